"""Language identification in two steps: the family first, then the language within it.

A text is described by counts of its byte n-grams (1 to 3 bytes of the lower-cased text, runs
without letters taken as one blank), hashed into DIMS places, square-rooted and scaled to length
one. One linear support vector machine per family, against all others, picks the family; within it
one machine per pair of languages votes, ties going to the larger sum of margins.

The machines are fitted on at most `sample_rows` labelled documents (the bound of what reaches the
driver), the same number of each language, picked by a hash of doc_id; of rows that repeat a doc_id
and language the least text is taken. All languages are learned: more than `max_languages` end the
run with an error, as one machine is fitted for each family and each pair within it. A `sample_rows`
below the number of languages leaves the rarest out, with a warning. Every text is predicted
whole. `score` is the product of the family's and the language's confidence, each a logistic
function of margins.

Only text and non-null lang of documents outside the held-out fifth (crc32 of doc_id as text,
modulo 5, is 0) are learned from. Nulls, empty texts: null texts and texts without a letter are
`und` with score 0; a null doc_id counts as held out. Without any labelled row all is `und`.
Repeated rows are predicted alike; extra columns are left to the caller.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import fresh, importable
from wagerlens.llm.svm import train

UNKNOWN = "und"
FOLDS = 5
SAMPLE_ROWS = 3000
MAX_LANGUAGES = 200
DIMS = 4096
CHUNK_BYTES = 8_000_000
CHUNK_DOCS = 256

# Families of closely related languages. Others are a family of their own.
FAMILIES = {
    "germanic": "en de nl af fy lb da sv no nb nn is fo",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl",
    "baltic": "lt lv",
    "finnic": "fi et",
    "turkic": "tr az kk uz tk ky",
    "indic": "hi mr ne bn gu pa ur",
    "malayic": "id ms",
}

_LETTER = regex.compile(r"\p{L}")
# ASCII letters and all bytes of other characters stay; the rest becomes one blank.
_PLACE = np.array(
    [b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint8
)


def family_of(lang: str) -> str:
    for family, members in FAMILIES.items():
        if lang in members.split():
            return family
    return lang


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def features(texts: list[str]) -> np.ndarray:
    """One row of DIMS + 1 places per text; the last is constant."""
    out = np.empty((len(texts), DIMS + 1), dtype=np.float32)
    for i, text in enumerate(texts):
        raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8)
        counts = np.zeros(DIMS, dtype=np.int64)
        # Three bytes reach over a cut between chunks, so that long texts need little memory.
        tail = np.empty(0, dtype=np.uint8)
        for at in range(0, len(raw), CHUNK_BYTES):
            b = _PLACE[raw[at : at + CHUNK_BYTES]]
            joined = np.concatenate((tail, b))
            blank = joined == 32
            keep = ~(blank & np.r_[False, blank[:-1]])
            keep[: len(tail)] = True
            b = joined[keep].astype(np.uint32)
            reach = len(tail)
            two = b[:-1] * np.uint32(257) + b[1:]
            three = two[:-1] * np.uint32(259) + b[2:]
            for grams, size in ((b, 1), (two, 2), (three, 3)):
                new = grams[max(0, reach - size + 1) :]
                mixed = (new * np.uint32(2654435761) + np.uint32(size * 40503)) >> np.uint32(20)
                counts += np.bincount(mixed, minlength=DIMS)
            tail = b[-2:].astype(np.uint8)
        row = np.sqrt(counts, dtype=np.float32)
        out[i, :DIMS] = row / max(float(np.sqrt((row * row).sum())), 1e-9)
    out[:, DIMS] = 0.1
    return out


@dataclass
class Model:
    """Weights by family, and by pair of languages within each."""

    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    members: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> Model:
        learned = sorted(set(langs.tolist()))
        members: dict[str, list[str]] = {}
        for lang in learned:
            members.setdefault(family_of(lang), []).append(lang)
        families = sorted(members)
        own = np.array([family_of(lang) for lang in langs.tolist()])
        weights = [train(x, np.where(own == f, 1, -1)) for f in families] if len(families) > 1 else []
        pairs = {}
        for f in families:
            rows = []
            for a, b in combinations(members[f], 2):
                some = (langs == a) | (langs == b)
                rows.append(train(x[some], np.where(langs[some] == a, 1, -1)))
            if rows:
                pairs[f] = np.stack(rows)
        return cls(families, np.stack(weights) if weights else None, members, pairs)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        if self.family_weights is None:
            family, sure = np.zeros(len(x), dtype=int), np.ones(len(x))
        else:
            margins = x @ self.family_weights.T
            ranked = np.sort(margins, axis=1)
            family, sure = margins.argmax(axis=1), _logistic(ranked[:, -1] - ranked[:, -2])
        langs, score = [UNKNOWN] * len(x), np.zeros(len(x))
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(family == k)
            if not len(rows):
                continue
            own, best, held = self._within(name, x[rows])
            for r, b in zip(rows, best, strict=True):
                langs[r] = own[b]
            score[rows] = sure[rows] * held
        return langs, score

    def _within(self, family: str, x: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        own = self.members[family]
        if len(own) == 1:
            return own, np.zeros(len(x), dtype=int), np.ones(len(x))
        margins = x @ self.pairs[family].T
        votes, sums = np.zeros((len(x), len(own))), np.zeros((len(x), len(own)))
        worst = np.full((len(x), len(own)), np.inf)
        for p, (a, b) in enumerate(combinations(range(len(own)), 2)):
            for lang, m in ((a, margins[:, p]), (b, -margins[:, p])):
                votes[:, lang] += m > 0
                sums[:, lang] += m
                worst[:, lang] = np.minimum(worst[:, lang], m)
        best = (votes + np.tanh(sums) / 4).argmax(axis=1)
        return own, best, _logistic(2 * worst[np.arange(len(x)), best])


def _logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(
        F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True)
    )


def learnable(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES
) -> DataFrame:
    """lang and text of the labelled documents that are fitted on, `sample_rows` at most."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    named = rows.select(
        F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id")
    )
    # Near enough for a cut that leaves twice as many rows as are picked; no ids are shuffled for it.
    counts = named.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("count"))
    found = counts.limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages to learn: raise max_languages")
    found.sort(key=lambda r: (-r["count"], r["lang"]))
    if len(found) > sample_rows:
        warnings.warn(f"{sample_rows} of {len(found)} languages are learned: raise sample_rows")
    langs = {r["lang"]: r["count"] for r in found[:sample_rows]}
    each = max(1, sample_rows // max(1, len(langs)))
    # Of a language with many rows only those of small hash are ranked, twice as many as needed on
    # average, so no task gets all rows of a common language.
    small = F.lit(False)
    for lang, n in langs.items():
        share = min(1.0, (2 * each + 100) / n)
        low = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
        small = F.when(F.col("lang") == lang, low).otherwise(small)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # Ids are ranked without their texts; the texts of the few picked are fetched after that.
    picked = (
        named.filter(small)
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= each)
        .select("doc_id", "lang")
    )
    texts = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    # At most `sample_rows` ids and languages are broadcast.
    found = texts.join(F.broadcast(picked), ["doc_id", "lang"], "left_semi")
    return found.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")


def fit(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES
) -> Model:
    """The model of a bounded sample; its features are made by Spark's tasks."""
    importable(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if has_letter(text):
                    row = features([text])[0].tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([row], pa.binary())], names=["lang", "x"]
                    )

    rows = learnable(docs, sample_rows, max_languages).mapInArrow(describe, "lang string, x binary").collect()
    if not rows:
        return Model()
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    x = np.stack([np.frombuffer(r["x"], dtype=np.float32) for r in rows])
    return Model.fit(x, np.array([r["lang"] for r in rows], dtype=object))


def predict(
    docs: DataFrame, model: Model, carry: list[str], lang_pred: str = "lang_pred", sure: str = "score"
) -> DataFrame:
    """The `carry` columns, then the language and its score, of every whole text."""
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(model)  # a few weights per pair of languages

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_DOCS):
                part = batch.slice(at, CHUNK_DOCS)
                texts = part.column(part.num_columns - 1).to_pylist()
                langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                some = [i for i, t in enumerate(texts) if has_letter(t)]
                if some:
                    names, scores = known.predict(features([texts[i] for i in some]))
                    for i, name in zip(some, names, strict=True):
                        langs[i] = name
                    score[some] = scores
                columns = [part.column(i) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                    names=[*carry, lang_pred, sure],
                )

    kinds = docs.select(*[F.col(f"`{c}`") for c in carry]).schema
    text = F.col("text").cast("string").alias("_text")
    picked = docs.select(*[F.col(f"`{c}`") for c in carry], text)
    return picked.mapInArrow(label, kinds.add(lang_pred, "string").add(sure, "double"))


def identify(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = fit(docs, sample_rows, max_languages)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return predict(ids, model, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def keep_identified(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, least: float = 0.0
) -> DataFrame:
    """The documents in a learned language with a score of at least `least`.

    Texts that are null or hold no letter go. All columns, in their order, are those of the input.
    """
    model = fit(docs, sample_rows)
    lang, score = fresh(docs.columns, "lang_pred", "score")
    found = predict(docs, model, docs.columns, lang, score)
    return found.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).drop(lang, score)
