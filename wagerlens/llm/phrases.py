"""Phrase mining: word n-grams that are more frequent than their parts make likely.

Texts are cut at piece marks, pieces into words. Tasks number the words of a chunk of text and keep the
chunk as numbers. The chunk's distinct words go, by a hash, to tasks that sum them up, give dense ids
to those frequent enough in their language and answer each chunk. n-grams of 2, 3, ... words are then
counted in counting quotient filters, one per chunk and key range, which are merged by range: what is
shuffled is the distinct n-grams of a chunk, however often they occur. No n-gram is more frequent than
its parts, so the next length looks only at places where both parts are frequent; the merging task
answers each filter with one bit per entry, and a chunk drops all other places. Nothing is dropped
that could reach `min_count`; counts are exact.

Nothing is broadcast that grows with rows; one number per word bucket (`BUCKET_BYTES` of text) travels
with the tasks. A chunk holds up to `CHUNK_BYTES` of text (a longer text is cut between pieces; a
single longer piece stays whole), a range about `RANGE_KEYS` entries. A filter per chunk and range
should hold some hundred entries at least, so for corpora of many TB raise both.

Nulls: a null text is empty, a null language is `und`. Empty texts hold no words. Repeated rows count
each. An empty table, or one without frequent phrases, gives an empty result. Other columns are not
read. Scores are exact while 1000 * a * n stays below 10 ** 38.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import importable, store
from wagerlens.llm.quotient import Layout, counted, filters, merge
from wagerlens.sources.scratch import scratch_dir

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
PERCENT = 100
CHUNK_BYTES = 8 << 20
RANGE_KEYS = 2_000_000
BUCKET_BYTES = 32 << 20
MARKS = b".,;:!?\n\x0b\x0c\r"
# All marks become one, tabs become blanks, and only A-Z are lower-cased.
PLAIN = bytes(
    46 if b in MARKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
MARK = b"."
TOKENS, LISTED, IDS, LANGS = "tokens", "words", "ids", "langs"
CODED, FILTERS, MASKS, COUNTS = "coded", "filters", "masks", "counts"


class Words(dict):
    """Numbers the words of one language within a chunk, shared with the chunk's other languages."""

    def __init__(self, lang: str, listed: list):
        super().__init__({MARK: -1})
        self.lang, self.listed = lang, listed

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.listed)
        self.listed.append((self.lang, word))
        return number


def parts_of(text: bytes, limit: int) -> Iterator[bytes]:
    """A text with one kind of mark, cut at marks into parts of at most `limit` where there are any."""
    first = 0
    while len(text) - first > limit:
        cut = text.rfind(MARK, first, first + limit)
        if cut < 0:
            cut = text.find(MARK, first + limit)
        if cut < 0:
            break
        yield text[first : cut + 1]
        first = cut + 1
    yield text[first:]


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers from -1 to 2 ** 32 - 2 as compressed bytes, those of equal weight together."""
    head = len(values).to_bytes(8, "little")
    if not len(values):
        return head
    planes = (values + 1).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return head + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def loosened(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    if not n:
        return np.zeros(0, dtype=np.int64)
    flat = np.frombuffer(pa.decompress(raw[8:], 4 * n, "zstd"), dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(4, n).T).view("<u4").reshape(-1).astype(np.int64) - 1


CUT = "kind string, chunk long, number int, lang string, data binary, counts binary, names binary"


def chunks(docs: DataFrame, text: str, lang: str, chunk_bytes: int, buckets: int) -> DataFrame:
    """Per chunk a row with its texts as numbers (-1 between pieces), and for each language and bucket of
    words a row with the numbers, counts and spellings of the chunk's words in it."""
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in CUT.split(", ")]

    def rows_of(number: int, held: list[np.ndarray], listed: list) -> pa.RecordBatch:
        ids = np.concatenate(held)
        counts = np.bincount(ids[ids >= 0], minlength=len(listed))
        rows = [(TOKENS, number, -1, None, squeezed(ids), None, None)]
        places: dict[tuple, list[int]] = {}
        for i, (code, word) in enumerate(listed):
            places.setdefault((code, crc32(word) % buckets), []).append(i)
        for (code, bucket), some in places.items():
            spelled = b" ".join([listed[i][1] for i in some])  # no word holds a blank
            at = np.array(some, dtype=np.int64)
            rows.append((LISTED, number, bucket, code, squeezed(at), squeezed(counts[at]), spelled))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        listed: list = []
        words: dict[str, Words] = {}
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for raw, name in zip(texts, batch.column(1), strict=True):
                code = name.as_py()
                for part in parts_of((raw.as_py() or b"").translate(PLAIN), chunk_bytes):
                    if code not in words:
                        words[code] = Words(code, listed)
                    found = part.replace(MARK, b" . ").split()  # no white space but blanks is left
                    ids = list(map(words[code].__getitem__, found))
                    if not ids:
                        continue
                    held.append(np.array([*ids, -1], dtype=np.int32))
                    size += len(part)
                    if size >= chunk_bytes:
                        yield rows_of(number, held, listed)
                        number, size, listed = number + 1, 0, []
                        held.clear()
                        words.clear()
        if held:
            yield rows_of(number, held, listed)

    given = docs.select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
    )
    return given.mapInArrow(work, CUT)


NUMBERED = "kind string, chunk long, number int, lang string, data binary, counts binary, word string, f long"


def _numbered(min_count: int):
    """Sums up the words of a bucket: ids from 0 for the frequent ones, which ids each chunk's words
    have, and all words per language."""

    def answer(key, rows):
        bucket = key[0].as_py()
        asked = list(zip(*(rows.column(c).to_pylist() for c in ("chunk", "lang", "data", "counts", "names")), strict=True))
        total: dict[tuple, int] = {}
        langs: dict[str, int] = {}
        spelled = []
        for _, code, _, counts, names in asked:
            words = names.split(b" ")
            spelled.append(words)
            counts = loosened(counts).tolist()
            langs[code] = langs.get(code, 0) + sum(counts)
            for word, n in zip(words, counts, strict=True):
                total[code, word] = total.get((code, word), 0) + n
        often = sorted(k for k, n in total.items() if n >= min_count)
        ids = {k: i for i, k in enumerate(often)}
        out = [("words", None, i, code, None, None, word.decode("utf-8", "replace"), total[code, word]) for (code, word), i in ids.items()]
        out += [(LANGS, None, bucket, code, None, None, None, n) for code, n in langs.items()]
        for (chunk, code, at, _, _), words in zip(asked, spelled, strict=True):
            found = np.array([ids.get((code, w), -1) for w in words], dtype=np.int64)
            some = found >= 0
            out.append((IDS, chunk, bucket, None, squeezed(loosened(at)[some]), squeezed(found[some]), None, None))
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.int64()]
        named = [c.split()[0] for c in NUMBERED.split(", ")]
        table = pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=named)
        return table.append_column("bucket", pa.array([bucket] * table.num_rows, pa.int32()))

    return answer


def windows(ids: np.ndarray, words: int) -> np.ndarray:
    """Where n-grams of so many words begin; none holds a -1."""
    starts = max(0, len(ids) - words + 1)
    whole = np.ones(starts, dtype=bool)
    for k in range(words):
        whole &= ids[k : k + starts] >= 0
    return np.flatnonzero(whole)


def trimmed(ids: np.ndarray, alive: np.ndarray, words: int) -> np.ndarray:
    """The places that an n-gram of one more word can lie in; `alive` are the starts of frequent ones."""
    live = np.zeros(len(ids) + 1, dtype=bool)
    live[alive] = True
    both = np.flatnonzero(live[:-1] & live[1:])
    edge = np.zeros(len(ids) + words + 2, dtype=np.int64)
    edge[both] += 1
    edge[both + words + 1] -= 1
    covered = np.cumsum(edge)[: len(ids)] > 0
    kept = covered.copy()
    kept[1:] |= covered[:-1]
    return np.where(covered, ids, -1)[kept]


def packed(layout: Layout, ids: np.ndarray) -> list[np.ndarray]:
    at = windows(ids, layout.words)
    return layout.pack([ids[at + k] for k in range(layout.words)])


KEPT = "kind string, chunk long, number int, data binary, grams long"


def _counted_rows(chunk: int, ids: np.ndarray, layout: Layout) -> pa.Table:
    """A chunk's numbers, and its filters for the n-grams of the layout."""
    at = windows(ids, layout.words)
    rows = []
    if len(at):
        limbs, counts = counted(packed(layout, ids))
        rows = [(CODED, chunk, -1, squeezed(ids), len(at))]
        rows += [(FILTERS, chunk, r, raw, 0) for r, raw in filters(layout, limbs, counts)]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["kind", "chunk", "number", "data", "grams"],
    )


def _first(layout: Layout, starts: np.ndarray, chunk: pa.Table, known: pa.Table) -> pa.Table:
    """The chunk's own numbers become ids of frequent words; `starts` are the first ids of the buckets."""
    if not chunk.num_rows:
        return _counted_rows(0, np.zeros(0, dtype=np.int64), layout)
    own = loosened(chunk.column("data")[0].as_py())
    to = np.full(int(own.max(initial=-1)) + 2, -1, dtype=np.int64)  # the last place is for -1
    for bucket, at, ids in zip(*(known.column(c).to_pylist() for c in ("number", "data", "counts")), strict=True):
        to[loosened(at)] = loosened(ids) + starts[bucket]
    ids = to[own]
    ids = trimmed(ids, np.flatnonzero(ids >= 0), 1)
    return _counted_rows(chunk.column("chunk")[0].as_py(), ids, layout)


def _next(before: Layout, layout: Layout, chunk: pa.Table, masks: pa.Table) -> pa.Table:
    """Only places with frequent n-grams of the layout before stay."""
    if not chunk.num_rows:
        return _counted_rows(0, np.zeros(0, dtype=np.int64), layout)
    ids = loosened(chunk.column("data")[0].as_py())
    at, limbs = windows(ids, before.words), packed(before, ids)
    order = np.argsort(limbs[0]) if len(limbs) == 1 else np.lexsort(limbs[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for x in limbs:
        ordered = x[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    said = sorted(zip(masks.column("number").to_pylist(), masks.column("data").to_pylist(), masks.column("grams").to_pylist(), strict=True))
    frequent = np.concatenate([np.unpackbits(np.frombuffer(m, dtype=np.uint8), count=n) for _, m, n in said])
    entry = np.cumsum(new) - 1
    if len(frequent) != entry[-1] + 1:
        raise RuntimeError("a chunk got answers for other filters than its own")
    alive = at[order[frequent[entry].astype(bool)]]
    return _counted_rows(chunk.column("chunk")[0].as_py(), trimmed(ids, alive, before.words), layout)


def _merged(layout: Layout, min_count: int, key: tuple, rows: pa.Table) -> pa.Table:
    """Frequent n-grams of a range, and a bit for every entry of each filter."""
    number = key[0].as_py()
    asked = rows.column("chunk").to_pylist()
    limbs, counts, places = merge(layout, number, rows.column("data").to_pylist())
    enough = counts >= min_count
    columns = layout.unpack([x[enough] for x in limbs])
    grams = np.stack(columns, axis=1).astype(np.int32).reshape(-1)
    ends = np.arange(int(enough.sum()) + 1, dtype=np.int32) * layout.words
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(grams))
    n = len(lists)
    masks = [np.packbits(enough[p]).tobytes() for p in places]
    m = len(masks)
    none = lambda kind, many: pa.nulls(many, kind)
    both = [
        [pa.array([COUNTS] * n, pa.string()), pa.array([MASKS] * m, pa.string())],
        [none(pa.int64(), n), pa.array(asked, pa.int64())],
        [none(pa.int32(), n), pa.array([number] * m, pa.int32())],
        [none(pa.binary(), n), pa.array(masks, pa.binary())],
        [pa.array(counts[enough], pa.int64()), pa.array([len(p) for p in places], pa.int64())],
        [lists, none(pa.list_(pa.int32()), m)],
    ]
    return pa.Table.from_arrays(
        [pa.concat_arrays(c) for c in both],
        names=["kind", "chunk", "number", "data", "grams", "words"],
    )


def _answering(layout: Layout, min_count: int):
    # Spark looks at the type hints of a plain function, of which this one has none.
    return lambda key, rows: _merged(layout, min_count, key, rows)


def _coding(layout: Layout, starts: np.ndarray):
    return lambda chunk, known: _first(layout, starts, chunk, known)


def _recoding(layout: Layout, before: Layout):
    return lambda chunk, masks: _next(before, layout, chunk, masks)


def _by_kind(df: DataFrame, label: str) -> DataFrame:
    """Stored with a folder per kind, so that a reader of one opens no other."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def phrase_counts(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    chunk_bytes: int = CHUNK_BYTES,
    range_keys: int = RANGE_KEYS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: lang, word, f, id), (phrases: words, a), (langs: lang, n); phrases have 2 words or more,
    as ids. All are stored."""
    spark = docs.sparkSession
    importable(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    buckets = max(least, -(-size // BUCKET_BYTES))
    cut = _by_kind(chunks(docs, text, lang, chunk_bytes, buckets), "phrase-chunks")
    numbered = _by_kind(
        cut.filter(F.col("kind") == LISTED)
        .select("number", "chunk", "lang", "data", "counts", "names")
        .groupBy("number")
        .applyInArrow(_numbered(min_count), f"{NUMBERED}, bucket int"),
        "phrase-words",
    )
    langs = numbered.filter(F.col("kind") == LANGS).groupBy("lang").agg(F.sum("f").alias("n"))
    spelled = numbered.filter(F.col("kind") == "words")
    sizes = np.zeros(buckets + 1, dtype=np.int64)
    total = 0
    for r in spelled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("f").alias("f")).collect():
        sizes[r["bucket"] + 1] = r["n"]
        total += r["f"]
    starts = np.cumsum(sizes)
    many = int(starts[-1])
    if many >= 2**31:
        raise OverflowError(f"{many} frequent words; ids have 31 bits")
    first = spark.createDataFrame(list(enumerate(starts[:-1].tolist())), "bucket int, first long")
    words = spelled.join(F.broadcast(first), "bucket").select(
        "lang", "word", "f", (F.col("first") + F.col("number")).cast("int").alias("id")
    )
    bits = max(1, (many - 1).bit_length())
    ranges = min(max(least, -(-total // range_keys)), 1 << min(30, 2 * bits))
    left = cut.filter(F.col("kind") == TOKENS).select("chunk", "data")
    right = numbered.filter(F.col("kind") == IDS).select("chunk", "number", "data", "counts")
    step, found = _coding(Layout(2, bits, ranges), starts), None
    for k in range(2, max_words + 1):
        layout = Layout(k, bits, ranges)
        met = left.groupBy("chunk").cogroup(right.groupBy("chunk"))
        counted_chunks = _by_kind(met.applyInArrow(step, KEPT), f"phrases-{k}")
        merged = _by_kind(
            counted_chunks.filter(F.col("kind") == FILTERS)
            .select("chunk", "number", "data")
            .groupBy("number")
            .applyInArrow(_answering(layout, min_count), f"{KEPT}, words array<int>"),
            f"phrases-{k}-merged",
        )
        here = merged.filter(F.col("kind") == COUNTS).select("words", F.col("grams").alias("a"))
        found = here if found is None else found.unionByName(here)
        left = counted_chunks.filter(F.col("kind") == CODED).select("chunk", "data")
        right = merged.filter(F.col("kind") == MASKS).select("chunk", "number", "data", "grams")
        if k < max_words:
            step = _recoding(Layout(k + 1, bits, ranges), layout)
    return words, found, langs


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    percent: int = PERCENT,
    chunk_bytes: int = CHUNK_BYTES,
    range_keys: int = RANGE_KEYS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    words, phrases, langs = phrase_counts(
        docs, text, lang, min_count, max_words, chunk_bytes, range_keys
    )
    size = F.size("words")
    # A phrase within a longer one of as many: one word more is enough to look at, as all phrases
    # in between are at least as frequent as the longest.
    inner = F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", 2, size - 1)))
    longer = phrases.filter(size > 2).select(inner.alias("words"), F.col("a").alias("longer"))
    longer = longer.groupBy("words").agg(F.max("longer").alias("longer"))
    left = phrases.join(longer, "words", "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))
    )
    single = words.select(F.array("id").alias("words"), F.col("f").alias("a"))
    known = store(phrases.unionByName(single), "phrase-parts")
    cuts = (
        left.drop("longer")
        .withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1)))
        .select(
            F.col("words").alias("whole"), "a", "cut",
            F.slice("words", F.lit(1), F.col("cut")).alias("head"),
            F.slice("words", F.col("cut") + 1, size - F.col("cut")).alias("tail"),
        )
        .join(known.select(F.col("words").alias("head"), F.col("a").alias("l")), "head")
        .join(known.select(F.col("words").alias("tail"), F.col("a").alias("r")), "tail")
        .withColumn("first", F.element_at("whole", 1))
    )
    of_lang = words.join(langs, "lang").select(F.col("id").alias("first"), "lang", "n")
    score = F.expr(
        "CAST((CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(16,0)))"
        " DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS BIGINT)"
    )
    weakest = (
        cuts.join(of_lang, "first")
        .withColumn("score", score)
        .groupBy("whole")
        .agg(F.min(F.struct("score", "cut", "a", "l", "r", "n", "lang")).alias("best"))
        .select("whole", "best.*")
    )
    # Ties at the end of a language's list are settled by the phrase, so all of them are kept here.
    ranked = weakest.withColumn(
        "rank", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    ).filter(F.col("rank") <= top)
    spelled = (
        ranked.select("whole", F.posexplode("whole").alias("at", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("whole")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
        .select("whole", F.array_join(F.col("spelled.word"), " ").alias("phrase"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        ranked.drop("rank")
        .join(spelled, "whole")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def check_sql(min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> str:
    """The same rows from plain strings: all n-grams by grouping, parts by self-joins."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    marks = " || ".join([*[f"'{c}'" for c in ".,;:!?"], *[f"chr({c})" for c in (10, 11, 12, 13)]])
    leads = ", ".join(f"lead(w1, {k - 1}) OVER o AS w{k}" for k in range(2, max_words + 1))
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, {' || chr(32) || '.join(f'w{i}' for i in range(1, k + 1))} AS g FROM x"
        f" WHERE w{k} IS NOT NULL"
        for k in range(1, max_words + 1)
    )
    return f"""
    WITH d AS (
      SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}' || chr(9) || {marks},
             '{lower}' || ' ' || repeat(chr(10), 10)) AS t FROM documents
    ), q AS (
      SELECT lang, unnest(string_split(t, chr(10))) AS t FROM d
    ), p AS (
      SELECT row_number() OVER () AS r, lang, list_filter(string_split(t, ' '), lambda x: x <> '') AS w
      FROM q
    ), o AS (
      SELECT r, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p
    ), x AS (
      SELECT lang, w1, {leads} FROM o WINDOW o AS (PARTITION BY r ORDER BY i)
    ), g AS (
      SELECT lang, k, g, count(*) AS a FROM ({grams}) GROUP BY lang, k, g
    ), n AS (
      SELECT lang, sum(a)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang
    ), f AS (
      SELECT lang, k, g, a, string_split(g, ' ') AS w FROM g WHERE a >= {min_count}
    ), long AS (
      SELECT lang, h, max(a) AS a FROM (
        SELECT lang, a, array_to_string(w[1:k - 1], ' ') AS h FROM f WHERE k > 2 UNION ALL
        SELECT lang, a, array_to_string(w[2:k], ' ') AS h FROM f WHERE k > 2) GROUP BY lang, h
    ), c AS (
      SELECT f.lang, f.g, f.a, f.w, f.k, u.cut FROM f, (SELECT unnest(range(1, {max_words})) AS cut) AS u
      WHERE f.k > 1 AND u.cut < f.k
    ), s AS (
      SELECT c.lang, c.g, c.a, c.cut, l.a AS l, r.a AS r, n.n,
             ((1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
      FROM c JOIN f l ON l.lang = c.lang AND l.g = array_to_string(c.w[1:c.cut], ' ')
      JOIN f r ON r.lang = c.lang AND r.g = array_to_string(c.w[c.cut + 1:c.k], ' ')
      JOIN n ON n.lang = c.lang
    ), b AS (
      SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS best FROM s
    ), t AS (
      SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.g) AS rank
      FROM b LEFT JOIN long ON long.lang = b.lang AND long.h = b.g
      WHERE best = 1 AND (long.a IS NULL OR long.a < b.a)
    )
    SELECT lang, rank::INT AS rank, g AS phrase, a, l, r, n, score FROM t WHERE rank <= {top}
    """
