"""Personal data in texts: base patterns, and further spans chosen by boosted trees.

Two generators per kind propose spans. The base patterns with their checks (parts of an address, Luhn
digit, number of digits) always count. The wide ones propose what these miss: a card number next to
another number, which a base pattern takes as one run of digits and drops, national phone numbers,
long-form addresses, spelled-out or accented e-mail. They overlap the base spans and each other.

Boosted trees score every candidate by its format and context (length, separators, leading digit,
characters around it, cue words before it), not by its checks: the checks are what they learn to
foretell, from the corpus itself. So a score says how likely a number that looks so and stands so is
no chance hit. Features are whole numbers of a few values each; all candidates of all documents are
counted by feature vector, of which there are at most `VECTORS`, and the trees are fitted and applied
to that table. A fifth of the documents is kept from the fit: the least score at which the share of
true candidates among them reaches `precision` (with one hit and one miss added) is the threshold of
a kind; a kind without such a score gets no further spans. A wide candidate is taken if it passes its
check, reaches its threshold and overlaps neither a base span nor one of a wide pattern listed earlier.

All of it are built-in functions and DataFrame operations. Patterns run in linear time: they can't
back off into what they have matched, or only by a bounded number of characters.

Nulls, empty texts: both are texts without spans; documents of a null doc_id are kept. Repeated rows
are documents of their own. Places count code points. A text of any length is one row; its spans are
put in order by a window over that row's matches. An empty table gives an empty result. Columns of
the caller are kept by `redact`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import fresh, store, text_or_empty

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.95
TREES = 12
DEPTH = 3
BEFORE, AFTER = 24, 2
CHUNK = 4096

_LOCAL = "A-Za-z0-9._%+-"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Generator:
    kind: int
    pattern: str
    base: bool


# A start that is no start of a run can only follow a match (\G), or else the run's start had matched.
GENERATORS = [
    Generator(0, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True),
    Generator(1, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True),
    Generator(2, r"[0-9](?:[ -]?+[0-9])++", True),
    Generator(3, r"\+[0-9][ ().0-9-]+[0-9]", True),
    Generator(
        0,
        r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+(?:@[\p{L}\p{N}-]{1,63}+(?:\.[\p{L}\p{N}-]{1,63}+){1,8}+"
        r"| ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+ ?(?:[\[(]dot[\])]|\.) ?[A-Za-z]{2,24}+)",
        False,
    ),
    Generator(
        1,
        rf"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}(?![0-9A-Fa-f:])"
        rf"|(?<![0-9])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9])",
        False,
    ),
    Generator(
        2,
        r"(?<![0-9A-Za-z])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}"
        r"|[0-9]{12,19}+)(?![0-9A-Za-z])",
        False,
    ),
    Generator(
        3,
        r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
        r"|(?<![0-9A-Za-z+(])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])",
        False,
    ),
]

# Words that speak for personal data or against it.
FOR = "mail|phone|mobile|tel|fax|call|card|visa|credit|address|contact|host|client|user|reach"
AGAINST = "token|secret|hash|key|version|isbn|serial|invoice|order|sku|build"

FEATURES = ["generator", "digits", "leading", "separators", "before", "after", "cue", "counter_cue"]
# Values each feature can take; their product bounds the table the trees are fitted on.
SIZES = [8, 14, 6, 5, 6, 6, 2, 2]
VECTORS = 8 * 14 * 6 * 5 * 6 * 6 * 2 * 2

MARK = "struct<gen:int,at:int,gap:int,before:string,head:string,hit:string>"


def _marks(text: Column, number: int, pattern: str) -> Column:
    """All matches of a pattern, each with the length, end and beginning of the gap before it; the
    gap after the last one follows without a match."""
    gaps = F.transform(
        F.split(text, pattern, -1),
        lambda g: F.struct(
            F.length(g).alias("n"),
            F.substring(g, -BEFORE, BEFORE).alias("tail"),
            F.substring(g, 1, AFTER).alias("head"),
        ),
    )
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(gaps.alias("g"), hits.alias("h"))
    marks = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("gen"), i.alias("at"), x["g"]["n"].alias("gap"),
            x["g"]["tail"].alias("before"), x["g"]["head"].alias("head"), x["h"].alias("hit"),
        ),
    )
    none = F.array().cast(f"array<{MARK}>")
    return F.when(text.rlike(pattern), marks.cast(f"array<{MARK}>")).otherwise(none)


def matches(docs: DataFrame, text: str = "text", row: Column | None = None) -> DataFrame:
    """row, doc_id, marks of every document, stored; marks are small beside the texts."""
    number = F.monotonically_increasing_id() if row is None else row
    found = F.concat(*[_marks(F.col("text"), i, g.pattern) for i, g in enumerate(GENERATORS)])
    return store(
        docs.select(number.alias("row"), F.col("doc_id").alias("doc_id"), text_or_empty(text).alias("text"))
        .withColumn("marks", found)
        .drop("text"),
        "private-marks",
    )


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is divisible by ten."""

    def added(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), added) % 10 == 0


def _class(c: Column, none: Column) -> Column:
    """What kind of character stands beside a span."""
    return (
        F.when(none, 0).when(c.rlike(r"[\s]"), 1).when(c.rlike(r"\p{L}"), 2).when(c.rlike("[0-9]"), 3)
        .when(c.rlike("[\"'=:/#\\\\]"), 4).otherwise(5)
    )


def candidates(marks: DataFrame) -> DataFrame:
    """row, gen, kind, start, end, base, true (its check holds), and the features of every match."""
    each = marks.select("row", "doc_id", F.explode("marks").alias("m")).select("row", "doc_id", "m.*")
    along = Window.partitionBy("row", "gen").orderBy("at")
    size = F.coalesce(F.length("hit"), F.lit(0))
    placed = (
        each.withColumn("end", F.sum(F.col("gap").cast("long") + size).over(along))
        .withColumn("next", F.lead("head").over(along))
        .filter(F.col("hit").isNotNull())
        .withColumn("start", F.col("end") - F.length("hit"))
        .withColumn("figures", F.regexp_replace("hit", "[^0-9]+", ""))
        .withColumn("n", F.length("figures"))
    )
    hit, n, gen = F.col("hit"), F.col("n"), F.col("gen")
    kind = F.element_at(F.array(*[F.lit(g.kind) for g in GENERATORS]), gen + 1)
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    last = F.substring("before", -1, 1)
    card = F.when(n.between(12, 19), luhn(F.col("figures"))).otherwise(F.lit(False))
    national = hit.rlike(r"^\(?[2-9][0-9]{2}[^0-9]+[2-9]")
    top = F.lower(F.regexp_extract(hit, "([A-Za-z]+)$", 1))
    checks = [
        F.lit(True),
        hit.rlike(rf"^{part}(?:\.{part}){{3}}$"),
        card,
        n.between(9, 15),
        F.length(top).between(2, 24) & (~hit.contains("at") | hit.contains("@") | top.isin(
            "com", "org", "net", "edu", "gov", "info", "io", "de", "es", "fr", "uk")),
        F.when(hit.contains(":"), hit.rlike("[0-9A-Fa-f]{3}")).otherwise(
            (last != ".") & ~F.coalesce(F.col("next"), F.lit("")).rlike(r"^\.[0-9]")),
        card,
        F.when(hit.startswith("+"), n.between(9, 15)).otherwise(national),
    ]
    true = F.lit(False)
    for i, check in reversed(list(enumerate(checks))):
        true = F.when(gen == i, check).otherwise(true)
    lead = F.substring("figures", 1, 1)
    separators = F.regexp_replace("hit", r"[\p{L}\p{N}@+()]+", "")
    cue = F.lower("before")
    head = F.substring("next", 1, 1)
    features = {
        "generator": gen,
        "digits": F.when(n == 0, 0).when(n < 9, 1).when(n > 19, 13).otherwise(n - 7),
        "leading": F.when(lead == "", 0).when(lead == "3", 1).when(lead == "4", 2).when(lead == "5", 3)
        .when(lead.isin("2", "6"), 4).otherwise(5),
        "separators": F.when(separators == "", 0).when(separators.rlike("^ +$"), 1)
        .when(separators.rlike("^-+$"), 2).when(separators.rlike(r"^\.+$"), 3).otherwise(4),
        "before": _class(last, (F.col("gap") == 0) & (F.col("at") == 0)),
        "after": _class(head, F.coalesce(head, F.lit("")) == ""),
        "cue": cue.rlike(FOR).cast("int"),
        "counter_cue": cue.rlike(AGAINST).cast("int"),
    }
    is_base = gen < len(KINDS)
    return placed.select(
        "row", "doc_id", "gen", kind.alias("kind"), "start", "end", (is_base & true).alias("base"),
        true.alias("true"), F.struct(*[c.cast("int").alias(k) for k, c in features.items()]).alias("f"),
    )


def scored_vectors(
    found: DataFrame, trees: int = TREES, depth: int = DEPTH, precision: float = PRECISION
) -> DataFrame | None:
    """f, score, threshold of every feature vector, at most VECTORS rows; None with nothing to learn.

    Vectors are counted with what their checks said, so the trees learn from all candidates.
    """
    held_out = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("row").cast("string"))), F.lit(5)) == 0
    counts = store(
        found.groupBy("f", "kind")
        .agg(
            *[
                F.count_if((held_out == F.lit(h)) & (F.col("true") == F.lit(t))).cast("double").alias(name)
                for name, h, t in (("hits", False, True), ("misses", False, False),
                                   ("held_hits", True, True), ("held_misses", True, False))
            ]
        ),
        "private-vectors",
    )
    seen = counts.agg(F.sum("hits"), F.sum("misses")).first()
    if not seen[0]:
        return None
    wide = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        counts.select("*", "f.*")
    )
    if not seen[1]:
        scored = counts.withColumn("score", F.lit(1.0))
    else:
        # One task, in one order: the fit is the same each time. The table is bounded.
        labelled = wide.select(
            "features", F.explode(F.array(
                F.struct(F.lit(1.0).alias("label"), F.col("hits").alias("weight")),
                F.struct(F.lit(0.0).alias("label"), F.col("misses").alias("weight")))).alias("x"),
            *FEATURES,
        ).select("features", "x.*", *FEATURES).filter("weight > 0")
        ordered = labelled.coalesce(1).sortWithinPartitions(*FEATURES, "label")
        boosted = GBTClassifier(
            maxIter=trees, maxDepth=depth, maxBins=max(SIZES), stepSize=0.5, seed=11, weightCol="weight",
            minInstancesPerNode=1, minWeightFractionPerNode=0.0,
        ).fit(ordered)
        scored = boosted.transform(wide).withColumn("score", vector_to_array("probability")[1])
    falling = Window.partitionBy("kind").orderBy(F.desc("score")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    hits, misses = F.sum("held_hits").over(falling), F.sum("held_misses").over(falling)
    share = (hits + 1) / (hits + misses + 2)
    enough = F.when(share >= precision, F.col("score"))
    return store(
        scored.withColumn("enough", enough)
        .withColumn("threshold", F.min("enough").over(Window.partitionBy("kind")))
        .select("f", "score", "threshold"),
        "private-scores",
    )


def _overlapped(spans: DataFrame, kept: Column) -> DataFrame:
    """Adds `hit_by`: a kept span of the same row shares a character with the span."""
    order = ["start", "end", "gen"]
    past = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    to_come = (
        Window.partitionBy("row").orderBy(*[F.desc(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = F.max(F.when(kept, F.col("end"))).over(past)
    near = F.min(F.when(kept, F.col("start"))).over(to_come)
    return spans.withColumn("reach", reach).withColumn("near", near).withColumn(
        "hit_by", F.coalesce(F.col("reach") > F.col("start"), F.lit(False))
        | F.coalesce(F.col("near") < F.col("end"), F.lit(False)),
    ).drop("reach", "near")


def spans_of(
    marks: DataFrame, precision: float = PRECISION, trees: int = TREES, depth: int = DEPTH
) -> DataFrame:
    """row, kind (place in KINDS), start, end, base, score: base spans and what the trees add."""
    found = store(candidates(marks), "private-candidates")
    scores = scored_vectors(found, trees, depth, precision)
    base = found.filter("base").select("row", "gen", "kind", "start", "end", "base", F.lit(1.0).alias("score"))
    if scores is None:
        return base.drop("gen")
    taken = (
        found.filter((F.col("gen") >= len(KINDS)) & F.col("true"))
        .join(F.broadcast(scores), "f")  # at most VECTORS rows
        .filter(F.col("score") >= F.col("threshold"))
        .select("row", "gen", "kind", "start", "end", "base", "score")
    )
    spans = base.unionByName(taken).withColumn("kept", F.col("base"))
    for gen in range(len(KINDS), len(GENERATORS)):
        spans = _overlapped(spans, F.col("kept")).withColumn(
            "kept", F.col("kept") | ((F.col("gen") == gen) & ~F.col("hit_by"))
        ).drop("hit_by")
    return spans.filter("kept").drop("kept", "gen")


def find_private(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """doc_id, row, kind, start, end, base, score of every span."""
    marks = matches(docs)
    names = F.array(*[F.lit(k) for k in KINDS])
    found = spans_of(marks, precision).withColumn("kind", F.element_at(names, F.col("kind") + 1))
    return marks.select("row", "doc_id").join(found, "row")


def private_digests(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    marks = matches(docs)
    found = spans_of(marks, precision)
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(only: Column | None) -> Column:
        one = F.struct("start", "kind", "end")
        ordered = F.array_sort(F.collect_list(one if only is None else F.when(only, one)))
        texts = F.transform(
            ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        )
        return F.array_join(texts, ",")

    per_row = found.groupBy("row").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        listed(F.col("base")).alias("base_spans"),
        listed(None).alias("spans"),
    )
    joined = marks.select("row", "doc_id").join(per_row, "row", "left")
    empty = F.lit("")
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base_spans", empty), 256).alias("base_sha256"),
        F.coalesce("spans", empty).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> DataFrame:
    """The documents with every span replaced by its kind, such as [EMAIL]; overlapping spans become one.

    Texts with spans are cut into pieces of CHUNK characters, so a span is found in its piece, however
    long the text, and many spans of one text are spread over tasks.
    """
    row, clean = fresh(docs.columns, "row", "clean")
    rows = store(docs.withColumn(row, F.monotonically_increasing_id()), "private-rows")
    narrow = rows.select(F.col(row).alias("row"), F.lit(None).alias("doc_id"), F.col(text).alias("text"))
    spans = spans_of(matches(narrow, row=F.col("row")), precision)
    past = Window.partitionBy("row").orderBy("start", "end", "kind")
    before = F.max("end").over(past.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(before <= F.col("start"), F.lit(True)).cast("int")
    islands = (
        spans.withColumn("new", new)
        .withColumn("island", F.sum("new").over(past))
        .groupBy("row", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "kind")).alias("kind"))
    )
    first, last = (F.floor(c / CHUNK).cast("long") for c in (F.col("start"), F.col("end") - 1))
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    cuts = (
        islands.withColumn("piece", F.explode(F.sequence(first, last)))
        .withColumn("label", F.when(F.col("piece") == first, F.element_at(labels, F.col("kind") + 1)).otherwise(""))
        .groupBy("row", "piece")
        .agg(F.array_sort(F.collect_list(F.struct(
            F.greatest(F.col("start") - F.col("piece") * CHUNK, F.lit(0)).cast("int").alias("a"),
            F.least(F.col("end") - F.col("piece") * CHUNK, F.lit(CHUNK)).cast("int").alias("b"), "label"))).alias("cuts"))
    )
    pieces = (
        rows.select(F.col(row).alias("row"), text_or_empty(text).alias("text"))
        .join(islands.select("row").distinct(), "row", "left_semi")
        .select("row", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).alias("piece", "part"))
    )

    def without(part: Column, cuts: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        done = F.aggregate(
            cuts, begin,
            lambda acc, c: F.struct(
                c["b"].alias("at"),
                F.concat(acc["out"], F.substring(part, acc["at"] + 1, c["a"] - acc["at"]), c["label"]).alias("out")),
        )
        return F.concat(done["out"], F.substring(part, done["at"] + 1, F.lit(CHUNK)))

    whole = (
        pieces.join(cuts, ["row", "piece"], "left")
        .withColumn("part", F.when(F.col("cuts").isNull(), F.col("part")).otherwise(without(F.col("part"), F.col("cuts"))))
        .groupBy(F.col("row").alias(row))
        .agg(F.array_sort(F.collect_list(F.struct("piece", "part"))).alias(clean))
        .withColumn(clean, F.array_join(F.col(f"{clean}.part"), ""))
    )
    out = [F.coalesce(F.col(clean), F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return rows.join(whole, row, "left").select(*out)
