"""Lines that a site repeats on many of its pages, found by their frequency within the site.

A line counts once per page, without blanks at its ends; empty lines never count. A line is
boilerplate on a host when the share of the host's pages that hold it exceeds `max_ratio` and at
least `min_pages` pages hold it (on a host of one page every line would be on all pages). Lines
are counted by their MD5 digest. Everything runs in the JVM.

The count shuffles (host, digest, count), summed per task first, so a host with a third of all
pages sends no more than its distinct lines. A host with up to `max_list` boilerplate lines has them
in one array that is broadcast to its pages, which are not shuffled. The pages of hosts with more
lines (of all hosts with any, where the arrays would hold over `max_broadcast` lines) are stored
with row numbers, cut into lines, rid of those of (host, digest) by a salted join and put together
again by row and position, so no host's lines have to fit in one row or be searched one by one.

Nulls, empty texts: a null text stays null and counts as a page without lines. Pages without a host
form a host of their own. Repeated rows are pages of their own. An empty table gives an empty
result.
Columns and their order are kept; working columns take names that are free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import bounded_side, fresh, store
from wagerlens.operators.skew import salted_join

MAX_RATIO = 0.05
MIN_PAGES = 5
MAX_BROADCAST_LINES = 500_000
MAX_LIST = 1000
BLANKS = " \t\r"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def digest(line: Column) -> Column:
    """Digest of a line without blanks at its ends; null for an empty one.

    Kept as text: Spark finds distinct texts of an array by hashing, but compares every two binaries.
    """
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(bare != "", F.md5(bare))


def site_lines(
    pages: DataFrame, text: str, host: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """host (empty text for none), digest, n_pages, host_pages of each boilerplate line."""
    site = F.coalesce(F.col(host).cast("string"), F.lit(""))
    nameless = F.col(host).isNull()
    digests = F.array_distinct(F.transform(lines_of(F.col(text)), digest))
    per_line = (
        pages.select(
            site.alias("host"), nameless.alias("nameless"), F.explode(digests).alias("digest")
        )
        .filter(F.col("digest").isNotNull())
        .groupBy("host", "nameless", "digest")
        .agg(F.count(F.lit(1)).alias("n_pages"))
        .filter(F.col("n_pages") >= min_pages)
    )
    per_host = pages.groupBy(site.alias("host"), nameless.alias("nameless")).agg(
        F.count(F.lit(1)).alias("host_pages")
    )
    return per_line.join(per_host, ["host", "nameless"]).filter(
        F.col("n_pages") / F.col("host_pages") > F.lit(max_ratio)
    )


def drop_site_lines(
    pages: DataFrame,
    text: str = "text",
    host: str = "source",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    max_broadcast: int = MAX_BROADCAST_LINES,
    dropped: str | None = None,
    max_list: int = MAX_LIST,
) -> DataFrame:
    """The pages without the boilerplate lines of their host; `dropped` names a count of them."""
    at, nameless, bad = fresh([*pages.columns, dropped or ""], "site", "nameless", "boilerplate")
    found = store(site_lines(pages, text, host, max_ratio, min_pages), "site-lines").select(
        F.col("host").alias(at), F.col("nameless").alias(nameless), "digest"
    )
    sizes = store(found.groupBy(at, nameless).agg(F.count(F.lit(1)).alias("n")), "site-sizes")
    listed = sizes.filter(F.col("n") <= max_list)
    if (listed.agg(F.sum("n")).first()[0] or 0) > max_broadcast:
        max_list, listed = 0, sizes.limit(0)
    many = sizes.filter(F.col("n") > max_list).select(at, nameless)
    n_many = many.count()
    keyed = pages.withColumns(
        {at: F.coalesce(F.col(host).cast("string"), F.lit("")), nameless: F.col(host).isNull()}
    )
    if not n_many:
        return _without_listed(keyed, found, text, pages.columns, (at, nameless, bad), dropped)
    side = bounded_side(many, n_many, MAX_BROADCAST_LINES)
    few = _without_listed(
        keyed.join(side, [at, nameless], "left_anti"),
        found.join(listed.select(at, nameless), [at, nameless], "left_semi"),
        text, pages.columns, (at, nameless, bad), dropped,
    )
    rest = keyed.join(side, [at, nameless], "left_semi")
    return few.unionByName(
        _without_joined(rest, found, text, pages.columns, (at, nameless), dropped)
    )


def _without_joined(
    keyed: DataFrame,
    found: DataFrame,
    text: str,
    columns: list[str],
    keys: tuple[str, str],
    dropped: str | None,
) -> DataFrame:
    """Pages cut into lines, joined with the boilerplate by digest, and put together again."""
    row, n, clean = fresh([*keyed.columns, dropped or ""], "row", "n_kept", "clean")
    # Stored, as both sides of the last join need the same numbers.
    rows = store(keyed.withColumn(row, F.monotonically_increasing_id()), "line-pages")
    each = rows.select(
        F.col(row).alias("page"), *keys, F.posexplode(lines_of(F.col(text))).alias("at", "line")
    )
    # Empty lines match nothing and get keys of their own, longer than any digest.
    alone = F.concat(F.lit("an empty line, "), F.concat_ws(",", "page", "at"))
    each = each.withColumn("digest", F.coalesce(digest(F.col("line")), alone))
    marked = salted_join(each, found.withColumn("bad", F.lit(True)), [*keys, "digest"], "left")
    whole = (
        marked.filter(F.col("bad").isNull())
        .groupBy(F.col("page").alias(row))
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "line"))).alias(clean),
            F.count(F.lit(1)).alias(n),
        )
        .withColumn(clean, F.array_join(F.col(f"{clean}.line"), "\n"))
    )
    joined = rows.join(whole, row, "left")
    left = F.when(F.col(text).isNotNull(), F.coalesce(F.col(clean), F.lit("")))
    out = [left.alias(c) if c == text else F.col(f"`{c}`") for c in columns]
    if dropped:
        count = F.size(lines_of(F.col(text))) - F.coalesce(F.col(n), F.lit(0)).cast("int")
        out.append(F.when(F.col(text).isNull(), F.lit(0)).otherwise(count).alias(dropped))
    return joined.select(*out)


def _without_listed(
    keyed: DataFrame,
    found: DataFrame,
    text: str,
    columns: list[str],
    names: tuple[str, str, str],
    dropped: str | None,
) -> DataFrame:
    """Pages filtered by the short list of their host."""
    at, nameless, bad = names
    per_host = found.groupBy(at, nameless).agg(F.collect_list("digest").alias(bad))
    joined = keyed.join(F.broadcast(per_host), [at, nameless], "left")
    # A list of its own per page for the test below; null where the host has no such lines.
    kept = F.filter(
        lines_of(F.col(text)),
        lambda line: ~F.coalesce(F.array_contains(F.col(bad), digest(line)), F.lit(False)),
    )
    clean = F.when(F.col(bad).isNull() | F.col(text).isNull(), F.col(text)).otherwise(
        F.array_join(kept, "\n")
    )
    out = [clean.alias(c) if c == text else F.col(f"`{c}`") for c in columns]
    if dropped:
        count = F.size(lines_of(F.col(text))) - F.size(kept)
        none = F.col(bad).isNull() | F.col(text).isNull()
        out.append(F.when(none, F.lit(0)).otherwise(count).alias(dropped))
    return joined.select(*out)


def check_sql(max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> str:
    """The same rows in SQL, from whole lines instead of digests."""
    bare = "trim(line, ' ' || chr(9) || chr(13))"
    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, source, text FROM documents
    ), l AS (
      SELECT r, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d WHERE text IS NOT NULL
    ), b AS (
      SELECT r, source, i, line, {bare} AS bare FROM l
    ), c AS (
      SELECT source, bare, count(DISTINCT r) AS n_pages FROM b WHERE bare <> '' GROUP BY ALL
    ), h AS (
      SELECT source, count(*) AS host_pages FROM d GROUP BY source
    ), bad AS (
      SELECT c.source, c.bare FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source
      WHERE n_pages >= {min_pages} AND n_pages / host_pages > {max_ratio}
    ), k AS (
      SELECT b.r, string_agg(line, chr(10) ORDER BY i) FILTER (bad.bare IS NULL) AS text,
             count(bad.bare) AS n_dropped
      FROM b LEFT JOIN bad ON b.bare = bad.bare AND b.source IS NOT DISTINCT FROM bad.source
      GROUP BY b.r
    )
    SELECT d.doc_id, d.source,
           CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
           coalesce(n_dropped, 0) AS n_dropped
    FROM d LEFT JOIN k USING (r)
    """
