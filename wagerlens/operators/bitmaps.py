"""Exact distinct counts that add up, as bitmaps over dense numbers.

The distinct values of a column over a month can't be told from those of its days, but the sets
can: a set is kept as words of 64 numbers each, sets of parts are or-ed, and their bits
counted. So one stored table of sets by day and a few dimensions answers any period and any
selection of them exactly. A word is a long: a set of few values among many numbers takes no more rows
than it has values, and words are or-ed in hash aggregates, in place and without a sort.

Nulls: a null value is in no set; null dimensions are values of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBER_BUCKETS = 256
# Numbers in a word are told by their last bits, words by the others.
WORD_BITS = 6


def dense_numbers(values: DataFrame, key: str, start: int = 1, name: str = "number") -> DataFrame:
    """Each distinct value of a column with a number from `start` on, without gaps.

    Numbered within hash buckets, whose sizes are all that goes to the driver.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(NUMBER_BUCKETS)).cast("int")
    distinct = values.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_bucket", bucket)
    sizes = dict(distinct.groupBy("_bucket").count().collect())
    starts, at = [], start
    for b in range(NUMBER_BUCKETS):
        starts.append(F.lit(at).cast("long"))
        at += sizes.get(b, 0)
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    first = F.element_at(F.array(*starts), F.col("_bucket") + 1)
    return distinct.select(key, (first + place - 1).alias(name))


def distinct_sets(rows: DataFrame, by: Sequence[str | Column], number: str = "number") -> DataFrame:
    """`by`, part, bits: the set of numbers of each group; groups without a number are left out."""
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.col(number).bitwiseAND(2**WORD_BITS - 1).cast("int")
    )
    return (
        rows.filter(F.col(number).isNotNull())
        .groupBy(*by, F.shiftright(number, WORD_BITS).alias("part"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def merged_sets(*sets: DataFrame) -> DataFrame:
    """Sets of several parts of the rows, such as loads, as one table."""
    both = sets[0]
    for more in sets[1:]:
        both = both.unionByName(more)
    by = [c for c in both.columns if c != "bits"]
    return both.groupBy(*by).agg(F.bit_or("bits").alias("bits"))


def distinct_counts(sets: DataFrame, by: Sequence[str | Column], name: str = "n") -> DataFrame:
    """How many values the sets of each group hold together."""
    whole = sets.groupBy(*by, "part").agg(F.bit_count(F.bit_or("bits")).alias("_n"))
    names = [c for c in whole.columns if c not in ("part", "_n")]
    return whole.groupBy(*names).agg(F.sum("_n").alias(name))
