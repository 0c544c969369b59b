"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str], stamp: str = "_ingested_at"
) -> DataFrame:
    """Row number per key, newest stamp first; equal stamps are settled by the other columns."""
    order = [F.col(c).desc_nulls_last() for c in (stamp, *tie_break)]
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def latest(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str], stamp: str = "_ingested_at"
) -> DataFrame:
    # `rn = 1` lets Spark cut each key to one row per task before the shuffle.
    return numbered(df, keys, tie_break, stamp).filter("rn = 1").drop("rn")


def by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows shuffled by key, for latest() of rows that rarely share one.

    The cut per task sorts all rows of a task to drop next to none of them, whatever the size of an input
    split, and the rows are sorted again after the shuffle. Of rows that come shuffled by key Spark
    sorts each partition once, whose size adaptive execution chooses. All rows of a key, or without
    one, meet in one task: leave rows with many copies of a key to the cut.
    """
    return df.repartition(*keys)
