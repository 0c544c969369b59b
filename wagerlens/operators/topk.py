"""Top rows of a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_with_ties(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Rows whose value is among the k largest, with every row tied with the last of them.

    The k-th value is found with a distributed top-k and used as a filter, so that ties, however
    many, stay where they are instead of meeting in one window.
    """
    kth = (
        df.select(column)
        .filter(F.col(column).isNotNull())
        .orderBy(F.desc(column))
        .limit(k)
        .agg(F.min(column))
    )
    return df.filter(F.col(column) >= kth.scalar())


def top_rows(df: DataFrame, column: str, tie_break: list[str], k: int = 10) -> DataFrame:
    """Exactly k rows, ties settled by further columns."""
    return df.orderBy(F.desc_nulls_last(column), *tie_break).limit(k)
