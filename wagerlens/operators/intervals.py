"""Pairs of rows of one key that follow each other within a time limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.operators.skew import salted_pair_join


def followed_within(
    first: DataFrame,
    second: DataFrame,
    key: str,
    first_ts: str,
    second_ts: str,
    first_id: str,
    second_id: str,
    minutes: int = 60,
    min_rows: int | None = None,
) -> DataFrame:
    """All pairs with first_ts < second_ts < first_ts + minutes.

    Time is cut into buckets as long as the limit. A second row can only follow first rows of its
    own bucket or the one before, so it is copied to those two and each pair meets once. Rows of
    a busy key thus spread over its buckets, and the rows compared are about twice the rows kept.
    """
    width = minutes * 60
    bucket_of = lambda c: F.floor(F.unix_seconds(c) / F.lit(width))
    left = first.withColumn("_bucket", bucket_of(first_ts))
    right = second.withColumn(
        "_bucket",
        F.explode(F.array(bucket_of(second_ts), bucket_of(second_ts) - 1)),
    )
    in_time = (F.col(second_ts) > F.col(first_ts)) & (
        F.col(second_ts) < F.col(first_ts) + F.make_dt_interval(mins=F.lit(minutes))
    )
    return salted_pair_join(
        left, right, [key, "_bucket"], [key], in_time, [first_id], [second_id], min_rows
    ).drop("_bucket")
