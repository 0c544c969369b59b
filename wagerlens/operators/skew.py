"""Joins that stay balanced when one key holds a large share of the rows.

A key is heavy when it holds more than 1/SHARES of all rows. Fewer than SHARES keys can do so,
whatever the data, which bounds the list of heavy keys that is broadcast. Only heavy keys are
salted; every other key takes the plain shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARES = 4096
MIN_ROWS = 100_000


def heavy_keys(
    weights: DataFrame,
    keys: Sequence[str],
    weight: str,
    total: DataFrame | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Keys above their share, with the number of slices each is cut into.

    `weights` has one row per key. Fewer than SHARES rows come out, and their slices sum to less
    than twice that. `total` is the one-row sum to take shares of, if not that of `weights`.
    """
    total = weights.agg(F.sum(weight)) if total is None else total
    limit = F.greatest(
        F.lit(float(MIN_ROWS if min_rows is None else min_rows)),
        F.coalesce(total.scalar().cast("double"), F.lit(0.0)) / SHARES
    )
    return (
        weights.dropna(subset=list(keys))
        .select(*keys, F.col(weight).cast("double").alias("_weight"), limit.alias("_limit"))
        .filter(F.col("_weight") > F.col("_limit"))
        .select(*keys, F.ceil(F.col("_weight") / F.col("_limit")).cast("int").alias("_slices"))
    )


def row_weights(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; partial counts are merged before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def heavy_row_keys(
    df: DataFrame, keys: Sequence[str], coarse: Sequence[str], min_rows: int | None = None
) -> DataFrame:
    """heavy_keys() of a frame with many distinct keys.

    A key can only be heavy if its coarse part is, so the rows are counted by the coarse part,
    which has few values, and by the full key only where that is heavy.
    """
    per_coarse = row_weights(df, coarse)
    total = per_coarse.agg(F.sum("_rows"))
    suspects = F.broadcast(heavy_keys(per_coarse, coarse, "_rows", min_rows=min_rows))
    rows = df.select(*keys).join(suspects.select(*coarse), list(coarse), "left_semi")
    return heavy_keys(row_weights(rows, keys), keys, "_rows", total, min_rows)


def _slice_of(spread: Sequence[str], slices: Column) -> Column:
    # Not a random number: a task that is run again must pick the same slices. The partition id
    # spreads rows that are exact copies of each other.
    return F.pmod(
        F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in spread]), slices
    ).cast("int")


def _copies(slices: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), slices - 1))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    weights: tuple[DataFrame, str] | None = None,
    spread: Sequence[str] | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Join many left rows to at most one right row per key.

    Left rows of a heavy key are spread over slices by a hash of `spread`, and the right row is
    copied once per slice. `weights` gives the rows per key where the caller knows them already.
    Left rows with a NULL key match nothing and are spread too.

    Without `weights` the rows per key would have to be counted by a pass of their own. Adaptive
    execution knows the sizes once the left side is shuffled, cuts the partition of a hot key into
    slices and reads the right one for each, so the plain join is left to it, and either side is
    read once. `min_rows` asks for salting all the same, where adaptive execution is off.
    """
    if weights is None and min_rows is None:
        return left.join(right, list(keys), how)
    spread = list(spread or left.columns)
    per_key, weight = weights or (row_weights(left, keys), "_rows")
    heavy = F.broadcast(heavy_keys(per_key, keys, weight, min_rows=min_rows))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    sliced = F.when(no_key, F.lit(SHARES)).otherwise(F.coalesce("_slices", F.lit(1)))
    left_s = left.join(heavy, list(keys), "left").withColumn("_slice", _slice_of(spread, sliced))
    right_s = right.join(heavy, list(keys), "left").withColumn(
        "_slice", _copies(F.coalesce("_slices", F.lit(1)))
    )
    return left_s.drop("_slices").join(
        right_s.drop("_slices"), [*keys, "_slice"], how
    ).drop("_slice")


def salted_pair_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    coarse: Sequence[str],
    condition: Column,
    left_spread: Sequence[str],
    right_spread: Sequence[str],
    min_rows: int | None = None,
) -> DataFrame:
    """Inner join with many rows per key on both sides.

    A heavy key becomes a grid: each side is cut into its own slices and copied along the other
    side's slices, so every pair meets in exactly one cell. `coarse` names the keys with fewer
    values. Columns other than the keys must have different names on the two sides.

    Counting rows per key reads both sides twice more. Unless `min_rows` asks for it, the grid is
    left to adaptive execution, which cuts the partitions of hot keys on both sides.
    """
    keys = list(keys)
    if min_rows is None:
        # Shuffled even if one side is small, see below.
        return left.hint("merge").join(right, keys).filter(condition)
    left_heavy = heavy_row_keys(left, keys, coarse, min_rows)
    right_heavy = heavy_row_keys(right, keys, coarse, min_rows)
    grid = F.broadcast(
        left_heavy.withColumnRenamed("_slices", "_left_n").join(
            right_heavy.withColumnRenamed("_slices", "_right_n"), keys, "full"
        )
    )
    left_n, right_n = (F.coalesce(c, F.lit(1)) for c in ("_left_n", "_right_n"))
    left_s = (
        left.join(grid, keys, "left")
        .withColumn("_row", _slice_of(left_spread, left_n))
        .withColumn("_cell", _copies(right_n))
        .drop("_left_n", "_right_n")
    )
    right_s = (
        right.join(grid, keys, "left")
        .withColumn("_cell", _slice_of(right_spread, right_n))
        .withColumn("_row", _copies(left_n))
        .drop("_left_n", "_right_n")
    )
    # Both sides are shuffled even if one is small: the output can be far larger than the input,
    # and must not be left to the few tasks that scan it.
    return (
        left_s.hint("merge")
        .join(right_s, [*keys, "_row", "_cell"])
        .filter(condition)
        .drop("_row", "_cell")
    )
