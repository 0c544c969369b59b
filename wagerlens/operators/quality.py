"""Data-quality checks: failing rows, metric rows and row marks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.functions.times import stamp
from wagerlens.schemas import TRANSACTION_TYPES, struct

# Alert limits.
MIN_VOLUME = 0.90
MIN_VALID = 0.95

METRIC_SCHEMA = "check string, value double, limit double, status string"


# --- failing values ---


def _failing(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n_records")
    )


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows. NULL is not checked."""
    return _failing(df.filter(F.col(column).isNotNull()), column).filter("n_records > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their number of rows. NULL is not checked."""
    return _failing(df.filter(~F.col(column).isin(*values)), column)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent, with their number of rows. NULL is not checked.

    Both sides are cut to distinct values before the join, so no value is heavy in it.
    """
    values = _failing(child.filter(F.col(column).isNotNull()), column)
    known = parent.select(F.col(parent_column).cast("string").alias("value")).distinct()
    return values.join(known, "value", "left_anti")


# --- one pass over a table ---


def table_profile(
    df: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Row count, NULL counts and illegal values of one table in a single aggregate.

    Rows: (test, column, failures); the row count has test `row_count`.
    """
    checks = [("row_count", None, F.lit(True))]
    checks += [("not_null", c, F.col(c).isNull()) for c in not_null]
    checks += [
        ("accepted_values", c, ~F.col(c).isin(*values)) for c, values in (accepted or {}).items()
    ]
    counted = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(test).alias("test"),
                F.lit(column).cast("string").alias("column"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, (test, column, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


# --- metrics ---


def _metric(df: DataFrame, check: str, value: Column, limit: Column, ok: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        value.cast("double").alias("value"),
        limit.cast("double").alias("limit"),
        F.when(ok, "OK").otherwise("ALERT").alias("status"),
    )


def load_count(source: DataFrame, loaded: DataFrame, dataset: str) -> DataFrame:
    """Rows loaded against rows delivered."""
    n_source = source.agg(F.count(F.lit(1))).scalar()
    counted = loaded.agg(F.count(F.lit(1)).alias("n")).withColumn("expected", n_source)
    return _metric(
        counted,
        f"row_count:{dataset}",
        F.col("n"),
        F.col("expected"),
        F.col("n") == F.col("expected"),
    )


def counted_load(delivered: DataFrame, loaded: int, dataset: str) -> DataFrame:
    """load_count() where the number of rows loaded is known, and `delivered` has that of rows delivered,
    `n`, in its one row."""
    counted = delivered.select(F.col("n").alias("expected"), F.lit(loaded).alias("n"))
    return _metric(
        counted,
        f"row_count:{dataset}",
        F.col("n"),
        F.col("expected"),
        F.col("n") == F.col("expected"),
    )


def volume_alert(loaded: DataFrame, expected: int, dataset: str) -> DataFrame:
    """Alert below 90 % of the expected rows."""
    return counted_volume(loaded.agg(F.count(F.lit(1)).alias("n")), expected, dataset)


def counted_volume(loaded: DataFrame, expected: int, dataset: str) -> DataFrame:
    """volume_alert() where `loaded` has the number of rows, `n`, in its one row."""
    share = F.try_divide(F.col("n").cast("double"), F.lit(expected).cast("double"))
    counted = loaded.select(share.alias("share"))
    ok = F.coalesce(F.col("share") >= MIN_VOLUME, F.lit(False))
    return _metric(counted, f"volume:{dataset}", F.col("share"), F.lit(MIN_VOLUME), ok)


def schema_changes(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns added, missing or of another type."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name in [*wanted, *(n for n in found if n not in wanted)]:
        if name not in found:
            rows.append((name, "missing", wanted[name], None))
        elif name not in wanted:
            rows.append((name, "added", None, found[name]))
        elif found[name] != wanted[name]:
            rows.append((name, "type", wanted[name], found[name]))
    schema = "column string, change string, expected string, found string"
    return df.sparkSession.createDataFrame(rows, schema)


def valid_share(marked: DataFrame) -> DataFrame:
    """Share of rows without violations; alert below 95 %. An empty table has none to alert on."""
    share = F.avg((F.size("violations") == 0).cast("double"))
    ok = F.coalesce(F.col("share") >= MIN_VALID, F.lit(True))
    return _metric(
        marked.agg(share.alias("share")), "valid_rows", F.col("share"), F.lit(MIN_VALID), ok
    )


def freshness(
    df: DataFrame, event_ts: str, as_of: datetime, limit_hours: float = 24.0
) -> DataFrame:
    """Hours from the newest event to the time of the run."""
    newest = df.agg(F.max(event_ts).alias("newest"))
    lag = (
        F.unix_seconds(stamp(as_of)) - F.unix_seconds(F.col("newest"))
    ) / F.lit(3600.0)
    ok = F.coalesce(lag <= limit_hours, F.lit(False))
    return _metric(newest, f"freshness_hours:{event_ts}", lag, F.lit(limit_hours), ok)


def signal_counts(signals: DataFrame) -> DataFrame:
    return signals.groupBy("signal_type").agg(F.count(F.lit(1)).alias("signals"))


def signal_metrics(signals: DataFrame) -> DataFrame:
    """signal_counts() as metrics; they have no limit."""
    return signal_counts(signals).select(
        F.concat(F.lit("signals:"), F.col("signal_type")).alias("check"),
        F.col("signals").cast("double").alias("value"),
        F.lit(None).cast("double").alias("limit"),
        F.lit("OK").alias("status"),
    )


def runtime_alert(
    spark: SparkSession, entries: Sequence[tuple], limit_seconds: float
) -> DataFrame:
    """Seconds of each stage of a run; alert above the limit."""
    log = spark.createDataFrame(list(entries), RUN_LOG_SCHEMA)
    total = log.groupBy("stage").agg(F.sum("seconds").alias("seconds"))
    ok = F.when(F.col("seconds") <= limit_seconds, "OK").otherwise("ALERT")
    return total.select(
        F.concat(F.lit("seconds:"), F.col("stage")).alias("check"),
        F.col("seconds").alias("value"),
        F.lit(limit_seconds).alias("limit"),
        ok.alias("status"),
    )


# --- row marks ---


def transaction_rules(as_of: datetime) -> dict[str, Column]:
    """Business rules of a transaction; which rules apply is our own choice."""
    return {
        "amount_missing": F.col("amount").isNull(),
        "amount_negative": F.col("amount") < 0,
        "type_unknown": ~F.col("transaction_type").isin(*TRANSACTION_TYPES),
        "timestamp_in_future": F.col("transaction_timestamp") > stamp(as_of),
    }


def mark_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows with the names of the rules they break."""
    marks = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*marks)))


# --- run log ---

RUN_LOG_SCHEMA = struct(
    "run_at timestamp, stage string, dataset string, rows_out bigint, seconds double, error string"
)


def append_run_log(spark: SparkSession, path: str, entries: Sequence[tuple]) -> None:
    """One row per stage of a run."""
    log = spark.createDataFrame(list(entries), RUN_LOG_SCHEMA)
    log.coalesce(1).write.mode("append").parquet(path)
