"""The column tests each layer declares, and their run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.operators.quality import (
    duplicates,
    orphans,
    table_profile,
)
from wagerlens.schemas import DEVICES, RISK_CLASSES, RISK_LEVELS, SIGNAL_TYPES, TRANSACTION_TYPES

# Table -> columns.
UNIQUE = {
    "raw_players": ["player_id"],
    "raw_sessions": ["session_id"],
    "raw_transactions": ["transaction_id"],
    "stg_players": ["player_id"],
    "stg_sessions": ["session_id"],
    "stg_transactions": ["transaction_id"],
    "dim_players": ["player_id"],
    "dim_sessions": ["session_id"],
    "fct_transactions": ["transaction_id"],
    "fct_fraud_signals": ["fraud_signal_id"],
    "fct_affiliate_performance": ["affiliate_performance_id"],
    "fct_financial_summary": ["player_id"],
}

_AFFILIATE_COLUMNS = [
    "affiliate_id", "player_id", "clicks", "registrations", "ftd_count", "cpa_value",
]

NOT_NULL = {
    "raw_players": ["player_id", "email"],
    "raw_sessions": ["session_id", "player_id"],
    "raw_transactions": ["transaction_id", "player_id"],
    "stg_players": ["player_id", "email", "created_at"],
    "stg_sessions": ["session_id", "player_id", "session_timestamp"],
    "stg_transactions": ["transaction_id", "player_id", "amount", "transaction_timestamp"],
    "stg_affiliates": _AFFILIATE_COLUMNS,
    "dim_players": ["player_id", "email", "created_at"],
    "dim_sessions": ["session_id", "player_id", "session_timestamp"],
    "fct_transactions": ["transaction_id", "player_id", "amount"],
    "dim_affiliates": _AFFILIATE_COLUMNS,
    "fct_fraud_signals": ["fraud_signal_id", "player_id", "detected_at"],
    "fct_affiliate_performance": [
        "affiliate_performance_id", "affiliate_id", "total_players", "total_ftd",
        "total_cpa_revenue",
    ],
    "fct_financial_summary": ["player_id", "total_deposits", "total_bets"],
}

# table -> {column: (parent table, parent column)}
RELATIONSHIPS = {
    "stg_sessions": {"player_id": ("stg_players", "player_id")},
    "stg_transactions": {"player_id": ("stg_players", "player_id")},
    "stg_affiliates": {"player_id": ("stg_players", "player_id")},
    "dim_sessions": {"player_id": ("dim_players", "player_id")},
    "fct_transactions": {"player_id": ("dim_players", "player_id")},
    "dim_affiliates": {"player_id": ("dim_players", "player_id")},
    "fct_fraud_signals": {"player_id": ("dim_players", "player_id")},
}

ACCEPTED = {
    "stg_transactions": {"transaction_type": TRANSACTION_TYPES},
    "dim_sessions": {"device": DEVICES},
    "fct_transactions": {"transaction_type": TRANSACTION_TYPES},
    "fct_fraud_signals": {"signal_type": SIGNAL_TYPES, "risk_level": RISK_LEVELS},
    "fct_financial_summary": {"risk_classification": RISK_CLASSES},
}


def _counted(failing: DataFrame, test: str, column: str) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(test).alias("test"), F.lit(column).alias("column"), "failures"
    )


def run_tests(frames: dict[str, DataFrame]) -> DataFrame:
    """Results of every declared test on the given tables: (table, test, column, failures, status).

    Row-level tests of a table share one pass. Failures of unique and relationships count values,
    those of the others count rows. Failing tests warn; they stop nothing.
    """
    parts = []
    for table, df in frames.items():
        found = [table_profile(df, NOT_NULL.get(table, []), ACCEPTED.get(table))]
        found += [_counted(duplicates(df, c), "unique", c) for c in UNIQUE.get(table, [])]
        found += [
            _counted(orphans(df, c, frames[parent], parent_column), "relationships", c)
            for c, (parent, parent_column) in RELATIONSHIPS.get(table, {}).items()
            if parent in frames
        ]
        parts += [f.select(F.lit(table).alias("table"), "test", "column", "failures") for f in found]
    results = reduce(DataFrame.unionByName, parts).filter("test <> 'row_count'")
    return results.withColumn("status", F.when(F.col("failures") > 0, "warn").otherwise("pass"))


def failing_values(
    table: str, frames: dict[str, DataFrame], names: Sequence[str] | None = None
) -> DataFrame | None:
    """test, column, value, n_records of all failures of one table; None if it declares no test.

    The table is read once: each row gives the (test, column, value) it could fail by, which are counted
    before they are shuffled. Values that occur once are dropped from the unique tests, values that
    have a parent from the relationships, by one join for all of them. `names` picks tests.
    """
    rows = []

    def add(test: str, column: str, may_fail: Column) -> None:
        if names is None or f"{table}.{test}.{column}" in names:
            value = F.col(column).cast("string").alias("value")
            rows.append(
                F.when(may_fail, F.struct(F.lit(test).alias("test"), F.lit(column).alias("column"), value))
            )

    for c in UNIQUE.get(table, []):
        add("unique", c, F.col(c).isNotNull())
    for c in NOT_NULL.get(table, []):
        add("not_null", c, F.col(c).isNull())
    for c, values in ACCEPTED.get(table, {}).items():
        add("accepted_values", c, ~F.col(c).isin(*values))
    parents = {}
    for c, (parent, parent_column) in RELATIONSHIPS.get(table, {}).items():
        if parent in frames:
            parents[c] = frames[parent].select(F.col(parent_column).cast("string").alias("value"))
            add("relationships", c, F.col(c).isNotNull())
    if not rows:
        return None
    found = (
        frames[table]
        .select(F.explode(F.array_compact(F.array(*rows))).alias("f"))
        .groupBy("f.test", "f.column", "f.value")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter((F.col("test") != "unique") | (F.col("n_records") > 1))
    )
    if not parents:
        return found
    known = reduce(
        DataFrame.unionByName,
        [
            p.distinct().select(F.lit("relationships").alias("test"), F.lit(c).alias("column"), "value")
            for c, p in parents.items()
        ],
    )
    return found.join(known, ["test", "column", "value"], "left_anti")


def store_failures(frames: dict[str, DataFrame], path: str, names: list[str] | None = None) -> None:
    """Write the failing values of the tests, in one job per table, to folders by table, test and
    column; see read_failures(). `names` picks tests, such as `raw_players.unique.player_id`."""
    for table in frames:
        found = failing_values(table, frames, names)
        if found is not None:
            out = found.write.mode("overwrite").partitionBy("test", "column")
            out.parquet(f"{path}/table={table}")


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """table, test, column, value, n_records of what store_failures() wrote."""
    schema = "value string, n_records long, table string, test string, column string"
    found = spark.read.schema(schema).parquet(path)
    return found.select("table", "test", "column", "value", "n_records")
