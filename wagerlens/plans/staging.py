"""Staging models: bronze columns cleaned, renamed and typed. Lazy, one per bronze table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.text import lower_trimmed, trimmed, upper_trimmed
from wagerlens.functions.times import stamp


def stg_players(raw: DataFrame) -> DataFrame:
    return raw.select(
        "player_id",
        lower_trimmed("email").alias("email"),
        trimmed("city").alias("city"),
        F.to_date("created_at").alias("created_at"),
        "_ingested_at",
    )


def stg_sessions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "session_id",
        "player_id",
        trimmed("ip").alias("ip"),
        lower_trimmed("device").alias("device"),
        F.col("timestamp").cast("timestamp").alias("session_timestamp"),
        "_ingested_at",
    )


def stg_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "transaction_id",
        "player_id",
        lower_trimmed("type").alias("transaction_type"),
        F.col("amount").cast("decimal(10,2)").alias("amount"),
        F.col("timestamp").cast("timestamp").alias("transaction_timestamp"),
        "_ingested_at",
    )


def stg_affiliates(raw: DataFrame) -> DataFrame:
    return raw.select(
        "affiliate_id",
        "player_id",
        upper_trimmed("country").alias("country"),
        F.col("clicks").cast("bigint").alias("clicks"),
        F.col("registrations").cast("bigint").alias("registrations"),
        F.col("ftd").cast("bigint").alias("ftd_count"),
        F.col("cpa_value").cast("decimal(10,2)").alias("cpa_value"),
        "_ingested_at",
    )


STAGING = {
    "players": stg_players,
    "sessions": stg_sessions,
    "transactions": stg_transactions,
    "affiliates": stg_affiliates,
}


def register_views(bronze: dict[str, DataFrame], as_of: datetime) -> dict[str, DataFrame]:
    """Staging models as temporary views named stg_<dataset>, stamped with the time of the run."""
    views = {}
    for name, model in STAGING.items():
        views[name] = model(bronze[name]).withColumn("_dbt_processed_at", stamp(as_of))
        views[name].createOrReplaceTempView(f"stg_{name}")
    return views
