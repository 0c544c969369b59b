"""Silver models: one row per key, with derived columns, kept up to date by merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.functions.measures import MONEY, amount_if, percent
from wagerlens.functions.times import stamp
from wagerlens.operators.dedup import by_key, latest
from wagerlens.operators.skew import salted_join
from wagerlens.plans.staging import STAGING
from wagerlens.schemas import SILVER_KEYS, SILVER_SOURCE
from wagerlens.sources.bronze import read_bronze, table_path
from wagerlens.sources.scratch import WorkTables, scratch_dir
from wagerlens.sources.tables import (
    BUCKETS,
    State,
    buckets_of,
    delete,
    merge_table,
    read_added,
    read_table,
    replace_table,
    state,
)

# Columns that settle which of several rows of a key and a stamp is the latest.
TIES = {
    "dim_players": ["email", "city", "created_at"],
    "dim_sessions": ["session_timestamp", "player_id", "ip", "device"],
    "fct_transactions": ["transaction_timestamp", "player_id", "transaction_type", "amount"],
    "dim_affiliates": ["clicks", "registrations", "ftd_count", "cpa_value", "country"],
}


def _latest(rows: DataFrame, name: str) -> DataFrame:
    return latest(rows, SILVER_KEYS[name], TIES[name])


def dim_players(stg: DataFrame) -> DataFrame:
    return _latest(stg, "dim_players")


def dim_sessions(stg: DataFrame) -> DataFrame:
    ts = F.col("session_timestamp")
    return _latest(stg, "dim_sessions").select(
        "session_id",
        "player_id",
        "ip",
        "device",
        "session_timestamp",
        F.to_date(ts).alias("session_date"),
        F.hour(ts).alias("session_hour"),
        F.dayofweek(ts).alias("day_of_week"),  # Sunday is 1
        "_ingested_at",
    )


def fct_transactions(stg: DataFrame) -> DataFrame:
    ts = F.col("transaction_timestamp")
    return _latest(stg, "fct_transactions").select(
        "transaction_id",
        "player_id",
        "transaction_type",
        "amount",
        "transaction_timestamp",
        F.to_date(ts).alias("transaction_date"),
        F.hour(ts).alias("transaction_hour"),
        amount_if("deposit").alias("deposit_amount"),
        amount_if("withdraw").alias("withdraw_amount"),
        amount_if("bet").alias("bet_amount"),
        "_ingested_at",
    )


def dim_affiliates(stg: DataFrame) -> DataFrame:
    return _latest(stg, "dim_affiliates").select(
        "affiliate_id",
        "player_id",
        "country",
        "clicks",
        "registrations",
        "ftd_count",
        "cpa_value",
        percent("registrations", "clicks").alias("conversion_rate"),
        percent("ftd_count", "registrations").alias("ftd_rate"),
        (F.col("ftd_count") * F.col("cpa_value")).cast(MONEY).alias("total_cpa_value"),
        "_ingested_at",
    )


SILVER = {
    "dim_players": dim_players,
    "dim_sessions": dim_sessions,
    "fct_transactions": fct_transactions,
    "dim_affiliates": dim_affiliates,
}


def audited(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.withColumns(
        {"_dbt_processed_at": stamp(as_of), "_silver_updated_at": stamp(as_of)}
    )


def build_all(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every silver model in full, as lazy frames."""
    return {
        name: model(STAGING[SILVER_SOURCE[name]](bronze[SILVER_SOURCE[name]]))
        for name, model in SILVER.items()
    }


def refresh(
    spark: SparkSession,
    name: str,
    bronze_root: str,
    silver_root: str,
    as_of: datetime,
    buckets: int = BUCKETS,
    model=None,
    keep_retired: bool = False,
) -> State:
    """Bring one silver table up to date.

    The first run builds all rows. Later runs take the bronze rows that were added after the bronze
    load this table holds already, whatever stamps they carry, and merge them by key: only that slice
    is sorted, and only the buckets of its keys are read and written. If some of its rows are not newer
    than all of silver (a second delivery under one stamp, an earlier one, a backfill), stored rows
    of the same keys compete with them. `keep_retired` is for tables that others are kept up to date from.
    The rows to merge are worked out once, into a table of their own that is deleted after the merge.
    """
    path, keys = f"{silver_root}/{name}", SILVER_KEYS[name]
    build = model or SILVER[name]
    dataset = SILVER_SOURCE[name]
    source = table_path(bronze_root, dataset)
    # Taken before the rows are read: what is loaded in between is merged again by the next run.
    marks = {dataset: state(spark, source).load}
    old = state(spark, path)
    if old is None:
        raw = read_bronze(spark, bronze_root, dataset)
        rows = audited(build(by_key(STAGING[dataset](raw), keys)), as_of)
        return replace_table(spark, path, rows, keys, buckets=buckets, marks=marks)
    raw = read_added(spark, source, old.marks.get(dataset, 0))
    work_dir = scratch_dir(spark, "refresh")
    work = WorkTables(spark, work_dir)
    try:
        rows = work.keep("rows", audited(build(by_key(STAGING[dataset](raw), keys)), as_of))
        if old.newest and not raw.filter(F.col("_ingested_at") <= stamp(old.newest)).isEmpty():
            some = None if old.buckets == 1 else buckets_of(rows, old)
            held = read_table(spark, path, buckets=some).join(rows.select(*keys), keys, "left_semi")
            both = rows.unionByName(held, allowMissingColumns=True).select(rows.columns)
            rows = work.keep("latest", _latest(by_key(both, keys), name))
        return merge_table(spark, path, rows, keys, marks=marks, keep_retired=keep_retired)
    finally:
        delete(spark, work_dir)


def bridge_player_sessions(sessions: DataFrame, players: DataFrame) -> DataFrame:
    """Each session of a known player with the player's city and sign-up date."""
    # Sessions are unique by their id already.
    pairs = sessions.select("player_id", "session_id", "session_timestamp", "ip", "device")
    attributes = players.select("player_id", "city", F.col("created_at").alias("player_created_at"))
    return salted_join(pairs, attributes, ["player_id"]).withColumn(
        "days_since_signup", F.datediff(F.to_date("session_timestamp"), "player_created_at")
    )
