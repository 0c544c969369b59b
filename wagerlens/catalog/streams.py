"""Streaming forms, run to the end over the given data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from wagerlens.catalog.lake import Lake
from wagerlens.catalog.registry import query
from wagerlens.catalog.sqlparts import money, ts
from wagerlens.plans.silver import TIES
from wagerlens.plans.staging import stg_sessions
from wagerlens.sources.bronze import read_bronze
from wagerlens.sources.files import write_file
from wagerlens.sources.scratch import scratch_dir
from wagerlens.sources.tables import read_table
from wagerlens.streaming import live
from wagerlens.streaming.ingest import ingest_available

RUN = datetime(2024, 3, 1)


def _stream_of(lake: Lake, name: str) -> DataFrame:
    """A stored silver table as a stream."""
    stored = lake.silver(name)
    return lake.spark.readStream.schema(stored.schema).parquet(lake.path(name))


def _drain(lake: Lake, stream: DataFrame) -> DataFrame:
    root = scratch_dir(lake.spark, "stream")
    running = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/out")
    )
    running.awaitTermination()
    return lake.spark.read.schema(stream.schema).parquet(f"{root}/out")


@query(
    "x1_file_stream_ingest",
    f"""SELECT session_id, player_id, ip, device, {ts('"timestamp"')} AS "timestamp",
          {ts("TIMESTAMP '2024-03-01'")} AS _ingested_at FROM raw_sessions""",
)
def _(lake: Lake) -> DataFrame:
    root = scratch_dir(lake.spark, "ingest")
    write_file(lake.raw["sessions"], "sessions", f"{root}/in")
    for _run in range(2):  # the second run finds no new files
        ingest_available(
            lake.spark, "sessions", f"{root}/in", f"{root}/bronze", f"{root}/checkpoint",
            lambda: RUN,
        ).awaitTermination()
    return read_bronze(lake.spark, f"{root}/bronze", "sessions")


@query("x2_stream_dedup", "SELECT session_id, player_id FROM dim_sessions")
def _(lake: Lake) -> DataFrame:
    twice = _stream_of(lake, "dim_sessions")
    unique = live.first_per_key(twice.unionByName(twice), "session_id", "session_timestamp")
    return _drain(lake, unique.select("session_id", "player_id"))


@query(
    "x2_stream_latest",
    f"""SELECT session_id, player_id, ip, device, {ts('session_timestamp')} AS session_timestamp,
          {ts('_ingested_at')} AS _ingested_at FROM dim_sessions""",
)
def _(lake: Lake) -> DataFrame:
    """Sessions kept up to date by a stream: deliveries repeat and correct rows of earlier batches."""
    root = scratch_dir(lake.spark, "latest")
    raw = lake.raw["sessions"]
    raw.repartition(3).write.parquet(f"{root}/in")
    delivered = (
        lake.spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    )
    keys, order = ["session_id"], ["_ingested_at", *TIES["dim_sessions"]]
    changes = live.latest_per_key(
        stg_sessions(delivered), keys, order, "session_timestamp", "60 days"
    )
    live.store_latest(changes, f"{root}/out", keys, order, f"{root}/checkpoint").awaitTermination()
    return read_table(lake.spark, f"{root}/out")


@query(
    "x3_stream_rapid_cycles",
    f"""SELECT player_id AS deposit_player, player_id AS withdraw_player, deposit_id, withdraw_id,
          {ts('deposit_time')} AS deposit_time, {ts('withdraw_time')} AS withdraw_time,
          {money('deposit_amount')} AS deposit_amount,
          {money('withdraw_amount')} AS withdraw_amount FROM rapid_pairs""",
)
def _(lake: Lake) -> DataFrame:
    return _drain(lake, live.rapid_cycles(_stream_of(lake, "fct_transactions")))


@query(
    "x4_stream_ip_per_hour",
    f"""SELECT ip, {ts('start')} AS hour_start,
          {ts('start + INTERVAL 1 HOUR')} AS hour_end, count(*) AS logins,
          count(DISTINCT player_id) AS distinct_players
        FROM (SELECT ip, player_id, session_timestamp, time_bucket(INTERVAL 10 MINUTE, session_timestamp)
                - INTERVAL 10 MINUTE * k AS start
              FROM dim_sessions, (VALUES (0), (1), (2), (3), (4), (5)) AS s(k))
        WHERE start + INTERVAL 1 HOUR
          <= (SELECT max(session_timestamp) FROM dim_sessions) - INTERVAL 10 MINUTE
        GROUP BY ip, start""",
)
def _(lake: Lake) -> DataFrame:
    """Windows that the watermark has closed."""
    counted = live.ip_sharing_per_hour(_stream_of(lake, "dim_sessions"))
    return _drain(lake, counted)
