"""Live forms of batch results, with state bounded by watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wagerlens.operators.dedup import latest
from wagerlens.plans.fraud import RAPID_MINUTES
from wagerlens.sources.tables import buckets_of, delete, merge_table, read_table, state


def first_per_key(stream: DataFrame, key: str, event_ts: str, delay: str = "1 day") -> DataFrame:
    """One row per key among rows less than `delay` apart. Keeps the first row that arrives,
    where the batch model keeps the latest delivery."""
    return stream.withWatermark(event_ts, delay).dropDuplicatesWithinWatermark([key])


def latest_per_key(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], event_ts: str, delay: str = "1 day"
) -> DataFrame:
    """The newest row of each key and day of event time, given out again whenever a newer one arrives.

    For update mode and store_latest(), which settles a key whose event time moved to another day. Newest
    is the largest in the columns of `order`, compared one after the other, NULL being the smallest, as in
    operators.dedup. Rows are cut to one per key and day in every task before the shuffle, so a
    busy key costs little, and state holds one row of each, until the watermark is past the day. Rows
    that are later than that, and rows without an event time, are left out.
    """
    rest = [c for c in stream.columns if c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    return (
        stream.withWatermark(event_ts, delay)
        .groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.window(event_ts, "1 day"))
        .agg(newest)
        .select(*[F.col(f"newest.{c}").alias(c) for c in stream.columns])
    )


def store_latest(
    changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Merge what latest_per_key() gives out into a keyed stored table; returns the running query.

    Stored rows of the same keys compete once more, so that a batch that is run again, or a key whose
    state is gone already, never puts an older row over a newer one. Read and written are the buckets
    of the batch's keys. As in every merge, a row without a key matches none that is stored. A batch is
    written to a folder beside the checkpoint first: a merge reads it several times, and each would
    count it anew.
    """

    def merge(changed: DataFrame, batch_id: int) -> None:
        session = changed.sparkSession
        folder = f"{checkpoint.rstrip('/')}-run/batch={batch_id}"
        changed.write.mode("overwrite").parquet(folder)
        batch = session.read.schema(changed.schema).parquet(folder)
        if batch.isEmpty():
            delete(session, folder)
            return
        old = state(session, path)
        if old is not None:
            some = None if old.buckets == 1 else buckets_of(batch, old)
            held = read_table(session, path, buckets=some)
            held = held.join(batch.select(*keys), list(keys), "left_semi").select(batch.columns)
            batch = batch.unionByName(held)
        merge_table(session, path, latest(batch, keys, order[1:], order[0]), keys)
        delete(session, folder)

    return (
        changes.writeStream.foreachBatch(merge)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rapid_cycles(transactions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Withdrawals less than an hour after a deposit, as they happen.

    Rows meet by player and hour: a deposit lies in its own hour, a withdrawal goes to its own and the
    one before, so each pair meets once, and what is kept of a busy player is spread over the hours
    instead of lying in one task. The time condition and the two watermarks together let Spark drop
    rows from its state once no partner can arrive.
    """
    hour = RAPID_MINUTES * 60_000_000

    def side(kind: str, prefix: str, buckets: list[int]) -> DataFrame:
        of_row = F.floor(F.unix_micros(f"{prefix}_time") / hour)
        return (
            transactions.filter(F.col("transaction_type") == kind)
            .select(
                F.col("player_id").alias(f"{prefix}_player"),
                F.col("transaction_id").alias(f"{prefix}_id"),
                F.col("transaction_timestamp").alias(f"{prefix}_time"),
                F.col("amount").alias(f"{prefix}_amount"),
            )
            .withWatermark(f"{prefix}_time", delay)
            .withColumn(f"{prefix}_hour", F.explode(F.array(*[of_row - F.lit(k) for k in buckets])))
        )

    window = F.make_dt_interval(mins=F.lit(RAPID_MINUTES))
    return (
        side("deposit", "deposit", [0])
        .join(
            side("withdraw", "withdraw", [0, 1]),
            (F.col("deposit_player") == F.col("withdraw_player"))
            & (F.col("deposit_hour") == F.col("withdraw_hour"))
            & (F.col("withdraw_time") > F.col("deposit_time"))
            & (F.col("withdraw_time") < F.col("deposit_time") + window),
        )
        .drop("deposit_hour", "withdraw_hour")
    )


def ip_sharing_per_hour(sessions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Logins and distinct players per address and sliding hour.

    Two counts in a row: logins per address, hour and player, and, once the watermark has closed the
    hour, players and logins per address. The first one is spread over the players of an address and
    holds each once, so the second counts distinct players exactly.
    """
    per_player = (
        sessions.withWatermark("session_timestamp", delay)
        .groupBy("ip", "player_id", F.window("session_timestamp", "1 hour", "10 minutes"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_player.groupBy("ip", "window")
        .agg(F.sum("n").alias("logins"), F.count("player_id").alias("distinct_players"))
        .select(
            "ip",
            F.col("window.start").alias("hour_start"),
            F.col("window.end").alias("hour_end"),
            "logins",
            "distinct_players",
        )
    )
