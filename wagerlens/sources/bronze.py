"""Bronze tables and the loads that fill them."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.functions.times import moment_of, stamp
from wagerlens.operators.skew import salted_join
from wagerlens.schemas import BRONZE, BRONZE_TABLES
from wagerlens.sources.tables import (
    BUCKETS,
    STAMP,
    append_table,
    buckets_of,
    create_table,
    merge_table,
    read_table,
    replace_table,
    state,
)

# Rows at or before this moment never pass the mark of an empty table, unless a load says otherwise.
FIRST_MARK = datetime(2020, 1, 1)
AFFILIATE_KEYS = ["affiliate_id", "player_id"]
# What a load looks rows up by; a table with many buckets is searched in those of the batch only.
BRONZE_KEYS = {
    "players": [],
    "sessions": ["session_id"],
    "transactions": ["transaction_id"],
    "affiliates": AFFILIATE_KEYS,
}
# Event time, whose largest value is the mark of an incremental load.
EVENT = {"sessions": "timestamp", "transactions": "timestamp"}


class MergeConflict(ValueError):
    """Two rows of one batch claim the same stored row."""


def table_path(root: str, dataset: str) -> str:
    return f"{root}/{BRONZE_TABLES[dataset]}"


def create_bronze(spark: SparkSession, root: str, dataset: str, buckets: int = BUCKETS) -> None:
    """Create the table if it is absent; an existing one is left alone.

    Loads are kept by day of the ingest stamp, so that an incremental read opens only recent folders;
    affiliates are merged into by key.
    """
    create_table(
        spark, table_path(root, dataset), BRONZE[dataset], BRONZE_KEYS[dataset],
        dataset == "affiliates", "day", buckets,
    )


def with_stamp(df: DataFrame, dataset: str, as_of: datetime) -> DataFrame:
    """Columns of the table; `_ingested_at` defaults to the time of the run."""
    given = F.col("_ingested_at") if "_ingested_at" in df.columns else F.lit(None)
    stamped = df.withColumn("_ingested_at", F.coalesce(given.cast("timestamp"), stamp(as_of)))
    return stamped.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE[dataset].fields])


def _moment(rows: DataFrame, as_of: datetime) -> datetime | None:
    """The stamp that with_stamp() gives all rows, in UTC, if they have none of their own."""
    if STAMP in rows.columns:
        return None
    return as_of.astimezone(timezone.utc).replace(tzinfo=None) if as_of.tzinfo else as_of


def read_bronze(
    spark: SparkSession, root: str, dataset: str, since: datetime | None = None
) -> DataFrame:
    """The whole table, or its rows with `_ingested_at` after `since`."""
    rows = read_table(spark, table_path(root, dataset), since)
    return rows if since is None else rows.filter(F.col("_ingested_at") > stamp(since))


def backfill(spark: SparkSession, root: str, dataset: str, rows: DataFrame) -> None:
    """Add rows with the stamps they carry, such as the history of another system."""
    create_bronze(spark, root, dataset)
    path, rows = table_path(root, dataset), rows.select(*BRONZE[dataset].names)
    if dataset == "affiliates":
        # No stored row is retired: the history of a pair is kept until silver takes the latest.
        merge_table(spark, path, rows, AFFILIATE_KEYS, retire_if=F.lit(False))
    else:
        append_table(spark, path, rows, EVENT.get(dataset))


def append_players(
    spark: SparkSession,
    root: str,
    rows: DataFrame,
    as_of: datetime,
    full_reload: bool = False,
    buckets: int = BUCKETS,
) -> None:
    """Load every row of the delivery. `full_reload` replaces what earlier runs loaded."""
    create_bronze(spark, root, "players", buckets)
    batch = with_stamp(rows.withColumn("created_at", F.to_date("created_at")), "players", as_of)
    path, moment = table_path(root, "players"), _moment(rows, as_of)
    if full_reload:
        replace_table(spark, path, batch, period="day", keyed=False, moment=moment)
    else:
        append_table(spark, path, batch, moment=moment)


def high_water_mark(
    table: DataFrame, column: str = "timestamp", first_mark: datetime = FIRST_MARK
) -> datetime:
    """Largest event time loaded so far."""
    return moment_of(table, F.coalesce(F.max(column), stamp(first_mark)))


def loaded_mark(
    spark: SparkSession, root: str, dataset: str, first_mark: datetime = FIRST_MARK
) -> datetime:
    """high_water_mark() of a stored table; every load keeps it, so no row is read."""
    known = state(spark, table_path(root, dataset))
    return max(known.high, first_mark) if known and known.high else first_mark


def unseen(batch: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Batch rows whose key the table does not hold.

    The table is first cut down to keys of the batch, so that only those are shuffled or held; it
    is never shuffled whole when the batch is small enough for Spark to broadcast its keys.
    """
    held = table.select(key).join(batch.select(key).distinct(), key, "left_semi").distinct()
    return salted_join(batch, held, [key], "left_anti")


def insert_new(
    spark: SparkSession,
    root: str,
    dataset: str,
    key: str,
    rows: DataFrame,
    as_of: datetime,
    lookback_minutes: int = 0,
    first_mark: datetime = FIRST_MARK,
    buckets: int = BUCKETS,
    mark: datetime | None = None,
) -> int:
    """Insert rows later than the newest event time loaded, unless their key is known.

    Rows of one batch are not deduplicated against each other. Late rows, and rows without a time,
    are dropped unless `lookback_minutes` moves the mark back; returned is how many there are. `mark`
    stands for the newest event time where one delivery is loaded in several batches. Of what is
    stored only the buckets of the batch's keys are searched.
    """
    create_bronze(spark, root, dataset, buckets)
    path = table_path(root, dataset)
    late_at = stamp(mark or loaded_mark(spark, root, dataset, first_mark))
    if lookback_minutes:
        late_at = late_at - F.make_dt_interval(mins=F.lit(lookback_minutes))
    batch = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    in_time = F.coalesce(F.col("timestamp") > late_at, F.lit(False))
    late = batch.agg(F.count_if(~in_time)).first()[0]
    fresh = batch.filter(F.col("timestamp") > late_at)
    known = state(spark, path)
    # With one bucket there is nothing to choose.
    some = None if known.buckets == 1 else buckets_of(fresh, known)
    table = read_table(spark, path, buckets=some)
    new = with_stamp(unseen(fresh, table, key), dataset, as_of)
    append_table(spark, path, new, EVENT.get(dataset), moment=_moment(rows, as_of))
    return late


def load_sessions(spark, root: str, rows: DataFrame, as_of: datetime, **options) -> int:
    return insert_new(spark, root, "sessions", "session_id", rows, as_of, **options)


def load_transactions(spark, root: str, rows: DataFrame, as_of: datetime, **options) -> int:
    return insert_new(spark, root, "transactions", "transaction_id", rows, as_of, **options)


def upsert_affiliates(
    spark: SparkSession, root: str, rows: DataFrame, as_of: datetime, buckets: int = BUCKETS
) -> None:
    """Update stored rows that an incoming row of the same pair is newer than, insert new pairs.

    Read and written are the buckets of the batch's pairs only.
    """
    create_bronze(spark, root, "affiliates", buckets)
    path = table_path(root, "affiliates")
    batch = with_stamp(rows, "affiliates", as_of)
    known = state(spark, path)
    table = read_table(spark, path, buckets=None if known.buckets == 1 else buckets_of(batch, known))
    keys = AFFILIATE_KEYS
    held = (
        table.select(*keys, F.col("_ingested_at").alias("_stored_at"))
        .join(batch.select(*keys).distinct(), keys, "left_semi")
    )
    per_pair = batch.groupBy(*keys).count()
    if not per_pair.filter("count > 1").join(held, keys, "left_semi").isEmpty():
        raise MergeConflict("two rows of the batch match one stored affiliate and player")
    updated = batch.join(held, keys).filter("_ingested_at > _stored_at").drop("_stored_at")
    inserted = salted_join(batch, held.select(*keys).distinct(), keys, "left_anti")
    columns = BRONZE["affiliates"].names
    merge_table(
        spark,
        path,
        updated.select(columns).unionByName(inserted.select(columns)),
        keys,
        retire_by=batch.select(*keys, "_ingested_at"),
        retire_if=F.col("new._ingested_at") > F.col("old._ingested_at"),
    )


LOADS = {
    "players": append_players,
    "sessions": load_sessions,
    "transactions": load_transactions,
    "affiliates": upsert_affiliates,
}
