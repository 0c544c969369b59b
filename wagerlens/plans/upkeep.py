"""The financial summary kept up to date by what a load changes, instead of rebuilt.

Three tables stand behind it: sums per player and day, metrics per player, and sums per city. After a
load of transactions or players, the players it touches are worked out again: the day sums of new
transactions are added to the stored ones, and where a transaction was replaced, the days of its
players are counted anew. The difference of old and new metrics is added to the cities; the operator's
totals are the sum of the cities. All other players are carried over unread: what is read and written
are the changed rows and the buckets of their players.

The totals of city and operator that stand next to each player change with every load, so they are
joined when the summary is read (cities are few) and not stored with the players.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.functions.measures import MONEY, average, risk_class
from wagerlens.functions.times import stamp
from wagerlens.plans.finance import (
    SUMMARY_COLUMNS,
    added_days,
    city_metrics,
    financial_metrics,
    global_metrics,
    player_days,
    totals_of_days,
    with_city,
    with_global,
)
from wagerlens.sources.scratch import WorkTables
from wagerlens.sources.tables import (
    BUCKETS,
    buckets_of,
    forget_retired,
    merge_table,
    read_added,
    read_retired,
    read_table,
    replace_table,
    state,
)

KEY = ["player_id"]
TX, PLAYERS = "fct_transactions", "dim_players"
PARTS = ("player_days", "player_metrics", "cities")
CITY_SUMS = ["city_total_deposits", "city_total_withdrawals", "city_total_bets", "city_ggr"]


def _of_players(spark: SparkSession, path: str, chosen: DataFrame) -> DataFrame:
    """Stored rows of some players, from their buckets only."""
    known = state(spark, path)
    some = None if known.buckets == 1 else buckets_of(chosen, known)
    return read_table(spark, path, buckets=some).join(chosen, KEY, "left_semi")


def _city_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What the cities of the metrics before lose and those of the metrics after gain."""
    sign = lambda n, rows: city_metrics(rows).select(
        "city", (F.lit(n) * F.col("total_players")).alias("total_players"),
        *[(F.lit(n) * F.col(c)).cast(MONEY).alias(c) for c in CITY_SUMS],
    )
    return sign(-1, before).unionByName(sign(1, after))


def _summed_cities(rows: DataFrame) -> DataFrame:
    """City rows added up; cities without players are gone."""
    return (
        rows.groupBy("city")
        .agg(
            F.sum("total_players").alias("total_players"),
            *[F.sum(c).cast(MONEY).alias(c) for c in CITY_SUMS],
        )
        .filter("total_players > 0")
        .withColumns(
            {
                "avg_deposits_per_player": average("city_total_deposits", "total_players"),
                "avg_bets_per_player": average("city_total_bets", "total_players"),
            }
        )
    )


def refresh_summary(
    spark: SparkSession,
    silver_root: str,
    root: str,
    work: WorkTables,
    as_of: datetime,
    buckets: int = BUCKETS,
) -> int:
    """Take in the silver rows added since the last call; returns the number of players worked out.

    Silver must have been refreshed with `keep_retired`. The marks of what is taken in are written
    last; a call that died is made good by the next one only before it has stored anything, so run
    it as the last step of a load, and rebuild (delete `root`) after a failure between its steps.
    """
    silver = {n: f"{silver_root}/{n}" for n in (TX, PLAYERS)}
    days_at, metrics_at, cities_at = (f"{root}/{n}" for n in PARTS)
    marks = {n: state(spark, path).load for n, path in silver.items()}
    old = state(spark, metrics_at)
    if old is None:
        tx = read_table(spark, silver[TX]).filter(F.col("player_id").isNotNull())
        replace_table(spark, days_at, player_days(tx), KEY, buckets=buckets)
        totals = totals_of_days(read_table(spark, days_at))
        metrics = financial_metrics(totals, read_table(spark, silver[PLAYERS]))
        done = replace_table(spark, metrics_at, metrics, KEY, buckets=buckets, marks=marks)
        cities = city_metrics(read_table(spark, metrics_at))
        replace_table(spark, cities_at, cities.withColumn("_gold_processed_at", stamp(as_of)))
        return done.added_rows

    known = F.col("player_id").isNotNull()
    new_tx = read_added(spark, silver[TX], old.marks[TX]).filter(known)
    gone = read_retired(spark, silver[TX], old.marks[TX]).filter(known).select(*KEY).distinct()
    gone = work.keep("replaced", gone)
    # A replaced transaction can't be taken off a least or a greatest time: its players are counted anew.
    again = not gone.isEmpty()
    added = player_days(new_tx.join(gone, KEY, "left_anti") if again else new_tx)
    fresh = work.keep("new_days", added)
    with_new_days = fresh.select(*KEY).distinct()
    days = added_days(fresh.unionByName(_of_players(spark, days_at, with_new_days).select(fresh.columns)))
    if again:
        whole = read_table(spark, silver[TX]).join(gone, KEY, "left_semi")
        days = days.unionByName(player_days(whole))
    days = work.keep("days", days)
    merge_table(
        spark, days_at, days, KEY, retire_by=days.select(*KEY).distinct().unionByName(gone)
    )

    changed = read_added(spark, silver[PLAYERS], old.marks[PLAYERS]).select(*KEY)
    lost = read_retired(spark, silver[PLAYERS], old.marks[PLAYERS]).select(*KEY)
    touched = work.keep(
        "touched",
        days.select(*KEY).unionByName(gone).unionByName(changed).unionByName(lost).distinct(),
    )
    totals = totals_of_days(_of_players(spark, days_at, touched))
    after = work.keep("after", financial_metrics(totals, _of_players(spark, silver[PLAYERS], touched)))
    before = work.keep("before", _of_players(spark, metrics_at, touched))
    cities = read_table(spark, cities_at).select("city", "total_players", *CITY_SUMS)
    cities = work.keep("cities", _summed_cities(cities.unionByName(_city_changes(before, after))))
    replace_table(spark, cities_at, cities.withColumn("_gold_processed_at", stamp(as_of)))
    done = merge_table(spark, metrics_at, after, KEY, retire_by=touched, marks=marks)
    for n, path in silver.items():
        forget_retired(spark, path, marks[n])
    return done.added_rows


def is_kept(spark: SparkSession, root: str) -> bool:
    """Whether a summary is kept up to date in this folder."""
    return state(spark, f"{root}/player_metrics") is not None


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    """The financial summary, as plans.finance.financial_summary() builds it."""
    metrics, cities = (read_table(spark, f"{root}/{n}") for n in ("player_metrics", "cities"))
    processed = cities.agg(F.max("_gold_processed_at"))
    return (
        with_global(with_city(metrics, cities), global_metrics(cities))
        .withColumn("risk_classification", risk_class())
        .select(*SUMMARY_COLUMNS, processed.scalar().alias("_gold_processed_at"))
    )
