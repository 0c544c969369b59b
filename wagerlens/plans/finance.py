"""Financial summary per player, with its city and the whole operator next to it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.measures import AVERAGE, MONEY, average, risk_class
from wagerlens.functions.times import stamp
from wagerlens.operators.bitmaps import distinct_counts, distinct_sets
from wagerlens.operators.skew import salted_join
from wagerlens.sources.scratch import WorkTables, kept

# Name in the totals, transaction type, name in the counts and averages.
KINDS = [
    ("total_deposits", "deposit", "deposit"),
    ("total_withdrawals", "withdraw", "withdrawal"),
    ("total_bets", "bet", "bet"),
]


def player_days(tx: DataFrame) -> DataFrame:
    """Sums per player and day, from which those of any longer time add up."""
    is_kind = {kind: F.col("transaction_type") == kind for _, kind, _ in KINDS}
    amount = F.col("amount")
    return tx.groupBy("player_id", "transaction_date").agg(
        F.min("transaction_timestamp").alias("first_transaction"),
        F.max("transaction_timestamp").alias("last_transaction"),
        *[F.sum(F.when(is_kind[k], amount).otherwise(0)).alias(f"{k}_sum") for _, k, _ in KINDS],
        *[F.count(F.when(is_kind[k], 1)).alias(f"{k}_rows") for _, k, _ in KINDS],
        *[F.count(F.when(is_kind[k], amount)).alias(f"{k}_amounts") for _, k, _ in KINDS],
    )


def added_days(days: DataFrame) -> DataFrame:
    """Rows of player_days() of several parts of the transactions as one row per player and day."""
    sums = [c for c in days.columns if c.endswith(("_sum", "_rows", "_amounts"))]
    return days.groupBy("player_id", "transaction_date").agg(
        F.min("first_transaction").alias("first_transaction"),
        F.max("last_transaction").alias("last_transaction"),
        *[F.sum(c).cast(days.schema[c].dataType).alias(c) for c in sums],
    )


def player_financials(tx: DataFrame) -> DataFrame:
    """Totals, counts and averages per player and transaction type, and the days active.

    Counted per player and day first: the distinct days become rows, and a player with very many
    rows is added up in parts before the second shuffle.
    """
    return totals_of_days(player_days(tx))


def totals_of_days(daily: DataFrame) -> DataFrame:
    sums = daily.groupBy("player_id").agg(
        F.count("transaction_date").alias("active_days"),
        F.min("first_transaction").alias("first_transaction"),
        F.max("last_transaction").alias("last_transaction"),
        *[F.sum(f"{k}_sum").cast(MONEY).alias(total) for total, k, _ in KINDS],
        *[F.sum(f"{k}_rows").alias(f"{name}_count") for _, k, name in KINDS],
        *[F.sum(f"{k}_amounts").alias(f"_{k}_amounts") for _, k, _ in KINDS],
    )
    return sums.select(
        "player_id",
        "active_days",
        "first_transaction",
        "last_transaction",
        *[
            c
            for total, k, name in KINDS
            for c in (
                F.col(total),
                F.col(f"{name}_count"),
                average(total, f"_{k}_amounts").alias(f"avg_{name}"),
            )
        ],
    )


def financial_metrics(totals: DataFrame, players: DataFrame) -> DataFrame:
    """Players that have transactions, with city, revenue and lifespan."""
    return (
        totals.join(players.select("player_id", "city", "created_at"), "player_id")
        .withColumns(
            {
                "ggr": (F.col("total_bets") - F.col("total_withdrawals")).cast(MONEY),
                "net_deposit": (F.col("total_deposits") - F.col("total_withdrawals")).cast(MONEY),
                "estimated_ltv": F.col("total_deposits"),
                "customer_lifespan_days": F.datediff(
                    F.to_date("last_transaction"), F.to_date("first_transaction")
                ),
            }
        )
    )


def city_metrics(metrics: DataFrame) -> DataFrame:
    """Totals per city; players without a city form one group. Players are unique in `metrics`,
    so their number is the number of rows."""
    return (
        metrics.groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("total_players"),
            F.sum("total_deposits").cast(MONEY).alias("city_total_deposits"),
            F.sum("total_withdrawals").cast(MONEY).alias("city_total_withdrawals"),
            F.sum("total_bets").cast(MONEY).alias("city_total_bets"),
            F.sum("ggr").cast(MONEY).alias("city_ggr"),
        )
        .withColumns(
            {
                "avg_deposits_per_player": average("city_total_deposits", "total_players"),
                "avg_bets_per_player": average("city_total_bets", "total_players"),
            }
        )
    )


def global_metrics(cities: DataFrame) -> DataFrame:
    """One row for the whole operator, added up from the cities."""
    return cities.agg(
        F.coalesce(F.sum("total_players"), F.lit(0)).alias("total_active_players"),
        F.sum("city_total_deposits").cast(MONEY).alias("global_total_deposits"),
        F.sum("city_total_withdrawals").cast(MONEY).alias("global_total_withdrawals"),
        F.sum("city_total_bets").cast(MONEY).alias("global_total_bets"),
        F.sum("city_ggr").cast(MONEY).alias("global_ggr"),
    ).withColumns(
        {
            "arpu_deposits": average("global_total_deposits", "total_active_players"),
            "arpu_bets": average("global_total_bets", "total_active_players"),
        }
    )


def with_city(metrics: DataFrame, cities: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Metrics with the totals of the player's city; NULL for players without one."""
    named = cities.select(
        "city",
        F.col("total_players").alias("city_total_players"),
        "city_total_deposits",
        "city_total_withdrawals",
        "city_total_bets",
        "city_ggr",
        F.col("avg_deposits_per_player").alias("city_avg_deposits"),
        F.col("avg_bets_per_player").alias("city_avg_bets"),
    )
    return salted_join(
        metrics,
        named,
        ["city"],
        "left",
        weights=(cities, "total_players"),
        spread=["player_id"],
        min_rows=min_rows,
    )


def with_global(metrics: DataFrame, totals: DataFrame) -> DataFrame:
    """Metrics with the one row of global totals next to each, as a scalar subquery."""
    row = totals.select(F.struct("*").alias("_totals"))
    return metrics.withColumn("_totals", row.scalar()).select("*", "_totals.*").drop("_totals")


SUMMARY_COLUMNS = [
    "player_id",
    "city",
    "created_at",
    "active_days",
    "first_transaction",
    "last_transaction",
    "total_deposits",
    "deposit_count",
    "avg_deposit",
    "total_withdrawals",
    "withdrawal_count",
    "avg_withdrawal",
    "total_bets",
    "bet_count",
    "avg_bet",
    "ggr",
    "net_deposit",
    "estimated_ltv",
    "customer_lifespan_days",
    "city_total_players",
    "city_total_deposits",
    "city_total_withdrawals",
    "city_total_bets",
    "city_ggr",
    "city_avg_deposits",
    "city_avg_bets",
    "total_active_players",
    "global_total_deposits",
    "global_total_withdrawals",
    "global_total_bets",
    "global_ggr",
    "arpu_deposits",
    "arpu_bets",
    "risk_classification",
]


def financial_summary(
    tx: DataFrame,
    players: DataFrame,
    as_of: datetime,
    work: WorkTables | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Every player that has transactions. The metrics per player are read for the cities, for
    the operator and for the rows themselves, so they are worth keeping."""
    totals = kept(work, "player_totals", player_financials(tx))
    metrics = kept(work, "player_metrics", financial_metrics(totals, players))
    cities = kept(work, "city_metrics", city_metrics(metrics))
    return (
        with_global(with_city(metrics, cities, min_rows), global_metrics(cities))
        .withColumn("risk_classification", risk_class())
        .select(*SUMMARY_COLUMNS, stamp(as_of).alias("_gold_processed_at"))
    )


def player_ltv(summary: DataFrame) -> DataFrame:
    """Lifetime value per player next to the operator's revenue per user."""
    return summary.select(
        "player_id",
        "city",
        "estimated_ltv",
        "customer_lifespan_days",
        "active_days",
        "arpu_deposits",
        "arpu_bets",
    )


def net_gaming_revenue(summary: DataFrame, affiliates: DataFrame) -> DataFrame:
    """GGR less what the player's affiliates were paid. The formula is our own choice."""
    cost = affiliates.groupBy("player_id").agg(
        F.sum("total_cpa_value").cast(MONEY).alias("cpa_cost")
    )
    return (
        summary.select("player_id", "ggr")
        .join(cost, "player_id", "left")
        .withColumn("cpa_cost", F.coalesce("cpa_cost", F.lit(0).cast(MONEY)))
        .withColumn("ngr", (F.col("ggr") - F.col("cpa_cost")).cast(MONEY))
    )


def period_totals(tx: DataFrame, period: str = "month") -> DataFrame:
    """Totals per period and transaction type."""
    return tx.groupBy(
        F.date_trunc(period, "transaction_date").cast("date").alias("period"), "transaction_type"
    ).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount").cast(MONEY).alias("total_amount"),
        (F.sum("amount") / F.count("amount")).cast(AVERAGE).alias("avg_amount"),
    )


def active_player_sets(tx: DataFrame, players: DataFrame, numbers: DataFrame) -> DataFrame:
    """transaction_date, transaction_type, city, part, bits: the players of each day, type and city.

    `numbers` has a dense number per player; see operators.bitmaps.
    """
    pairs = tx.select("player_id", "transaction_date", "transaction_type").distinct()
    known = numbers.join(players.select("player_id", "city"), "player_id", "left")
    numbered = salted_join(pairs, known, ["player_id"])
    return distinct_sets(numbered, ["transaction_date", "transaction_type", "city"])


def active_players(sets: DataFrame, period: str, by: list[str]) -> DataFrame:
    """Distinct players per period and further columns of the sets, added up from the days."""
    start = F.date_trunc(period, "transaction_date").cast("date").alias("start")
    return distinct_counts(sets, [start, *by], "players")
