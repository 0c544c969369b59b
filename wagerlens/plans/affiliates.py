"""Affiliate performance and affiliates with flagged players."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.measures import (
    MONEY,
    average,
    money_percent,
    percent,
    safe_ratio,
)
from wagerlens.functions.text import surrogate_key
from wagerlens.functions.times import stamp
from wagerlens.operators.skew import salted_join
from wagerlens.plans.finance import player_financials
from wagerlens.sources.scratch import WorkTables, kept

REVENUE = ["total_deposits", "total_bets", "total_withdrawals", "net_revenue"]


def affiliate_totals():
    """Aggregates over the rows of one affiliate and country."""
    return [
        # One row per affiliate and player, so rows with a player are distinct players.
        F.count("player_id").alias("total_players"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("registrations").alias("total_registrations"),
        F.sum("ftd_count").alias("total_ftd"),
        F.sum("total_cpa_value").cast(MONEY).alias("total_cpa_revenue"),
        F.sum("cpa_value").alias("_cpa_sum"),
        F.count("cpa_value").alias("_cpa_rows"),
    ]


def with_affiliate_rates(df: DataFrame) -> DataFrame:
    whole = {c: F.col(c).cast("decimal(20,0)") for c in
             ("total_clicks", "total_registrations", "total_ftd")}
    return df.withColumns(
        {
            "avg_cpa_value": average("_cpa_sum", "_cpa_rows"),
            "overall_conversion_rate": percent(
                whole["total_registrations"], whole["total_clicks"]
            ),
            "overall_ftd_rate": percent(whole["total_ftd"], whole["total_registrations"]),
        }
    ).drop("_cpa_sum", "_cpa_rows")


def affiliate_metrics(affiliates: DataFrame) -> DataFrame:
    return with_affiliate_rates(
        affiliates.groupBy("affiliate_id", "country").agg(*affiliate_totals())
    )


def player_revenue(totals: DataFrame) -> DataFrame:
    return totals.select(
        "player_id",
        "total_deposits",
        "total_bets",
        "total_withdrawals",
        (F.col("total_bets") - F.col("total_withdrawals")).cast(MONEY).alias("net_revenue"),
    )


def affiliate_performance(
    affiliates: DataFrame,
    tx: DataFrame,
    as_of: datetime,
    work: WorkTables | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """One row per affiliate and country, with the revenue of the players referred.

    Revenue is joined to the referrals once and added up with them. Referrals without affiliate
    or country count as referrals but carry no revenue. A player referred by several affiliates
    counts for each of them.
    """
    matched = F.col("affiliate_id").isNotNull() & F.col("country").isNotNull()
    totals = kept(work, "player_totals", player_financials(tx))
    joined = salted_join(
        affiliates,
        player_revenue(totals),
        ["player_id"],
        "left",
        spread=["affiliate_id"],
        min_rows=min_rows,
    )
    revenue = [
        F.coalesce(F.sum(F.when(matched, F.col(c))), F.lit(0)).cast(MONEY).alias(name)
        for c, name in zip(
            REVENUE,
            (
                "player_total_deposits",
                "player_total_bets",
                "player_total_withdrawals",
                "player_net_revenue",
            ),
        )
    ]
    grouped = joined.groupBy("affiliate_id", "country").agg(*affiliate_totals(), *revenue)
    return with_affiliate_rates(grouped).select(
        surrogate_key(["affiliate_id", "country"]).alias("affiliate_performance_id"),
        "affiliate_id",
        "country",
        "total_players",
        "total_clicks",
        "total_registrations",
        "total_ftd",
        "total_cpa_revenue",
        "avg_cpa_value",
        "overall_conversion_rate",
        "overall_ftd_rate",
        "player_total_deposits",
        "player_total_bets",
        "player_total_withdrawals",
        "player_net_revenue",
        money_percent(
            F.col("player_net_revenue") - F.col("total_cpa_revenue"), F.col("total_cpa_revenue")
        ).alias("affiliate_roi"),
        stamp(as_of).alias("_gold_processed_at"),
    )


def affiliate_fraud(
    affiliates: DataFrame, signals: DataFrame, min_rows: int | None = None
) -> DataFrame:
    """Share of each affiliate's players that carry a fraud signal. The rule is our own choice:
    an affiliate is suspicious when at least half of its players do."""
    flagged = signals.groupBy("player_id").agg(F.count(F.lit(1)).alias("signals"))
    joined = salted_join(
        affiliates.select("affiliate_id", "player_id"),
        flagged,
        ["player_id"],
        "left",
        spread=["affiliate_id"],
        min_rows=min_rows,
    )
    return (
        joined.groupBy("affiliate_id")
        .agg(
            F.count("player_id").alias("total_players"),
            F.count("signals").alias("flagged_players"),
            F.coalesce(F.sum("signals"), F.lit(0)).alias("total_signals"),
        )
        .withColumn("flagged_share", safe_ratio("flagged_players", "total_players"))
        .withColumn("suspicious", F.coalesce(F.col("flagged_share") >= 0.5, F.lit(False)))
    )
