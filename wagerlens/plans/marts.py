"""The datasets behind the three dashboard pages: fraud, affiliates, finance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.measures import MONEY, average, safe_ratio
from wagerlens.operators.filters import not_normal
from wagerlens.operators.topk import top_rows, top_with_ties

TOP = 10


def distinct_with_blank(column: str) -> Column:
    """Distinct values, where NULL counts as one value."""
    blank = F.max(F.when(F.col(column).isNull(), 1).otherwise(0))
    return F.count_distinct(column) + F.coalesce(blank, F.lit(0))


# --- fraud page ---


def flagged_players(signals: DataFrame) -> DataFrame:
    return signals.agg(distinct_with_blank("player_id").alias("flagged_players"))


def total_signals(signals: DataFrame) -> DataFrame:
    return signals.agg(F.count(F.lit(1)).alias("total_signals"))


def flagged_share(signals: DataFrame, players: DataFrame) -> DataFrame:
    """Flagged players over all players, NULL without players."""
    everyone = players.agg(F.count(F.lit(1)))
    return flagged_players(signals).select(
        "flagged_players",
        everyone.scalar().alias("all_players"),
        safe_ratio(F.col("flagged_players"), everyone.scalar()).alias("flagged_share"),
    )


def signals_by_type(signals: DataFrame) -> DataFrame:
    return signals.groupBy("signal_type", "risk_level").agg(F.count(F.lit(1)).alias("signals"))


def signals_share_by_type(signals: DataFrame) -> DataFrame:
    """Signals per type and risk next to all signals within the active filters."""
    per_type = signals_by_type(signals)
    total = per_type.agg(F.sum("signals"))
    return per_type.withColumn("all_signals", total.scalar()).withColumn(
        "share", safe_ratio("signals", "all_signals")
    )


def signals_with_city(signals: DataFrame, players: DataFrame) -> DataFrame:
    """Signals per player and risk with the player's city.

    Counted before the join, so that each player meets the dimension once per risk level.
    """
    counted = signals.groupBy("player_id", "risk_level").agg(F.count(F.lit(1)).alias("signals"))
    return counted.join(players.select("player_id", "city"), "player_id", "left")


def signals_by_city(signals: DataFrame, players: DataFrame) -> DataFrame:
    return (
        signals_with_city(signals, players)
        .groupBy("city", "risk_level")
        .agg(F.sum("signals").alias("signals"))
    )


def signals_by_day(signals: DataFrame) -> DataFrame:
    return signals.groupBy(F.to_date("detected_at").alias("day"), "signal_type").agg(
        F.count(F.lit(1)).alias("signals")
    )


CARD_COLUMNS = ["signal_type", "risk_level", "city", "day"]
# What each card of the fraud page is counted by; `type` and `total` are what shares are taken of.
CARDS = {
    "total": [],
    "type": ["signal_type"],
    "type_and_risk": ["signal_type", "risk_level"],
    "city_and_risk": ["city", "risk_level"],
    "day_and_type": ["day", "signal_type"],
}


def fraud_cards(signals: DataFrame, players: DataFrame) -> DataFrame:
    """card, signal_type, risk_level, city, day, signals: all cards of the fraud page by one pass over
    the signals; columns a card is not counted by are NULL.

    Counted per player, type, risk and day before the join, so each player meets the dimension with
    counts only.
    """
    day = F.to_date("detected_at").alias("day")
    counted = signals.groupBy("player_id", "signal_type", "risk_level", day).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = counted.join(players.select("player_id", "city"), "player_id", "left")
    card = F.lit(None).cast("string")
    for name, by in CARDS.items():
        # A bit for each column that is not counted by, the first column in the highest.
        number = sum(1 << i for i, c in enumerate(reversed(CARD_COLUMNS)) if c not in by)
        card = F.when(F.col("_set") == number, F.lit(name)).otherwise(card)
    return (
        rows.groupingSets([[F.col(c) for c in by] for by in CARDS.values()], *CARD_COLUMNS)
        .agg(F.sum("n").alias("signals"), F.grouping_id(*CARD_COLUMNS).alias("_set"))
        .select(card.alias("card"), *CARD_COLUMNS, "signals")
    )


def card(cards: DataFrame, name: str) -> DataFrame:
    """One card of fraud_cards() with the columns it is counted by."""
    return cards.filter(F.col("card") == name).select(*CARDS[name], "signals")


def cards_with_shares(cards: DataFrame) -> DataFrame:
    """Each row of the cards next to all signals within the filters, and to those of its type."""
    total = card(cards, "total").agg(F.coalesce(F.sum("signals"), F.lit(0)))
    of_type = card(cards, "type").select(
        F.col("signal_type").alias("_type"), F.col("signals").alias("type_signals")
    )
    met = F.col("signal_type").eqNullSafe(F.col("_type")) & F.col("card").isin("type", "type_and_risk", "day_and_type")
    return (
        cards.join(of_type, met, "left")
        .drop("_type")
        .withColumn("all_signals", total.scalar())
        .withColumns(
            {
                "share": safe_ratio("signals", "all_signals"),
                "share_of_type": safe_ratio("signals", "type_signals"),
            }
        )
    )


def latest_signals(signals: DataFrame, k: int = TOP) -> DataFrame:
    """The newest signals, with all that tie with the last one."""
    return top_with_ties(signals, "detected_at", k).select(
        "player_id", "signal_type", "risk_level", "signal_description", "detected_at"
    )


def latest_signals_text(signals: DataFrame, k: int = TOP) -> DataFrame:
    """The newest k signals as one line; ties are settled by the event id so that the line
    stays short."""
    newest = top_rows(signals, "detected_at", ["signal_event_id"], k)
    item = F.struct(
        (-F.unix_micros("detected_at")).alias("age"),
        "signal_event_id",
        F.concat_ws(" - ", "player_id", "signal_type").alias("label"),
    )
    ordered = F.sort_array(F.collect_list(item))
    return newest.agg(F.array_join(ordered.getField("label"), " | ").alias("details"))


def high_risk_share(signals: DataFrame) -> DataFrame:
    """Share of signals with risk HIGH. The definition is our own choice."""
    return signals.agg(
        safe_ratio(F.count_if(F.col("risk_level") == "HIGH"), F.count(F.lit(1))).alias(
            "high_risk_share"
        )
    )


def total_accounts(players: DataFrame) -> DataFrame:
    return players.agg(F.count(F.lit(1)).alias("total_accounts"))


# --- affiliate page ---


def affiliate_kpis(performance: DataFrame) -> DataFrame:
    return performance.agg(
        distinct_with_blank("affiliate_id").alias("total_affiliates"),
        F.sum("total_ftd").alias("total_ftd"),
        F.avg(F.col("overall_conversion_rate").cast("decimal(18,2)"))
        .cast("decimal(18,6)")
        .alias("avg_conversion_rate"),
        F.avg(F.col("affiliate_roi").cast("decimal(18,2)"))
        .cast("decimal(18,6)")
        .alias("avg_roi"),
    )


def ftd_by_affiliate(performance: DataFrame) -> DataFrame:
    return (
        performance.groupBy("affiliate_id")
        .agg(
            F.sum("total_ftd").alias("total_ftd"),
            F.sum("total_cpa_revenue").cast(MONEY).alias("total_cpa_revenue"),
        )
        .orderBy(F.desc("total_ftd"), "affiliate_id")
    )


def ftd_by_country(performance: DataFrame) -> DataFrame:
    return performance.groupBy("country").agg(F.sum("total_ftd").alias("total_ftd"))


def roi_points(performance: DataFrame) -> DataFrame:
    return performance.select(
        "affiliate_id", "country", "total_ftd", "affiliate_roi", "total_cpa_revenue"
    )


def top_affiliates(performance: DataFrame, k: int = TOP) -> DataFrame:
    return top_rows(performance, "total_ftd", ["affiliate_id", "country"], k).select(
        "affiliate_id",
        "country",
        "total_ftd",
        "total_cpa_revenue",
        "overall_conversion_rate",
        "affiliate_roi",
    )


# --- finance page ---


def finance_kpis(summary: DataFrame) -> DataFrame:
    totals = summary.agg(
        F.sum("total_deposits").cast(MONEY).alias("total_deposits"),
        F.sum("ggr").cast(MONEY).alias("total_ggr"),
        F.sum("estimated_ltv").cast(MONEY).alias("_ltv"),
        F.count("total_deposits").alias("_players"),
    )
    return totals.select(
        "total_deposits",
        "total_ggr",
        average("total_deposits", "_players").alias("arpu"),
        average("_ltv", "_players").alias("avg_ltv"),
    )


def ggr_by_city(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("city")
        .agg(F.sum("ggr").cast(MONEY).alias("ggr"))
        .orderBy(F.desc("ggr"), "city")
    )


def players_by_risk(summary: DataFrame) -> DataFrame:
    return summary.groupBy("risk_classification").agg(F.count(F.lit(1)).alias("players"))


def deposits_and_bets_by_city(summary: DataFrame) -> DataFrame:
    """Long form: one row per city and measure."""
    per_city = summary.groupBy("city").agg(
        F.sum("total_deposits").cast(MONEY).alias("total_deposits"),
        F.sum("total_bets").cast(MONEY).alias("total_bets"),
    )
    return per_city.unpivot("city", ["total_deposits", "total_bets"], "measure", "amount")


def risky_players(summary: DataFrame) -> DataFrame:
    return not_normal(summary).select(
        "player_id", "city", "total_deposits", "total_bets", "ggr", "risk_classification"
    )
