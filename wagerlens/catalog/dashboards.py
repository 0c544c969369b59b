"""The datasets of the dashboard pages, read from stored gold tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from wagerlens.catalog.lake import Lake
from wagerlens.catalog.registry import query
from wagerlens.catalog.sqlparts import avg6, day, money, ts
from wagerlens.operators.filters import Filters, apply_filters
from wagerlens.plans import marts


@query(
    "b1_flagged_players",
    "SELECT count(DISTINCT player_id) AS flagged_players FROM fct_fraud_signals",
)
def _(lake: Lake) -> DataFrame:
    return marts.flagged_players(lake.signals)


@query("b2_total_signals", "SELECT count(*) AS total_signals FROM fct_fraud_signals")
def _(lake: Lake) -> DataFrame:
    return marts.total_signals(lake.signals)


@query(
    "b3_flagged_share",
    """SELECT count(DISTINCT player_id) AS flagged_players,
          (SELECT count(*) FROM dim_players) AS all_players,
          CAST(count(DISTINCT player_id) AS DOUBLE) / (SELECT count(*) FROM dim_players)
            AS flagged_share FROM fct_fraud_signals""",
)
def _(lake: Lake) -> DataFrame:
    return marts.flagged_share(lake.signals, lake.players)


@query(
    "b4_signals_by_type",
    """SELECT signal_type, risk_level, count(*) AS signals FROM fct_fraud_signals
        GROUP BY signal_type, risk_level""",
)
def _(lake: Lake) -> DataFrame:
    return marts.signals_by_type(lake.signals)


@query(
    "b5_signals_by_city",
    """SELECT city, risk_level, count(*) AS signals
        FROM fct_fraud_signals AS s LEFT JOIN dim_players AS p ON s.player_id = p.player_id
        GROUP BY city, risk_level""",
)
def _(lake: Lake) -> DataFrame:
    return marts.signals_by_city(lake.signals, lake.players)


@query(
    "b6_signals_by_day",
    f"""SELECT {day('CAST(detected_at AS DATE)')} AS day, signal_type, count(*) AS signals
        FROM fct_fraud_signals GROUP BY CAST(detected_at AS DATE), signal_type""",
)
def _(lake: Lake) -> DataFrame:
    return marts.signals_by_day(lake.signals)


_CARD_SQL = {
    "total": "", "type": "signal_type", "type_and_risk": "signal_type, risk_level",
    "city_and_risk": "city, risk_level", "day_and_type": "day, signal_type",
}


def _cards_sql() -> str:
    parts = []
    for name, by in _CARD_SQL.items():
        listed = by.split(", ") if by else []
        columns = ", ".join(
            c if c in listed else f"CAST(NULL AS {'DATE' if c == 'day' else 'VARCHAR'}) AS {c}"
            for c in ("signal_type", "risk_level", "city", "day")
        )
        of_type = "sum(count(*)) OVER (PARTITION BY signal_type)" if "signal_type" in listed else "NULL"
        parts.append(
            f"""SELECT '{name}' AS card, {columns}, count(*) AS signals, CAST({of_type} AS BIGINT) AS type_signals
            FROM chosen {f"GROUP BY {by}" if by else ""}"""
        )
    rows = " UNION ALL ".join(parts)
    return f"""SELECT card, signal_type, risk_level, city, {day('day')} AS day, signals, type_signals,
          (SELECT count(*) FROM chosen) AS all_signals,
          CAST(signals AS DOUBLE) / (SELECT count(*) FROM chosen) AS share,
          CAST(signals AS DOUBLE) / type_signals AS share_of_type FROM ({rows})"""


@query(
    "adx3_b2_b4_b5_b6_fraud_cards",
    _cards_sql(),
    {
        "chosen": """SELECT signal_type, risk_level, city, CAST(detected_at AS DATE) AS day
          FROM fct_fraud_signals AS s LEFT JOIN dim_players AS p ON s.player_id = p.player_id
          WHERE detected_at >= TIMESTAMP '2024-01-05' AND detected_at < TIMESTAMP '2024-01-21'"""
    },
)
def _(lake: Lake) -> DataFrame:
    """All cards of the fraud page within a selection of dates, and their shares."""
    chosen = Filters(start=date(2024, 1, 5), end=date(2024, 1, 20))
    signals = apply_filters(lake.signals, chosen)
    cards = lake.work.keep("fraud_cards", marts.fraud_cards(signals, lake.players))
    return marts.cards_with_shares(cards)


@query(
    "b7_latest_signals",
    f"""SELECT player_id, signal_type, risk_level, signal_description,
          {ts('detected_at')} AS detected_at FROM (
            SELECT *, rank() OVER (ORDER BY detected_at DESC) AS r FROM fct_fraud_signals)
        WHERE r <= 10""",
)
def _(lake: Lake) -> DataFrame:
    return marts.latest_signals(lake.signals)


@query(
    "b7_adx4_p31_latest_signals_text",
    """SELECT string_agg(player_id || ' - ' || signal_type, ' | '
            ORDER BY detected_at DESC, signal_event_id) AS details
        FROM (SELECT * FROM fct_fraud_signals
              ORDER BY detected_at DESC, signal_event_id LIMIT 10)""",
)
def _(lake: Lake) -> DataFrame:
    return marts.latest_signals_text(lake.signals)


@query(
    "b8_affiliate_kpis",
    f"""SELECT count(DISTINCT affiliate_id) AS total_affiliates,
          CAST(sum(total_ftd) AS BIGINT) AS total_ftd,
          {avg6('sum(CAST(overall_conversion_rate AS DECIMAL(18,2)))', 'count(*)')}
            AS avg_conversion_rate,
          {avg6('sum(CAST(affiliate_roi AS DECIMAL(18,2)))', 'count(*)')} AS avg_roi
        FROM fct_affiliate_performance""",
)
def _(lake: Lake) -> DataFrame:
    return marts.affiliate_kpis(lake.performance)


@query(
    "b9_k3_ftd_by_affiliate",
    f"""SELECT affiliate_id, CAST(sum(total_ftd) AS BIGINT) AS total_ftd,
          {money('sum(total_cpa_revenue)')} AS total_cpa_revenue
        FROM fct_affiliate_performance GROUP BY affiliate_id""",
)
def _(lake: Lake) -> DataFrame:
    return marts.ftd_by_affiliate(lake.performance)


@query(
    "b10_ftd_by_country",
    """SELECT country, CAST(sum(total_ftd) AS BIGINT) AS total_ftd
        FROM fct_affiliate_performance GROUP BY country""",
)
def _(lake: Lake) -> DataFrame:
    return marts.ftd_by_country(lake.performance)


@query(
    "b11_roi_points",
    f"""SELECT affiliate_id, country, total_ftd, affiliate_roi,
          {money('total_cpa_revenue')} AS total_cpa_revenue FROM fct_affiliate_performance""",
)
def _(lake: Lake) -> DataFrame:
    return marts.roi_points(lake.performance)


@query(
    "b12_k2_top_affiliates",
    f"""SELECT affiliate_id, country, total_ftd, {money('total_cpa_revenue')}
          AS total_cpa_revenue, overall_conversion_rate, affiliate_roi
        FROM fct_affiliate_performance
        ORDER BY total_ftd DESC, affiliate_id, country NULLS FIRST LIMIT 10""",
)
def _(lake: Lake) -> DataFrame:
    return marts.top_affiliates(lake.performance)


@query(
    "b13_finance_kpis",
    f"""SELECT {money('sum(total_deposits)')} AS total_deposits, {money('sum(ggr)')} AS total_ggr,
          {avg6('sum(total_deposits)', 'count(*)')} AS arpu,
          {avg6('sum(estimated_ltv)', 'count(*)')} AS avg_ltv FROM fct_financial_summary""",
)
def _(lake: Lake) -> DataFrame:
    return marts.finance_kpis(lake.summary)


@query(
    "b14_k4_ggr_by_city",
    f"SELECT city, {money('sum(ggr)')} AS ggr FROM fct_financial_summary GROUP BY city",
)
def _(lake: Lake) -> DataFrame:
    return marts.ggr_by_city(lake.summary)


@query(
    "b15_adx2_players_by_risk",
    """SELECT risk_classification, count(*) AS players FROM fct_financial_summary
        GROUP BY risk_classification""",
)
def _(lake: Lake) -> DataFrame:
    return marts.players_by_risk(lake.summary)


@query(
    "b16_deposits_and_bets_by_city",
    f"""SELECT city, 'total_deposits' AS measure, {money('sum(total_deposits)')} AS amount
        FROM fct_financial_summary GROUP BY city
        UNION ALL
        SELECT city, 'total_bets', {money('sum(total_bets)')}
        FROM fct_financial_summary GROUP BY city""",
)
def _(lake: Lake) -> DataFrame:
    return marts.deposits_and_bets_by_city(lake.summary)


@query(
    "b17_risky_players",
    f"""SELECT player_id, city, {money('total_deposits')} AS total_deposits,
          {money('total_bets')} AS total_bets, {money('ggr')} AS ggr, risk_classification
        FROM fct_financial_summary WHERE risk_classification <> 'NORMAL'""",
)
def _(lake: Lake) -> DataFrame:
    return marts.risky_players(lake.summary)


@query(
    "b18_high_risk_share",
    """SELECT CAST(count(*) FILTER (WHERE risk_level = 'HIGH') AS DOUBLE) / count(*)
          AS high_risk_share FROM fct_fraud_signals""",
)
def _(lake: Lake) -> DataFrame:
    return marts.high_risk_share(lake.signals)


@query("b19_total_accounts", "SELECT count(*) AS total_accounts FROM dim_players")
def _(lake: Lake) -> DataFrame:
    return marts.total_accounts(lake.players)


