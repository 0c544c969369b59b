"""Whole models: staging, silver, gold and the tables next to them."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.catalog.lake import AS_OF, Lake
from wagerlens.catalog.registry import query
from wagerlens.catalog.sqlparts import avg6, day, money, ts
from wagerlens.operators.bitmaps import dense_numbers, distinct_counts, merged_sets
from wagerlens.operators.sharing import PAGE_PLAYERS
from wagerlens.plans import affiliates, finance, fraud, silver

STG_SQL = {
    "players": f"SELECT player_id, email, city, {day('created_at')} AS created_at,"
    f" {ts('_ingested_at')} AS _ingested_at FROM stg_players",
    "sessions": f"SELECT session_id, player_id, ip, device,"
    f" {ts('session_timestamp')} AS session_timestamp,"
    f" {ts('_ingested_at')} AS _ingested_at FROM stg_sessions",
    "transactions": f"SELECT transaction_id, player_id, transaction_type,"
    f" {money('amount')} AS amount, {ts('transaction_timestamp')} AS transaction_timestamp,"
    f" {ts('_ingested_at')} AS _ingested_at FROM stg_transactions",
    "affiliates": f"SELECT affiliate_id, player_id, country, clicks, registrations, ftd_count,"
    f" {money('cpa_value')} AS cpa_value, {ts('_ingested_at')} AS _ingested_at"
    f" FROM stg_affiliates",
}

SILVER_SQL = {
    "dim_players": f"SELECT player_id, email, city, {day('created_at')} AS created_at,"
    f" {ts('_ingested_at')} AS _ingested_at FROM dim_players",
    "dim_sessions": f"SELECT session_id, player_id, ip, device,"
    f" {ts('session_timestamp')} AS session_timestamp, {day('session_date')} AS session_date,"
    f" session_hour, day_of_week, {ts('_ingested_at')} AS _ingested_at FROM dim_sessions",
    "fct_transactions": f"SELECT transaction_id, player_id, transaction_type,"
    f" {money('amount')} AS amount, {ts('transaction_timestamp')} AS transaction_timestamp,"
    f" {day('transaction_date')} AS transaction_date, transaction_hour,"
    f" {money('deposit_amount')} AS deposit_amount, {money('withdraw_amount')} AS withdraw_amount,"
    f" {money('bet_amount')} AS bet_amount, {ts('_ingested_at')} AS _ingested_at"
    f" FROM fct_transactions",
    "dim_affiliates": f"SELECT affiliate_id, player_id, country, clicks, registrations, ftd_count,"
    f" {money('cpa_value')} AS cpa_value, conversion_rate, ftd_rate,"
    f" {money('total_cpa_value')} AS total_cpa_value, {ts('_ingested_at')} AS _ingested_at"
    f" FROM dim_affiliates",
}

_SIGNAL_LIST = (
    f"player_id, signal_type, signal_description, risk_level, {ts('detected_at')} AS detected_at,"
    f" related_count, related_group, signal_event_id"
)

SIGNALS_SQL = f"SELECT fraud_signal_id, {_SIGNAL_LIST} FROM fct_fraud_signals"


def one_signal_sql(kind: str) -> str:
    return f"SELECT {_SIGNAL_LIST} FROM fct_fraud_signals WHERE signal_type = '{kind}'"


_MONEY_COLUMNS = {
    "total_deposits", "total_withdrawals", "total_bets", "ggr", "net_deposit", "estimated_ltv",
    "city_total_deposits", "city_total_withdrawals", "city_total_bets", "city_ggr",
    "global_total_deposits", "global_total_withdrawals", "global_total_bets", "global_ggr",
}


def _summary_column(c: str) -> str:
    if c in _MONEY_COLUMNS:
        return f"{money(c)} AS {c}"
    if c == "created_at":
        return f"{day(c)} AS {c}"
    if c in ("first_transaction", "last_transaction"):
        return f"{ts(c)} AS {c}"
    return c


SUMMARY_SQL = (
    f"SELECT {', '.join(_summary_column(c) for c in finance.SUMMARY_COLUMNS)}"
    f" FROM fct_financial_summary"
)

_PERFORMANCE_MONEY = [
    "total_cpa_revenue", "player_total_deposits", "player_total_bets",
    "player_total_withdrawals", "player_net_revenue",
]

PERFORMANCE_SQL = (
    "SELECT affiliate_performance_id, affiliate_id, country, total_players, total_clicks,"
    " total_registrations, total_ftd, avg_cpa_value, overall_conversion_rate, overall_ftd_rate,"
    f" affiliate_roi, {', '.join(f'{money(c)} AS {c}' for c in _PERFORMANCE_MONEY)}"
    " FROM fct_affiliate_performance"
)


@query("m1_stg_players", STG_SQL["players"])
def _(lake: Lake) -> DataFrame:
    return lake.staging("players")


@query("m2_stg_sessions", STG_SQL["sessions"])
def _(lake: Lake) -> DataFrame:
    return lake.staging("sessions")


@query("m3_stg_transactions", STG_SQL["transactions"])
def _(lake: Lake) -> DataFrame:
    return lake.staging("transactions")


@query("m4_stg_affiliates", STG_SQL["affiliates"])
def _(lake: Lake) -> DataFrame:
    return lake.staging("affiliates")


@query("m5_w1_dim_players", SILVER_SQL["dim_players"])
def _(lake: Lake) -> DataFrame:
    return lake.silver_model("dim_players")


@query("m6_w2_dim_sessions", SILVER_SQL["dim_sessions"])
def _(lake: Lake) -> DataFrame:
    return lake.silver_model("dim_sessions")


@query("m7_w3_fct_transactions", SILVER_SQL["fct_transactions"])
def _(lake: Lake) -> DataFrame:
    return lake.silver_model("fct_transactions")


@query("m8_w4_dim_affiliates", SILVER_SQL["dim_affiliates"])
def _(lake: Lake) -> DataFrame:
    return lake.silver_model("dim_affiliates")


@query("m9_fct_fraud_signals", SIGNALS_SQL)
def _(lake: Lake) -> DataFrame:
    return lake.gold_model("fct_fraud_signals")


@query("m9a_multi_accounting", one_signal_sql("MULTI_ACCOUNTING"))
def _(lake: Lake) -> DataFrame:
    return fraud.multi_accounting(lake.sessions, lake.work)


@query("m9b_deposit_without_bet", one_signal_sql("DEPOSIT_WITHOUT_BET"))
def _(lake: Lake) -> DataFrame:
    return fraud.deposit_without_bet(lake.totals, AS_OF)


@query("m9c_device_sharing", one_signal_sql("DEVICE_SHARING"))
def _(lake: Lake) -> DataFrame:
    return fraud.device_signals(lake.sessions, AS_OF, lake.work)


@query("m9d_rapid_deposit_withdraw", one_signal_sql("RAPID_DEPOSIT_WITHDRAW"))
def _(lake: Lake) -> DataFrame:
    return fraud.rapid_deposit_withdraw(lake.tx)


# The page of a player, by the default size of pages.
_PAGES = f"CAST(ceil(distinct_players / {PAGE_PLAYERS}.0) AS BIGINT)"
_PAGE = f"CAST(CAST('0x' || substr(md5(player_id), 1, 8) AS BIGINT) % {_PAGES} AS INTEGER)"
PAGES_SQL = f"""SELECT kind, related_group, distinct_players, page, count(*) AS page_players,
          string_agg(player_id, ', ' ORDER BY player_id) AS related_players
        FROM (
          SELECT DISTINCT 'device' AS kind, g.device AS related_group, distinct_players,
                 s.player_id, {_PAGE} AS page
          FROM device_sharing AS g JOIN dim_sessions AS s ON g.device = s.device
          UNION ALL
          SELECT DISTINCT 'ip', g.ip, distinct_players, s.player_id, {_PAGE}
          FROM ip_sharing AS g JOIN dim_sessions AS s ON g.ip = s.ip
        ) WHERE player_id IS NOT NULL GROUP BY kind, related_group, distinct_players, page"""


@query("m9_related_player_pages", PAGES_SQL)
def _(lake: Lake) -> DataFrame:
    return fraud.related_player_pages(lake.sessions, lake.work)


@query("m10_fct_affiliate_performance", PERFORMANCE_SQL)
def _(lake: Lake) -> DataFrame:
    return lake.gold_model("fct_affiliate_performance")


@query("m11_fct_financial_summary", SUMMARY_SQL)
def _(lake: Lake) -> DataFrame:
    return lake.gold_model("fct_financial_summary")


@query(
    "m12_bridge_player_sessions",
    f"""SELECT s.player_id, session_id, {ts('session_timestamp')} AS session_timestamp, ip, device,
          city, {day('p.created_at')} AS player_created_at,
          CAST(date_diff('day', p.created_at, session_date) AS INTEGER) AS days_since_signup
        FROM dim_sessions AS s JOIN dim_players AS p ON s.player_id = p.player_id""",
)
def _(lake: Lake) -> DataFrame:
    return silver.bridge_player_sessions(lake.sessions, lake.players)


@query(
    "m13_fct_multi_accounting",
    f"""SELECT 'ip' AS kind, ip AS shared_value, distinct_players,
          {ts('first_seen')} AS first_seen, {ts('last_seen')} AS last_seen FROM ip_sharing
        UNION ALL
        SELECT 'device', device, distinct_players, {ts('first_seen')}, {ts('last_seen')}
        FROM device_sharing""",
)
def _(lake: Lake) -> DataFrame:
    return fraud.multi_accounting_groups(lake.sessions)


@query(
    "m14_a2_deposit_without_bet",
    f"""SELECT player_id, {money('total_deposits')} AS total_deposits,
          {money('total_bets')} AS total_bets, {money('total_withdrawals')} AS total_withdrawals,
          deposit_count, bet_count FROM no_bets""",
)
def _(lake: Lake) -> DataFrame:
    return fraud.player_deposits_without_bet(lake.totals)


@query(
    "m15_fct_affiliate_fraud",
    """SELECT affiliate_id, count(a.player_id) AS total_players, count(n) AS flagged_players,
          CAST(coalesce(sum(n), 0) AS BIGINT) AS total_signals,
          CAST(count(n) AS DOUBLE) / count(a.player_id) AS flagged_share,
          2 * count(n) >= count(a.player_id) AS suspicious
        FROM dim_affiliates AS a LEFT JOIN flagged AS f ON a.player_id = f.player_id
        GROUP BY affiliate_id""",
    {"flagged": "SELECT player_id, count(*) AS n FROM fct_fraud_signals GROUP BY player_id"},
)
def _(lake: Lake) -> DataFrame:
    return affiliates.affiliate_fraud(lake.affiliates, lake.signals)


@query(
    "m16_fct_player_ltv",
    f"""SELECT player_id, city, {money('estimated_ltv')} AS estimated_ltv, customer_lifespan_days,
          active_days, arpu_deposits, arpu_bets FROM fct_financial_summary""",
)
def _(lake: Lake) -> DataFrame:
    return finance.player_ltv(lake.summary)


@query(
    "m17_net_gaming_revenue",
    f"""SELECT m.player_id, {money('ggr')} AS ggr, {money('coalesce(cost, 0)')} AS cpa_cost,
          {money('ggr - coalesce(cost, 0)')} AS ngr
        FROM metrics AS m LEFT JOIN cpa AS c ON m.player_id = c.player_id""",
    {"cpa": "SELECT player_id, sum(total_cpa_value) AS cost FROM dim_affiliates GROUP BY 1"},
)
def _(lake: Lake) -> DataFrame:
    return finance.net_gaming_revenue(lake.summary, lake.affiliates)


@query(
    "m18_ip_logins_per_hour",
    f"""SELECT ip, {ts('start')} AS hour_start, count(*) AS logins,
          count(DISTINCT player_id) AS distinct_players
        FROM (SELECT ip, player_id, time_bucket(INTERVAL 10 MINUTE, session_timestamp)
                - INTERVAL 10 MINUTE * k AS start
              FROM dim_sessions, (VALUES (0), (1), (2), (3), (4), (5)) AS s(k)
              WHERE ip IS NOT NULL)
        GROUP BY ip, start""",
)
def _(lake: Lake) -> DataFrame:
    return fraud.ip_logins_per_hour(lake.sessions)


_TRAILING_SQL = """SELECT a.ip, a.t AS login_time, count(*) AS logins,
          count(DISTINCT b.player_id) AS distinct_players
        FROM (SELECT DISTINCT ip, session_timestamp AS t FROM dim_sessions
              WHERE ip IS NOT NULL AND session_timestamp IS NOT NULL) AS a
        JOIN dim_sessions AS b ON a.ip = b.ip AND b.session_timestamp <= a.t
          AND b.session_timestamp > a.t - INTERVAL 1 HOUR
        GROUP BY a.ip, a.t"""


@query(
    "m18_trailing_hour",
    f"SELECT ip, {ts('login_time')} AS login_time, logins, distinct_players FROM ({_TRAILING_SQL})",
)
def _(lake: Lake) -> DataFrame:
    return fraud.trailing_hour(lake.sessions)


@query(
    "m18_busiest_hours",
    f"""SELECT ip, max(logins) AS peak_logins, max(distinct_players) AS peak_players,
          {ts('arg_min(login_time, (-logins, login_time))')} AS peak_logins_at,
          {ts('arg_min(login_time, (-distinct_players, login_time))')} AS peak_players_at
        FROM ({_TRAILING_SQL}) GROUP BY ip""",
)
def _(lake: Lake) -> DataFrame:
    return fraud.busiest_hours(lake.sessions)


@query(
    "m19_period_totals",
    f"""SELECT {day("date_trunc('month', transaction_date)")} AS period, transaction_type,
          count(*) AS transactions, {money('sum(amount)')} AS total_amount,
          {avg6('sum(amount)', 'count(amount)')} AS avg_amount
        FROM fct_transactions GROUP BY date_trunc('month', transaction_date), transaction_type""",
)
def _(lake: Lake) -> DataFrame:
    return finance.period_totals(lake.tx, "month")


def _player_sets(lake: Lake) -> DataFrame:
    numbers = lake.work.keep("player_numbers", dense_numbers(lake.tx, "player_id"))
    return lake.work.keep("player_sets", finance.active_player_sets(lake.tx, lake.players, numbers))


_PERIODS = {"day": ["transaction_type"], "week": [], "month": ["transaction_type", "city"], "year": ["city"]}


@query(
    "m19_active_players_by_period",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS period, {day(f"date_trunc('{p}', transaction_date)")} AS start,
          {'transaction_type' if 'transaction_type' in by else 'CAST(NULL AS VARCHAR)'} AS transaction_type,
          {'city' if 'city' in by else 'CAST(NULL AS VARCHAR)'} AS city,
          count(DISTINCT t.player_id) AS players
        FROM fct_transactions t LEFT JOIN dim_players p ON p.player_id = t.player_id
        WHERE t.player_id IS NOT NULL
        GROUP BY {', '.join([f"date_trunc('{p}', transaction_date)", *by])}"""
        for p, by in _PERIODS.items()
    ),
)
def _(lake: Lake) -> DataFrame:
    """Distinct players per day, week, month and year, all rolled up from one table of sets."""
    sets, none = _player_sets(lake), F.lit(None).cast("string")
    return reduce(
        DataFrame.unionByName,
        [
            finance.active_players(sets, p, by).select(
                F.lit(p).alias("period"), "start",
                *[(F.col(c) if c in by else none).alias(c) for c in ("transaction_type", "city")],
                "players",
            )
            for p, by in _PERIODS.items()
        ],
    )


@query(
    "acd_active_players_of_a_selection",
    """SELECT transaction_type, count(DISTINCT t.player_id) AS players
        FROM fct_transactions t JOIN dim_players p ON p.player_id = t.player_id
        WHERE transaction_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-18'
          AND city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')
        GROUP BY transaction_type
        UNION ALL
        SELECT 'any', count(DISTINCT t.player_id)
        FROM fct_transactions t JOIN dim_players p ON p.player_id = t.player_id
        WHERE transaction_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-18'
          AND city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')""",
)
def _(lake: Lake) -> DataFrame:
    """Distinct players of a dashboard's filters, by type and over all types, from the same sets; the
    sets of two halves of the transactions are merged first, as after two loads."""
    numbers = lake.work.keep("player_numbers", dense_numbers(lake.tx, "player_id"))
    late = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 1
    sets = merged_sets(
        *[finance.active_player_sets(lake.tx.filter(half), lake.players, numbers) for half in (late, ~late)]
    )
    chosen = sets.filter(
        F.col("transaction_date").between(date(2024, 1, 5), date(2024, 1, 18))
        & F.col("city").isin("NATION_1", "NATION_2", "NATION_3", "NATION_4")
    )
    total = distinct_counts(chosen, [F.lit("any").alias("transaction_type")], "players")
    return distinct_counts(chosen, ["transaction_type"], "players").unionByName(total)
