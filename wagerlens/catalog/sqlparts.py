"""Shared parts of the check SQL: the tables as named subqueries, and text helpers.

The SQL states each result in the plainest way, without the rewrites the Spark models use.
"""

from __future__ import annotations

import re

from wagerlens.functions.text import NULL_KEY_PART

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def money(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def pct(num: str, den: str) -> str:
    """Percentage with two digits of whole numbers, rounded half away from zero."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"CASE WHEN {den} > 0 THEN CAST(sign({num}) * ((20000 * abs({n}) + {d}) // (2 * {d}))"
        f" AS DOUBLE) / 100 ELSE 0 END"
    )


def avg6(total: str, n: str) -> str:
    """Average with six digits of an amount with two, rounded half away from zero."""
    cents = f"CAST(abs({total}) * 100 AS HUGEINT)"
    return (
        f"CASE WHEN {n} > 0 THEN CAST(sign({total}) * ((20000 * {cents} + {n}) // (2 * {n}))"
        f" AS DOUBLE) / 1000000 END"
    )


def key(*parts: str) -> str:
    cols = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '{NULL_KEY_PART}')" for p in parts)
    return f"md5(concat_ws('-', {cols}))"


def amount_text(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.?0+$', '')"


_EVENT_DAY = "date_trunc('day', ts)"

_EVENT_DEVICE = (
    "CASE event_id % 3 WHEN 0 THEN ' Android' WHEN 1 THEN 'iOS ' ELSE 'DESKTOP' END"
)

_REDELIVERY = "(VALUES (0), (1)) AS d(again)"


def _deliveries(day_expr: str) -> str:
    return f"CAST({day_expr} AS TIMESTAMP) + INTERVAL 1 DAY * (1 + again)"


RELATIONS = {
    "raw_players": """
        SELECT CAST(c_custkey AS VARCHAR) AS player_id,
               '  ' || c_name || '@Example.COM ' AS email,
               CASE WHEN n_name <> 'NATION_24' THEN ' ' || n_name || ' ' END AS city,
               CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS created_at,
               TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_sessions": f"""
        SELECT 'S' || event_id AS session_id, CAST(user_id AS VARCHAR) AS player_id,
               ' 10.' || (user_id // 2) || '.0.'
                 || (CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 20) AS ip,
               CASE WHEN again = 1 THEN 'desktop' ELSE {_EVENT_DEVICE} END AS device,
               ts AS "timestamp", {_deliveries(_EVENT_DAY)} AS _ingested_at
        FROM events, {_REDELIVERY} WHERE again = 0 OR event_id % 50 = 0""",
    "raw_transactions": f"""
        SELECT transaction_id, player_id, type, amount + again AS amount, "timestamp",
               {_deliveries("date_trunc('day', \"timestamp\")")} AS _ingested_at
        FROM (
          SELECT o_orderkey AS k, 'O' || o_orderkey AS transaction_id,
                 CAST(o_custkey AS VARCHAR) AS player_id,
                 CASE o_orderstatus WHEN 'F' THEN ' BET' WHEN 'O' THEN 'Deposit '
                   ELSE 'withdraw' END AS type,
                 o_totalprice AS amount, CAST(DATE '2020-02-01' + CAST(date_diff('day',
                   DATE '1992-01-01', CAST(o_orderdate AS DATE)) % 1400 AS INTEGER) AS TIMESTAMP)
                   AS "timestamp"
          FROM orders
          UNION ALL
          SELECT event_id, 'E' || event_id, CAST(user_id AS VARCHAR),
                 CASE event_type WHEN 'click' THEN ' BET' WHEN 'purchase' THEN 'Deposit '
                   ELSE 'withdraw' END, value, ts
          FROM events WHERE event_type IN ('click', 'purchase', 'signup')
        ) AS t, {_REDELIVERY} WHERE again = 0 OR k % 50 = 0""",
    "raw_affiliates": """
        SELECT 'A' || l_suppkey AS affiliate_id, CAST(o_custkey AS VARCHAR) AS player_id,
               CASE WHEN n_name <> 'NATION_0' THEN ' ' || lower(n_name) END AS country,
               CAST(l_quantity AS BIGINT) * (l_partkey % 7) AS clicks,
               CAST(l_quantity AS BIGINT) AS registrations,
               CAST(l_returnflag = 'N' AS BIGINT) AS ftd,
               floor(abs(s_acctbal)) / 4 AS cpa_value,
               CAST(l_shipdate AS TIMESTAMP) AS _ingested_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "stg_players": """
        SELECT player_id, lower(trim(email)) AS email, trim(city) AS city, created_at,
               _ingested_at FROM raw_players""",
    "stg_sessions": """
        SELECT session_id, player_id, trim(ip) AS ip, lower(trim(device)) AS device,
               "timestamp" AS session_timestamp, _ingested_at FROM raw_sessions""",
    "stg_transactions": """
        SELECT transaction_id, player_id, lower(trim(type)) AS transaction_type,
               CAST(amount AS DECIMAL(10,2)) AS amount, "timestamp" AS transaction_timestamp,
               _ingested_at FROM raw_transactions""",
    "stg_affiliates": """
        SELECT affiliate_id, player_id, upper(trim(country)) AS country, clicks, registrations,
               ftd AS ftd_count, CAST(cpa_value AS DECIMAL(10,2)) AS cpa_value, _ingested_at
        FROM raw_affiliates""",
    "dim_players": """
        SELECT player_id, email, city, created_at, _ingested_at FROM stg_players
        QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY _ingested_at DESC,
          email DESC, city DESC NULLS LAST, created_at DESC) = 1""",
    "dim_sessions": """
        SELECT session_id, player_id, ip, device, session_timestamp,
               CAST(session_timestamp AS DATE) AS session_date,
               CAST(hour(session_timestamp) AS INTEGER) AS session_hour,
               CAST(dayofweek(session_timestamp) + 1 AS INTEGER) AS day_of_week, _ingested_at
        FROM stg_sessions
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY _ingested_at DESC,
          session_timestamp DESC, player_id DESC, ip DESC, device DESC) = 1""",
    "fct_transactions": """
        SELECT transaction_id, player_id, transaction_type, amount, transaction_timestamp,
               CAST(transaction_timestamp AS DATE) AS transaction_date,
               CAST(hour(transaction_timestamp) AS INTEGER) AS transaction_hour,
               CASE transaction_type WHEN 'deposit' THEN amount ELSE 0 END AS deposit_amount,
               CASE transaction_type WHEN 'withdraw' THEN amount ELSE 0 END AS withdraw_amount,
               CASE transaction_type WHEN 'bet' THEN amount ELSE 0 END AS bet_amount,
               _ingested_at
        FROM stg_transactions
        QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY _ingested_at DESC,
          transaction_timestamp DESC, player_id DESC, transaction_type DESC, amount DESC) = 1""",
    "dim_affiliates": f"""
        SELECT affiliate_id, player_id, country, clicks, registrations, ftd_count, cpa_value,
               {pct('registrations', 'clicks')} AS conversion_rate,
               {pct('ftd_count', 'registrations')} AS ftd_rate,
               CAST(ftd_count * cpa_value AS DECIMAL(18,2)) AS total_cpa_value, _ingested_at
        FROM stg_affiliates
        QUALIFY row_number() OVER (PARTITION BY affiliate_id, player_id
          ORDER BY _ingested_at DESC, clicks DESC, registrations DESC, ftd_count DESC,
          cpa_value DESC, country DESC NULLS LAST) = 1""",
    "ip_sharing": """
        SELECT ip, count(DISTINCT player_id) AS distinct_players,
               min(session_timestamp) AS first_seen, max(session_timestamp) AS last_seen
        FROM dim_sessions WHERE ip IS NOT NULL GROUP BY ip
        HAVING count(DISTINCT player_id) > 1""",
    "device_sharing": """
        SELECT device, count(DISTINCT player_id) AS distinct_players,
               min(session_timestamp) AS first_seen, max(session_timestamp) AS last_seen
        FROM dim_sessions WHERE device IS NOT NULL GROUP BY device
        HAVING count(DISTINCT player_id) > 5""",
    "per_player": """
        SELECT player_id, count(DISTINCT transaction_date) AS active_days,
               min(transaction_timestamp) AS first_transaction,
               max(transaction_timestamp) AS last_transaction,
               sum(deposit_amount) AS total_deposits,
               count(*) FILTER (WHERE transaction_type = 'deposit') AS deposit_count,
               sum(withdraw_amount) AS total_withdrawals,
               count(*) FILTER (WHERE transaction_type = 'withdraw') AS withdrawal_count,
               sum(bet_amount) AS total_bets,
               count(*) FILTER (WHERE transaction_type = 'bet') AS bet_count
        FROM fct_transactions GROUP BY player_id""",
    "no_bets": """
        SELECT * FROM per_player WHERE total_deposits > 0 AND total_bets = 0""",
    "rapid_pairs": """
        SELECT d.player_id, d.transaction_id AS deposit_id, w.transaction_id AS withdraw_id,
               d.transaction_timestamp AS deposit_time, w.transaction_timestamp AS withdraw_time,
               d.amount AS deposit_amount, w.amount AS withdraw_amount,
               date_sub('minute', d.transaction_timestamp, w.transaction_timestamp)
                 AS minutes_between
        FROM fct_transactions AS d JOIN fct_transactions AS w ON d.player_id = w.player_id
        WHERE d.transaction_type = 'deposit' AND w.transaction_type = 'withdraw'
          AND w.transaction_timestamp > d.transaction_timestamp
          AND date_sub('minute', d.transaction_timestamp, w.transaction_timestamp) < 60""",
    "sig_ip": """
        SELECT DISTINCT s.player_id, 'MULTI_ACCOUNTING' AS signal_type,
               'IP compartilhado entre ' || g.distinct_players || ' jogadores'
                 AS signal_description, 'HIGH' AS risk_level, g.first_seen AS detected_at,
               g.distinct_players AS related_count, ip AS related_group
        FROM ip_sharing AS g JOIN dim_sessions AS s USING (ip)""",
    "sig_no_bet": f"""
        SELECT player_id, 'DEPOSIT_WITHOUT_BET' AS signal_type,
               'Depositos totais: $' || {amount_text('total_deposits')} || ' sem nenhuma aposta'
                 AS signal_description, 'MEDIUM' AS risk_level, {AS_OF} AS detected_at,
               CAST(NULL AS BIGINT) AS related_count,
               CAST(NULL AS VARCHAR) AS related_group
        FROM no_bets""",
    "sig_device": f"""
        SELECT DISTINCT s.player_id, 'DEVICE_SHARING' AS signal_type,
               'Device ' || device || ' usado por ' || g.distinct_players || ' jogadores'
                 AS signal_description, 'MEDIUM' AS risk_level, {AS_OF} AS detected_at,
               g.distinct_players AS related_count, device AS related_group
        FROM device_sharing AS g JOIN dim_sessions AS s USING (device)""",
    "sig_rapid": f"""
        SELECT player_id, 'RAPID_DEPOSIT_WITHDRAW' AS signal_type,
               'Deposito de $' || {amount_text('deposit_amount')} || ' e saque de $'
                 || {amount_text('withdraw_amount')} || ' em ' || minutes_between || ' minutos'
                 AS signal_description, 'HIGH' AS risk_level, deposit_time AS detected_at,
               CAST(NULL AS BIGINT) AS related_count,
               CAST(NULL AS VARCHAR) AS related_group,
               {key("'RAPID_DEPOSIT_WITHDRAW'", 'player_id', 'deposit_id', 'withdraw_id')}
                 AS signal_event_id
        FROM rapid_pairs""",
    "fct_fraud_signals": f"""
        SELECT {key('player_id', 'signal_type', ts('detected_at'))} AS fraud_signal_id, *
        FROM (
          SELECT *, {key('signal_type', 'player_id', 'related_group')} AS signal_event_id
          FROM sig_ip
          UNION ALL BY NAME
          SELECT *, {key('signal_type', 'player_id')} AS signal_event_id FROM sig_no_bet
          UNION ALL BY NAME
          SELECT *, {key('signal_type', 'player_id', 'related_group')} AS signal_event_id
          FROM sig_device
          UNION ALL BY NAME
          SELECT * FROM sig_rapid
        )""",
    "referral_revenue": """
        SELECT a.affiliate_id, a.country, sum(p.total_deposits) AS dep, sum(p.total_bets) AS bets,
               sum(p.total_withdrawals) AS wd
        FROM dim_affiliates AS a JOIN per_player AS p ON a.player_id = p.player_id
        WHERE a.country IS NOT NULL GROUP BY a.affiliate_id, a.country""",
    "affiliate_groups": """
        SELECT affiliate_id, country, count(DISTINCT player_id) AS total_players,
               sum(clicks) AS total_clicks, sum(registrations) AS total_registrations,
               sum(ftd_count) AS total_ftd, sum(total_cpa_value) AS total_cpa_revenue,
               sum(cpa_value) AS cpa_sum, count(cpa_value) AS cpa_rows
        FROM dim_affiliates GROUP BY affiliate_id, country""",
    "fct_affiliate_performance": f"""
        SELECT {key('g.affiliate_id', 'g.country')} AS affiliate_performance_id,
               g.affiliate_id, g.country, total_players,
               CAST(total_clicks AS BIGINT) AS total_clicks,
               CAST(total_registrations AS BIGINT) AS total_registrations,
               CAST(total_ftd AS BIGINT) AS total_ftd, total_cpa_revenue,
               {avg6('cpa_sum', 'cpa_rows')} AS avg_cpa_value,
               {pct('total_registrations', 'total_clicks')} AS overall_conversion_rate,
               {pct('total_ftd', 'total_registrations')} AS overall_ftd_rate,
               coalesce(dep, 0) AS player_total_deposits, coalesce(bets, 0) AS player_total_bets,
               coalesce(wd, 0) AS player_total_withdrawals,
               coalesce(bets - wd, 0) AS player_net_revenue,
               {pct('((coalesce(bets - wd, 0) - total_cpa_revenue) * 100)',
                    '(total_cpa_revenue * 100)')} AS affiliate_roi
        FROM affiliate_groups AS g LEFT JOIN referral_revenue AS r
          ON g.affiliate_id = r.affiliate_id AND g.country = r.country""",
    "metrics": f"""
        SELECT p.*, d.city, d.created_at,
               {avg6('total_deposits', 'deposit_count')} AS avg_deposit,
               {avg6('total_withdrawals', 'withdrawal_count')} AS avg_withdrawal,
               {avg6('total_bets', 'bet_count')} AS avg_bet,
               total_bets - total_withdrawals AS ggr,
               total_deposits - total_withdrawals AS net_deposit,
               total_deposits AS estimated_ltv,
               date_diff('day', CAST(first_transaction AS DATE), CAST(last_transaction AS DATE))
                 AS customer_lifespan_days
        FROM per_player AS p JOIN dim_players AS d ON p.player_id = d.player_id""",
    "cities": f"""
        SELECT city, count(DISTINCT player_id) AS total_players,
               sum(total_deposits) AS city_total_deposits,
               sum(total_withdrawals) AS city_total_withdrawals,
               sum(total_bets) AS city_total_bets, sum(ggr) AS city_ggr,
               {avg6('sum(total_deposits)', 'count(total_deposits)')} AS avg_deposits_per_player,
               {avg6('sum(total_bets)', 'count(total_bets)')} AS avg_bets_per_player
        FROM metrics GROUP BY city""",
    "everyone": f"""
        SELECT count(DISTINCT player_id) AS total_active_players,
               sum(total_deposits) AS global_total_deposits,
               sum(total_withdrawals) AS global_total_withdrawals,
               sum(total_bets) AS global_total_bets, sum(ggr) AS global_ggr,
               {avg6('sum(total_deposits)', 'count(DISTINCT player_id)')} AS arpu_deposits,
               {avg6('sum(total_bets)', 'count(DISTINCT player_id)')} AS arpu_bets
        FROM metrics""",
    "fct_financial_summary": """
        SELECT m.*, c.total_players AS city_total_players, c.city_total_deposits,
               c.city_total_withdrawals, c.city_total_bets, c.city_ggr,
               c.avg_deposits_per_player AS city_avg_deposits,
               c.avg_bets_per_player AS city_avg_bets, e.*,
               CASE WHEN m.total_deposits > 0 AND m.total_bets = 0 THEN 'HIGH_RISK_NO_BETS'
                    WHEN m.total_withdrawals > m.total_deposits THEN 'HIGH_RISK_OVER_WITHDRAWAL'
                    WHEN m.active_days <= 2 AND m.total_deposits > 1000
                      THEN 'MEDIUM_RISK_NEW_HIGH_VALUE'
                    ELSE 'NORMAL' END AS risk_classification
        FROM metrics AS m LEFT JOIN cities AS c ON m.city = c.city CROSS JOIN everyone AS e""",
}


def _needed(sql: str, relations: dict[str, str]) -> list[str]:
    found: list[str] = []

    def visit(text: str) -> None:
        for name in relations:
            if name not in found and re.search(rf"\b{name}\b", text):
                visit_name(name)

    def visit_name(name: str) -> None:
        visit(relations[name].replace(name, ""))
        if name not in found:
            found.append(name)

    visit(sql)
    return found


def with_relations(sql: str, overrides: dict[str, str] | None = None) -> str:
    """The query with the subqueries it needs in front, in order of use."""
    relations = RELATIONS | (overrides or {})
    parts = [f"{n} AS ({relations[n].strip()})" for n in _needed(sql, relations)]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
