"""The building blocks of the models, each as a query of its own."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.catalog.lake import Lake
from wagerlens.catalog.models import PAGES_SQL
from wagerlens.catalog.registry import query
from wagerlens.catalog.sqlparts import amount_text, avg6, key, money, pct, ts
from wagerlens.functions.measures import percent, risk_class, safe_ratio
from wagerlens.functions.text import money_text, surrogate_key
from wagerlens.operators.dedup import numbered
from wagerlens.operators.filters import Filters, apply_filters, between_dates, not_normal
from wagerlens.operators.quality import orphans
from wagerlens.operators.topk import top_rows, top_with_ties
from wagerlens.plans import affiliates, finance, fraud, marts
from wagerlens.sources.bronze import high_water_mark

# --- scalar functions ---


@query(
    "p3_p4_p5_clean_text",
    """SELECT 'email' AS field, lower(trim(email)) AS value, count(*) AS n
        FROM raw_players GROUP BY 1, 2
        UNION ALL SELECT 'city', trim(city), count(*) FROM raw_players GROUP BY 1, 2
        UNION ALL SELECT 'device', lower(trim(device)), count(*) FROM raw_sessions GROUP BY 1, 2
        UNION ALL SELECT 'type', lower(trim(type)), count(*) FROM raw_transactions GROUP BY 1, 2
        UNION ALL SELECT 'country', upper(trim(country)), count(*) FROM raw_affiliates
          GROUP BY 1, 2""",
)
def _(lake: Lake) -> DataFrame:
    out = None
    for dataset, field, column in (
        ("players", "email", "email"),
        ("players", "city", "city"),
        ("sessions", "device", "device"),
        ("transactions", "type", "transaction_type"),
        ("affiliates", "country", "country"),
    ):
        counted = (
            lake.staging(dataset)
            .groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(field).alias("field"), "value", "n")
        )
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "p6_p11_p12_sessions_by_hour_and_weekday",
    """SELECT day_of_week, session_hour, count(DISTINCT session_date) AS days,
          count(*) AS sessions
        FROM dim_sessions GROUP BY day_of_week, session_hour""",
)
def _(lake: Lake) -> DataFrame:
    return lake.sessions.groupBy("day_of_week", "session_hour").agg(
        F.count_distinct("session_date").alias("days"), F.count(F.lit(1)).alias("sessions")
    )


@query(
    "p13_amounts_by_type",
    f"""SELECT transaction_type, {money('sum(deposit_amount)')} AS deposit_amount,
          {money('sum(withdraw_amount)')} AS withdraw_amount,
          {money('sum(bet_amount)')} AS bet_amount
        FROM fct_transactions GROUP BY transaction_type""",
)
def _(lake: Lake) -> DataFrame:
    return lake.tx.groupBy("transaction_type").agg(
        *[F.sum(c).alias(c) for c in ("deposit_amount", "withdraw_amount", "bet_amount")]
    )


@query(
    "p14_p16_row_rates",
    f"""SELECT affiliate_id, player_id, {pct('registrations', 'clicks')} AS conversion_rate,
          {pct('ftd_count', 'registrations')} AS ftd_rate,
          {money('round(ftd_count * cpa_value, 2)')} AS total_cpa_value FROM dim_affiliates""",
)
def _(lake: Lake) -> DataFrame:
    return lake.affiliates.select(
        "affiliate_id",
        "player_id",
        percent("registrations", "clicks").alias("conversion_rate"),
        percent("ftd_count", "registrations").alias("ftd_rate"),
        F.round(F.col("ftd_count") * F.col("cpa_value"), 2).alias("total_cpa_value"),
    )


@query(
    "p15_p17_group_rates_and_roi",
    """SELECT affiliate_id, country, overall_conversion_rate, overall_ftd_rate, affiliate_roi
        FROM fct_affiliate_performance""",
)
def _(lake: Lake) -> DataFrame:
    return lake.performance.select(
        "affiliate_id", "country", "overall_conversion_rate", "overall_ftd_rate", "affiliate_roi"
    )


@query(
    "p18_surrogate_keys",
    f"""SELECT {key('player_id', 'city', ts('_ingested_at'))} AS id, player_id FROM dim_players""",
)
def _(lake: Lake) -> DataFrame:
    stamp_text = F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return lake.players.select(
        surrogate_key(["player_id", "city", stamp_text]).alias("id"), "player_id"
    )


@query(
    "p19_p20_amount_text",
    f"""SELECT transaction_id, 'AMOUNT' AS tag, CAST(NULL AS VARCHAR) AS nothing,
          transaction_type || ': $' || {amount_text('amount')} AS label FROM fct_transactions""",
)
def _(lake: Lake) -> DataFrame:
    return lake.tx.select(
        "transaction_id",
        F.lit("AMOUNT").alias("tag"),
        F.lit(None).cast("string").alias("nothing"),
        F.concat("transaction_type", F.lit(": $"), money_text("amount")).alias("label"),
    )


@query(
    "p21_a_arr_player_lists",
    f"SELECT related_group AS ip, page, related_players, distinct_players FROM ({PAGES_SQL})"
    " WHERE kind = 'ip'",
)
def _(lake: Lake) -> DataFrame:
    return (
        fraud.related_player_pages(lake.sessions, lake.work)
        .filter("kind = 'ip'")
        .select(F.col("related_group").alias("ip"), "page", "related_players", "distinct_players")
    )


@query(
    "p22_p24_lifespan_and_revenue",
    f"""SELECT player_id, customer_lifespan_days, {money('ggr')} AS ggr,
          {money('net_deposit')} AS net_deposit, {money('estimated_ltv')} AS estimated_ltv
        FROM metrics""",
)
def _(lake: Lake) -> DataFrame:
    return finance.financial_metrics(lake.totals, lake.players).select(
        "player_id", "customer_lifespan_days", "ggr", "net_deposit", "estimated_ltv"
    )


@query("p23_minutes_between", "SELECT deposit_id, withdraw_id, minutes_between FROM rapid_pairs")
def _(lake: Lake) -> DataFrame:
    return fraud.rapid_cycles(lake.tx).select("deposit_id", "withdraw_id", "minutes_between")


@query(
    "p25_p27_a5_player_revenue",
    f"""SELECT player_id, {money('total_deposits')} AS total_deposits,
          {money('total_bets')} AS total_bets, {money('total_withdrawals')} AS total_withdrawals,
          {money('total_bets - total_withdrawals')} AS net_revenue FROM per_player""",
)
def _(lake: Lake) -> DataFrame:
    return affiliates.player_revenue(lake.totals)


@query(
    "p26_risk_ladder",
    "SELECT player_id, active_days, risk_classification FROM fct_financial_summary",
)
def _(lake: Lake) -> DataFrame:
    return (
        finance.financial_metrics(lake.totals, lake.players)
        .withColumn("risk_classification", risk_class())
        .select("player_id", "active_days", "risk_classification")
    )


@query(
    "p28_a10_f5_water_marks",
    f"""SELECT 'sessions' AS dataset, {ts('coalesce(max("timestamp"), TIMESTAMP \'2020-01-01\')')}
          AS mark FROM raw_sessions
        UNION ALL
        SELECT 'transactions', {ts('max("timestamp")')} FROM raw_transactions
        UNION ALL
        SELECT 'empty', '2020-01-01 00:00:00.000000'""",
)
def _(lake: Lake) -> DataFrame:
    marks = {
        "sessions": high_water_mark(lake.raw["sessions"]),
        "transactions": high_water_mark(lake.raw["transactions"]),
        "empty": high_water_mark(lake.raw["sessions"].filter("session_id IS NULL")),
    }
    rows = [(d, m.isoformat(" ", "microseconds")) for d, m in marks.items()]
    return lake.spark.createDataFrame(rows, "dataset string, mark string")


@query("p29_a9_global_metrics", f"""SELECT total_active_players,
          {money('global_total_deposits')} AS global_total_deposits,
          {money('global_total_withdrawals')} AS global_total_withdrawals,
          {money('global_total_bets')} AS global_total_bets, {money('global_ggr')} AS global_ggr,
          arpu_deposits, arpu_bets FROM everyone""")
def _(lake: Lake) -> DataFrame:
    metrics = finance.financial_metrics(lake.totals, lake.players)
    return finance.global_metrics(finance.city_metrics(metrics))


@query(
    "p30_divide",
    """SELECT affiliate_id, player_id,
          CAST(registrations AS DOUBLE) / nullif(CAST(clicks AS DOUBLE), 0) AS ratio
        FROM dim_affiliates""",
)
def _(lake: Lake) -> DataFrame:
    return lake.affiliates.select(
        "affiliate_id", "player_id", safe_ratio("registrations", "clicks").alias("ratio")
    )


# --- filters ---


@query(
    "f1_row_numbers",
    """SELECT rn, count(*) AS n FROM (
          SELECT row_number() OVER (PARTITION BY affiliate_id, player_id
            ORDER BY _ingested_at DESC) AS rn FROM stg_affiliates) GROUP BY rn""",
)
def _(lake: Lake) -> DataFrame:
    rows = numbered(
        lake.staging("affiliates"),
        ["affiliate_id", "player_id"],
        ["clicks", "registrations", "ftd_count", "cpa_value"],
    )
    return rows.groupBy("rn").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f12_not_normal",
    """SELECT player_id, risk_classification FROM fct_financial_summary
        WHERE risk_classification <> 'NORMAL'""",
)
def _(lake: Lake) -> DataFrame:
    return not_normal(lake.summary).select("player_id", "risk_classification")


@query(
    "f13_global_filters",
    """SELECT signal_event_id, player_id, signal_type, risk_level FROM fct_fraud_signals
        WHERE detected_at >= TIMESTAMP '2024-01-05' AND detected_at < TIMESTAMP '2024-02-02'
          AND risk_level IN ('HIGH', 'MEDIUM')
          AND player_id IN (SELECT player_id FROM dim_players
                            WHERE city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4'))
          AND player_id IN (SELECT player_id FROM dim_sessions WHERE device = 'android')
          AND player_id IN (SELECT player_id FROM dim_affiliates
                            WHERE country IN ('NATION_5', 'NATION_6', 'NATION_7'))""",
)
def _(lake: Lake) -> DataFrame:
    chosen = Filters(
        start=date(2024, 1, 5),
        end=date(2024, 2, 1),
        cities=("NATION_1", "NATION_2", "NATION_3", "NATION_4"),
        countries=("NATION_5", "NATION_6", "NATION_7"),
        devices=("android",),
        risks=("HIGH", "MEDIUM"),
    )
    return apply_filters(
        lake.signals,
        chosen,
        players=lake.players,
        sessions=lake.sessions,
        affiliates=lake.affiliates,
    ).select("signal_event_id", "player_id", "signal_type", "risk_level")


@query(
    "f14_between_dates",
    """SELECT count(*) AS signals FROM fct_fraud_signals
        WHERE CAST(detected_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
)
def _(lake: Lake) -> DataFrame:
    found = between_dates(lake.signals, "detected_at", date(2024, 1, 10), date(2024, 1, 20))
    return found.agg(F.count(F.lit(1)).alias("signals"))


# --- joins ---


@query(
    "j1_f9_f10_rapid_pairs",
    f"""SELECT player_id, deposit_id, withdraw_id, {ts('deposit_time')} AS deposit_time,
          {ts('withdraw_time')} AS withdraw_time, {money('deposit_amount')} AS deposit_amount,
          {money('withdraw_amount')} AS withdraw_amount, minutes_between FROM rapid_pairs""",
)
def _(lake: Lake) -> DataFrame:
    return fraud.rapid_cycles(lake.tx)


@query(
    "j2_financial_metrics",
    f"""SELECT player_id, city, active_days, {money('total_deposits')} AS total_deposits,
          avg_deposit, avg_withdrawal, avg_bet FROM metrics""",
)
def _(lake: Lake) -> DataFrame:
    return finance.financial_metrics(lake.totals, lake.players).select(
        "player_id", "city", "active_days", "total_deposits", "avg_deposit", "avg_withdrawal",
        "avg_bet",
    )


@query(
    "j3_j4_city_and_global",
    f"""SELECT m.player_id, m.city, c.total_players AS city_total_players,
          {money('c.city_ggr')} AS city_ggr, total_active_players,
          {money('global_ggr')} AS global_ggr
        FROM metrics AS m LEFT JOIN cities AS c ON m.city = c.city, everyone""",
)
def _(lake: Lake) -> DataFrame:
    metrics = finance.financial_metrics(lake.totals, lake.players)
    cities = finance.city_metrics(metrics)
    joined = finance.with_city(metrics, cities)
    return finance.with_global(joined, finance.global_metrics(cities)).select(
        "player_id", "city", "city_total_players", "city_ggr", "total_active_players", "global_ggr"
    )


@query(
    "j5_j6_a6_referral_revenue",
    f"""SELECT affiliate_id, country, {money('player_total_deposits')} AS player_total_deposits,
          {money('player_total_bets')} AS player_total_bets,
          {money('player_total_withdrawals')} AS player_total_withdrawals,
          {money('player_net_revenue')} AS player_net_revenue FROM fct_affiliate_performance""",
)
def _(lake: Lake) -> DataFrame:
    return lake.gold_model("fct_affiliate_performance").select(
        "affiliate_id", "country", "player_total_deposits", "player_total_bets",
        "player_total_withdrawals", "player_net_revenue",
    )


@query(
    "j7_group_members",
    """SELECT DISTINCT s.device, s.player_id, distinct_players
        FROM device_sharing AS g JOIN dim_sessions AS s ON g.device = s.device""",
)
def _(lake: Lake) -> DataFrame:
    members = fraud.sharing_members(lake.sessions, "device", fraud.DEVICE_PLAYERS_OVER, lake.work)
    return members.select("device", "player_id", "distinct_players")


@query(
    "j9_orphans",
    """SELECT t.player_id AS value, count(*) AS n_records FROM fct_transactions AS t
        WHERE t.player_id NOT IN (SELECT player_id FROM dim_sessions) GROUP BY t.player_id""",
)
def _(lake: Lake) -> DataFrame:
    """Transactions of players without a session; against the players there are no orphans."""
    return orphans(lake.tx, "player_id", lake.sessions.select("player_id").distinct(), "player_id")


@query(
    "j10_signals_with_city",
    """SELECT s.player_id, risk_level, count(*) AS signals, any_value(city) AS city
        FROM fct_fraud_signals AS s LEFT JOIN dim_players AS p ON s.player_id = p.player_id
        GROUP BY s.player_id, risk_level""",
)
def _(lake: Lake) -> DataFrame:
    return marts.signals_with_city(lake.signals, lake.players)


# --- aggregates ---


@query(
    "a1_f2_f6_ip_sharing",
    f"""SELECT ip, distinct_players, {ts('first_seen')} AS first_seen,
          {ts('last_seen')} AS last_seen FROM ip_sharing""",
)
def _(lake: Lake) -> DataFrame:
    return fraud.ip_sharing(lake.sessions)


@query(
    "a3_f3_f7_device_sharing",
    f"""SELECT device, distinct_players, {ts('first_seen')} AS first_seen,
          {ts('last_seen')} AS last_seen FROM device_sharing""",
)
def _(lake: Lake) -> DataFrame:
    return fraud.device_sharing(lake.sessions)


@query(
    "a4_affiliate_metrics",
    f"""SELECT affiliate_id, country, total_players, CAST(total_clicks AS BIGINT) AS total_clicks,
          CAST(total_registrations AS BIGINT) AS total_registrations,
          CAST(total_ftd AS BIGINT) AS total_ftd,
          {money('total_cpa_revenue')} AS total_cpa_revenue,
          {avg6('cpa_sum', 'cpa_rows')} AS avg_cpa_value,
          {pct('total_registrations', 'total_clicks')} AS overall_conversion_rate,
          {pct('total_ftd', 'total_registrations')} AS overall_ftd_rate
        FROM affiliate_groups""",
)
def _(lake: Lake) -> DataFrame:
    return affiliates.affiliate_metrics(lake.affiliates)


@query(
    "a7_acc_asc_aac_player_financials",
    f"""SELECT player_id, active_days, {ts('first_transaction')} AS first_transaction,
          {ts('last_transaction')} AS last_transaction,
          {money('total_deposits')} AS total_deposits, deposit_count,
          {avg6('total_deposits', 'deposit_count')} AS avg_deposit,
          {money('total_withdrawals')} AS total_withdrawals, withdrawal_count,
          {avg6('total_withdrawals', 'withdrawal_count')} AS avg_withdrawal,
          {money('total_bets')} AS total_bets, bet_count,
          {avg6('total_bets', 'bet_count')} AS avg_bet FROM per_player""",
)
def _(lake: Lake) -> DataFrame:
    return finance.player_financials(lake.tx)


@query(
    "a8_aav_city_metrics",
    f"""SELECT city, total_players, {money('city_total_deposits')} AS city_total_deposits,
          {money('city_total_withdrawals')} AS city_total_withdrawals,
          {money('city_total_bets')} AS city_total_bets, {money('city_ggr')} AS city_ggr,
          avg_deposits_per_player, avg_bets_per_player FROM cities""",
)
def _(lake: Lake) -> DataFrame:
    return finance.city_metrics(finance.financial_metrics(lake.totals, lake.players))


@query(
    "acd_amm_distinct_and_range",
    f"""SELECT transaction_type, count(DISTINCT player_id) AS players,
          count(DISTINCT transaction_date) AS days,
          {ts('min(transaction_timestamp)')} AS first_seen,
          {ts('max(transaction_timestamp)')} AS last_seen
        FROM fct_transactions GROUP BY transaction_type""",
)
def _(lake: Lake) -> DataFrame:
    return lake.tx.groupBy("transaction_type").agg(
        F.count_distinct("player_id").alias("players"),
        F.count_distinct("transaction_date").alias("days"),
        F.min("transaction_timestamp").alias("first_seen"),
        F.max("transaction_timestamp").alias("last_seen"),
    )


@query(
    "adx1_distinct_with_blank",
    """SELECT count(DISTINCT coalesce(country, '')) AS countries,
          (SELECT count(DISTINCT coalesce(city, '')) FROM dim_players) AS cities
        FROM dim_affiliates""",
)
def _(lake: Lake) -> DataFrame:
    cities = lake.players.agg(marts.distinct_with_blank("city"))
    return lake.affiliates.agg(marts.distinct_with_blank("country").alias("countries")).select(
        F.col("countries").cast("bigint").alias("countries"),
        cities.scalar().cast("bigint").alias("cities"),
    )


@query(
    "adx3_share_of_selection",
    """SELECT signal_type, risk_level, count(*) AS signals,
          (SELECT count(*) FROM fct_fraud_signals) AS all_signals,
          CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fct_fraud_signals) AS share
        FROM fct_fraud_signals GROUP BY signal_type, risk_level""",
)
def _(lake: Lake) -> DataFrame:
    return marts.signals_share_by_type(lake.signals)


# --- top-k and set operations ---


@query(
    "k1_top_with_ties",
    """SELECT transaction_id, ts FROM (
          SELECT transaction_id, strftime(transaction_date, '%Y-%m-%d') AS ts,
            rank() OVER (ORDER BY transaction_date DESC) AS r FROM fct_transactions)
        WHERE r <= 10""",
)
def _(lake: Lake) -> DataFrame:
    return top_with_ties(lake.tx, "transaction_date", 10).select(
        "transaction_id", F.col("transaction_date").alias("ts")
    )


@query(
    "k2_k3_k4_top_players_by_ggr",
    f"""SELECT player_id, {money('ggr')} AS ggr FROM metrics
        ORDER BY metrics.ggr DESC, player_id LIMIT 10""",
)
def _(lake: Lake) -> DataFrame:
    return top_rows(lake.summary, "ggr", ["player_id"], 10).select("player_id", "ggr")


@query(
    "u1_union_of_signals",
    """SELECT 'MULTI_ACCOUNTING' AS signal_type, count(*) AS n FROM sig_ip
        UNION ALL SELECT 'DEPOSIT_WITHOUT_BET', count(*) FROM sig_no_bet
        UNION ALL SELECT 'DEVICE_SHARING', count(*) FROM sig_device
        UNION ALL SELECT 'RAPID_DEPOSIT_WITHDRAW', count(*) FROM sig_rapid""",
)
def _(lake: Lake) -> DataFrame:
    signals = lake.gold_model("fct_fraud_signals")
    return signals.groupBy("signal_type").agg(F.count(F.lit(1)).alias("n"))
