from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import at, rows, same
from pyspark.sql import functions as F

from wagerlens.catalog.lake import AS_OF
from wagerlens.plans import affiliates, finance, fraud, marts, silver
from wagerlens.plans.staging import stg_players, stg_sessions
from wagerlens.schemas import BRONZE

D = Decimal
TX = (
    "transaction_id string, player_id string, transaction_type string, amount decimal(10,2),"
    " transaction_timestamp timestamp"
)


def transactions(spark, data):
    stamped = [(f"t{i}", p, kind, None if a is None else D(a), at(ts))
               for i, (p, kind, a, ts) in enumerate(data)]
    df = spark.createDataFrame(stamped, TX)
    return df.withColumn("transaction_date", F.to_date("transaction_timestamp"))


# --- staging and silver ---


def test_staging_cleans(spark):
    raw = spark.createDataFrame(
        [("p", "\tAna@X.com\n", " São Paulo ", at("2024-01-01").date(), at("2024-01-02"))],
        BRONZE["players"],
    )
    row = stg_players(raw).first()
    assert (row["email"], row["city"]) == ("ana@x.com", "São Paulo")


def test_weekday_hour_and_latest_delivery(spark):
    raw = spark.createDataFrame(
        [("s", "p", "1", " IOS", at("2024-01-07 23:10:00"), at("2024-01-08")),
         ("s", "p", "1", "Desktop ", at("2024-01-07 23:10:00"), at("2024-01-09"))],
        BRONZE["sessions"],
    )
    row = silver.dim_sessions(stg_sessions(raw)).collect()
    assert len(row) == 1
    assert (row[0]["day_of_week"], row[0]["session_hour"], row[0]["device"]) == (1, 23, "desktop")


def test_fixture_counts(lake):
    # Counts at the smallest scale.
    counts = {n: lake.silver(n).count() for n in silver.SILVER}
    assert counts == {
        "dim_players": 150, "dim_sessions": 1000, "fct_transactions": 2111, "dim_affiliates": 1444,
    }
    by_type = dict(rows(marts.signals_by_type(lake.signals), "signal_type", "signals"))
    assert by_type == {
        "MULTI_ACCOUNTING": 246, "DEPOSIT_WITHOUT_BET": 3, "DEVICE_SHARING": 45,
        "RAPID_DEPOSIT_WITHDRAW": 3,
    }
    assert dict(rows(marts.players_by_risk(lake.summary))) == {
        "HIGH_RISK_NO_BETS": 3, "HIGH_RISK_OVER_WITHDRAWAL": 70, "MEDIUM_RISK_NEW_HIGH_VALUE": 1,
        "NORMAL": 76,
    }


# --- fraud ---


def test_deposit_without_bet(spark):
    tx = transactions(
        spark,
        [("none", "deposit", "10.00", "2024-01-01"),
         ("zero", "deposit", "10.50", "2024-01-01"), ("zero", "bet", "0.00", "2024-01-02"),
         ("bettor", "deposit", "5.00", "2024-01-01"), ("bettor", "bet", "1.00", "2024-01-02"),
         ("taker", "withdraw", "5.00", "2024-01-01")],
    )
    got = fraud.deposit_without_bet(finance.player_financials(tx), AS_OF)
    assert rows(got, "player_id", "signal_description") == [
        ("none", "Depositos totais: $10 sem nenhuma aposta"),
        ("zero", "Depositos totais: $10.5 sem nenhuma aposta"),
    ]


def test_device_needs_more_than_five_players(spark):
    data = [("five", f"p{i}") for i in range(5)] + [("six", f"p{i}") for i in range(6)]
    sessions = spark.createDataFrame(
        [(d, p, "9.9.9.9", at("2024-01-01")) for d, p in data],
        "device string, player_id string, ip string, session_timestamp timestamp",
    )
    got = fraud.device_signals(sessions, AS_OF)
    assert {r["related_group"] for r in got.collect()} == {"six"} and got.count() == 6


def test_two_withdrawals_share_the_signal_id_but_not_the_event_id(spark):
    tx = transactions(
        spark,
        [("p", "deposit", "100.00", "2024-01-01 10:00:00"),
         ("p", "withdraw", "40.00", "2024-01-01 10:20:30"),
         ("p", "withdraw", "60.50", "2024-01-01 10:40:00")],
    )
    empty = spark.createDataFrame(
        [], "device string, player_id string, ip string, session_timestamp timestamp"
    )
    got = fraud.fraud_signals(empty, tx, AS_OF).filter(
        "signal_type = 'RAPID_DEPOSIT_WITHDRAW'"
    ).collect()
    assert len(got) == 2
    assert len({r["fraud_signal_id"] for r in got}) == 1
    assert len({r["signal_event_id"] for r in got}) == 2
    assert {r["signal_description"] for r in got} == {
        "Deposito de $100 e saque de $40 em 20 minutos",
        "Deposito de $100 e saque de $60.5 em 40 minutos",
    }


def test_event_ids_are_unique(lake):
    assert lake.signals.groupBy("signal_event_id").count().filter("count > 1").isEmpty()


def test_union_keeps_equal_rows(spark):
    one = spark.createDataFrame([("p", 1)], "player_id string, x int")
    assert one.unionByName(one).count() == 2


def test_signals_do_not_change_when_everything_is_salted(lake):
    plain = lake.signals.drop("_gold_processed_at")
    salted = fraud.fraud_signals(lake.sessions, lake.tx, AS_OF, min_rows=1)
    assert same(plain, salted.drop("_gold_processed_at"))


# --- finance ---


def test_player_financials_equal_the_direct_aggregate(lake):
    when = lambda k: F.when(F.col("transaction_type") == k, F.col("amount"))
    direct = lake.tx.groupBy("player_id").agg(
        F.count_distinct("transaction_date").alias("active_days"),
        F.sum(F.coalesce(when("deposit"), F.lit(0))).cast("decimal(18,2)").alias("total_deposits"),
        F.avg(when("withdraw")).cast("decimal(18,6)").alias("avg_withdrawal"),
        F.count(when("bet")).alias("bet_count"),
    )
    got = finance.player_financials(lake.tx).select(direct.columns)
    assert same(direct, got)


def test_averages_and_unknown_players(spark):
    tx = transactions(
        spark,
        [("a", "deposit", "10.00", "2024-01-01 08:00:00"),
         ("a", "deposit", "20.01", "2024-01-03 08:00:00"),
         ("a", "deposit", None, "2024-01-03 09:00:00"),
         ("ghost", "deposit", "99.00", "2024-01-01")],
    )
    players = spark.createDataFrame(
        [("a", None, at("2023-01-01").date()), ("idle", "X", at("2023-01-01").date())],
        "player_id string, city string, created_at date",
    )
    summary = finance.financial_summary(tx, players, AS_OF).collect()
    assert [r["player_id"] for r in summary] == ["a"]
    row = summary[0]
    assert row["avg_deposit"] == D("15.005000") and row["deposit_count"] == 3
    assert (row["total_withdrawals"], row["withdrawal_count"], row["avg_withdrawal"]) == (0, 0, None)
    assert row["city_total_players"] is None and row["city_ggr"] is None
    assert row["total_active_players"] == 1 and row["global_total_deposits"] == D("30.01")
    assert row["active_days"] == 2 and row["customer_lifespan_days"] == 2


def test_summary_of_nothing_is_empty(spark):
    players = spark.createDataFrame([], "player_id string, city string, created_at date")
    assert finance.financial_summary(transactions(spark, [("a", "bet", "1", "2024-01-01")]).limit(0),
                                     players, AS_OF).isEmpty()


def test_global_from_cities_equals_global_from_players(lake):
    metrics = finance.financial_metrics(lake.totals, lake.players)
    direct = metrics.agg(
        F.count_distinct("player_id").alias("total_active_players"),
        F.sum("ggr").cast("decimal(18,2)").alias("global_ggr"),
    )
    got = finance.global_metrics(finance.city_metrics(metrics)).select(direct.columns)
    assert same(direct, got)


def test_summary_does_not_change_when_cities_are_salted(lake):
    salted = finance.financial_summary(lake.tx, lake.players, AS_OF, min_rows=1)
    assert same(lake.summary.drop("_gold_processed_at"), salted.drop("_gold_processed_at"))


# --- affiliates ---


def _affiliates(spark, data):
    df = spark.createDataFrame(
        [(a, p, c, 10, 5, 1, D(cpa), D(cpa)) for a, p, c, cpa in data],
        "affiliate_id string, player_id string, country string, clicks long, registrations long,"
        " ftd_count long, cpa_value decimal(10,2), total_cpa_value decimal(18,2)",
    )
    return df


def test_null_country_is_a_group_without_revenue(spark):
    tx = transactions(
        spark, [("p", "bet", "30.00", "2024-01-01"), ("p", "withdraw", "10.00", "2024-01-01")]
    )
    aff = _affiliates(spark, [("a", "p", None, "4.00"), ("b", "p", "BR", "5.00"),
                              ("c", "p", "BR", "0.00")])
    got = affiliates.affiliate_performance(aff, tx, AS_OF)
    assert rows(got, "affiliate_id", "country", "player_net_revenue", "affiliate_roi") == [
        ("a", None, D("0.00"), -100.0),
        ("b", "BR", D("20.00"), 300.0),
        ("c", "BR", D("20.00"), 0.0),
    ]


@pytest.mark.parametrize("min_rows", [1, 10**9])
def test_single_pass_revenue_equals_join_back(lake, min_rows):
    revenue = affiliates.player_revenue(lake.totals)
    groups = lake.affiliates.groupBy("affiliate_id", "country").agg(
        F.count_distinct("player_id").alias("total_players")
    )
    members = lake.affiliates.select("affiliate_id", "country", "player_id")
    naive = (
        groups.join(members, ["affiliate_id", "country"], "left")
        .join(revenue, "player_id", "left")
        .groupBy("affiliate_id", "country", "total_players")
        .agg(F.coalesce(F.sum("net_revenue"), F.lit(0)).cast("decimal(18,2)")
             .alias("player_net_revenue"))
    )
    got = affiliates.affiliate_performance(lake.affiliates, lake.tx, AS_OF, min_rows=min_rows)
    assert same(naive, got.select(naive.columns))


def test_a_burst_across_the_hour_is_whole_in_one_window(spark):
    moments = ["2024-01-01 09:55:00", "2024-01-01 10:05:00", "2024-01-01 10:20:00"]
    sessions = spark.createDataFrame(
        [("1.1.1.1", f"p{i % 2}", at(m)) for i, m in enumerate(moments)],
        "ip string, player_id string, session_timestamp timestamp",
    )
    most = fraud.ip_logins_per_hour(sessions).orderBy(F.desc("logins")).first()
    assert (most["logins"], most["distinct_players"]) == (3, 2)


def test_cards_equal_the_datasets_they_stand_for(spark, lake):
    from wagerlens.plans import marts

    signals, players = lake.signals, lake.players
    cards = marts.fraud_cards(signals, players)
    for name, whole in (
        ("total", marts.total_signals(signals).withColumnRenamed("total_signals", "signals")),
        ("type_and_risk", marts.signals_by_type(signals)),
        ("city_and_risk", marts.signals_by_city(signals, players)),
        ("day_and_type", marts.signals_by_day(signals)),
    ):
        assert same(marts.card(cards, name), whole.select(*marts.CARDS[name], "signals"))
    shares = marts.cards_with_shares(cards).filter("card = 'type_and_risk'")
    assert same(
        shares.select("signal_type", "risk_level", "signals", "all_signals", "share"),
        marts.signals_share_by_type(signals),
    )
    assert cards._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 1
