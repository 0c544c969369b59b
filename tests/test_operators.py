from __future__ import annotations

from datetime import date

import pytest
from conftest import at, rows, same
from pyspark.sql import functions as F

from wagerlens.operators.dedup import latest
from wagerlens.operators.filters import Filters, apply_filters
from wagerlens.operators.intervals import followed_within
from wagerlens.operators.sharing import (
    group_members,
    player_pages,
    shared_pairs,
    sharing_groups,
)
from wagerlens.operators.skew import SHARES, heavy_keys, row_weights, salted_join
from wagerlens.operators.topk import top_rows, top_with_ties


def test_latest_settles_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, at("2024-01-01")),
            ("a", 2, at("2024-01-01")),
            ("b", 1, None),
            ("b", 0, at("2020-01-01")),
            (None, 5, None),
            (None, 6, None),
        ],
        "k string, v int, _ingested_at timestamp",
    )
    assert rows(latest(df, ["k"], ["v"]), "k", "v") == [("a", 2), ("b", 0), (None, 6)]


# --- skew ---


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, another third has no key."""
    n = 3000
    df = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string")))
        .alias("k"),
    )
    dim = df.select("k").distinct().filter("k IS NOT NULL AND k <> 'k2'").withColumn(
        "name", F.upper("k")
    )
    return df, dim


def test_heavy_keys_are_few_and_found(spark, skewed):
    df, _ = skewed
    found = heavy_keys(row_weights(df, ["k"]), ["k"], "_rows", min_rows=100).collect()
    assert [(r["k"], r["_slices"]) for r in found] == [("hot", 10)]
    many = heavy_keys(row_weights(df, ["k"]), ["k"], "_rows", min_rows=0)
    assert many.count() < SHARES


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    df, dim = skewed
    plain = df.join(dim, "k", how)
    for min_rows in (1, 100, 10**9):
        assert same(plain, salted_join(df, dim, ["k"], how, min_rows=min_rows))


def test_salted_join_spreads_the_hot_key(spark, skewed):
    df, dim = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(df, dim, ["k"], min_rows=10)
        parts = (
            joined.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(parts) > 3
    assert sum(r["count"] for r in parts) == 1000


# --- intervals ---


def _timed(spark, prefix, items):
    data = [(p, f"{prefix}{i}", at(t)) for i, (p, t) in enumerate(items)]
    return spark.createDataFrame(data, f"player string, {prefix}_id string, {prefix}_ts timestamp")


def _pairs(first, second, min_rows=10**9):
    return followed_within(
        first, second, "player", "a_ts", "b_ts", "a_id", "b_id", 60, min_rows
    )


def test_interval_edges(spark):
    first = _timed(spark, "a", [("p", "2024-01-01 10:30:00")])
    second = _timed(
        spark,
        "b",
        [
            ("p", "2024-01-01 10:30:00"),
            ("p", "2024-01-01 10:30:01"),
            ("p", "2024-01-01 11:29:59"),
            ("p", "2024-01-01 11:30:00"),
            ("p", "2024-01-01 10:29:59"),
            ("q", "2024-01-01 10:31:00"),
        ],
    )
    assert rows(_pairs(first, second), "b_id") == [("b1",), ("b2",)]


def test_interval_join_equals_brute_force_when_salted(spark):
    moments = [f"2024-01-01 {h:02d}:{m:02d}:00" for h in range(8, 12) for m in range(0, 60, 7)]
    first = _timed(spark, "a", [("hot", t) for t in moments] + [("cold", t) for t in moments[:5]])
    second = _timed(spark, "b", [("hot", t) for t in moments] + [("cold", t) for t in moments[3:9]])
    brute = first.join(second, "player").filter(
        "b_ts > a_ts AND timestampdiff(MINUTE, a_ts, b_ts) < 60"
    )
    assert brute.count() > 100
    for min_rows in (0, 2, 10**9):
        assert same(brute, _pairs(first, second, min_rows))


# --- sharing ---


@pytest.fixture(scope="module")
def sessions(spark):
    data = [("1.1.1.1", "p1"), ("1.1.1.1", "p1"), ("2.2.2.2", "p1"), ("2.2.2.2", "p2")]
    data += [(None, "p1"), (None, "p2"), ("3.3.3.3", None), ("3.3.3.3", "p9")]
    data += [("4.4.4.4", f"q{i:02d}") for i in range(30)]
    stamped = [(ip, p, at(f"2024-01-01 00:00:{i:02d}")) for i, (ip, p) in enumerate(data)]
    return spark.createDataFrame(
        stamped, "ip string, player_id string, session_timestamp timestamp"
    )


def test_groups_need_two_players(sessions):
    groups = sharing_groups(shared_pairs(sessions, "ip"), "ip", 1)
    assert rows(groups, "ip", "distinct_players") == [("2.2.2.2", 2), ("4.4.4.4", 30)]


@pytest.mark.parametrize("min_rows", [0, 5, 10**9])
def test_members_equal_collect_and_explode(sessions, min_rows):
    naive = (
        sessions.filter("ip IS NOT NULL AND player_id IS NOT NULL")
        .groupBy("ip")
        .agg(F.array_sort(F.collect_set("player_id")).alias("l"))
        .filter("size(l) > 1")
        .select("ip", F.explode("l").alias("player_id"))
    )
    pairs = shared_pairs(sessions, "ip")
    members = group_members(pairs, sharing_groups(pairs, "ip", 1), "ip", min_rows)
    assert same(naive, members.select("ip", "player_id"))


def test_lists_of_all_groups_stand_once_in_pages(sessions):
    pairs = shared_pairs(sessions, "ip")
    members = group_members(pairs, sharing_groups(pairs, "ip", 1), "ip")
    pages = player_pages(members, "ip", page_players=8).collect()
    of = lambda ip: [r for r in pages if r["ip"] == ip]
    assert [r["related_players"] for r in of("2.2.2.2")] == ["p1, p2"]
    assert 1 < len(of("4.4.4.4")) <= 4 and {r["ip"] for r in pages} == {"2.2.2.2", "4.4.4.4"}
    players = sorted(p for r in of("4.4.4.4") for p in r["related_players"].split(", "))
    assert players == [f"q{i:02d}" for i in range(30)]


@pytest.mark.parametrize("n", [2_000, 2_001, 25_000])
def test_a_group_of_any_size_has_its_whole_list(spark, n):
    from wagerlens.plans import fraud

    sessions = spark.range(n).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("player_id"),
        F.lit("one").alias("device"),
        F.lit(None).cast("string").alias("ip"),
        F.lit(at("2024-01-01")).alias("session_timestamp"),
    )
    signals = fraud.device_signals(sessions, at("2024-02-01"))
    assert rows(signals.groupBy("related_group", "related_count").count()) == [("one", n, n)]
    pages = fraud.related_player_pages(sessions).collect()
    assert len(pages) == -(-n // 10_000) and {r["related_group"] for r in pages} == {"one"}
    listed = [p for r in pages for p in r["related_players"].split(", ")]
    assert len(listed) == len(set(listed)) == n


# --- top-k and filters ---


def test_top_keeps_ties_or_exactly_k(spark):
    df = spark.createDataFrame([(i, max(i, 3)) for i in range(12)], "id long, v long")
    assert top_with_ties(df, "v", 10).count() == 12  # the tenth value is shared by four rows
    assert rows(top_rows(df, "v", ["id"], 10), "id")[:2] == [(0,), (1,)]
    assert top_rows(df, "v", ["id"], 10).count() == 10


def test_filters_reach_through_players(spark):
    signals = spark.createDataFrame(
        [("p1", "HIGH", at("2024-01-05 23:59:59")), ("p2", "HIGH", at("2024-01-06")),
         ("p1", "LOW", at("2024-01-04")), ("p3", "HIGH", at("2024-01-05"))],
        "player_id string, risk_level string, detected_at timestamp",
    )
    players = spark.createDataFrame([("p1", "X"), ("p2", "X"), ("p3", "Y")],
                                    "player_id string, city string")
    sessions = spark.createDataFrame([("p1", "ios"), ("p1", "ios"), ("p2", "android")],
                                     "player_id string, device string")
    got = apply_filters(
        signals,
        Filters(date(2024, 1, 5), date(2024, 1, 5), cities=("X",), devices=("ios",),
                risks=("HIGH",)),
        players=players,
        sessions=sessions,
    )
    assert rows(got, "player_id", "risk_level") == [("p1", "HIGH")]
    assert apply_filters(signals, Filters()).count() == 4
