from __future__ import annotations

from conftest import at, rows
from pyspark.sql import functions as F

from wagerlens.catalog.lake import AS_OF
from wagerlens.operators import quality as q
from wagerlens.plans import declared
from wagerlens.schemas import BRONZE


def seeded(spark):
    return spark.createDataFrame(
        [("a", "p1", "bet"), ("a", "p2", "bet"), (None, "p9", "fee"), (None, None, None)],
        "id string, player_id string, kind string",
    )


def test_failing_values_are_exactly_the_seeded_ones(spark):
    df = seeded(spark)
    parent = spark.createDataFrame([("p1",), ("p2",), (None,)], "player_id string")
    assert rows(q.duplicates(df, "id")) == [("a", 2)]
    assert rows(q.nulls(df, "kind"), "id") == [(None,)]
    assert rows(q.not_accepted(df, "kind", ["bet"])) == [("fee", 1)]
    assert rows(q.orphans(df, "player_id", parent, "player_id")) == [("p9", 1)]


def test_profile_counts_everything_in_one_pass(spark):
    df = seeded(spark)
    profile = q.table_profile(df, ["id", "kind"], {"kind": ["bet"]})
    assert {(r["test"], r["column"]): r["failures"] for r in profile.collect()} == {
        ("row_count", None): 4,
        ("not_null", "id"): 2,
        ("not_null", "kind"): 1,
        ("accepted_values", "kind"): 1,
    }
    plan = q.table_profile(df, ["id", "kind"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_seventy_three_tests_are_declared():
    n = sum(len(v) for d in (declared.UNIQUE, declared.NOT_NULL, declared.RELATIONSHIPS,
                             declared.ACCEPTED) for v in d.values())
    assert n == 73


def test_clean_silver_passes(lake):
    frames = {n: lake.silver(n) for n in ("dim_players", "dim_sessions", "fct_transactions",
                                          "dim_affiliates")}
    assert declared.run_tests(frames).filter("status <> 'pass'").isEmpty()


def test_alerts(spark):
    df = spark.range(9).toDF("x")
    assert q.volume_alert(df, 10, "d").first()["status"] == "OK"
    assert q.volume_alert(df.limit(8), 10, "d").first()["status"] == "ALERT"
    assert q.volume_alert(df, 0, "d").first()["status"] == "ALERT"
    assert q.load_count(df, df.limit(3), "d").first()["status"] == "ALERT"
    stale = spark.createDataFrame([(at("2024-01-30 23:00:00"),)], "ts timestamp")
    assert q.freshness(stale, "ts", AS_OF).first()["value"] == 25.0
    assert q.freshness(stale, "ts", AS_OF).first()["status"] == "ALERT"


def test_rows_are_marked_with_every_rule_they_break(spark):
    df = spark.createDataFrame(
        [("ok", 1, "bet", at("2024-01-01")), ("bad", -1, "fee", at("2025-01-01")),
         ("none", None, "bet", at("2024-01-01"))],
        "id string, amount int, transaction_type string, transaction_timestamp timestamp",
    )
    marked = q.mark_violations(df, q.transaction_rules(AS_OF))
    assert dict(rows(marked.select("id", F.array_join("violations", ",")))) == {
        "ok": "",
        "bad": "amount_negative,type_unknown,timestamp_in_future",
        "none": "amount_missing",
    }
    assert q.valid_share(marked).first()["status"] == "ALERT"


def test_schema_changes(spark):
    df = spark.createDataFrame([], "player_id string, email int, city string, created_at date, x int")
    assert rows(q.schema_changes(df, BRONZE["players"]), "column", "change") == [
        ("_ingested_at", "missing"), ("email", "type"), ("x", "added"),
    ]
    assert q.schema_changes(spark.createDataFrame([], BRONZE["players"]), BRONZE["players"]).isEmpty()
