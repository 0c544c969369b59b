"""What a run writes to disk: no shuffle that a first load can do without, none kept after its query."""

from __future__ import annotations

import os
import time

import pytest
from conftest import at, rows, same
from pyspark.sql import functions as F

from wagerlens.plans import fraud, medallion, silver
from wagerlens.session import SHUFFLE_CLEANUP, shuffles_dropped
from wagerlens.sources import bronze, files, fixtures, tables
from wagerlens.sources.scratch import WorkTables

DAY = at("2024-02-01")
SESSIONS = "session_id string, player_id string, ip string, device string, timestamp timestamp"
AFFILIATES = (
    "affiliate_id string, player_id string, country string, clicks long, registrations long, ftd long,"
    " cpa_value double"
)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sessions(spark, *keys):
    data = [(k, "1", "10.0.0.1", "ios", at(f"2024-01-{10 + n}")) for n, k in enumerate(keys)]
    return spark.createDataFrame(data, SESSIONS)


def _affiliates(spark, *pairs):
    return spark.createDataFrame([(a, p, "BR", 4, 2, 1, 1.5) for a, p in pairs], AFFILIATES)


def _shuffle_files(spark) -> set[str]:
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    tops = list(env.blockManager().diskBlockManager().localDirsString())
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def _left_over(spark, before: set[str]) -> set[str]:
    """Shuffle files that stay; they are deleted by a message that nobody waits for."""
    for _ in range(40):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return left


@pytest.fixture
def written(monkeypatch):
    """Plan, folder and partition columns of each write of a stored table."""
    found, plain = [], tables._write

    def write(df, folder, by, *a, **k):
        found.append((_plan(df), folder, list(by)))
        return plain(df, folder, by, *a, **k)

    monkeypatch.setattr(tables, "_write", write)
    return found


def test_shuffle_files_go_with_their_query(spark, root):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_dropped(spark):
        spark.range(1000).repartition(3, "id").write.parquet(f"{root}/a")
        assert spark.range(1000).groupBy("id").count().count() == 1000
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert _left_over(spark, before) == set()
    assert spark.read.parquet(f"{root}/a").count() == 1000


def test_a_run_keeps_no_shuffle_files_and_no_parsed_rows(spark, root, monkeypatch):
    deliveries = {
        "players": spark.createDataFrame(
            [(str(n), f"{n}@x", "Recife", at("2024-01-01").date()) for n in range(4)],
            "player_id string, email string, city string, created_at date",
        ),
        "sessions": _sessions(spark, "s1", "s2", "s3"),
        "transactions": spark.createDataFrame(
            [(f"t{n}", str(n), "deposit", 5.0, at("2024-01-02")) for n in range(4)],
            "transaction_id string, player_id string, type string, amount double, timestamp timestamp",
        ),
        "affiliates": _affiliates(spark, ("a", "1"), ("b", "2")),
    }
    for dataset, file in medallion.FILES.items():
        files.write_file(deliveries[dataset], dataset, f"{root}/in/{file}", "gzip")
    held, refresh = [], silver.refresh

    def seen(*a, **k):
        held.extend(d for d, _, names in os.walk(f"{root}/out/work") if any(n.startswith("part-") for n in names))
        return refresh(*a, **k)

    monkeypatch.setattr(silver, "refresh", seen)
    before = _shuffle_files(spark)
    medallion.run(spark, f"{root}/in", f"{root}/out", DAY)
    assert _left_over(spark, before) == set() and held == []
    metrics = spark.read.parquet(medallion.Layout(f"{root}/out").metrics)
    counts = metrics.filter("check LIKE 'row_count:%'").selectExpr("substring(check, 11)", "value", "`limit`", "status")
    assert rows(counts) == [("affiliates", 2, 2, "OK"), ("players", 4, 4, "OK"), ("sessions", 3, 3, "OK"),
                            ("transactions", 4, 4, "OK")]
    gold = medallion.read_gold(spark, medallion.Layout(f"{root}/out"))
    assert rows(gold["fct_financial_summary"], "player_id") == [(str(n),) for n in range(4)]
    assert rows(gold["fct_affiliate_performance"], "affiliate_id", "total_players") == [("a", 1), ("b", 1)]


def test_compressed_files_are_bounded_and_read_back(spark, root, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 2)
    frames = {"sessions": _sessions(spark, *"abcde"), "affiliates": _affiliates(spark, *[(a, "1") for a in "abcde"])}
    for dataset, frame in frames.items():
        files.write_file(frame.coalesce(1), dataset, f"{root}/{dataset}", "gzip")
        names = [n for n in os.listdir(f"{root}/{dataset}") if n.startswith("part-")]
        assert len(names) == 3 and all(n.endswith(".gz") for n in names)
        assert same(files.scan_file(spark, dataset, f"{root}/{dataset}"), frame)


def test_a_first_load_is_not_joined_with_an_empty_table(spark, root):
    bronze.create_bronze(spark, root, "sessions")
    batch = _sessions(spark, "a", "a", None)
    new = bronze.unseen(batch, bronze.read_bronze(spark, root, "sessions"), "session_id")
    assert "Join" not in _plan(new) and "Exchange" not in _plan(new)
    assert rows(new, "session_id") == rows(batch, "session_id")


def test_first_loads_are_written_without_a_shuffle(spark, root, written):
    assert bronze.load_sessions(spark, root, _sessions(spark, "a", "b", "b", None), DAY) == 0
    bronze.upsert_affiliates(spark, root, _affiliates(spark, ("a", "1"), ("b", None), ("b", None)), DAY)
    assert [by for _, _, by in written] == [[], []]
    assert not any("Exchange" in plan or "Sort" in plan or "Join" in plan for plan, _, _ in written)
    assert written[0][1].endswith("/_period=2024-02-01/_bucket=0")
    got = bronze.read_bronze(spark, root, "sessions", since=at("2024-01-31"))
    assert rows(got, "session_id") == [("a",), ("b",), ("b",), (None,)]
    assert bronze.read_bronze(spark, root, "sessions", since=at("2024-02-02")).isEmpty()
    # Later ones meet what is stored.
    later = at("2024-02-02")
    bronze.load_sessions(spark, root, _sessions(spark, "x", "x", "x", "x", "c", "b"), later)
    bronze.upsert_affiliates(spark, root, _affiliates(spark, ("a", "1"), ("c", "1")), later)
    got = bronze.read_bronze(spark, root, "sessions").selectExpr("session_id", "day(_ingested_at)")
    assert rows(got) == [("a", 1), ("b", 1), ("b", 1), ("c", 2), (None, 1)]
    got = bronze.read_bronze(spark, root, "affiliates").selectExpr("affiliate_id", "day(_ingested_at)")
    assert rows(got) == [("a", 2), ("b", 1), ("b", 1), ("c", 2)]


def test_rows_with_stamps_of_their_own_keep_their_periods(spark, root, written):
    frame = _sessions(spark, "a", "b").withColumn("_ingested_at", F.col("timestamp"))
    bronze.load_sessions(spark, root, frame, DAY)
    assert [by for _, _, by in written] == [["_period", "_bucket"]]
    folder = written[0][1]
    assert sorted(n for n in os.listdir(folder) if "=" in n) == ["_period=2024-01-10", "_period=2024-01-11"]


def test_a_rebuilt_table_is_written_as_its_rows_come(spark, root, written):
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    for keys in ([], ["k"]):
        path = f"{root}/{len(keys)}"
        assert tables.replace_table(spark, path, frame, keys).added_rows == 3
        assert tables.replace_table(spark, path, frame.limit(2), keys).added_rows == 2
        assert rows(tables.read_table(spark, path)) == rows(frame.limit(2))
    assert all(by == [] for _, _, by in written)
    tables.replace_table(spark, f"{root}/many", frame, ["k"], buckets=4)
    assert written[-1][2] == ["_bucket"]


def test_a_merge_into_one_bucket_does_not_look_for_buckets(spark, root, monkeypatch):
    monkeypatch.setattr(tables, "buckets_of", lambda *a: pytest.fail("rows are worked out for one bucket"))
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    path, schema = f"{root}/t", frame.schema
    tables.create_table(spark, path, schema, ["k"], keyed=True)
    assert tables.merge_table(spark, path, frame.limit(0), ["k"]).added_rows == 0
    assert tables.merge_table(spark, path, frame, ["k"]).added_rows == 2
    assert tables.merge_table(spark, path, frame.filter("k = 'b'").selectExpr("k", "9 AS v"), ["k"]).added_rows == 1
    gone = frame.filter("k = 'a'").select("k")
    assert tables.merge_table(spark, path, frame.limit(0), ["k"], retire_by=gone).added_rows == 0
    assert rows(tables.read_table(spark, path)) == [("b", 9)]


def test_lines_are_not_shuffled_for_the_suppliers(spark, sf_dir):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, 200_000)
    try:
        assert "SortMergeJoin" not in _plan(fixtures.raw_affiliates(spark, sf_dir))
    finally:
        spark.conf.set(name, before)


def test_groups_are_counted_on_the_pairs_that_signals_keep(spark, root):
    stored = spark.createDataFrame(
        [("10.0.0.1", "ios", str(n), at("2024-01-01")) for n in range(3)],
        "ip string, device string, player_id string, session_timestamp timestamp",
    )
    stored.write.parquet(f"{root}/s")
    work = WorkTables(spark, f"{root}/work")
    read = lambda: spark.read.schema(stored.schema).parquet(f"{root}/s")
    fraud.multi_accounting(read(), work)
    fraud.device_signals(read(), DAY, work)
    kept = set(work._kept)
    groups = fraud.multi_accounting_groups(read(), work)
    assert len(kept) == 2 and set(work._kept) == kept
    assert rows(groups, "kind", "shared_value", "distinct_players") == [("ip", "10.0.0.1", 3)]
