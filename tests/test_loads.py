from __future__ import annotations

import json
import os

import pytest
from conftest import at, rows, same
from pyspark.sql import functions as F

from wagerlens.plans import declared, medallion, silver
from wagerlens.schemas import FILE_SCHEMAS, SILVER_KEYS, SILVER_SOURCE
from wagerlens.sources import bronze
from wagerlens.sources.files import SourceError, check_file, file_columns, scan_file, write_file
from wagerlens.sources import tables
from wagerlens.sources.tables import expire, merge_table, read_table, replace_table, state

DAY1, DAY2, DAY3 = at("2024-03-01"), at("2024-03-02"), at("2024-03-03")


def tx(spark, data):
    return spark.createDataFrame(
        [(i, "p", "bet", 1.0, at(ts)) for i, ts in data], FILE_SCHEMAS["transactions"]
    )


def aff(spark, data):
    return spark.createDataFrame(
        [(a, p, "br", 1, 1, ftd, 1.0) for a, p, ftd in data], FILE_SCHEMAS["affiliates"]
    )


# --- files ---


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_json_array_and_json_lines(spark, root):
    people = [{"player_id": "1", "email": "A@x", "city": None, "created_at": "2024-01-05"},
              {"player_id": "2", "email": "b@x", "city": "Rio", "created_at": "2024-01-06"}]
    array = write(f"{root}/a/players.json", json.dumps(people, indent=1))
    lines = write(f"{root}/b/players.json", "\n".join(map(json.dumps, people)))
    for path, is_array in ((array, True), (lines, False)):
        assert set(check_file(spark, "players", path, is_array)) >= set(people[0])
        assert rows(scan_file(spark, "players", path, is_array), "player_id", "city") == [
            ("1", None), ("2", "Rio"),
        ]


def test_csv_columns_are_found_by_name(spark, root):
    path = write(
        f"{root}/t.csv",
        "amount,transaction_id,extra,type,player_id,timestamp\n"
        "1.5,t1,x,bet,p,2024-01-01 10:00:00\n",
    )
    check_file(spark, "transactions", path)
    row = scan_file(spark, "transactions", path).first()
    assert (row["transaction_id"], row["amount"], row["timestamp"]) == (
        "t1", 1.5, at("2024-01-01 10:00:00"),
    )


def test_missing_column_and_empty_file_are_rejected(spark, root):
    path = write(f"{root}/s.json", json.dumps({"session_id": "1", "player_id": "2", "ip": "3"}))
    with pytest.raises(SourceError, match="device"):
        check_file(spark, "sessions", path)
    with pytest.raises(SourceError, match="empty"):
        check_file(spark, "players", write(f"{root}/p.json", ""))
    with pytest.raises(SourceError, match="ftd"):
        check_file(spark, "affiliates", write(f"{root}/a.csv", "affiliate_id,player_id\n1,2\n"))
    # A CSV with a header and no rows is accepted.
    header = ",".join(FILE_SCHEMAS["affiliates"].names)
    check_file(spark, "affiliates", write(f"{root}/b.csv", header + "\n"))


def test_written_files_read_back_equal(spark, root, lake):
    for dataset in FILE_SCHEMAS:
        raw = lake.raw[dataset].select(*FILE_SCHEMAS[dataset].names)
        write_file(raw, dataset, f"{root}/{dataset}")
        assert file_columns(spark, dataset, f"{root}/{dataset}") == FILE_SCHEMAS[dataset].names
        back = scan_file(spark, dataset, f"{root}/{dataset}")
        assert same(raw, back)


# --- bronze ---


def test_create_is_idempotent_and_stamps_by_default(spark, root):
    for dataset in bronze.BRONZE_TABLES:
        bronze.create_bronze(spark, root, dataset)
        bronze.create_bronze(spark, root, dataset)
        assert bronze.read_bronze(spark, root, dataset).isEmpty()
    bronze.load_transactions(spark, root, tx(spark, [("t1", "2024-01-01")]), DAY1)
    assert rows(bronze.read_bronze(spark, root, "transactions"), "_ingested_at") == [(DAY1,)]


def test_players_append_or_reload(spark, root, lake):
    delivery = lake.raw["players"].drop("_ingested_at")
    bronze.append_players(spark, root, delivery, DAY1)
    bronze.append_players(spark, root, delivery, DAY2)
    assert bronze.read_bronze(spark, root, "players").count() == 300
    bronze.append_players(spark, root, delivery, DAY3, full_reload=True)
    assert rows(bronze.read_bronze(spark, root, "players").groupBy("_ingested_at").count()) == [
        (DAY3, 150)
    ]


def test_insert_only_merge_edges(spark, root):
    bronze.load_transactions(spark, root, tx(spark, [("old", "2019-12-31"), ("first", "2020-01-01"),
                                                     ("a", "2024-01-01 10:00:00")]), DAY1)
    ids = lambda: rows(bronze.read_bronze(spark, root, "transactions"), "transaction_id")
    assert ids() == [("a",)]
    bronze.load_transactions(
        spark,
        root,
        tx(spark, [("at_mark", "2024-01-01 10:00:00"), ("late", "2024-01-01 09:59:59"),
                   ("a", "2024-01-02"), ("new", "2024-01-02"), ("new", "2024-01-03")]),
        DAY2,
    )
    # The same key twice in one batch goes in twice; silver keeps the latest.
    assert ids() == [("a",), ("new",), ("new",)]
    bronze.load_transactions(
        spark, root, tx(spark, [("late", "2024-01-01 12:00:00")]), DAY3, lookback_minutes=3 * 1440
    )
    assert ("late",) in ids()


def test_loading_a_batch_again_changes_nothing(spark, root, lake):
    delivery = lake.raw["sessions"].drop("_ingested_at")
    bronze.load_sessions(spark, root, delivery, DAY1)
    before = bronze.read_bronze(spark, root, "sessions").count()
    bronze.load_sessions(spark, root, delivery, DAY2)
    assert bronze.read_bronze(spark, root, "sessions").count() == before == 1020


def test_affiliate_upsert(spark, root):
    bronze.upsert_affiliates(spark, root, aff(spark, [("a", "p", 0), ("a", "q", 0)]), DAY1)
    bronze.upsert_affiliates(spark, root, aff(spark, [("a", "p", 1), ("b", "p", 0)]), DAY2)
    table = bronze.read_bronze(spark, root, "affiliates")
    assert rows(table, "affiliate_id", "player_id", "ftd", "_ingested_at") == [
        ("a", "p", 1, DAY2), ("a", "q", 0, DAY1), ("b", "p", 0, DAY2),
    ]
    # An older stamp does not update.
    bronze.upsert_affiliates(spark, root, aff(spark, [("a", "p", 7)]), DAY1)
    assert rows(bronze.read_bronze(spark, root, "affiliates").filter("ftd = 7")) == []
    with pytest.raises(bronze.MergeConflict):
        bronze.upsert_affiliates(spark, root, aff(spark, [("a", "p", 1), ("a", "p", 2)]), DAY3)
    # Two new rows of a pair the table does not hold both go in.
    bronze.upsert_affiliates(spark, root, aff(spark, [("z", "p", 1), ("z", "p", 2)]), DAY3)
    assert bronze.read_bronze(spark, root, "affiliates").filter("affiliate_id = 'z'").count() == 2


def test_stored_copies_of_a_pair_are_all_updated(spark, root):
    bronze.upsert_affiliates(spark, root, aff(spark, [("a", "p", 1), ("a", "p", 2)]), DAY1)
    bronze.upsert_affiliates(spark, root, aff(spark, [("a", "p", 9)]), DAY2)
    assert rows(bronze.read_bronze(spark, root, "affiliates"), "ftd") == [(9,), (9,)]


def test_incremental_read_opens_recent_folders_only(spark, root, lake):
    bronze.backfill(spark, root, "sessions", lake.raw["sessions"])
    recent = bronze.read_bronze(spark, root, "sessions", since=at("2024-01-25"))
    assert same(lake.raw["sessions"].filter("_ingested_at > '2024-01-25'"), recent)
    days = {f.split("_period=")[1][:10] for f in recent.inputFiles()}
    assert min(days) == "2024-01-25" and len(days) < 10


# --- stored tables ---


def _kv(spark, data):
    return spark.createDataFrame(
        [(k, v, at(d)) for k, v, d in data], "k string, v int, _ingested_at timestamp"
    )


def _files(path):
    """Data files of a table with their times, by bucket."""
    out = {}
    for folder, _, names in os.walk(path):
        if "_bucket=" in folder:
            files = {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.startswith("part-")}
            out.setdefault(int(folder.split("_bucket=")[1]), {}).update(files)
    return out


def test_merge_rewrites_only_touched_buckets(spark, root):
    path = f"{root}/t"
    data = [(f"k{i}", i, "2024-01-05") for i in range(64)]
    replace_table(spark, path, _kv(spark, data), ["k"], buckets=16)
    before = _files(path)
    batch = _kv(spark, [("k1", -1, "2024-04-01"), ("new", 7, "2024-04-01")])
    touched = tables.buckets_of(batch, state(spark, path))
    assert merge_table(spark, path, batch, ["k"]).added_rows == 2
    after = _files(path)
    assert {b for b in after if after[b] != before.get(b)} == set(touched) and len(touched) < 3
    assert dict(rows(read_table(spark, path), "k", "v")) == {
        **{f"k{i}": i for i in range(64)}, "k1": -1, "new": 7,
    }


def test_a_load_reads_only_the_buckets_of_its_keys(spark, root, monkeypatch):
    first = tx(spark, [(f"t{i}", "2024-01-01") for i in range(200)])
    bronze.load_transactions(spark, root, first, DAY1, buckets=32)
    path, seen, read = bronze.table_path(root, "transactions"), [], tables.read_table

    def watched(spark, path, since=None, buckets=None):
        found = read(spark, path, since, buckets)
        seen.append((buckets, {int(f.split("_bucket=")[1].split("/")[0]) for f in found.inputFiles()}, found.count()))
        return found

    monkeypatch.setattr(bronze, "read_table", watched)
    batch = tx(spark, [("t5", "2024-01-02"), ("t1000", "2024-01-02")])
    bronze.load_transactions(spark, root, batch, DAY2)
    ((asked, opened, n),) = seen
    want = tables.buckets_of(batch, state(spark, path))
    assert asked == want and opened <= set(want)
    whole = read(spark, path)
    in_buckets = whole.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(32)).isin(want))
    assert n == in_buckets.filter(F.col("_ingested_at") == DAY1).count() < 40
    assert whole.count() == 201  # t5 was known


@pytest.mark.parametrize("buckets", [3, 1, 2])
def test_merges_equal_latest_per_key(spark, root, buckets):
    path = f"{root}/t"
    batches = [
        [(f"k{(i * 7 + n) % 40}", 100 * n + i, f"2024-0{n + 1}-{i % 28 + 1:02d}") for i in range(25)]
        for n in range(4)
    ]
    expected = {}
    for batch in batches:
        merge_table(spark, path, _kv(spark, batch), ["k"], buckets=buckets)
        expected |= {k: v for k, v, _ in batch}
    assert dict(rows(read_table(spark, path), "k", "v")) == expected


def test_null_keys_are_added_never_matched(spark, root):
    path = f"{root}/t"
    replace_table(spark, path, _kv(spark, [(None, 1, "2024-01-05")]), ["k"])
    merge_table(spark, path, _kv(spark, [(None, 2, "2024-01-06")]), ["k"])
    assert rows(read_table(spark, path), "v") == [(1,), (2,)]


@pytest.mark.parametrize("kind", ["replace", "append", "merge"])
def test_a_load_that_dies_leaves_the_table_alone(spark, root, kind):
    path = f"{root}/t"
    replace_table(spark, path, _kv(spark, [("a", 1, "2024-01-05")]), ["k"], keyed=kind != "append")
    before = state(spark, path)
    broken = F.when(F.col("k") == "b", F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int")
    batch = _kv(spark, [("a", 2, "2024-01-06"), ("b", 2, "2024-01-06")])
    write = {
        "replace": lambda df: replace_table(spark, path, df, ["k"]),
        "append": lambda df: tables.append_table(spark, path, df),
        "merge": lambda df: merge_table(spark, path, df, ["k"]),
    }[kind]
    with pytest.raises(Exception, match="lost"):
        write(batch.withColumn("v", broken))
    assert rows(read_table(spark, path), "k", "v") == [("a", 1)]
    assert state(spark, path) == before
    write(batch)  # and can be run again
    assert ("b", 2) in rows(read_table(spark, path), "k", "v")


def test_a_rebuild_without_its_last_step_is_not_seen(spark, root):
    path = f"{root}/t"
    replace_table(spark, path, _kv(spark, [("a", 1, "2024-01-05")]), ["k"])
    n = state(spark, path).load
    _kv(spark, [("x", 9, "2024-01-05")]).write.parquet(f"{path}/_load={n + 1}/_bucket=0")
    assert rows(read_table(spark, path), "k") == [("a",)]
    assert replace_table(spark, path, _kv(spark, [("b", 1, "2024-01-05")]), ["k"]).load == n + 2
    assert rows(read_table(spark, path), "k") == [("b",)]


# --- silver ---


@pytest.mark.parametrize("name", list(SILVER_KEYS))
def test_incremental_equals_full(spark, root, lake, name):
    dataset = SILVER_SOURCE[name]
    raw = lake.raw[dataset]
    marks = raw.select("_ingested_at").distinct().orderBy("_ingested_at").collect()
    cuts = [m[0] for m in marks[:: max(1, len(marks) // 3)]][1:] + [at("2100-01-01")]
    start = at("1900-01-01")
    for cut in cuts:
        part = raw.filter((F.col("_ingested_at") > start) & (F.col("_ingested_at") <= cut))
        bronze.backfill(spark, f"{root}/b", dataset, part)
        silver.refresh(spark, name, f"{root}/b", f"{root}/s", DAY1)
        start = cut
    again = silver.refresh(spark, name, f"{root}/b", f"{root}/s", DAY2)
    assert again.added_rows == 0
    got = read_table(spark, f"{root}/s/{name}").drop("_dbt_processed_at", "_silver_updated_at")
    assert same(lake.silver(name), got)


def test_empty_table_counts_as_never_loaded(spark, root, lake):
    bronze.create_bronze(spark, f"{root}/b", "sessions")
    silver.refresh(spark, "dim_sessions", f"{root}/b", f"{root}/s", DAY1)
    bronze.backfill(spark, f"{root}/b", "sessions", lake.raw["sessions"])
    assert silver.refresh(spark, "dim_sessions", f"{root}/b", f"{root}/s", DAY2).added_rows == 1000


# --- a whole run ---


def _deliver(lake, folder, condition):
    for dataset, file in medallion.FILES.items():
        df = lake.raw[dataset]
        if dataset == "affiliates":
            df = df.dropDuplicates(bronze.AFFILIATE_KEYS)
        elif dataset != "players":
            df = df.filter(condition)
        write_file(df, dataset, f"{folder}/{file}")


def test_two_hourly_runs(spark, root, lake):
    out = f"{root}/out"
    _deliver(lake, f"{root}/in1", "timestamp < '2024-01-15'")
    _deliver(lake, f"{root}/in2", "timestamp >= '2024-01-15'")
    medallion.run(spark, f"{root}/in1", out, DAY1)
    first = medallion.read_gold(spark, medallion.Layout(out))["fct_fraud_signals"].count()
    results = medallion.run(spark, f"{root}/in2", out, DAY2, store_failures=True)
    layout = medallion.Layout(out)
    gold, tables = medallion.read_gold(spark, layout), medallion.read_silver(spark, layout)
    assert tables["dim_sessions"].count() == 1000
    assert gold["fct_fraud_signals"].count() > first
    log = spark.read.parquet(layout.run_log)
    assert log.filter("error IS NOT NULL").isEmpty()
    assert log.filter("stage NOT IN ('late', 'rejected')").count() == 2 * 20
    metrics = spark.read.parquet(layout.metrics).filter(F.col("run_at") == DAY2)
    status = {r["check"]: r["status"] for r in metrics.collect()}
    assert status["volume:players"] == "ALERT" and status["row_count:players"] == "OK"
    assert {"valid_rows", "seconds:gold", "freshness_hours:transaction_timestamp"} <= set(status)
    for name in medallion.MARTS:
        assert read_table(spark, f"{layout.gold}/{name}").count() > 0
    assert not os.listdir(layout.work)
    failing = {tuple(r) for r in results.filter("failures > 0").select("table", "test").collect()}
    # Players are appended by both runs, and redeliveries repeat keys in bronze.
    assert ("raw_players", "unique") in failing and ("dim_players", "unique") not in failing
    stored = declared.read_failures(spark, layout.failures)
    of_players = stored.filter("`table` = 'raw_players' AND test = 'unique' AND `column` = 'player_id'")
    assert of_players.count() == 150 and of_players.filter("n_records <> 2").isEmpty()
    counts = stored.groupBy("table", "test", "column").agg(
        F.when(F.col("test") == "unique", F.count("value")).when(
            F.col("test") == "relationships", F.count("value")
        ).otherwise(F.sum("n_records")).alias("failures")
    )
    told = results.filter("failures > 0").select("table", "test", "column", "failures")
    assert rows(counts) == rows(told)


def test_a_failed_stage_is_logged(spark, root, lake):
    _deliver(lake, f"{root}/in", "timestamp < '2024-01-15'")
    lake.raw["players"].drop("email").limit(5).write.mode("overwrite").json(f"{root}/in/players.json")
    with pytest.raises(SourceError):
        medallion.run(spark, f"{root}/in", f"{root}/out", DAY1)
    log = spark.read.parquet(medallion.Layout(f"{root}/out").run_log)
    assert [(r["stage"], r["dataset"]) for r in log.filter("error IS NOT NULL").collect()] == [
        ("check", "players")
    ]


def test_added_columns_end_the_run_before_any_load(spark, root, lake):
    _deliver(lake, f"{root}/in", "timestamp < '2024-01-15'")
    people = lake.raw["players"].drop("_ingested_at").withColumn("vip", F.lit("x"))
    people.write.mode("overwrite").json(f"{root}/in/players.json")
    with pytest.raises(SourceError, match="vip"):
        medallion.run(spark, f"{root}/in", f"{root}/out", DAY1)
    assert not os.path.exists(f"{root}/out/bronze")


def test_late_events_are_counted_and_the_first_mark_moves(spark, root):
    rows_1999 = tx(spark, [("old", "1999-05-05"), ("new", "2024-01-01")])
    assert bronze.load_transactions(spark, f"{root}/a", rows_1999, DAY1) == 1
    assert bronze.load_transactions(
        spark, f"{root}/b", rows_1999, DAY1, first_mark=at("1990-01-01")
    ) == 0
    assert bronze.read_bronze(spark, f"{root}/b", "transactions").count() == 2


def test_work_tables_tell_inputs_apart(spark, root):
    from wagerlens.sources.scratch import WorkTables

    work = WorkTables(spark, f"{root}/work")
    few, many = spark.range(3), spark.range(5)
    assert (work.keep("t", few).count(), work.keep("t", many).count()) == (3, 5)
    assert work.keep("t", spark.range(3)).count() == 3 and len(os.listdir(f"{root}/work")) == 2


def test_mark_is_the_largest_time_of_all_folders(spark, root):
    path = bronze.table_path(root, "transactions")
    for day, ts in ((DAY1, "2024-01-09 10:00:00.000001"), (DAY2, "2024-01-05")):
        rows_of_day = bronze.with_stamp(tx(spark, [("t", ts)]), "transactions", day)
        bronze.backfill(spark, root, "transactions", rows_of_day)
    assert os.path.isdir(path)
    assert bronze.loaded_mark(spark, root, "transactions") == at("2024-01-09 10:00:00.000001")


def test_filter_before_dedup_equals_filter_after(lake):
    from wagerlens.operators.dedup import latest

    stg = lake.staging("transactions")
    keys, order = ["transaction_id"], ["transaction_timestamp", "amount"]
    newer = F.col("_ingested_at") > "2024-01-16"
    assert same(latest(stg, keys, order).filter(newer), latest(stg.filter(newer), keys, order))


def test_stored_times_keep_their_range(spark, root, lake):
    import pyarrow.parquet as pq

    replace_table(spark, f"{root}/t", lake.silver_model("dim_sessions"), ["session_id"])
    file = next(
        os.path.join(d, f) for d, _, fs in os.walk(f"{root}/t") for f in fs
        if f.endswith(".parquet") and tables.LOG not in d
    )
    meta = pq.ParquetFile(file).metadata.row_group(0)
    stats = {meta.column(i).path_in_schema: meta.column(i).statistics for i in range(meta.num_columns)}
    assert stats["_ingested_at"].has_min_max


def test_replaced_rows_are_deleted_and_the_table_stays(spark, root):
    path = f"{root}/t"
    for n in range(1, 5):
        replace_table(spark, path, _kv(spark, [("a", n, "2024-01-01")]))
    assert len([f for f in os.listdir(path) if f.startswith("_load=")]) == 4
    expire(spark, path, keep=2)
    assert rows(read_table(spark, path), "v") == [(4,)]
    assert [f for f in os.listdir(path) if f.startswith("_load=")] == ["_load=4"]
    assert sorted(f for f in os.listdir(f"{path}/{tables.LOG}")) == ["_load=3", "_load=4"]
    merged = f"{root}/m"
    for n in range(1, 5):
        batch = _kv(spark, [("a", n, "2024-01-01"), (f"k{n}", n, "2024-01-01")])
        merge_table(spark, merged, batch, ["k"])
    before = rows(read_table(spark, merged))
    expire(spark, merged)
    assert rows(read_table(spark, merged)) == before and len(before) == 5


def test_rows_added_since_a_load(spark, root):
    path = f"{root}/t"
    merge_table(spark, path, _kv(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-01")]), ["k"])
    first = state(spark, path).load
    merge_table(spark, path, _kv(spark, [("b", 2, "2023-01-01")]), ["k"])
    assert rows(tables.read_added(spark, path, first), "k", "v") == [("b", 2)]
    assert rows(tables.read_added(spark, path, 0), "k", "v") == [("a", 1), ("b", 2)]


def test_a_load_whose_folder_exists_is_refused(spark, root, monkeypatch):
    path = f"{root}/t"
    replace_table(spark, path, _kv(spark, [("a", 1, "2024-01-05")]), keyed=False)
    monkeypatch.setattr(tables, "_next_load", lambda *_: 2)  # two writers that start from one load
    tables.append_table(spark, path, _kv(spark, [("b", 1, "2024-01-05")]))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.append_table(spark, path, _kv(spark, [("c", 1, "2024-01-05")]))
    assert rows(read_table(spark, path), "k") == [("a",), ("b",)]


def test_rows_reach_silver_whatever_their_stamp(spark, root):
    b, s = f"{root}/b", f"{root}/s"

    def deliver(data, stamp):
        frame = tx(spark, [(i, f"2024-01-0{v}") for i, v in data])
        frame = frame.withColumn("amount", F.lit(float(data[0][1])))
        bronze.backfill(spark, b, "transactions", bronze.with_stamp(frame, "transactions", stamp))
        silver.refresh(spark, "fct_transactions", b, s, stamp)
        table = read_table(spark, f"{s}/fct_transactions")
        return rows(table.select("transaction_id", F.dayofmonth("transaction_timestamp")))

    assert deliver([("a", 1), ("b", 1)], DAY2) == [("a", 1), ("b", 1)]
    # A second delivery under the same stamp; ties of a key go to the later event.
    assert deliver([("c", 2), ("a", 2)], DAY2) == [("a", 2), ("b", 1), ("c", 2)]
    # An earlier stamp adds keys, but takes none from newer rows.
    assert deliver([("d", 3), ("a", 3)], DAY1) == [("a", 2), ("b", 1), ("c", 2), ("d", 3)]
    assert deliver([("b", 4)], DAY3) == [("a", 2), ("b", 4), ("c", 2), ("d", 3)]


def test_bad_rows_are_rejected_whole_with_their_text(spark, root):
    from wagerlens.sources.files import good_rows, parse_file, rejected_rows

    path = write(
        f"{root}/t.csv",
        "transaction_id,player_id,type,amount,timestamp\n"
        "t1,p, BET ,1.5,2024-01-01 10:00:00\n"
        "t2,p,bet,abc,2024-01-01 10:00:00\n"
        "t3,p,bet,2.5,yesterday\n"
        "t4,p,bet,,\n",
    )
    parsed = parse_file(spark, "transactions", path)
    assert rows(good_rows(parsed), "transaction_id", "type", "amount") == [
        ("t1", " BET ", 1.5), ("t4", "bet", None),
    ]
    texts = [t for _, t in rows(rejected_rows(parsed, "transactions"))]
    assert len(texts) == 2 and "abc" in texts[0] and "yesterday" in texts[1]
    people = [
        '{"player_id": "1", "email": "a", "city": "b", "created_at": "2024-01-05"}',
        '{"player_id": "2", "email"',
        '{"player_id": "3", "email": "a", "city": "b", "created_at": "someday"}',
        "",
    ]
    parsed = parse_file(spark, "players", write(f"{root}/p.json", "\n".join(people)))
    assert rows(good_rows(parsed), "player_id") == [("1",)]
    assert len(rows(rejected_rows(parsed, "players"))) == 2


def test_a_run_keeps_rejected_rows_and_logs_them(spark, root, lake):
    _deliver(lake, f"{root}/in", "timestamp < '2024-01-15'")
    lines = lake.raw["players"].drop("_ingested_at").limit(5).toJSON().collect()
    os.makedirs(f"{root}/in2")
    for name in os.listdir(f"{root}/in"):
        os.symlink(f"{root}/in/{name}", f"{root}/in2/{name}") if name != "players.json" else None
    write(f"{root}/in2/players.json", "\n".join([*lines, "{broken"]))
    medallion.run(spark, f"{root}/in2", f"{root}/out", DAY1)
    layout = medallion.Layout(f"{root}/out")
    assert rows(spark.read.parquet(layout.rejected), "dataset", "text") == [("players", "{broken")]
    log = spark.read.parquet(layout.run_log).filter("stage = 'rejected'")
    assert rows(log, "dataset", "rows_out") == [("players", 1)]


def test_a_load_counts_what_it_writes_without_reading_it(spark, root, monkeypatch):
    path, log, stamp = f"{root}/keyed", f"{root}/log", "2024-01-05 00:00:00.000001"
    monkeypatch.setattr(tables, "_stored", None)  # reads nothing
    keyed = replace_table(spark, path, _kv(spark, [("a", 1, "2024-01-03"), ("b", 2, stamp)]), ["k"])
    assert (keyed.added_rows, keyed.newest, keyed.high) == (2, at(stamp), None)
    tables.create_table(spark, log, _kv(spark, []).schema)
    for batch, n, high in (
        ([("a", 1, "2024-01-03"), (None, None, stamp)], 2, at(stamp)),
        ([("d", 1, "2024-01-02")], 1, at(stamp)), ([], 0, at(stamp)), ([("e", 1, "2024-02-01")], 1, at("2024-02-01")),
    ):
        got = tables.append_table(spark, log, _kv(spark, batch), "_ingested_at")
        assert (got.added_rows, got.newest, got.high) == (n, high, high)
        assert state(spark, log) == got
    monkeypatch.undo()
    # Rows that stay are not counted again.
    merged = merge_table(spark, path, _kv(spark, [("b", 9, "2024-01-01"), ("z", 1, "2024-01-02")]), ["k"])
    assert (merged.added_rows, merged.newest) == (2, at(stamp))
    assert merge_table(spark, path, _kv(spark, []), ["k"]).added_rows == 0
