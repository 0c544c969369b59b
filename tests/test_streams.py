"""Streaming forms against the batch models and against plain Python."""

from __future__ import annotations

import os
import random
from collections import Counter
from datetime import timedelta

import pytest
from conftest import at, rows, same
from pyspark.sql import functions as F

from wagerlens.plans import fraud
from wagerlens.schemas import FILE_SCHEMAS
from wagerlens.sources import bronze, tables
from wagerlens.sources.files import write_file
from wagerlens.streaming import ingest, live

START = at("2024-01-01")
TX = "player_id string, transaction_id string, transaction_type string, transaction_timestamp timestamp, amount decimal(18,2)"


def drained(spark, stored, transform, root):
    stored.write.parquet(f"{root}/in")
    stream = transform(spark.readStream.schema(stored.schema).parquet(f"{root}/in"))
    running = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/check")
        .trigger(availableNow=True).start(f"{root}/out")
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def test_cycles_of_a_hot_player_are_spread_over_tasks(spark, root):
    rng = random.Random(2)
    data = []
    for i in range(900):
        player = "hot" if i % 3 == 0 else f"p{rng.randint(0, 60)}"
        moment = START + timedelta(seconds=rng.choice([rng.randint(0, 200_000), 3600 * rng.randint(0, 50)]))
        data.append((player, f"t{i}", rng.choice(["deposit", "withdraw"]), moment, None))
    tx = spark.createDataFrame(data, TX).withColumn("amount", F.lit(1).cast("decimal(18,2)"))
    got = drained(spark, tx, lambda s: live.rapid_cycles(s, "60 hours"), root)
    want = fraud.rapid_cycles(tx)
    assert rows(got, "deposit_id", "withdraw_id") == rows(want, "deposit_id", "withdraw_id")
    assert want.filter("player_id = 'hot'").count() > 50
    kept = spark.read.format("statestore").option("joinSide", "left").load(f"{root}/check")
    of_hot = kept.filter(F.col("key.field0") == "hot").groupBy("partition_id").count()
    assert of_hot.count() >= 4  # one without the hours


def test_live_sharing_counts_distinct_players(spark, root):
    rng = random.Random(3)
    data = [
        (rng.choice(["a", "b", None]), rng.choice(["p", "q", "r", "s", None]), START + timedelta(seconds=rng.randint(0, 20_000)))
        for _ in range(400)
    ]
    frame = spark.createDataFrame(data, "ip string, player_id string, session_timestamp timestamp")
    got = drained(spark, frame, live.ip_sharing_per_hour, root)
    logins, players = Counter(), {}
    for ip, player, t in data:
        slot = START + timedelta(minutes=10 * ((t - START) // timedelta(minutes=10)))
        for k in range(6):
            key = (ip, slot - timedelta(minutes=10 * k))
            logins[key] += 1
            players.setdefault(key, set()).update([player] if player else [])
    closed = max(t for *_, t in data) - timedelta(minutes=10)
    want = sorted(
        ((ip, s, n, len(players[ip, s])) for (ip, s), n in logins.items() if s + timedelta(hours=1) <= closed), key=repr
    )
    assert rows(got, "ip", "hour_start", "logins", "distinct_players") == want and len(want) > 30


VERSION = "k string, v long, t timestamp, _ingested_at timestamp"


def deliver(spark, root, n, data):
    frame = spark.createDataFrame([(k, v, at(t), at(i)) for k, v, t, i in data], VERSION)
    frame.coalesce(1).write.parquet(f"{root}/{n}")
    (name,) = [f for f in os.listdir(f"{root}/{n}") if f.startswith("part-")]
    os.makedirs(f"{root}/versions", exist_ok=True)
    os.rename(f"{root}/{n}/{name}", f"{root}/versions/{n}-{name}")
    os.utime(f"{root}/versions/{n}-{name}", (1_700_000_000 + n, 1_700_000_000 + n))


def follow(spark, root):
    rows_in = spark.readStream.schema(VERSION).option("maxFilesPerTrigger", 1).parquet(f"{root}/versions")
    order = ["_ingested_at", "v"]
    changes = live.latest_per_key(rows_in, ["k"], order, "t", "2 days")
    live.store_latest(changes, f"{root}/latest", ["k"], order, f"{root}/check").awaitTermination()
    return rows(tables.read_table(spark, f"{root}/latest"), "k", "v")


def test_a_later_delivery_corrects_what_a_stream_has_stored(spark, root):
    deliver(spark, root, 0, [
        ("a", 1, "2024-01-01 10:00", "2024-01-05"), ("b", 1, "2024-01-01 11:00", "2024-01-05"),
        ("b", 2, "2024-01-01 11:00", "2024-01-05"), ("c", 9, "2024-01-01 12:00", "2024-01-05"),
    ])
    deliver(spark, root, 1, [
        ("a", 3, "2024-01-01 10:30", "2024-01-06"),  # newer
        ("b", 7, "2024-01-02 11:00", "2024-01-04"),  # older, of another day
        ("c", None, "2024-01-01 12:00", "2024-01-05"),  # NULL is the smallest
    ])
    assert follow(spark, root) == [("a", 3), ("b", 2), ("c", 9)]
    # The event time moves to another day, by which state of the first is gone afterwards.
    deliver(spark, root, 2, [("a", 4, "2024-01-20 10:00", "2024-01-07")])
    deliver(spark, root, 3, [
        ("a", 0, "2024-01-20 10:00", "2024-01-06"), ("d", 5, "2024-01-19 10:00", "2024-01-07"),
    ])
    assert follow(spark, root) == [("a", 4), ("b", 2), ("c", 9), ("d", 5)]
    deliver(spark, root, 4, [("b", 8, "2024-01-02 11:00", "2024-01-30")])  # late
    assert follow(spark, root) == [("a", 4), ("b", 2), ("c", 9), ("d", 5)]
    assert not os.listdir(f"{root}/check-run")


def delivery(spark, root, n, data):
    frame = spark.createDataFrame(
        [(i, "p", "ip", "ios", at(t)) for i, t in data], FILE_SCHEMAS["sessions"]
    )
    write_file(frame.coalesce(1), "sessions", f"{root}/part{n}")
    os.makedirs(f"{root}/in", exist_ok=True)
    (name,) = [f for f in os.listdir(f"{root}/part{n}") if f.startswith("part-")]
    os.rename(f"{root}/part{n}/{name}", f"{root}/in/{n}-{name}")
    os.utime(f"{root}/in/{n}-{name}", (1_700_000_000 + n, 1_700_000_000 + n))


# Later files hold older events; one key comes twice.
BACKLOG = [
    [("a", "2024-01-09"), ("b", "2024-01-08")], [("c", "2024-01-02"), ("a", "2024-01-09")],
    [("d", "2024-01-05"), ("e", "2023-12-31")], [("f", "2024-01-03")],
]


def load(spark, root, name, max_files, now=at("2024-02-01")):
    return ingest.ingest_available(
        spark, "sessions", f"{root}/in", f"{root}/{name}", f"{root}/{name}-check", lambda: now,
        max_files=max_files,
    )


def test_a_backlog_in_batches_gives_the_rows_of_one(spark, root):
    delivery(spark, root, 0, [("first", "2024-01-01")])
    for name, files in (("one", 1000), ("cut", 1)):
        load(spark, root, name, files).awaitTermination()
    for n, data in enumerate(BACKLOG, 1):
        delivery(spark, root, n, data)
    for name, files in (("one", 1000), ("cut", 1)):
        running = load(spark, root, name, files)
        running.awaitTermination()
        assert len(running.recentProgress) >= (4 if files == 1 else 1)
        assert not os.path.exists(f"{root}/{name}-check-run")
    one, cut = (bronze.read_bronze(spark, f"{root}/{n}", "sessions") for n in ("one", "cut"))
    # Rows of one batch are not told apart, so a key that is in it twice goes in twice.
    assert same(one.distinct(), cut) and rows(cut, "session_id") == [
        (k,) for k in ("a", "b", "c", "d", "f", "first")
    ]


def test_a_run_after_a_failure_keeps_the_mark(spark, root, monkeypatch):
    delivery(spark, root, 0, [("first", "2024-01-01")])
    load(spark, root, "b", 1).awaitTermination()
    for n, data in enumerate(BACKLOG, 1):
        delivery(spark, root, n, data)
    calls, real = [], bronze.LOADS["sessions"]

    def broken(*args, **options):
        calls.append(options["mark"])
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args, **options)

    monkeypatch.setitem(bronze.LOADS, "sessions", broken)
    with pytest.raises(Exception, match="lost"):
        load(spark, root, "b", 1).awaitTermination()
    load(spark, root, "b", 1).awaitTermination()
    assert set(calls) == {at("2024-01-01")}
    got = rows(bronze.read_bronze(spark, f"{root}/b", "sessions"), "session_id")
    assert got == [(k,) for k in ("a", "b", "c", "d", "f", "first")]
    # The next backlog has a mark of its own.
    delivery(spark, root, 9, [("late", "2024-01-04"), ("new", "2024-01-10")])
    load(spark, root, "b", 1).awaitTermination()
    assert ("late",) not in rows(bronze.read_bronze(spark, f"{root}/b", "sessions"), "session_id")
    assert calls[-1] == at("2024-01-09")
