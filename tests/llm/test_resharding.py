from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import pytest
from odd import TEXTS, no_docs, odd_docs
from pyspark.sql import functions as F

from wagerlens.llm.queries import QUERIES
from wagerlens.llm.resharding import even, flows, plan_moves, reshard, rewrite, write_layout


def cheapest(supply, capacity, price):
    """Least total price over all ways to send whole bytes, by trying them."""
    best = None
    slots = [j for j, c in enumerate(capacity) for _ in range(c)]
    rows = [i for i, n in enumerate(supply) for _ in range(n)]
    for chosen in set(itertools.permutations(slots, len(rows))):
        cost = sum(price[i][j] for i, j in zip(rows, chosen, strict=True))
        best = cost if best is None else min(best, cost)
    return best


def test_flows_are_the_cheapest():
    rng = random.Random(6)
    for _ in range(25):
        supply = [rng.randint(0, 2) for _ in range(3)]
        capacity = [rng.randint(0, 3) for _ in range(3)]
        while sum(capacity) < sum(supply):
            capacity[rng.randrange(3)] += 1
        if sum(capacity) > 7:
            continue
        price = [[rng.randint(0, 4) for _ in range(3)] for _ in range(3)]
        sent = flows(supply, capacity, price)
        assert [sum(r) for r in sent] == supply
        assert all(sum(r[j] for r in sent) <= capacity[j] for j in range(3))
        cost = sum(sent[i][j] * price[i][j] for i in range(3) for j in range(3))
        assert cost == cheapest(supply, capacity, price)


def test_bytes_stay_where_they_fit():
    sent = flows([100, 20, 0, 60], even(180, 6))
    assert sum(sent[i][i] for i in range(4)) == 30 + 20 + 0 + 30
    assert [sum(r[j] for r in sent) for j in range(6)] == [30] * 6
    with pytest.raises(ValueError):
        flows([5], [4])


def check(rows, texts, shards=8):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert {r.law for r in rows} <= {"bytes"} and {r.grown_shard for r in rows} <= {None}
    sizes, slots = Counter(), {}
    for r in rows:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(sizes) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    filled = [sizes[j] for j in range(shards)]
    assert max(filled) - min(filled) <= max(s for _, s, _ in want)


def test_odd_documents(spark):
    old = F.pmod(F.xxhash64("source"), F.lit(3))
    check(reshard(odd_docs(spark), old).collect(), [(i, t) for i, t, *_ in TEXTS])
    assert reshard(no_docs(spark), old).collect() == []


def test_only_affected_files_are_rewritten(spark, sf_dir, root):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    layout = write_layout(docs, f"{root}/old", F.col("doc_id") % 3, least_block=4096)
    moves = plan_moves(layout, 4)
    new = rewrite(moves, f"{root}/new")
    assert new.count() == docs.count()
    assert new.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).isEmpty()
    total = layout.agg(F.sum("size")).first()[0]
    assert abs(moves.moved - total / 4) <= 3  # the new shard's share and no more
    whole = moves.joined(F.col("new_shard") == F.col("shard")).count()
    rewritten = spark.read.parquet(f"{root}/new").count()
    assert whole + rewritten == docs.count() and whole > 0.6 * docs.count()
    moved = new.filter("shard <> old").agg(F.sum("size")).first()[0]
    assert abs(moved - moves.moved) < 0.05 * total


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op7_minimum_cost_resharding"](spark, sf_dir).collect()
    check(rows, [tuple(r) for r in docs])


def test_rows_without_an_old_shard_and_clashing_columns_stay(spark, root):
    rows = [(i, f"text {i}", 5 * i, "mine", -i) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size long, shard string, old int")
    old = F.when(F.col("doc_id") % 2 == 0, F.col("old") % 3)  # null or not above zero
    check(reshard(docs, old).collect(), [(r[0], r[1]) for r in rows])
    layout = write_layout(docs, f"{root}/old", old, least_block=64)
    new = rewrite(plan_moves(layout, 4), f"{root}/new")
    got = new.select("doc_id", "text", "doc_size", "doc_shard", "doc_old").collect()
    assert sorted(map(tuple, got)) == rows


def test_copies_are_spread_over_blocks(spark, root):
    docs = spark.range(0, 4000, 1, 8).selectExpr("CAST(NULL AS LONG) AS doc_id", "'copy' AS text")
    layout = write_layout(docs, f"{root}/old", F.lit(0), least_block=16)
    blocks = [r[1] for r in layout.groupBy("block").count().collect()]
    assert len(blocks) >= 6 and max(blocks) < 2000
    check(reshard(docs, F.lit(0)).collect(), [(None, "copy")] * 4000)
