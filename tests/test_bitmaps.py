from __future__ import annotations

import random

from conftest import rows
from pyspark.sql import functions as F

from wagerlens.operators.bitmaps import dense_numbers, distinct_counts, distinct_sets, merged_sets


def test_numbers_are_dense(spark):
    names = spark.createDataFrame([(f"p{i % 500}",) for i in range(900)] + [(None,)], "k string")
    got = dense_numbers(names, "k", start=7)
    assert sorted(r["number"] for r in got.collect()) == list(range(7, 507))
    assert got.select("k").distinct().count() == 500
    assert dense_numbers(names.limit(0), "k").count() == 0


def test_sets_add_up_exactly(spark):
    rng = random.Random(9)
    data = [(rng.randint(0, 9), rng.choice(["a", "b", None]), rng.choice([1, 40_000, 32_768, 32_769, rng.randint(1, 100_000), None]))
            for _ in range(3000)]
    frame = spark.createDataFrame(data, "day int, kind string, number long").repartition(4)
    early, late = (distinct_sets(frame.filter(c), ["day", "kind"]) for c in ("day < 5", "day >= 3"))
    sets = merged_sets(early, late)  # two days are in both
    want = {}
    for day, kind, n in data:
        if n is not None:
            for key in ((day // 4, kind), (day // 4, "any"), ("all", "any")):
                want.setdefault(key, set()).add(n)
    half = F.floor(F.col("day") / 4).cast("int").alias("half")
    got = {(r.half, r.kind): r.n for r in distinct_counts(sets, [half, "kind"]).collect()}
    got |= {(r.half, "any"): r.n for r in distinct_counts(sets, [half]).collect()}
    got["all", "any"] = distinct_counts(sets, []).first()["n"]
    assert got == {k: len(v) for k, v in want.items()}
    assert rows(distinct_counts(sets.limit(0), ["kind"])) == []
