from __future__ import annotations

import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wagerlens.llm import whitening
from wagerlens.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<double>, component string, x string, n string, s0 string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], VECTORS).repartition(3)


def exact(vectors, scale=64, shift=1_000_000):
    """n, x sums and the covariance as fractions, from the distinct vectors."""
    width = max(len(v) for v in vectors)
    full = [[*v, *[0.0] * (width - len(v))] for v in vectors]
    x = [tuple(math.floor(scale * c) + shift for c in v) for v in full]
    fitted = sorted(set(x))
    n = len(fitted)
    sums = [sum(c) for c in zip(*fitted)]
    centred = [[Fraction(a) - Fraction(s, n) for a, s in zip(v, sums)] for v in fitted]
    cov = [[sum(v[i] * v[j] for v in centred) / n for j in range(width)] for i in range(width)]
    return x, n, sums, np.array([[float(c) for c in r] for r in cov])


def check(rows, found, components=16):
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x, n, sums, cov = exact([v for _, v in usable])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    size = min(components, int((values > 1e-12 * np.trace(cov)).sum()))
    assert len(found) == len(usable) * size
    assert {r["n"] for r in found} == {n}
    assert len({r["identity_error"] for r in found}) == 1
    assert found[0]["identity_error"] <= 1e-4
    for r in found:
        k = r["component"] - 1
        assert r["explained"] == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
    deviations = Counter()
    for (i, _), v in zip(usable, x):
        deviations[i, sum((n * c - s) ** 2 for c, s in zip(v, sums))] += size
    assert Counter((r["vec_id"], r["deviation"]) for r in found) == deviations
    centred = {}
    for (i, _), v in zip(usable, x):
        centred[i] = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(v, sums)])
    gap = np.abs(np.diff(values)) > 1e-6 * values[0]
    by_component = defaultdict(list)
    for r in found:
        by_component[r["component"]].append(r)
    for c, some in by_component.items():
        alone = (c == 1 or gap[c - 2]) and (c == len(values) or gap[c - 1])
        if not alone:
            continue
        right = np.array([centred[r["vec_id"]] @ vectors[:, c - 1] for r in some]) / math.sqrt(values[c - 1])
        got = np.array([r["whitened"] for r in some])
        assert min(np.abs(got - right).max(), np.abs(got + right).max()) < 1e-7


def test_given_vectors_equal_brute_force(spark, sf_dir):
    found = QUERIES["op12_embedding_whitening"](spark, sf_dir).collect()
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    check([(r[0], r[1]) for r in given], found)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [-4.0, 0.5, 2.5]), (4, None), (5, [1.0, None, 2.0]),
        (6, [NAN, 1.0, 1.0]), (7, [INF, 0.0, 0.0]), (8, []), (9, [0.3]), (10, [9.0, -9.0, 0.01]),
        (11, [9.0, -9.0, 0.010001]), (3, [-4.0, 0.5, 2.5]),
    ]
    df = frame(spark, rows)
    found = whitening.whiten(df).collect()
    check(rows, found)
    nameless = whitening.whiten(df.withColumn("vec_id", F.when(F.col("vec_id") != 1, F.col("vec_id"))))
    size = max(r["component"] for r in found)
    assert nameless.filter("vec_id IS NULL").count() == size and nameless.count() == len(found)


def test_large_means_lose_nothing(spark):
    # Raw moments in doubles would lose all digits of these covariances.
    rng = np.random.RandomState(3)
    rows = [(i, [float(v) for v in 1e9 + rng.randint(0, 5, 4)]) for i in range(40)]
    found = whitening.whiten(frame(spark, rows)).collect()
    check(rows, found)


def test_constant_and_dependent_dimensions_have_fewer_components(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(6)]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 6
    check(rows, found)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, []), (2, [])]):
        found = whitening.whiten(frame(spark, rows))
        assert found.count() == 0
        assert found.columns == [c.split()[0] for c in whitening.OUT.split(", ")]


def test_what_does_not_fit_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [(1, [1e300]), (2, [0.0])])).collect()
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [(1, [1e12]), (2, [0.0])])).collect()
    with pytest.raises(ValueError, match="dimensions"):
        whitening.whiten(frame(spark, [(1, [1.0] * 9), (2, [0.0])]), max_dims=8)


def test_squares_of_large_values_are_exact():
    near = np.array([[2**33, -(2**32)], [2**34, 5]], dtype=np.int64)
    got = {i: (s, q) for i, s, q in whitening.squares(near)}
    a = [2**33, 2**34]
    b = [2**33 - 2**32, 2**34 + 5]
    assert got[0] == ([sum(a), sum(b)], [sum(v * v for v in a), sum(v * v for v in b)])
