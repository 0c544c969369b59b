from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wagerlens.llm import exact_topk, multiindex
from wagerlens.llm.queries import CHECKS, QUERIES

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<double>, label int, row string, cell string"


def odd_rows():
    rows = [
        (1, [1.0, 0.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0, 0.0]),
        (4, None), (5, []), (6, [0.0, 0.0, 0.0, 0.0]), (7, [1.0, None, 0.0, 0.0]),
        (8, [NAN, 1.0, 0.0, 0.0]), (9, [INF, 1.0, 0.0, 0.0]), (10, [0.0, -1.0, 0.0, 0.0]),
        (11, [1e300, 0.0, 0.0, 0.0]), (12, [0.0, 0.0, 1e-300, 0.0]), (50, [1.0, 0.0, 0.0, 0.0]),
        (50, [1.0, 0.0, 0.0, 0.0]), (None, [0.0, 0.0, 1.0, 0.0]), (0, [0.0, 0.0, 1.0, 0.01]),
        (100, [0.5, 0.5]),
    ]
    return [(i, v, 1, "x", "x") for i, v in rows]


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def plain_links(rows, cosine=0.9):
    """vec_id, links, component of every row by comparing all."""
    width = max(len(v or []) for _, v, *_ in rows)
    units = []
    for _, v, *_ in rows:
        if usable(v) and any(v):
            x = np.zeros(width)
            x[: len(v)] = v
            x = x / np.abs(x).max()
            units.append(x / np.sqrt(x @ x))
        else:
            units.append(np.full(width, np.nan))
    close = np.array(units) @ np.array(units).T >= cosine
    np.fill_diagonal(close, False)
    label = np.arange(len(rows))
    while True:
        new = np.array([min([label[i], *label[close[i]]]) for i in range(len(rows))])
        if (new == label).all():
            break
        label = new
    out = []
    for i, (vec, *_) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(label == label[i]) if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vec, int(close[i].sum()), least, vec is not None and vec == least))
    return out


def test_cells_come_nearest_first():
    rng = np.random.default_rng(0)
    one, two = rng.random(9), rng.random(7)
    sums = sorted((a + b, i, j) for i, a in enumerate(one) for j, b in enumerate(two))
    got = multiindex.multi_sequence(one, two, 40)
    assert got == [(i, j) for _, i, j in sums[:40]]
    assert len(multiindex.multi_sequence(one, two, 999)) == 63


def test_odd_vectors(spark):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = multiindex.near_vectors(frame).collect()
    assert Counter(map(tuple, got)) == Counter(plain_links(rows))
    assert multiindex.near_vectors(frame.limit(0)).collect() == []
    none = frame.filter("vec_id in (4, 6, 8)")
    assert sorted(map(tuple, multiindex.near_vectors(none).collect())) == [
        (i, 0, i, True) for i in (4, 6, 8)
    ]


def test_crowded_cells_are_sliced(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=8)
    x = np.r_[centre + 0.05 * rng.normal(size=(120, 8)), rng.normal(size=(200, 8))]
    rows = [(i, v.tolist(), 0, "x", "x") for i, v in enumerate(x)]
    monkeypatch.setattr(multiindex, "SLICE", 16)
    got = multiindex.near_vectors(spark.createDataFrame(rows, VECTORS), recall=1.0).collect()
    want = plain_links(rows)
    assert sum(r.n_links for r in got) >= 0.97 * sum(w[1] for w in want)
    assert all(r.n_links <= w[1] for r, w in zip(sorted(got), sorted(want), strict=True))
    core = {r.component_id for r in got if r.vec_id < 120}
    assert core == {w[2] for w in want if w[0] < 120}


def paired(rng, points, pairs, dims=16, cosine=0.905):
    """Random vectors, and `pairs` more, each at the given cosine to one of them."""
    x = rng.normal(size=(points, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=(pairs, dims))
    side -= (side * x[:pairs]).sum(axis=1)[:, None] * x[:pairs]
    side /= np.linalg.norm(side, axis=1)[:, None]
    return np.r_[x, cosine * x[:pairs] + (1 - cosine**2) ** 0.5 * side]


def test_rare_links_are_found(spark):
    x = paired(np.random.default_rng(3), 1500, 30)
    rows = [(i, v.tolist(), 0, "x", "x") for i, v in enumerate(x)]
    got = multiindex.near_vectors(spark.createDataFrame(rows, VECTORS), queries=2).collect()
    assert sorted(map(tuple, got)) == sorted(plain_links(rows))


def test_copies_have_no_say_in_recall(spark):
    rng = np.random.default_rng(4)
    x = paired(rng, 500, 300)
    x[400:410] = x[400] + 0.01 * rng.normal(size=(10, 16))
    rows = [(i, v.tolist(), 0, "x", "x") for i, v in enumerate(x)]
    hot = [(1000 + i, x[400].tolist(), 0, "x", "x") for i in range(30_000)]
    frame = spark.createDataFrame(rows + hot, VECTORS).repartition(3)
    got = {r.vec_id: r.n_links for r in multiindex.near_vectors(frame).collect()}
    want = [w for w in plain_links(rows) if not 400 <= w[0] < 410]
    assert sum(got[w[0]] for w in want) >= 0.99 * sum(w[1] for w in want)


def test_links_count_for_both_ends(spark, monkeypatch):
    x = paired(np.random.default_rng(5), 800, 300)
    rows = [(i, v.tolist(), 0, "x", "x") for i, v in enumerate(np.r_[x, x[:5]])]
    monkeypatch.setattr(multiindex, "visits_needed", lambda *_: 2)
    got = multiindex.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    size = Counter(r.component_id for r in got)
    links = {w[0]: w[1] for w in plain_links(rows)}
    assert all(r.n_links <= links[r.vec_id] for r in got)
    small = [r for r in got if size[r.component_id] == 2]
    assert len(small) > 300
    assert all(r.n_links == 1 for r in small)


def plain_top(rows, step=50, k=5):
    kept = [(i, v) for i, v, *_ in rows if i is not None and usable(v)]
    whole = [[math.floor(256 * x) for x in v] for _, v in kept]
    out = []
    for q, (i, _) in enumerate(kept):
        if i % step:
            continue
        scores = [
            (-sum(a * b for a, b in zip(whole[q], whole[c], strict=False)), kept[c][0], c)
            for c in range(len(kept)) if c != q
        ]
        out += [(i, r + 1, v, -s) for r, (s, v, _) in enumerate(sorted(scores)[:k])]
    return out


def test_top_k_of_odd_vectors(spark):
    rows = [r for r in odd_rows() if r[0] != 11]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    asked = F.col("vec_id") % 50 == 0
    for block in (4096, 3):
        got = exact_topk.top_k(frame, asked, block=block).collect()
        assert Counter(map(tuple, got)) == Counter(plain_top(rows))
    assert exact_topk.top_k(frame.limit(0), asked).collect() == []
    assert exact_topk.top_k(frame.filter("vec_id = 0"), asked).collect() == []


def test_top_k_of_large_components(spark):
    asked = F.col("vec_id") % 50 == 0
    frame = lambda rows: spark.createDataFrame([(i, v, 1, "x", "x") for i, v in rows], VECTORS)
    rows = [(0, [2e6, 0.0]), (1, [2e6, 0.0]), (2, [3e6, 0.0])]
    got = exact_topk.top_k(frame(rows), asked).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2, 393216000000000000), (0, 2, 1, 262144000000000000)]
    # Products of single terms pass 64 bits, the sums that are returned don't.
    rows = [(0, [4e7, 4e7, 1.0]), (1, [4e7, -4e7, 3.0]), (2, [4e7, -4e7, 2.0]), (3, [-4e7, 3e7, 0.0]),
            (50, [1.0, 0.5, -2.0])]
    got = exact_topk.top_k(frame(rows), asked, k=2).collect()
    assert Counter(map(tuple, got)) == Counter(plain_top(rows, k=2))
    with pytest.raises(Exception, match="too large for a long"):
        exact_topk.top_k(frame([(0, [4e7] * 40), (1, [4e7] * 40)]), asked).collect()
    with pytest.raises(Exception, match="too large for a long"):
        exact_topk.top_k(frame([(0, [1.0]), (11, [1e300])]), asked).collect()


def test_top_k_equals_sql_on_large_components(spark):
    duckdb = pytest.importorskip("duckdb")
    rows = [(i, [2e6 * ((i * 7) % 5 - 2), 1e6 * (i % 3), 0.25 * i]) for i in range(60)]
    frame = spark.createDataFrame([(i, v, 1, "x", "x") for i, v in rows], VECTORS)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    cursor = con.execute(CHECKS["op10_exact_top_k"])
    names = [d[0] for d in cursor.description]
    df = exact_topk.top_k(frame, F.col("vec_id") % 50 == 0)
    want = sorted(tuple(r[names.index(c)] for c in df.columns) for r in cursor.fetchall())
    assert sorted(map(tuple, df.collect())) == want


def test_bound_keeps_every_link_of_both_halves():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16)) * 3
    x = multiindex.unit(np.concatenate([c + 0.3 * rng.normal(size=(40, 16)) for c in centres]))
    grid = multiindex.Grid.learn(x, 8)
    one, two = grid.gaps(x)
    home = one.argmin(axis=1), two.argmin(axis=1)
    far = [np.array([np.sqrt(g[h == k, k]).max(initial=-1) for k in range(8)]) for g, h in zip((one, two), home)]
    held = np.zeros((8, 8), dtype=bool)
    held[home] = True
    reach = multiindex.Reach(*far, held)
    close = x @ x.T >= 0.9
    visited = 0
    for k in range(len(x)):
        ways = reach.ways(one[k], two[k], 0.2 + 1e-6)
        gap = one[k][ways // 8] + two[k][ways % 8]
        assert (np.diff(gap) >= 0).all()
        assert set((home[0] * 8 + home[1])[close[k]]) <= set(ways.tolist())
        visited += len(ways)
    assert visited < 0.5 * len(x) * held.sum()  # both halves rule cells out


@pytest.mark.parametrize("name", ["op8_multi_index_near_vectors", "op10_exact_top_k"])
def test_queries_against_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    df = QUERIES[name](spark, sf_dir)
    cursor = con.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(r[names.index(c)] for c in df.columns) for r in cursor.fetchall())
    assert sorted(map(tuple, df.collect())) == want
