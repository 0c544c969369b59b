from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from odd import TEXTS, no_docs, odd_docs

from wagerlens.llm import simhash
from wagerlens.llm.components import components
from wagerlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids, max_bits=4):
    """Smallest id reachable from each place, by comparing all."""
    a = np.array(fps, dtype=np.uint64)
    label = list(range(len(a)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= max_bits).tolist():
            x, y = find(i), find(j)
            label[max(x, y)] = min(x, y)
    least = {}
    for i, doc in enumerate(ids):
        r = find(i)
        known = [x for x in (least.get(r), doc) if x is not None]
        least[r] = min(known) if known else None
    return [least[find(i)] for i in range(len(a))]


def test_fingerprints():
    for _, text, *_ in TEXTS:
        if text is None or len(text) < 999:
            assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_close_pairs_share_a_key(blocks):
    rng = np.random.default_rng(2)
    masks = simhash.block_masks(blocks, 4)
    for _ in range(200):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, 4, replace=False):
            b ^= 1 << int(bit)
        assert any(a & m == b & m for m in masks)


def test_spanning_links_connect_a_bucket():
    base = 0x0123456789ABCDEF
    near = [base] + [base ^ (1 << i) ^ (1 << (i + 1)) for i in range(40)] + [~base & (2**64 - 1)]
    links = simhash.spanning_links(np.array(near, dtype=np.uint64), 4)
    assert len(links) == 40


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, 7), (90, 80)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 80: 80, 90: 80}
    assert components(edges.limit(0)).collect() == []


def test_odd_documents(spark):
    got = simhash.near_duplicates(odd_docs(spark)).collect()
    fps = [plain_fingerprint(t) if t is None or len(t) < 999 else simhash.fingerprint(t) for _, t, *_ in TEXTS]
    want = plain_components(fps, [i for i, *_ in TEXTS])
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=key) == sorted(
        [(i, f"{f:016x}", c) for (i, *_), f, c in zip(TEXTS, fps, want, strict=True)], key=key
    )
    assert simhash.near_duplicates(no_docs(spark)).collect() == []


def test_one_of_each_group_stays(spark):
    docs = odd_docs(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # 3, 4 and 5 have no words; 9 and both 10 are copies; the two rows without an id as well.
    assert sorted(ids, key=lambda i: (i is None, i)) == [-11, 1, 2, 3, 6, 7, 8, 9, 12, None]


def test_crowded_buckets_are_sliced_without_losing_links(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**62))
    fps = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (300, 2))}
    fps |= set(rng.integers(0, 2**62, 200).tolist())
    fps = sorted(fps)
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.close_links(frame, bucket=8).collect()
    a = np.array(fps, dtype=np.uint64)
    assert all(bin(r.a ^ r.b).count("1") <= 4 for r in links)
    want = plain_components(fps, fps)
    edges = spark.createDataFrame([(r.a, r.b) for r in links], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert [got.get(f, f) for f in fps] == want
    assert len(a) == len(fps)


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in docs]
    want = plain_components(fps, [r.doc_id for r in docs])
    got = QUERIES["op3_simhash_near_duplicates"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == [
        (r.doc_id, f"{f:016x}", c) for r, f, c in zip(docs, fps, want, strict=True)
    ]
