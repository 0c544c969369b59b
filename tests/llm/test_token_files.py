from __future__ import annotations

import zlib

import numpy as np
import pytest
from odd import TEXTS, library_ids, no_docs, odd_docs

from wagerlens.llm.queries import QUERIES
from wagerlens.llm.token_files import (
    EliasFano,
    open_token_files,
    read_documents,
    token_file_digests,
    write_token_files,
)


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 3000])
@pytest.mark.parametrize("below", [1, 10, 1000, 10**6, 2**40])
def test_select_returns_every_value(n, below):
    values = np.sort(np.random.default_rng(n).integers(0, below, n))
    coded = EliasFano.of(values)
    assert (coded.values() == values).all()
    for i in {0, n - 1, n // 2, *range(0, n, 97)}:
        assert coded.select(i) == values[i]
    with pytest.raises(IndexError):
        coded.select(n)
    for first in {0, 1, n // 2, n - 1, *range(0, n, 200)}:
        for count in (1, 7, 256, 600):
            assert (coded.run(first, count) == values[first : first + count]).all()
    assert len(coded.run(n)) == 0


def test_space_is_near_the_least():
    values = np.sort(np.random.default_rng(1).integers(0, 10**7, 10_000))
    coded = EliasFano.of(values)
    size = len(coded.low) + len(coded.high) + len(coded.samples)
    assert 8 * size / 10_000 < 2.5 + np.log2(10**7 / 10_000)


def test_no_values():
    assert len(EliasFano.of(np.array([], dtype=np.int64)).values()) == 0


def expected(texts):
    """doc_id, start, n_tokens, crc by the library, in ascending doc_id order."""
    plain, at, out = library_ids("byte_bpe_50k.json"), 0, []
    for doc, text in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = plain(text) + b"\0\0\0\0"
        out.append((doc, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return out


def test_odd_documents(spark):
    got = token_file_digests(spark, odd_docs(spark)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected([(i, t) for i, t, *_ in TEXTS])
    assert token_file_digests(spark, no_docs(spark)).collect() == []


def test_many_small_blocks(spark, root):
    docs = odd_docs(spark)
    write_token_files(docs, f"{root}/t", block_ids=16)
    blocks = open_token_files(spark, f"{root}/t")
    assert blocks.count() > 5
    got = read_documents(blocks).select("doc_id", "n_tokens", "ids").collect()
    want = expected([(i, t) for i, t, *_ in TEXTS])
    key = lambda x: (x[0] is not None, x[0] or 0, x[2])
    assert sorted([(r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in got], key=key) == sorted(
        [(d, n, c) for d, _, n, c in want], key=key
    )


def test_query_against_the_library(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op2_elias_fano_token_files"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == expected(docs)


def test_documents_are_found_by_select(spark, monkeypatch):
    def unpacked(self):
        raise AssertionError("all values at once")

    monkeypatch.setattr(EliasFano, "values", unpacked)
    rows = [(i if i % 3 else None, f"text {i} " * (i % 5)) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_file_digests(spark, docs).collect()
    want = expected(rows)
    known = lambda found: sorted(map(tuple, (r for r in found if r[0] is not None)))
    assert known(got) == known(want)
    assert sorted(r[2:] for r in map(tuple, got) if r[0] is None) == sorted(r[2:] for r in want if r[0] is None)
