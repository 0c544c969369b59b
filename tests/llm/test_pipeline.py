from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from odd import TEXTS, no_docs, odd_docs
from test_lines import plain
from test_simhash import plain_components

from wagerlens.llm import lines
from wagerlens.llm.langid import has_letter
from wagerlens.llm.simhash import fingerprint
from wagerlens.llm.tokens import Encoder, vocabulary

pipeline = pytest.importorskip("corpus_pipeline")


def through(spark, docs, sf_dir):
    """Each stage's output, written and read as the check does."""
    out = []
    for name, stage in pipeline.STAGES:
        docs = pipeline.store(stage(spark, docs, sf_dir), f"test-{name}")
        out.append(docs)
    return out


def plain_stages(rows):
    """Kept rows (doc_id, source, text) after the first three stages, one by one."""
    kept = [r for r in rows if has_letter(r[2])]
    clean = [
        (i, source, text)
        for i, source, text, _ in plain([(*r, "") for r in kept], lines.MAX_RATIO, lines.MIN_PAGES)
    ]
    first = {}
    names = plain_components([fingerprint(t) for *_, t in clean], [i for i, *_ in clean])
    for row, name in sorted(zip(clean, names, strict=True), key=lambda x: x[0][0]):
        first.setdefault(name, row)
    return kept, clean, list(first.values())


def pieces(rows):
    coder, out = Encoder(vocabulary("word_bpe_49k.json")), Counter()
    for i, _, text in rows:
        ids = coder.whole(text) if text else b""
        ids += np.array([1], "<u4").tobytes()
        n = len(ids) // 4
        out.update((i, a, min(2048, n - a), zlib.crc32(ids[4 * a : 4 * a + 8192]), n) for a in range(0, n, 2048))
    return out


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    a, b, c, d = through(spark, docs, sf_dir)
    for got, want in zip((a, b, c), plain_stages(rows), strict=True):
        assert got.columns == docs.columns
        assert sorted((r.doc_id, r.source, r.text) for r in got.collect()) == sorted(want)
    want = pieces(plain_stages(rows)[2])
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(tuple(r) for r in d.select(columns).collect()) == want
    assert c.count() < b.count()
    run = pipeline.run(spark, sf_dir).select(columns).collect()
    assert Counter(tuple(r) for r in run) == want


def test_odd_documents(spark, sf_dir):
    docs = odd_docs(spark)
    a, b, c, d = through(spark, docs, sf_dir)
    assert a.columns == b.columns == c.columns == docs.columns
    ids = [r.doc_id for r in c.collect()]
    assert sorted(i for i in ids if i is not None) == [-11, 1, 2, 7, 8, 9, 12]
    assert ids.count(None) == 1 and d.select("doc_id").distinct().count() == len(ids)
    assert len(TEXTS) > len(ids)
    assert through(spark, no_docs(spark), sf_dir)[-1].count() == 0
