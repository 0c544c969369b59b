from __future__ import annotations

import zlib

import numpy as np
import pytest
from odd import TEXTS, no_docs, odd_docs

from wagerlens.llm import langid
from wagerlens.llm.queries import QUERIES
from wagerlens.llm.svm import train


def test_separable_rows_are_separated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    x[:, 4] = 1
    y = np.where(x[:, 0] - 2 * x[:, 1] + 0.3 > 0, 1, -1)
    w = train(x, y, cost=100.0, epochs=200)
    assert (np.sign(x @ w) == y).mean() > 0.97


def test_chunks_give_the_features_of_the_whole(monkeypatch):
    texts = ["Le été   est — là, 42 fois!", "a", "  ab\n\ncd " * 30]
    whole = langid.features(texts)
    monkeypatch.setattr(langid, "CHUNK_BYTES", 5)
    assert np.allclose(langid.features(texts), whole)


def test_letters():
    assert [langid.has_letter(t) for t in (None, "", "12 _!", "² ½ Ⅷ", "é", "漢", "1a")] == [
        False, False, False, False, True, True, True,
    ]


def test_family_comes_first_and_pairs_vote_within_it():
    rng = np.random.default_rng(1)
    langs = np.array(["en", "de", "nl", "fr", "ja"] * 40, dtype=object)
    x = rng.normal(scale=0.1, size=(200, 8)).astype(np.float32)
    for k, lang in enumerate(["en", "de", "nl", "fr", "ja"]):
        x[langs == lang, k] += 1
    x[:, 7] = 0.1
    model = langid.Model.fit(x, langs)
    assert model.families == ["germanic", "ja", "romance"]
    assert model.pairs["germanic"].shape[0] == 3 and set(model.pairs) == {"germanic"}
    names, score = model.predict(x)
    assert np.mean(np.array(names) == langs) > 0.95
    assert ((score >= 0) & (score <= 1)).all()
    assert langid.Model().predict(x[:2]) [0] == ["und", "und"]


def test_odd_documents(spark):
    docs = odd_docs(spark)
    got = langid.identify(docs).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        text = next(t for i, t, *_ in TEXTS if i == r.doc_id)
        known = langid.has_letter(text)
        assert (r.lang_pred == "und") == (not known) and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [-11, 1, 2, 7, 8, 9, 10, 10, 12]
    assert langid.identify(no_docs(spark)).collect() == []


def test_labels_and_held_out_rows_teach_nothing(spark):
    docs = odd_docs(spark, clashing=False)
    learned = langid.learnable(docs).collect()
    ids = {r.text for r in learned}
    for i, text, lang, *_ in TEXTS:
        fold = zlib.crc32(str(i).encode()) % 5 if i is not None else 0
        assert (text in ids) == (lang is not None and text is not None and fold != 0)
    assert langid.learnable(docs, sample_rows=2).count() <= 2


def test_repeated_ids_hide_no_language(spark):
    rows = [(1 + i % 4, f"a hot text {i}", "en") for i in range(400)]
    rows += [(100 + i, f"ein Text {i}", "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = langid.learnable(docs, sample_rows=10).collect()
    assert {r.lang for r in got} == {"en", "de"} and len(got) <= 10
    for lang in ("en", "de"):
        assert len({r.text for r in got if r.lang == lang}) == sum(r.lang == lang for r in got) <= 5


def test_every_language_is_learned_or_the_run_ends(spark):
    rows = [(i, f"text {i}", f"x{i % 250}") for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.learnable(docs, max_languages=250).collect()
    assert len({r.lang for r in got}) == 250
    with pytest.raises(ValueError, match="more than 200 languages"):
        langid.learnable(docs)


def test_held_out_accuracy(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang", "text")
    got = QUERIES["op4_hierarchical_language"](spark, path).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
