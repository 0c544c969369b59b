from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from odd import TEXTS, no_docs, odd_docs

from wagerlens.llm.queries import QUERIES
from wagerlens.llm.sampling import (
    MARK,
    Lattice,
    decode_ids,
    decoded,
    encode_sampled,
    piece_bytes,
)
from wagerlens.llm.tokens import vocabulary


@pytest.fixture(scope="module")
def lattice():
    return Lattice(vocabulary("piece_bpe_32k.model"))


def paths(lattice, word):
    """Every segmentation of a prepared word with its weight."""
    if not word:
        return {(): 1.0}
    out = {}
    for n in range(1, len(word) + 1):
        if word[:n] in lattice.ids:
            i = lattice.ids[word[:n]]
            for rest, w in paths(lattice, word[n:]).items():
                out[(i, *rest)] = w * float(np.exp(lattice.log_weight[i]))
    return out


def test_each_segmentation_comes_with_its_share(lattice):
    word = "there"
    want = paths(lattice, MARK + word)
    total = sum(want.values())
    n = 40_000
    ids, counts = lattice.sample(list(range(n)), [word] * n)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    got = Counter(tuple(p.tolist()) for p in parts)
    assert set(got) <= set(want)
    for path, weight in want.items():
        share = weight / total
        assert abs(got[path] / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1e-4


def test_samples_repeat_and_depend_on_the_key_alone(lattice):
    texts = ["some words to be cut", "other words", "some words to be cut", "", None]
    a, n = lattice.sample([1, 2, 3, 4, 5], texts)
    b, m = lattice.sample([2, 1], [texts[1], texts[0]])
    first, second = a[: n[0]], a[n[0] : n[0] + n[1]]
    assert (np.r_[second, first] == b).all() and m.tolist() == [n[1], n[0]]
    assert n[3] == n[4] == 0
    many, sizes = lattice.sample(list(range(50)), [texts[0]] * 50)
    assert len({tuple(p) for p in np.split(many, np.cumsum(sizes)[:-1])}) > 10


def test_decoding_is_lossless(lattice):
    odd = [t or "" for _, t, *_ in TEXTS] + [
        " ", "  lead", "trail  ", "\n\n", MARK, f"a{MARK} b", "\U0010ff41\U0010ffff", "\x00", "x" * 70_000,
        "日本語テキスト", "é" * 40, "é", "\r\n\t",
    ]
    ids, counts = lattice.sample(list(range(len(odd))), odd)
    pieces = piece_bytes(vocabulary("piece_bpe_32k.model"))
    for text, part in zip(odd, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert decoded(part, pieces) == text


def test_the_library_decodes_alike(lattice):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    text = "The quick  brown fox,\njumps – été 漢字"
    ids, _ = lattice.sample([1], [text])
    assert model.decode(ids.tolist()) == text


def test_odd_documents(spark):
    docs = odd_docs(spark)
    got = decode_ids(encode_sampled(docs)).collect()
    assert len(got) == len(TEXTS)
    assert all(r.decoded == (r.text or "") and len(r.ids) == 4 * r.n_tokens for r in got)
    again = {(r.key, r.text): r.ids for r in encode_sampled(docs.repartition(5)).collect()}
    assert all(again[r.key, r.text] == r.ids for r in got)
    assert decode_ids(encode_sampled(no_docs(spark))).collect() == []


def test_query_is_lossless(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op9_sampled_segmentation"](spark, sf_dir).collect()
    assert len(got) == len(docs) and all(r.lossless for r in got)
    assert all(r.text_crc32 == zlib.crc32((docs[r.doc_id] or "").encode()) for r in got)


def test_ids_depend_on_nothing_but_key_and_text(lattice, monkeypatch):
    from wagerlens.llm import sampling

    rng = np.random.RandomState(4)
    letters = list("abcdefghijklmnopqrstuvwxyzé")
    word = lambda: "".join(rng.choice(letters, rng.randint(1, 14)))
    texts = [" ".join(word() for _ in range(40)) for _ in range(300)] + ["zz" * 5000]
    keys = list(range(len(texts)))
    lattice.forget()
    together, counts = lattice.sample(keys, texts)
    edges = {w: (int(lattice.kept_base.rows[i]), int(lattice.kept_size.rows[i])) for w, i in lattice.known.items()}
    parts = {w: _parts(lattice, *at) for w, at in edges.items()}
    for size in (1, 100):
        lattice.forget()
        found = [lattice.sample(keys[i : i + size], texts[i : i + size])[0] for i in range(0, len(keys), size)]
        assert (np.concatenate(found) == together).all()
    lattice.forget()
    lattice.sample([0], [" ".join(word() for _ in range(60_000))])
    assert len(lattice.known) > 40_000
    after, sizes = lattice.sample(keys, texts)
    assert (after == together).all() and (sizes == counts).all()
    for w, p in parts.items():
        i = lattice.known[w]
        assert p == _parts(lattice, int(lattice.kept_base.rows[i]), int(lattice.kept_size.rows[i]))
    monkeypatch.setattr(sampling, "KEPT_EDGES", 100)
    found = [lattice.sample(keys[i : i + 7], texts[i : i + 7])[0] for i in range(0, len(keys), 7)]
    assert (np.concatenate(found) == together).all()
    assert len(lattice.known) < 500


def _parts(lattice, base, size):
    """Parts of every place of a kept word; each place's end with the whole."""
    firsts = lattice.kept_first.rows[base + 1 : base + size].tolist()
    out = []
    for first in firsts:
        row = []
        while not row or row[-1] < (1 << 32) - 1:
            row.append(int(lattice.kept_run.rows[first + len(row)]))
        out.append(row)
    return out
