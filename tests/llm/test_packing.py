from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from odd import TEXTS, library_ids, no_docs, odd_docs
from pyspark.sql import functions as F

from wagerlens.llm.packing import lightest_fit, pack, pack_documents, piece_rows
from wagerlens.llm.queries import QUERIES
from wagerlens.llm.tokens import Encoder, encoder, vocabulary

ODD = [
    "", " ", "  a", "a\n\nb", "x\r\ny \t z", "it's WE'LL I'd'", "É Ünïcode ÀÇ", "½ ² ª º µ ß",
    "a\xa0b\x85c", "\x1c\x1d a", "ﬁ é 漢字 🙂", "<|endoftext|> <|startoftext|>", "1234 5,6.7",
    "naïve—dash “q”", "ΟΔΟΣ Σ", "İstanbul", "a" * 300, "🙂" * 5,
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_give_the_ids_of_the_whole_text(name):
    coder, plain = Encoder(vocabulary(name)), library_ids(name)
    texts = [*ODD, " ".join(ODD), "".join(ODD), *[t for _, t, *_ in TEXTS if t and len(t) < 999]]
    for text in texts + texts:  # the second time from kept words
        assert coder.encode(text) == plain(text)
    assert coder.encode(None) == b""


def test_random_latin_texts_give_the_library_s_ids():
    rng = np.random.default_rng(5)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        coder, plain = encoder(vocabulary(name)), library_ids(name)
        for _ in range(300):
            text = "".join(map(chr, rng.choice([*range(1, 256), *[32] * 60, 10, 39], 40)))
            assert coder.encode(text) == plain(text), repr(text)


def test_longest_pieces_go_to_the_cheapest_sequence_with_room():
    lengths = np.array([90, 60, 50, 40, 30, 20, 10])
    sequence, offset = lightest_fit(lengths, 100)
    used = Counter()
    for s, o, n in zip(sequence, offset, lengths, strict=True):
        assert o == used[s]
        used[s] += n
    # 90 | 60 + 30 | 50 + 40, and 20 fits in none of them.
    assert sequence.tolist()[:5] == [0, 1, 2, 2, 1] and used[3] == 30
    assert [len(x) for x in lightest_fit(np.array([], dtype=int), 100)] == [0, 0]
    # Cost, not tokens, decides: one piece of 80 costs more than two of 45.
    sequence, _ = lightest_fit(np.array([80, 45, 45, 5]), 100, 0.0, 1.0)
    assert sequence[3] == sequence[1]


def check(rows, texts, vocab="word_bpe_49k.json", end=1, length=2048):
    plain = library_ids(vocab)
    want = Counter()
    for doc, text in texts:
        ids = plain(text) + np.array([end], "<u4").tobytes()
        n = len(ids) // 4
        want.update(
            (doc, a, min(length, n - a), zlib.crc32(ids[4 * a : 4 * (a + length)]), n)
            for a in range(0, n, length)
        )
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return by


def test_odd_documents(spark):
    rows = pack_documents(odd_docs(spark)).collect()
    check(rows, [(i, t) for i, t, *_ in TEXTS])
    assert pack_documents(no_docs(spark)).collect() == []


def test_query_packs_whole_documents_with_little_padding(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op1_cost_balanced_packing"](spark, sf_dir).collect()
    by = check(rows, docs)
    assert sum(r.length for r in rows) > 0.95 * 2048 * len(by)


def test_added_tokens_of_a_text_have_their_ids():
    ids = lambda name, text: np.frombuffer(Encoder(vocabulary(name)).encode(text), "<u4").tolist()
    assert ids("byte_bpe_50k.json", "hello <|endoftext|> world") == [31373, 220, 50256, 995]
    assert 49407 in ids("word_bpe_49k.json", "hello <|endoftext|> world")


def test_columns_named_like_the_result_stay(spark):
    docs = odd_docs(spark, clashing=False)
    pieces = piece_rows(docs, "word_bpe_49k.json", 1).withColumns(
        {c: F.lit(c) for c in ("offset", "sequence_id", "row", "group", "size")}
    )
    got = pack(pieces)
    assert got.columns == [*pieces.columns, "_sequence_id", "_offset"]
    rows = got.collect()
    assert len(rows) == pieces.count()
    assert all(r["offset"] == "offset" and r["sequence_id"] == "sequence_id" for r in rows)
