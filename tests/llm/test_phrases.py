from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from odd import no_docs, odd_docs

from wagerlens.llm import phrases, quotient
from wagerlens.llm.queries import CHECKS, QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, min_count, max_words=5, top=2000):
    """The contract, word for word."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= min_count}
    out = {}
    for (lang, g), a in found.items():
        inside = [
            b for (other, h), b in found.items()
            if other == lang and len(h) > len(g) and 100 * b >= 100 * a
            and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
        ]
        if inside:
            continue
        cuts = [
            (1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]])
            for k in range(1, len(g))
        ]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), left, right))
    rows = []
    for lang, some in out.items():
        for rank, (score, a, g, left, right) in enumerate(sorted(some)[:top], 1):
            rows.append((lang, rank, g.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def given(df):
    return [(r[0], r[1]) for r in df.select("text", "lang").collect()]


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("chunk_bytes, range_keys", [(8 << 20, 2_000_000), (3000, 300)])
def test_given_documents_equal_brute_force(spark, sf_dir, chunk_bytes, range_keys):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    right = plain(given(docs), 10, top=100)
    assert len(right) > 100
    found = phrases.collocations(
        docs, min_count=10, top=100, chunk_bytes=chunk_bytes, range_keys=range_keys
    )
    assert got(found) == right


def test_odd_documents(spark):
    more = [
        ("New York\tNEW york. new YORK; new york", None), ("new york new york new york", "und"),
        ("a a a a a a", "xx"), ("É É é É", "xx"), ("\x00 \x00 \x1c x\x00y", "xx"), ("a b" * 30, ""),
    ]
    docs = odd_docs(spark).select("text", "lang", "row", "block").unionByName(
        spark.createDataFrame([(t, i, "x", "x") for t, i in more], "text string, lang string, row string, block string")
    )
    for least in (1, 2, 5):
        words = 3 if least == 1 else 5
        found = phrases.collocations(docs, min_count=least, max_words=words, top=40, chunk_bytes=2000)
        assert got(found) == plain(given(docs), least, words, top=40)


def test_texts_without_phrases(spark):
    assert phrases.collocations(no_docs(spark)).count() == 0
    rare = spark.createDataFrame([("one two three", "en"), (None, None), ("", "en")], "text string, lang string")
    assert phrases.collocations(rare).count() == 0


def test_two_limbs_and_many_copies(spark):
    # Over 2 ** 13 frequent words: five ids don't fit 64 bits.
    text = " ".join(f"w{i}" for i in range(9000))
    docs = spark.createDataFrame([(text, "en")] * 3 + [("w1 w2 w3 w4 w5 w1 w2", "en")], "text string, lang string").repartition(2)
    words, found, _ = phrases.phrase_counts(docs, min_count=3, chunk_bytes=70_000, range_keys=4000)
    assert words.count() == 9000
    sizes = Counter(len(r["words"]) for r in found.collect())
    assert sizes == {2: 8999, 3: 8998, 4: 8997, 5: 8996}
    assert {r["a"] for r in found.collect()} == {3, 4, 5}


def test_query_equals_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = c.execute(CHECKS["op13_phrase_collocations"])
    names = [d[0] for d in found.description]
    right = sorted(tuple(r[names.index(x)] for x in COLUMNS) for r in found.fetchall())
    assert got(QUERIES["op13_phrase_collocations"](spark, sf_dir)) == right


@pytest.mark.parametrize("words, bits, ranges", [(2, 1, 1), (2, 3, 5), (2, 17, 12), (3, 21, 7), (4, 16, 9),
                                                 (5, 17, 31), (5, 25, 3), (5, 31, 4), (2, 31, 1000)])
def test_filters_give_back_what_they_hold(words, bits, ranges):
    rng = np.random.RandomState(words * bits)
    ids = [rng.randint(0, 1 << bits, 5000) for _ in range(words)]
    ids = [np.concatenate([c, c[:700], np.repeat(c[:2], 300)]) for c in ids]
    right = Counter(zip(*(c.tolist() for c in ids)))
    layout = quotient.Layout(words, bits, min(ranges, 1 << min(30, 2 * bits)))
    half = len(ids[0]) // 2
    parts = []
    for some in (slice(0, half), slice(half, None)):
        limbs, counts = quotient.counted(layout.pack([c[some] for c in ids]))
        parts.append(dict(quotient.filters(layout, limbs, counts)))
    found = Counter()
    for r in set(parts[0]) | set(parts[1]):
        raws = [p[r] for p in parts if r in p]
        limbs, counts, places = quotient.merge(layout, r, raws)
        for raw, place in zip(raws, places):
            own, _ = quotient.read_filter(layout, r, raw)
            assert all((x[place] == y).all() for x, y in zip(limbs, own))
        for gram, n in zip(zip(*(c.tolist() for c in layout.unpack(limbs))), counts.tolist()):
            assert gram not in found
            found[gram] = n
    assert found == right


def test_filters_are_compact():
    rng = np.random.RandomState(1)
    layout = quotient.Layout(2, 17, 1)
    limbs, counts = quotient.counted(layout.pack([rng.randint(0, 1 << 17, 200_000) for _ in range(2)]))
    (_, raw), = quotient.filters(layout, limbs, counts)
    assert len(raw) < 4.5 * len(counts)  # of 34 bits a key, 17 and two bits of its place, and a counter


def test_trimmed_runs_hold_all_candidates():
    ids = np.array([1, 2, 3, -1, 4, 5, 6, 7, 8, -1])
    alive = np.array([0, 1, 4, 5, 7])  # bigrams 12, 23, 45, 56, 78
    assert phrases.trimmed(ids, alive, 2).tolist() == [1, 2, 3, -1, 4, 5, 6, -1]
