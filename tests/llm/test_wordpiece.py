from __future__ import annotations

import random

from odd import TEXTS, no_docs, odd_docs

from wagerlens.llm.queries import QUERIES
from wagerlens.llm.tokens import vocabulary
from wagerlens.llm.wordpiece import Automaton, split_vocabulary, token_counts

VOCAB = "piece_bpe_32k.model"


def greedy(word, begin, go_on):
    """Longest match from the left, piece by piece; -1 if a part has none."""
    at, n = 0, 0
    while at < len(word):
        pieces = go_on if at else begin
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_automaton_equals_greedy_matching_on_random_vocabularies():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc") for _ in range(rng.randint(1, n)))
    for _ in range(60):
        begin = {word(5) for _ in range(rng.randint(0, 12))}
        go_on = {word(5) for _ in range(rng.randint(0, 12))}
        machine = Automaton(begin, go_on)
        for _ in range(60):
            w = word(14)
            assert machine.count(w) == greedy(w, begin, go_on), (w, begin, go_on)


def library():
    from tokenizers import Tokenizer
    from tokenizers.models import WordPiece
    from tokenizers.pre_tokenizers import BertPreTokenizer

    begin, go_on = split_vocabulary(vocabulary(VOCAB))
    names = ["[UNK]", *begin, *(f"##{p}" for p in go_on)]
    tokenizer = Tokenizer(
        WordPiece({p: i for i, p in enumerate(names)}, unk_token="[UNK]", max_input_chars_per_word=10**9)
    )
    tokenizer.pre_tokenizer = BertPreTokenizer()
    return tokenizer


def test_odd_documents_against_the_library(spark):
    tokenizer = library()
    got = token_counts(odd_docs(spark)).collect()
    want = []
    for i, text, *_ in TEXTS:
        ids = tokenizer.encode(text or "").ids
        words = len(tokenizer.pre_tokenizer.pre_tokenize_str(text or ""))
        want.append((i, words, len(ids), ids.count(0)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_counts(no_docs(spark)).collect() == []


def test_query_against_the_library(spark, sf_dir):
    tokenizer = library()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.n_unknown) for r in QUERIES["op6_longest_match_counts"](spark, sf_dir).collect()}
    for r in docs:
        ids = tokenizer.encode(r.text or "").ids
        assert got[r.doc_id] == (len(ids), ids.count(0))
