"""Token counts by greedy longest match, in one pass over each word.

The vocabulary is a trie with two roots: one for pieces that begin a word and one for pieces that
continue it. Each node has a failure link, the node for what is left of its string once its longest
pieces are taken off the front, and the number of pieces taken off. Where no edge goes on, the
automaton adds that number and follows the link, so a word is read once and no piece is built.
A word that can't be cut into pieces counts as one unknown token.

Words are runs of characters without white space and punctuation; a punctuation character is a
word. The vocabulary is taken from a sentence-piece file: pieces that start with its blank mark
begin words, others continue them.

Nulls, empty texts: both have no words and no tokens. Null doc_ids and repeated rows are counted
like others; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import importable
from wagerlens.llm.tokens import vocabulary

MARK = "▁"
KEPT_WORDS = 400_000
# Fixed value: punctuation is Unicode's, and all of ASCII that is no letter, digit or blank.
WORD = r"[\p{P}$+<=>^`|~]|[^\s\p{P}$+<=>^`|~]+"


class Automaton(dict):
    """Maps words to token counts; a negative count is that of an unknown word."""

    def __init__(self, begin: Iterable[str], go_on: Iterable[str]):
        super().__init__()
        self.next: list[dict[str, int]] = [{}, {}]  # nodes 0 and 1 are the two roots
        ends: set[int] = set()
        for root, pieces in ((0, begin), (1, go_on)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                    node = self.next[node][c]
                if node != root:
                    ends.add(node)
        self.fail: list[int] = [-1] * len(self.next)
        self.popped: list[int] = [0] * len(self.next)
        self._link(ends)

    def _link(self, ends: set[int]) -> None:
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for c, node in self.next[parent].items():
                queue.append(node)
                if node in ends:
                    self.fail[node], self.popped[node] = 1, 1
                    continue
                at, taken = self.fail[parent], self.popped[parent]
                while at >= 0 and c not in self.next[at]:
                    taken += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.next[at][c], taken

    def __missing__(self, word: str) -> int:
        count = self.count(word)
        if len(self) < KEPT_WORDS and len(word) <= 64:
            self[word] = count
        return count

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match of a word, or -1 if it has none."""
        node, tokens = 0, 0
        for c in word:
            while c not in self.next[node]:
                if self.fail[node] < 0:
                    return -1
                tokens += self.popped[node]
                node = self.fail[node]
            node = self.next[node][c]
        while node != 1:
            if self.fail[node] < 0:
                return -1
            tokens += self.popped[node]
            node = self.fail[node]
        return tokens


def split_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that continue one, of a sentence-piece file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    begin, go_on = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        bare = piece.removeprefix(MARK)
        if bare and MARK not in bare:
            (begin if piece != bare else go_on).append(bare)
    return begin, go_on


_AUTOMATA: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """One automaton per worker process and vocabulary."""
    if path not in _AUTOMATA:
        _AUTOMATA[path] = Automaton(*split_vocabulary(path))
    return _AUTOMATA[path]


def token_counts(docs: DataFrame, vocab: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every whole text."""
    importable(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        words, pieces = regex.compile(WORD), automaton(vocabulary(vocab))
        for batch in batches:
            found = []
            for text in batch.column(1):
                counts = list(map(pieces.__getitem__, words.findall(text.as_py() or "")))
                unknown = counts.count(-1)
                found.append((len(counts), sum(counts) + 2 * unknown, unknown))
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", "n_words", "n_tokens", "n_unknown"]
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(count, "doc_id long, n_words long, n_tokens long, n_unknown long")
