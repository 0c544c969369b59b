"""Sampled sentence-piece segmentations that repeat, and their lossless decoding.

All pieces of the vocabulary that match at some place of a text form a lattice. Forward filtering
sums the weights of all paths to each place; backward sampling walks from the end and picks each
piece with its share of that sum, so a segmentation comes with exactly its share of all of them.
A piece weighs `(rank + 1) ** -sharpness`, its rank being its place in the vocabulary's order.
Characters without a piece are written as bytes.

No piece has the blank mark behind another character, so the lattice of a text falls apart into
those of its words. A worker keeps the filtered lattices of words it has met, up to `KEPT_EDGES` pieces,
and starts anew beyond that. Shares are whole numbers of 2 ** -32 that are worked out word by word;
random numbers are a hash of the row key, the place in the text and the step. So ids depend on
nothing but key, text, vocabulary and seed: not on the batch, on neighbours or on what a worker
keeps, and a task that is run again draws them again.

Nulls, empty texts: both have no ids and decode to an empty text. Rows with equal keys and texts
are cut alike; a null key is a key. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import importable
from wagerlens.llm.tokens import vocabulary

MARK = "▁"
SHARPNESS = 0.3
# Shares of a place are cut into so many whole parts.
PARTS = 1 << 32
KEPT_EDGES = 4_000_000
BATCH_CHARS = 1_000_000
BATCH_ROWS = 256
# Stand-ins for the 256 bytes inside a lattice; the characters themselves have no piece.
BYTE_AT = 0x10FF00
BYTES = f"{chr(BYTE_AT)}-{chr(BYTE_AT + 255)}"
SPLITS = re.compile(rf"{MARK}*[^{MARK}{BYTES}]+|{MARK}+|[{BYTES}]")
CODE_BITS = 21


def piece_bytes(path: str) -> list[bytes]:
    """What each id stands for in a text."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            out.append(bytes([int(model.id_to_piece(i)[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            out.append(b"")
        else:
            out.append(model.id_to_piece(i).replace(MARK, " ").encode("utf-8"))
    return out


def decoded(ids: np.ndarray, pieces: list[bytes]) -> str:
    """The text that was cut into these ids."""
    return b"".join(map(pieces.__getitem__, ids.tolist()))[1:].decode("utf-8")


class Lattice:
    """Pieces and weights of a vocabulary; see `sample`."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        for i in range(size):
            if model.is_byte(i):
                self.ids[chr(BYTE_AT + int(model.id_to_piece(i)[3:-1], 16))] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                if MARK in piece.lstrip(MARK) or (len(piece) > 1 and piece[-1] >= chr(BYTE_AT)):
                    raise ValueError(f"piece {piece!r} crosses words")
                self.ids[piece] = i
        order = sorted(range(size), key=lambda i: (-model.get_score(i), i))
        self.log_weight = np.empty(size)
        self.log_weight[order] = -sharpness * np.log(np.arange(size) + 1.0)
        self._build_trie()
        self.forget()

    def _build_trie(self) -> None:
        """Edges as sorted numbers (node, code) and the nodes they lead to; a piece id per node."""
        edges: dict[int, int] = {}
        pieces = [-1]
        for piece, i in self.ids.items():
            node = 0
            for c in piece:
                edge = node << CODE_BITS | ord(c)
                if edge not in edges:
                    edges[edge] = len(pieces)
                    pieces.append(-1)
                node = edges[edge]
            pieces[node] = i
        self.edges = np.array(sorted(edges), dtype=np.int64)
        self.leads_to = np.array([edges[e] for e in self.edges.tolist()], dtype=np.int64)
        self.piece_at = np.array(pieces, dtype=np.int32)

    def prepared(self, text: str) -> str:
        """The text with its blanks marked, a leading blank, and uncovered characters as bytes."""
        odd = {
            c
            for c in set(text)
            if c != " " and (c == MARK or ord(c) >= BYTE_AT or c not in self.ids)
        }
        table = {c: "".join(chr(BYTE_AT + b) for b in c.encode("utf-8")) for c in odd}
        if any(c >= chr(BYTE_AT) for c in odd) or len(odd) > 16:
            text = text.translate(str.maketrans(table))
        else:
            for c, stand_ins in table.items():
                text = text.replace(c, stand_ins)
        return MARK + text.replace(" ", MARK)

    def matches(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """All pieces in all words: first place, end place, length up to there, piece id.

        A word of n characters has n + 1 places, numbered on from word to word.
        """
        code = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), sizes)
        stop = np.repeat(np.cumsum(sizes), sizes)
        at = np.arange(len(code))
        within = at - (stop - np.repeat(sizes, sizes))
        node = np.zeros(len(code), dtype=np.int64)
        found = []
        length = 0
        while len(at):
            edge = (node << CODE_BITS) | code[at + length]
            where = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            hit = self.edges[where] == edge
            at, node = at[hit], self.leads_to[where[hit]]
            length += 1
            piece = self.piece_at[node]
            some = piece >= 0
            first = at[some]
            place = first + word[first]
            found.append((place, place + length, within[first] + length, piece[some]))
            more = at + length < stop[at]
            at, node = at[more], node[more]
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def filtered(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """All pieces by end place, the likeliest of a place first: how far back each starts, its id,
        its end place, and the last part of the place that is its own.

        Sums run in logarithms, over all words at once, from the first place to the last. Parts are
        rounded piece by piece and summed as whole numbers, so they don't depend on other words.
        """
        start, end, depth, piece = self.matches(words)
        order = np.argsort(end, kind="stable")
        start, end, depth, piece = start[order], end[order], depth[order], piece[order]
        weight = self.log_weight[piece]
        share = np.empty(len(end))
        total = np.zeros(int(end[-1]) + 1)
        kind = np.uint16 if int(depth.max()) < 1 << 16 else np.int64
        by_depth = np.argsort(depth.astype(kind), kind="stable")
        sizes = np.bincount(depth)
        stops = np.cumsum(sizes)
        for stop, size in zip(stops.tolist(), sizes.tolist(), strict=True):
            if not size:
                continue
            some = by_depth[stop - size : stop]
            ends = end[some]
            cuts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
            lots = np.diff(np.r_[cuts, size])
            value = total[start[some]] + weight[some]
            most = np.maximum.reduceat(value, cuts)
            part = np.exp(value - np.repeat(most, lots))
            summed = np.add.reduceat(part, cuts)  # each sum from its own pieces, in their order
            total[ends[cuts]] = most + np.log(summed)
            share[some] = part / np.repeat(summed, lots)
        parts = np.rint(share * PARTS).astype(np.int64)
        order = np.argsort((end << 33) - parts, kind="stable")  # of equal ones the shorter first
        start, end, piece, parts = start[order], end[order], piece[order], parts[order]
        cuts = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])
        lots = np.diff(np.r_[cuts, len(end)])
        run = np.cumsum(parts)  # below 2 ** 63 for 2 ** 31 places
        run -= np.repeat(run[cuts] - parts[cuts], lots)
        run[cuts + lots - 1] = PARTS
        return end - start, piece, end, run - 1

    def _keep(self, words: list[str]) -> None:
        """Filter words that were not met yet and add their pieces to the kept ones."""
        back, piece, end, run = self.filtered(words)
        sizes = np.array([len(w) + 1 for w in words])
        edges = np.bincount(end, minlength=int(sizes.sum()))
        kept = len(self.kept_back)
        first = kept + np.cumsum(edges) - edges
        self.kept_base.extend(len(self.kept_first) + np.cumsum(sizes) - sizes)
        self.kept_size.extend(sizes)
        self.kept_first.extend(first)
        self.kept_back.extend(back)
        self.kept_piece.extend(piece)
        self.kept_run.extend(run)

    def forget(self) -> None:
        """Start anew with no words kept."""
        self.known = Numbered()
        self.kept_base, self.kept_size = Growing(np.int64), Growing(np.int64)  # per word
        self.kept_first = Growing(np.int64)  # per place: its first piece
        self.kept_back, self.kept_piece = Growing(np.uint16), Growing(np.uint32)  # per piece
        self.kept_run = Growing(np.uint32)

    def sample(self, keys: list, texts: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if len(self.kept_back) > KEPT_EDGES:
            self.forget()
        met = len(self.known)
        words: list[int] = []
        per_text = []
        for text in texts:
            cut = SPLITS.findall(self.prepared(text)) if text else []
            words.extend(map(self.known.__getitem__, cut))
            per_text.append(len(cut))
        if not words:
            return np.empty(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        if len(self.known) > met:
            self._keep(self.known.listed)
            self.known.listed.clear()
        per_text = np.array(per_text)
        word = np.array(words)
        text_of = np.repeat(np.arange(len(texts)), per_text)
        within = np.arange(len(word)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        state = mixed(row_seeds(keys, seed)[text_of] + within.astype(np.uint64) * GOLDEN)
        base = self.kept_base.rows[word]
        node = base + self.kept_size.rows[word] - 1
        first, run = self.kept_first.rows, self.kept_run.rows
        back, piece = self.kept_back.rows, self.kept_piece.rows
        live = np.arange(len(word))
        picked, owner = [], []
        step = 0
        while len(live):
            step += 1
            salt = np.uint64(step * int(GOLDEN) % (1 << 64))
            drawn = (mixed(state[live] + salt) >> np.uint64(32)).astype(np.uint32)
            edge = first[node[live]]
            more = np.flatnonzero(run[edge] < drawn)
            while len(more):  # likely pieces come first, so few draws look at many
                edge[more] += 1
                more = more[run[edge[more]] < drawn[more]]
            picked.append(piece[edge])
            owner.append(live)
            node[live] -= back[edge]
            live = live[node[live] > base[live]]
        counts = np.bincount(np.concatenate(owner), minlength=len(word))
        ends = np.cumsum(counts)
        ids = np.empty(int(ends[-1]), dtype=np.uint32)
        for before, (own, chosen) in enumerate(zip(owner, picked, strict=True)):
            ids[ends[own] - 1 - before] = chosen
        return ids, np.bincount(text_of, weights=counts, minlength=len(texts)).astype(np.int64)


class Numbered(dict):
    """Numbers words as they come; `listed` are those that were not filtered yet."""

    def __init__(self):
        super().__init__()
        self.listed: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.listed.append(word)
        return number


class Growing:
    """An array that is added to at its end, in space that doubles."""

    def __init__(self, kind):
        self._all = np.empty(1024, dtype=kind)
        self._n = 0

    def __len__(self) -> int:
        return self._n

    @property
    def rows(self) -> np.ndarray:
        return self._all[: self._n]

    def extend(self, rows: np.ndarray) -> None:
        end = self._n + len(rows)
        if end > len(self._all):
            grown = np.empty(max(end, 2 * len(self._all)), dtype=self._all.dtype)
            grown[: self._n] = self.rows
            self._all = grown
        self._all[self._n : end] = rows
        self._n = end


GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix whose outputs for successive inputs look random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def row_seeds(keys: list, seed: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    found = [xxh64_intdigest(repr(k).encode("utf-8"), seed) for k in keys]
    return np.array(found, dtype=np.uint64)


_LATTICES: dict[tuple, Lattice] = {}


def lattice(path: str, sharpness: float = SHARPNESS) -> Lattice:
    """One lattice per worker process, vocabulary and sharpness."""
    if (path, sharpness) not in _LATTICES:
        _LATTICES[path, sharpness] = Lattice(path, sharpness)
    return _LATTICES[path, sharpness]


@cache
def _pieces(path: str) -> list[bytes]:
    return piece_bytes(path)


def _short_runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, up to BATCH_CHARS bytes of text (or one text) at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
    run = np.cumsum(sizes)
    first = 0
    while first < batch.num_rows:
        before = int(run[first - 1]) if first else 0
        end = max(first + 1, int(np.searchsorted(run, before + BATCH_CHARS, side="right")))
        yield batch.slice(first, end - first)
        first = end


def encode_sampled(
    docs: DataFrame,
    key: str = "doc_id",
    vocab: str = "piece_bpe_32k.model",
    sharpness: float = SHARPNESS,
    seed: int = 0,
) -> DataFrame:
    """key, text, n_tokens, ids (little-endian 32 bit) of every whole text."""
    importable(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = lattice(vocabulary(vocab), sharpness)
        for batch in batches:
            for rows in _short_runs(batch):
                keys, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                ids, counts = cutter.sample(keys, texts, seed)
                ends = np.concatenate(([0], np.cumsum(counts)))
                raw = ids.astype("<u4").tobytes()
                parts = [
                    raw[4 * a : 4 * b]
                    for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(counts), pa.array(parts, pa.binary())],
                    names=["key", "text", "n_tokens", "ids"],
                )

    return docs.select(
        F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text")
    ).mapInArrow(encode, "key long, text string, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, vocab: str = "piece_bpe_32k.model") -> DataFrame:
    """Adds `decoded`, the text that the column `ids` stands for."""
    importable(encoded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(vocabulary(vocab))
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for first in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(first, BATCH_ROWS)
                ids = (np.frombuffer(x.as_py(), dtype="<u4") for x in rows.column(at))
                texts = pa.array([decoded(x, pieces) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, texts], names=[*rows.schema.names, "decoded"]
                )

    schema = encoded.select(*encoded.columns).schema
    return encoded.mapInArrow(decode, schema.add("decoded", "string"))


def sampled_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, text_crc32 (of the decoded text), lossless."""
    done = decode_ids(encode_sampled(docs))
    return done.select(
        F.col("key").alias("doc_id"),
        "n_tokens",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("decoded").cast("binary")).alias("text_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )
