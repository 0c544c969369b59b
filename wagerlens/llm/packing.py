"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

The cost of a piece of n tokens is estimated as `linear * n + quadratic * n * n` (attention looks
back within a document only). Documents are cut at multiples of the sequence length; a piece that
fills a sequence is one. The rest goes, longest first, to the sequence of least cost that still
has room for it. Pieces are dealt into groups of about `group_pieces` by a hash of their row, each
group is packed by one task, and the number of sequences of a group is the least that can hold its
tokens; a piece that fits in none opens another one. Groups are independent, so tasks hold a few
thousand lengths each whatever the size of the corpus, and padding is that of a few sequences per
group.

Nulls, empty texts: a null text is empty and holds the end id alone. Null and repeated doc_ids are
rows like others. An empty table gives an empty result. Further columns are carried along; where one
is named `sequence_id` or `offset` already, the new column gets a `_` in front.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import fresh, importable, store
from wagerlens.llm.tokens import encoder, vocabulary

SEQUENCE = 2048
GROUP_PIECES = 4096
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
BATCH_IDS = 4_000_000


def piece_rows(
    docs: DataFrame, vocab: str, end_id: int, length: int = SEQUENCE
) -> DataFrame:
    """One row per piece: doc_id, doc_tokens, start, length and ids (little-endian 32 bit)."""
    importable(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("start", pa.int64()),
         ("length", pa.int64()), ("ids", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary(vocab)).encode
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            texts = batch.column(1)
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = encode(text.as_py()) + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc, total, start, len(part) // 4, part))
                held += total
                if held >= BATCH_IDS:
                    yield _batch(rows, schema)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, doc_tokens long, start long, length long, ids binary"
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def lightest_fit(
    lengths: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length; the lengths are taken in the order given."""
    least = max(1, -(-int(lengths.sum()) // capacity)) if len(lengths) else 0
    room = np.full(least, capacity, dtype=np.int64)
    cost = np.zeros(least)
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    for i, n in enumerate(lengths.tolist()):
        open_cost = np.where(room >= n, cost, np.inf)
        s = int(open_cost.argmin())
        if room[s] < n:
            s = len(room)
            room, cost = np.append(room, capacity), np.append(cost, 0.0)
        sequence[i], offset[i] = s, capacity - room[s]
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n
    return sequence, offset


def pack(
    pieces: DataFrame,
    capacity: int = SEQUENCE,
    group_pieces: int = GROUP_PIECES,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    length: str = "length",
) -> DataFrame:
    """The pieces with `sequence_id` and `offset`; no length may exceed the capacity.

    `pieces` is stored once with a number for each row, so that a task that is run again deals
    its rows into the same groups.
    """
    seq, off = fresh(pieces.columns, "sequence_id", "offset")
    row, group, size = fresh([*pieces.columns, seq, off], "row", "group", "size")
    kept = store(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    small = kept.filter(F.col(length) < capacity).select(row, F.col(length).alias(size))
    groups = max(1, -(-small.count() // group_pieces))

    def deal(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([size, row], ascending=[False, True])
        sequence, offset = lightest_fit(
            part[size].to_numpy(dtype=np.int64), capacity, linear, quadratic
        )
        first = int(part[group].iloc[0]) << 32
        return pd.DataFrame(
            {row: part[row].to_numpy(), seq: 2 * (first + sequence), off: offset}
        )

    dealt = (
        small.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups)))
        .groupBy(group)
        .applyInPandas(deal, f"`{row}` long, `{seq}` long, `{off}` long")
    )
    whole = kept.filter(F.col(length) >= capacity).select(
        "*", (2 * F.col(row) + 1).alias(seq), F.lit(0).cast("long").alias(off)
    )
    packed = kept.filter(F.col(length) < capacity).join(dealt, row)
    return packed.unionByName(whole).drop(row)


def pack_documents(
    docs: DataFrame, vocab: str = "word_bpe_49k.json", end_id: int = 1, length: int = SEQUENCE
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    The ids are digested in the pass that makes them; `pack(piece_rows(...))` carries them whole.
    """
    pieces = piece_rows(docs, vocab, end_id, length)
    digests = pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack(digests, length)
