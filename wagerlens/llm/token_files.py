"""Token-id files: blocks of concatenated ids with Elias-Fano coded document boundaries.

A file set is a Parquet folder whose rows are blocks of documents in ascending doc_id order. A
block holds the ids of its documents one after another (16 bits each if the vocabulary allows, else
32), and two monotone sequences in Elias-Fano form: where each document ends, and the doc_ids. Such
a sequence of n values below u takes about 2 + log2(u / n) bits a value, and a table of every 256th
set bit lets `select` find one value without reading the others; no 64-bit offsets are stored.

Nulls, empty texts: a null text is empty and holds the end id alone; null doc_ids come first.
Documents that share a doc_id are ordered by a hash of their text. An empty table gives an empty
file set. Columns other than doc_id and text are not stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import importable
from wagerlens.llm.tokens import encoder, vocabulary
from wagerlens.sources.scratch import scratch_dir

STEP = 256
BLOCK_IDS = 1 << 19
BLOCK_DOCS = 1 << 16

BLOCK = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int32()),
     ("n_null", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()),
     ("ends_bits", pa.int32()), ("ends_low", pa.binary()), ("ends_high", pa.binary()),
     ("ends_select", pa.binary()), ("first_doc", pa.int64()),
     ("docs_bits", pa.int32()), ("docs_low", pa.binary()), ("docs_high", pa.binary()),
     ("docs_select", pa.binary())]
)
BLOCK_DDL = (
    "shard int, block int, n_docs int, n_null int, n_ids long, width int, ids binary,"
    " ends_bits int, ends_low binary, ends_high binary, ends_select binary, first_doc long,"
    " docs_bits int, docs_low binary, docs_high binary, docs_select binary"
)


@dataclass(frozen=True)
class EliasFano:
    """n values in ascending order: low bits packed, high parts in unary, every 256th set bit."""

    n: int
    bits: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """Values are non-negative and never fall."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        bits = max(0, int(int(values[-1]) // n).bit_length() - 1)
        places = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(bool)
        low = np.packbits(places.reshape(-1), bitorder="little").tobytes() if bits else b""
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        ones = np.zeros(int(at[-1]) + 1, dtype=bool)
        ones[at] = True
        high = np.packbits(ones, bitorder="little").tobytes()
        return cls(n, bits, low, high, at[::STEP].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """Value i, from at most the bits between two samples."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        samples = np.frombuffer(self.samples, dtype="<u4")
        at, left = int(samples[i // STEP]), i % STEP
        while left:
            window = np.frombuffer(self.high, np.uint8, offset=at // 8)[: STEP // 4]
            ones = np.flatnonzero(np.unpackbits(window, bitorder="little")) + at // 8 * 8
            ones = ones[ones > at][:left]
            at = int(ones[-1]) if len(ones) else (at // 8 + len(window)) * 8 - 1
            left -= len(ones)
        return ((at - i) << self.bits) | self._low(i)

    def _low(self, i: int) -> int:
        first, last = i * self.bits, (i + 1) * self.bits
        part = int.from_bytes(self.low[first // 8 : -(-last // 8)], "little")
        return (part >> (first % 8)) & ((1 << self.bits) - 1)

    def run(self, first: int, count: int = STEP) -> np.ndarray:
        """Values first .. first + count - 1 (fewer at the end) by select: from the samples around
        them and the bits between, whatever the length of the sequence."""
        last = min(self.n, first + count)
        if not 0 <= first < last:
            return np.zeros(0, dtype=np.int64)
        samples = np.frombuffer(self.samples, dtype="<u4")
        begin = int(samples[first // STEP])
        stop = (last - 1) // STEP + 1
        end = int(samples[stop]) if stop < len(samples) else 8 * len(self.high)
        window = np.frombuffer(self.high, np.uint8)[begin // 8 : -(-end // 8)]
        ones = np.flatnonzero(np.unpackbits(window, bitorder="little")) + begin // 8 * 8
        skip = int(np.searchsorted(ones, begin)) + first % STEP
        at = ones[skip : skip + last - first]
        high = (at - np.arange(first, last)).astype(np.uint64)
        if not self.bits:
            return high.astype(np.int64)
        bit = first * self.bits
        flat = np.unpackbits(np.frombuffer(self.low, np.uint8)[bit // 8 : -(-last * self.bits // 8)], bitorder="little")
        places = flat[bit % 8 : bit % 8 + (last - first) * self.bits].reshape(-1, self.bits).astype(np.uint64)
        low = (places << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return ((high << np.uint64(self.bits)) | low).astype(np.int64)

    def values(self) -> np.ndarray:
        """All values, as `select` gives them one by one."""
        ones = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = (np.flatnonzero(ones)[: self.n] - np.arange(self.n)).astype(np.uint64)
        if not self.bits:
            return high.astype(np.int64)
        flat = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
        places = flat[: self.n * self.bits].reshape(self.n, self.bits).astype(np.uint64)
        low = (places << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return ((high << np.uint64(self.bits)) | low).astype(np.int64)


def _block(shard: int, number: int, docs: list, parts: list[bytes], width: int) -> tuple:
    ids = np.frombuffer(b"".join(parts), dtype="<u4")
    ends = EliasFano.of(np.cumsum([len(p) // 4 for p in parts], dtype=np.int64))
    known = np.array([d for d in docs if d is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    names = EliasFano.of(known.view(np.uint64) - np.int64(first).view(np.uint64))
    return (
        shard, number, len(docs), len(docs) - len(known), len(ids), width,
        ids.astype("<u2" if width == 2 else "<u4").tobytes(),
        ends.bits, ends.low, ends.high, ends.samples,
        first, names.bits, names.low, names.high, names.samples,
    )


def _record(row: tuple) -> pa.RecordBatch:
    arrays = [pa.array([v], type=f.type) for v, f in zip(row, BLOCK, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=BLOCK)


def write_token_files(
    docs: DataFrame,
    path: str,
    vocab: str = "byte_bpe_50k.json",
    end_id: int = 0,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode whole texts, each followed by `end_id`, and write them in ascending doc_id order.

    Texts are dealt out by doc_id range and sorted before they are encoded, so ids are made by the
    task that writes them and are never shuffled.
    """
    importable(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary(vocab))
        width = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], dtype="<u4").tobytes()
        shard, number = TaskContext.get().partitionId(), 0
        docs_held: list = []
        parts: list[bytes] = []
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                parts.append(coder.encode(text.as_py()) + end)
                docs_held.append(doc)
                held += len(parts[-1]) // 4
                if held >= block_ids or len(parts) >= BLOCK_DOCS:
                    yield _record(_block(shard, number, docs_held, parts, width))
                    docs_held, parts, held, number = [], [], 0, number + 1
        if parts:
            yield _record(_block(shard, number, docs_held, parts, width))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("tie"),
        # Copies of one row are told apart by the task that reads them, or all would meet in one range.
        F.spark_partition_id().alias("copy"),
    )
    (
        rows.repartitionByRange("doc_id", "tie", "copy")
        .sortWithinPartitions("doc_id", "tie", "copy")
        .select("doc_id", "text")
        .mapInArrow(blocks, BLOCK_DDL)
        .write.option("compression", "zstd")
        .option("parquet.block.size", 8 << 20)
        .parquet(path)
    )


def block_starts(blocks: DataFrame) -> DataFrame:
    """shard, block, base: ids before each block.

    Sums run per shard, then over one row per shard; there are as many shards as the writing job
    had tasks, so the one task of the last step sees no more rows than that.
    """
    sizes = blocks.select("shard", "block", "n_ids")
    inside = Window.partitionBy("shard").orderBy("block")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select(
        "shard", F.coalesce(F.sum("shard_ids").over(before), F.lit(0)).alias("shard_base")
    )
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("block_base", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(shards, "shard")
        .select("shard", "block", (F.col("shard_base") + F.col("block_base")).alias("base"))
    )


def read_documents(blocks: DataFrame) -> DataFrame:
    """shard, block, doc_id, first (ids before it in its block), n_tokens, ids (32 bit)."""
    importable(blocks.sparkSession)
    schema = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()),
         ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                ids = np.frombuffer(b["ids"], "<u2" if b["width"] == 2 else "<u4").astype("<u4")
                n, null = b["n_docs"], b["n_null"]
                ends = EliasFano(
                    n, b["ends_bits"], b["ends_low"], b["ends_high"], b["ends_select"]
                )
                names = EliasFano(
                    n - null, b["docs_bits"], b["docs_low"], b["docs_high"], b["docs_select"]
                )
                raw = ids.tobytes()
                for at in range(0, n, STEP):
                    # Where the documents of a run lie is found by select; no table of all ends is made.
                    stops = ends.run(at)
                    before = ends.select(at - 1) if at else 0
                    starts = np.concatenate(([before], stops[:-1]))
                    known = names.run(max(0, at - null), min(at + STEP, n) - max(at, null))
                    unknown = [None] * (len(stops) - len(known))
                    parts = [
                        raw[4 * s : 4 * e] for s, e in zip(starts.tolist(), stops.tolist(), strict=True)
                    ]
                    many = len(stops)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([b["shard"]] * many, pa.int32()),
                            pa.array([b["block"]] * many, pa.int32()),
                            pa.array(unknown + (known + b["first_doc"]).tolist(), pa.int64()),
                            pa.array(starts, pa.int64()),
                            pa.array(stops - starts, pa.int64()),
                            pa.array(parts, pa.binary()),
                        ],
                        schema=schema,
                    )

    return blocks.mapInArrow(
        documents, "shard int, block int, doc_id long, first long, n_tokens long, ids binary"
    )


def open_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_DDL).parquet(path)


def token_file_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from files written for the purpose."""
    path = scratch_dir(spark, "token-files")
    write_token_files(docs, path)
    blocks = open_token_files(spark, path)
    found = read_documents(blocks).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return found.join(block_starts(blocks), ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
