"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Two 64-bit fingerprints that differ in at most `max_bits` places, cut into `blocks` blocks, agree
on at least `blocks - max_bits` whole blocks. Every choice of that many blocks gives one join key;
a close pair meets under at least one. Each bucket of fingerprints with one key is compared in
full, and only edges that connect it are kept (at most one fewer than its members), so a group of
near copies yields no more edges than members, while every link joins its two ends.

Equal fingerprints are one entry from the start, so copies cost nothing here. A bucket of more
than `bucket` fingerprints is cut into slices by a hash; each pair of slices is compared in a task
of its own.

Nulls, empty texts: a null text is empty; texts without words have fingerprint zero and link like
any other. Null doc_ids belong to components but never name one unless no other id does.
Repeated rows are kept and share a component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import bounded_side, fresh, importable, store
from wagerlens.llm.components import components

SHINGLE, SEED, MAX_BITS = 4, 42, 4
BLOCKS = 6
BUCKET = 4096
MAX_BROADCAST_KEYS = 100_000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash over word shingles of the ASCII-lower-cased text."""
    from xxhash import xxh64_intdigest as digest

    # bytes.lower() changes A-Z only; bytes.split() cuts at space and 0x09-0x0D only.
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = list(accumulate(words, lambda at, w: at + 1 + len(w), initial=-1))
        hashes = [
            digest(joined[a + 1 : b], seed) for a, b in zip(ends, ends[shingle:], strict=False)
        ]
    ones = _ones_per_bit(np.array(hashes, dtype="<u8"))
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _ones_per_bit(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, row: str | None = None
) -> DataFrame:
    """row (if named), doc_id and fp (the fingerprint as a signed long) of every document."""
    importable(docs.sparkSession)
    keep = ["doc_id"] if row is None else [row, "doc_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in texts], dtype=np.uint64)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns.append(pa.array(fps.view(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "fp"])

    picked = [F.col(k).cast("long").alias(k) for k in keep]
    ddl = ", ".join(f"`{k}` long" for k in [*keep, "fp"])
    return docs.select(*picked, F.col("text").cast("string").alias("text")).mapInArrow(digest, ddl)


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """A bit mask for each choice of blocks that a close pair can agree on."""
    if blocks <= max_bits:
        raise ValueError("more blocks than differing bits are needed")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_keys(fps: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    """mask (its number), key, fp: one row per fingerprint and choice of blocks."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in block_masks(blocks, max_bits)])
    return fps.select("fp", F.posexplode(masks).alias("mask", "bits")).select(
        "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"), "fp"
    )


def _into_cells(keys: DataFrame, bucket: int) -> DataFrame:
    """Adds lo, hi: the pair of slices a row is compared under; (0, 0) in most buckets."""
    # Keys of one bucket agree on the blocks of their mask, so they are counted by mask and key.
    crowded = store(
        keys.groupBy("mask", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > bucket)
        .select("mask", "key", F.ceil(F.col("n") / (bucket / 2)).cast("int").alias("slices")),
        "crowded",
    )
    many = crowded.count()
    if not many:
        return keys.withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    own = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    return (
        keys.join(bounded_side(crowded, many, MAX_BROADCAST_KEYS), ["mask", "key"], "left")
        .withColumn("slices", F.coalesce("slices", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", other)
        .select(
            "mask", "key", "fp",
            F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        )
    )


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect whatever the close pairs of one bucket connect."""
    links: list[tuple[int, int]] = []
    left = fps
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            node = reached.pop()
            near = np.bitwise_count(left ^ node) <= max_bits
            if near.any():
                found = left[near]
                links.extend((int(node), int(f)) for f in found)
                reached.extend(found)
                left = left[~near]
    return links


SHORT_RUN = 24


def _links_of(runs: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Links within runs of equal number; both arrays are in run order."""
    starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
    sizes = np.diff(np.r_[starts, len(runs)])
    found = []
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    longest = int(sizes[sizes <= SHORT_RUN].max(initial=1))
    for d in range(1, longest):
        close = (
            short[d:]
            & (runs[d:] == runs[:-d])
            & (np.bitwise_count(fps[d:] ^ fps[:-d]) <= max_bits)
        )
        at = np.flatnonzero(close)
        found.append(np.stack([fps[at], fps[at + d]], axis=1))
    for s, n in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN], strict=True):
        links = spanning_links(fps[s : s + n], max_bits)
        found.append(np.array(links, dtype=np.uint64).reshape(-1, 2))
    return np.concatenate(found) if found else np.empty((0, 2), dtype=np.uint64)


def close_links(
    fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, bucket: int = BUCKET
) -> DataFrame:
    """a, b: links between distinct fingerprints that connect all within `max_bits` bits."""
    importable(fps.sparkSession)
    cells = _into_cells(block_keys(fps, blocks, max_bits), bucket)
    where = ["mask", "key", "lo", "hi"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, dtype=np.int64) for _ in range(5)]
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            held = [np.concatenate((h, n.astype(np.int64))) for h, n in zip(held, new, strict=True)]
            # The last bucket may go on in the next batch; slicing bounds its size.
            last = np.ones(len(held[0]), dtype=bool)
            for c in held[:4]:
                last &= c == c[-1]
            keep = int(np.argmax(last)) if len(last) else 0
            yield _link_batch([c[:keep] for c in held], max_bits)
            held = [c[keep:] for c in held]
        yield _link_batch(held, max_bits)

    return (
        cells.select(*where, "fp")
        .repartition(*where)
        .sortWithinPartitions(*where, "fp")
        .mapInArrow(compare, "a long, b long")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )


def _link_batch(columns: list[np.ndarray], max_bits: int) -> pa.RecordBatch:
    links = np.empty((0, 2), dtype=np.uint64)
    if len(columns[0]):
        change = np.zeros(len(columns[0]), dtype=bool)
        for c in columns[:4]:
            change[1:] |= c[1:] != c[:-1]
        links = _links_of(np.cumsum(change), columns[4].view(np.uint64), max_bits)
    arrays = [pa.array(np.ascontiguousarray(links[:, i]).view(np.int64)) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    seed: int = SEED,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
    bucket: int = BUCKET,
    row: str | None = None,
) -> DataFrame:
    """doc_id, fingerprint, component_id of every document, and `row` if one is named.

    component_fingerprint tells components apart even where doc_ids are null or repeat.
    """
    found = store(fingerprints(docs, shingle, seed, row), "fingerprints")
    distinct = store(found.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fps")
    linked = components(close_links(distinct.select("fp"), max_bits, blocks, bucket))
    members = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "least_id"
    )
    names = members.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = members.join(names, "component").select("fp", "component", "component_id")
    extra = [] if row is None else [row]
    return found.join(named, "fp").select(
        *extra,
        "doc_id",
        hex_digits(F.col("fp")).alias("fingerprint"),
        "component_id",
        hex_digits(F.col("component")).alias("component_fingerprint"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents whose component starts with them: one row of each group stays.

    The row with the smallest doc_id stays (of several with that id, or without any id, the first
    as stored). Columns and their order are those of the input.
    """
    row, least = fresh(docs.columns, "row", "least")
    kept = store(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(kept, row=row, **options)
    first = found.groupBy("component_fingerprint").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias(least)
    )
    chosen = first.select(F.col(f"{least}.{row}").alias(row))
    return kept.join(chosen, row, "left_semi").select(*docs.columns)
