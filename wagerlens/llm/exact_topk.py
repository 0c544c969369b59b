"""Exact top-k by inner product of whole-numbered sparse rows, one term at a time.

Components are turned into floor(scale * x). Candidates are dealt into blocks; a task turns its
block into one posting list per term (the rows with a weight other than zero, and the weights),
and every query row of the stream that follows scatters its weighted postings into a dense array
of scores. The k best of a block are found by partition selection, and blocks are merged by a
window per query. Every query meets every candidate; a task holds one block and a few queries.
Queries are copied once per block, so a block is as large as `block_bytes` allow, but for small
tables there are as many as the cluster has cores.

Scores are exact. Where the weights of a block and of a query could add up to more than 64 bits,
their products are summed as integers of any size. A component that doesn't fit a long after
scaling, and a score among the best that doesn't, end the run with an error.
Nulls: vectors that are null or hold null or non-finite components, and rows without a vec_id,
take no part; missing components count as zero, and a zero vector has score zero with all. Ties
go to the smaller vec_id. Repeated rows are candidates of their own; a query leaves out its own row
only. With fewer candidates than k all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import importable, key_runs, store
from wagerlens.llm.vectors import finite, matrix

SCALE = 256
BLOCK_BYTES = 96 << 20
LEAST_BLOCK = 4096
QUERY_BLOCK = 64
SAFE = 1 << 62


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of every component; an error if one doesn't fit a long."""

    def one(c: Column) -> Column:
        scaled = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(scaled) < F.lit(float(SAFE)), F.floor(scaled)).otherwise(
            F.raise_error(F.lit("a component is too large for a long"))
        )

    return F.transform(vector, one)


def _largest(weights: np.ndarray) -> int:
    return int(np.abs(weights).max(initial=0))


class Postings:
    """A block of candidates as one list of rows and weights per term."""

    def __init__(self, names: np.ndarray, rows: np.ndarray, weights: np.ndarray):
        self.names, self.rows = names, rows  # vec_ids, row numbers
        self.largest = _largest(weights)
        self.lists = []
        for term in range(weights.shape[1]):
            at = np.flatnonzero(weights[:, term])
            self.lists.append((at, np.ascontiguousarray(weights[at, term])))

    def scores(self, queries: np.ndarray) -> np.ndarray:
        """One row per candidate, one column per query."""
        wide = self.largest * _largest(queries) * max(1, len(self.lists)) >= SAFE
        kind = object if wide else np.int64
        dense = np.zeros((len(self.names), len(queries)), dtype=kind)
        queries = queries.astype(kind)
        for term, (at, weights) in enumerate(self.lists):
            weights = weights.astype(kind, copy=False)
            asked = np.flatnonzero(queries[:, term])
            if not len(at) or not len(asked):
                continue
            if len(asked) == len(queries):
                dense[at] += weights[:, None] * queries[None, :, term]
            else:
                dense[np.ix_(at, asked)] += weights[:, None] * queries[None, asked, term]
        return dense

    def best(self, scores: np.ndarray, own: int, k: int) -> np.ndarray:
        """Places of the k best of one column, without row `own`; ties by vec_id and row."""
        places = np.flatnonzero(self.rows != own)
        scores = scores[places]
        if scores.dtype == object:
            order = sorted(range(len(places)), key=lambda i: (-scores[i], self.names[places[i]], self.rows[places[i]]))
            return places[order[:k]]
        if len(places) > k:
            least = np.partition(scores, len(places) - k)[len(places) - k]
            some = scores >= least
            places, scores = places[some], scores[some]
        order = np.lexsort((self.rows[places], self.names[places], -scores))
        return places[order[:k]]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = SCALE,
    block: int | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row that `is_query` picks.

    Queries are repeated once per block of candidates, candidates are shuffled once. `block` sets the
    candidates of a block where they should not be worked out.
    """
    importable(vectors.sparkSession)
    rows = store(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .filter(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
        .withColumns({"x": whole_numbers(F.col("embedding"), scale), "row": F.monotonically_increasing_id()})
        .drop("embedding"),
        "whole-numbers",
    )
    count, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    # A candidate takes a vector, postings of it and the scores of a query block.
    most = max(1, block_bytes // (8 * (3 * dims + QUERY_BLOCK)))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-count // most), min(cores, -(-count // LEAST_BLOCK)), 1)
    if block is not None:
        blocks = max(1, -(-count // block))
    candidates = rows.select(
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
        F.lit(0).alias("asks"), "row", "vec_id", "x",
    )
    queries = rows.filter(is_query).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(1).alias("asks"), "row", "vec_id", "x",
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, at, held = None, None, []
        for part in _pieces(batches):
            number = part.column(0)[0].as_py()
            names, numbers = part.column(3).to_numpy(), part.column(2).to_numpy()
            if part.column(1)[0].as_py() == 0:
                held = held if number == at else []
                held.append((names, numbers, matrix(part.column(4), dims, np.int64)))
                current, at = None, number
                continue
            if number != at:
                continue  # a block without candidates
            if current is None:
                current = Postings(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held = []
            asked = matrix(part.column(4), dims, np.int64)
            for first in range(0, len(names), QUERY_BLOCK):
                some = slice(first, first + QUERY_BLOCK)
                yield _answers(current, names[some], numbers[some], asked[some], k)

    found = (
        candidates.unionByName(queries)
        .repartition("block")
        .sortWithinPartitions("block", "asks", "row")
        .mapInArrow(search, "query_row long, query_id long, vec_id long, row long, score long")
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Parts of batches with one block and one kind of row; queries are never gathered."""
    for batch in batches:
        yield from key_runs([batch], 2)


def _answers(
    block: Postings, names: np.ndarray, rows: np.ndarray, asked: np.ndarray, k: int
) -> pa.RecordBatch:
    dense = block.scores(asked)
    picked = [block.best(dense[:, i], rows[i], k) for i in range(len(names))]
    sizes = [len(p) for p in picked]
    where = np.concatenate(picked) if picked else np.empty(0, dtype=np.int64)
    columns = np.repeat(np.arange(len(names)), sizes)
    best = dense[where, columns]
    if best.dtype == object and any(abs(v) >= 1 << 63 for v in best):
        raise OverflowError("a score is too large for a long")
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(rows, sizes)),
            pa.array(np.repeat(names, sizes)),
            pa.array(block.names[where]),
            pa.array(block.rows[where]),
            pa.array(best.astype(np.int64)),
        ],
        names=["query_row", "query_id", "vec_id", "row", "score"],
    )


def check_sql(step: int = 50, k: int = 5, scale: int = SCALE) -> str:
    return f"""
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)) AS x FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {step} = 0
    ), r AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
      FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}
    """
