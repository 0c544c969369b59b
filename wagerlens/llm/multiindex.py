"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into halves; a codebook for each half, learned apart, makes a grid of cells.
A vector lies in the cell of its two nearest codes and visits the cells nearest to it in the order
of the summed distances of its halves (multi-sequence traversal). The members of a visited cell are
verified by cosine in double precision. How many cells to visit is measured: sampled points are
compared with all points, and the count is the least that reaches `recall` of the linked pairs of one
half of them, plus a quarter, if it also reaches `recall` on the other half. Each pair weighs one,
whatever its copies, and the mean recall of the linked points must reach `recall` as well, so that
one dense group doesn't decide alone. `queries` points a half are asked first, more until each half
has LEAST_PAIRS pairs of LEAST_LINKED points or 32 * `queries` points (or all) are asked. Where that
doesn't settle the count (links too rare to count), it is a bound that ends the traversal instead of a
number: every code has the distance of its farthest half, so a cell whose least possible distance from
the vector, over both halves, is more than the cosine allows can hold no link and is not visited. All
others that hold a vector are, nearest first, and no link is lost. The traversal, cells and checks are
the same either way; the count only saves visits. How much the bound saves depends on the data: little
where all vectors are about as far from each other.
Bounded are the sample for the codebooks, the codebooks, their distances and one bit per cell (at most
MOST_CODES ** 2), and the measured queries, all broadcast; every vector is indexed and visits.

Equal vectors are one point with a count. A crowded cell is cut into slices by a hash, and each
slice of visitors meets each slice of members in a task of its own. A meeting gives the number of
links per visitor and links that connect what it connects, never all pairs. A link counts for both
its ends: where the member's own cells leave out the visitor's, the meeting counts for the member too.

Nulls: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
missing trailing components count as zero. Repeated rows link with each other. A row without vec_id
can't name its component. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from wagerlens.llm.common import bounded_side, importable, key_runs, store
from wagerlens.llm.components import components
from wagerlens.llm.vectors import finite, matrix, nonzero, unit

COSINE = 0.9
RECALL = 0.999
SAMPLE = 16_384
QUERIES = 512
MOST_CODES = 1024
POINTS_PER_CELL = 8
LEAST_VISITS = 8
LEAST_PAIRS = 1000
LEAST_LINKED = 32
SLICE = 512
MAX_BROADCAST_CELLS = 100_000


def learn_codes(rows: np.ndarray, codes: int, rounds: int = 10, seed: int = 11) -> np.ndarray:
    """k-means codebook; codes that lose all rows move to the rows farthest from theirs."""
    rng = np.random.RandomState(seed)
    book = rows[rng.permutation(len(rows))[:codes]].copy()
    for _ in range(rounds):
        gap = distances(rows, book)
        own = gap.argmin(axis=1)
        size = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, rows)
        book = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], book)
        empty = np.flatnonzero(size == 0)
        far = np.argsort(-gap[np.arange(len(rows)), own], kind="stable")[: len(empty)]
        book[empty[: len(far)]] = rows[far]
    return book


def distances(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(axis=1)[:, None] + (book * book).sum(axis=1)[None]
    return np.maximum(square - 2 * rows @ book.T, 0)


def multi_sequence(one: np.ndarray, two: np.ndarray, count: int) -> list[tuple[int, int]]:
    """The `count` cells (i, j) of least one[i] + two[j], nearest first."""
    a, b = one.argsort(kind="stable"), two.argsort(kind="stable")
    heap = [(float(one[a[0]] + two[b[0]]), 0, 0)]
    seen = {(0, 0)}
    cells = []
    while heap and len(cells) < count:
        _, x, y = heapq.heappop(heap)
        cells.append((int(a[x]), int(b[y])))
        for nx, ny in ((x + 1, y), (x, y + 1)):
            if nx < len(a) and ny < len(b) and (nx, ny) not in seen:
                seen.add((nx, ny))
                heapq.heappush(heap, (float(one[a[nx]] + two[b[ny]]), nx, ny))
    return cells


@dataclass
class Grid:
    """Two codebooks over the halves of vectors of `dims` components."""

    dims: int
    first: np.ndarray
    second: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]

    @classmethod
    def learn(cls, rows: np.ndarray, codes: int) -> Grid:
        dims = rows.shape[1]
        half = max(1, dims // 2)
        codes = max(1, min(codes, len(rows)))
        rest = rows[:, half:] if dims > half else np.zeros((len(rows), 1))
        return cls(dims, learn_codes(rows[:, :half], codes), learn_codes(rest, codes))

    def gaps(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = rows[:, self.half :] if self.dims > self.half else np.zeros((len(rows), 1))
        return distances(rows[:, : self.half], self.first), distances(rest, self.second)

    def number(self, i, j):
        return i * len(self.second) + j


def points_of(vectors: DataFrame) -> DataFrame:
    """point, embedding, least_id, copies: comparable vectors, equal ones once; stored."""
    good = vectors.filter(finite(F.col("embedding")) & nonzero(F.col("embedding")))
    alike = good.groupBy("embedding").agg(
        F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    return store(alike.withColumn("point", F.monotonically_increasing_id()), "points")


def learn_grid(points: DataFrame, count: int, dims: int, sample: int = SAMPLE) -> Grid:
    """Codebooks from at most `sample` points."""
    share = min(1.0, 1.2 * sample / max(1, count))
    picked = points.filter(
        F.pmod(F.xxhash64("point", F.lit(3)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    )
    rows = picked.select("point", "embedding").limit(sample).toArrow()
    x = unit(matrix(rows.column("embedding"), dims, np.float64))
    x = x[np.argsort(rows.column("point").to_numpy())]
    codes = int(max(1, min(MOST_CODES, round((count / POINTS_PER_CELL) ** 0.5))))
    return Grid.learn(x, codes)


def visits_needed(
    points: DataFrame, grid: Grid, count: int, queries: int, cosine: float, recall: float
) -> int | None:
    """Cells to visit for the wanted recall; None where the sampled points can't tell.

    Each round asks points that were not asked before. Those of one half choose the count, those of
    the other check it; when all points are asked, all choose.
    """
    asked, size, rounds = 0, 2 * queries, []
    while asked < min(count, 32 * queries):
        rounds.append(linked_ranks(points, grid, count, asked, asked + size, cosine))
        asked += size
        size = asked
        ranks = np.concatenate(rounds)
        if asked >= count:
            return cells_for(ranks, recall)
        one, two = (ranks[ranks["half"] == half] for half in (0, 1))
        if min(one["pairs"].sum(), two["pairs"].sum()) < LEAST_PAIRS or min(
            one["linked"].sum(), two["linked"].sum()
        ) < LEAST_LINKED:
            continue
        visits = cells_for(one, recall)
        near = two[two["rank"] < visits]
        if all(near[w].sum() >= (recall - 1e-9) * two[w].sum() for w in ("pairs", "linked")):
            return visits
    return None


def cells_for(ranks: np.ndarray, recall: float) -> int:
    """Cells that hold `recall` of the pairs and of the points' mean shares, and a quarter more."""
    ranks = np.sort(ranks, order="rank")
    least = 0
    for weight in ("pairs", "linked"):
        sums = np.cumsum(ranks[weight])
        if len(sums):
            at = np.searchsorted(sums, recall * sums[-1] - 1e-9 * sums[-1])
            least = max(least, int(ranks["rank"][at]))
    return max(LEAST_VISITS, (least + 1) * 5 // 4 + 1)


def linked_ranks(
    points: DataFrame, grid: Grid, count: int, start: int, end: int, cosine: float
) -> np.ndarray:
    """half, rank, pairs, linked: linked pairs of the sampled points by the rank of the cell.

    Of about `count` points in the order of a hash those from `start` to `end` are asked, each
    compared with every point. The rank of a linked point's cell is the number of cells nearer to
    the asked point, `linked` the sum of the shares of each asked point's pairs.
    """
    spark = points.sparkSession
    top = 1 << 40
    first, last = (min(top, int(n / count * top)) for n in (start, end))
    at = F.pmod(F.xxhash64("point", F.lit(5)), F.lit(top))
    asked = points.filter((at >= first) & (at < last)).select("point", "embedding").toArrow()
    names = asked.column("point").to_numpy()
    order = np.argsort(names)
    raw = matrix(asked.column("embedding"), grid.dims, float)[order]
    shared = spark.sparkContext.broadcast((grid, names[order], raw))

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, names, raw = shared.value
        q = unit(raw) if len(raw) else raw
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = unit(matrix(part.column(1), grid.dims, np.float64))
                a, b = grid.gaps(x)
                own = np.stack((a.argmin(axis=1), b.argmin(axis=1)), axis=1)
                others = part.column(0).to_numpy()
                found = []
                for low in range(0, len(q), 2048):
                    close = q[low : low + 2048] @ x.T >= cosine
                    close &= names[low : low + 2048, None] != others[None]
                    some = np.flatnonzero(close.any(axis=1))
                    if not len(some):
                        continue
                    one, two = grid.gaps(q[low + some])
                    two_sorted = np.sort(two, axis=1)
                    for r, k in enumerate(some.tolist()):
                        cells, n = np.unique(own[close[k]], axis=0, return_counts=True)
                        for (i, j), pairs in zip(cells.tolist(), n.tolist(), strict=True):
                            gap = one[r, i] + two[r, j]
                            rank = int(np.searchsorted(two_sorted[r], gap - one[r]).sum())
                            found.append((low + k, rank, pairs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
                    names=["asked", "rank", "n"],
                )

    per_point = (
        points.select("point", "embedding")
        .mapInArrow(ranks, "asked long, rank long, n long")
        .groupBy("asked", "rank")
        .agg(F.sum("n").alias("n"))
    )
    share = F.col("n") / F.sum("n").over(Window.partitionBy("asked"))
    seen = (
        per_point.withColumn("share", share)
        .groupBy((F.col("asked") % 2).alias("half"), "rank")
        .agg(F.sum("n").alias("pairs"), F.sum("share").alias("linked"))
        .collect()  # ranks lie below the number of cells
    )
    kind = [("half", "i8"), ("rank", "i8"), ("pairs", "i8"), ("linked", "f8")]
    return np.array([tuple(r) for r in seen], dtype=kind)


@dataclass
class Reach:
    """What lies in the cells of a grid: the distance of each code to the farthest half next to it (-1
    for none), and which cells hold a point."""

    first: np.ndarray
    second: np.ndarray
    held: np.ndarray

    def ways(self, one: np.ndarray, two: np.ndarray, apart: float) -> np.ndarray:
        """Cells that may hold a point within `apart` of a vector with these squared distances to the
        codes, nearest first."""
        near_one = np.maximum(np.sqrt(one) - self.first, 0) ** 2
        near_two = np.maximum(np.sqrt(two) - self.second, 0) ** 2
        i = np.flatnonzero((self.first >= 0) & (near_one <= apart))
        j = np.flatnonzero((self.second >= 0) & (near_two <= apart))
        may = (near_one[i][:, None] + near_two[j][None] <= apart) & self.held[np.ix_(i, j)]
        x, y = np.nonzero(may)
        x, y = i[x], j[y]
        order = np.argsort(one[x] + two[y], kind="stable")
        return (x * len(self.second) + y)[order]


def reach_of(points: DataFrame, grid: Grid) -> Reach:
    """Measured over all points; at most MOST_CODES ** 2 cells and codes come to the driver."""
    shared = points.sparkSession.sparkContext.broadcast(grid)

    def farthest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value
        most = [np.full(len(book), -1.0) for book in (grid.first, grid.second)]
        held = np.zeros(len(grid.first) * len(grid.second), dtype=bool)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                gaps = grid.gaps(unit(matrix(part.column(0), grid.dims, np.float64)))
                homes = []
                for k, gap in enumerate(gaps):
                    # All codes that tie but for rounding, as either may be found the nearest later.
                    near = gap <= gap.min(axis=1)[:, None] + 1e-9
                    most[k] = np.maximum(most[k], np.where(near, np.sqrt(gap), -1).max(axis=0))
                    homes.append(near)
                for a, b in zip(*homes, strict=True):
                    i, j = np.flatnonzero(a), np.flatnonzero(b)
                    held[(i[:, None] * len(grid.second) + j[None]).reshape(-1)] = True
        kinds, codes, far = [], [], []
        for k, values in enumerate(most):
            some = np.flatnonzero(values >= 0)
            kinds += [k] * len(some)
            codes += some.tolist()
            far += values[some].tolist()
        cells = np.flatnonzero(held).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kinds + [2] * len(cells), pa.int32()),
                pa.array(codes + cells, pa.int64()),
                pa.array(far + [0.0] * len(cells), pa.float64()),
            ],
            names=["kind", "code", "radius"],
        )

    found = points.select("embedding").mapInArrow(farthest, "kind int, code long, radius double")
    out = Reach(
        np.full(len(grid.first), -1.0), np.full(len(grid.second), -1.0),
        np.zeros(len(grid.first) * len(grid.second), dtype=bool),
    )
    for r in found.groupBy("kind", "code").agg(F.max("radius").alias("radius")).collect():
        if r["kind"] == 2:
            out.held[r["code"]] = True
        else:
            (out.first, out.second)[r["kind"]][r["code"]] = r["radius"]
    out.held = out.held.reshape(len(grid.first), len(grid.second))
    return out


def place(
    points: DataFrame, grid: Grid, visits: int | None, cosine: float
) -> tuple[DataFrame, DataFrame]:
    """Members and visitors: cell, point, embedding, copies, home, ways.

    `home` is the cell of a visitor, `ways` are the cells a member visits; empty where every link is
    found from both its ends. Without `visits` all cells that can hold a link are visited.
    """
    reach = reach_of(points, grid) if visits is None else None
    # The squared distance of linked unit vectors is at most this; a little for rounding.
    apart = max(0.0, 2 - 2 * cosine) + 1e-6
    shared = points.sparkSession.sparkContext.broadcast((grid, reach))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, reach = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                one, two = grid.gaps(unit(matrix(part.column(1), grid.dims, np.float64)))
                home = grid.number(one.argmin(axis=1), two.argmin(axis=1))
                if reach is None:
                    ways = [
                        [grid.number(i, j) for i, j in multi_sequence(one[k], two[k], visits)]
                        for k in range(part.num_rows)
                    ]
                else:
                    ways = [reach.ways(one[k], two[k], apart) for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(home, pa.int64()), pa.array(ways, pa.list_(pa.int64()))],
                    names=[*part.schema.names, "cell", "ways"],
                )

    located = store(
        points.select("point", "embedding", "copies").mapInArrow(
            locate,
            points.select("point", "embedding", "copies")
            .schema.add("cell", "long")
            .add("ways", ArrayType(LongType())),
        ),
        "located",
    )
    none = F.array().cast(ArrayType(LongType()))
    columns = ["point", "embedding", "copies", F.col("cell").alias("home")]
    ways = none if visits is None else F.col("ways")
    members = located.select("cell", *columns, ways.alias("ways"))
    visitors = located.select(F.explode("ways").alias("way"), *columns)
    return members, visitors.withColumnRenamed("way", "cell").withColumn("ways", none)


def meet(members: DataFrame, visitors: DataFrame, dims: int, cosine: float) -> DataFrame:
    """point, links, other: link counts (other null), and links that connect (links zero)."""
    spark = members.sparkSession
    sizes = store(
        members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        .join(visitors.groupBy("cell").agg(F.count(F.lit(1)).alias("v")), "cell")
        .select(
            "cell",
            F.ceil(F.col("n") / SLICE).cast("int").alias("member_slices"),
            F.ceil(F.col("v") / SLICE).cast("int").alias("visitor_slices"),
        ),
        "cells",
    )
    side = bounded_side(sizes, sizes.count(), MAX_BROADCAST_CELLS)
    own = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    m = members.join(side, "cell").withColumns(
        {"m": own("member_slices"), "v": others("visitor_slices")}
    )
    v = visitors.join(side, "cell").withColumns(
        {"v": own("visitor_slices"), "m": others("member_slices")}
    )
    columns = ["cell", "m", "v", "visits", "point", "embedding", "copies", "home", "ways"]
    both = m.withColumn("visits", F.lit(0)).select(columns).unionByName(
        v.withColumn("visits", F.lit(1)).select(columns)
    )
    importable(spark)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in key_runs(batches, 3):
            visits = run.column(3).to_numpy() > 0
            if visits.all() or not visits.any():
                continue
            names = run.column(4).to_numpy()
            x = unit(matrix(run.column(5), dims, np.float64))
            copies = run.column(6).to_numpy()
            a, b = names[visits], names[~visits]
            close = (x[visits] @ x[~visits].T >= cosine) & (a[:, None] != b[None])
            counts = close @ copies[~visits]
            some = np.flatnonzero(counts)
            if not len(some):
                continue
            ways = run.column(8).filter(pa.array(~visits))
            met = _visited(run.column(7).to_numpy()[visits], ways)
            back = copies[visits] @ (close & ~met) if met is not None else np.zeros(len(b))
            other_some = np.flatnonzero(back)
            links = _connecting(close, a, b)
            points = np.r_[a[some], b[other_some], [p for p, _ in links]].astype(np.int64)
            number = np.r_[counts[some], back[other_some], np.zeros(len(links))].astype(np.int64)
            other = [None] * (len(some) + len(other_some)) + [int(q) for _, q in links]
            yield pa.RecordBatch.from_arrays(
                [pa.array(points), pa.array(number), pa.array(other, pa.int64())],
                names=["point", "links", "other"],
            )

    return (
        both.repartition("cell", "m", "v")
        .sortWithinPartitions("cell", "m", "v", "visits", "point")
        .mapInArrow(compare, "point long, links long, other long")
    )


def _visited(homes: np.ndarray, ways: pa.ChunkedArray) -> np.ndarray | None:
    """Whether the cells in each of `ways` (columns) hold each home (rows); None without ways."""
    rows = ways.combine_chunks()
    cells = rows.flatten().to_numpy()
    if not len(cells):
        return None
    column = np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy())
    distinct, at = np.unique(homes, return_inverse=True)
    place = np.minimum(np.searchsorted(distinct, cells), len(distinct) - 1)
    some = distinct[place] == cells
    found = np.zeros((len(distinct), len(rows)), dtype=bool)
    found[place[some], column[some]] = True
    return found[at]


def _connecting(close: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links (row name, column name) that connect whatever the true entries connect."""
    links = []
    free = close.any(axis=0)
    todo = set(np.flatnonzero(close.any(axis=1)).tolist())
    while todo:
        rows = [todo.pop()]
        while rows:
            r = rows.pop()
            columns = np.flatnonzero(close[r] & free)
            free[columns] = False
            links.extend((a[r], b[c]) for c in columns.tolist())
            for c in columns.tolist():
                for k in np.flatnonzero(close[:, c]).tolist():
                    if k in todo:
                        todo.remove(k)
                        links.append((a[k], b[c]))
                        rows.append(k)
    return links


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    recall: float = RECALL,
    sample: int = SAMPLE,
    queries: int = QUERIES,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding)."""
    importable(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    points = points_of(rows)
    count, dims = points.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    alone = rows.filter(
        ~(finite(F.col("embedding")) & F.coalesce(nonzero(F.col("embedding")), F.lit(False)))
    ).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if count:
        grid = learn_grid(points, count, dims, sample)
        visits = visits_needed(points, grid, count, queries, cosine, recall)
        met = store(meet(*place(points, grid, visits, cosine), dims, cosine), "meetings")
        links = met.groupBy("point").agg(F.sum("links").alias("links"))
        joined = components(
            met.filter(F.col("other").isNotNull()).select(
                F.least("point", "other").alias("a"), F.greatest("point", "other").alias("b")
            )
        )
        known = (
            points.join(links, "point", "left")
            .join(joined, F.col("point") == F.col("node"), "left")
            .withColumn("component", F.coalesce("component", "point"))
        )
        names = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
        known = known.join(names, "component").select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "component_id",
        )
        linked = rows.filter(finite(F.col("embedding")) & nonzero(F.col("embedding"))).join(
            known, "embedding"
        )
        alone = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    same = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return alone.withColumn("kept", same)


def check_sql(cosine: float = COSINE) -> str:
    """The same rows from all pairs."""
    return f"""
    WITH RECURSIVE v AS (
      SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        AND len(list_filter(embedding, lambda c: c <> 0)) > 0
    ), pair AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.x, b.x) >= {cosine}
    ), reach AS (
      SELECT vec_id AS a, vec_id AS b FROM embeddings
      UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a
    ), least AS (
      SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
    ), n AS (
      SELECT a AS vec_id, count(*) AS n_links FROM pair GROUP BY a
    )
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM least LEFT JOIN n USING (vec_id)
    """
