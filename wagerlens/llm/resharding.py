"""Resharding by minimum-cost flow: move the fewest bytes from old shards to new capacities.

The old layout is a Parquet folder cut by shard and block (a block is a hash slice of a shard).
From the bytes of the old shards and the capacities of the new ones a flow network gives how many
bytes go from each to each; a byte costs nothing where it stays and one where it moves. The flows
of an old shard are laid along its blocks: blocks that lie within one flow go whole, a block on a
border is cut between documents. The few documents on a border itself go, largest first, to the
shard that is smallest then, so sizes differ by one document at most.
Files of blocks that stay whole are read where they are; files of all other blocks are rewritten.

What reaches the driver: bytes per old shard, and the documents on borders (fewer than old plus
new shards). Blocks are numbered by sums per shard over the block list, never over rows of one key;
rows are only ordered within a block.

Nulls, empty texts: a null text has size 1 and the crc32 of nothing. Null doc_ids and repeated rows
are placed like others. Rows whose old shard is null or negative count as lying in shard 0. An empty
table gives an empty layout. Further columns are rewritten too; one that has the name of a column of
the layout is stored with `doc_` in front.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import bounded_side, fresh, store
from wagerlens.sources.scratch import scratch_dir

# A block has a 512th of all bytes, but no fewer and no more than this.
LEAST_BLOCK, MOST_BLOCK, SHARES = 1 << 20, 256 << 20, 512
MAX_BROADCAST_BLOCKS = 100_000
# Names of the layout's own columns.
LAYOUT = ["shard", "block", "size", "crc", "tie", "first", "new_shard", "old", "chosen"]


def flows(
    supply: list[int], capacity: list[int], price: list[list[int]] | None = None
) -> list[list[int]]:
    """Bytes from each old to each new shard at the least total price.

    Sends along the cheapest path that is left, found by relaxing all edges; a byte that stays in
    the shard of the same number costs 0, any other 1, unless `price` says otherwise.
    """
    if sum(capacity) < sum(supply):
        raise ValueError("new shards are too small")
    n, m = len(supply), len(capacity)
    price = price or [[int(i != j) for j in range(m)] for i in range(n)]
    sent = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        # Nodes: old shards 0..n-1, new shards n..n+m-1; edges back undo what was sent.
        cost = [0 if left[i] else None for i in range(n)] + [None] * m
        back: list[int | None] = [None] * (n + m)
        for _ in range(n + m):
            changed = False
            for i in range(n):
                for j in range(m):
                    if cost[i] is not None and (cost[n + j] is None or cost[i] + price[i][j] < cost[n + j]):
                        cost[n + j], back[n + j], changed = cost[i] + price[i][j], i, True
                    if sent[i][j] and cost[n + j] is not None and (
                        cost[i] is None or cost[n + j] - price[i][j] < cost[i]
                    ):
                        cost[i], back[i], changed = cost[n + j] - price[i][j], n + j, True
            if not changed:
                break
        end = min((j for j in range(m) if room[j] and cost[n + j] is not None), key=lambda j: cost[n + j])
        path, node = [n + end], n + end
        while back[node] is not None:
            node = back[node]
            path.append(node)
        path.reverse()
        steps = list(zip(path, path[1:], strict=False))
        amount = min([left[path[0]], room[end], *(sent[b][a - n] for a, b in steps if a >= n)])
        for a, b in steps:
            if a < n:
                sent[a][b - n] += amount
            else:
                sent[b][a - n] -= amount
        left[path[0]] -= amount
        room[end] -= amount
    return sent


def even(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def size_of(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + 1


def write_layout(
    docs: DataFrame,
    path: str,
    shard: Column,
    text: str = "text",
    least_block: int = LEAST_BLOCK,
    most_block: int = MOST_BLOCK,
) -> DataFrame:
    """Store `docs` by shard and block and open the result.

    Columns size, crc and tie (order within a block) are added. Columns of `docs` that carry one
    of the names of the layout are stored with `doc_` in front.
    """
    names: list[str] = []
    for c in docs.columns:
        name = f"doc_{c}" if c.lower() in LAYOUT else c
        others = [*LAYOUT, *names, *(o for o in docs.columns if o != c)]
        names += fresh(others, name) if name != c else [c]
    placed = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)],
        size_of(text).alias("size"),
        F.crc32(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")).alias("crc"),
        F.xxhash64("doc_id", F.col(text).cast("string")).alias("tie"),
        F.greatest(F.coalesce(shard.cast("int"), F.lit(0)), F.lit(0)).alias("shard"),
    )
    per_shard = placed.groupBy("shard").agg(F.sum("size").alias("bytes"))
    share = per_shard.agg(F.sum("bytes")).scalar() / SHARES
    block_bytes = F.greatest(F.lit(least_block), F.least(F.lit(most_block), share))
    blocks = per_shard.select(
        "shard", F.ceil(F.col("bytes") / block_bytes).cast("int").alias("blocks")
    )
    # One row per old shard; their number is a parameter of the layout.
    dealt = (
        placed.join(F.broadcast(blocks), "shard")
        # The reading task is in the hash: copies of one row would all meet in one block without it.
        .withColumn(
            "block",
            F.pmod(F.xxhash64("doc_id", "tie", F.spark_partition_id()), F.col("blocks")).cast("int"),
        )
        .select(*[F.col(f"`{n}`") for n in names], "size", "crc", "tie", "shard", "block")
    )
    (
        dealt.repartition("shard", "block")
        .write.partitionBy("shard", "block")
        .option("compression", "zstd")
        .parquet(path)
    )
    return docs.sparkSession.read.schema(dealt.schema).parquet(path)


@dataclass
class Resharding:
    """Where the blocks of a layout go; a null new_shard is a block cut between documents."""

    layout: DataFrame
    plan: DataFrame  # shard, block, first (byte of the block in its shard), bytes, new_shard
    blocks: int
    ranges: list[tuple[int, int, int, int]]  # old shard, new shard, first byte, end byte
    shards: int
    moved: int

    def joined(self, condition: Column) -> DataFrame:
        """Layout rows of the blocks that meet a condition, with first and new_shard."""
        some = self.plan.filter(condition).select("shard", "block", "first", "new_shard")
        return self.layout.join(
            bounded_side(some, self.blocks, MAX_BROADCAST_BLOCKS), ["shard", "block"]
        )


def _into(ranges: list[tuple], shard: Column, first: Column, end: Column) -> Column:
    """New shard of what lies within one range; null for what lies on a border."""
    found = F.lit(None).cast("int")
    for old, new, a, b in ranges:
        found = F.when((shard == old) & (first >= a) & (end <= b), F.lit(new)).otherwise(found)
    return found


def plan_moves(layout: DataFrame, shards: int) -> Resharding:
    """Solve the flows from the sizes of the stored layout."""
    before = (
        Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = layout.groupBy("shard", "block").agg(F.sum("size").alias("bytes"))
    blocks = store(
        sizes.withColumn("first", F.coalesce(F.sum("bytes").over(before), F.lit(0))), "blocks"
    )
    totals = blocks.groupBy("shard").agg(F.sum("bytes").alias("n"), F.count(F.lit(1)).alias("b"))
    per_shard = totals.collect()
    supply = {r["shard"]: r["n"] for r in per_shard}
    # Rows of the network are old shards 0..max, so that equal numbers meet.
    amounts = [supply.get(i, 0) for i in range(max(supply, default=-1) + 1)]
    sent = flows(amounts, even(sum(amounts), shards))
    ranges = []
    for i, row in enumerate(sent):
        at = 0
        for j in sorted(range(shards), key=lambda j: (j != i, j)):  # what stays comes first
            if row[j]:
                ranges.append((i, j, at, at + row[j]))
                at += row[j]
    moved = sum(n for i, row in enumerate(sent) for j, n in enumerate(row) if i != j)
    end = F.col("first") + F.col("bytes")
    plan = blocks.withColumn("new_shard", _into(ranges, F.col("shard"), F.col("first"), end))
    return Resharding(layout, plan, sum(r["b"] for r in per_shard), ranges, shards, moved)


def _cut(r: Resharding) -> DataFrame:
    """Rows of the blocks that are cut, each with its new shard."""
    spark = r.layout.sparkSession
    ordered = Window.partitionBy("shard", "block").orderBy("tie", "doc_id", "size", "crc")
    sums = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at, end, new = fresh([*r.layout.columns, "first", "new_shard", "chosen"], "at", "end", "new")

    def numbered(rows: DataFrame) -> DataFrame:
        last = F.col("first") + F.sum("size").over(sums)
        return rows.withColumns({at: F.row_number().over(ordered) - 1, end: last}).withColumn(
            new, _into(r.ranges, F.col("shard"), F.col(end) - F.col("size"), F.col(end))
        )

    rows = r.joined(F.col("new_shard").isNull())
    slim = numbered(rows.select("shard", "block", "first", "tie", "doc_id", "size", "crc"))
    filled = dict.fromkeys(range(r.shards), 0)
    settled = r.plan.select("new_shard", "bytes").unionByName(
        slim.select(F.col(new).alias("new_shard"), F.col("size").alias("bytes"))
    )
    for x in settled.dropna().groupBy("new_shard").agg(F.sum("bytes").alias("n")).collect():
        filled[x["new_shard"]] = x["n"]
    border = slim.filter(F.col(new).isNull()).select("shard", "block", at, "size")
    chosen = []
    for x in border.orderBy(F.desc("size"), "shard", "block", at).collect():
        least = min(filled, key=lambda j: (filled[j], j))
        filled[least] += x["size"]
        chosen.append((x["shard"], x["block"], x[at], least))
    few = spark.createDataFrame(chosen, f"shard int, block int, `{at}` int, chosen int")
    return (
        numbered(rows)
        .join(F.broadcast(few), ["shard", "block", at], "left")
        .withColumn("new_shard", F.coalesce(new, "chosen"))
    )


def rewrite(r: Resharding, path: str) -> DataFrame:
    """Rewrite the files of blocks that move or are cut; the whole new layout, old files included.

    Rows have the columns of the layout, `shard` being the new one, and `old`, the shard they were
    in. A block that stays whole is read from its old file.
    """
    spark = r.layout.sparkSession
    columns = [c for c in r.layout.columns if c not in {"shard", "block"}]
    out = [*columns, F.col("new_shard").alias("shard"), F.col("shard").alias("old"), "block"]
    whole = r.joined(F.col("new_shard") != F.col("shard")).select(*out)
    new = whole.unionByName(_cut(r).select(*out))
    new.write.partitionBy("shard", "old", "block").option("compression", "zstd").parquet(path)
    kept = r.joined(F.col("new_shard") == F.col("shard")).select(*out)
    return kept.unionByName(spark.read.schema(new.schema).parquet(path))


def with_slots(rows: DataFrame) -> DataFrame:
    """Adds slot: the gapless place of a row in its shard, by blocks first."""
    part = ["shard", "old", "block"]
    inside = Window.partitionBy(*part).orderBy("tie", "doc_id", "size", "crc")
    before = (
        Window.partitionBy("shard").orderBy("old", "block").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = (
        rows.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    return (
        rows.withColumn("place", F.row_number().over(inside) - 1)
        .join(bases, part)
        .withColumn("slot", F.col("base") + F.col("place"))
        .drop("base", "place")
    )


def reshard(
    docs: DataFrame, old_shard: Column, shards: int = 8, least_block: int = LEAST_BLOCK
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    `docs` is first stored in its old layout, by `old_shard`; then the files that the flows touch
    are rewritten, and the result is read from the files of the new layout.
    """
    spark = docs.sparkSession
    layout = write_layout(
        docs, scratch_dir(spark, "old-layout"), old_shard, least_block=least_block
    )
    new = rewrite(plan_moves(layout, shards), scratch_dir(spark, "new-layout"))
    slim = new.select("doc_id", "size", "crc", "tie", "shard", "old", "block")
    return with_slots(slim).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
