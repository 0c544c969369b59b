"""What the operators of this folder share: stored intermediates and column handling."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.sources.scratch import scratch_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver found it.

    A cluster whose machines don't share that path gets the package with --py-files.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join(p for p in [ROOT, *paths] if p)


def store(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """The frame written once as Parquet in the shared folder, read back.

    This cuts the lineage: tasks that are lost later read the files and compute nothing again.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(names: Sequence[str], *wanted: str) -> list[str]:
    """Working column names that clash with none of the given ones."""
    taken = {n.lower() for n in names}
    found = []
    for w in wanted:
        while w.lower() in taken:
            w = f"_{w}"
        taken.add(w.lower())
        found.append(w)
    return found


def bounded_side(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Broadcast a stored frame whose counted rows are within the bound, else shuffle it."""
    return F.broadcast(df) if rows <= max_rows else df.hint("merge")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def key_runs(batches, keys: int):
    """Rows of equal leading `keys` columns, as one table each; the input is sorted by them.

    Null keys are not expected. Only the rows of one run are held beyond the batch at hand.
    """
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        change = np.zeros(rows.num_rows, dtype=bool)
        for i in range(keys):
            k = rows.column(i).to_numpy()
            change[1:] |= k[1:] != k[:-1]
        cuts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield rows.slice(a, b - a)
        held = rows.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held
