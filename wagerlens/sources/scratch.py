"""Where intermediate tables are written."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared checkpoint folder the session names.

    Every executor must see it, so a local temporary folder is used only by a local session that
    names none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="wagerlens-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


class WorkTables:
    """Intermediate results that several queries of one run read.

    Each is written once under `root`, which a later run may write over. Readers then scan only
    the columns they need instead of computing the result again, and a lost executor costs no
    more than its own tasks.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root
        self._kept: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """The stored frame; written by the first caller, while others that ask for it wait.

        Frames are told apart by name and plan, so another input under the same name is stored anew.
        """
        key = f"{name}-{df.semanticHash() & 0xFFFFFFFF:08x}"
        with self._locks.setdefault(key, threading.Lock()):
            if key not in self._kept:
                path = f"{self._root}/{key}"
                df.write.mode("overwrite").option("compression", "zstd").parquet(path)
                self._kept[key] = self._spark.read.schema(df.schema).parquet(path)
            return self._kept[key]


def kept(work: WorkTables | None, name: str, df: DataFrame) -> DataFrame:
    """The frame stored as a work table, or left lazy if there is no place for one."""
    return df if work is None else work.keep(name, df)
