"""The hourly loads as a stream over a folder of delivered files.

Each run takes the files that arrived since the last one, some at a time, and stops, so it can be
started by any scheduler. The checkpoint remembers which files were taken. A batch that is run again
after a failure inserts nothing twice: the loads skip keys they hold already. Only players are
appended again; silver keeps one row of each.

A backlog is cut into batches of `max_files`, in the order in which files came. What is late is told
by the newest event time before the run, which is kept beside the checkpoint until the whole backlog is
loaded: else a row of a later file could be older than the mark an earlier batch has set, and be
dropped. So cutting, and a run that takes over from one that failed, load the rows of a single batch.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wagerlens.plans.silver import SILVER, refresh
from wagerlens.schemas import FILE_SCHEMAS, SILVER_SOURCE
from wagerlens.sources.bronze import EVENT, FIRST_MARK, LOADS, loaded_mark
from wagerlens.sources.files import FORMATS
from wagerlens.sources.tables import children, delete

MAX_FILES = 1000


def file_stream(
    spark: SparkSession, dataset: str, folder: str, max_files: int | None = None
) -> DataFrame:
    """Rows of the files in a folder. Deliveries are JSON Lines, or CSV with a header in the
    order of the schema."""
    reader = spark.readStream.schema(FILE_SCHEMAS[dataset])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if FORMATS[dataset] == "json":
        return reader.json(folder)
    # A header in another order fails the batch instead of shifting columns.
    return reader.option("header", True).option("enforceSchema", False).csv(folder)


def _frozen_mark(
    spark: SparkSession, dataset: str, bronze_root: str, folder: str, first_mark: datetime
) -> datetime:
    """The mark of the backlog at hand: the one a run that did not end has left, or that of now."""
    if "_SUCCESS" not in children(spark, folder):
        mark = loaded_mark(spark, bronze_root, dataset, first_mark)
        row = spark.createDataFrame([(mark,)], "mark timestamp")
        row.coalesce(1).write.mode("overwrite").parquet(folder)
    return spark.read.schema("mark timestamp").parquet(folder).first()["mark"]


def ingest_available(
    spark: SparkSession,
    dataset: str,
    folder: str,
    bronze_root: str,
    checkpoint: str,
    now: Callable[[], datetime],
    silver_root: str | None = None,
    max_files: int = MAX_FILES,
    first_mark: datetime = FIRST_MARK,
) -> StreamingQuery:
    """Load all files not loaded yet into bronze, and refresh silver if its folder is given.

    Returns the running query. Its batches are written to a folder beside the checkpoint first, as a
    load reads its batch several times; they and the mark go when the query has ended well.
    """
    tables = [n for n in SILVER if SILVER_SOURCE[n] == dataset]
    beside = f"{checkpoint.rstrip('/')}-run"
    options = {}
    if dataset in EVENT:
        options["mark"] = _frozen_mark(spark, dataset, bronze_root, f"{beside}/mark", first_mark)

    def load(batch: DataFrame, batch_id: int) -> None:
        session, as_of = batch.sparkSession, now()
        parsed = f"{beside}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(parsed)
        rows = session.read.schema(batch.schema).parquet(parsed)
        LOADS[dataset](session, bronze_root, rows, as_of, **options)
        if silver_root is not None:
            for name in tables:
                refresh(session, name, bronze_root, silver_root, as_of)
        delete(session, parsed)

    running = (
        file_stream(spark, dataset, folder, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return _Backlog(running, lambda: delete(spark, beside))


class _Backlog:
    """A streaming query that cleans up once, after it has ended without an error."""

    def __init__(self, query: StreamingQuery, clean_up: Callable[[], None]):
        self._query, self._clean_up, self._lock = query, clean_up, threading.Lock()

    def __getattr__(self, name: str):
        return getattr(self._query, name)

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        ended = self._query.awaitTermination(timeout)
        with self._lock:
            if self._clean_up and not self._query.isActive:
                self._clean_up()
                self._clean_up = None
        return ended
