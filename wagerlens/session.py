"""Session settings for tests and benchmarks; a cluster brings its own."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "wagerlens") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores if isinstance(cores, int) else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        # One machine only; a cluster names a folder that all of its machines see.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wagerlens-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside are deleted when its query ends.

    Else they stay until the driver collects its garbage, and a driver that only plans has little: a run of
    many steps then holds the shuffles of all of them on disk. A frame that is run twice is shuffled twice.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def prepare(spark: SparkSession) -> None:
    """Settings the results or their storage depend on.

    Dates and hours are taken in UTC. Timestamps are written in the parquet type that keeps
    minima and maxima, so that a filter on a time mark skips row groups.
    """
    for name, value in (
        ("spark.sql.session.timeZone", "UTC"),
        ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"),
    ):
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
