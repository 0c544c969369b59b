"""Stored tables: Parquet that Spark lays out, prunes and replaces by partition.

A table is either a log, which is added to, or keyed, which is merged into.

- A load of a log is a folder `_load=N` of its own, partitioned by the period of the ingest stamp and by
  a hash bucket of the key. Rows added since a load, of recent periods or of some buckets are found
  by partition.
- A keyed table is partitioned by hash bucket of the key. A merge reads the buckets that its keys fall
  into and writes them anew with dynamic partition overwrite; all others stay as they are.
- A full rebuild writes a new `_load=N` folder; readers turn to it when it is complete.

Each load ends by writing one row about the table (columns, layout, rows added, marks) to `_log`; the
newest complete one holds. A load that dies before that has no effect on what readers of a log's
marks or of a rebuilt table see, and it can be run again: loads skip keys that are stored, merges give
the same rows. Spark refuses a load whose folder exists. One run at a time writes to a table, as the
schedule asks for; two merges at once are not kept apart.

Period and buckets are fixed when a table is created. Choose them so that a bucket holds some
gigabytes: one for a small table, many for a large one.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAMP = "_ingested_at"
PERIOD = "month"
BUCKETS = 1
LOG = "_log"
RETIRED = "_retired"
# Name Spark gives to the folder of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
_STATE = (
    "load int, first int, keyed boolean, schema string, keys array<string>, period string,"
    " buckets int, added_rows long, newest timestamp, marks map<string, int>, high timestamp"
)


@dataclass(frozen=True)
class State:
    """What is known of a table after its load number `load`."""

    load: int
    first: int  # rows of earlier loads were replaced
    keyed: bool
    schema: T.StructType
    keys: list[str]
    period: str
    buckets: int
    added_rows: int = 0
    newest: datetime | None = None  # largest ingest stamp
    # Loads of other tables whose rows this one holds, by name.
    marks: dict[str, int] = field(default_factory=dict)
    high: datetime | None = None  # largest event time


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the `_load=N` folders in a folder, in order."""
    names = (n.removeprefix("_load=") for n in children(spark, path) if n.startswith("_load="))
    return sorted(int(n) for n in names if n.isdigit())


def _load_dir(path: str, load: int) -> str:
    return f"{path}/_load={load}"


def _complete(spark: SparkSession, folder: str) -> bool:
    fs, p = _fs(spark, f"{folder}/_SUCCESS")
    return fs.exists(p)


def state(spark: SparkSession, path: str) -> State | None:
    """What the newest complete load says; None if the table does not exist."""
    for n in reversed(_numbers(spark, f"{path}/{LOG}")):
        folder = _load_dir(f"{path}/{LOG}", n)
        if _complete(spark, folder):
            row = spark.read.schema(_STATE).parquet(folder).first().asDict()
            schema = T.StructType.fromJson(json.loads(row.pop("schema")))
            return State(schema=schema, **row)
    return None


def _write_state(spark: SparkSession, path: str, s: State) -> State:
    row = (s.load, s.first, s.keyed, s.schema.json(), s.keys, s.period, s.buckets, s.added_rows,
           s.newest, s.marks, s.high)
    spark.createDataFrame([row], _STATE).write.parquet(_load_dir(f"{path}/{LOG}", s.load))
    return s


def _next_load(spark: SparkSession, path: str, old: State | None) -> int:
    """Above every load there is, those included that never came to an end."""
    taken = [n for folder in ("", f"/{LOG}", f"/{RETIRED}") for n in _numbers(spark, f"{path}{folder}")]
    return 1 + max([0, old.load if old else 0, *taken])


# --- reading ---


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    if not keys or buckets == 1:
        return F.lit(0)
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_of(rows: DataFrame, s: State) -> list[int]:
    """Buckets that the keys of rows fall into; at most as many as the table has."""
    found = rows.select(_bucket(s.keys, s.buckets).alias("b")).distinct()
    return sorted(r["b"] for r in found.collect())


def _first_day(moment: datetime, period: str) -> str:
    """The day by which the period of a moment is named."""
    day = moment.date()
    if period == "year":
        day = day.replace(month=1, day=1)
    elif period == "month":
        day = day.replace(day=1)
    return day.isoformat()


def _folders(spark: SparkSession, path: str, s: State, after: int, day: str, buckets: Sequence[int] | None) -> list[str]:
    """Folders of the loads after a number, of periods from `day` on and of some buckets."""
    loads = [n for n in _numbers(spark, path) if (n == s.first if s.keyed else max(after, s.first - 1) < n <= s.load)]
    if buckets is None and not day:
        return [_load_dir(path, n) for n in loads]
    inner = "" if s.keyed else "/_period=*"
    picked = "*" if buckets is None else "{" + ",".join(str(b) for b in buckets) + "}"
    found = []
    for n in loads:
        fs, pattern = _fs(spark, f"{_load_dir(path, n)}{inner}/_bucket={picked}")
        names = [f.getPath().toString() for f in fs.globStatus(pattern) or []]
        found += [f for f in names if not day or "/_period=" not in f or _is_from(f, day)]
    return found


def _is_from(folder: str, day: str) -> bool:
    period = folder.split("/_period=")[1].split("/")[0]
    return period >= day and period != NO_DATE


def _stored(
    spark: SparkSession,
    path: str,
    s: State,
    after: int = 0,
    day: str = "",
    buckets: Sequence[int] | None = None,
) -> DataFrame:
    """Rows of the loads after a number, with the columns the table is laid out by.

    Reading with the table's own schema gives NULL for columns a file does not have yet and leaves
    out columns the table no longer has.
    """
    extra = "_added int, _bucket int" if s.keyed else "_load int, _period date, _bucket int"
    schema = T.StructType([*s.schema.fields, *T.StructType.fromDDL(extra).fields])
    folders = _folders(spark, path, s, after, day, buckets)
    if not folders:
        # The filter tells Spark that there are no rows, so that joins with them are left out of the plan.
        return spark.createDataFrame([], schema).filter(F.lit(False))
    base = _load_dir(path, s.first) if s.keyed else path
    rows = spark.read.schema(schema).option("basePath", base).parquet(*folders)
    return rows.filter(F.col("_added") > after) if s.keyed and after else rows


def _known(spark: SparkSession, path: str) -> State:
    s = state(spark, path)
    if s is None:
        raise FileNotFoundError(f"no table at {path}")
    return s


def read_table(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    buckets: Sequence[int] | None = None,
) -> DataFrame:
    """The rows of a table.

    `since` leaves out the periods of a log before it; rows of its own period are all returned.
    `buckets` leaves out all other buckets.
    """
    s = _known(spark, path)
    day = "" if since is None or s.keyed else _first_day(since, s.period)
    return _stored(spark, path, s, 0, day, buckets).select(*s.schema.names)


def read_added(spark: SparkSession, path: str, after: int) -> DataFrame:
    """All rows that loads after a number have added, whatever stamps they carry."""
    s = _known(spark, path)
    return _stored(spark, path, s, after).select(*s.schema.names)


def read_retired(spark: SparkSession, path: str, after: int) -> DataFrame:
    """Rows that merges after a load have taken out of a keyed table, where they were kept."""
    s = _known(spark, path)
    folder = f"{path}/{RETIRED}"
    loads = [n for n in _numbers(spark, folder) if after < n <= s.load]
    if not loads:
        return spark.createDataFrame([], s.schema)
    return spark.read.schema(s.schema).parquet(*[_load_dir(folder, n) for n in loads])


def forget_retired(spark: SparkSession, path: str, upto: int) -> None:
    """Delete retired rows that everyone who needs them has read."""
    for n in _numbers(spark, f"{path}/{RETIRED}"):
        if n <= upto:
            delete(spark, _load_dir(f"{path}/{RETIRED}", n))


# --- writing ---


def _write(
    df: DataFrame, folder: str, by: Sequence[str], s: State, event: str | None, mode: str = "error"
) -> State:
    """Write rows in partitions; returns the state with what the rows of load `s.load` say of themselves.

    They are observed by the tasks that write them, after the shuffle, so that nothing is read back;
    the result of a task that is run again counts once. With no columns to partition by, each task
    writes its rows as they come, without a shuffle or a sort. `mode` may be dynamic.
    """
    # Splits a large partition over several tasks and keeps a small one in one file.
    laid_out = df.hint("rebalance", *[F.col(c) for c in by]) if by else df
    own = F.col("_added") == s.load if s.keyed else F.lit(True)
    newest = F.col(STAMP) if STAMP in s.schema.names else F.lit(None).cast("timestamp")
    high = F.col(event) if event else F.lit(None).cast("timestamp")
    seen = Observation()
    out = laid_out.observe(
        seen, F.count_if(own).alias("rows"),
        F.max(F.when(own, F.unix_micros(newest.cast("timestamp")))).alias("newest"),
        F.max(F.when(own, F.unix_micros(high.cast("timestamp")))).alias("high"),
    ).write.partitionBy(*by).option("compression", "zstd")
    if mode == "dynamic":
        out = out.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        out = out.mode(mode)
    out.parquet(folder)
    found = seen.get
    later = lambda known, us: max(
        (x for x in (known, T.TimestampType().fromInternal(us)) if x is not None), default=None
    )
    return replace(
        s, added_rows=found["rows"], newest=later(s.newest, found["newest"]),
        high=later(s.high, found["high"]),
    )


def _period(s: State) -> Column:
    if STAMP in s.schema.names:
        return F.date_trunc(s.period, STAMP).cast("date")
    return F.lit(None).cast("date")


def _only_folder(s: State, moment: datetime | None) -> str | None:
    """Folder of all rows of a table's first load, or of a rebuild, if there is but one.

    Later loads of a log are shuffled into few files, which add up.
    """
    if s.buckets > 1 or s.load != s.first:
        return None
    if s.keyed:
        return "_bucket=0"
    if STAMP not in s.schema.names:
        return f"_period={NO_DATE}/_bucket=0"
    return f"_period={_first_day(moment, s.period)}/_bucket=0" if moment else None


def _add_load(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    s: State,
    event: str | None,
    moment: datetime | None = None,
) -> State:
    """Write rows as the folder of load `s.load`. `moment` is the ingest stamp of all rows, if they share
    one."""
    folder, only = _load_dir(path, s.load), _only_folder(s, moment)
    if only:
        rows = df.withColumn("_added", F.lit(s.load)) if s.keyed else df
        return _write_state(spark, path, _write(rows, f"{folder}/{only}", [], s, event))
    if s.keyed:
        laid_out = df.withColumns({"_added": F.lit(s.load), "_bucket": _bucket(s.keys, s.buckets)})
        by = ["_bucket"]
    else:
        laid_out = df.withColumns({"_period": _period(s), "_bucket": _bucket(s.keys, s.buckets)})
        by = ["_period", "_bucket"]
    return _write_state(spark, path, _write(laid_out, folder, by, s, event))


def create_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = (),
    keyed: bool = False,
    period: str = PERIOD,
    buckets: int = BUCKETS,
) -> State:
    """A table without rows; one that exists is left alone."""
    old = state(spark, path)
    if old is not None:
        return old
    load = _next_load(spark, path, None)
    return _write_state(spark, path, State(load, load + 1, keyed, schema, list(keys), period, buckets))


def replace_table(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    keys: Sequence[str] = (),
    period: str = PERIOD,
    buckets: int = BUCKETS,
    marks: dict[str, int] | None = None,
    keyed: bool | None = None,
    event: str | None = None,
    moment: datetime | None = None,
) -> State:
    """Full rebuild: readers see the old rows until the new ones are complete. `moment` is the ingest
    stamp of all rows, if they share one."""
    load = _next_load(spark, path, state(spark, path))
    is_keyed = bool(keys) if keyed is None else keyed
    s = State(load, load, is_keyed, df.schema, list(keys), period, buckets, marks=marks or {})
    return _add_load(spark, path, df, s, event, moment)


def append_table(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    event: str | None = None,
    moment: datetime | None = None,
) -> State:
    """Add rows to a log as a load of their own; nothing that is stored is rewritten. `moment` is the
    ingest stamp of all rows, if they share one."""
    old = _known(spark, path)
    if old.keyed:
        raise ValueError(f"{path} is merged into, not added to")
    s = replace(old, load=_next_load(spark, path, old), schema=rows.schema)
    return _add_load(spark, path, rows, s, event, moment)


def merge_table(
    spark: SparkSession,
    path: str,
    new_rows: DataFrame,
    keys: Sequence[str],
    retire_by: DataFrame | None = None,
    retire_if: Column | None = None,
    buckets: int = BUCKETS,
    marks: dict[str, int] | None = None,
    keep_retired: bool = False,
) -> State:
    """Add `new_rows` to a keyed table; rows they supersede leave it.

    A stored row is retired if it has the key of a row of `retire_by` (default: the new rows) and
    `retire_if` holds for the two, which sees them as aliases `old` and `new`. The columns of
    `new_rows` become the columns of the table. NULL keys never match, so such rows are only added.

    Read and written are the buckets that new and retiring rows fall into. `keep_retired` stores the rows that leave
    the table beside it, see read_retired().
    """
    old = state(spark, path)
    if old is None:
        return replace_table(spark, path, new_rows, keys, buckets=buckets, marks=marks)
    if list(keys) != old.keys or not old.keyed:
        raise ValueError(f"{path} is laid out by {old.keys}, not {list(keys)}")
    load = _next_load(spark, path, old)
    s = replace(old, load=load, schema=new_rows.schema, added_rows=0, marks=old.marks | (marks or {}))
    retiring = new_rows if retire_by is None else retire_by
    if old.buckets == 1:
        # With one bucket there is nothing to choose, so the rows are not worked out for it.
        searched = (retiring,) if retire_by is None else (retiring, new_rows)
        touched = [] if all(rows.isEmpty() for rows in searched) else [0]
    else:
        keys_of = new_rows.select(*keys)
        touched = buckets_of(keys_of if retire_by is None else keys_of.unionByName(retiring.select(*keys)), old)
    if not touched:
        return _write_state(spark, path, s)
    base = _load_dir(path, old.first)
    files = {b: set(children(spark, f"{base}/_bucket={b}")) for b in touched}
    stored = _stored(spark, path, s, buckets=touched)
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    if retire_if is not None:
        on.append(retire_if)
    remaining = stored.alias("old").join(retiring.alias("new"), on, "left_anti")
    if keep_retired:
        gone = stored.alias("old").join(retiring.alias("new"), on, "left_semi")
        gone.select(*old.schema.names).write.parquet(_load_dir(f"{path}/{RETIRED}", load))
    fresh = new_rows.withColumn("_added", F.lit(load))
    if old.buckets == 1 and not files[0]:
        done = _write(fresh, f"{base}/_bucket=0", [], s, None, "overwrite")
        return _write_state(spark, path, done)
    fresh = fresh.withColumn("_bucket", _bucket(old.keys, old.buckets))
    done = _write(remaining.unionByName(fresh), base, ["_bucket"], s, None, "dynamic")
    for b, names in files.items():
        # Spark leaves a partition alone for which there are no rows: all of its rows were retired.
        if names and set(children(spark, f"{base}/_bucket={b}")) == names:
            delete(spark, f"{base}/_bucket={b}")
    return _write_state(spark, path, done)


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete rows that were replaced, and what is known of loads before the newest `keep`."""
    s = state(spark, path)
    if s is None:
        return
    for n in _numbers(spark, f"{path}/{LOG}")[:-keep]:
        delete(spark, _load_dir(f"{path}/{LOG}", n))
    for n in _numbers(spark, path):
        if n < s.first:
            delete(spark, _load_dir(path, n))
