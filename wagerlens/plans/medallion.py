"""One run from source files to gold tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from wagerlens.functions.times import stamp
from wagerlens.operators import quality
from wagerlens.operators.quality import append_run_log
from wagerlens.plans import affiliates, declared, finance, fraud, silver, upkeep
from wagerlens.plans.staging import STAGING
from wagerlens.schemas import BRONZE_TABLES, GOLD_TABLES
from wagerlens.session import prepare, shuffles_dropped
from wagerlens.sources.bronze import FIRST_MARK, LOADS, read_bronze, table_path
from wagerlens.sources.files import (
    check_added,
    check_file,
    good_rows,
    parse_file,
    rejected_rows,
)
from wagerlens.sources.scratch import WorkTables, kept
from wagerlens.sources.tables import BUCKETS, delete, expire, read_table, replace_table, state

SUMMARY = "fct_financial_summary"
# Player lists of the groups that signals name.
PLAYER_PAGES = "related_player_pages"
# Tables next to the three gold models, rebuilt after them.
MARTS = (
    "bridge_player_sessions",
    "fct_multi_accounting",
    "fct_deposit_without_bet",
    "fct_affiliate_fraud",
    "fct_player_ltv",
)
# Rows expected per delivery, hours until events are stale, seconds per stage.
EXPECTED_ROWS = {"players": 600, "sessions": 4_000, "transactions": 1_800, "affiliates": 2_000}
FRESH_HOURS = 24.0
STAGE_SECONDS = 3600.0

# Names of the delivered files.
FILES = {
    "players": "players.json",
    "sessions": "sessions.json",
    "transactions": "transactions.csv",
    "affiliates": "affiliate_cpa_ftd.csv",
}


@dataclass(frozen=True)
class Options:
    """How a run loads and stores its tables.

    `buckets` lays out bronze and silver tables by key when they are created; a bucket should hold some
    gigabytes, and a load reads and writes those of its keys only. Events at or before `first_mark` never pass an empty table, and `lookback_minutes`
    lets later loads take events that far behind the newest. `full_reload` replaces the players of
    earlier runs. `upkeep` keeps the financial summary up to date by what each load changes instead of
    rebuilding it; choose it for a warehouse from its first run on. `expected_rows` are alerted on, not
    enforced.
    """

    buckets: int = BUCKETS
    first_mark: datetime = FIRST_MARK
    lookback_minutes: int = 0
    full_reload: bool = False
    upkeep: bool = False
    expected_rows: Mapping[str, int] = field(default_factory=lambda: dict(EXPECTED_ROWS))

    def of_load(self, dataset: str) -> dict:
        if dataset == "players":
            return {"full_reload": self.full_reload, "buckets": self.buckets}
        if dataset == "affiliates":
            return {"buckets": self.buckets}
        return {"lookback_minutes": self.lookback_minutes, "first_mark": self.first_mark,
                "buckets": self.buckets}


@dataclass(frozen=True)
class Layout:
    """Folders of one warehouse."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def summary(self) -> str:
        """What the summary is put together from, where it is kept up to date."""
        return f"{self.root}/gold/summary_parts"

    @property
    def work(self) -> str:
        return f"{self.root}/work"

    @property
    def failures(self) -> str:
        return f"{self.root}/quality/failures"

    @property
    def rejected(self) -> str:
        """Rows of deliveries that could not be read, by run."""
        return f"{self.root}/quality/rejected"

    @property
    def metrics(self) -> str:
        return f"{self.root}/quality/metrics"

    @property
    def run_log(self) -> str:
        return f"{self.root}/quality/run_log"


class _Log:
    """Collects one row per stage; a stage that fails is logged before the error goes on."""

    def __init__(self, as_of: datetime):
        self.as_of = as_of
        self.entries: list[tuple] = []

    def stage(self, stage: str, dataset: str, step: Callable[[], int | None]) -> None:
        start, rows, error = time.monotonic(), None, None
        try:
            rows = step()
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            raise
        finally:
            seconds = time.monotonic() - start
            self.entries.append((self.as_of, stage, dataset, rows, seconds, error))


def _all(steps: Iterable[Callable[[], None]]) -> None:
    """Run steps that do not depend on each other; Spark shares its cores among their jobs. All
    of them end before the first error is raised."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def gold_frame(
    name: str,
    silver_frames: Mapping[str, DataFrame],
    as_of: datetime,
    work: WorkTables | None = None,
) -> DataFrame:
    """One gold model. Models given the same `work` share the totals per player."""
    tx = silver_frames["fct_transactions"]
    if name == "fct_fraud_signals":
        return fraud.fraud_signals(silver_frames["dim_sessions"], tx, as_of, work)
    if name == "fct_affiliate_performance":
        return affiliates.affiliate_performance(silver_frames["dim_affiliates"], tx, as_of, work)
    return finance.financial_summary(tx, silver_frames["dim_players"], as_of, work)


def read_silver(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {n: read_table(spark, f"{layout.silver}/{n}") for n in silver.SILVER}


def read_gold(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The tables a dashboard opens."""
    kept = {SUMMARY: upkeep.read_summary(spark, layout.summary)} if upkeep.is_kept(spark, layout.summary) else {}
    return kept | {n: read_table(spark, f"{layout.gold}/{n}") for n in GOLD_TABLES if n not in kept}


def rebuild_gold(
    spark: SparkSession, layout: Layout, as_of: datetime, work: WorkTables | None, name: str
) -> int:
    """Replace one gold table; returns its number of rows."""
    tables = read_silver(spark, layout)
    frame = gold_frame(name, tables, as_of, work)
    rows = replace_table(spark, f"{layout.gold}/{name}", frame).added_rows
    if name == "fct_fraud_signals":
        pages = fraud.related_player_pages(tables["dim_sessions"], work)
        replace_table(spark, f"{layout.gold}/{PLAYER_PAGES}", pages)
    return rows


def mart_frame(name: str, tables: Mapping[str, DataFrame], work: WorkTables | None) -> DataFrame:
    """One of MARTS from the silver and gold tables."""
    if name == "bridge_player_sessions":
        return silver.bridge_player_sessions(tables["dim_sessions"], tables["dim_players"])
    if name == "fct_multi_accounting":
        return fraud.multi_accounting_groups(tables["dim_sessions"], work)
    if name == "fct_deposit_without_bet":
        totals = kept(work, "player_totals", finance.player_financials(tables["fct_transactions"]))
        return fraud.player_deposits_without_bet(totals)
    if name == "fct_affiliate_fraud":
        return affiliates.affiliate_fraud(tables["dim_affiliates"], tables["fct_fraud_signals"])
    return finance.player_ltv(tables["fct_financial_summary"])


def rebuild_mart(spark: SparkSession, layout: Layout, work: WorkTables | None, name: str) -> int:
    tables = read_silver(spark, layout) | read_gold(spark, layout)
    frame = mart_frame(name, tables, work)
    return replace_table(spark, f"{layout.gold}/{name}", frame).added_rows


def quality_metrics(
    delivered: Mapping[str, int],
    loaded: Mapping[str, int],
    tables: Mapping[str, DataFrame],
    entries: list[tuple],
    as_of: datetime,
    expected_rows: Mapping[str, int],
) -> DataFrame:
    """Metric rows of one run: volume and load counts per dataset, valid share and freshness of
    transactions, signals per type, seconds per stage. `delivered` and `loaded` are numbers of rows."""
    tx, signals = tables["fct_transactions"], tables["fct_fraud_signals"]
    some = next(iter(tables.values())).sparkSession
    counted = {d: some.createDataFrame([(n,)], "n long") for d, n in delivered.items()}
    found = [quality.counted_volume(counted[d], n, d) for d, n in expected_rows.items()]
    found += [quality.counted_load(n, loaded[d], d) for d, n in counted.items()]
    found.append(quality.valid_share(quality.mark_violations(tx, quality.transaction_rules(as_of))))
    found.append(quality.freshness(tx, "transaction_timestamp", as_of, FRESH_HOURS))
    found.append(quality.signal_metrics(signals))
    found.append(quality.runtime_alert(some, entries, STAGE_SECONDS))
    return reduce(DataFrame.unionByName, found)


def all_frames(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Every table of the warehouse by name, staging models included."""
    bronze = {d: read_bronze(spark, layout.bronze, d) for d in BRONZE_TABLES}
    return (
        {BRONZE_TABLES[d]: df for d, df in bronze.items()}
        | {f"stg_{d}": STAGING[d](df) for d, df in bronze.items()}
        | read_silver(spark, layout)
        | read_gold(spark, layout)
    )


def run(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    as_of: datetime,
    json_array: bool = False,
    store_failures: bool = False,
    options: Options = Options(),
) -> DataFrame:
    """Check and load the files, refresh silver, rebuild gold, log the run, test the tables.

    A file with missing or added columns ends the run before anything is loaded. Rows that can't be
    read are kept aside and logged, and so are the numbers of events that came too late. Metrics of
    the run are appended to the metrics table. Returns the results of the declared tests. Running
    again with files already loaded inserts nothing but players, which every run appends.
    """
    prepare(spark)
    layout, log = Layout(out_dir), _Log(as_of)
    # Two runs on one warehouse must not share work tables.
    work_dir = f"{layout.work}/{uuid.uuid4().hex}"
    work = WorkTables(spark, work_dir)
    delivered: dict[str, int] = {}
    loaded: dict[str, int] = {}

    def check(dataset: str) -> None:
        path = f"{in_dir}/{FILES[dataset]}"
        check_added(dataset, check_file(spark, dataset, path, json_array))

    def load(dataset: str) -> int:
        # The file is parsed once, into the table the load reads, which goes with the load.
        rows = parse_file(spark, dataset, f"{in_dir}/{FILES[dataset]}", json_array)
        staging = f"{work_dir}/{BRONZE_TABLES[dataset]}_staging"
        parsed = WorkTables(spark, staging).keep("parsed", rows)
        bad = rejected_rows(parsed, dataset).withColumn("as_of", stamp(as_of))
        n_bad = bad.count()
        if n_bad:
            bad.write.mode("append").parquet(layout.rejected)
            log.entries.append((as_of, "rejected", dataset, n_bad, 0.0, None))
        good = good_rows(parsed)
        delivered[dataset] = good.count()
        late = LOADS[dataset](spark, layout.bronze, good, as_of, **options.of_load(dataset))
        if late:
            log.entries.append((as_of, "late", dataset, late, 0.0, None))
        loaded[dataset] = state(spark, table_path(layout.bronze, dataset)).added_rows
        delete(spark, staging)
        return loaded[dataset]

    def refresh(name: str) -> int:
        return silver.refresh(
            spark, name, layout.bronze, layout.silver, as_of, options.buckets,
            keep_retired=options.upkeep and name in (upkeep.TX, upkeep.PLAYERS),
        ).added_rows

    def gold(name: str) -> int:
        if options.upkeep and name == SUMMARY:
            return upkeep.refresh_summary(
                spark, layout.silver, layout.summary, work, as_of, options.buckets
            )
        return rebuild_gold(spark, layout, as_of, work, name)

    try:
        with shuffles_dropped(spark):
            for stage, names, step in (
                ("check", FILES, check),
                ("bronze", FILES, load),
                ("silver", silver.SILVER, refresh),
                ("gold", GOLD_TABLES, gold),
                ("mart", MARTS, partial(rebuild_mart, spark, layout, work)),
            ):
                _all(partial(log.stage, stage, name, partial(step, name)) for name in names)
        for dataset in FILES:
            expire(spark, table_path(layout.bronze, dataset))
        for name in silver.SILVER:
            expire(spark, f"{layout.silver}/{name}")
        for name in (*GOLD_TABLES, *MARTS, PLAYER_PAGES):
            expire(spark, f"{layout.gold}/{name}")
        for name in upkeep.PARTS:
            expire(spark, f"{layout.summary}/{name}")
        tables = read_silver(spark, layout) | read_gold(spark, layout)
        with shuffles_dropped(spark):
            metrics = quality_metrics(
                delivered, loaded, tables, log.entries, as_of, options.expected_rows
            )
            metrics.withColumn("run_at", stamp(as_of)).write.mode("append").parquet(layout.metrics)
        delete(spark, work_dir)
    finally:
        append_run_log(spark, layout.run_log, log.entries)
    frames = all_frames(spark, layout)
    if store_failures:
        declared.store_failures(frames, layout.failures)
    return declared.run_tests(frames)
