"""Times the headline queries and prints one JSON line.

Silver models run from the raw tables; gold models read stored silver tables, as in a real run,
and write their own intermediates anew each time; dashboard queries read stored gold tables.
`hourly_increment` loads a thousandth of the transactions and merges it into silver.
`end_to_end` goes from raw tables to all three gold tables in a new folder.

Reported is the median of BENCH_RUNS runs (default 3), next to the first run, which includes the
compilation of the JVM. First runs differ by a fifth either way from one process to the next.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import datetime, timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from wagerlens.catalog import queries  # noqa: E402
from wagerlens.catalog.lake import Lake, lake_for  # noqa: E402
from wagerlens.plans import silver  # noqa: E402
from wagerlens.schemas import GOLD_TABLES, SILVER_KEYS  # noqa: E402
from wagerlens.session import local_session  # noqa: E402
from wagerlens.sources import bronze  # noqa: E402
from wagerlens.sources.scratch import WorkTables, scratch_dir  # noqa: E402

SILVER = ["m5_w1_dim_players", "m6_w2_dim_sessions", "m7_w3_fct_transactions",
          "m8_w4_dim_affiliates"]
GOLD = ["m9_fct_fraud_signals", "m10_fct_affiliate_performance", "m11_fct_financial_summary"]
PARTS = ["m9a_multi_accounting", "m9c_device_sharing", "m9d_rapid_deposit_withdraw",
         "m12_bridge_player_sessions", "m15_fct_affiliate_fraud", "m18_ip_logins_per_hour", "m18_trailing_hour",
         "m19_period_totals"]
DASHBOARD = ["b4_signals_by_type", "b5_signals_by_city", "b7_latest_signals",
             "b9_k3_ftd_by_affiliate", "b12_k2_top_affiliates", "b14_k4_ggr_by_city",
             "b17_risky_players"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, "bench")
    registered, lake = queries(), lake_for(spark, sf_dir)
    median: dict[str, float] = {}
    first: dict[str, float] = {}

    def measure(name: str, work) -> None:
        seconds = []
        for _ in range(runs):
            lake.work = WorkTables(spark, scratch_dir(spark, "work"))
            start = time.perf_counter()
            work()
            seconds.append(time.perf_counter() - start)
        median[name] = round(statistics.median(seconds), 3)
        first[name] = round(seconds[0], 3)

    def measure_query(name: str) -> None:
        measure(name, lambda: run(registered[name](spark, sf_dir)))

    def increments():
        """Loads a thousandth of the transactions into a stored table and merges it, one per call."""
        root = scratch_dir(spark, "increments")
        rows = lake.raw["transactions"].drop("_ingested_at")
        part = F.pmod(F.xxhash64("transaction_id"), F.lit(1000))
        path = f"{root}/parts"
        rows.withColumn("part", F.least(part, F.lit(runs))).write.partitionBy("part").parquet(path)
        stored = spark.read.parquet(path)

        def deliver(n: int) -> None:
            moment = datetime(2024, 3, 1) + timedelta(hours=(n - runs) % (runs + 1))
            batch = stored.filter(F.col("part") == n).drop("part")
            stamped = bronze.with_stamp(batch, "transactions", moment)
            bronze.backfill(spark, f"{root}/b", "transactions", stamped)
            silver.refresh(spark, "fct_transactions", f"{root}/b", f"{root}/s", moment, buckets=16)

        deliver(runs)
        todo = iter(range(runs))
        return lambda: deliver(next(todo))

    def end_to_end() -> None:
        fresh = Lake(spark, sf_dir)
        for name in GOLD_TABLES:
            fresh.gold(name)

    run(lake.raw["players"])  # start the JVM's readers and writers
    for name in SILVER:
        measure_query(name)
    for name in SILVER_KEYS:
        lake.silver(name)
    for name in GOLD + PARTS:
        measure_query(name)
    for name in GOLD_TABLES:
        lake.gold(name)
    for name in DASHBOARD:
        measure_query(name)
    measure("hourly_increment", increments())
    measure("end_to_end", end_to_end)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(median.values()), 3),
                "unit": "sec",
                "queries": median,
                "first_run": first,
                "first_run_total": round(sum(first.values()), 3),
                "runs": runs,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
