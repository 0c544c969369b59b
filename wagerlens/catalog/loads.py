"""Scans, loads and stored tables, run over the given data in two deliveries."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.catalog.lake import AS_OF, Lake
from wagerlens.catalog.models import SILVER_SQL, STG_SQL, SUMMARY_SQL
from wagerlens.catalog.registry import query
from wagerlens.catalog.sqlparts import AS_OF as AS_OF_SQL
from wagerlens.catalog.sqlparts import RELATIONS, day, ts
from wagerlens.functions.times import stamp
from wagerlens.operators.dedup import by_key, latest
from wagerlens.plans import medallion, upkeep
from wagerlens.plans.silver import dim_sessions, refresh
from wagerlens.plans.staging import register_views
from wagerlens.schemas import BRONZE, FILE_SCHEMAS, SILVER_KEYS, SILVER_SOURCE
from wagerlens.session import shuffles_dropped
from wagerlens.sources import bronze
from wagerlens.sources.files import (
    good_rows,
    parse_file,
    rejected_rows,
    scan_file,
    write_file,
)
from wagerlens.sources.scratch import WorkTables, scratch_dir
from wagerlens.sources.tables import read_table, replace_table

FIRST_RUN = datetime(2024, 3, 1)
SECOND_RUN = datetime(2024, 3, 2)
FIRST_SQL, SECOND_SQL = (f"TIMESTAMP '{d}'" for d in (FIRST_RUN, SECOND_RUN))


def _file_columns(rows: DataFrame, dataset: str) -> DataFrame:
    return rows.select(*FILE_SCHEMAS[dataset].names)


# --- scans of source files ---


def _scan(lake: Lake, dataset: str) -> DataFrame:
    path = scratch_dir(lake.spark, dataset)
    write_file(lake.raw[dataset], dataset, path)
    return scan_file(lake.spark, dataset, path)


@query(
    "l1a_scan_players_json",
    f"SELECT player_id, email, city, {day('created_at')} AS created_at FROM raw_players",
)
def _(lake: Lake) -> DataFrame:
    return _scan(lake, "players")


@query(
    "l1b_scan_sessions_json",
    f"""SELECT session_id, player_id, ip, device, {ts('"timestamp"')} AS "timestamp"
        FROM raw_sessions""",
)
def _(lake: Lake) -> DataFrame:
    return _scan(lake, "sessions")


@query(
    "l1c_scan_transactions_csv",
    f"""SELECT transaction_id, player_id, type, amount,
          {ts('"timestamp"')} AS "timestamp" FROM raw_transactions""",
)
def _(lake: Lake) -> DataFrame:
    return _scan(lake, "transactions")


@query(
    "l1d_scan_affiliates_csv",
    """SELECT affiliate_id, player_id, country, clicks, registrations, ftd,
          cpa_value FROM raw_affiliates""",
)
def _(lake: Lake) -> DataFrame:
    return _scan(lake, "affiliates")


_BROKEN = {"players": "player_id", "sessions": "session_id", "transactions": "transaction_id",
           "affiliates": "affiliate_id"}


@query(
    "l1e_rejected_rows",
    " UNION ALL ".join(
        f"""SELECT '{d}' AS dataset,
          count(*) FILTER (NOT {k} LIKE '%7') AS good, count(*) FILTER ({k} LIKE '%7') AS rejected
        FROM raw_{d}"""
        for d, k in _BROKEN.items()
    ),
)
def _(lake: Lake) -> DataFrame:
    """Deliveries in which every row whose key ends in 7 is broken: JSON lines are cut short, CSV
    rows have a word for a number."""
    root, counts = scratch_dir(lake.spark, "broken"), []
    for dataset, key in _BROKEN.items():
        rows, path = _file_columns(lake.raw[dataset], dataset), f"{root}/{dataset}"
        hit = F.col(key).like("%7")
        if dataset in ("players", "sessions"):
            line = F.to_json(F.struct(*rows.columns))
            cut = F.when(hit, F.substring(line, 1, 12)).otherwise(line)
            rows.select(cut.alias("value")).write.text(path)
        else:
            number = "amount" if dataset == "transactions" else "clicks"
            text = F.col(number).cast("string")
            word = rows.withColumn(number, F.when(hit, "many").otherwise(text))
            write_file(word, dataset, path)
        parsed = parse_file(lake.spark, dataset, path)
        counts.append(
            good_rows(parsed)
            .agg(F.count(F.lit(1)).alias("good"))
            .crossJoin(rejected_rows(parsed, dataset).agg(F.count("text").alias("rejected")))
            .select(F.lit(dataset).alias("dataset"), "good", "rejected")
        )
    return reduce(DataFrame.unionByName, counts)


# --- bronze ---


@query(
    "l2_create_bronze",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, count(*) AS rows, count(*) AS stamped_by_default FROM raw_{d}"
        for d in BRONZE
    ),
)
def _(lake: Lake) -> DataFrame:
    """Create each table twice, which must leave it alone, then fill it without stamps."""
    root = scratch_dir(lake.spark, "bronze")
    counts = []
    for dataset, rows in lake.raw.items():
        bronze.create_bronze(lake.spark, root, dataset)
        bronze.create_bronze(lake.spark, root, dataset)
        unstamped = bronze.with_stamp(_file_columns(rows, dataset), dataset, FIRST_RUN)
        table = bronze.read_bronze(lake.spark, root, dataset).unionByName(unstamped)
        counts.append(
            table.agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col("_ingested_at") == stamp(FIRST_RUN)).alias("stamped_by_default"),
            ).select(F.lit(dataset).alias("dataset"), "rows", "stamped_by_default")
        )
    return reduce(DataFrame.unionByName, counts)


@query(
    "l3_players_append",
    f"""SELECT player_id, email, city, {day('created_at')} AS created_at,
          {ts('run')} AS _ingested_at
        FROM raw_players, (VALUES ({FIRST_SQL}), ({SECOND_SQL})) AS r(run)""",
)
def _(lake: Lake) -> DataFrame:
    """Two runs over the same delivery: every run appends all rows."""
    root, rows = scratch_dir(lake.spark, "bronze"), _file_columns(lake.raw["players"], "players")
    bronze.append_players(lake.spark, root, rows, FIRST_RUN)
    bronze.append_players(lake.spark, root, rows, SECOND_RUN)
    return bronze.read_bronze(lake.spark, root, "players")


# The second delivery overlaps the first by three days.
_FIRST_ENDS, _SECOND_STARTS = "2024-01-20", "2024-01-17"


def _insert_twice(lake: Lake, dataset: str) -> DataFrame:
    root, rows = scratch_dir(lake.spark, "bronze"), _file_columns(lake.raw[dataset], dataset)
    load = bronze.LOADS[dataset]
    load(lake.spark, root, rows.filter(F.col("timestamp") < _FIRST_ENDS), FIRST_RUN)
    load(lake.spark, root, rows.filter(F.col("timestamp") >= _SECOND_STARTS), SECOND_RUN)
    return bronze.read_bronze(lake.spark, root, dataset)


def _insert_twice_sql(dataset: str, key: str, columns: str) -> tuple[str, dict[str, str]]:
    relations = {
        "first_load": f"""SELECT * FROM raw_{dataset} WHERE "timestamp" > TIMESTAMP '2020-01-01'
          AND "timestamp" < TIMESTAMP '{_FIRST_ENDS}'""",
        "second_load": f"""SELECT * FROM raw_{dataset}
          WHERE "timestamp" >= TIMESTAMP '{_SECOND_STARTS}'
          AND "timestamp" > (SELECT max("timestamp") FROM first_load)
          AND {key} NOT IN (SELECT {key} FROM first_load)""",
    }
    sql = " UNION ALL ".join(
        f"""SELECT {columns}, {ts('"timestamp"')} AS "timestamp", {ts(run)} AS _ingested_at
        FROM {name}"""
        for name, run in (("first_load", FIRST_SQL), ("second_load", SECOND_SQL))
    )
    return sql, relations


@query(
    "l4a_sessions_insert_only",
    *_insert_twice_sql("sessions", "session_id", "session_id, player_id, ip, device"),
)
def _(lake: Lake) -> DataFrame:
    return _insert_twice(lake, "sessions")


@query(
    "l4b_transactions_insert_only",
    *_insert_twice_sql(
        "transactions", "transaction_id", "transaction_id, player_id, type, amount"
    ),
)
def _(lake: Lake) -> DataFrame:
    return _insert_twice(lake, "transactions")


_PAIR_ORDER = "clicks DESC, registrations DESC, ftd DESC, cpa_value DESC, country DESC NULLS LAST"
_AFFILIATE_CUT = "1998-01-01"


def _one_per_pair(lake: Lake, condition: str) -> DataFrame:
    rows = lake.raw["affiliates"].filter(condition)
    return latest(
        by_key(rows, bronze.AFFILIATE_KEYS),
        bronze.AFFILIATE_KEYS,
        ["clicks", "registrations", "ftd", "cpa_value", "country"],
    ).drop("_ingested_at")


def _one_per_pair_sql(condition: str) -> str:
    return f"""SELECT * FROM raw_affiliates WHERE {condition}
        QUALIFY row_number() OVER (PARTITION BY affiliate_id, player_id
          ORDER BY _ingested_at DESC, {_PAIR_ORDER}) = 1"""


@query(
    "l4c_j8_affiliates_upsert",
    f"""SELECT affiliate_id, player_id, country, clicks, registrations, ftd, cpa_value,
          {ts(SECOND_SQL)} AS _ingested_at FROM second_load
        UNION ALL
        SELECT affiliate_id, player_id, country, clicks, registrations, ftd, cpa_value,
          {ts(FIRST_SQL)} FROM first_load
        WHERE (affiliate_id, player_id) NOT IN (SELECT (affiliate_id, player_id) FROM second_load)
        """,
    {
        "first_load": _one_per_pair_sql(f"_ingested_at < TIMESTAMP '{_AFFILIATE_CUT}'"),
        "second_load": _one_per_pair_sql(f"_ingested_at >= TIMESTAMP '{_AFFILIATE_CUT}'"),
    },
)
def _(lake: Lake) -> DataFrame:
    """The second delivery updates the pairs the first one brought and inserts the others."""
    root = scratch_dir(lake.spark, "bronze")
    staging = WorkTables(lake.spark, f"{root}/staging")
    for name, condition, run in (
        ("first", f"_ingested_at < '{_AFFILIATE_CUT}'", FIRST_RUN),
        ("second", f"_ingested_at >= '{_AFFILIATE_CUT}'", SECOND_RUN),
    ):
        delivered = staging.keep(name, _one_per_pair(lake, condition))
        bronze.upsert_affiliates(lake.spark, root, delivered, run)
    return bronze.read_bronze(lake.spark, root, "affiliates")


# --- silver ---

# Rows stamped up to this moment come with the first of two loads. Each load gives its rows one
# stamp of its own.
_MARKS = {
    "players": "2023-12-31",
    "sessions": "2024-01-16",
    "transactions": "2024-01-10",
    "affiliates": "1999-01-01",
}


def _refresh_twice(lake: Lake, name: str, first_model=None) -> DataFrame:
    dataset = SILVER_SOURCE[name]
    root = scratch_dir(lake.spark, "incremental")
    b, s = f"{root}/bronze", f"{root}/silver"
    early = F.col("_ingested_at") <= _MARKS[dataset]
    for part, run, model in ((early, FIRST_RUN, first_model), (~early, SECOND_RUN, None)):
        rows = lake.raw[dataset].filter(part).withColumn("_ingested_at", stamp(run))
        bronze.backfill(lake.spark, b, dataset, rows)
        refresh(lake.spark, name, b, s, run, model=model)
    return read_table(lake.spark, f"{s}/{name}")


def _two_loads_sql(dataset: str) -> dict[str, str]:
    raw = f"raw_{dataset}"
    return {
        raw: f"""SELECT * REPLACE (CASE WHEN _ingested_at <= TIMESTAMP '{_MARKS[dataset]}'
          THEN {FIRST_SQL} ELSE {SECOND_SQL} END AS _ingested_at) FROM ({RELATIONS[raw]})"""
    }


def _register_refreshes() -> None:
    for letter, name in zip("abcd", SILVER_KEYS):
        query(
            f"l5{letter}_f4_incremental_{name}",
            SILVER_SQL[name],
            _two_loads_sql(SILVER_SOURCE[name]),
        )(lambda lake, name=name: _refresh_twice(lake, name))


_register_refreshes()


@query(
    "l5e_one_stamp_several_deliveries",
    SILVER_SQL["dim_sessions"],
    {
        "raw_sessions": f"""SELECT * REPLACE (CASE WHEN session_id LIKE '%3'
          THEN TIMESTAMP '2024-02-01' ELSE {FIRST_SQL} END AS _ingested_at)
          FROM ({RELATIONS["raw_sessions"]})"""
    },
)
def _(lake: Lake) -> DataFrame:
    """Deliveries under one stamp, then one under an earlier stamp: all of them reach silver."""
    root = scratch_dir(lake.spark, "stamps")
    b, s = f"{root}/bronze", f"{root}/silver"
    rows = lake.raw["sessions"]
    ends = lambda *digits: F.substring("session_id", -1, 1).isin(*digits)
    for part, moment in (
        (ends("0", "1", "2"), FIRST_RUN),
        (ends("4", "5", "6"), FIRST_RUN),
        (ends("3"), datetime(2024, 2, 1)),
        (ends("7", "8", "9"), FIRST_RUN),
    ):
        delivery = rows.filter(part).withColumn("_ingested_at", stamp(moment))
        bronze.backfill(lake.spark, b, "sessions", delivery)
        refresh(lake.spark, "dim_sessions", b, s, FIRST_RUN)
    return read_table(lake.spark, f"{s}/dim_sessions")


def _old_sessions(stg: DataFrame) -> DataFrame:
    """An earlier form of the model: no weekday, and a column that was dropped since."""
    return dim_sessions(stg).drop("day_of_week").withColumn("platform", F.col("device"))


@query(
    "l6_schema_sync",
    SILVER_SQL["dim_sessions"].replace(
        "day_of_week",
        f"CASE WHEN _ingested_at = {SECOND_SQL} THEN day_of_week END AS day_of_week",
    ),
    _two_loads_sql("sessions"),
)
def _(lake: Lake) -> DataFrame:
    """Rows merged before the column existed have NULL in it; the dropped column is gone."""
    return _refresh_twice(lake, "dim_sessions", _old_sessions)


@query(
    "p10_audit_stamps",
    f"""SELECT 'silver' AS layer, {ts('_ingested_at')} AS processed_at,
          {ts('_ingested_at')} AS updated_at, count(*) AS rows
        FROM dim_sessions GROUP BY _ingested_at
        UNION ALL
        SELECT 'staging', {ts(FIRST_SQL)}, NULL, count(*) FROM raw_sessions
        UNION ALL
        SELECT 'gold', {ts(AS_OF_SQL)}, NULL, count(*) FROM fct_financial_summary""",
    _two_loads_sql("sessions"),
)
def _(lake: Lake) -> DataFrame:
    """The stamps that say which run wrote a row; rows of the first load keep its stamp."""
    register_views(lake.raw, FIRST_RUN)
    none = F.lit(None).cast("timestamp")
    parts = [
        ("silver", _refresh_twice(lake, "dim_sessions"), "_dbt_processed_at", "_silver_updated_at"),
        ("staging", lake.spark.table("stg_sessions"), "_dbt_processed_at", None),
        ("gold", lake.gold_model("fct_financial_summary"), "_gold_processed_at", None),
    ]
    counted = [
        rows.groupBy(
            F.lit(layer).alias("layer"),
            F.col(processed).alias("processed_at"),
            (F.col(updated) if updated else none).alias("updated_at"),
        ).agg(F.count(F.lit(1)).alias("rows"))
        for layer, rows, processed, updated in parts
    ]
    return reduce(DataFrame.unionByName, counted)


@query("l7_l9_staging_view", STG_SQL["sessions"])
def _(lake: Lake) -> DataFrame:
    register_views(lake.raw, FIRST_RUN)
    return lake.spark.sql("SELECT * FROM stg_sessions")


# --- gold ---


@query("l8_l11_gold_rebuild", SUMMARY_SQL)
def _(lake: Lake) -> DataFrame:
    """Written twice; the second build replaces the first."""
    path = f"{scratch_dir(lake.spark, 'gold')}/fct_financial_summary"
    frame = lake.gold_model("fct_financial_summary")
    replace_table(lake.spark, path, frame.filter("risk_classification = 'NORMAL'"))
    replace_table(lake.spark, path, frame)
    return read_table(lake.spark, path)


@query(
    "l12_bronze_by_ingest_date",
    f"""SELECT session_id, player_id, ip, device, {ts('"timestamp"')} AS "timestamp",
          {ts('_ingested_at')} AS _ingested_at
        FROM raw_sessions WHERE _ingested_at > TIMESTAMP '2024-01-25 00:00:00'""",
)
def _(lake: Lake) -> DataFrame:
    """Only folders of the last days are opened."""
    root = scratch_dir(lake.spark, "bronze")
    bronze.backfill(lake.spark, root, "sessions", lake.raw["sessions"])
    return bronze.read_bronze(lake.spark, root, "sessions", since=datetime(2024, 1, 25))


# --- a whole run ---


def _run_relations() -> dict[str, str]:
    """Bronze as one run loads it: one stamp for all rows."""
    return {
        name: f"SELECT * REPLACE ({FIRST_SQL} AS _ingested_at) FROM ({RELATIONS[name]})"
        for name in ("raw_players", "raw_affiliates", "raw_sessions", "raw_transactions")
    }


@query(
    "l14_incremental_control",
    f"""SELECT 'signals' AS part, signal_type AS name, count(*) AS n,
          CAST(NULL AS DOUBLE) AS amount
        FROM fct_fraud_signals GROUP BY signal_type
        UNION ALL
        SELECT 'players', risk_classification, count(*), CAST(sum(ggr) AS DOUBLE)
        FROM fct_financial_summary GROUP BY risk_classification
        UNION ALL
        SELECT 'affiliates', country, CAST(sum(total_players) AS BIGINT),
          CAST(sum(player_net_revenue) AS DOUBLE)
        FROM fct_affiliate_performance GROUP BY country""",
    _run_relations(),
)
def _(lake: Lake) -> DataFrame:
    """Files to gold in one run."""
    root = scratch_dir(lake.spark, "run")
    with shuffles_dropped(lake.spark):
        for dataset, file in medallion.FILES.items():
            write_file(lake.raw[dataset], dataset, f"{root}/in/{file}", "gzip")
    out = f"{root}/out"
    medallion.run(lake.spark, f"{root}/in", out, FIRST_RUN)
    gold = medallion.read_gold(lake.spark, medallion.Layout(out))
    return (
        gold["fct_fraud_signals"]
        .groupBy("signal_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.lit("signals").alias("part"),
            F.col("signal_type").alias("name"),
            "n",
            F.lit(None).cast("double").alias("amount"),
        )
        .unionByName(
            gold["fct_financial_summary"]
            .groupBy("risk_classification")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("ggr").cast("double").alias("amount"))
            .select(
                F.lit("players").alias("part"),
                F.col("risk_classification").alias("name"),
                "n",
                "amount",
            )
        )
        .unionByName(
            gold["fct_affiliate_performance"]
            .groupBy("country")
            .agg(
                F.sum("total_players").alias("n"),
                F.sum("player_net_revenue").cast("double").alias("amount"),
            )
            .select(
                F.lit("affiliates").alias("part"), F.col("country").alias("name"), "n", "amount"
            )
        )
    )


@query(
    "l14_summary_upkeep",
    SUMMARY_SQL,
    _two_loads_sql("transactions") | _two_loads_sql("players"),
)
def _(lake: Lake) -> DataFrame:
    """The financial summary after two deliveries, the second one taken in by what it changes."""
    root = scratch_dir(lake.spark, "upkeep")
    b, s, out = (f"{root}/{n}" for n in ("bronze", "silver", "gold"))
    for n, run in enumerate((FIRST_RUN, SECOND_RUN)):
        for name in (upkeep.TX, upkeep.PLAYERS):
            dataset = SILVER_SOURCE[name]
            early = F.col("_ingested_at") <= _MARKS[dataset]
            rows = lake.raw[dataset].filter(~early if n else early)
            bronze.backfill(lake.spark, b, dataset, rows.withColumn("_ingested_at", stamp(run)))
            refresh(lake.spark, name, b, s, run, buckets=8, keep_retired=True)
        work = WorkTables(lake.spark, f"{root}/work{n}")
        upkeep.refresh_summary(lake.spark, s, out, work, AS_OF, buckets=8)
    return upkeep.read_summary(lake.spark, out)
