"""Data-quality checks over the given data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.catalog.lake import AS_OF, Lake
from wagerlens.catalog.registry import query
from wagerlens.catalog.sqlparts import AS_OF as AS_OF_SQL
from wagerlens.operators import quality as q
from wagerlens.plans import declared, medallion
from wagerlens.plans.medallion import EXPECTED_ROWS
from wagerlens.schemas import DEVICES, FILE_SCHEMAS, struct
from wagerlens.sources.files import NON_EMPTY, SourceError, check_file, write_file
from wagerlens.sources.scratch import scratch_dir


def _deliveries_sql(dataset: str) -> str:
    """What check_file() says of a whole delivery, of one without its last column, and of one
    without rows (a CSV file keeps its header)."""
    names = FILE_SCHEMAS[dataset].names
    empty = "'file is empty'" if dataset in NON_EMPTY else "'ok'"
    return f"""SELECT 'whole' AS delivery, 'ok' AS outcome, count(*) AS rows FROM raw_{dataset}
        UNION ALL
        SELECT 'cut', 'missing columns [\'\'{names[-1]}\'\']', count(*) FROM raw_{dataset}
        UNION ALL SELECT 'empty', {empty}, 0""".replace("\\'", "'")


def _register_file_checks() -> None:
    for letter, dataset in zip("abcd", FILE_SCHEMAS):

        def check(lake: Lake, dataset=dataset) -> DataFrame:
            root = scratch_dir(lake.spark, "delivered")
            names, rows = FILE_SCHEMAS[dataset].names, lake.raw[dataset]
            write_file(rows, dataset, f"{root}/whole")
            if dataset in ("players", "sessions"):
                rows.select(*names[:-1]).write.json(f"{root}/cut")
            else:
                rows.select(*names[:-1]).write.csv(f"{root}/cut", header=True)
            write_file(rows.limit(0), dataset, f"{root}/empty")
            found = []
            for delivery in ("whole", "cut", "empty"):
                try:
                    check_file(lake.spark, dataset, f"{root}/{delivery}")
                    outcome = "ok"
                except SourceError as e:
                    outcome = str(e).removeprefix(f"{dataset}: ")
                n = rows if delivery != "empty" else rows.limit(0)
                found.append(
                    n.agg(F.count(F.lit(1)).alias("rows")).select(
                        F.lit(delivery).alias("delivery"), F.lit(outcome).alias("outcome"), "rows"
                    )
                )
            return reduce(DataFrame.unionByName, found)

        query(f"q0{letter}_required_columns_{dataset}", _deliveries_sql(dataset))(check)


_register_file_checks()


def _test_sql() -> str:
    """Every declared test of the stored tables as one row."""
    parts = []

    def add(table: str, test: str, column: str, failures: str) -> None:
        parts.append(
            f"SELECT '{table}' AS \"table\", '{test}' AS test, '{column}' AS \"column\","
            f" ({failures}) AS failures"
        )

    for table in TESTED:
        for c in declared.NOT_NULL.get(table, []):
            add(table, "not_null", c, f"SELECT count(*) FROM {table} WHERE {c} IS NULL")
        for c, values in declared.ACCEPTED.get(table, {}).items():
            listed = ", ".join(f"'{v}'" for v in values)
            add(table, "accepted_values", c,
                f"SELECT count(*) FROM {table} WHERE {c} NOT IN ({listed})")
        for c in declared.UNIQUE.get(table, []):
            add(table, "unique", c,
                f"SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL"
                f" GROUP BY {c} HAVING count(*) > 1)")
        for c, (parent, pc) in declared.RELATIONSHIPS.get(table, {}).items():
            add(table, "relationships", c,
                f"SELECT count(DISTINCT {c}) FROM {table} WHERE {c} NOT IN"
                f" (SELECT {pc} FROM {parent})")
    rows = " UNION ALL ".join(parts)
    return (
        f"SELECT *, CASE WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status FROM ({rows})"
    )


TESTED = [
    *(f"raw_{d}" for d in FILE_SCHEMAS),
    *(f"stg_{d}" for d in FILE_SCHEMAS),
    "dim_players",
    "dim_sessions",
    "fct_transactions",
    "dim_affiliates",
    "fct_fraud_signals",
    "fct_affiliate_performance",
    "fct_financial_summary",
]


def _tested_frames(lake: Lake) -> dict[str, DataFrame]:
    frames: dict[str, DataFrame] = {f"raw_{d}": df for d, df in lake.raw.items()}
    frames |= {f"stg_{d}": lake.staging(d) for d in FILE_SCHEMAS}
    for name in TESTED[8:12]:
        frames[name] = lake.silver(name)
    for name in TESTED[12:]:
        frames[name] = lake.gold(name)
    return frames


@query("q1_q2_q3_q4_declared_tests", _test_sql())
def _(lake: Lake) -> DataFrame:
    return declared.run_tests(_tested_frames(lake))


def _failures_sql() -> str:
    """Failing values of every declared test."""
    parts = []

    def add(table: str, test: str, column: str, where: str, having: str = "") -> None:
        parts.append(
            f"SELECT '{table}' AS \"table\", '{test}' AS test, '{column}' AS \"column\","
            f" CAST({column} AS VARCHAR) AS value, count(*) AS n_records FROM {table}"
            f" WHERE {where} GROUP BY {column} {having}"
        )

    for table in TESTED:
        for c in declared.NOT_NULL.get(table, []):
            add(table, "not_null", c, f"{c} IS NULL")
        for c, values in declared.ACCEPTED.get(table, {}).items():
            add(table, "accepted_values", c, f"{c} NOT IN ({', '.join(repr(v) for v in values)})")
        for c in declared.UNIQUE.get(table, []):
            add(table, "unique", c, f"{c} IS NOT NULL", "HAVING count(*) > 1")
        for c, (parent, pc) in declared.RELATIONSHIPS.get(table, {}).items():
            add(table, "relationships", c, f"{c} NOT IN (SELECT {pc} FROM {parent})")
    return " UNION ALL ".join(parts)


@query("l13_stored_failures", _failures_sql())
def _(lake: Lake) -> DataFrame:
    """All declared tests, stored and read back."""
    path = scratch_dir(lake.spark, "failures")
    declared.store_failures(_tested_frames(lake), path)
    return declared.read_failures(lake.spark, path)


@query(
    "q1_duplicates",
    """SELECT session_id AS value, count(*) AS n_records FROM raw_sessions
        GROUP BY session_id HAVING count(*) > 1""",
)
def _(lake: Lake) -> DataFrame:
    return q.duplicates(lake.raw["sessions"], "session_id")


@query("q2_nulls", "SELECT player_id, email FROM dim_players WHERE city IS NULL")
def _(lake: Lake) -> DataFrame:
    return q.nulls(lake.players, "city").select("player_id", "email")


@query(
    "q3_relationships",
    """SELECT player_id AS value, count(*) AS n_records FROM raw_affiliates
        WHERE player_id NOT IN (SELECT player_id FROM raw_sessions) GROUP BY player_id""",
)
def _(lake: Lake) -> DataFrame:
    return q.orphans(lake.raw["affiliates"], "player_id", lake.raw["sessions"], "player_id")


@query(
    "q4_accepted_values",
    """SELECT device AS value, count(*) AS n_records FROM raw_sessions
        WHERE device NOT IN ('android', 'ios', 'desktop') GROUP BY device""",
)
def _(lake: Lake) -> DataFrame:
    return q.not_accepted(lake.raw["sessions"], "device", DEVICES)


def _metric_sql(check: str, value: str, limit: str, ok: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", CAST({value} AS DOUBLE) AS value,"
        f" CAST({limit} AS DOUBLE) AS \"limit\","
        f" CASE WHEN {ok} THEN 'OK' ELSE 'ALERT' END AS status FROM {source}"
    )


@query(
    "q5_load_counts",
    " UNION ALL ".join(
        f"SELECT 'row_count:{d}' AS \"check\","
        f" CAST((SELECT count(*) FROM {t}) AS DOUBLE) AS value,"
        f" CAST(count(*) AS DOUBLE) AS \"limit\","
        f" CASE WHEN count(*) = (SELECT count(*) FROM {t}) THEN 'OK' ELSE 'ALERT' END AS status"
        f" FROM raw_{d}"
        for d, t in zip(
            FILE_SCHEMAS, ("dim_players", "dim_sessions", "fct_transactions", "dim_affiliates")
        )
    ),
)
def _(lake: Lake) -> DataFrame:
    """Rows that reached silver against rows delivered; redeliveries raise alerts."""
    tables = ("dim_players", "dim_sessions", "fct_transactions", "dim_affiliates")
    return reduce(
        DataFrame.unionByName,
        [q.load_count(lake.raw[d], lake.silver(t), d) for d, t in zip(FILE_SCHEMAS, tables)],
    )


@query(
    "q6_volume_alert",
    " UNION ALL ".join(
        _metric_sql(f"volume:{d}", f"count(*) / {n}.0", "0.9", f"count(*) / {n}.0 >= 0.9",
                    f"raw_{d}")
        for d, n in EXPECTED_ROWS.items()
    ),
)
def _(lake: Lake) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [q.volume_alert(lake.raw[d], n, d) for d, n in EXPECTED_ROWS.items()],
    )


@query(
    "q7_schema_changes",
    """SELECT 'device' AS "column", 'type' AS change, 'bigint' AS expected, 'string' AS found
        WHERE EXISTS (SELECT 1 FROM raw_sessions WHERE device IS NOT NULL)
        UNION ALL SELECT 'app', 'added', NULL, 'string'
        WHERE EXISTS (SELECT 1 FROM raw_sessions WHERE session_id LIKE 'S%7')
        UNION ALL SELECT 'ip', 'missing', 'string', NULL
        WHERE EXISTS (SELECT 1 FROM raw_sessions)""",
)
def _(lake: Lake) -> DataFrame:
    """Delivered JSON whose fields are found by reading all of it: one field appears in some rows
    only, one is gone, and one is not of the type expected."""
    path = scratch_dir(lake.spark, "delivery")
    rows = lake.raw["sessions"].withColumn("app", F.expr("IF(session_id LIKE 'S%7', 'x', NULL)"))
    rows.select("session_id", "player_id", "device", "app").write.json(path)
    found = lake.spark.read.json(path)
    expected = struct("session_id string, player_id string, ip string, device bigint")
    return q.schema_changes(found, expected)


_VALID = f"""CASE WHEN amount < 0 OR amount IS NULL
          OR transaction_type NOT IN ('deposit', 'withdraw', 'bet')
          OR transaction_timestamp > {AS_OF_SQL} THEN 0 ELSE 1 END"""


@query(
    "q8_valid_share",
    _metric_sql("valid_rows", f"sum({_VALID}) / CAST(count(*) AS DOUBLE)", "0.95",
                f"sum({_VALID}) >= 0.95 * count(*)", "fct_transactions"),
)
def _(lake: Lake) -> DataFrame:
    return q.valid_share(q.mark_violations(lake.tx, q.transaction_rules(AS_OF)))


@query(
    "q9_freshness",
    _metric_sql(
        "freshness_hours:session_timestamp",
        f"(epoch_ms({AS_OF_SQL}) // 1000 - epoch_ms(max(session_timestamp)) // 1000) / 3600.0",
        "24",
        f"(epoch_ms({AS_OF_SQL}) // 1000 - epoch_ms(max(session_timestamp)) // 1000) <= 24 * 3600",
        "dim_sessions",
    ),
)
def _(lake: Lake) -> DataFrame:
    return q.freshness(lake.sessions, "session_timestamp", AS_OF)


_MISSING = "SourceError: players: missing columns [''email'']"


@query(
    "q10_run_log",
    " UNION ALL ".join(
        f"""SELECT 'check' AS stage, '{d}' AS dataset, CAST(NULL AS BIGINT) AS rows_out,
          {f"'{_MISSING}'" if d == "players" else "CAST(NULL AS VARCHAR)"} AS error"""
        for d in FILE_SCHEMAS
    ),
)
def _(lake: Lake) -> DataFrame:
    """The log of a run whose players come without a column: it ends after the checks."""
    root = scratch_dir(lake.spark, "run")
    for dataset, file in medallion.FILES.items():
        write_file(lake.raw[dataset], dataset, f"{root}/in/{file}")
    people = lake.raw["players"].select("player_id", "city", "created_at")
    people.write.mode("overwrite").json(f"{root}/in/{medallion.FILES['players']}")
    try:
        medallion.run(lake.spark, f"{root}/in", f"{root}/out", AS_OF)
    except SourceError:
        log = lake.spark.read.parquet(medallion.Layout(f"{root}/out").run_log)
        return log.select("stage", "dataset", "rows_out", "error")
    raise AssertionError("the run went on")


@query(
    "q11_marked_rows",
    f"""SELECT transaction_id,
          concat_ws(',',
            CASE WHEN amount IS NULL THEN 'amount_missing' END,
            CASE WHEN amount < 200 THEN 'amount_small' END,
            CASE WHEN transaction_timestamp > {AS_OF_SQL} THEN 'timestamp_in_future' END
          ) AS violations FROM fct_transactions""",
)
def _(lake: Lake) -> DataFrame:
    rules = q.transaction_rules(AS_OF)
    chosen = {
        "amount_missing": rules["amount_missing"],
        "amount_small": F.col("amount") < 200,
        "timestamp_in_future": rules["timestamp_in_future"],
    }
    return q.mark_violations(lake.tx, chosen).select(
        "transaction_id", F.array_join("violations", ",").alias("violations")
    )


@query(
    "q12_signal_counts",
    "SELECT signal_type, count(*) AS signals FROM fct_fraud_signals GROUP BY signal_type",
)
def _(lake: Lake) -> DataFrame:
    return q.signal_counts(lake.signals)
