"""The four bronze tables derived from the given star-schema tables.

Spaces and mixed case are added on purpose, as are second deliveries of every 50th row, so
that clean-up and deduplication have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.schemas import BRONZE
from wagerlens.session import prepare

REDELIVER_EVERY = 50


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _deliveries(key: str) -> Column:
    """0 for the first delivery, 1 for the second one some rows get."""
    return F.explode(
        F.when(F.col(key) % REDELIVER_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
    )


def _recent(day: str) -> Column:
    """A day of the nineties as one of 2020 to 2023, past the first mark of the loads."""
    since = F.datediff(F.col(day).cast("date"), F.lit("1992-01-01").cast("date"))
    return F.date_add(F.lit("2020-02-01").cast("date"), F.pmod(since, F.lit(1400))).cast("timestamp")


def _ingest_stamp(ts: str) -> Column:
    return (F.date_trunc("day", ts) + F.make_dt_interval(F.col("_again") + 1)).cast("timestamp")


def _shape(df: DataFrame, dataset: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE[dataset].fields])


def raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return _shape(
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").cast("string").alias("player_id"),
            F.concat(F.lit("  "), "c_name", F.lit("@Example.COM ")).alias("email"),
            F.when(F.col("n_name") == "NATION_24", F.lit(None))
            .otherwise(F.concat(F.lit(" "), "n_name", F.lit(" ")))
            .alias("city"),
            F.date_add(F.lit("2023-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
            .alias("created_at"),
            F.lit("2024-01-01").cast("timestamp").alias("_ingested_at"),
        ),
        "players",
    )


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").select(
        "event_id", "user_id", "props", F.col("ts").cast("timestamp").alias("timestamp")
    )
    plain_device = (
        F.when(F.col("event_id") % 3 == 0, " Android")
        .when(F.col("event_id") % 3 == 1, "iOS ")
        .otherwise("DESKTOP")
    )
    return _shape(
        events.withColumn("_again", _deliveries("event_id")).select(
            F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("session_id"),
            F.col("user_id").cast("string").alias("player_id"),
            F.concat(
                F.lit(" 10."),
                F.expr("user_id div 2").cast("string"),
                F.lit(".0."),
                (F.get_json_object("props", "$.k").cast("bigint") % 20).cast("string"),
            ).alias("ip"),
            F.when(F.col("_again") == 1, "desktop").otherwise(plain_device).alias("device"),
            "timestamp",
            _ingest_stamp("timestamp").alias("_ingested_at"),
        ),
        "sessions",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_key"),
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("player_id"),
        F.when(F.col("o_orderstatus") == "F", " BET")
        .when(F.col("o_orderstatus") == "O", "Deposit ")
        .otherwise("withdraw")
        .alias("type"),
        F.col("o_totalprice").alias("amount"),
        _recent("o_orderdate").alias("timestamp"),
    )
    events = (
        _read(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("purchase", "signup", "click"))
        .select(
            F.col("event_id").alias("_key"),
            F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("transaction_id"),
            F.col("user_id").cast("string").alias("player_id"),
            F.when(F.col("event_type") == "click", " BET")
            .when(F.col("event_type") == "purchase", "Deposit ")
            .otherwise("withdraw")
            .alias("type"),
            F.col("value").alias("amount"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )
    )
    return _shape(
        orders.unionByName(events)
        .withColumn("_again", _deliveries("_key"))
        .withColumn("amount", F.col("amount") + F.col("_again"))
        .withColumn("_ingested_at", _ingest_stamp("timestamp")),
        "transactions",
    )


def raw_affiliates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"
    )
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Nations last: Spark takes the suppliers with them for a large table, for which it would shuffle
    # the lines a second time.
    return _shape(
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("A"), F.col("l_suppkey").cast("string")).alias("affiliate_id"),
            F.col("o_custkey").cast("string").alias("player_id"),
            F.when(F.col("n_name") == "NATION_0", F.lit(None))
            .otherwise(F.concat(F.lit(" "), F.lower("n_name")))
            .alias("country"),
            (F.col("l_quantity").cast("bigint") * (F.col("l_partkey") % 7)).alias("clicks"),
            F.col("l_quantity").cast("bigint").alias("registrations"),
            F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("ftd"),
            (F.floor(F.abs(F.col("s_acctbal"))) / F.lit(4.0)).alias("cpa_value"),
            F.col("l_shipdate").alias("_ingested_at"),
        ),
        "affiliates",
    )


def bronze_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    prepare(spark)
    return {
        "players": raw_players(spark, sf_dir),
        "sessions": raw_sessions(spark, sf_dir),
        "transactions": raw_transactions(spark, sf_dir),
        "affiliates": raw_affiliates(spark, sf_dir),
    }
