"""Silver and gold tables over the given data, written once per session.

Gold models read stored silver tables and dashboards read stored gold tables, as in a real run;
queries that exercise the models themselves build them from the raw tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from wagerlens.operators.dedup import by_key
from wagerlens.plans.finance import player_financials
from wagerlens.plans.medallion import gold_frame
from wagerlens.plans.silver import SILVER
from wagerlens.plans.staging import STAGING
from wagerlens.schemas import GOLD_TABLES, SILVER_KEYS, SILVER_SOURCE
from wagerlens.sources.fixtures import bronze_frames
from wagerlens.sources.scratch import WorkTables, scratch_dir

AS_OF = datetime(2024, 2, 1)


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = bronze_frames(spark, sf_dir)
        self._dir = scratch_dir(spark, "lake")
        self._stored: dict[str, DataFrame] = {}
        self.work = WorkTables(spark, f"{self._dir}/work")

    def staging(self, dataset: str) -> DataFrame:
        return STAGING[dataset](self.raw[dataset])

    def silver_model(self, name: str) -> DataFrame:
        """A silver model built from the raw tables, not stored."""
        return SILVER[name](by_key(self.staging(SILVER_SOURCE[name]), SILVER_KEYS[name]))

    def _store(self, name: str, build) -> DataFrame:
        if name not in self._stored:
            build().write.mode("overwrite").parquet(self.path(name))
            self._stored[name] = self.spark.read.parquet(self.path(name))
        return self._stored[name]

    def path(self, name: str) -> str:
        return f"{self._dir}/{name}"

    def silver(self, name: str) -> DataFrame:
        return self._store(name, lambda: self.silver_model(name))

    def gold_model(self, name: str) -> DataFrame:
        """A gold model over stored silver tables, not stored."""
        return gold_frame(name, _SilverTables(self), AS_OF, self.work)

    def gold(self, name: str) -> DataFrame:
        return self._store(name, lambda: self.gold_model(name))

    @property
    def totals(self) -> DataFrame:
        return self.work.keep("player_totals", player_financials(self.tx))

    @property
    def players(self) -> DataFrame:
        return self.silver("dim_players")

    @property
    def sessions(self) -> DataFrame:
        return self.silver("dim_sessions")

    @property
    def tx(self) -> DataFrame:
        return self.silver("fct_transactions")

    @property
    def affiliates(self) -> DataFrame:
        return self.silver("dim_affiliates")

    @property
    def signals(self) -> DataFrame:
        return self.gold("fct_fraud_signals")

    @property
    def performance(self) -> DataFrame:
        return self.gold("fct_affiliate_performance")

    @property
    def summary(self) -> DataFrame:
        return self.gold("fct_financial_summary")


class _SilverTables(dict):
    """Stores a silver table when a gold model first asks for it."""

    def __init__(self, lake: Lake):
        super().__init__()
        self._lake = lake

    def __missing__(self, name: str) -> DataFrame:
        return self._lake.silver(name)


_LAKES: dict[tuple[str, str], Lake] = {}


def lake_for(spark: SparkSession, sf_dir: str) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, sf_dir)
    return _LAKES[key]
