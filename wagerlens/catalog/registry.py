"""Names, queries and check SQL, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wagerlens.catalog.lake import Lake, lake_for
from wagerlens.catalog.present import present
from wagerlens.catalog.sqlparts import with_relations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, relations: dict[str, str] | None = None):
    """Register a function of the lake under a name, with the SQL that gives the same rows."""

    def add(fn: Callable[[Lake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: present(fn(lake_for(spark, sf_dir)))
        if sql is not None:
            CHECKS[name] = with_relations(sql, relations)
        return fn

    return add
