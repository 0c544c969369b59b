"""Shape of the physical plans."""

from __future__ import annotations

import pytest
from conftest import at

from wagerlens.catalog.lake import AS_OF
from wagerlens.plans import affiliates, finance, fraud, silver
from wagerlens.plans.staging import STAGING
from wagerlens.schemas import SILVER_SOURCE
from wagerlens.sources import bronze


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def gold(lake):
    return {
        "signals": fraud.fraud_signals(lake.sessions, lake.tx, AS_OF),
        "performance": affiliates.affiliate_performance(lake.affiliates, lake.tx, AS_OF),
        "summary": finance.financial_summary(lake.tx, lake.players, AS_OF),
    }


@pytest.mark.parametrize("name", ["signals", "performance", "summary"])
def test_gold_stays_in_the_jvm_without_products(lake, name):
    plan = plan_of(gold(lake)[name])
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("name", list(silver.SILVER))
def test_dedup_cuts_keys_before_the_shuffle(lake, name):
    plan = plan_of(silver.SILVER[name](STAGING[SILVER_SOURCE[name]](lake.raw[SILVER_SOURCE[name]])))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_silver_reads_only_rows_after_the_mark(spark, lake, root):
    bronze.backfill(spark, root, "transactions", lake.raw["transactions"])
    recent = bronze.read_bronze(spark, root, "transactions", since=at("2024-01-20"))
    plan = plan_of(silver.fct_transactions(STAGING["transactions"](recent)))
    assert "PushedFilters: [IsNotNull(_ingested_at), GreaterThan(_ingested_at" in plan
    assert min(f.split("_period=")[1][:10] for f in recent.inputFiles()) == "2024-01-20"


def test_models_read_only_their_columns(lake):
    plan = plan_of(fraud.ip_sharing(lake.sessions))
    assert "ReadSchema: struct<player_id:string,ip:string,session_timestamp:timestamp>" in plan


def test_interval_join_filters_types_at_the_scan(lake):
    plan = plan_of(fraud.rapid_cycles(lake.tx))
    assert "EqualTo(transaction_type,deposit)" in plan
    assert "EqualTo(transaction_type,withdraw)" in plan


def test_totals_per_player_take_one_scan(lake):
    plan = plan_of(finance.player_financials(lake.tx))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
