"""Steps whose sorts grew with the input split, held wide rows, or ran several times."""

from __future__ import annotations

import pytest
from conftest import at, rows

from wagerlens.operators.bitmaps import distinct_counts, distinct_sets, merged_sets
from wagerlens.plans import silver
from wagerlens.sources import bronze


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(silver.SILVER))
def test_a_silver_table_is_sorted_once_after_the_shuffle(lake, name):
    plan = plan_of(lake.silver_model(name))
    assert "WindowGroupLimit" in plan and "Partial" not in plan


def test_sets_are_added_up_without_sorting_them(spark):
    frame = spark.createDataFrame([(1, 5), (1, 64), (1, 64), (2, 5)], "day int, number long")
    sets = distinct_sets(frame, ["day"])
    counts = distinct_counts(merged_sets(sets, sets), [])
    assert "SortAggregate" not in plan_of(counts)
    assert rows(counts) == [(2,)]


def _affiliates(spark, moment, *pairs):
    data = [(a, p, "BR", 4, 2, 1, 1.5, at(moment)) for a, p in pairs]
    columns = "affiliate_id string, player_id string, country string, clicks long, registrations long"
    return spark.createDataFrame(data, f"{columns}, ftd int, cpa_value double, _ingested_at timestamp")


def test_an_upsert_does_not_count_its_pairs_to_join_them(spark, root, monkeypatch):
    merged = []

    def merge(spark, path, new_rows, *a, **k):
        merged.append(plan_of(new_rows))
        return plain(spark, path, new_rows, *a, **k)

    plain = bronze.merge_table
    monkeypatch.setattr(bronze, "merge_table", merge)
    first = _affiliates(spark, "2024-01-01", ("a", "1"), ("b", "1")).drop("_ingested_at")
    second = _affiliates(spark, "2024-01-02", ("a", "1"), ("c", "1")).drop("_ingested_at")
    bronze.upsert_affiliates(spark, root, first, at("2024-01-01"))
    bronze.upsert_affiliates(spark, root, second, at("2024-01-02"))
    assert not any("_slice" in p for p in merged)
    got = bronze.read_bronze(spark, root, "affiliates")
    assert rows(got.selectExpr("affiliate_id", "day(_ingested_at)")) == [("a", 2), ("b", 1), ("c", 2)]


def test_rows_of_a_refresh_are_worked_out_once(spark, root, monkeypatch):
    b, s, merged = f"{root}/bronze", f"{root}/silver", []

    def merge(spark, path, new_rows, *a, **k):
        merged.append(plan_of(new_rows))
        return plain(spark, path, new_rows, *a, **k)

    plain = silver.merge_table
    monkeypatch.setattr(silver, "merge_table", merge)
    names = bronze.BRONZE["affiliates"].names
    for moment, pairs in (
        ("2024-01-01", [("a", "1"), ("b", "1"), (None, "1")]),
        ("2024-01-02", [("a", "1"), ("a", "2"), ("a", "2")]),
        ("2023-12-01", [("a", "1"), ("c", "1")]),
    ):
        delivery = _affiliates(spark, moment, *pairs)
        cast = [delivery[f.name].cast(f.dataType) for f in bronze.BRONZE["affiliates"].fields]
        bronze.backfill(spark, b, "affiliates", delivery.select(cast).toDF(*names))
        silver.refresh(spark, "dim_affiliates", b, s, at("2024-02-01"))
    assert len(merged) == 2 and not any("Window" in p for p in merged)
    got = silver.read_table(spark, f"{s}/dim_affiliates")
    assert rows(got.selectExpr("affiliate_id", "player_id", "date(_ingested_at)")) == sorted(
        [("a", "1", at("2024-01-02").date()), ("a", "2", at("2024-01-02").date()),
         ("b", "1", at("2024-01-01").date()), ("c", "1", at("2023-12-01").date()),
         (None, "1", at("2024-01-01").date())], key=repr,
    )
