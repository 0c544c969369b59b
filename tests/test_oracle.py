"""Every registered query against its SQL."""

from __future__ import annotations

import math

import pytest

from wagerlens.catalog import checks, queries

duckdb = pytest.importorskip("duckdb")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def test_every_query_has_check_sql():
    assert set(queries()) == set(checks())


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = con.execute(checks()[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    expected = sorted(tuple(_value(r[i]) for i in order) for r in cursor.fetchall())
    got = sorted(tuple(_value(r[c]) for c in columns) for r in df.collect())
    assert got == expected
