from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wagerlens.session import local_session  # noqa: E402

TESTDATA = os.environ.get("WAGERLENS_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


@pytest.fixture(scope="session")
def lake(spark, sf_dir):
    from wagerlens.catalog.lake import lake_for

    return lake_for(spark, sf_dir)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(a, b) -> bool:
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
