"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from paths import TESTDATA

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
from check_queries import normal  # noqa: E402

SF_DIR = Path(TESTDATA) / "sf0.001"

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_of_the_library_has_sql():
    from querybook.oracle import ORACLES
    from querybook.queries import QUERIES

    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, str(SF_DIR)).toPandas()
    want = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
