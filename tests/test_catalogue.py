"""Every registered query against its SQL in another engine, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from tesserae.plans import catalogue
from tesserae.plans.views import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    return value.isoformat() if hasattr(value, "isoformat") else str(list(value)) if hasattr(value, "__len__") and not isinstance(value, str) else str(value)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_agrees(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    rows = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(got.columns) == sorted(rows.columns)
    names = sorted(got.columns)
    at = [rows.columns.index(n) for n in names]
    want = sorted(tuple(plain(r[i]) for i in at) for r in rows.fetchall())
    assert sorted(tuple(plain(r[n]) for n in names) for r in got.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == e.queries()["dup_clusters"](spark, SF).columns
    assert set(e.oracle_sql()) <= set(e.queries())
