"""The queries of the training-data operators against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tesserae.llm import queries, sql
from tests.test_catalogue import plain

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, rows = queries.queries()[name](spark, SF), con.sql(sql.oracle_sql()[name])
    names = sorted(got.columns)
    assert names == sorted(rows.columns)
    at = [rows.columns.index(n) for n in names]
    assert sorted(tuple(plain(r[n]) for n in names) for r in got.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in rows.fetchall())
