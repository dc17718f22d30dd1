"""Queries against their SQL on rows with missing values, and where their SQL goes another way."""

import duckdb
import pytest

from tesserae.operators import links, ranks
from tesserae.plans import catalogue


@pytest.fixture
def both(spark, tmp_path):
    """Rows of a query and of its SQL, as sets of tuples in the SQL's order, over the ``rows`` of a table."""

    def run(name, table, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/{table}.parquet")
        con = duckdb.connect()
        con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
        want = con.sql(catalogue.oracle_sql()[name])
        got = catalogue.queries()[name](spark, f"file://{tmp_path}").select(*want.columns).collect()
        assert len(got) == len(rows)
        return {tuple(r) for r in got}, set(want.fetchall())

    return run


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_ids_of_rows_without_source_or_id(spark, both):
    rows = [(None if k % 50 == 7 else k, "t", "en", None if k % 3 == 0 else f"s{k % 3}", 1) for k in range(300)]
    got, want = both("doc_ids", "documents", rows, DOCS)
    assert got == want and len(got) >= 297
    df = spark.createDataFrame([(k % 2, None if k in (11, 12) else 100 - k) for k in range(60)], "k int, ord long")
    for n in (7, 1000):
        last = {r._n for r in ranks.placed(df, ["k"], piece_rows=n).where("ord is null").collect()}
        assert last == {30}


def test_ids_past_four_digits(spark, both):
    """The SQL's lpad cuts them, so that ids come again; ours stay apart and are the SQL's up to there."""
    got, want = both("doc_ids", "documents", [(k, "t", "en", "s", 1) for k in range(12_000)], DOCS)
    assert len({r[2] for r in got}) == 12_000 and len({r[2] for r in want}) == 9_899
    assert {(s, d, i[:7]) for s, d, i in got} == want
    assert {r for r in got if r[1] < 9_899} == {r for r in want if r[1] < 9_899} and ("s", 9_899, "XXX10000") in got
    more = spark.createDataFrame([("A", "AAA", 1), (None, None, 2)], "country string, iso3 string, ord long")
    last = spark.createDataFrame([("A", 9_999), (None, 7)], "country string, last_num long")
    assert sorted(r.doc_id for r in links.numbered(more, last).collect()) == ["AAA10000", "XXX0008"]


PAGES = "page_id long, url string, html string"


def test_fields_of_no_page(both):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<title> A &amp; b</title><h1 class='x'>C</h1>"), (4, None, "<p>d</p>"), (5, "u", None)]
    got, want = both("html_fields", "pages", rows, PAGES)
    assert got == want == {(1, None, None), (2, "", ""), (3, "A & b", "C"), (4, "", ""), (5, None, None)}


def test_fields_with_other_references(both):
    """The SQL reads ``&amp;`` and no other; ours reads what pages are written with, also where a cut took the last semicolon."""
    rows = [(1, "u", "<title>token = &quot;77</title><h1>x&lt;y &#39;z&#39;</h1>"), (2, "u", "<title>this&amp;&amp</title><h1>a &amp;lt; b</h1>"), (3, "u", "<title>this&am</title><h1>caf&eacute;</h1>")]
    got, want = both("html_fields", "pages", rows, PAGES)
    assert got == {(1, 'token = "77', "x<y 'z'"), (2, "this&&", "a &lt; b"), (3, "this&am", "café")}
    assert want == {(1, "token = &quot;77", "x&lt;y &#39;z&#39;"), (2, "this&&amp", "a &lt; b"), (3, "this&am", "caf&eacute;")}


def test_need_without_language(both):
    rows = [(1, "x", None, "s", 1), (2, "x", "en", "s", 1), (3, "x", "fr", "s", 1), (4, None, None, "s", 1), (5, "", "en", "s", 1), (6, None, "en", "s", 1)]
    got, want = both("translate_need", "documents", rows, DOCS)
    assert got == want == {(1, None, None), (2, "en", False), (3, "fr", True), (4, None, None), (5, "en", False), (6, "en", False)}


def test_need_without_text(both):
    """The SQL looks at the language alone; where there is no text there is nothing to translate."""
    rows = [(k, t, "de", "s", 1) for k, t in enumerate([None, "", "  ", "\n\t\u3000", "ja"])]
    got, want = both("translate_need", "documents", rows, DOCS)
    assert got == {(k, "de", k == 4) for k in range(5)} and want == {(k, "de", True) for k in range(5)}
