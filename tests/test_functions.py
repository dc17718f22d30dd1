"""Expressions on single values, one case for each rule."""

import datetime

import pytest
from pyspark.sql import functions as F

from tesserae.functions import dates as D
from tesserae.functions import languages as L
from tesserae.functions import text as T
from tesserae.functions import urls as U
from tesserae.operators import duplicates, enrich, folds, gate, html


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) if v is None or isinstance(v, str) else F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expr.alias("x")).first()["x"]


def test_text(spark):
    t = F.col("t")
    assert one(spark, T.tidy(t), t="  a \t b\r\n\r\n c \x0b d  ") == "a b\nc d"
    assert one(spark, T.normal_form(t), t=" A  b\nC ") == "a b c"
    assert one(spark, T.truncated(t, 2), t="a  b c") == "a b [...]" and one(spark, T.truncated(t, 3), t="a  b c") == "a  b c"
    assert one(spark, T.first_line(t), t="\n  x  \ny") == "x" and one(spark, T.first_line(t), t=None) == ""
    assert one(spark, T.sentences(t), t="One. Two!  Three? 4.5 ok") == ["One.", "Two!", "Three?", "4.5 ok"]
    assert one(spark, T.slug(t), t="Élan & Co. (UK)") == "lan-co-uk"
    assert one(spark, T.document_id(F.lit("ABC"), F.lit(12345))) == "ABC12345" and one(spark, T.document_id(F.lit(None).cast("string"), F.lit(7))) == "XXX0007"
    assert one(spark, T.id_number(t), t="AFG10000") == 10000 and one(spark, T.id_number(t), t="AFG") == -1
    assert one(spark, T.clipped_cell(t, 10), t="Short one. And a long rest") == "Short one"


def test_urls(spark):
    u = F.col("u")
    assert one(spark, U.page_identity(u), u="HTTP://www.X.org:80/A%20b/?utm_source=q&id=2&REF=z&a=1#f") == "x.org/a b?a=1&id=2"
    assert one(spark, U.page_identity(u), u="https://x.org/p/comment-page-3?v=~a*+b%zz") == "x.org/p?v=~a%2A+b%25zz"
    assert one(spark, U.page_identity(u, ["Foo"]), u="https://x.org/p?foo=1") == "x.org/p"
    assert one(spark, U.link_key(u), u=" https://www.A.b:80//c//d/?q=1/ ") == "a.b/c/d/?q=1"
    assert one(spark, U.canonical(u), u="http://www.a.b:8080/c/?q#f").asDict() == {"host": "a.b", "path": "/c", "url": "a.b/c"}
    assert one(spark, U.url_match(u, r"/(?P<y>\d{4})/", 1), u="http://a/2020/x") == "2020" and one(spark, U.url_match(u, r"/(\d{4})/", 1), u="http://a/x") is None
    assert one(spark, U.with_param(u, "p", F.lit(3)), u="http://a?p=1&q=2") == "http://a?p=3&q=2" and one(spark, U.with_param(u, "p", F.lit(3)), u="http://a") == "http://a?p=3"


@pytest.mark.parametrize(
    "text, want",
    [
        ("19.11.2010\nbody", "2010-11-19"), ("Title\n| 19.11.2010 |", "2010-11-19"), ("Friday, November 08, 2013", "2013-11-08"), ("Published on: 8 Nov. 2013", "2013-11-08"),
        ("2nd of March 2011", "2011-03-02"), ("2015-07-20", "2015-07-20"), ("25/12/2016", "2016-12-25"), ("12/25/2016", "2016-12-25"), ("05/12/2016", None), ("2016", None),
        ("He spoke on 2015-07-20 in town", None), ("/uploads/2015-07-20/x", None), ("31.02.2010", None), ("1.1.1985", None), ("x" * 70 + " 2015-07-20", None),
        ("a\nb\nc\nd\n2015-07-20", None), ("12 de marzo de 2014", "2014-03-12"), ("3 décembre 2012", "2012-12-03"), ("1.1.2999", None), (None, None),
    ],
)
def test_head_date(spark, text, want):
    assert one(spark, D.head_date(F.col("t")), t=text) == want


def test_hijri(spark):
    got = lambda t: tuple(one(spark, D.hijri_date(F.col("t")), t=t))
    assert got("کابل ۱۹ حمل ۱۴۰۴") == ("2025-04-08", "day") and got("تاریخ 1404/01/19") == ("2025-04-08", "day")
    assert got("سال ۱۴۰۳ بود") == ("2024", "year") and got("in the year 1403") == (None, None) and got(None) == (None, None)
    assert got("1404 حمل 19") == ("2025-04-08", "day") and got("۱۹ حمل ۱۴۹۹") == (None, None)


def test_hijri_calendar(spark):
    """Against the calendar itself: years of 365 or 366 days, new year in March."""
    days = spark.range(1350, 1418).select(D.from_hijri(F.col("id").cast("int"), F.lit(1), F.lit(1)).alias("a"), D.from_hijri(F.col("id").cast("int"), F.lit(12), F.lit(29)).alias("b")).collect()
    for x, y in zip(days, days[1:], strict=False):
        a, b, n = (datetime.date.fromisoformat(v) for v in (x.a, x.b, y.a))
        assert (a.month, a.day) in ((3, 20), (3, 21), (3, 22)) and (n - a).days in (365, 366) and (n - b).days in (1, 2)


def test_other_dates(spark):
    assert one(spark, D.capture_date(F.col("t")), t="20210000123456") == "2021-01-01" and one(spark, D.capture_date(F.col("t")), t="2021") == ""
    assert one(spark, D.capture_date(F.col("t")), t="20210231") == "2021-02-31"
    assert one(spark, D.url_date(F.col("t"), r"/(\d{4})/(\d\d)/(\d\d)/"), t="http://a/2020/02/31/x") is None
    assert one(spark, D.full_year(F.col("y")), y=68) == 2068 and one(spark, D.full_year(F.col("y")), y=69) == 1969
    assert one(spark, D.upload_date(F.col("t")), t="20200131") == "2020-01-31" and one(spark, D.upload_date(F.col("t")), t="soon") is None


@pytest.mark.parametrize(
    "case, want",
    [
        (dict(sel="2010-01-01", model="2012-02-02", cap="2015-01-01"), ("2010-01-01", "scraped", False, False)),
        (dict(model="2012-02-02", cap="2015-01-01", head="2011-01-01"), ("2012-02-02", "model", False, False)),
        (dict(model="2015-01-01", cap="2015-01-01", head="2011-01-01"), ("2011-01-01", "regex_text", False, False)),
        (dict(model="2019-01-01", cap="2015-01-01"), ("2015-01-01", "wayback_capture", True, True)),
        (dict(cap="2015-01-01", head="2016-01-01"), ("2015-01-01", "wayback_capture", True, True)),
        (dict(hijri="2014-03-21", sel="2010-01-01", cap="2015-01-01"), ("2014-03-21", "day", False, False)),
        (dict(hijri="2001-03-21", sel="2010-01-01", cap="2015-01-01"), ("2010-01-01", "scraped", True, False)),
        (dict(hijri="2014-03-21", sel="2010-01-01", agrees=" NO"), ("2010-01-01", "scraped", True, False)),
        (dict(hijri="2001-03-21", cap="2015-01-01", head="2014-01-01"), ("2015-01-01", "wayback_capture", True, True)),
        (dict(sel="2010-01-01", model="2019-01-01"), ("2010-01-01", "scraped", True, False)),
        (dict(), ("", None, False, False)),
    ],
)
def test_resolved(spark, case, want):
    values = {k: case.get(k) for k in ("sel", "cap", "model", "agrees", "hijri", "head")}
    hijri = F.struct(F.col("hijri").alias("date"), F.when(F.col("hijri").isNotNull(), "day").alias("precision"))
    got = one(spark, D.resolved(F.col("sel"), F.col("cap"), F.col("model"), F.col("agrees"), hijri, F.col("head")), **values)
    assert (got.date, got.precision, got.disagreement, got.is_fallback) == want


def test_causes(spark):
    long = "word " * 100
    cause = lambda text, *urls: one(spark, duplicates.cause(F.array(*[F.lit(u) for u in urls]), F.col("t")), t=text)
    assert cause("tiny", "http://a/1", "http://b/2") == "junk_stub" and cause("page not found " * 10, "http://a/1", "http://b/2") == "junk_stub"
    assert cause(long, "http://a/x?q=1", "https://www.a:80/x/") == "url_variant" and cause(long, "http://a/x", "http://b/x") == "mirror"
    assert cause(long, "http://a/s/1234/x", "http://a/t/1234") == "id_variant" and cause(long, "http://a/x", "http://a/x-2") == "slug_variant"
    assert cause(long, "http://a/x", "http://a/y") == "shared_text_suspect"


def test_gate(spark):
    position = lambda p: tuple(one(spark, gate.by_position(F.col("p")), p=p))
    assert position("Deputy Prime Minister")[::2] == (False, "auto_exclude") and position(" President ") == (True, "President", "auto_include") and position("") == (None, None, "gpt")
    assert position("General Secretary")[0] is None and position("Chairman of the State Council")[0] is None and position("Prince Regent")[0] is None
    approved = lambda w, m, k: one(spark, gate.approved(F.col("w"), F.lit(m), F.col("k")), w=w, k=k)
    assert approved("yes", False, "low") and not approved("no", True, "high") and approved("", True, "High") and not approved("", True, "low")
    assert one(spark, gate.corrected(F.col("a"), F.col("b"), F.col("c")), a="x", b="y", c="no") == "y" and one(spark, gate.corrected(F.col("a"), F.col("b"), F.col("c")), a="x", b="y", c="yes") == "x"


def test_languages(spark):
    lang = lambda d, n: one(spark, L.source_language(F.col("d"), F.col("n")), d=d, n=n)
    assert lang("ES-mx", "french") == "fr" and lang("spa", None) == "sp" and lang(None, "Farsi") == "fa" and lang("nan", "xx") == "xx" and lang("", "Klingon") is None


def test_chunks(spark):
    chunks = lambda text, most: one(spark, enrich.chunks(F.col("t"), most), t=text)
    assert chunks("One. Two. Three", 10) == ["One. Two.", " Three"] and chunks("abcdefgh", 3) == ["abc", "def", "gh"]
    assert chunks("", 5) == [] and chunks("a, b c d", 5) == ["a,", " b c ", "d"]
    text = "Some words; more words! And 一。二。三 " * 30
    assert "".join(chunks(text, 50)) == text and max(map(len, chunks(text, 50))) <= 50
    assert enrich.packed(["a", "b", "c"], [3, 3, 9], 6) == [["a", "b"], ["c"]]


def test_selectors():
    page = """<html><head><title>T</title><base href="/b/"></head><body><div id=m class="x y"><p lang=en>One <b>bold</b></p><p class=z>Two</p><a href=' c.html" '>L</a></div>
    <ul><li>1<li>2</ul><div class=y><a href="http://o.x/q">M</a><span>s</span></div><script>no()</script></body></html>"""
    root = html.parse(page)
    text = lambda s: [n.text() for n in html.select(root, s)]
    assert text("#m > p.z") == ["Two"] and text("div.x.y p") == ["One bold", "Two"] and text("p[lang=en], p.z") == ["One bold", "Two"] and text("p:not(.z)") == ["One bold"]
    assert text("div:has(span) > a") == ["M"] and text("p + a") == ["L"] and text("p ~ a") == ["L"] and text("[href^=http]") == ["M"] and text("p[[") == []
    assert html.links(root, "http://s.x/a/") == ["http://s.x/b/c.html", "http://o.x/q"]
    assert html.first_match(root, ["h9", "p.z"]) == "Two" and html.first_match(root, ["p"], regex=r"(\w+) bold") == "One" and html.first_match(root, ["p"], regex="zz", required=True) == ""
    assert "no()" not in root.text()


def test_folds(spark):
    assert [one(spark, folds.backoff(F.lit(k), 2.0)) for k in (0, 3, 9)] == [2.0, 16.0, 60.0]
    assert one(spark, folds.retries(F.lit(503), F.lit(0))) == "retry" and one(spark, folds.retries(F.lit(404), F.lit(0))) == "raise" and one(spark, folds.retries(F.lit(None).cast("int"), F.lit(4))) == "raise"
    assert one(spark, html.file_kind(F.lit(bytearray(b"junk%PDF-1.7")))) == "pdf"


def test_cause_looks_at_all_places(spark):
    at = lambda n, year: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.concat(F.lit(f"https://a.org/{year}/p-"), k.cast("string"), F.lit("x")))
    text = F.lit("words of a text that is long enough to be no stub at all " * 9)
    got = spark.range(1).select(duplicates.cause(at(10_001, 2019), text).alias("a"), duplicates.cause(F.concat(at(10_001, 2019), at(2, 2020)), text).alias("b")).first()
    assert (got.a, got.b) == ("id_variant", "shared_text_suspect")


def test_models(spark):
    rows = spark.createDataFrame([("a",), ("boom",)], "prompt string")
    got = {r.prompt: (r.reply, r.error) for r in enrich.called(rows, lambda x: {"a": '{"speaker": " S ", "title": ""}'}[x]).collect()}
    assert got["boom"][0] is None and got["boom"][1].startswith("KeyError")
    assert one(spark, enrich.reply(F.col("t")), t=got["a"][0]).speaker == "S" and one(spark, enrich.empty_reply(enrich.reply(F.col("t"))), t="nope")
    docs = spark.createDataFrame([("", "hola", "es"), ("kept", "x", "es"), (None, None, "en")], "text string, text_originlanguage string, lang string")
    assert sorted(str(r.text) for r in enrich.translated(docs, ["text"], lambda t, k: f"{k}:{t}").collect()) == ["None", "es:hola", "kept"]
