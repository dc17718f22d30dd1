"""Rules that the registered queries touch only in part."""

import pytest
from pyspark.sql import functions as F

from tesserae.functions import dates as D
from tesserae.functions import urls as U
from tesserae.operators import enrich, gate, html, links, reports
from tesserae.sources import files


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) if v is None or isinstance(v, str) else F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expr.alias("x")).first()["x"]


def test_seeded_sample(spark):
    docs = spark.range(500).withColumnRenamed("id", "doc_id")
    ids = lambda seed, parts: sorted(r.doc_id for r in links.seeded_sample(docs.repartition(parts), 20, seed).collect())
    assert ids(1, 2) == ids(1, 7) and ids(1, 2) != ids(2, 2) and len(set(ids(1, 2))) == 20
    assert links.seeded_sample(docs.limit(3), 20, 1).count() == 3


def test_transcribed(spark):
    media = spark.createDataFrame([("a.mp3", 1), ("b.mp3", 2)], "path string, k int")
    got = enrich.transcribed(media, lambda p: (f"text of {p}", "en")).collect()
    assert sorted((r.k, r.text, r.language) for r in got) == [(1, "text of a.mp3", "en"), (2, "text of b.mp3", "en")]


def test_table_function(spark):
    spark.udtf.register("extract_links", html.ExtractLinks)
    rows = spark.sql("""select * from extract_links('<base href="/r/"><a href=a>x</a><a href="a">y</a><a href="https://o.org">z</a>', 'https://s.org/p')""").collect()
    assert [(r.ord, r.url) for r in rows] == [(0, "https://s.org/r/a"), (1, "https://o.org")]


def test_tables_of_any_age(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"file://{tmp_path}/1")
    spark.createDataFrame([(2, "x")], "a int, b string").write.parquet(f"file://{tmp_path}/2")
    assert sorted((r.a, r.b) for r in files.parquet(spark, f"file://{tmp_path}/1", f"file://{tmp_path}/2").collect()) == [(1, None), (2, "x")]


@pytest.mark.parametrize(
    "row, scraped, audio, want",
    [
        ((0, 5, False, False, False, False, True), 9, False, ""), ((2, 5, True, True, True, True, True), 9, False, "stale_links"), ((2, 5, True, True, True, True, True), 5, True, "post_limit"),
        ((2, 5, True, True, True, True, True), 5, False, "page1_only"), ((2, 5, False, True, True, True, True), 5, False, "stopped_early"), ((2, 5, False, False, True, True, True), 5, False, "capped"),
        ((2, 5, False, False, False, True, True), 5, False, "unfiltered"), ((2, 5, False, False, False, False, True), None, False, "complete"), ((2, 5, False, False, False, False, False), 1, False, "probe_only"),
    ],
)
def test_link_status(spark, row, scraped, audio, want):
    df = spark.createDataFrame([row], "n_files int, n_links int, page1_only boolean, stopped_early boolean, capped boolean, unfiltered boolean, from_run boolean")
    assert df.select(reports.link_status(F.lit(scraped).cast("int"), F.lit(audio)).alias("s")).first().s == want


def test_head_dates(spark):
    line = lambda t, **kw: one(spark, D.head_date(F.col("t"), max_year=F.lit(2030), **kw), t=t)
    assert line("Title\n| 19.11.2010 |\nBody") == "2010-11-19" and line("Friday, November 08, 2013") == "2013-11-08" and line("Published: 3. März 2021") == "2021-03-03"
    assert line("He spoke on 3 May 2011 in Rome") is None and line("/uploads/2015-07-20/x") is None and line("05/12/2016") is None and line("13/05/2016") == "2016-05-13"
    assert line("31.02.2011") is None and line("12.5.1950") is None and line("2020年5月3日") == "2020-05-03" and line("a\nb\nc\nd\n1.2.2003") is None
    assert line("5. srpna 2010", languages=["cs"]) == "2010-08-05" and line("14 juillet 2010", languages=["cs"]) is None
    assert line("x" * 70 + " 1.2.2003") is None and line(None) is None and line("") is None


def test_parse_dates(spark):
    day = lambda t, *a, **kw: one(spark, D.parse_date(F.col("t"), *a, max_year=F.lit(2030), **kw), t=t)
    assert day("2024-05-25T10:00:00Z") == "2024-05-25" and day("Buenos Aires, 25 de mayo de 2024", ["es"]) == "2024-05-25" and day("Publié le 14 juillet 2023", ["fr"]) == "2023-07-14"
    assert day("05/12/2016") == "2016-12-05" and day("05/12/2016", ["en"]) == "2016-05-12" and day("25 de mayo de 2024", ["en"]) is None
    assert day("0001-11-30") is None and day("no date") is None and day(None) is None and day("version 1.2.2003.4") is None
    assert day("3 days ago", ["en"], today=F.lit("2024-03-02")) == "2024-02-28" and day("yesterday", ["en"]) is None


def test_hijri_dates(spark):
    got = lambda t: tuple(one(spark, D.hijri_date(F.col("t")), t=t) or (None, None))
    assert got("۱۹ حمل ۱۴۰۴\nمتن سخنرانی") == ("2025-04-08", "day") and got("جلسه در 1 سنبله 1400 برگزار شد") == ("2021-08-23", "day") and got("۱ فروردین ۱۴۰۳") == ("2024-03-20", "day")
    assert got("تاریخ نشر: 1404/01/19") == ("2025-04-08", "day") and got("در جریان سال 1403 اقدامات") == ("2024", "year") and got("En el ano 1403 ocurrio") == (None, None)
    assert got("۵ ثور ۱۴۰۲ و همچنین سال ۱۳۹۹")[1] == "day" and got("عدد 12345") == (None, None) and got(None) == (None, None)


def test_small_rules(spark):
    assert one(spark, U.archive_prefix(F.col("t")), t="a.org/x/") == "a.org/x/*"
    assert one(spark, gate.by_position(F.col("t"))["method"], t="") == "gpt"
    assert one(spark, links.link_fate(F.lit("u"), F.col("t"), F.lit(False)), t=" ") == "filtered"
    assert one(spark, files.unescaped(F.col("t")), t="a &amp;lt; b &#233;&#x1F600; &quot;c&quot; &unknown;") == 'a &lt; b é😀 "c" &unknown;'
