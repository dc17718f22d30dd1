"""Readers, writers and streams on small files."""

import gzip

import pytest
from pyspark.sql import functions as F

from tesserae.operators import links
from tesserae.sources import files, harvest
from tesserae.streaming import runs

SITE = {
    "http://s.x/list?page=1": '<a href="/a/1">One</a><a href="/a/2">Two</a><a href="/other">no</a>',
    "http://s.x/list?page=2": '<a href="/a/2">Two</a><a href="/a/3">Three</a>',
    "http://s.x/list?page=3": '<a href="/a/1">One</a>',
    "http://s.x/list?page=4": '<a href="/a/9">never</a>',
    "http://s.x/n1": '<a href="/a/1">One</a><a rel=next href="/n2">next</a>',
    "http://s.x/n2": '<a href="/a/4">Four</a><a rel=next href="/n1">next</a>',
}


def fetch(url):
    return SITE.get(url)


def test_pager():
    urls = lambda **o: [r[3] for r in harvest.harvested(o.pop("start"), {"pattern": "/a/", **o}, fetch)]
    assert urls(start="http://s.x/list?page=1", pagination="query_param") == ["http://s.x/a/1", "http://s.x/a/2", "http://s.x/a/3"]
    assert urls(start="http://s.x/n1", pagination="next_link", next_selector="a[rel=next]") == ["http://s.x/a/1", "http://s.x/a/4"]
    assert urls(start="http://s.x/n1", pagination="none") == ["http://s.x/a/1"] and urls(start="http://gone", pagination="none") == []
    assert urls(start="http://q", pagination="url_list") == ["http://q"]


def test_harvest_source(spark):
    harvest.register(spark)
    rows = spark.read.format("harvest").option("starts", "http://s.x/list http://s.x/n1").option("fetcher", "tests.test_sources:fetch").option("pagination", "none").load()
    assert {r.url for r in rows.collect()} == {"http://s.x/a/1", "http://s.x/n2"}


def test_csv_tree(spark, tmp_path):
    (tmp_path / "Aland" / "sample").mkdir(parents=True)
    (tmp_path / "Aland" / "one.csv").write_text('doc_id,text\nA1,"x ""q""\ny"\nA2,\n')
    (tmp_path / "Aland" / "one_errors.csv").write_text("doc_id,text\nE,e\n")
    (tmp_path / "Aland" / "sample" / "two.csv").write_text("doc_id,text\nS,s\n")
    got = sorted((r.doc_id, r.text) for r in files.csv(spark, f"file://{tmp_path}", ["doc_id", "text"]).collect())
    assert got == [("A1", 'x "q"\ny'), ("A2", "")]


def test_union_orders_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "zz int, text string"), spark.createDataFrame([("d", "s")], "doc_id string, source_id string")
    assert files.united(a, b).columns == ["doc_id", "text", "source_id", "zz"]


def test_link_lists_and_sitemap(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "abc_links.txt").write_text("﻿http://a/1\r\nnope\nhttp://a/2\n")
    assert sorted((r.source_id, r.url) for r in files.link_lists(spark, f"file://{tmp_path}/l").collect()) == [("abc", "http://a/1"), ("abc", "http://a/2")]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.xml.gz").write_bytes(gzip.compress(b"<urlset><url><loc> http://a/1 </loc></url><url><loc><![CDATA[http://a/2]]></loc></url></urlset>"))
    (tmp_path / "m" / "b.xml").write_text("<sitemapindex><sitemap><loc>http://a/s.xml</loc></sitemap></sitemapindex>")
    assert sorted((r.is_index, r.url) for r in files.sitemap(spark, f"file://{tmp_path}/m").collect()) == [(False, "http://a/1"), (False, "http://a/2"), (True, "http://a/s.xml")]


def test_feed_api_captures(spark):
    rss = "<rss><item><title>A</title><link>http://a</link><pubDate>d</pubDate><description><![CDATA[t]]></description></item></rss>"
    atom = '<feed><entry><title>B</title><link href="http://b"/><updated>e</updated></entry></feed>'
    got = files.feed(spark.createDataFrame([(1, rss), (2, atom)], "id int, xml string")).orderBy("id").collect()
    assert [(r.title, r.url, r.date, r.text) for r in got] == [("A", "http://a", "d", "t"), ("B", "http://b", "e", "")]
    raw = '{"r": {"items": [{"t": "x", "m": {"a b": [1, "y"]}}, {"t": 2}]}}'
    got = files.api_items(spark.createDataFrame([(raw,), ("broken",)], "raw string"), "$.r.items", {"title": "$.t", "deep": "$.m['a b'][1]"}).collect()
    assert [(r.ord, r.title, r.deep) for r in got] == [(0, "x", "y"), (1, "2", None)]
    cdx = '[["timestamp", "original", "statuscode", "length"], ["20200101", "http://a", "200", "9"], ["20210101", "http://a", "404", "99"]]'
    rows = files.captures(spark.createDataFrame([(cdx,)], "raw string"))
    assert [(r.timestamp, r.digest) for r in rows.orderBy("ord").collect()] == [("20200101", None), ("20210101", None)]
    assert links.best_capture(rows.withColumn("length", F.col("length").cast("int"))).first().timestamp == "20200101"
    pairs = spark.sql("select array(struct('a' as Key, '1' as Value), struct('a' as Key, '2' as Value)) as c")
    assert files.cells(pairs, "c").first().c == {"a": "2"}


def test_replace_refuses_to_shrink(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    files.replace(spark.range(5).toDF("x"), path)
    files.replace(spark.range(6).toDF("x"), path, at_least=5)
    with pytest.raises(ValueError):
        files.replace(spark.range(2).toDF("x"), path, at_least=6)
    assert spark.read.parquet(path).count() == 6 and spark.read.parquet(f"{path}.bak").count() == 5


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"country": "A", "url": "http://a/1"}\n{"country": "A", "url": "https://www.a:80/1?utm_x=1"}\n{"country": "B", "url": "http://b"}\n')
    read = lambda: spark.readStream.schema("country string, url string").json(f"file://{tmp_path}/in")
    runs.numbered(runs.unseen(read()).drop("identity")).writeStream.format("memory").queryName("nums").option("checkpointLocation", f"file://{tmp_path}/c1").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.country, r.doc_num) for r in spark.table("nums").collect()) == [("A", 1), ("B", 1)]
    runs.run_once(read(), lambda b: b.distinct(), f"file://{tmp_path}/out", f"file://{tmp_path}/c2").awaitTermination()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 3
    (tmp_path / "ev").mkdir()
    (tmp_path / "ev" / "1.json").write_text("".join(f'{{"source_id": "s", "ord": {k}, "failed": {str(k > 2).lower()}}}\n' for k in range(6)))
    events = spark.readStream.schema("source_id string, ord long, failed boolean").json(f"file://{tmp_path}/ev")
    runs.guarded(events, 3).writeStream.format("memory").queryName("guard").outputMode("update").option("checkpointLocation", f"file://{tmp_path}/c3").trigger(availableNow=True).start().awaitTermination()
    assert [(r.run, r.tripped) for r in spark.table("guard").collect()] == [(3, True)]


def test_streaming_pacer(spark, tmp_path):
    (tmp_path / "ev").mkdir()
    write = lambda n, marks: (tmp_path / "ev" / f"{n}.json").write_text("".join(f'{{"source_id": "s", "ord": {100 * n + k}, "throttled": {str(m).lower()}}}\n' for k, m in enumerate(marks)))
    events = spark.readStream.schema("source_id string, ord long, throttled boolean").json(f"file://{tmp_path}/ev")
    seen = []
    for n, marks in enumerate([[True, True], [False] * 15, [False] * 10, [True] * 9]):
        write(n, marks)
        each = lambda batch, _: seen.extend(r.delay for r in batch.collect())
        runs.paced(events, 2.0, 6.0).writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert seen == [5.0, 5.0, 4.5, 6.0]  # the run of clean fetches goes on from batch to batch
