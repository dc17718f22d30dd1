"""Office files, fetching, APIs, sinks and listings on small files."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tesserae.operators import html, media, records, reports
from tesserae.sources import api, fetch, files, office

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(path, *paragraphs):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{''.join(f'<w:p><w:r><w:t>{p}</w:t></w:r></w:p>' for p in paragraphs)}</w:body></w:document>")
    return path.read_bytes()


def test_docx(spark, tmp_path):
    data = docx(tmp_path / "a.docx", "One &amp; two", "", "three")
    assert office.docx_text(data) == "One & two\n\nthree"
    assert office.docx_text(b"no zip") == office.docx_text(None) == ""
    (tmp_path / "b.docx").write_bytes(b"PK\x03\x04broken")
    files_ = spark.read.format("binaryFile").load(str(tmp_path)).select(office.document_text("content").alias("t"), html.file_kind(F.col("content")).alias("k"))
    assert sorted((r.t, r.k) for r in files_.collect()) == [("", "zip"), ("One & two\n\nthree", "zip")]


def test_workbook_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, None), ("b <&> é", 2, "x")], "name string, n int, other string")
    office.write_workbook(spark, f"file://{tmp_path}/index.xlsx", scraped=rows, pending=rows.limit(0))
    got = office.xlsx(spark, str(tmp_path), ["name", "n", "not_there"]).orderBy("ord").collect()
    assert [(r.name, r.n, r.not_there) for r in got] == [("a", "1", None), ("b <&> é", "2", None)]
    assert office.xlsx(spark, str(tmp_path), ["name"], sheet="pending").count() == 0


def test_budgets_and_retries(spark):
    clock = iter(range(100))
    assert fetch.capped([b"ab", b"c"], 3, 9, lambda: 0.0) == b"abc"
    with pytest.raises(fetch.Refused):
        fetch.capped([b"abc", b"d"], 3, 9, lambda: 0.0)
    with pytest.raises(fetch.Refused):
        fetch.capped([b"a"] * 20, 100, 5.0, lambda: float(next(clock)))
    answers, waits = {"429": [(429, []), (503, []), (200, [b"ok"])], "404": [(404, [])], "big": [(200, [b"x" * 50])]}, []

    def get(url):
        if url == "down":
            raise ConnectionError("no route")
        return answers[url].pop(0)

    one = lambda u: fetch.attempt(get, u, (10, 5.0), 3, 0.5, waits.append)
    assert one("429") == (200, None, 3, b"ok") and waits == [0.5, 1.0]
    assert one("404") == (404, "HTTP 404", 1, None) and one("big") == (200, "over 10 bytes", 1, None)
    assert one("down") == (None, "ConnectionError: no route", 3, None)
    rows = spark.createDataFrame([("a",), ("b",)], "url string")
    got = fetch.fetched(rows, lambda u: (200, [u.encode()]) if u == "a" else (500, []), most=2, first=0.0, wait=lambda _: None).collect()
    assert sorted((r.url, r.status, r.attempts, r.body) for r in got) == [("a", 200, 1, b"a"), ("b", 500, 2, None)]


def test_robots(spark):
    rows = spark.createDataFrame([("https://www.a.org/x/1",), ("https://a.org/private/2",), ("https://b.org/private",), (None,)], "url string")
    robots = spark.createDataFrame([("a.org", "User-agent: *\nDisallow: /private"), ("c.org", "")], "host string, text string")
    assert {r.url: r.allowed for r in fetch.allowed(rows, robots, "bot").collect()} == {"https://www.a.org/x/1": True, "https://a.org/private/2": False, "https://b.org/private": True, None: True}


PAGES = {0: [{"id": 1}, {"id": 2}], 10: [{"id": 2}, {"id": 3}], 20: [{"id": 3}]}


def answer(url, body):
    return json.dumps({"r": {"items": PAGES.get(json.loads(body)["page"]["from"], [])}})


def test_api(spark):
    api.register(spark)
    rows = spark.read.format("api").options(fetcher="tests.test_more_sources:answer", url="https://x/s", body='{"q": 1}', body_path="page.from", first="0", step="10", items="r.items").load()
    assert [r.page for r in rows.orderBy("page").collect()] == [0, 1]  # the third brings nothing new
    assert files.api_items(rows, "$.r.items", {"id": "$.id"}).count() == 4
    deep = {"a": [{"b c": {"0": "zero"}}]}
    assert api.path_get(deep, 'a[0]["b c"].0') == "zero" and api.path_get(deep, "a[-1]") == deep["a"][0] and api.path_get(deep, "a[1]") is None and api.path_get(deep, "a.0") is None
    api.path_set(deep, "x.y", 3)
    assert deep["x"] == {"y": 3}
    with pytest.raises(ValueError):
        api.steps("a[")


def test_csv_under_two_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('doc_id,text,old\nA1,"two\nlines, ""x""",o\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("﻿doc_id,text\nA2,NA\n", encoding="utf-8")
    (tmp_path / "b_errors.csv").write_text("doc_id,text\nA3,x\n", encoding="utf-8")
    rows = files.csv_any_header(spark, str(tmp_path), ["doc_id", "text", "new"])
    assert sorted((r.doc_id, r.text, r.new) for r in rows.collect()) == [("A1", 'two\nlines, "x"', ""), ("A2", "NA", "")]
    assert {r.doc_id: r.text for r in files.na_parsed(rows, "text").collect()}["A2"] is None


def test_sinks(spark, tmp_path):
    at = f"file://{tmp_path}"
    rows = spark.range(3).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("source_id"), F.col("id").alias("ord"), F.lit("u").alias("url"))
    files.write_links(rows, f"{at}/links", "2024-01-01")
    files.write_links(rows.where("ord = 1"), f"{at}/links", "2024-02-01", "probe")
    assert sorted((r.source_id, r.kind) for r in files.current_links(spark, f"{at}/links").collect()) == [("s0", "run"), ("s1", "probe"), ("s2", "run")]
    rows.write.parquet(f"{at}/key")
    with pytest.raises(ValueError):
        files.backed_up(rows.limit(1), f"{at}/key", "20240101", 3)
    files.backed_up(rows.unionByName(rows), f"{at}/key", "20240102", 3)
    assert spark.read.parquet(f"{at}/key").count() == 6 and spark.read.parquet(f"{at}/key.20240102.bak").count() == 3
    files.write_report(rows, f"{at}/report", F.desc("ord"))
    [part] = list((tmp_path / "report").glob("*.csv"))
    assert part.read_text().splitlines() == ["source_id,ord,url", "s2,2,u", "s1,1,u", "s0,0,u"]
    done = spark.createDataFrame([("scraped",), ("failed",), ("failed",)], "status string")
    counted, seen = reports.observed(done)
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 3 and seen.get["failed"] == 2 and seen.get["filtered"] == 0


def test_sources_by_id(spark, tmp_path):
    rows = spark.createDataFrame([("a", "X"), ("b", "X"), ("b", "Y")], "source_id string, country string")
    assert files.located(rows, "a").count() == 1
    for bad in ("b", "c"):
        with pytest.raises(LookupError):
            files.located(rows, bad)
    cleaned = spark.createDataFrame([("accepted", False), ("rejected_foreign", True), ("error", None)], "clean_status string, speaker_review boolean")
    cleaned.write.parquet(f"file://{tmp_path}/cleaned")
    assert files.preferred(spark, [f"file://{tmp_path}/none"], f"file://{tmp_path}/cleaned").count() == 2
    spark.range(5).write.parquet(f"file://{tmp_path}/dataset")
    assert files.preferred(spark, [f"file://{tmp_path}/none", f"file://{tmp_path}/dataset"], f"file://{tmp_path}/cleaned").count() == 5


def test_sitemap_indexes(spark):
    rows = [("d/root.xml", True, 0, "https://x/sub.xml.gz"), ("d/root.xml", True, 1, "https://x/missing.xml"), ("d/sub.xml.gz", False, 0, "https://x/p1"), ("d/other.xml", False, 0, "https://x/p2")]
    entries = spark.createDataFrame(rows, "path string, is_index boolean, ord int, url string")
    assert [r.url for r in files.sitemap_pages(entries, "https://x/root.xml").collect()] == ["https://x/p1"]


def test_charsets(spark):
    rows = [("é".encode("cp1250"), None, None), ("<meta charset=windows-1250>ž".encode("cp1250"), None, None), ("ž".encode("cp1250"), None, "text/html; charset=windows-1250"), ("ž".encode("utf-8"), "utf-8", "text/html; charset=latin-1"), (None, None, None)]
    data = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, b binary, o string, h string")
    got = [r.t for r in data.select("k", html.decoded(F.col("b"), F.col("o"), F.col("h")).alias("t")).orderBy("k").collect()]
    assert got == ["�", "<meta charset=windows-1250>ž", "ž", "ž", None]


def test_listing_blocks():
    page = html.parse('<base href="/r/"><ul><li class=i><h3>T <b>one</b></h3><time>Oct. 6, 2023</time><div><a href=a>x</a></div></li><li class=i><a href=/b>y</a></li></ul><a href=a>again</a><a href="http://[bad">z</a>')
    assert html.listing(page, "https://s.org/p/", "li.i", ["h2", "h3"], ["time"]) == [("https://s.org/r/a", "T one", "Oct. 6, 2023"), ("https://s.org/b", "", "")]


def test_media(spark):
    kinds = {"https://y.com/playlist?list=1": "playlist", "https://y.com/@who": "channel", "https://y.com/who/videos/": "channel", "https://y.com/watch?v=1": "url_list", None: "url_list"}
    rows = spark.createDataFrame([(k,) for k in kinds], "u string")
    assert {r.u: r.k for r in rows.select("u", media.kind(F.col("u")).alias("k")).collect()} == kinds


def test_audit_columns_do_not_clash(spark):
    rows = spark.createDataFrame([("A1", "S", "2020-01-01", "kept")], "doc_id string, speaker string, date string, gate_reason string")
    got = records.audited(rows).first()
    assert (got.speaker_scraped, got.date_scraped, got.gate_reason, got.text, got.clean_status) == ("S", "2020-01-01", "kept", "", None)


def test_provenance(spark):
    got = spark.range(1).select(records.provenance([("a", F.lit(" ")), ("b", F.lit("v")), ("c", F.lit("w"))]).alias("p"), records.provenance([("a", F.lit(None).cast("string"))]).alias("q")).first()
    assert tuple(got.p) == ("v", "b") and got.q is None


def test_sidecars(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n  "capped": true,\n  "pages": 3\n}')
    (tmp_path / "b.json").write_text('{\n broken')
    got = {r.file.rsplit("/", 1)[-1]: r.meta for r in files.sidecars(spark, str(tmp_path), "capped boolean, pages int").collect()}
    assert len(got) == 2 and (got["a.json"].capped, got["a.json"].pages) == (True, 3) and got["b.json"].capped is None
