"""What a recipe may say, and records by recipe."""

import pytest

from tesserae.plans import recipes

GOOD = """
source_id: arg_x
country: Argentina
source_language: Spanish
start_urls: [https://x.org/a]
listing: {link_pattern: '/talks/', item_selector: li, item_date: {selectors: [time]}}
keep_if: {selectors: [nav], pattern: '(?i)speeches'}
pagination: {type: query_param, param: start, step: 40}
title: {selectors: [h2, h1]}
text: {selectors: [article]}
date: {selectors: [time], url_regex: '/(?P<year>[0-9]{4})/(?P<month>[0-9]{2})/(?P<day>[0-9]{2})/'}
speaker_default: The President
date_languages: [es]
wayback_extend: true
"""


def test_defaults():
    r = recipes.load(GOOD)
    assert r["pagination"]["step"] == 40 and r["pagination"]["wayback_delay"] == 5.0 and r["politeness"]["retries"] == 3
    assert r["wayback_extend"]["enabled"] and r["title"]["regex_required"] is False and r["dataset"] == "corpus"
    assert recipes.load(GOOD.replace("wayback_extend: true", "wayback_extend: false"))["wayback_extend"] is None


@pytest.mark.parametrize(
    "old, new, message",
    [
        ("link_pattern: '/talks/', ", "", "link_selector, link_pattern or both"), ("item_selector: li, ", "", "within an item_selector"), (", item_date: {selectors: [time]}", "", "to read in it"),
        ("{selectors: [time]}}", "{selectors: [time], url_regex: x}}", "no URL of its own"), ("{selectors: [nav], pattern: '(?i)speeches'}", "{negate: true}", "keep_if: give"), ("param: start, ", "", "param is missing"),
        ("{type: query_param, param: start, step: 40}", "{type: path, path_format: /page}", "no place for the number"), ("{type: query_param, param: start, step: 40}", "{type: path, path_format: '{m}'}", "be filled in"),
        ("{type: query_param, param: start, step: 40}", "{type: api, api: {results_path: r}}", "both needed"), ("{type: query_param, param: start, step: 40}", "{type: api, api: {results_path: r, url_field: u, method: PUT}}", "GET or POST"),
        ("{type: query_param, param: start, step: 40}", "{type: sitemap}", "sitemap_urls is missing"), ("type: query_param", "type: scroll", "is none of"), ("title: {selectors: [h2, h1]}", "title: {attr: x}", "title: no selector"),
        ("country: Argentina", "contry: Argentina", "no such setting"), ("'/talks/'", "'(talks'", "link_pattern"), ("text: {selectors: [article]}", "text: [article]", "must be a mapping"),
    ],
)
def test_faults(old, new, message):
    assert old in GOOD
    with pytest.raises(ValueError, match=message):
        recipes.load(GOOD.replace(old, new))


def test_pdf_needs_no_selectors():
    recipes.load(GOOD.replace("title: {selectors: [h2, h1]}", "content_type: pdf").replace("text: {selectors: [article]}", ""))


def test_records(spark):
    page = "<nav>Home / Speeches</nav><h1> A  title </h1><article><p>Body  one</p></article><time>25 de mayo de 2024</time>"
    rows = [(1, page, "https://x.org/2020/01/02/a"), (2, page.replace("25 de mayo de 2024", "soon").replace("Speeches", "News"), "https://x.org/2020/01/02/a"), (3, "<h1>t</h1>", "https://x.org/2020/13/02/a"), (4, None, None)]
    out = recipes.extracted(spark.createDataFrame(rows, "k int, html string, url string"), recipes.load(GOOD)).orderBy("k").collect()
    assert [(r.title, r.text, r.date, r.speaker, r.keep) for r in out] == [
        ("A title", "Body one", "2024-05-25", "The President", True), ("A title", "Body one", "2020-01-02", "The President", False), ("t", "", "", "The President", False), ("", "", "", "The President", True),
    ]


def test_files(spark, tmp_path):
    (tmp_path / "a.yml").write_text(GOOD)
    (tmp_path / "b.yml").write_text("source_id: b\nlisting: {}\n")
    (tmp_path / "c.yml").write_text("a: [")
    got = {r.file.rsplit("/", 1)[-1]: r for r in recipes.recipes(spark, str(tmp_path)).collect()}
    assert got["a.yml"].faults == [] and got["a.yml"].archived and got["a.yml"].start_urls == ["https://x.org/a"]
    assert "country is missing" in got["b.yml"].faults and got["c.yml"].faults[0].startswith("no YAML")
