"""``spark.read.format("harvest")``: links of paged listings, through a fetcher that the caller names.

The fetcher is ``module:function``, called with a URL and giving a page's
text, or None where the site has no such page.  Each start page is a
partition, as its pager must go in order; pages end when one is missing,
empty or brings nothing new, or at the cap.
"""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tesserae.operators.html import first_match, links, parse, select

PAGE_CAP = 5000


def with_number(url: str, name: str, n: int) -> str:
    if re.search(rf"[?&]{re.escape(name)}=", url):
        return re.sub(rf"([?&]{re.escape(name)}=)[^&#]*", rf"\g<1>{n}", url)
    return f"{url}{'&' if '?' in url else '?'}{name}={n}"


def pages(start: str, options: dict) -> Iterator[str]:
    """The addresses that a pager asks for: by query parameter, by path, or the start alone."""
    kind, first, step = options.get("pagination", "none"), int(options.get("first", 1)), int(options.get("step", 1))
    if kind in ("none", "url_list", "next_link"):
        yield start
        return
    for i in range(int(options.get("cap", PAGE_CAP))):
        n = first + i * step
        if kind == "query_param":
            yield with_number(start, options.get("param", "page"), n)
        else:
            yield start if i == 0 and options.get("bare_first", "true") == "true" else start.rstrip("/") + options.get("path_format", "/page/{n}").format(n=n)


def harvested(start: str, options: dict, fetch: Callable[[str], str | None]) -> Iterator[tuple[str, int, int, str, str]]:
    """(start, page, ord, url, title) of each new link."""
    if options.get("pagination") == "url_list":
        yield start, 0, 0, start, ""
        return
    pattern = re.compile(options["pattern"]) if "pattern" in options else None
    selector, follow = options.get("selector", "a"), options.get("next_selector")
    seen, asked, n = set(), set(), 0
    todo = pages(start, options)
    page = 0
    while (address := next(todo, None)) is not None and address not in asked:
        asked.add(address)
        text = fetch(address)
        if text is None:
            return
        root = parse(text)
        titles = {}
        for a in select(root, selector):
            if a.attrs.get("href"):
                titles.setdefault(a.attrs["href"], a.text())
        new = 0
        for url in links(root, address, selector):
            if url in seen or pattern and not pattern.search(url):
                continue
            seen.add(url)
            new += 1
            yield start, page, n, url, next((t for h, t in titles.items() if urlsplit(h).path and url.endswith(urlsplit(h).path)), "")
            n += 1
        page += 1
        if follow and (href := first_match(root, [follow], "href")):
            todo = iter([links(parse(f'<a href="{href}">x</a>'), address)[0]])
        elif not new:
            return


class Start(InputPartition):
    def __init__(self, url: str):
        self.url = url


class HarvestReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Start]:
        return [Start(u) for u in self.options["starts"].split()]

    def read(self, partition: Start) -> Iterator[tuple]:
        module, _, name = self.options["fetcher"].partition(":")
        yield from harvested(partition.url, self.options, getattr(importlib.import_module(module), name))


class Harvest(DataSource):
    @classmethod
    def name(cls) -> str:
        return "harvest"

    def schema(self) -> str:
        return "start string, page int, ord int, url string, title string"

    def reader(self, schema) -> HarvestReader:
        return HarvestReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Harvest)
