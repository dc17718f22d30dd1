"""Search APIs: paths into JSON, request bodies page by page, and ``format("api")``, a reader of their answers."""

from __future__ import annotations

import copy
import importlib
import json
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tesserae.sources.harvest import with_number

STEP = re.compile(r"""\.?(?:([^.\[\]]+)|\[(-?\d+)\]|\[(?:"([^"]*)"|'([^']*)')\])""")


def steps(path: str) -> list[str | int]:
    """``a.b[0]["c d"]`` in steps; a bare number is a key, and only one in brackets an index."""
    out, at = [], 0
    path = path.removeprefix("$").lstrip(".")
    while at < len(path):
        m = STEP.match(path, at)
        if not m:
            raise ValueError(f"no path: {path!r}")
        out.append(int(m[2]) if m[2] is not None else next(x for x in (m[1], m[3], m[4]) if x is not None))
        at = m.end()
    return out


def path_get(value, path: str):
    """What lies at the path, None if nothing does."""
    for step in steps(path):
        if isinstance(step, int):
            if not isinstance(value, list) or not -len(value) <= step < len(value):
                return None
            value = value[step]
        else:
            if not isinstance(value, dict) or step not in value:
                return None
            value = value[step]
    return value


def path_set(value, path: str, new) -> None:
    """Put ``new`` at the path; objects on the way are made, places in lists must be there."""
    *way, last = steps(path)
    for step in way:
        value = value[step] if isinstance(step, int) else value.setdefault(step, {})
    value[last] = new


def requests(options: dict) -> Iterator[tuple[str, str | None]]:
    """(URL, body) of page after page: by a parameter of the URL, or at a path of the body."""
    url, first, step, cap = options["url"], int(options.get("first", 1)), int(options.get("step", 1)), int(options.get("cap", 5000))
    body = json.loads(options["body"]) if options.get("body") else None
    where, name = options.get("body_path"), options.get("param")
    for k in range(cap if where or name else 1):
        n = first + k * step
        if where:
            now = copy.deepcopy(body if body is not None else {})
            path_set(now, where, n)
            yield url, json.dumps(now)
        else:
            yield with_number(url, name, n) if name else url, None if body is None else json.dumps(body)


class Answers(DataSourceReader):
    """Pages end when one is missing, isn't JSON, or brings no item that is new."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, _, name = self.options["fetcher"].partition(":")
        fetch, seen = getattr(importlib.import_module(module), name), set()
        for page, (url, body) in enumerate(requests(self.options)):
            raw = fetch(url, body)
            try:
                items = path_get(json.loads(raw), self.options.get("items", "$")) if raw is not None else None
            except ValueError:
                items = None
            fresh = {json.dumps(x, sort_keys=True) for x in items or []} - seen
            if not fresh:
                return
            seen |= fresh
            yield page, url, raw


class Api(DataSource):
    """Options: fetcher (``module:function`` of a URL and a body), url, items, param or body_path, body, first, step, cap."""

    @classmethod
    def name(cls) -> str:
        return "api"

    def schema(self) -> str:
        return "page int, url string, raw string"

    def reader(self, schema) -> Answers:
        return Answers(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Api)
