"""Fetching through a function that the caller injects: budgets, retries, pacing and robots rules, as values in rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions import text as T
from tesserae.functions import urls as U
from tesserae.operators.html import signed

# Bytes and seconds that a capture may take, for pages and for documents.
PAGE_BUDGET, DOCUMENT_BUDGET = (10 << 20, 120.0), (50 << 20, 300.0)
OUTCOME = "status int, reason string, attempts int, body binary"

#: A fetcher gives a status and the body in pieces; it raises where there is no answer.
Fetcher = Callable[[str], tuple[int, Iterable[bytes]]]


class Refused(Exception):
    """A body over its budget, which no retry makes smaller."""


def capped(chunks: Iterable[bytes], max_bytes: int, max_seconds: float, clock: Callable[[], float] = time.monotonic) -> bytes:
    """The whole body, or ``Refused`` at the first piece beyond the budget of bytes or of seconds."""
    out, began = bytearray(), clock()
    for piece in chunks:
        out += piece
        if len(out) > max_bytes:
            raise Refused(f"over {max_bytes} bytes")
        if clock() - began > max_seconds:
            raise Refused(f"over {max_seconds:g} seconds")
    return bytes(out)


def attempt(fetch: Fetcher, url: str, budget: tuple[int, float], most: int, first: float, wait: Callable[[float], None]) -> tuple[int | None, str | None, int, bytes | None]:
    """(status, reason, attempts, body): transport errors, 429 and 5xx are tried again, all else is final."""
    for n in range(1, most + 1):
        status, reason = None, None
        try:
            status, chunks = fetch(url)
            if 200 <= status < 300:
                return status, None, n, capped(chunks, *budget)
            reason = f"HTTP {status}"
            if status != 429 and status < 500:
                return status, reason, n, None
        except Refused as e:
            return status, str(e), n, None
        except Exception as e:  # noqa: BLE001  a failed fetch is a value here
            reason = f"{type(e).__name__}: {e}"
        if n < most:
            wait(min(60.0, first * 2.0 ** (n - 1)))
    return status, reason, most, None


def fetched(rows: DataFrame, fetch: Fetcher, budget: tuple[int, float] = PAGE_BUDGET, most: int = 5, first: float = 0.5, delay: float = 0.0, url: str = "url", wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """``rows`` with the outcome of each URL: status, reason of a failure, attempts, body.

    A task fetches one after the other, ``delay`` seconds apart, so the number
    of partitions sets the load; repartition by host to be fair to each.
    """

    @F.pandas_udf(OUTCOME)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = []
            for u in batch:
                if delay:
                    wait(delay)
                got.append(attempt(fetch, u, budget, most, first, wait))
            out = pd.DataFrame(got, columns=["status", "reason", "attempts", "body"])
            yield out.astype({"status": "Int32"})

    return rows.withColumn("_o", run(url)).select(*rows.columns, "_o.*")


def page_fate(status: Column, n_links_before: Column) -> Column:
    """What a listing page's status means for its pager: a missing page after links is its normal end."""
    gone = status.isin(404, 410)
    return F.when(status.between(200, 299), "page").when(gone & (n_links_before > 0), "end").otherwise("error")


def denied(rows: DataFrame, html: str = "html") -> DataFrame:
    """``rows`` with ``reason`` ``blocked`` where the page denies access, as a failed fetch has."""
    return rows.withColumn("reason", F.when(signed(F.col(html)), "blocked").otherwise(F.col("reason")))


def allowed(rows: DataFrame, robots: DataFrame, agent: str, url: str = "url") -> DataFrame:
    """``rows`` with ``allowed``, by the robots file of each one's host (``robots``: host, text); without one everything is."""

    @F.pandas_udf("boolean")
    def judge(urls: pd.Series, texts: pd.Series) -> pd.Series:
        known: dict[str, RobotFileParser] = {}
        out = []
        for u, t in zip(urls, texts, strict=True):
            if not t:
                out.append(True)
                continue
            if t not in known:
                known[t] = RobotFileParser()
                known[t].parse(t.splitlines())
            out.append(known[t].can_fetch(agent, urlsplit(u or "").path or "/"))
        return pd.Series(out, dtype=bool)

    rules = robots.groupBy(F.lower("host").alias("_host")).agg(F.max("text").alias("_rules"))
    both = rows.withColumn("_host", U.host(F.col(url))).join(rules, "_host", "left")
    return both.select(*rows.columns, judge(url, T.nz(F.col("_rules"))).alias("allowed"))
