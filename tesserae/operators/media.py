"""Entries of video playlists and channels: which are wanted, and under which names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions.text import blank, nz

WATCH = "https://www.youtube.com/watch?v="


def kind(url: Column) -> Column:
    """What a media source's first address leads to: playlist, channel, or nothing but itself."""
    u = F.lower(nz(url))
    return F.when(u.rlike("list=|/playlist"), "playlist").when(u.rlike("/channel/|/@|/c/|/user/|/videos/*$"), "channel").otherwise("url_list")


def wanted(entries: DataFrame, date_min: str | None = None, date_max: str | None = None, min_duration: float | None = None, max_duration: float | None = None, title: str | None = None, limit: int | None = None) -> DataFrame:
    """The entries within the bounds, before anything is fetched; each id once and in order if there is a limit."""
    rows = entries
    for bound, keep in ((date_min, lambda b: F.col("upload_date") >= b), (date_max, lambda b: F.col("upload_date") <= b), (min_duration, lambda b: F.col("duration") >= b), (max_duration, lambda b: F.col("duration") <= b), (title, lambda b: F.col("title").rlike(b))):
        if bound is not None:
            rows = rows.where(keep(bound))
    return rows.orderBy("ord").limit(limit) if limit is not None else rows


def normalised(entries: DataFrame) -> DataFrame:
    """``entries`` with ``url`` (the page's, else from the id), ``tags`` in one string and the uploader for a missing channel."""
    url = F.when(~blank(F.col("webpage_url")), F.col("webpage_url")).when(~blank(F.col("id")), F.concat(F.lit(WATCH), F.col("id"))).otherwise("")
    tags = F.array_join(F.filter("tags", lambda t: nz(t) != ""), ", ")
    channel = F.when(~blank(F.col("channel")), F.col("channel")).otherwise(nz(F.col("uploader")))
    return entries.withColumns({"url": url, "tags": tags, "channel": channel})
