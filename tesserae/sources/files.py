"""Tables in files: CSV of strings, Parquet, link lists, sidecars, feeds, sitemaps, API pages, captures; and the sinks."""

from __future__ import annotations

import gzip
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tesserae.functions import text as T

#: A scraped row; all are strings, and ``''`` is missing.
SCRAPED = [
    "doc_id", "country", "ISO3N", "speaker", "position", "context", "context_originlanguage", "title", "title_originlanguage", "text", "text_originlanguage",
    "date", "source", "source_language", "dataset", "wayback_capture", "date_regex_recovered",
]
SIDE_FILES = r"(_errors|_media)\.csv$|/sample/"
# Cells that mean missing where a table is read with NA parsing.
NA_CELLS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def csv(spark: SparkSession, path: str, columns: Sequence[str] = SCRAPED, suffix: str = "*.csv") -> DataFrame:
    """A tree of CSV files, strings only, with ``source_file`` and without side files."""
    rows = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("pathGlobFilter", suffix).option("recursiveFileLookup", True)
        .option("enforceSchema", False).schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    )
    rows = rows.withColumn("source_file", F.col("_metadata.file_path")).where(~F.col("source_file").rlike(SIDE_FILES))
    return rows.select(*[T.nz(F.col(c)).alias(c) for c in columns], "source_file")


def na_parsed(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with null for every cell that means missing; all columns unless some are named."""
    return rows.withColumns({c: F.when(~F.col(c).isin(*NA_CELLS), F.col(c)) for c in columns or rows.columns})


def csv_any_header(spark: SparkSession, path: str, columns: Sequence[str] = SCRAPED, suffix: str = "*.csv") -> DataFrame:
    """A tree of CSV files written under older headers too: cells go by their own file's header, and what it lacks is ``''``.

    Files are grouped by header (each file's first line, one row a file), so there is a scan for each header, not for each file.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", suffix).text(path)
    heads = lines.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("at"), "value").where("at = 0").groupBy("f").agg(F.first("value").alias("head"))
    heads = heads.where(~F.col("f").rlike(SIDE_FILES)).groupBy("head").agg(F.collect_list("f").alias("files")).collect()
    frames = []
    for r in heads:
        own = [c.strip().strip('"').removeprefix("\ufeff") for c in r["head"].split(",")]
        rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", True).schema(", ".join(f"`{c}` string" for c in own)).csv(r["files"])
        rows = rows.withColumn("source_file", F.col("_metadata.file_path"))
        frames.append(rows.select(*[(T.nz(F.col(c)) if c in own else F.lit("")).alias(c) for c in columns], "source_file"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def located(sources: DataFrame, source_id: str) -> DataFrame:
    """The files of one source; none and more than one country for it are errors."""
    mine = sources.where(F.col("source_id") == source_id)
    places = [r["country"] for r in mine.select("country").distinct().limit(2).collect()]
    if not places:
        raise LookupError(f"no source {source_id}")
    if len(places) > 1:
        raise LookupError(f"{source_id} is ambiguous: {', '.join(sorted(map(str, places)))}")
    return mine


def preferred(spark: SparkSession, candidates: Sequence[str], tree: str) -> DataFrame:
    """The first of the ``candidates`` (Parquet) that is there, else the cleaned ``tree``: accepted rows and those under review."""
    jvm = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    path = next((c for c in candidates if jvm.Path(c).getFileSystem(conf).exists(jvm.Path(c))), None)
    rows = spark.read.parquet(path) if path else spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(tree)
    if "clean_status" not in rows.columns:
        return rows
    review = F.coalesce(F.col("speaker_review"), F.lit(False)) if "speaker_review" in rows.columns else F.lit(False)
    return rows.where((F.col("clean_status") == "accepted") | review)


def parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Tables of any age: columns that some lack are null there."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def united(*frames: DataFrame, first: Sequence[str] = SCRAPED) -> DataFrame:
    """All rows under all columns: the schema's in its order, then the others by name, ``source_id`` ahead of them."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    rest = sorted((c for c in out.columns if c not in first), key=lambda c: (c != "source_id", c))
    return out.select(*[c for c in first if c in out.columns], *rest)


def link_lists(spark: SparkSession, path: str) -> DataFrame:
    """Links of text files: source_id (the file's name up to ``_links``), file, url."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_links*.txt").text(path).withColumn("file", F.col("_metadata.file_path"))
    url = F.regexp_replace(T.strip(F.col("value")), "^﻿", "")
    return lines.select(F.regexp_extract("file", r"([^/]+?)_links[^/]*$", 1).alias("source_id"), "file", url.alias("url")).where(F.col("url").startswith("http"))


def sidecars(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON side files; one that can't be read is a row of nulls."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("meta"))


def gunzipped(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def sitemap(spark: SparkSession, path: str, max_files: int = 200) -> DataFrame:
    """Locations in sitemaps, gzipped or not, with the file and whether it is an index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [gunzipped(x.as_py()).decode("utf-8", "replace") for x in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(texts)], ["path", "xml"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").orderBy("path").limit(max_files)
    xml = files.mapInArrow(run, "path string, xml string")
    found = F.regexp_extract_all("xml", F.lit(r"(?s)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>"), 1)
    return xml.select("path", F.col("xml").contains("<sitemapindex").alias("is_index"), F.posexplode(found).alias("ord", "url"))


def unescaped(c: Column) -> Column:
    """XML's entities undone: numbers by their code, then the five names, the ampersand last."""
    pieces = F.split(c, r"(?=&#x?[0-9A-Fa-f]{1,6};)|(?<=;)", -1)

    def one(x: Column) -> Column:
        code = F.when(x.rlike("^&#x[0-9A-Fa-f]{1,6};$"), F.conv(F.regexp_extract(x, "([0-9A-Fa-f]+);", 1), 16, 10).try_cast("int")).when(x.rlike("^&#[0-9]{1,6};$"), F.regexp_extract(x, "([0-9]+)", 1).try_cast("int"))
        wide = F.lpad(F.hex(code), 8, "0")
        return F.when(code.isNotNull(), F.decode(F.unhex(wide), "utf-32")).otherwise(x)

    numbers = F.when(c.contains("&#"), F.array_join(F.transform(pieces, one), "")).otherwise(c)
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        numbers = F.replace(numbers, F.lit(name), F.lit(sign))
    return numbers


def feed(rows: DataFrame, xml: str = "xml") -> DataFrame:
    """Entries of RSS and Atom documents: ord, title, url, date, text."""
    item = F.posexplode(F.regexp_extract_all(xml, F.lit(r"(?s)<(?:item|entry)[\s>].*?</(?:item|entry)>"), 0)).alias("ord", "_item")
    plain = lambda c: F.when(c.contains("<![CDATA["), F.regexp_replace(c, r"<!\[CDATA\[|\]\]>", "")).otherwise(unescaped(c))
    field = lambda names: T.strip(plain(F.regexp_extract("_item", rf"(?s)<(?:{names})(?:\s[^>]*)?>(.*?)</(?:{names})>", 1)))
    link = T.first_filled(field("link"), F.regexp_extract("_item", r"""<link[^>]*href=["']([^"']+)""", 1))
    other = [c for c in rows.columns if c != xml]
    return rows.select(*other, item).select(*other, "ord", field("title").alias("title"), unescaped(link).alias("url"), field("pubDate|published|updated|dc:date").alias("date"), field("content:encoded|content|description|summary").alias("text"))


def api_items(rows: DataFrame, items: str, fields: dict[str, str], raw: str = "raw") -> DataFrame:
    """Items of JSON answers: ``items`` is the path of the list (``$`` for a root list), ``fields`` paths within an item."""
    other = [c for c in rows.columns if c != raw]
    listed = rows.select(*other, F.try_variant_get(F.try_parse_json(F.col(raw)), items, "array<variant>").alias("_l"))
    found = listed.select(*other, F.posexplode("_l").alias("ord", "_i"))
    return found.select(*other, "ord", *[F.try_variant_get(F.col("_i"), p, "string").alias(n) for n, p in fields.items()])


def cells(rows: DataFrame, column: str, key: str = "Key", value: str = "Value") -> DataFrame:
    """An array of key-value structs as a map; of equal keys the last counts, and cells without a key don't."""
    numbered = F.transform(F.col(column), lambda x, i: F.struct(x[key].alias("k"), (-i).alias("i"), x[value].alias("v")))
    ranked = F.array_sort(F.filter(numbered, lambda x: x["k"].isNotNull()))  # equal keys side by side, the last first

    def firsts(all_: Column) -> Column:
        return F.filter(all_, lambda x, i: (i == 0) | (F.get(all_, i - 1)["k"] != x["k"]))

    last = F.get(F.transform(F.array(ranked), firsts), F.lit(0))
    return rows.withColumn(column, F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"]))))


def captures(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """An archive's listing, a header row and value rows in one JSON list, as columns of strings with ``ord``."""
    names = ["urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "length"]
    grid = F.from_json(raw, "array<array<string>>")
    lines = rows.select(grid.alias("g")).select(F.col("g")[0].alias("head"), F.posexplode(F.slice("g", 2, 1_000_000_000)).alias("ord", "row"))
    at = lambda n: F.get("row", (F.array_position("head", F.lit(n)) - 1).cast("int"))
    return lines.select("ord", *[F.when(F.array_contains("head", n), at(n)).alias(n) for n in names])


def archived(captures: DataFrame, prefix: str | None = None, match: str = "prefix", since: str | None = None, until: str | None = None, filters: Sequence[str] = (), collapse: str | None = None, limit: int | None = None) -> DataFrame:
    """``captures`` as an archive's index answers a query; all but the collapse are filters that reach the scan.

    ``match``: prefix, exact, host or domain.  ``filters``: ``field:regex``, with
    ``!`` in front for its contrary; a regex must match the whole field.
    ``collapse``: a field, or ``field:n`` for its first n characters; of
    captures of one key that follow each other with equal values the first
    stays.
    """
    rows = captures
    bare = F.regexp_replace(F.lower("original"), r"^https?://(www\.)?", "")
    if prefix is not None:
        want = prefix.lower().removeprefix("https://").removeprefix("http://").removeprefix("www.").rstrip("*")
        host = F.regexp_extract(bare, r"^([^/:?#]*)", 1)
        name = want.split("/")[0]
        rows = rows.where({"prefix": bare.startswith(want), "exact": F.regexp_replace(bare, "/$", "") == want.rstrip("/"), "host": host == name, "domain": (host == name) | host.endswith(f".{name}")}[match])
    if since is not None:
        rows = rows.where(F.col("timestamp") >= since)
    if until is not None:
        rows = rows.where(F.substring("timestamp", 1, len(until)) <= until)
    for f in filters:
        field, _, pattern = f.removeprefix("!").partition(":")
        hit = T.nz(F.col(field)).rlike(f"^(?:{pattern})$")
        rows = rows.where(~hit if f.startswith("!") else hit)
    if collapse:
        field, _, n = collapse.partition(":")
        value = F.substring(field, 1, int(n)) if n else F.col(field)
        before = F.lag(T.nz(value)).over(Window.partitionBy("urlkey").orderBy("timestamp", "ord"))
        rows = rows.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != T.nz(value))).drop("_before")
    return rows.orderBy("ord").limit(limit) if limit is not None else rows


def first_capture_of_queries(listings: DataFrame, limit: int | None = None) -> DataFrame:
    """Of several queries' captures (query, ord) the first of each original, in their order; the limit comes after."""
    first = listings.withColumn("_n", F.row_number().over(Window.partitionBy("original").orderBy("query", "ord"))).where("_n = 1").drop("_n")
    return first.orderBy("query", "ord").limit(limit) if limit is not None else first


def sitemap_pages(entries: DataFrame, root: str, depth: int = 5, max_files: int = 200) -> DataFrame:
    """Pages below the sitemap file ``root``: an index leads to further files of ``entries`` (path, is_index, ord, url), by their addresses' last parts.

    Files are walked level by level, each once, ``max_files`` at most.
    """
    name = lambda c: F.regexp_extract(c, r"([^/]+?)(?:\?.*)?$", 1)
    rows = entries.withColumn("_name", name(F.col("path")))
    todo, done = [root.rsplit("/", 1)[-1]], set()
    for _ in range(depth + 1):
        todo = [t for t in todo if t not in done][: max(0, max_files - len(done))]
        done |= set(todo)
        if not todo:
            break
        todo = sorted(r["n"] for r in rows.where(F.col("_name").isin(todo) & F.col("is_index")).select(name(F.col("url")).alias("n")).distinct().limit(max_files).collect())
    return rows.where(F.col("_name").isin(sorted(done)) & ~F.col("is_index")).select("path", "ord", "url")


def stale_index(index: DataFrame, files: DataFrame) -> DataFrame:
    """Sources that the index lists and no file has (``missing``), and the other way round (``unlisted``)."""
    a, b = index.select("source_id").distinct(), files.select("source_id").distinct()
    return a.join(b, "source_id", "left_anti").withColumn("state", F.lit("missing")).unionByName(b.join(a, "source_id", "left_anti").withColumn("state", F.lit("unlisted")))


def append(rows: DataFrame, path: str, *by: str) -> None:
    rows.write.mode("append").partitionBy(*by).parquet(path)


def replace(rows: DataFrame, path: str, at_least: int | None = None) -> None:
    """Swap a table for a new one; the old stays as ``.bak``, and a table that would shrink is refused."""
    spark = rows.sparkSession
    new = f"{path}.new"
    rows.write.mode("overwrite").parquet(new)
    if at_least is not None and (n := spark.read.parquet(new).count()) < at_least:
        raise ValueError(f"{n} rows would replace {at_least}")
    jvm = spark._jvm.org.apache.hadoop.fs
    old, kept, fresh = jvm.Path(path), jvm.Path(f"{path}.bak"), jvm.Path(new)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(old):
        files.delete(kept, True)
        files.rename(old, kept)
    files.rename(fresh, old)


def backed_up(rows: DataFrame, path: str, stamp: str, at_least: int) -> None:
    """As ``replace``, with a copy of the old table beside it under the time ``stamp``."""
    spark = rows.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    if jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm.Path(path)):
        spark.read.parquet(path).write.mode("overwrite").parquet(f"{path}.{stamp}.bak")
    replace(rows, path, at_least)


def write_links(links: DataFrame, path: str, run: str, kind: str = "run") -> None:
    """A harvest's links (source_id, ord, url, title, date) as a snapshot of that ``run``; the newest is the current list."""
    links.withColumns({"run": F.lit(run), "kind": F.lit(kind)}).write.mode("append").partitionBy("source_id", "run").parquet(path)


def current_links(spark: SparkSession, path: str) -> DataFrame:
    """The newest list of each source."""
    rows = spark.read.parquet(path)
    newest = rows.groupBy("source_id").agg(F.max("run").alias("run"))
    return rows.join(F.broadcast(newest), ["source_id", "run"])


def write_report(rows: DataFrame, path: str, *order: str | Column) -> None:
    """A report as one CSV file, in order."""
    rows.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", "gzip").csv(path)


def public_list(rows: DataFrame, columns: Sequence[str], limit: int = 120) -> DataFrame:
    """The columns that may be shown, long cells cut to their first sentence."""
    return rows.select(*[T.clipped_cell(F.col(c), limit).alias(c) for c in columns if c in rows.columns])
