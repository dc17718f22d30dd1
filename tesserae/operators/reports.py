"""Reports on sources: link status and audit, index totals, probing and run summaries, suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tesserae.functions import dates as D
from tesserae.functions import text as T
from tesserae.functions import urls as U

# A source's link status, the worst first.
STATUS = ["stale_links", "post_limit", "page1_only", "stopped_early", "capped", "unfiltered", "complete", "probe_only"]
RUN_KINDS = ["run", "run_snapshot"]
FAILURE_RATE = 0.5
# Who sets the bound of an archive's probing, and the lines that name suggestions are made of (C country, S speaker).
BOUND_BY = ["--wayback-to", "recipe wayback_extend.wayback_to", "date_floor of the scraped CSV (", "unbounded (nothing scraped yet, no wayback_to)"]
SURNAME_LINES = ['  # C: "S" looks like a surname only — map to the full name:', '  dataframe$speaker[dataframe$country == "C" & dataframe$speaker == "S"] <- "<FULL NAME>"']
NAME_LINES = ['  # C: confirm canonical form of "S" (add variants if any)']


def link_universe(listed: DataFrame) -> DataFrame:
    """By source: the links that all its lists know, and how far they can be trusted.

    ``listed``: source_id, file, kind, url, pattern, stopped_early, capped,
    page1_only.  A link counts once however it is spelled; one that the present
    pattern refuses in every spelling is dropped.  A doubt counts if a list of
    at least half the size of the largest has it.
    """
    keyed = listed.where(F.col("url").startswith("http")).withColumn("_key", U.link_key(F.col("url")))
    keyed = keyed.withColumn("_fits", F.coalesce(F.rlike("url", F.col("pattern")), F.lit(True)))
    each = keyed.groupBy("source_id", "_key").agg(F.max("_fits").alias("_fits")).groupBy("source_id").agg(F.count_if("_fits").alias("n_links"), F.count_if(~F.col("_fits")).alias("n_dropped"))
    files = keyed.groupBy("source_id", "file").agg(
        F.countDistinct("_key").alias("_n"), F.max("kind").alias("kind"), F.max("stopped_early").alias("stopped_early"), F.max("capped").alias("capped"), F.max("page1_only").alias("page1_only"),
        F.max(F.col("pattern").isNull()).alias("unfiltered"),
    )
    big = files.withColumn("_big", 2 * F.col("_n") >= F.max("_n").over(Window.partitionBy("source_id")))
    flags = big.groupBy("source_id").agg(
        F.count("*").alias("n_files"), F.max("unfiltered").alias("unfiltered"), F.max(F.col("kind").isin(*RUN_KINDS)).alias("from_run"),
        *[F.max(F.col("_big") & F.col(f)).alias(f) for f in ("stopped_early", "capped", "page1_only")],
    )
    return each.join(flags, "source_id")


def link_status(n_scraped: Column, audio: Column | None = None) -> Column:
    """The worst of a source's states, ``''`` if no list was ever seen, over the columns of ``link_universe``."""
    c = F.col
    out = F.when(c("n_files").isNull() | (c("n_files") == 0), "").when(n_scraped > c("n_links"), STATUS[0])
    if audio is not None:
        out = out.when(audio, STATUS[1])
    return out.when(c("page1_only"), STATUS[2]).when(c("stopped_early"), STATUS[3]).when(c("capped"), STATUS[4]).when(c("unfiltered"), STATUS[5]).when(c("from_run"), STATUS[6]).otherwise(STATUS[7])


def with_links(index: DataFrame, universe: DataFrame) -> DataFrame:
    """The index (source_id, n_docs) beside the links: unknown isn't zero, and a share may pass 100."""
    share = F.bround(100 * F.col("n_docs") / F.when(F.col("n_links") > 0, F.col("n_links")), 1)
    return index.join(universe, "source_id", "left").select(*index.columns, "n_links", share.alias("percent_scraped"), link_status(F.col("n_docs")).alias("links_status"))


def audit(universe: DataFrame) -> DataFrame:
    """By source what the lists hold, what the pattern keeps and what it drops; ``place`` 1 is the worst."""
    rows = universe.select("source_id", "n_files", (F.col("n_links") + F.col("n_dropped")).alias("union_raw"), F.col("n_links").alias("n_unique_links"), F.col("n_dropped").alias("dropped_by_pattern"), link_status(F.lit(None).cast("long")).alias("links_status"))
    return rows.orderBy(F.desc("dropped_by_pattern"), "source_id")


def totals(index: DataFrame) -> DataFrame:
    known, scraped = F.coalesce(F.sum("n_links"), F.lit(0)), F.coalesce(F.sum("n_docs"), F.lit(0))
    return index.agg(F.count("*").alias("n_sources"), known.alias("known_links"), scraped.alias("scraped"), F.coalesce(F.try_divide(100.0 * scraped, known), F.lit(0.0)).alias("percent"))


def date_floor(rows: DataFrame, *by: str) -> DataFrame:
    """The earliest believable date, of all rows or by key; null if there is none."""
    day = F.min(D.plausible(F.col("date"))).cast("string").alias("date_floor")
    return rows.groupBy(*by).agg(day) if by else rows.agg(day)


def archive_bound(override: Column, recipe: Column, floor: Column) -> Column:
    """struct<bound, origin>: up to which day a source's archive is probed, and who says so."""
    said = lambda v, o: F.struct(v.alias("bound"), o.alias("origin"))
    from_floor = said(F.replace(floor, F.lit("-"), F.lit("")), F.concat(F.lit(BOUND_BY[2]), floor, F.lit(")")))
    out = F.when(~T.blank(override), said(override, F.lit(BOUND_BY[0]))).when(~T.blank(recipe), said(recipe, F.lit(BOUND_BY[1]))).when(~T.blank(floor), from_floor)
    return out.otherwise(said(F.lit(None).cast("string"), F.lit(BOUND_BY[3])))


def media_marks(media: DataFrame) -> DataFrame:
    """By source, from the first row (``ord``) of its media side file: ``renderer`` and ``pagination``."""
    first = media.groupBy("source_id").agg(F.min_by(F.struct("backend", "kind"), "ord").alias("m"))
    return first.select("source_id", F.when(T.blank(F.col("m.backend")), "audio").otherwise(F.concat(F.lit("audio:"), F.col("m.backend"))).alias("renderer"), T.nz(F.col("m.kind")).alias("pagination"))


def listing_summary(links: DataFrame, meta: DataFrame, *by: str) -> DataFrame:
    """How much of a harvest (url) the listing (url, title, date) told."""
    both = links.join(meta.dropDuplicates(["url"]), "url", "left")
    date = F.when(~T.blank(F.col("date")), F.col("date"))
    return both.groupBy(*by).agg(F.count("*").alias("links"), F.count(date).alias("dated"), F.count_if(~T.blank(F.col("title"))).alias("titled"), F.min(date).alias("date_min"), F.max(date).alias("date_max"))


def keep_summary(pages: DataFrame, *by: str) -> DataFrame:
    """How a recipe judged its sampled pages (keep, error); a page that failed wasn't judged."""
    judged = F.col("error").isNull()
    kept = judged & F.coalesce("keep", F.lit(True))
    return pages.groupBy(*by).agg(F.count_if(judged).alias("sampled"), F.count_if(kept).alias("kept"), F.count_if(judged & ~kept).alias("filtered_out"))


def run_summary(outcomes: DataFrame, *by: str) -> DataFrame:
    """Counts of a run's outcomes (status: scraped, failed, filtered), the failure rate among the attempted, and whether it is high."""
    scraped, failed = F.count_if(F.col("status") == "scraped"), F.count_if(F.col("status") == "failed")
    rate = F.try_divide(failed, scraped + failed)
    return outcomes.groupBy(*by).agg(
        scraped.alias("scraped"), failed.alias("failed"), F.count_if(F.col("status") == "filtered").alias("filtered"), rate.alias("failure_rate"), F.coalesce(rate > FAILURE_RATE, F.lit(False)).alias("high_failure"),
    )


def observed(rows: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """``rows`` and a counter of them by status that is filled as they are written, without another pass."""
    seen = Observation(name)
    return rows.observe(seen, F.count("*").alias("rows"), *[F.count_if(F.col("status") == s).alias(s) for s in ("scraped", "failed", "filtered")]), seen


def people_summary(people: DataFrame) -> DataFrame:
    """How many people were approved, classified and confirmed."""
    return people.agg(*[F.count_if(F.col(c)).alias(c) for c in ("approved", "classified", "confirmed")])


def harvest_summary(entries: DataFrame, samples: int = 3, title_chars: int = 60) -> DataFrame:
    """By source a line on its media ``entries`` (source_id, ord, title, upload_date): how many, from when to when, and the first titles."""
    month = lambda d: F.when(F.length(d) >= 6, F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, 5, 2))).otherwise(d)
    day = F.when(~T.blank(F.col("upload_date")), F.col("upload_date"))
    counts = entries.groupBy("source_id").agg(F.count("*").alias("n"), F.min(day).alias("a"), F.max(day).alias("b"))
    titled = entries.where(T.nz(F.col("title")) != "").withColumn("_n", F.row_number().over(Window.partitionBy("source_id").orderBy("ord"))).where(F.col("_n") <= samples)
    shown = F.transform(F.array_sort(F.collect_list(F.struct("_n", F.substring("title", 1, title_chars).alias("t")))), lambda x: F.concat(F.lit("'"), x["t"], F.lit("'")))
    titles = titled.groupBy("source_id").agg(F.array_join(shown, "; ").alias("e"))
    line = F.concat(F.lit("Found "), F.col("n").cast("string"), F.lit(" video(s)"), T.nz(F.concat(F.lit(" | dates "), month(F.col("a")), F.lit(" .. "), month(F.col("b")))), T.nz(F.concat(F.lit(" | e.g. "), F.col("e"))))
    return counts.join(titles, "source_id", "left").select("source_id", line.alias("summary"))


def buckets(matched: DataFrame) -> DataFrame:
    """``matched`` (tenure_match) with ``bucket``: matched, wrong_country or unmatched."""
    return matched.withColumn("bucket", F.when(F.col("tenure_match") == "exact", "matched").when(F.col("tenure_match") == "other_country", "wrong_country").otherwise("unmatched"))


def name_suggestions(approved: DataFrame) -> DataFrame:
    """Lines for the key of names, by ``country, speaker, k``: a name of one word needs its full form, others a look."""
    made = lambda lines: F.array(*[F.replace(F.replace(F.lit(x.replace('"C"', '"\x01"').replace("# C:", "# \x01:").replace('"S"', '"\x02"')), F.lit("\x01"), F.col("country")), F.lit("\x02"), F.col("speaker")) for x in lines])
    return approved.select("country", "speaker", F.posexplode(F.when(F.size(T.words(F.col("speaker"))) == 1, made(SURNAME_LINES)).otherwise(made(NAME_LINES))).alias("k", "line"))
