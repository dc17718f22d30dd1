"""Links, ledgers and indexes of sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tesserae.functions import dates as D
from tesserae.functions import text as T
from tesserae.functions import urls as U
from tesserae.operators.ranks import placed


def first_of(rows: DataFrame, *key: str) -> DataFrame:
    """The first row (``ord``) of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy("ord"))).where("_n = 1").drop("_n")


def unscraped(candidates: DataFrame, ledger: DataFrame, noise: Sequence[str] = ()) -> DataFrame:
    """``candidates`` (ord, url) with ``fate``: exact, already, within or kept.

    ``exact`` is a URL of the ledger, ``already`` another form of one, ``within``
    another form of an earlier candidate.  All but ``kept`` is work to skip.
    """
    done = ledger.select("url").distinct()
    ids = done.select(U.page_identity(F.col("url"), noise).alias("identity")).distinct()
    rows = candidates.where(~T.blank(F.col("url"))).withColumn("identity", U.page_identity(F.col("url"), noise))
    rows = rows.join(done.withColumn("_exact", F.lit(True)), "url", "left").join(ids.withColumn("_known", F.lit(True)), "identity", "left")
    fresh = F.col("_exact").isNull() & F.col("_known").isNull()
    nth = F.row_number().over(Window.partitionBy("identity", fresh).orderBy("ord"))
    fate = F.when(F.col("_exact"), "exact").when(F.col("_known"), "already").when(fresh & (nth > 1), "within").otherwise("kept")
    return rows.select(*candidates.columns, "identity", fate.alias("fate"))


def resume(rows: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")


def selected(rows: DataFrame, ids: Sequence[str], key: str = "doc_id") -> DataFrame:
    """The rows that are asked for by name."""
    return rows.where(F.col(key).isin(list(ids)))


def with_carried(links: DataFrame, meta: DataFrame) -> DataFrame:
    """``links`` (url) with what a listing, an API or a feed told of each: ``meta`` (url, ord and further columns), the first row of a URL counting."""
    names = [c for c in meta.columns if c not in ("url", "ord")]
    first = meta.groupBy("url").agg(F.min_by(F.struct(*names), "ord").alias("_m"))
    return links.join(first, "url", "left").select(*links.columns, *[F.col(f"_m.{n}").alias(n) for n in names])


def matching(links: DataFrame, pattern: str) -> DataFrame:
    return links.where(F.col("url").rlike(pattern.replace("(?P<", "(?<")))


def without_listings(links: DataFrame, listings: DataFrame) -> DataFrame:
    """Links whose path isn't that of a listing page."""
    paths = listings.select(U.path(F.col("url")).alias("_path")).distinct()
    return links.withColumn("_path", U.path(F.col("url"))).join(paths, "_path", "left_anti").drop("_path")


def evenly(rows: DataFrame, k: int) -> DataFrame:
    """``k`` rows from the first to the last in equal steps, halves going to the even place."""
    if k <= 0:
        return rows.limit(0)
    n = rows.count()
    at = range(n) if k >= n else [0] if k == 1 else sorted({round(i * (n - 1) / (k - 1)) for i in range(k)})
    ids = rows.sparkSession.createDataFrame([(i + 1,) for i in at], "_n long")
    return placed(rows).join(F.broadcast(ids), "_n", "left_semi").drop("_n")


def seeded_sample(rows: DataFrame, n: int, seed: int, key: str = "doc_id") -> DataFrame:
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def numbered(rows: DataFrame, last: DataFrame) -> DataFrame:
    """``rows`` (country, iso3, ord) with doc_ids that continue each country's counter (``last``: country, last_num); rows without a country have one too."""
    n = F.coalesce("last_num", F.lit(0)) + F.col("_n")
    before = last.select(F.col("country").alias("_of"), "last_num")
    numbers = placed(rows, ["country"]).join(before, F.col("country").eqNullSafe(F.col("_of")), "left").withColumn("doc_num", n)
    return numbers.withColumn("doc_id", T.document_id(F.col("iso3"), F.col("doc_num"))).drop("_of", "last_num", "_n")


def universe(listed: DataFrame) -> DataFrame:
    """By source: distinct links over all its lists (source_id, file, url), and the largest list's share."""
    keyed = listed.where(F.col("url").startswith("http")).withColumn("key", U.link_key(F.col("url")))
    files = keyed.groupBy("source_id", "file").agg(F.countDistinct("key").alias("n"))
    top = files.groupBy("source_id").agg(F.max("n").alias("largest"), F.count("*").alias("n_files"))
    big = files.join(top.select("source_id", "largest"), "source_id").where(2 * F.col("n") >= F.col("largest")).groupBy("source_id").agg(F.count("*").alias("n_big"))
    return keyed.groupBy("source_id").agg(F.countDistinct("key").alias("n_links")).join(top, "source_id").join(big, "source_id")


def source_index(rows: DataFrame) -> DataFrame:
    """By source (source_id, doc_id, date, text, url): rows, coverage, span of plausible dates, first and last id by number."""
    day = D.plausible(F.col("date"))
    place = F.struct(T.id_prefix(F.col("doc_id")).alias("p"), T.id_number(F.col("doc_id")).alias("n"))
    return rows.groupBy("source_id").agg(
        F.count("*").alias("n_docs"), F.count_if(~T.blank(F.col("text"))).alias("n_text"), F.min(day).cast("string").alias("date_min"), F.max(day).cast("string").alias("date_max"),
        F.count_if(~T.blank(F.col("date")) & day.isNull()).alias("n_bad_dates"), F.min_by("doc_id", place).alias("first_id"), F.max_by("doc_id", place).alias("last_id"),
    )


def never_scraped(listed: DataFrame, rows: DataFrame) -> DataFrame:
    return listed.select("source_id").distinct().join(rows.select("source_id").distinct(), "source_id", "left_anti")


def merge_report(rows: DataFrame) -> DataFrame:
    wide = F.length(F.regexp_extract("doc_id", r"(\d+)$", 1)) > 4
    counts = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    again = counts.where("doc_id <> ''").agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("n_repeated"))
    total = rows.agg(F.count("*").alias("n_rows"), F.countDistinct("source_id").alias("n_sources"), F.countDistinct("doc_id").alias("n_ids"), F.count_if(T.blank(F.col("doc_id"))).alias("n_blank_ids"), F.count_if(wide).alias("n_wide_ids"))
    one = F.lit(1).alias("_k")  # two single rows side by side
    return total.select("*", one).join(again.select("*", one), "_k").drop("_k")


def cleaned_index(rows: DataFrame) -> DataFrame:
    """By source (source_id, doc_id, clean_status, speaker_review, needs_translation)."""
    status = F.col("clean_status")
    return rows.groupBy("source_id").agg(
        F.count("*").alias("n_rows"), F.count_if(status == "accepted").alias("n_accepted"), F.count_if(status.startswith("rejected")).alias("n_rejected"), F.count_if(status == "error").alias("n_errors"),
        F.count_if("speaker_review").alias("n_review"), F.count_if(~F.col("needs_translation")).alias("n_translated"), F.min("doc_id").alias("doc_id_first"), F.max("doc_id").alias("doc_id_last"),
    )


def best_capture(captures: DataFrame) -> DataFrame:
    """By original: the longest capture that came with status 200, the earliest in order of equals."""
    ok = captures.where("statuscode = '200'")
    return ok.groupBy("original").agg(F.max_by(F.struct("timestamp", "length"), F.struct("length", -F.col("ord"))).alias("c")).select("original", "c.*")


def extended(captures: DataFrame, live: DataFrame, ledger: DataFrame) -> DataFrame:
    """Captures from before the earliest live date whose document isn't in the ledger."""
    floor = live.select(F.min(D.plausible(F.col("date"))).alias("floor"))
    old = captures.withColumn("day", D.capture_date(F.col("timestamp"))).join(F.broadcast(floor)).where(F.col("floor").isNull() | (F.col("day") < F.col("floor").cast("string")))
    return unscraped(old.drop("floor", "day"), ledger).where("fate = 'kept'")


def link_fate(url: Column, text: Column, keep: Column) -> Column:
    """What becomes of a fetched page: the keep rule comes before the empty text."""
    return F.when(~keep, "filtered").when(T.blank(text), "failed").otherwise("seen")


def pager_stops(pages: DataFrame) -> DataFrame:
    """Where each start's pager ends: ``pages`` (start, page, url, status), the first page that brings nothing new."""
    links = pages.where(F.col("url").isNotNull())
    new = links.groupBy("start", "url").agg(F.min("page").alias("page")).groupBy("start", "page").agg(F.count("*").alias("gain"))
    seen = pages.groupBy("start", "page").agg(F.max("status").alias("status"), F.count("url").alias("n_links"))
    all_pages = seen.join(new, ["start", "page"], "left").withColumn("gain", F.coalesce("gain", F.lit(0)))
    why = F.when(F.col("status").isin(404, 410), "missing").when(F.col("n_links") == 0, "empty").when(F.col("gain") == 0, "no_new")
    ended = all_pages.withColumn("reason", why).where("reason is not null").groupBy("start").agg(F.min_by(F.struct("page", "reason"), "page").alias("e"))
    last = pages.groupBy("start").agg(F.max("page").alias("last_page"))
    return last.join(ended, "start", "left").select("start", F.coalesce("e.page", "last_page").alias("stopped_at"), F.coalesce("e.reason", F.lit("cap")).alias("stop_reason"))
