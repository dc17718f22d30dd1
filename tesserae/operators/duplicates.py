"""Documents that share their text, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tesserae.functions import text as T
from tesserae.functions import urls as U

SEPARATOR = " | "
# What stubs say, and the lengths that make one.
JUNK_MARKERS = ["under construction", "higher resolution", "link to video", "page not found", "access denied", "coming soon"]
JUNK_CHARS, STUB_CHARS = 300, 120


#: Numbers that a path holds between its slashes, and the ending that tells a slug from its copies.
ARTICLE_ID, COPY = r"/(\d{2,})(?:/|$)", r"-\d+$"


def article_ids(path: Column) -> Column:
    return F.regexp_extract_all(path, F.lit(ARTICLE_ID), 1)


def verdict(text: Column, one_place: Column, one_path: Column, one_host: Column, same_id: Column, one_slug: Column) -> Column:
    """Why pages share ``text``; ``shared_text_suspect`` is no duplication but a failed extraction."""
    low, size = F.lower(T.nz(text)), F.length(T.normal_form(text))
    marked = F.lit(False)
    for m in JUNK_MARKERS:
        marked |= F.contains(low, F.lit(m))
    return (
        F.when((size < JUNK_CHARS) & (marked | (size < STUB_CHARS)), "junk_stub").when(one_place, "url_variant").when(one_path & ~one_host, "mirror")
        .when(F.coalesce(same_id, F.lit(False)), "id_variant").when(one_slug, "slug_variant").otherwise("shared_text_suspect")
    )


def cause(urls: Column, text: Column) -> Column:
    """``verdict`` on the pages at an array of ``urls``."""
    places = F.array_sort(F.array_distinct(F.transform(urls, U.canonical)))
    one = lambda f: F.size(F.array_distinct(F.transform(places, f))) == 1
    numbers = F.transform(places, lambda p: article_ids(p["path"]))
    # bound to a variable, as the lambda would make the list anew for each place
    same_id = F.exists(F.array(numbers), lambda ns: (F.size(F.get(ns, F.lit(0))) > 0) & F.forall(ns, lambda x: F.arrays_overlap(x, F.get(ns, F.lit(0)))))
    return verdict(text, one(lambda p: p["url"]), one(lambda p: p["path"]), one(lambda p: p["host"]), same_id, one(lambda p: F.regexp_replace(p["path"], COPY, "")))


def clusters(rows: DataFrame, ids: int = 8, titles: int = 4) -> DataFrame:
    """A row for each text that two rows or more of a source hold.

    ``rows``: source_id, ord, doc_id, url, title, capture, text and, if there,
    country and text_originlanguage, which stands in for a blank text.  Rows
    without text don't count.

    First hashes are counted, without the texts; only what occurs twice goes
    on.  Nothing is collected: what the cause rests on are minima and maxima,
    and lists come from the first few rows of each cluster, of which each task
    sends no more than it may need.
    """
    given = set(rows.columns)
    text = T.first_filled(F.col("text"), *[F.col(x) for x in ("text_originlanguage",) if x in given])
    country = F.col("country") if "country" in given else F.lit("")
    base = rows.select("source_id", "ord", "doc_id", "url", "title", "capture", country.alias("country"), text.alias("_text")).where(~T.blank(F.col("_text")))
    base = base.withColumn("_h", T.text_key(F.col("_text")))
    key = ["source_id", "_h"]
    keyed = base.select(*key, "ord", "doc_id", "url", "title", "capture", "country", U.canonical(T.nz(F.col("url"))).alias("_p"))
    slug = F.regexp_replace("_p.path", COPY, "")
    one = lambda c, name: (F.min(c) == F.max(c)).alias(name)
    groups = keyed.groupBy(*key).agg(
        F.count("*").alias("n"), F.min("ord").alias("_first"), F.min_by("country", "ord").alias("country"), F.min("_p").alias("_p0"),
        one("_p.url", "_place"), one("_p.path", "_path"), one("_p.host", "_host"), one(slug, "_slug"),
    ).where("n >= 2")
    members = keyed.join(groups.select(*key, "_p0"), key)
    same = members.groupBy(*key).agg(F.bool_and(F.arrays_overlap(article_ids(F.col("_p.path")), article_ids(F.col("_p0.path")))).alias("_same"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", T.nz(F.col(c)).alias("x")))), lambda x: x["x"]), SEPARATOR)
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("ord"))
    firsts = members.withColumn("_n", nth).where(F.col("_n") <= ids).groupBy(*key).agg(listed("doc_id").alias("doc_ids"), listed("url").alias("urls"))

    def spread(c: str, most: int, name: str) -> DataFrame:
        values = members.where(~T.blank(F.col(c))).select(*key, c).distinct()
        few = values.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(c))).where(F.col("_n") <= most)
        return few.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list(c)), SEPARATOR).alias(name))

    texts = base.join(groups.select(*key, F.col("_first").alias("ord")), [*key, "ord"]).groupBy(*key).agg(F.min("_text").alias("_text"))
    out = groups.join(texts, key).join(same, key).join(firsts, key).join(spread("capture", ids, "captures"), key, "left").join(spread("title", titles, "titles"), key, "left")
    why = verdict(F.col("_text"), F.col("_place"), F.col("_path"), F.col("_host"), F.col("_same"), F.col("_slug"))
    return out.select(
        "source_id", "country", why.alias("cause"), "n", (F.col("n") - 1).alias("extra"), F.length("_text").alias("chars"), F.substring("_h", 1, 12).alias("text_hash"), "doc_ids", "urls",
        T.nz(F.col("captures")).alias("captures"), T.nz(F.col("titles")).alias("titles"), F.regexp_replace(F.substring("_text", 1, 300), r"(?U)\s+", " ").alias("text_head"),
    )


def by_cause(found: DataFrame) -> DataFrame:
    return found.groupBy("cause").agg(F.sum("extra").alias("extra_rows"), F.count("*").alias("n_clusters"))
