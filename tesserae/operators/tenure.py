"""Speakers held against the table of who was in office where and when."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from tesserae.functions.dates import year_of
from tesserae.functions.text import blank, id_number, nz

#: Rows of the tenure table up to which it is broadcast (about 100 bytes each).
BROADCAST_ROWS = 500_000


@F.pandas_udf(StringType())
def folded(names: pd.Series) -> pd.Series:
    """Without accents, in lower case, with single blanks."""

    def one(name: str | None) -> str:
        plain = "".join(c for c in unicodedata.normalize("NFKD", name or "") if not unicodedata.combining(c))
        return " ".join(plain.lower().split())

    known = {n: one(n) for n in names.unique()}
    return names.map(known, na_action=None)


def strong(a: Column, b: Column) -> Column:
    """Equal, or one within the other."""
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def loose(a: Column, b: Column) -> Column:
    """``strong``, or with a common token of three letters or more."""
    long = lambda c: F.filter(F.split(c, " "), lambda t: F.length(t) > 2)
    return strong(a, b) | ((a != "") & (b != "") & F.arrays_overlap(long(a), long(b)))


def grams(c: Column) -> Column:
    """All distinct pieces of a name of up to three characters."""
    n = F.length(c)
    return F.array_distinct(F.flatten(F.transform(F.array(*[F.lit(k) for k in (1, 2, 3)]), lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(c, i, k))).otherwise(F.array().cast("array<string>")))))


def within(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs of rows whose names ``a`` and ``b`` are ``strong``: joined on the beginning of the one that must be a piece of the other."""
    head = lambda c: F.substring(c, 1, 3).alias("_g")
    left, right = left.where(F.col(a) != ""), right.where(F.col(b) != "")
    ab = left.select("*", F.explode(grams(F.col(a))).alias("_g")).join(right.select("*", head(b)), "_g").where(F.contains(F.col(a), F.col(b)))
    ba = left.select("*", head(a)).join(right.select("*", F.explode(grams(F.col(b))).alias("_g")), "_g").where(F.contains(F.col(b), F.col(a)) & (F.col(a) != F.col(b)))
    return ab.unionByName(ba).drop("_g")


def bounded(key: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast the table if it is as small as such tables are, and leave the join to Spark if not."""
    return F.broadcast(key) if key.limit(limit + 1).count() <= limit else key


def match(rows: DataFrame, key: DataFrame, window: int = 1) -> DataFrame:
    """``rows`` (speaker, country, year) with tenure_match, is_ceremonial and matched_name.

    Only distinct (speaker, country, year) meet the table: first those in
    office in the country about that year, by the loose rule; for the rest
    anyone elsewhere, by the strong rule.  The earliest row of the table
    (``ord``) wins.  Blank countries skip the first step.
    """
    key = key.select("ord", F.col("speaker").alias("matched_name"), F.col("country").alias("k_country"), F.col("year").alias("k_year"), F.col("is_ceremonial").alias("k_ceremonial")).withColumn("k_norm", folded("matched_name"))
    asked = rows.select("speaker", "country", "year").distinct().withColumn("s_norm", folded("speaker")).where("s_norm <> ''")
    near = F.col("year").isNull() | F.col("k_year").between(F.col("year") - window, F.col("year") + window)
    first = lambda kind: F.min_by(F.struct(F.lit(kind).alias("m"), "matched_name", "k_ceremonial"), "ord").alias("hit")
    ids = ["speaker", "country", "year"]
    home = asked.where(~blank(F.col("country"))).join(bounded(key), (F.col("country") == F.col("k_country")) & near & loose(F.col("s_norm"), F.col("k_norm"))).groupBy(*ids).agg(first("exact"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    named = home.select(*[F.col(c).alias(f"h_{c}") for c in ids])
    missed = asked.join(named, same("speaker", "h_speaker") & same("country", "h_country") & same("year", "h_year"), "left_anti")
    # names, not years, decide abroad: the first row of each (name, country) is enough
    abroad = key.groupBy("k_country", "k_norm").agg(F.min_by(F.struct("ord", "matched_name", "k_ceremonial"), "ord").alias("k")).select("k_country", "k_norm", "k.*")
    places = missed.select("speaker", "s_norm", "country").distinct()
    elsewhere = blank(F.col("country")) | (F.col("country") != F.col("k_country"))
    away = within(places, abroad, "s_norm", "k_norm").where(elsewhere).groupBy("speaker", "country").agg(first("other_country"))
    away = missed.select(*ids).join(away.select(F.col("speaker").alias("a_speaker"), F.col("country").alias("a_country"), "hit"), same("speaker", "a_speaker") & same("country", "a_country")).select(*ids, "hit")
    hits = home.unionByName(away).select(*[F.col(c).alias(f"q_{c}") for c in ids], "hit")
    out = rows.join(hits, same("speaker", "q_speaker") & same("country", "q_country") & same("year", "q_year"), "left")
    return out.select(*rows.columns, F.coalesce("hit.m", F.lit("none")).alias("tenure_match"), F.when(F.col("hit.m") == "exact", F.col("hit.k_ceremonial")).alias("is_ceremonial"), F.coalesce("hit.matched_name", F.lit("")).alias("matched_name"))


def leaders_for(asked: DataFrame, key: DataFrame, window: int = 1) -> DataFrame:
    """``asked`` (country, year) with ``leaders``, the names in office then, in the table's order."""
    k = key.select("ord", F.col("speaker").alias("name"), F.col("country").alias("k_country"), F.col("year").alias("k_year"))
    near = F.col("year").isNull() | F.col("k_year").between(F.col("year") - window, F.col("year") + window)
    pairs = asked.distinct().join(bounded(k), (F.col("country") == F.col("k_country")) & near, "left").groupBy("country", "year", "name").agg(F.min("ord").alias("ord"))
    names = F.transform(F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("ord", "name")))), lambda x: x["name"])
    return pairs.groupBy("country", "year").agg(F.array_join(names, ", ").alias("leaders"))


def inventory(rows: DataFrame) -> DataFrame:
    """``rows`` (ord, speaker, country, position, date) by speaker and country: how often, when, and in which position mostly."""
    rows = rows.where(~blank(F.col("speaker"))).withColumn("year", year_of(F.col("date")))
    held = rows.where(~blank(F.col("position"))).groupBy("speaker", "country", "position").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    modal = held.groupBy("speaker", "country").agg(F.max_by("position", F.struct("n", -F.col("first"))).alias("position"))
    counted = rows.groupBy("speaker", "country").agg(F.count("*").alias("n"), F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    return counted.join(modal, ["speaker", "country"], "left")


def new_years(approved: DataFrame, key: DataFrame) -> DataFrame:
    """The leader-years of ``approved`` (speaker, country, min_year, max_year) that the table lacks."""
    years = approved.select("speaker", "country", F.explode(F.sequence("min_year", "max_year")).alias("year"))
    return years.join(key.select("speaker", "country", "year"), ["speaker", "country", "year"], "left_anti")


def spans_overlap(people: DataFrame, key: DataFrame) -> DataFrame:
    """``people`` (speaker, country, min_year, max_year) with whether their years meet the table's for the same name."""
    spans = key.groupBy("speaker", "country").agg(F.min("year").alias("t_min"), F.max("year").alias("t_max"))
    return people.join(spans, ["speaker", "country"], "left").select(*people.columns, F.coalesce((F.col("max_year") >= F.col("t_min")) & (F.col("min_year") <= F.col("t_max")), F.lit(False)).alias("in_office"))


def approvals(outbox: DataFrame) -> DataFrame:
    """Approved people (ord, speaker, country, min_year, max_year, role, is_ceremonial), one row each: the widest span, the first role."""
    return outbox.groupBy("speaker", "country").agg(
        F.min("min_year").alias("min_year"), F.max("max_year").alias("max_year"),
        F.min_by("role", F.when(F.col("role").isNotNull(), F.col("ord"))).alias("role"), F.min_by("is_ceremonial", F.when(F.col("is_ceremonial").isNotNull(), F.col("ord"))).alias("is_ceremonial"),
    )


def country_codes(key: DataFrame, columns: list[str]) -> DataFrame:
    """For each country the first code of each kind that isn't null."""
    return key.groupBy("country").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c) for c in columns])


def apply_name_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (speaker, country, year) with ``canonical``; ``rules``: ord, country, name, y_lo, y_hi, canonical.

    The last rule that fits wins; rules with years don't fire without a year.
    """
    r = rules.select("ord", F.col("country").alias("r_country"), F.col("name").alias("r_name"), "y_lo", "y_hi", F.col("canonical").alias("r_canonical"))
    open_ended = F.col("y_lo").isNull() & F.col("y_hi").isNull()
    inside = (F.col("y_lo").isNull() | (F.col("year") >= F.col("y_lo"))) & (F.col("y_hi").isNull() | (F.col("year") <= F.col("y_hi")))
    asked = rows.select("speaker", "country", "year").distinct()
    won = asked.join(bounded(r), (F.col("country") == F.col("r_country")) & (F.col("speaker") == F.col("r_name")) & (open_ended | F.coalesce(inside, F.lit(False)))).groupBy("speaker", "country", "year").agg(F.max_by("r_canonical", "ord").alias("won"))
    won = won.select(F.col("speaker").alias("w_s"), F.col("country").alias("w_c"), F.col("year").alias("w_y"), "won")
    out = rows.join(won, (F.col("speaker") == F.col("w_s")) & (F.col("country") == F.col("w_c")) & F.col("year").eqNullSafe(F.col("w_y")), "left")
    return out.select(*rows.columns, F.coalesce("won", F.col("speaker")).alias("canonical"))


def merged_once(rows: DataFrame) -> DataFrame:
    """The first row (``ord``) of each doc_id, in the order of their numbers."""
    w = Window.partitionBy(nz(F.col("doc_id"))).orderBy("ord")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").withColumn("doc_number", id_number(F.col("doc_id")))
