"""Rows of the corpus: assembled, audited, followed to linked documents, and judged again from what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions import dates as D
from tesserae.functions import languages as L
from tesserae.functions import text as T
from tesserae.functions import urls as U
from tesserae.operators import gate, links, tenure
from tesserae.sources.files import SCRAPED

#: What cleaning adds to a scraped row.
CLEANED = {
    "speaker_scraped": "string", "date_scraped": "string", "document_type": "string", "speaker_type": "string", "is_first_person": "string", "is_substantive": "string",
    "inclusion_tier": "string", "date_model": "string", "date_matches_metadata": "string", "date_precision": "string", "date_parsed": "string", "date_disagreement_flag": "boolean",
    "date_is_fallback": "boolean", "detected_language": "string", "tenure_match": "string", "tenure_matched_name": "string", "is_ceremonial": "boolean", "speaker_review": "boolean",
    "clean_status": "string", "gate_reason": "string", "clean_model": "string", "cleaned_at": "string",
}
REASON_CHARS = 300


def mapped(records: DataFrame, recipes: DataFrame, max_year: Column | None = None) -> DataFrame:
    """Scraped rows from ``records`` (source_id, doc_id, source, speaker, title, text, context, date) and their recipes.

    ``recipes``: source_id, country, iso3n, position, source_language, dataset.
    Title, text and context go under the names of the target language or of the
    original, by the recipe's language; the head line's date is a candidate only.
    """
    both = records.join(recipes, "source_id")
    english = L.is_english(F.col("source_language"))
    split = []
    for name in ("context", "title", "text"):
        split += [F.when(english, T.nz(F.col(name))).otherwise("").alias(name), F.when(english, "").otherwise(T.nz(F.col(name))).alias(f"{name}_originlanguage")]
    given = {"ISO3N": T.nz(F.col("iso3n")), "wayback_capture": T.nz(F.col("wayback_capture")) if "wayback_capture" in records.columns else F.lit("")}
    candidate = T.nz(D.head_date(F.col("text"), max_year=max_year)).alias("date_regex_recovered")
    plain = [given.get(c, T.nz(F.col(c))).alias(c) for c in SCRAPED if c in ("doc_id", "country", "ISO3N", "speaker", "position", "date", "source", "source_language", "dataset", "wayback_capture")]
    return both.select("source_id", *plain, *split, candidate).select("source_id", *SCRAPED)


def audited(rows: DataFrame) -> DataFrame:
    """Every column of ``rows``, those of a scraped row that are missing, copies of what cleaning may change, and its own columns, empty."""
    missing = [F.lit("").alias(c) for c in SCRAPED if c not in rows.columns]
    out = rows.select("*", *missing)
    copies = {"speaker_scraped": T.nz(F.col("speaker")), "date_scraped": T.nz(F.col("date"))}
    return out.select(*[c for c in out.columns if c not in copies], *[v.alias(k) for k, v in copies.items()], *[F.lit(None).cast(t).alias(c) for c, t in CLEANED.items() if c not in out.columns and c not in copies])


def failed(rows: DataFrame, status: Column, detail: Column, at: Column | None = None) -> DataFrame:
    """``audited`` rows of documents that couldn't be cleaned, with the reason cut to its first characters."""
    stamp = at if at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    values = {"clean_status": status, "gate_reason": F.substring(detail, 1, REASON_CHARS), "clean_model": F.lit(None).cast("string"), "cleaned_at": stamp}
    return audited(rows).withColumns(values)


def followed(rows: DataFrame) -> DataFrame:
    """``rows`` (title, text, link, kind, linked_text) with the linked document's text where there is one.

    No link, or none to a PDF: as it was.  A PDF without text clears the body,
    which then fails as empty; otherwise its text is the body and its first
    line a missing title.  ``followed`` says whether the body was replaced.
    """
    real = ~T.blank(F.col("link")) & (T.nz(F.col("kind")) == "pdf")
    full = real & ~T.blank(F.col("linked_text"))
    title = F.when(full & T.blank(F.col("title")), T.first_line(F.col("linked_text"))).otherwise(F.col("title"))
    text = F.when(full, T.strip(F.col("linked_text"))).when(real, "").otherwise(F.col("text"))
    return rows.withColumns({"title": title, "text": text, "followed": full})


def provenance(arms: Sequence[tuple[str, Column]]) -> Column:
    """struct<value, origin> of the first arm (label, value) that isn't blank; null if all are."""
    out = F.lit(None).cast("struct<value:string,origin:string>")
    for label, value in reversed(arms):
        out = F.when(~T.blank(value), F.struct(value.alias("value"), F.lit(label).alias("origin"))).otherwise(out)
    return out


def date_provenance(selectors: Sequence[tuple[str, Column]], url: Column, pattern: str | None, languages: Sequence[str] | None = None) -> Column:
    """As ``provenance`` for a date: a selector wins only if its text is a date; then the URL."""
    arms = [(label, D.parse_date(value, languages)) for label, value in selectors]
    return provenance([*arms, *([(f"url_regex: {pattern}", D.url_date(url, pattern))] if pattern else [])])


def redated(rows: DataFrame, flag_years: int = 5, text_first: bool = False, max_year: Column | None = None) -> DataFrame:
    """Dates resolved again from stored columns; error rows stay, and nothing that is read here is written.

    The site's own date is ``date_scraped``; ``date`` stands in for it only where the precision says that it is the same.
    """
    own = F.when(~T.blank(F.col("date_scraped")), F.col("date_scraped")).when(F.col("date_precision") == "scraped", F.col("date")).otherwise("")
    text = T.first_filled(F.col("text"), F.col("text_originlanguage"))
    said = F.when(T.blank(F.col("date_model")) & T.blank(F.col("date_matches_metadata")), F.lit(None).cast("string"))
    r = D.resolved(own, F.col("wayback_capture"), F.coalesce(said, F.col("date_model")), F.coalesce(said, F.col("date_matches_metadata")), F.col("_hijri"), F.col("_head"), flag_years, text_first)
    bound = rows.withColumns({"_hijri": D.hijri_date(text), "_head": D.head_date(text, max_year=max_year)}).withColumn("_r", F.when(~open_error(), r))
    kept = {"date": "date", "date_precision": "precision", "date_parsed": "parsed", "date_regex_recovered": "regex", "date_disagreement_flag": "disagreement", "date_is_fallback": "is_fallback"}
    return bound.withColumns({c: F.when(F.col("_r").isNotNull(), F.col(f"_r.{x}")).otherwise(F.col(c)) for c, x in kept.items()}).select(*rows.columns)


def open_error() -> Column:
    return T.nz(F.col("clean_status")).startswith("error")


def regated(rows: DataFrame, key: DataFrame | None = None, keep: Sequence[str] = gate.KEPT_TYPES, leaders_only: bool = True, window: int = 1) -> DataFrame:
    """The gate applied again to stored fields, without a call; ``key``, if given, also places the speakers anew.

    Error rows stay as they are.  Running it twice changes nothing.
    """
    todo, rest = rows.where(~open_error()), rows.where(open_error())
    if key is not None:
        stored = todo.drop("tenure_match", "tenure_matched_name", "is_ceremonial").withColumn("year", D.year_of(F.col("date")))
        todo = tenure.match(stored, key, window).withColumnRenamed("matched_name", "tenure_matched_name").withColumn("tenure_matched_name", F.nullif("tenure_matched_name", F.lit(""))).drop("year")
    c = F.col
    verdict = gate.decide(c("document_type"), c("speaker"), c("speaker_type"), c("tenure_match"), keep, leaders_only)
    same = T.nz(c("clean_status")) == c("_v.clean_status")
    judged = todo.withColumn("_v", verdict).withColumns({
        "inclusion_tier": gate.tier(c("document_type"), c("is_first_person"), c("is_substantive")), "gate_reason": F.when(same, c("gate_reason")).otherwise(c("_v.gate_reason")), "clean_status": c("_v.clean_status"),
        "speaker_review": gate.needs_review(c("_v.clean_status"), c("tenure_match"), c("speaker_type"), c("is_first_person"), c("is_substantive")),
    })
    return judged.select(*rows.columns).unionByName(rest)


def reopened(candidates: DataFrame, state: DataFrame, retry_failed: bool = False, rescrape: bool = False, noise: Sequence[str] = ()) -> DataFrame:
    """``links.unscraped`` against the part of ``state`` (url, status) that still closes a link.

    Seen, failed and filtered links are closed; ``retry_failed`` opens the
    failed ones, and ``rescrape`` all of these candidates but the filtered.
    """
    closed = state.where(F.col("status") != "failed") if retry_failed else state
    if rescrape:
        mine = candidates.select("url").distinct()
        closed = closed.where("status = 'filtered'").unionByName(closed.where("status <> 'filtered'").join(mine, "url", "left_anti"))
    return links.unscraped(candidates, closed, noise)


def continuation(recipes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The recipe for a source's archive: ``extend`` (a struct of overrides) over the live one's fields.

    The prefix, if none is given, is that of the first start page.
    """
    live = lambda f: F.col(f)
    prefix = F.coalesce("extend.prefix", U.archive_prefix(F.regexp_replace(F.get("start_urls", F.lit(0)), r"^https?://", "")))
    return recipes.select("source_id", prefix.alias("prefix"), *[F.coalesce(F.col(f"extend.{f}"), live(f)).alias(f) for f in fields])
