"""Recipes of sources: what a recipe may say, what it means if silent, what makes one unusable, and records by recipe.

A recipe is a nested dict, as its YAML says it.  ``KNOBS`` lists every setting
with its default; a setting that isn't listed is a mistake and is told.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions import dates as D
from tesserae.functions import text as T
from tesserae.functions import urls as U
from tesserae.operators import html as H

# Settings and their defaults, by part of a recipe (the name of the dataset is our own).
FIELD = {"selectors": [], "attr": None, "regex": None, "regex_required": False, "url_regex": None}
ARCHIVE = {"wayback_from": None, "wayback_to": None, "wayback_limit": None, "wayback_match_type": "prefix", "wayback_collapse": "urlkey", "wayback_delay": 5.0, "wayback_filter": None}
KNOBS = {
    "listing": {"link_selector": None, "link_pattern": None, "item_selector": None, "item_date": None, "item_title": None},
    "keep_if": {"selectors": [], "pattern": None, "negate": False},
    "api": {
        "results_path": None, "url_field": None, "title_field": None, "date_field": None, "text_field": None, "speaker_field": None, "cells_path": None, "cell_key": "Key", "cell_value": "Value",
        "headers": {}, "delay": 0.0, "method": "GET", "body": None, "body_page_field": None, "url_base": None,
    },
    "feed": {"format": "auto", "use_content": True},
    "pagination": {
        "type": "none", "param": None, "start": 0, "step": 1, "path_format": None, "max_pages": None, "next_selector": None, "url_list": None, "sitemap_urls": None, **ARCHIVE,
        "wayback_adaptive": False, "wayback_max_delay": 12.0, "wayback_dedupe_noise_params": True, "wayback_noise_params": None, "api": None, "feed": None,
    },
    "wayback_extend": {"enabled": True, "prefix": None, "link_pattern": None, "title": None, "text": None, "date": None, "speaker": None, "context": None, **ARCHIVE},
    "politeness": {"delay_range": [0.0, 0.0], "pause_every": 50, "pause_seconds": 5.0, "retries": 3, "backoff": 5.0},
    "recipe": {
        "source_id": None, "country": None, "iso3n": None, "source_language": "English", "dataset": "corpus", "start_urls": None, "renderer": "static", "content_type": "auto", "verify_ssl": True,
        "user_agent": None, "encoding": None, "block_page": True, "block_page_patterns": [], "js_settle": 0.0, "js_context_recycle": 0, "cdp_endpoint": None, "listing": None, "keep_if": None, "pagination": {},
        "wayback_extend": None, "title": None, "text": None, "date": None, "speaker": None, "context": None, "pdf_link": None, "pdf_ocr": False, "pdf_ocr_language": "eng", "position": None,
        "speaker_default": None, "date_languages": [], "politeness": {}, "notes": None,
    },
}
CHOICES = {"renderer": ["static", "js", "cdp"], "content_type": ["auto", "html", "pdf"], "type": ["none", "query_param", "path", "click", "next_link", "url_list", "sitemap", "api", "feed", "wayback"]}
FIELDS = ["title", "text", "date", "speaker", "context"]
PARTS = {"listing": "listing", "keep_if": "keep_if", "pagination": "pagination", "api": "api", "feed": "feed", "wayback_extend": "wayback_extend", "politeness": "politeness"}
FIELD_NAMES = {*FIELDS, "pdf_link", "item_date", "item_title"}


def filled(given: object, part: str, at: str, faults: list[str]) -> dict:
    """A part of a recipe with its defaults, and the parts within it; what isn't known goes to ``faults``."""
    defaults = FIELD if part == "field" else KNOBS[part]
    if not isinstance(given, dict):
        faults.append(f"{at or 'recipe'} must be a mapping")
        given = {}
    faults += [f"{at}{k}: no such setting" for k in given if k not in defaults]
    out = copy.deepcopy(defaults) | {k: v for k, v in given.items() if k in defaults}
    for k, v in out.items():
        inner = "field" if k in FIELD_NAMES and part != "api" else PARTS.get(k)
        if inner and v is not None:
            out[k] = filled(v, inner, f"{at}{k}.", faults)
        if k in CHOICES and v is not None and v not in CHOICES[k]:
            faults.append(f"{at}{k}: {v!r} is none of {', '.join(CHOICES[k])}")
    return out


def pattern_faults(node: object, at: str = "") -> Iterator[str]:
    for k, v in node.items() if isinstance(node, dict) else ():
        if isinstance(v, str) and (k in ("regex", "url_regex", "link_pattern") or k == "pattern"):
            try:
                re.compile(v)
            except re.error as e:
                yield f"{at}{k}: {e}"
        else:
            yield from pattern_faults(v, f"{at}{k}.")


def needs(r: dict) -> Iterator[tuple[bool, str]]:
    """(whether it holds, what is wrong if not) for all that a usable recipe needs."""
    listing, pages, keep = r["listing"] or {}, r["pagination"], r["keep_if"]
    kind, items = pages["type"], bool(listing.get("item_date") or listing.get("item_title"))
    for k in ("source_id", "country"):
        yield bool(r[k]), f"{k} is missing"
    yield isinstance(r["start_urls"], list), "start_urls is missing"
    yield bool(listing.get("link_selector") or listing.get("link_pattern")), "listing: give link_selector, link_pattern or both"
    yield not items or bool(listing.get("item_selector")), "listing: item_date and item_title are read within an item_selector, which is missing"
    yield not listing.get("item_selector") or items, "listing.item_selector: no item_date or item_title to read in it"
    for k in ("item_date", "item_title"):
        yield not (listing.get(k) or {}).get("url_regex"), f"listing.{k}.url_regex: an item has no URL of its own"
    yield keep is None or bool(keep["selectors"] or keep["pattern"]), "keep_if: give selectors, pattern or both"
    for k in ("title", "text", "date"):
        f = r[k] or {}
        yield bool(f.get("selectors") or f.get("url_regex")) or r["content_type"] == "pdf", f"{k}: no selector and no url_regex"
    for of, k in (("query_param", "param"), ("click", "next_selector"), ("next_link", "next_selector"), ("url_list", "url_list"), ("sitemap", "sitemap_urls"), ("api", "api")):
        yield kind != of or bool(pages[k]), f"pagination {of}: {k} is missing"
    for of in ("wayback", "feed"):
        yield kind != of or bool(r["start_urls"]), f"pagination {of}: start_urls is empty"
    if form := pages["path_format"]:
        try:
            yield form.format(n=0) != form, "pagination.path_format: no place for the number of a page, {n}"
        except (KeyError, ValueError, IndexError):
            yield False, "pagination.path_format: it can't be filled in"
    if kind == "api" and (api := pages["api"]):
        yield bool(api["results_path"] and api["url_field"]), "api: results_path and url_field are both needed"
        yield (api["method"] or "GET").upper() in ("GET", "POST"), "api.method: GET or POST"


def checked(data: object) -> tuple[dict, list[str]]:
    """The recipe with every default, and all that is wrong with it."""
    faults: list[str] = []
    if isinstance(data, dict):
        extend = data.get("wayback_extend")
        data = data | {"wayback_extend": None if extend in (None, False) else {} if extend is True else extend}
    out = filled(data, "recipe", "", faults)
    for k in ("pagination", "politeness"):
        if not isinstance(out[k], dict):
            out[k] = filled({}, k, f"{k}.", faults)
    faults += [message for holds, message in needs(out) if not holds]
    return out, [*faults, *pattern_faults(out)]


def load(text: str) -> dict:
    """The recipe of a YAML text; ``ValueError`` names every fault."""
    import yaml

    recipe, faults = checked(yaml.safe_load(text))
    if faults:
        raise ValueError("; ".join(faults))
    return recipe


def recipes(spark: SparkSession, path: str) -> DataFrame:
    """A row for each recipe file: what the other operators need of it, and its faults."""
    schema = (
        "file string, source_id string, country string, iso3n string, source_language string, dataset string, position string, renderer string, pagination string, link_pattern string, "
        "start_urls array<string>, date_languages array<string>, archived boolean, faults array<string>"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for batch in batches:
            rows = []
            for file, text in zip(batch["file"], batch["value"], strict=True):
                try:
                    data = yaml.safe_load(text)
                except yaml.YAMLError as e:
                    data, said = {}, [f"no YAML: {type(e).__name__}"]
                else:
                    said = []
                r, faults = checked(data)
                number = None if r["iso3n"] is None else f"{int(r['iso3n']):03d}"
                rows.append((file, r["source_id"], r["country"], number, r["source_language"], r["dataset"], r["position"], r["renderer"], r["pagination"]["type"], (r["listing"] or {}).get("link_pattern"),
                             r["start_urls"] if isinstance(r["start_urls"], list) else [], r["date_languages"], r["pagination"]["type"] == "wayback" or r["wayback_extend"] is not None, said + faults))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])

    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.yml", recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("file"), "value").mapInPandas(run, schema)


def keeps(page: Column, text: Column, rule: dict | None) -> Column:
    """A recipe's verdict on a page, given the text of what its selectors match (null without a page tree)."""
    if rule is None:
        return F.lit(True)
    hay = page if rule["selectors"] else text
    found = T.nz(hay).rlike(rule["pattern"].replace("(?P<", "(?<")) if rule["pattern"] else ~T.blank(hay)
    verdict = found != F.lit(bool(rule["negate"]))
    return F.when(hay.isNull(), True).otherwise(verdict) if rule["selectors"] else verdict


def extracted(pages: DataFrame, recipe: dict, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` with the fields of a record by the recipe, and ``keep``; one parse of each page serves them all.

    A field is what its chain of selectors yields, then what its pattern finds
    in the URL; a date counts only if it reads as one; a speaker may have a default.
    """
    specs = {n: recipe[n] for n in FIELDS if recipe[n]}
    rule = recipe["keep_if"]
    names = [*specs, "_kept"]

    @F.pandas_udf(", ".join(f"{n} string" for n in names))
    def run(pages: pd.Series) -> pd.DataFrame:
        out = []
        for page in pages:
            root = H.parse(page)
            row = [H.first_match(root, f["selectors"], f["attr"], f["regex"], f["regex_required"]) for f in specs.values()]
            kept = " ".join(n.text() for s in (rule or {}).get("selectors", []) for n in H.select(root, s)) if page else None
            out.append([*row, kept])
        return pd.DataFrame(out, columns=names)

    found = pages.withColumn("_f", run(html))
    values = {}
    for n in FIELDS:
        spec = specs.get(n)
        if not spec:
            values[n] = F.lit("")
            continue
        pattern = spec["url_regex"]
        own = F.col(f"_f.{n}")
        if n == "date":
            from_url = url_date(F.col(url), pattern, recipe["date_languages"]) if pattern else F.lit(None).cast("string")
            values[n] = T.nz(F.coalesce(D.parse_date(own, recipe["date_languages"] or None), from_url))
        else:
            group = 1 if pattern and re.compile(pattern).groups else 0
            values[n] = T.first_filled(own, *([U.url_match(F.col(url), pattern, group)] if pattern else []))
            values[n] = T.tidy(values[n]) if n != "speaker" else T.strip(values[n])
    values["speaker"] = T.first_filled(values["speaker"], F.lit(recipe["speaker_default"]))
    return found.select(*pages.columns, *[v.alias(n) for n, v in values.items()], keeps(F.col("_f._kept"), F.col(html), rule).alias("keep"))


def url_date(url: Column, pattern: str, languages: list[str]) -> Column:
    """The date in a URL: of named groups, whose nonsense is a miss, else of the match as text."""
    groups = re.compile(pattern).groupindex
    if {"year", "month", "day"} <= set(groups):
        return D.url_date(url, pattern.replace("(?P<", "(?<"), *(groups[k] for k in ("year", "month", "day")))
    return D.parse_date(U.url_match(url, pattern, 1 if re.compile(pattern).groups else 0), languages or None)
