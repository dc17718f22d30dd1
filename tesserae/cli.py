"""``python -m tesserae.cli COMMAND``: the batch stages over tables in files.

Tables are Parquet unless a command says otherwise; nothing is written without ``--output``, and a summary is printed.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.operators import duplicates, gate, links, records, reports, tenure
from tesserae.plans import recipes
from tesserae.plans.settings import KEEP, settings
from tesserae.sources import files


def chosen(rows: DataFrame, a: argparse.Namespace) -> DataFrame:
    """The rows of ``--source`` and ``--country``, and the first ``--limit``."""
    for name in ("source", "country"):
        if (value := getattr(a, name, None)) is not None:
            rows = rows.where(F.col("source_id" if name == "source" else name) == value)
    limit = getattr(a, "limit", None)
    return links.evenly(rows, a.sample) if getattr(a, "sample", None) else rows.limit(limit) if limit else rows


def find_duplicates(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Clusters of rows that share their text, and why."""
    return duplicates.clusters(chosen(spark.read.parquet(a.input), a)).orderBy("cause", F.desc("extra"), "source_id", "text_hash")


def index(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """What each source has, beside the links that are known of it (``--links``)."""
    out = links.source_index(chosen(spark.read.parquet(a.input), a))
    return reports.with_links(out, reports.link_universe(spark.read.parquet(a.links))) if a.links else out


def audit(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """What link lists hold and what the recipes' patterns drop."""
    return reports.audit(reports.link_universe(chosen(spark.read.parquet(a.input), a)))


def merge(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The kept rows of the cleaned sources, each document once."""
    rows, keep = chosen(spark.read.option("mergeSchema", True).parquet(a.input), a), KEEP[a.keep]
    rows = rows.where(~F.col("clean_status").startswith("error")) if keep is None else rows.where(F.col("clean_status").isin(keep))
    return tenure.merged_once(rows)


def clean(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Dates (``--redate``) and gate applied again to what is stored, without a call."""
    s = settings("clean", a.config, **({"keep_document_types": a.keep_types} if a.keep_types else {}))
    rows = chosen(spark.read.parquet(a.input), a)
    if a.redate:
        rows = records.redated(rows, a.date_flag_years or s["date_flag_years"], a.date_text_first or s["date_text_first"])
    key = spark.read.parquet(a.key) if a.key else None
    return records.regated(rows, key, s["keep_document_types"], s["require_leader_type"], s["tenure_window"])


def check_recipes(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Recipe files (YAML) and what is wrong with them."""
    return recipes.recipes(spark, a.input)


def inventory(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Who speaks, when and in which position, by whom the tenure table knows (``--key``)."""
    people = tenure.inventory(chosen(spark.read.parquet(a.input), a))
    verdict = gate.by_position(F.col("position"))
    people = people.withColumn("is_leader", verdict["is_leader"])
    return tenure.spans_overlap(people, spark.read.parquet(a.key)) if a.key else people


COMMANDS = {"duplicates": find_duplicates, "index": index, "links": audit, "merge": merge, "clean": clean, "recipes": check_recipes, "tenure": inventory}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tesserae", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)
    for name, run in COMMANDS.items():
        p = commands.add_parser(name, help=run.__doc__)
        p.add_argument("--input", required=True)
        p.add_argument("--output")
        p.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        if name != "recipes":
            p.add_argument("--source")
            p.add_argument("--country")
            p.add_argument("--limit", type=int)
            p.add_argument("--sample", type=int, help="so many rows, evenly from first to last")
        if name == "index":
            p.add_argument("--links")
        if name == "merge":
            p.add_argument("--keep", choices=list(KEEP), default="speakers")
        if name in ("clean", "tenure"):
            p.add_argument("--key", help="the tenure table")
        if name == "clean":
            p.add_argument("--config")
            p.add_argument("--keep-types", nargs="*")
            p.add_argument("--redate", action="store_true")
            p.add_argument("--date-flag-years", type=int)
            p.add_argument("--date-text-first", action="store_true")
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a command; returns the number of rows."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("tesserae").getOrCreate()
    rows = COMMANDS[a.command](spark, a)
    if a.output is None:
        n = rows.count()
        rows.show(20, truncate=60)
    else:
        (files.write_csv if a.format == "csv" else lambda r, p: r.write.mode("overwrite").option("compression", "zstd").parquet(p))(rows, a.output)
        n = (spark.read.option("header", True).csv(a.output) if a.format == "csv" else spark.read.parquet(a.output)).count()
    print(f"{a.command}: {n} rows")
    return n


if __name__ == "__main__":
    main()
