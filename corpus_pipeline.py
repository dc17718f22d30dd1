"""Documents made ready for training: a chain of stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import FOLDERS, release, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Items of the benchmark that a document may not hold a window of; one is enough here.
LEAKED_ITEMS = 1
#: As many where all of them are shorter than a window, as a single word says nothing.
LEAKED_SHORT_ITEMS = 2


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the network, fitted on the labelled rows of ``docs``, scores at the threshold or above.

    A null or empty text scores as padding does and stays; repeated rows share
    their fate; without labels of both kinds nothing goes.
    """
    from tesserae.llm.toxicity import THRESHOLD, score, train

    net = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, net).where(F.col("score") < THRESHOLD).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each SimHash component, a null id being the largest.

    Rows are told by id and text: repeated rows become one, and of rows that
    tie in their id the one with the least hash of its text stays.  Texts
    without words are one component.
    """
    from tesserae.llm.simhash import deduplicate

    return deduplicate(docs).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item.

    A null or wordless text holds none and stays; repeated rows share their fate.
    """
    from tesserae.llm.decontaminate import clean

    return clean(docs, table(spark, sf_dir, "benchmark"), min_items=LEAKED_ITEMS, short_items=LEAKED_SHORT_ITEMS).select(COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data and what discloses it; every document stays, null texts and repeated rows as well."""
    from tesserae.llm.pii import sanitise

    return sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode: the documents with their pieces and the scores of the N best segmentations.

    A null or empty text has no pieces; repeated rows get equal ones.
    """
    from tesserae.llm.pieces import encoded

    return encoded(docs.select(COLUMNS), wanted=["pieces", "scores"])


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("sentencepiece", sentencepiece)]

#: SQL can't express the network, the fingerprints' components or the piece search; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole of ``documents``."""
    docs, since = table(spark, sf_dir, "documents"), len(FOLDERS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, since)
    return docs
