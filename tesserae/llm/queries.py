"""The registered query of each operator: ``opN_<name>`` over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tesserae.llm.common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.pieces import digest

    return digest(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.counts import counted

    return counted(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.decontaminate import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.quality import assess

    return assess(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.pii import digest

    return digest(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.toxicity import assess

    return assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.substrings import digest

    return digest(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.llm.sharding import OUTPUT, shard

    return shard(table(spark, sf_dir, "documents")).select("doc_id", *OUTPUT)


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}
