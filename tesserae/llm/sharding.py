"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters the records by a seeded hash into buckets sized for a
task's memory, each a partition of its own.  Pass two puts each bucket into a
canonical order, applies Spark's seeded Fisher-Yates ``shuffle`` to it, whose
seed then is the bucket's own, and lays the buckets end to end.  Position ``g``
of that sequence goes to shard ``g % n``, slot ``g // n``, so shard sizes
differ by one row at most (law ``rows``).  The order depends on the records and
the seed alone: not on partitions, executors or attempts.

A record is scattered by its id and text.  Records that repeat so often that
they would fill a bucket are counted first and scattered by their number too,
so that none is too large for a task.

Defined results: null ids and null texts are records like any other (a null
text has no bytes); repeated rows keep their own places; an empty table gives
no rows; a column of the input that clashes with a result column is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RECORD_OVERHEAD = 16
#: Bytes of the records of a bucket, which is one task's; numbered copies in a row; rows of 20 bytes that may be broadcast.
BUCKET_BYTES, BLOCK, BROADCAST_ROWS = 16 << 20, 10_000, 1_000_000
OUTPUT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def record_size(text: str = "text"):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_OVERHEAD).cast("long")


def spread(docs: DataFrame, repeated: DataFrame, few: bool, seed: int) -> DataFrame:
    """``docs`` (with ``_key``) and ``_at``, a seeded hash of each record; those of ``repeated`` keys are told apart by number.

    Equal records are counted, which shrinks them to one row in each task, and
    come back in blocks, so no task writes out a whole group.
    """
    names = [c for c in docs.columns if c != "_key"]
    single = docs.join(F.broadcast(repeated) if few else repeated, "_key", "left_anti").withColumn("_at", F.xxhash64(F.lit(seed), "_key"))
    many = docs.join(F.broadcast(repeated) if few else repeated, "_key", "left_semi").groupBy("_key", *names).agg(F.count("*").alias("_n"))
    blocks = many.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {BLOCK}"))).alias("_block")).repartition("_key", "_block")
    last = F.least(F.col("_n"), (F.col("_block") + 1) * BLOCK) - 1
    copies = blocks.select("*", F.explode(F.sequence(F.col("_block") * BLOCK, last)).alias("_copy"))
    return single.unionByName(copies.select(*docs.columns, F.xxhash64(F.lit(seed), F.xxhash64("_key", *names), "_copy").alias("_at")))


def shuffled(docs: DataFrame, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``_g``, each record's place in one seeded random order of all."""
    docs = docs.select("doc_id", "text", *[c for c in docs.columns if c not in {"doc_id", "text", "_g", "_key", "_at", *OUTPUT}])
    keyed = docs.withColumn("_key", F.xxhash64(F.lit(seed), "doc_id", F.crc32("text"), F.octet_length("text")))
    groups = keyed.groupBy("_key").agg(F.count("*").alias("n"), F.sum(record_size()).alias("size"))
    heavy = (F.col("n") > 1) & (F.col("size") > bucket_bytes / 8)
    counts = groups.agg(F.sum("size").alias("total"), F.count_if(heavy).alias("heavy")).first()
    buckets = max(1, math.ceil((counts["total"] or 0) / bucket_bytes))
    if counts["heavy"]:
        keyed = spread(keyed, groups.where(heavy).select("_key"), counts["heavy"] <= BROADCAST_ROWS, seed)
    else:
        keyed = keyed.withColumn("_at", F.xxhash64(F.lit(seed), "_key"))
    scattered = keyed.withColumn("_bucket", F.pmod("_at", F.lit(buckets)).cast("int")).drop("_at", "_key")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    start = (
        scattered.groupBy("_bucket").agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    order = F.struct(F.xxhash64(F.lit(seed + 1), "doc_id").alias("h"), *docs.columns)
    full = (
        scattered.repartitionById(buckets, F.col("_bucket")).groupBy("_bucket").agg(F.collect_list(order).alias("_rows"))
        .select("_bucket", F.shuffle(F.sort_array("_rows"), seed).alias("_rows"))
    )
    placed = full.join(F.broadcast(start) if buckets <= BROADCAST_ROWS else start, "_bucket").select("_start", F.posexplode("_rows").alias("_i", "_row"))
    return placed.select(*[F.col("_row")[c].alias(c) for c in docs.columns], (F.col("_start") + F.col("_i")).alias("_g"))


def shard(docs: DataFrame, shards: int = 40, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every column of ``docs``, then size, text_crc32, law, shard, slot and grown_shard."""
    g = F.col("_g")
    return shuffled(docs, seed, bucket_bytes).select(
        "*", record_size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        F.pmod(g, F.lit(shards)).cast("int").alias("shard"), F.floor(g / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    ).drop("_g")


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 42) -> None:
    """Write the shards below ``path`` as ``shard=N`` folders, each file in slot order."""
    out = shard(docs, shards, seed)
    out.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
