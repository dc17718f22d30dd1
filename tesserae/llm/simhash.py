"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``RADIUS`` bits have a common variant within half of
it.  Emitting each fingerprint's whole half ball (2,081 variants of 64 bits)
finds every link, but writes over ten times the text.  So the pigeonhole
comes first: of two fingerprints that differ in 4 bits or fewer, one 32-bit
half differs in 2 or fewer, and there half the radius is 1.  Each fingerprint
emits the 33 variants of either half; those that share a variant meet in a
bucket, are compared in full, and a bucket returns a spanning forest of its
links, never its pairs.

A bucket of more than ``BUCKET`` members goes the exact way for crowds: its
fingerprints emit the whole half ball of 64-bit variants.  All that share one
are within the radius of each other, so a star needs no comparison, and no
variant has more than 2,081 takers.  Beyond ``HALVES`` distinct fingerprints
everything goes that way, as halves would then collide by chance too often.

Equal fingerprints are one class from the start.  Defined results: a null or
wordless text has fingerprint zero, linked like any other; repeated rows each
get a row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import join_hot, unused, without_cycles, written
from tesserae.llm.graph import components

RADIUS, SHINGLE, SEED = 4, 4, 42
BUCKET, HALVES = 512, 1 << 31


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of the text's word shingles, repeats included."""
    import xxhash

    hashed = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        hashes = [hashed(b" ".join(words), seed)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-width])).tolist()
        hashes = [hashed(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        part = np.array(hashes[k : k + 4096], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, ``t`` (a hash of the text) and ``fp``, the fingerprint as a signed long, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in without_cycles(batches):
            fps = np.array([fingerprint(x.as_py(), width, seed) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("t"), pa.array(fps.view(np.int64))], ["doc_id", "t", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").mapInArrow(run, "doc_id long, t long, fp long")


def half_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key`` (which half, and a variant of it within one bit) and ``fp``."""
    flips = np.concatenate(([0], 1 << np.arange(32, dtype=np.int64)))
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            fp = batch.slice(at, 1000).column("fp").to_numpy()
            bits = fp.view(np.uint64)
            halves = ((bits & np.uint64(0xFFFFFFFF)).astype(np.int64), (bits >> np.uint64(32)).astype(np.int64) )
            key = np.concatenate([((h[:, None] ^ flips) | (k << 32)).ravel() for k, h in enumerate(halves)])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.tile(np.repeat(fp, 33), 2))], ["key", "fp"])


def ball_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key`` (a variant within two bits of the whole fingerprint) and ``fp``."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    flips = np.concatenate((np.zeros(1, np.uint64), one, one[i] | one[j]))
    for batch in batches:
        for at in range(0, batch.num_rows, 50):
            fp = batch.slice(at, 50).column("fp").to_numpy()
            key = (fp.view(np.uint64)[:, None] ^ flips).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(fp, len(flips)))], ["key", "fp"])


def runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, bool]]:
    """The ``fp`` of each key with two rows or more, from batches sorted by key.

    A key of more than ``most`` rows comes in pieces of bounded size, marked as
    crowded; all other keys come whole.
    """
    key, fp, crowded = np.empty(0, np.int64), np.empty(0, np.int64), False
    for batch in batches:
        key = np.concatenate((key, batch.column("key").to_numpy()))
        fp = np.concatenate((fp, batch.column("fp").to_numpy()))
        if not len(key):
            continue
        begins = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        sizes = np.diff(begins)
        for k in range(len(sizes) - 1) if crowded else np.flatnonzero(sizes[:-1] > 1):
            if sizes[k] > 1 or crowded and not k:
                yield fp[begins[k] : begins[k + 1]], sizes[k] > most or crowded and not k
        crowded &= len(sizes) == 1
        key, fp = key[begins[-2] :], fp[begins[-2] :]
        if len(key) > most:  # one row stays behind to know the key by
            yield fp, True
            key, fp, crowded = key[-1:], fp[-1:], True
    if len(fp) > 1:
        yield fp, crowded or len(fp) > most


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``fps``."""
    fps = np.unique(fps)
    bits, todo, a, b = fps.view(np.uint64), np.ones(len(fps), bool), [], []
    for seed in range(len(fps)):
        if not todo[seed]:
            continue
        todo[seed], front = False, [seed]
        while front:
            x = front.pop()
            near = np.flatnonzero(todo & (np.bitwise_count(bits ^ bits[x]) <= radius))
            todo[near] = False
            a += [fps[x]] * len(near)
            b += fps[near].tolist()
            front += near.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, halves: int = HALVES) -> DataFrame:
    """Edges ``a``, ``b`` among the distinct ``fp``, enough to connect all that are linked."""
    schema = "a long, b long"

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of a bucket; of a crowd, each member beside a null."""
        for members, crowded in runs(batches, bucket):
            a, b = (members, None) if crowded else forest(members, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)], ["a", "b"])

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members, _ in runs(batches, 1 << 20):
            members = np.unique(members)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(members[:1], len(members) - 1)), pa.array(members[1:])], ["a", "b"])

    def crowds(some: DataFrame) -> DataFrame:
        at = some.mapInArrow(ball_variants, "key long, fp long")
        return at.repartition("key").sortWithinPartitions("key").mapInArrow(star, schema).distinct()

    if fps.count() > halves:
        return crowds(fps)
    at = fps.mapInArrow(half_variants, "key long, fp long").repartition("key").sortWithinPartitions("key")
    first = written(at.mapInArrow(meet, schema).distinct(), "links")
    crowded = written(first.where("b is null").select(F.col("a").alias("fp")).distinct(), "crowds")
    sure = first.where("b is not null")
    return sure.unionByName(crowds(crowded)) if crowded.take(1) else sure


def placed(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, t, fp, and component_id and component_t, which name the first row of the component: smallest id (null last), then hash."""
    rows = written(fingerprints(docs, width, seed), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
    classes = rows.groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("n"))
    linked = components(links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    classes = written(classes.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "classes")
    roots = classes.groupBy("root").agg(F.min("first").alias("top"), F.count("*").alias("members"))
    roots = written(roots.select("root", "members", F.col("top.doc_id").alias("component_id"), F.col("top.t").alias("component_t")), "roots")
    known = written(join_hot(classes.select("fp", "n", "root"), roots, "root", "members").select("fp", "n", "component_id", "component_t"), "known")
    return join_hot(rows, known, "fp", "n").select("doc_id", "t", "fp", "component_id", "component_t")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, one row for each row of ``docs``."""
    return placed(docs, radius, width, seed).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, broadcast_rows: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest id stays, once.

    Rows are told apart by id (a null is an id like any other, and the last)
    and text, so that ids need not be unique.
    """
    found = written(placed(docs).drop("fp"), "components")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("t") == F.col("component_t"))
    gone = found.where(~stays).select(F.col("doc_id").alias("_gone"), F.col("t").alias("_gone_t")).distinct()
    if gone.limit(broadcast_rows + 1).count() <= broadcast_rows:  # 16 bytes each
        gone = F.broadcast(gone)
    left = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_gone_t"]), "left_anti")
    again = found.where(stays).groupBy("doc_id", "t").count().where("count > 1")
    if again.take(1):
        t = unused("_t", docs)
        left = left.withColumn(t, F.xxhash64("text")).dropDuplicates(["doc_id", t]).drop(t)
    return left
