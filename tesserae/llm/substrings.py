"""Exact substring deduplication over a logarithmic family of suffix arrays.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a
document with a smaller id.  All strings of that length are judged on the
input; matches never cross documents.

Full suffix arrays hold a hundred times the text, so suffixes are sampled by
content: of the ``GRAM``-byte grams of a string the one with the least hash is
its anchor.  Equal strings have equal anchors, and the strings of one anchor
lie side by side; they travel together as one stretch of at most 88 bytes to
the bucket of the anchor's hash.  A scanning task settles stretches that it
meets again itself and sends each once, so a passage in a third of all
documents costs a bucket one row for each task, not for each document.

A bucket takes its stretches in order of ids.  Equal stretches need no search.
For the rest, what stands for them in an index is a suffix array (the sorted
suffixes, cut at ``LENGTH`` bytes, with the smallest id of each): every batch
is sorted, merge-scanned against the levels of the family for strings that an
earlier batch holds, and added; levels of equal size merge geometrically.

Defined results: a null or empty text has no bytes; rows without an id keep
all their bytes and remove none; repeated rows have one id, so none is the
source of another; texts under one id are told apart by their contents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import without_cycles

LENGTH, GRAM = 50, 12
SPAN = LENGTH - GRAM + 1  # grams in a string
WIDTH = 11  # a stretch in 64-bit words
HALF = 31  # bytes that two stretches with a common string share on one side of the anchor
#: Bytes of text that a scanning task holds at once, and that a bucket stands for.
BUFFER, BUCKET = 8 << 20, 8 << 20
#: Strings of a batch of the index.
BATCH = 1 << 16

ROW = np.dtype([("words", "<u8", WIDTH), ("doc", "<i8"), ("text", "<i8"), ("at", "<i8"), ("left", "u1"), ("n", "u1")])
FLAG = np.dtype([("doc", "<i8"), ("text", "<i8"), ("at", "<i8"), ("n", "u1")])
ODD = (np.arange(1, 2 * WIDTH, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def eights(data: np.ndarray, n: int) -> np.ndarray:
    """At each of the first ``n`` places the eight bytes from there as a number; ``data`` is padded."""
    out = np.empty(n + 8, np.uint64)
    for k in range(8):
        part = data[k : k + (len(data) - k) // 8 * 8].view("<u8")
        out[k::8] = part[: len(out[k::8])]
    return out[:n]


def pieces(data: bytes, size: int = BUFFER) -> Iterator[tuple[int, bytes]]:
    """A text in parts of ``size`` bytes and where each begins; every string of ``LENGTH`` bytes is in one of them, and in one alone."""
    step = size - LENGTH + 1
    for at in range(0, max(1, len(data) - LENGTH + 1), step):
        yield at, data[at : at + size]


def stretches(texts: list[bytes], docs: np.ndarray, hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (``ROW``) of every anchor of the texts, each of which begins at ``begins`` in its document, and the hash of its gram."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    starts = np.concatenate([np.arange(e - s, e - LENGTH + 1, dtype=np.int32) for e, s in zip(end.tolist(), size.tolist(), strict=True) if s >= LENGTH] or [np.empty(0, np.int32)])
    if not len(starts):
        return np.empty(0, ROW), np.empty(0, np.uint64)
    data = np.frombuffer(b"".join(texts) + bytes(8 * WIDTH + 64), np.uint8)
    eight = eights(data, total + 8 * WIDTH + 8)
    grams = lambda at: mixed(eight[at] * np.uint64(0xC2B2AE3D27D4EB4F) + eight[at + GRAM - 8] * np.uint64(0x165667B19E3779F9))
    place = np.uint64((1 << 28) - 1)
    least = np.empty(total + 40, np.uint64)
    for k in range(0, len(least), 1 << 20):  # in parts, as each step makes new arrays
        at = np.arange(k, min(k + (1 << 20), len(least)))
        least[k : k + (1 << 20)] = (grams(at) & ~place) | at.astype(np.uint64)
    done = 1
    while 2 * done <= SPAN:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    rest = SPAN - done
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    anchor = (least[starts] & place).astype(np.int32)
    del least
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1))))
    n = np.diff(np.append(new, len(starts)))
    at, anchor = starts[new].astype(np.int64), anchor[new].astype(np.int64)
    owner = np.searchsorted(end, at, "right")
    rows = np.empty(len(at), ROW)
    length = n + LENGTH - 1
    for k in range(WIDTH):
        keep = np.clip(length - 8 * k, 0, 8).astype(np.uint64)
        mask = np.where(keep == 8, ~np.uint64(0), (np.uint64(1) << (keep * np.uint64(8))) - np.uint64(1))
        rows["words"][:, k] = eight[at + 8 * k] & mask
    rows["doc"], rows["text"], rows["at"] = docs[owner], hashes[owner], at - (end - size)[owner] + begins[owner]
    rows["left"], rows["n"] = anchor - at, n
    return rows, grams(anchor)


def first_of_each(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are in the smallest document that has their stretch, and which are in a larger one."""
    key = (rows["words"] * ODD).sum(1, dtype=np.uint64) ^ (rows["left"].astype(np.uint64) << np.uint64(8)) ^ rows["n"]
    order = np.lexsort((rows["at"], rows["doc"], key))
    words, n = rows["words"][order], rows["n"][order]
    same = np.concatenate(([False], (key[order][1:] == key[order][:-1]) & (words[1:] == words[:-1]).all(1) & (n[1:] == n[:-1]) & (rows["left"][order][1:] == rows["left"][order][:-1])))
    group = np.flatnonzero(~same)[np.cumsum(~same) - 1]
    later = rows["doc"][order] > rows["doc"][order][group]
    return order[~later], order[later]


def flags(rows: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), FLAG)
    for name in FLAG.names:
        out[name] = rows[name]
    return out


class Family:
    """Suffix arrays of strings of one length with the smallest document of each, in levels of geometric sizes."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def scan(own: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in either of two sorted arrays, each without repeats, of the strings that both hold: one scan over their merge."""
        order = np.argsort(np.concatenate((own, have)), kind="stable")  # two sorted runs, which it merges
        here = order < len(own)
        value = np.concatenate((own, have))[order]
        both = np.flatnonzero(here[:-1] & ~here[1:] & (value[:-1] == value[1:]))
        return order[both], order[both + 1] - len(own)

    def add(self, strings: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Index a batch whose documents are no smaller than all before; returns the smallest document of each string."""
        order = np.lexsort((docs, strings))
        sorted_ = strings[order]
        new = np.concatenate(([True], sorted_[1:] != sorted_[:-1]))
        own, low = sorted_[new], docs[order][new]
        for have, have_low in self.levels:
            mine, theirs = self.scan(own, have)
            low[mine] = np.minimum(low[mine], have_low[theirs])
        least = np.empty_like(docs)
        least[order] = low[np.cumsum(new) - 1]
        self.levels.append((own, low))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            both, lows = np.concatenate((b, a)), np.concatenate((y, x))
            order = np.argsort(both, kind="stable")  # two sorted runs: a merge
            both, lows = both[order], lows[order]
            new = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
            self.levels.append((both[new], np.minimum.reduceat(lows, new)))
        return least


def settled(rows: np.ndarray) -> Iterator[np.ndarray]:
    """Flags of all strings of a bucket's stretches that start in a smaller document."""
    if not len(rows):
        return
    rows = rows[np.argsort(rows["doc"], kind="stable")]
    first, later = first_of_each(rows)
    yield flags(rows[later])
    rows = rows[np.sort(first)]
    data = np.concatenate((rows["words"].view(np.uint8).reshape(len(rows), 8 * WIDTH), np.zeros((len(rows), HALF), np.uint8)), 1)
    left, n = rows["left"].astype(np.int64), rows["n"].astype(np.int64)
    weights = (np.arange(1, 2 * HALF, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x5851F42D4C957F2D)
    reach = HALF - GRAM  # bytes before the anchor on its left side

    def shared(begin: np.ndarray, usable: np.ndarray) -> np.ndarray:
        """Of the usable rows, those whose ``HALF`` bytes from ``begin`` another document has too."""
        at = np.flatnonzero(usable)
        key = np.empty(len(at), np.uint64)
        for k in range(0, len(at), 50_000):
            i = at[k : k + 50_000]
            key[k : k + 50_000] = (data[i[:, None], begin[i][:, None] + np.arange(HALF)].astype(np.uint64) * weights).sum(1, dtype=np.uint64)
        order = np.lexsort((rows["doc"][at], key))
        k, d = key[order], rows["doc"][at][order]
        new = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
        size = np.diff(np.append(new, len(k)))
        return at[order[np.repeat(d[new] != d[new + size - 1], size)]] if len(k) else at

    lefts = shared(left - reach, left >= reach)
    rights = shared(left, left + HALF <= n + LENGTH - 1)
    # strings that begin ``reach`` bytes or more before the anchor hold its left side, all others its right
    owner, offset = [], []
    for some, lo, hi in ((lefts, np.zeros(len(lefts), np.int64), np.minimum(left[lefts] - reach + 1, n[lefts])), (rights, np.maximum(left[rights] - reach + 1, 0), n[rights])):
        size = np.maximum(hi - lo, 0)
        owner.append(np.repeat(some, size))
        offset.append(np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size))
    owner, offset = np.concatenate(owner), np.concatenate(offset)
    order = np.argsort(owner, kind="stable")  # rows are in the order of their documents
    owner, offset = owner[order], offset[order]
    family = Family()
    for k in range(0, len(owner), BATCH):
        i, o = owner[k : k + BATCH], offset[k : k + BATCH]
        strings = np.ascontiguousarray(data[i[:, None], o[:, None] + np.arange(LENGTH)]).view(f"S{LENGTH}").ravel()
        docs = rows["doc"][i]
        hit = family.add(strings, docs) < docs
        out = flags(rows[i[hit]])
        out["at"] += o[hit]
        out["n"] = 1
        yield out


def pack(rows: np.ndarray, gone: np.ndarray, level: int = 7) -> bytes:
    """Column by column, as neighbours then resemble each other; stretches without their padding."""
    inside = np.arange(8 * WIDTH) < (rows["n"].astype(np.int64) + LENGTH - 1)[:, None]
    parts = [np.array([len(rows), len(gone)], "<i8"), *(np.ascontiguousarray(a[name]) for a in (rows, gone) for name in a.dtype.names if name != "words")]
    parts.append(np.ascontiguousarray(rows["words"]).view(np.uint8).reshape(len(rows), 8 * WIDTH)[inside])
    return zstandard.ZstdCompressor(level).compress(b"".join(x.tobytes() for x in parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 16, []
    for kind, n in zip((ROW, FLAG), np.frombuffer(raw[:16], "<i8").tolist(), strict=True):
        rows = np.zeros(n, kind)
        for name in kind.names:
            if name != "words":
                size = kind[name].itemsize * n
                rows[name] = np.frombuffer(raw[at : at + size], kind[name])
                at += size
        out.append(rows)
    padded = np.zeros((len(out[0]), 8 * WIDTH), np.uint8)
    padded[np.arange(8 * WIDTH) < (out[0]["n"].astype(np.int64) + LENGTH - 1)[:, None]] = np.frombuffer(raw[at:], np.uint8)
    out[0]["words"] = padded.view("<u8")
    return out


def scanned(buckets: int, told_apart: bool):
    """For mapInArrow: documents to rows (bucket, packed stretches and flags)."""

    def one(texts: list[bytes], docs: list[int], hashes: list[int], begins: list[int]) -> pa.RecordBatch:
        order = np.argsort(np.array(docs, np.int64), kind="stable")
        rows, grams = stretches([texts[i] for i in order], *(np.array(x, np.int64)[order] for x in (docs, hashes, begins)))
        first, later = first_of_each(rows)
        to = ((grams & np.uint64(0xFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        gone = flags(rows[later])
        first, later_to = first[np.lexsort((rows["doc"][first], to[first]))], to[later]
        kept, kept_to = rows[first], to[first]
        order = np.argsort(later_to, kind="stable")
        gone, later_to = gone[order], later_to[order]
        names = np.union1d(kept_to, later_to)
        cut = lambda a, x: np.split(a, np.searchsorted(x, names[1:])) if len(names) else []
        blobs = [pack(a, b) for a, b in zip(cut(kept, kept_to), cut(gone, later_to), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, docs, hashes, begins, held = [], [], [], [], 0
        for batch in without_cycles(batches):
            for doc, h, text in zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist(), (x.as_py() for x in batch.column("text")), strict=True):
                for begin, data in pieces(text.encode("utf-8", "surrogatepass")):
                    if held and held + len(data) > BUFFER:
                        yield one(texts, docs, hashes, begins)
                        texts, docs, hashes, begins, held = [], [], [], [], 0
                    if len(data) >= LENGTH:
                        texts.append(data)
                        docs.append(doc)
                        hashes.append(h if told_apart else 0)
                        begins.append(begin)
                        held += len(data)
        if texts:
            yield one(texts, docs, hashes, begins)

    return run


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow, rows sorted by bucket: (doc, text, at) of what is to go; ``at`` also holds the number of strings."""

    def out(f: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(f), 100_000):
            x = f[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(x["doc"]), pa.array(x["text"]), pa.array((x["at"] << 8) | x["n"])], ["doc", "text_hash", "at"])

    now, held = None, []
    for batch in without_cycles(batches):
        for bucket, data in zip(batch.column("bucket").to_pylist(), (x.as_py() for x in batch.column("data")), strict=True):
            if bucket != now and held:
                for f in settled(np.concatenate(held)):
                    yield from out(f)
                held = []
            now = bucket
            rows, gone = unpack(data)
            held.append(rows)
            yield from out(gone)
    if held:
        for f in settled(np.concatenate(held)):
            yield from out(f)


def kept(data: bytes, at: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the number of removed runs."""
    if not len(at):
        return data, 0, 0
    begin, n = at >> 8, at & 255
    change = np.bincount(begin, minlength=len(data) + 1) - np.bincount(begin + n + LENGTH - 1, minlength=len(data) + 1)
    gone = np.cumsum(change[: len(data)]) > 0
    left = np.frombuffer(data, np.uint8)[~gone].tobytes()
    return left, int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: ``text`` as compressed bytes, for the way to its marks."""
    press = zstandard.ZstdCompressor(3)
    for batch in batches:
        for k in range(0, batch.num_rows, 1000):
            part = batch.slice(k, 1000)
            z = [None if (x := t.as_py()) is None else press.compress(x.encode("utf-8", "surrogatepass")) for t in part.column("text")]
            yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(z, pa.binary()))


def schema(df: DataFrame, **other: str) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema} | other
    return ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())


def marked(docs: DataFrame, bucket_bytes: int = BUCKET) -> DataFrame:
    """``docs`` with compressed ``text`` and ``_at``, the packed strings to remove of each row."""
    spark = docs.sparkSession
    named = docs.where("doc_id is not null")
    twice = bool(named.groupBy("doc_id").count().where("count > 1").take(1))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (1 << 18))))
    t = F.xxhash64("text") if twice else F.lit(0).cast("long")
    sent = named.where("text is not null").select(F.col("doc_id").cast("long"), t.alias("t"), "text").mapInArrow(scanned(buckets, twice), "bucket int, data binary")
    found = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(searched, "doc long, text_hash long, at long")
    at = found.groupBy("doc", "text_hash").agg(F.collect_list("at").alias("_at"))
    keyed = docs.withColumn("_t", t)
    keyed = keyed.mapInArrow(squeezed, schema(keyed, text="binary"))
    return keyed.join(at, (F.col("doc_id").cast("long") == F.col("doc")) & (F.col("_t") == F.col("text_hash")), "left").drop("doc", "text_hash", "_t")


def applied(rows: DataFrame, kinds: str, make) -> DataFrame:
    """``make(batch, texts, [(left, n_removed, n_spans)])`` for the rows of ``marked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts = [press.decompress(z) if (z := x.as_py()) is not None else None for x in part.column("text")]
                yield make(part, texts, [kept(x or b"", at.values.to_numpy() if at.is_valid else np.empty(0, np.int64)) for x, at in zip(texts, part.column("_at"), strict=True)])

    return rows.mapInArrow(run, kinds)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256, one row for each row of ``docs``."""

    def make(part: pa.RecordBatch, texts: list, done: list) -> pa.RecordBatch:
        left, removed, spans = zip(*done, strict=True)
        size = pa.array([len(x or b"") for x in texts], pa.int64())
        cols = [size, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in left])]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *cols], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = marked(docs.select(F.col("doc_id").cast("long"), "text"))
    return applied(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", make)


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with ``kept``, the bytes of each text that stay."""
    docs = docs.drop("kept", "_at", "_t")

    def make(part: pa.RecordBatch, texts: list, done: list) -> pa.RecordBatch:
        text = pa.array([None if x is None else x.decode("utf-8", "surrogatepass") for x in texts], pa.string())
        cols = {n: text if n == "text" else part.column(n) for n in part.schema.names if n != "_at"}
        return pa.RecordBatch.from_arrays([*cols.values(), pa.array([x[0] for x in done], pa.binary())], [*cols, "kept"])

    return applied(marked(docs), schema(docs, kept="binary"), make)
