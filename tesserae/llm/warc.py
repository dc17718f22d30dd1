"""WARC archives with a Zstandard dictionary, and their reader.

A writing task fills archives of bounded size.  Each trains a dictionary on
records spread over itself, stores it in a leading skippable frame and then
compresses every record as a frame of its own, so a reader can start at any.
Equal payloads are stored once: the record of the largest page id is the
response, the others revisit it and carry the full payload's size and digest.

Archives lie in the shared folder under names that no other attempt uses; the
manifest, a table that only finished tasks add to, says which of them count.

Defined results: a null html is an empty payload, and empty payloads are equal
like others; a null page id is the smallest and stays null; repeated rows with
the largest id are all responses; a null url is left out; control characters
in a url are escaped; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import join_hot, shared_dir, written

#: The skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: Bytes of an archive's records before compression, of its dictionary, and of the records that it is trained on.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES = 16 << 20, 64 << 10, 2 << 20
DATE, LEVEL = "2024-01-01T00:00:00Z", 3
#: Groups of equal payloads up to which they are broadcast (about 70 bytes each).
BROADCAST_GROUPS = 200_000


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path that a folder's address means."""
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if "://" in path else path.replace("file:", "file://", 1))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    name = lambda i: f"<urn:x-page:{'' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on records spread evenly; of too few records, the first one's text itself."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r[: DICTIONARY_BYTES * 2] for r in records[::step]], level=LEVEL)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(records[0][:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes]) -> bytes:
    """A whole file: the dictionary's frame, a warcinfo record, the records."""
    about = b"software: tesserae\r\nformat: WARC File Format 1.1\r\n"
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\nContent-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (str(uuid.uuid4()).encode(), DATE.encode(), len(about), about)
    held = dictionary(records)
    data = held.as_bytes()
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(data)), data, *(press.compress(r) for r in [info, *records])])


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record of an archive."""
    magic, size = struct.unpack("<II", data[:8])
    at, held = 0, None
    if magic == DICTIONARY_FRAME:
        at, held = 8 + size, zstandard.ZstdCompressionDict(data[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=held).stream_reader(io.BytesIO(memoryview(data)[at:]), read_across_frames=True)
    with io.BufferedReader(reader, 1 << 20) as stream:
        while line := stream.readline():
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a record: {line[:40]!r}")
            head = {}
            while (line := stream.readline().rstrip(b"\r\n")) != b"":
                key, _, value = line.decode("utf-8", "surrogatepass").partition(":")
                head[key.lower()] = value.strip()
            yield head, stream.read(int(head["content-length"]))
            stream.read(4)


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html`` with ``_first``, the id of the response that a page revisits (null for a response)."""
    pages = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = pages.withColumn("_sha", F.when(F.octet_length("html") >= min_bytes, F.sha1(F.encode("html", "utf-8"))))
    groups = keyed.where("_sha is not null").groupBy("_sha").agg(F.max("page_id").alias("_top"), F.count("*").alias("_n")).where("_n > 1")
    if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        known = keyed.join(F.broadcast(groups), "_sha", "left")
    else:
        known = join_hot(keyed, groups, "_sha", "_n")
    revisits = F.col("_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top"))
    return known.select("page_id", "url", "html", F.when(revisits, F.col("_top")).alias("_first"))


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write the archives below ``path``; returns the manifest (``path``, ``records``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = place(path)
        files.create_dir(folder, recursive=True)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            name = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            with files.open_output_stream(name) as out:
                out.write(archive(held))
            return pa.RecordBatch.from_arrays([pa.array([f"{path}/{name.rpartition('/')[2]}"]), pa.array([len(held)], pa.int64())], ["path", "records"])

        for batch in batches:
            for page_id, url, html, first in zip(*(batch.column(c) for c in ("page_id", "url", "html", "_first")), strict=True):
                held.append(record(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "surrogatepass"), first.as_py(), first.is_valid))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return written(roles(pages, min_bytes).mapInArrow(run, "path string, records long"), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """A row for each page's record: page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null for a revisit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        page = lambda x: int(i) if x and (i := x.strip("<>").rpartition(":")[2]) else None
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            files, name = place(path)
            with files.open_input_stream(name) as f:
                data = f.read()
            rows = []
            for head, block in records(data):
                if (kind := head["warc-type"]) not in ("response", "revisit"):
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"{path}: a payload of page {head['warc-record-id']} has another digest")
                size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                rows.append((page(head["warc-record-id"]), head.get("warc-target-uri"), size, digest, kind, page(head.get("warc-refers-to")), payload if kind == "response" else None))
                if len(rows) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    n = max(1, min(manifest.count(), 10_000))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return manifest.select("path").repartition(n).mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each page, from archives written and read back."""
    manifest = write(pages, shared_dir(pages.sparkSession, "warc"))
    return read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
