"""Personal data: patterns with checks, and information-theoretic sanitisation of what gives them away.

Base spans are e-mail addresses, IP addresses, card and phone numbers.  Each
distinct value found is a protected entity.  Over the whole corpus the
documents that hold a term (word), an entity, and both are counted, and the
pointwise mutual information of term and entity,
``log(p(term, entity) / (p(term) p(entity)))``, is held against the entity's
own information ``-log p(entity)``.  A term that yields the share ``ALPHA`` of
it or more, in ``SUPPORT`` documents of the entity or more, discloses the
entity: wherever it stands in a document that holds the entity it is
generalised to its class, or, where it yields everything (``REMOVE``), removed.

Defined results: a null or empty text has no spans; repeated rows count as
documents and get equal results; null ids are kept; spans are code points, end
exclusive; a term inside a base span adds none and isn't counted there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import join_hot, unused, without_cycles, written

KINDS = ["email", "ip", "card", "phone"]
SUPPORT, ALPHA, REMOVE = 2, 0.9, 0.999
#: Terms up to which they are broadcast (about 40 bytes each).
BROADCAST_TERMS = 200_000
#: Spans up to which they are broadcast (about 100 bytes each with their documents).
BROADCAST_FOUND = 400_000

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = re.compile(r"[^\W_]+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long tokens cost no more than their length."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL_CHARS:
            begin -= 1
        m = DOMAIN.match(text, at) if begin < at else None
        if m:
            out.append((begin, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(index of the kind, start, end), in the order of kinds and starts."""
    text = text or ""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:].lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int, bool]]:
    """(lower-cased term, start, end, whether it is clear of all ``spans``) for each term of the text."""
    held = bytearray(len(text))
    for _, a, b in spans:
        held[a:b] = b"\1" * (b - a)
    for m in TERM.finditer(text):
        s, e = m.span()
        yield m[0].lower(), s, e, held.find(1, s, e) < 0


def find(docs: DataFrame) -> DataFrame:
    """One row for each base span, and one for each document, with a null kind.

    The latter holds the distinct ``entities`` of a document with any, its
    ``terms`` and those that it has ``inside`` base spans only.  ``doc_id, t``
    name the document.
    """
    schema = "doc_id long, t long, kind int, s int, e int, entities array<string>, terms array<string>, inside array<string>"
    words = pa.list_(pa.string())
    arrow = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("kind", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("entities", words), ("terms", words), ("inside", words)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in without_cycles(batches):
            rows = []
            for doc, t, text in zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist(), (x.as_py() for x in batch.column("text")), strict=True):
                if spans := base_spans(text):
                    seen: tuple[set, set] = (set(), set())
                    for term, _, _, clear in outside(text, spans):
                        seen[clear].add(term)
                    entities = {f"{KINDS[kind]} {text[s:e].lower()}" for kind, s, e in spans}
                    rows.append((doc, t, None, None, None, list(entities), list(seen[1]), list(seen[0] - seen[1])))
                    rows += [(doc, t, kind, s, e, None, None, None) for kind, s, e in spans]
                else:
                    rows.append((doc, t, *[None] * 6))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").mapInArrow(run, schema)


def pairs(found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """doc_id, t, copies (its rows), entity, n_entity and term: all terms of each distinct document with all its entities of ``support`` documents or more."""
    held = found.where("size(entities) > 0").groupBy("doc_id", "t").agg(F.count("*").alias("copies"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    each = held.select("doc_id", "t", "copies", F.explode("entities").alias("entity"))
    known = written(each.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("_rows")).where(F.col("n_entity") >= support), "entities")
    kept = join_hot(each, known, "entity", "_rows").where("n_entity is not null")
    kept = kept.groupBy("doc_id", "t").agg(F.collect_list(F.struct("entity", "n_entity")).alias("_kept")).select(F.col("doc_id").alias("_d"), F.col("t").alias("_t"), "_kept")
    both = held.join(kept, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")))
    return both.select("doc_id", "t", "copies", "terms", F.explode("_kept").alias("_e")).select("doc_id", "t", "copies", "_e.*", F.explode("terms").alias("term"))


def disclosing(beside: DataFrame, found: DataFrame, docs: DataFrame, support: int = SUPPORT, alpha: float = ALPHA) -> DataFrame:
    """``entity``, ``term``, ``share`` (of the entity's information that the term yields) and ``_rows``, from the ``pairs``."""
    both = beside.groupBy("entity", "n_entity", "term").agg(F.sum("copies").alias("n_both"), F.count("*").alias("_rows")).where(F.col("n_both") >= support)
    both = written(both, "pairs")
    wanted = both.select("term").distinct()
    few = wanted.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    words = F.array_distinct(F.filter(F.split(F.lower(F.regexp_replace("text", r"[^\p{L}\p{N}]+", " ")), " ", -1), lambda w: w != ""))
    seen = docs.where("text is not null").select(F.explode(words).alias("term"), F.lit(1).alias("n"))
    seen = seen.unionByName(found.select(F.explode("inside").alias("term"), F.lit(-1).alias("n")))
    seen = seen.join(F.broadcast(wanted), "term", "left_semi") if few else seen
    counts = seen.groupBy("term").agg(F.sum("n").alias("n_term"))
    total = docs.count()
    n_term = F.greatest(F.coalesce("n_term", F.col("n_both")), "n_both")
    share = F.try_divide(F.log(F.col("n_both") * F.lit(float(total)) / (n_term * F.col("n_entity"))), F.log(F.lit(float(total)) / F.col("n_entity")))
    return both.join(counts, "term", "left").select("entity", "term", share.alias("share"), "_rows").where(F.col("share") >= alpha)


def places(docs: DataFrame, told: DataFrame) -> DataFrame:
    """``_d, _t, terms``: where each distinct document holds the terms that ``told`` (doc_id, t, told) lists for it."""
    told = written(told.select(F.col("doc_id").alias("_d"), F.col("t").alias("_t"), "told"), "told")
    if (told.agg(F.sum(F.size("told"))).first()[0] or 0) <= BROADCAST_TERMS:
        told = F.broadcast(told)
    schema = "_d long, _t long, terms array<struct<s:int,e:int,share:double>>"
    arrow = pa.schema([("_d", pa.int64()), ("_t", pa.int64()), ("terms", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("share", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in without_cycles(batches):
            at = []
            for text, shares in zip((x.as_py() for x in batch.column("text")), (x.as_py() for x in batch.column("told")), strict=True):
                share = {x["term"]: x["share"] for x in shares}
                at.append([{"s": s, "e": e, "share": share[term]} for term, s, e, clear in outside(text, base_spans(text)) if clear and term in share])
            yield pa.RecordBatch.from_arrays([batch.column("_d"), batch.column("_t"), pa.array(at, arrow.field("terms").type)], schema=arrow)

    texts = docs.where("text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    both = texts.join(told, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t"))).select("_d", "_t", "text", "told")
    return both.mapInArrow(run, schema).dropDuplicates(["_d", "_t"])


def spans(docs: DataFrame, support: int = SUPPORT, alpha: float = ALPHA) -> DataFrame:
    """``doc_id, t, base, copies, terms``: a row for each distinct document, its number of rows and sorted arrays of its spans."""
    found = written(find(docs), "pii")
    base = found.groupBy("doc_id", "t").agg(F.sort_array(F.collect_set(F.when(F.col("kind").isNotNull(), F.struct("kind", "s", "e")))).alias("base"), F.count_if(F.col("kind").isNull()).cast("int").alias("copies"))
    beside = pairs(found, support)
    told = written(disclosing(beside, found, docs, support, alpha).select(F.struct("entity", "term").alias("pair"), "share", "_rows"), "disclosing")
    near = beside.select("doc_id", "t", F.struct("entity", "term").alias("pair"))
    if told.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        near = near.join(F.broadcast(told), "pair")
    else:
        near = join_hot(near, told, "pair", "_rows").where("share is not null")
    near = near.groupBy("doc_id", "t", F.col("pair.term").alias("term")).agg(F.max("share").alias("share"))
    terms = places(docs, near.groupBy("doc_id", "t").agg(F.collect_list(F.struct("term", "share")).alias("told")))
    return base.join(terms, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")), "left").drop("_d", "_t")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, the four counts, base_sha256 and spans, one row for each row of ``docs``."""
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.array_join(F.transform("base", lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    more = F.transform(F.coalesce("terms", F.array()), lambda x: F.concat_ws(":", F.lit("term"), x["s"].cast("string"), x["e"].cast("string")))
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return (
        spans(docs).select("doc_id", *[n(k) for k in range(4)], F.sha2(shown, 256).alias("base_sha256"),
                           F.array_join(F.concat(F.filter(F.array(shown), lambda x: x != ""), more), ",").alias("spans"), F.explode(F.sequence(F.lit(1), "copies")).alias("_c"))
        .drop("_c")
    )


def masked(text: str | None, base: list, terms: list) -> str | None:
    """The text with each base span as ``<KIND>`` and each disclosing term generalised or gone."""
    if not text:
        return text
    base, terms = ([] if x is None else list(x) for x in (base, terms))
    cuts = [(x["s"], x["e"], f"<{KINDS[x['kind']].upper()}>") for x in base]
    cuts += [(x["s"], x["e"], "" if x["share"] >= REMOVE else "<NUMBER>" if text[x["s"] : x["e"]].isdigit() else "<TERM>") for x in terms]
    out, at = [], 0
    for s, e, to in sorted(cuts, key=lambda c: (c[0], -c[1])):
        if s >= at:
            out += [text[at:s], to]
            at = e
        elif e > at:  # overlaps what has just been masked
            at = e
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` masked; all rows and columns stay."""
    name, d, t = (unused(x, docs) for x in ("_found", "_d", "_t"))
    found = spans(docs).where((F.size("base") > 0) | F.col("terms").isNotNull()).select(F.col("doc_id").alias(d), F.col("t").alias(t), F.struct("base", "terms").alias(name))
    found = written(found, "found")
    n = F.size(f"{name}.base") + F.size(F.coalesce(f"{name}.terms", F.array()))
    if (found.agg(F.sum(n)).first()[0] or 0) <= BROADCAST_FOUND:
        found = F.broadcast(found)
    both = docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found[d]) & (F.xxhash64(docs["text"]) == found[t]), "left")

    @F.pandas_udf("string")
    def mask(text: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
        return pd.Series([masked(x, b, t) for x, b, t in zip(text, base, terms, strict=True)], dtype=object)

    there = F.col(name).isNotNull()
    touched = both.where(there).withColumn("text", mask("text", f"{name}.base", f"{name}.terms"))
    return touched.unionByName(both.where(~there)).select(*docs.columns)
