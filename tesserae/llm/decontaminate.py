"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item becomes windows of ``size`` consecutive words (an item of fewer words
is one window).  A window is the set of its word shingles with their offsets.
Containment of the whole set needs one prefix token: the shingle that the
documents hold least often.  Documents meet the windows on that token alone;
the positional bound drops places where the window would not fit, in the words
around the token and so in a document that is too short for it, and the words
are then compared exactly.

Words: A-Z in lower case, then runs of ``[0-9a-z]`` and all beyond ASCII.
The documents are scanned once; where they hold a token is kept with the words
around it, and both the tokens' frequencies and the comparison come from that.
Defined results: a null or wordless text has
no words and no hits; a null item id or text is no item; items with the same
id are one item; repeated documents get equal results; no benchmark, no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tesserae.llm.common import written

#: What lies between words, after A-Z became a-z.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE = 3
#: Windows up to which they are broadcast, and the bytes of their words and items.
BROADCAST_WINDOWS, BROADCAST_BYTES = 400_000, 64 << 20


def words(text: Column) -> Column:
    """The lower-cased words; null for a null text."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), NOT_WORD, -1), "")


def shingle(ws: str, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(ws, at + F.lit(k)) for k in range(width)])


def windows(items: DataFrame, size: int) -> DataFrame:
    """A row for each distinct window: ``_window`` (its words, joined), ``_len``, ``_items`` and ``_ws`` (its words)."""
    n = F.size("_all")
    length = F.least(n, F.lit(size))
    rows = (
        items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .select("item_id", words(F.col("text")).alias("_all")).where(n > 0)
        .select("item_id", "_all", length.alias("_len"), F.explode(F.sequence(F.lit(1), n - length + 1)).alias("_at"))
        .select("item_id", "_len", F.slice("_all", F.col("_at"), F.col("_len")).alias("_ws"))
    )
    return rows.groupBy("_ws", "_len").agg(F.collect_set(F.col("item_id").cast("string")).alias("_items")).withColumn("_window", F.concat_ws(" ", "_ws"))


def candidates(docs: DataFrame, tokens: DataFrame, widths: list[int], size: int, small: bool) -> DataFrame:
    """One scan of the documents: where each holds a token, with the words around it.

    Every document also has a row at place 0 that carries its number of words.
    """
    ws = docs.select("doc_id", F.xxhash64("text").alias("_t"), F.concat(F.array(F.lit("")), F.coalesce(words(F.col("text")), F.array().cast("array<string>"))).alias("_ws"))
    at = ws.select("doc_id", "_t", "_ws", F.posexplode("_ws").alias("_p", "_w"))
    if len(widths) == 1:
        at = at.withColumn("_token", shingle("_ws", F.col("_p"), widths[0]))
    else:
        tokens_here = F.array(*[shingle("_ws", F.col("_p"), w) for w in widths])
        at = at.select("*", F.posexplode(tokens_here).alias("_j", "_token")).where("_p > 0 or _j = 0").drop("_j")
    first = F.col("_p") == 0
    begin = F.greatest(F.col("_p") - (size - 1), F.lit(1))
    near = F.when(~first, F.slice("_ws", begin + 1, F.col("_p") - begin + size))
    out = ["doc_id", "_t", "_p", "_token", (F.col("_p") - begin).alias("_before"), near.alias("_near"), F.when(first, F.size("_ws") - 1).alias("_n")]
    if small:
        held = at.join(F.broadcast(tokens.select("_token", F.lit(True).alias("_in"))), "_token", "left").where(first | F.col("_in"))
        return held.select(*out)
    # a place leaves its document with the words near it alone, as all its words would follow every one of them
    return at.where(~first).select(*out).join(tokens, "_token", "left_semi").select("doc_id", "_t", "_p", "_token", "_before", "_near", "_n").unionByName(at.where(first).select(*out))


def verdicts(docs: DataFrame, items: DataFrame, size: int = 8, min_items: int = 2, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """The rows of ``decontaminate`` with ``_t``, a hash of the text, and ``_whole``: whether a window of all ``size`` words was hit."""
    wins = windows(items, size)
    room = F.sum(F.octet_length("_window") + F.aggregate("_items", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x) + 16))
    sizes = wins.groupBy("_len").agg(F.count("*").alias("windows"), room.alias("room")).collect()  # a row for each window length up to ``size``
    widths = sorted({min(SHINGLE, r["_len"]) for r in sizes}) or [SHINGLE]
    small = sum(r["windows"] for r in sizes) <= broadcast_windows and sum(r["room"] for r in sizes) <= BROADCAST_BYTES
    width = F.least("_len", F.lit(SHINGLE))

    own = wins.select("*", F.explode(F.sequence(F.lit(0), F.col("_len") - width)).alias("_k"))
    own = own.select("_window", "_len", "_items", "_k", F.coalesce(*[F.when(width == w, shingle("_ws", F.col("_k"), w)) for w in widths]).alias("_token"))

    at = written(candidates(docs, own.select("_token").distinct(), widths, size, small), "decontaminate")
    seen = at.where(F.col("_n").isNull()).groupBy("_token").agg(F.count("*").alias("_df"))
    rarest = Window.partitionBy("_window", "_len").orderBy(F.coalesce("_df", F.lit(0)), "_k")
    prefix = (
        own.join(seen, "_token", "left").withColumn("_rank", F.row_number().over(rarest))
        .where((F.col("_rank") == 1) & F.col("_df").isNotNull()).select("_token", "_k", "_len", "_items", "_window")
    )

    start = F.col("_before") - F.col("_k")
    fits = (start >= 0) & (start + F.col("_len") <= F.size("_near"))
    same = F.concat_ws(" ", F.slice("_near", start + 1, F.col("_len"))) == F.col("_window")
    span = F.struct((F.col("_p") - F.col("_k")).alias("s"), F.col("_len").alias("n"))
    found = at.where(F.col("_n").isNull()).join(F.broadcast(prefix) if small else prefix, "_token").where(F.when(fits, same)).select("doc_id", "_t", span.alias("_span"), "_items")
    none = at.where(F.col("_n").isNotNull()).select("doc_id", "_t", "_n")
    covered = F.array_distinct(F.flatten(F.transform("_spans", lambda x: F.sequence(x["s"], x["s"] + x["n"] - 1))))
    return (
        none.unionByName(found, allowMissingColumns=True).groupBy("doc_id", "_t")
        .agg(F.max("_n").alias("n"), F.count("_n").alias("rows"), F.collect_set("_span").alias("_spans"), F.collect_set("_items").alias("_sets"))
        .withColumn("_ids", F.array_sort(F.array_distinct(F.flatten("_sets"))))
        .select(
            "doc_id", "_t", F.col("n").cast("long").alias("n_words"), F.size(covered).cast("long").alias("n_hit"), F.size("_ids").cast("long").alias("n_items"),
            F.sha2(F.array_join("_ids", ","), 256).alias("items_sha256"), (F.size("_ids") >= min_items).alias("contaminated"),
            F.exists("_spans", lambda x: x["n"] == size).alias("_whole"),
            F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_copy"),
        ).drop("_copy")
    )


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 8, min_items: int = 2, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return verdicts(docs, items, size, min_items, broadcast_windows).drop("_t", "_whole")


def clean(docs: DataFrame, items: DataFrame, size: int = 8, min_items: int = 2, broadcast_rows: int = 2_000_000, short_items: int = 0) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, told by id (null or not) and text.

    Where all hits are items shorter than a window, ``short_items`` are needed at least.
    """
    found = verdicts(docs, items, size, min_items).where(F.col("contaminated") & (F.col("_whole") | (F.col("n_items") >= short_items)))
    bad = written(found.select(F.col("doc_id").alias("_bad"), F.col("_t").alias("_bad_t")).distinct(), "contaminated")
    if bad.limit(broadcast_rows + 1).count() <= broadcast_rows:  # 16 bytes each
        bad = F.broadcast(bad)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]) & (F.xxhash64(docs["text"]) == bad["_bad_t"]), "left_anti")
