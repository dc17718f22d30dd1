"""Decontamination, quality rules and sharding."""

import hashlib
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tesserae.llm import decontaminate, quality, sharding
from tests.llm.cases import PASSAGE, ROWS, documents, empty

ITEMS = [(1, PASSAGE), (2, PASSAGE.replace("seven", "eight")), (3, "naïve façade"), (4, None), (5, "..."), (None, PASSAGE), (6, "eleven"), (1, PASSAGE)]


def lowered(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, least=2):
    wins = {}
    for i, t in items:
        if i is not None:
            w = lowered(t)
            for k in range(len(w) - min(len(w), 8) + 1 if w else 0):
                wins.setdefault(tuple(w[k : k + 8]), set()).add(str(i))
    out = []
    for d, t, *_ in rows:
        w, hit, ids = lowered(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if got := wins.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    ids |= got
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), len(ids) >= least))
    return sorted(out, key=str)


def test_decontaminate(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute(ROWS, ITEMS)
    assert sum(r[2] for r in want) > 20
    for limit in (10**6, 0):  # the tables broadcast, and not
        got = decontaminate.decontaminate(documents(spark), items, broadcast_windows=limit).collect()
        assert sorted(map(tuple, got), key=str) == want
    kept = decontaminate.clean(documents(spark), items, min_items=1)
    assert kept.columns == documents(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r[0] or 0 for r in ROWS if r[0] is None or not next(w[3] for w in want if w[0] == r[0]))


def test_clean_tells_rows_by_id_and_text(spark):
    leaked = "one two three four five six seven eight nine"
    rows = [(1, f"well {leaked}"), (1, "clean"), (None, leaked), (None, "clean too"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = decontaminate.clean(docs, spark.createDataFrame([(1, leaked)], "item_id long, text string"), min_items=1).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == [("1", "clean"), ("None", "None"), ("None", "clean too")]


def test_decontaminate_empty(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.decontaminate(empty(spark), items).count() == 0
    got = decontaminate.decontaminate(documents(spark), items.where("item_id > 99")).collect()
    assert len(got) == len(ROWS) and not any(r.contaminated or r.n_hit for r in got)


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    got = quality.assess(documents(spark)).collect()
    want = [(r[0], *measures(r[1])) for r in ROWS]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert {r.doc_id for r in got if r.kept} >= {1, 5}
    names = quality.order(documents(spark))
    assert sorted(names) == sorted(quality.rules(F.col("text"), F.col("words")))
    assert {r.doc_id for r in quality.keep(documents(spark), names).collect()} == {r.doc_id for r in got if r.kept}
    assert sorted(map(str, quality.assess(documents(spark), list(reversed(names))).collect())) == sorted(map(str, got))
    assert quality.assess(empty(spark)).count() == 0


def test_sharding(spark):
    got = sharding.shard(documents(spark), shards=4, bucket_bytes=3000)
    assert {"lang", "source", "score", "shard", "slot"} <= set(got.columns)
    rows = got.collect()
    assert sorted(str((r.doc_id, r.text)) for r in rows) == sorted(str(r[:2]) for r in ROWS)
    by = Counter(r.shard for r in rows)
    assert max(by.values()) - min(by.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in by.items())
    for r in rows:
        data = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
    again = sharding.shard(documents(spark).repartition(3), shards=4, bucket_bytes=3000).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert sharding.shard(empty(spark)).count() == 0
    many = spark.range(5000).selectExpr("id doc_id", "'copy' text")
    order = [r.doc_id for r in sharding.shard(many, 7).orderBy("shard", "slot").collect()]
    assert sorted(order) == list(range(5000)) and order != sorted(order)


def test_cascade_leaves_work_out(spark):
    """Rules after the one that rejects never run: the last here fails on any text that it sees."""
    text = F.col("text")
    trap = {"few_words": F.size(quality.words(text)) < 10, "trap": F.raise_error(F.lit("evaluated")).cast("boolean")}
    few = spark.createDataFrame([(1, "too few"), (2, "")], "doc_id long, text string")
    assert few.where(~quality.rejected(["few_words", "trap"], trap)).count() == 0
    plan = quality.keep(documents(spark), list(quality.rules(text, text)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Filter") and plan.count("Filter ") == 1 and "Project" not in plan  # no measure is taken before the cascade


def test_sharding_is_one_order(spark):
    """Equal results whatever the partitions, with and without adaptive plans, and with repeated rows that fill buckets."""
    rows = [(i % 400, f"text {i % 400} " + "pad " * (i % 50), i % 3) for i in range(1200)] + [(None, "a copy", 0)] * 700 + [(7, "b copy " * 30, k % 2) for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size int")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    seen = []
    try:
        for n, adaptive in (("1", "true"), ("4", "false"), ("7", "true"), ("200", "true"), ("7", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            got = sharding.shard(docs.repartition(int(n) % 5 + 1), 7, bucket_bytes=20_000).collect()
            seen.append(sorted((r.shard, r.slot, str(r.doc_id), r.text) for r in got))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(seen[0]) == len(rows) and all(x == seen[0] for x in seen[1:])
    assert sorted((d, t) for _, _, d, t in seen[0]) == sorted((str(d), t) for d, t, _ in rows)
    copies = Counter(s // 20 for _, s, d, _ in seen[0] if d == "None")
    assert len(copies) > 10  # spread over the whole order


def test_write_shards(spark, tmp_path):
    sharding.write_shards(documents(spark), f"file://{tmp_path}/out", 3)
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == len(ROWS)
