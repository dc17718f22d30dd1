"""What the operators must not do: lose rows to clashing names, long texts, hubs or local folders; and stages against brute force."""

import hashlib
import math
import random
import re
from types import SimpleNamespace

import corpus_pipeline
import numpy as np
import pytest

from tesserae.llm import common, decontaminate, graph, pii, simhash, substrings
from tests.llm.test_dedup import classes, plain_simhash
from tests.llm.test_text import plain_spans

CLASHES = ["_gone", "_gone_t", "_bad", "_bad_t", "_d", "_t", "_found", "_FOUND_", "_hot", "_g", "t", "fp", "base", "terms", "score", "_e"]


def test_clashing_columns(spark):
    leaked = "one two three four five six seven eight nine"
    rows = [(1, "write to a.b@c.de please"), (2, "write to a.b@c.de please"), (3, leaked), (None, None)]
    names = [c for c in CLASHES if c.lower() not in {"_found"}] + ["_found"]
    names = [c for k, c in enumerate(names) if c.lower() not in {x.lower() for x in names[:k]}]
    docs = spark.createDataFrame([(d, t, *[f"{c}{d}" for c in names]) for d, t in rows], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names))
    items = spark.createDataFrame([(1, leaked)], "item_id long, text string")
    for out, ids in ((simhash.deduplicate(docs), {1, 3, None}), (decontaminate.clean(docs, items, min_items=1), {1, 2, None}), (pii.sanitise(docs), {1, 2, 3, None})):
        got = out.collect()
        assert out.columns == docs.columns and {r.doc_id for r in got} == ids and len(got) == len(ids)
        assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in names)


def test_long_texts_in_parts():
    data = bytes(random.Random(1).randbytes(1000))
    for size in (50, 51, 64, 200, 999, 1000, 5000):
        seen = [at + k for at, part in substrings.pieces(data, size) for k in range(len(part) - substrings.LENGTH + 1)]
        assert sorted(seen) == list(range(951)) and all(data[at : at + len(part)] == part for at, part in substrings.pieces(data, size))
    assert list(substrings.pieces(b"short", 50)) == [(0, b"short")]


def test_parts_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    shared = "".join(rng.choice("abcdef ") for _ in range(700))
    texts = ["".join(rng.choice("ghijkl ") for _ in range(2000)) + shared + str(k) for k in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(map(tuple, substrings.digest(docs).collect()))
    assert all(r[2] >= 700 for r in want[1:])
    real = substrings.pieces
    monkeypatch.setattr(substrings, "pieces", lambda data, size=None: real(data, 333))
    batches = docs.withColumn("t", docs.doc_id * 0).toArrow().to_batches()
    found = [substrings.unpack(x.as_py()) for b in substrings.scanned(1, False)(iter(batches)) for x in b.column("data")]
    flags = [gone for _, gone in found] + list(substrings.settled(np.concatenate([rows for rows, _ in found])))
    gone = {k: set() for k in range(4)}
    for f in flags:
        for doc, at, n in zip(f["doc"].tolist(), f["at"].tolist(), f["n"].tolist(), strict=True):
            gone[doc] |= set(range(at, at + n + substrings.LENGTH - 1))
    assert [len(gone[k]) for k in range(4)] == [r[2] for r in want]


def test_hubs_split(spark, monkeypatch):
    edges = [(0, k) for k in range(1, 60)] + [(k, k + 100) for k in range(1, 30)] + [(500, 501), (501, 502)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = sorted(map(tuple, graph.components(df).collect()))
    monkeypatch.setattr(graph, "SPLIT_EDGES", 0)
    assert sorted(map(tuple, graph.components(df).collect())) == want
    assert {r for n, r in want if n < 500} == {0} and {r for n, r in want if n >= 500} == {500}


def test_a_cluster_must_name_its_folder():
    session = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None, set=lambda *_: None), sparkContext=SimpleNamespace(master=master))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            common.shared_dir(session(master), "x")
    assert common.shared_dir(session("local[4]"), "x").startswith("file:")


def brute_terms(rows):
    """Places of disclosing terms by the definition, for (doc_id, text) rows."""
    words = lambda t: [(m[0].lower(), *m.span()) for m in re.finditer(r"[^\W_]+", t or "")]
    docs = []
    for _, t in rows:
        spans = plain_spans(t)
        clear = [w for w in words(t) if not any(a < w[2] and w[1] < b for _, a, b in spans)]
        docs.append(({f"{k} {t[a:b].lower()}" for k, a, b in spans}, clear))
    total, entities = len(rows), {e for es, _ in docs for e in es}
    n_entity = {e: sum(e in es for es, _ in docs) for e in entities}
    n_term: dict[str, int] = {}
    for _, clear in docs:
        for w in {w for w, _, _ in clear}:
            n_term[w] = n_term.get(w, 0) + 1
    told = {}
    for e in entities:
        for w, n in n_term.items():
            both = sum(e in es and any(x == w for x, _, _ in clear) for es, clear in docs)
            if both >= pii.SUPPORT and n_entity[e] < total and math.log(both * total / (n * n_entity[e])) / math.log(total / n_entity[e]) >= pii.ALPHA - 1e-12:
                told.setdefault(e, set()).add(w)
    return [sorted((a, b) for w, a, b in clear if any(w in told.get(e, ()) for e in es)) for es, clear in docs]


def test_terms_by_brute_force(spark):
    rng = random.Random(9)
    common_words = [f"w{k}" for k in range(30)]
    rows = []
    for k in range(150):
        text = [rng.choice(common_words) for _ in range(rng.randrange(3, 40))]
        if k % 3 == 0:
            who = rng.randrange(12)
            text.insert(rng.randrange(len(text)), f"p{who}@x.org")
            if rng.random() < 0.8:
                text.insert(rng.randrange(len(text)), f"Nick{who}")
            if rng.random() < 0.2:
                text.append(f"nick{rng.randrange(12)}")
        rows.append((k, " ".join(text)))
    rows += [(0, rows[0][1]), (200, None), (201, "")]
    got = {}
    for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id] = sorted(tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("term:"))
    want = brute_terms(rows)
    assert sum(map(len, want)) > 20
    for (d, _), places in zip(rows, want, strict=True):
        assert got[d] == places, d


def test_stages_by_brute_force(spark, tmp_path):
    """Near-dedup, decontamination and PII in a row, against plain loops."""
    rng = random.Random(4)
    vocab = [a + b for a in ("ka", "lo", "mi", "ne", "ru") for b in ("lun", "der", "pok", "sin", "tar")]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    item = prose(12)
    rows = [(k, prose(rng.randrange(5, 120))) for k in range(40)]
    rows += [(50 + k, rows[k][1]) for k in range(5)] + [(60, rows[7][1] + " ende"), (70, f"{prose(9)} {item} {prose(9)}"), (71, f"{prose(9)} {' '.join(item.split()[2:11])} x"), (72, " ".join(item.split()[:7]))]
    rows += [(80, f"mail {prose(6)} to some.one@example.org now"), (81, "card 4111 1111 1111 1111 here " + prose(8)), (82, None), (83, "")]
    at = f"file://{tmp_path}"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    docs = spark.createDataFrame([(d, t, "en", "s", len(t) if t else None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("near_dedup", "decontamination", "pii"):
        docs = common.written(stages[name](spark, docs, at), f"test-{name}")
    got = {r.doc_id: r.text for r in docs.collect()}
    root = classes({plain_simhash(t) for _, t in rows})
    first = {}
    for d, t in sorted(rows):
        first.setdefault(root[plain_simhash(t)], d)
    kept = {d: t for d, t in rows if first[root[plain_simhash(t)]] == d}
    windows = {" ".join(item.split()[k : k + 8]) for k in range(5)}
    kept = {d: t for d, t in kept.items() if not any(w in " ".join((t or "").split()) for w in windows)}
    masked = {}
    for d, t in kept.items():
        for kind, a, b in sorted(plain_spans(t), key=lambda x: -x[1]):
            t = f"{t[:a]}<{pii.KINDS[kind].upper()}>{t[b:]}"
        masked[d] = t
    assert got == masked and "<EMAIL>" in got[80] and "<CARD>" in got[81] and 70 not in got and 71 not in got and 72 in got
    assert hashlib.sha256(repr(sorted(got)).encode()).hexdigest()  # ids are plain integers
