"""SimHash components and substring removal, against brute force."""

import hashlib
import random

import numpy as np
import xxhash

from tesserae.llm import graph, simhash, substrings
from tests.llm.cases import ROWS, documents, empty


def plain_simhash(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, radius=4):
    """The smallest value reachable from each, by brute force."""
    root = {v: v for v in values}
    change = True
    while change:
        change = False
        for a in root:
            for b in root:
                if (a ^ b).bit_count() <= radius and root[b] < root[a]:
                    root[a], change = root[b], True
    return root


def test_fingerprints_and_components(spark):
    got = simhash.near_duplicates(documents(spark)).collect()
    fps = {r[1]: plain_simhash(r[1]) for r in ROWS}
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(r[0]), f"{fps[r[1]]:016x}") for r in ROWS)
    root = classes(set(fps.values()))
    for r in got:
        same = [x[0] for x in ROWS if x[0] is not None and root[fps[x[1]]] == root[int(r.fingerprint, 16)]]
        assert r.component_id == min(same, default=None)
    assert simhash.near_duplicates(empty(spark)).count() == 0
    kept = simhash.deduplicate(documents(spark)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None).count(6) == 1 and 7 not in {r.doc_id for r in kept}


def test_deduplicate_tells_rows_by_id_and_text(spark):
    a, b, c = (" ".join(f"{w}{k * k % 89}" for k in range(80)) for w in ("ab", "cde", "fghi"))
    rows = [(1, a), (2, a), (2, b), (3, b), (3, c), (1, c), (1, c), (None, a), (None, "alone"), (None, "alone")]
    kept = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, a), (2, b), (1, c), (None, "alone")], key=str)


def test_links_by_halves_crowds_and_balls(spark):
    rng = random.Random(3)
    center = rng.getrandbits(64)
    crowd = {center ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3]))) for _ in range(60)}
    chain = [rng.getrandbits(64)]
    for k in range(12):
        chain.append(chain[-1] ^ sum(1 << b for b in range(4 * k, 4 * k + 4)))
    values = sorted(crowd | set(chain) | {rng.getrandbits(64) for _ in range(100)})
    root = classes(values)
    want = {}
    for v, r in root.items():
        want.setdefault(r, set()).add(v)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    for how in ({}, {"bucket": 4}, {"halves": 0}):
        found = graph.components(simhash.links(fps, **how)).collect()
        by = {}
        for r in found:
            by.setdefault(r.root, set()).add(r.node & (1 << 64) - 1)
        assert sorted(map(sorted, by.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 50)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {1000 + k: 1000 for k in range(50)} | {2000: 2000, 2001: 2000}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows):
    seen, out = {}, []
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            seen.setdefault(b[k : k + 50], d)
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b) + 1)
        for k in range(len(b) - 49):
            if d is not None and seen[b[k : k + 50]] < d:
                gone[k : k + 50] = b"\1" * 50
        left = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out.append((d, len(b), len(b) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_substrings(spark, monkeypatch):
    rng = random.Random(1)
    odd = [(100 + k, "".join(rng.choice("ab") for _ in range(rng.choice([0, 49, 50, 51, 400])))) for k in range(25)]
    odd += [(200 + k, "xyz" * rng.choice([16, 17, 60])) for k in range(5)] + [(300, "\0" * 120), (301, "\0" * 60), (302, "q" * 49 + "\0"), (303, "q" * 49 + "\0")]
    shared = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))
    odd += [(400 + k, f"{k}" * 30 + shared[k : 300 - 2 * k] + f"{k}" * 40) for k in range(40)]
    rows = [r[:2] for r in ROWS] + odd
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert sorted(map(tuple, substrings.digest(frame).collect()), key=str) == want
    unique = [r for r in rows if r[0] not in (6,)]
    got = substrings.digest(spark.createDataFrame(unique, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == brute(unique)
    kept = substrings.deduplicate(documents(spark))
    assert kept.columns == [*documents(spark).columns, "kept"] and kept.count() == len(ROWS)
    assert substrings.digest(empty(spark)).count() == 0


def test_family_levels_grow_geometrically():
    family, rng, seen = substrings.Family(), np.random.default_rng(0), {}
    for batch in range(40):
        strings = np.array([b"%050d" % x for x in rng.integers(0, 3000, 100)], "S50")
        docs = np.full(100, batch)
        for s, least in zip(strings.tolist(), family.add(strings, docs).tolist(), strict=True):
            assert least == seen.setdefault(s, batch)
    assert len(family.levels) <= 8 and sum(len(x) for x, _ in family.levels) >= len(seen)
