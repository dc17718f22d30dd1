"""Operators that go piece by piece give what they give in one piece."""

import random

from pyspark.sql import functions as F

from tesserae.operators import folds, ranks, tenure


def test_places(spark):
    rng = random.Random(3)
    rows = [(k % 3 if k % 7 else None, x) for k, x in enumerate(rng.sample(range(100_000), 2000))]
    df = spark.createDataFrame(rows, "k int, ord long")
    for keys in ([], ["k"]):
        want = {(r.k, r.ord): r._n for r in ranks.placed(df, keys).collect()}
        got = {(r.k, r.ord): r._n for r in ranks.placed(df, keys, piece_rows=90).collect()}
        assert got == want and len(got) == 2000
        each = {}
        for k, x in rows:
            each.setdefault(k if keys else 0, []).append(x)
        assert all(want[k, x] == sorted(each[k if keys else 0]).index(x) + 1 for k, x in rows[:200])
    assert ranks.placed(df.limit(0)).count() == 0


def test_breaker_and_pacer_by_steps(spark):
    rng = random.Random(5)
    rows = [(s, i, rng.random() < p, rng.random() < p / 4) for s, p in (("a", 0.7), ("b", 0.1), ("c", 0.0), ("d", 1.0)) for i in range(400)]
    df = spark.createDataFrame(rows, "source_id string, ord long, failed boolean, throttled boolean")
    trips = {r.source_id: (r.longest_run, r.tripped_at) for r in folds.breaker(df, 5).collect()}
    delays = {r.source_id: (r.delay, r.throttle_events) for r in folds.paced(df, 2.0, 12.0).collect()}
    for s in "abcd":
        run = longest = clean = hits = 0
        at, delay = None, 2.0
        for _, i, failed, throttled in (r for r in rows if r[0] == s):
            run = run + 1 if failed else 0
            longest = max(longest, run)
            at = i if at is None and run == 5 else at
            if throttled:
                hits, clean = hits + 1, 0
                delay = round(min(12.0, delay + 1.5), 2) if delay < 12.0 else delay
            elif clean + 1 >= 20 and delay > 2.0:
                clean, delay = 0, round(max(2.0, delay - 0.5), 2)
            else:
                clean += 1
        assert trips[s] == (longest, at) and delays[s] == (delay, hits)


def test_names_within_names(spark):
    rng = random.Random(7)
    names = lambda n: ["".join(rng.choice("abé ") for _ in range(rng.randrange(0, 6))) for _ in range(n)]
    a, b = names(120), names(120)
    left, right = (spark.createDataFrame(list(enumerate(x)), f"{c}_id int, {c} string") for c, x in (("a", a), ("b", b)))
    got = sorted((r.a_id, r.b_id) for r in tenure.within(left, right, "a", "b").collect())
    assert got == sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x and y and (x in y or y in x))
    assert spark.range(1).select(tenure.grams(F.lit("abab")).alias("g")).first().g == ["a", "b", "ab", "ba", "aba", "bab"]
