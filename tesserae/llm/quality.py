"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Every rule rejects a document.  A sample estimates what each rule costs
(nanoseconds, its own measures included) and how often it rejects; the rules
then run in the order of rejections per cost, and the rules after the one that
rejects a document aren't evaluated on it, nor are the measures that only they
need.  The order changes the work, never the verdict.

``keep`` is that cascade alone.  ``assess`` reports all base measures, so it
has them anyway; there the cascade saves what rules read from the text besides.

Defined results: a null or empty text has no words and fails; repeated rows
get equal results; an empty table gives no rows and keeps the stated order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD, SPACE = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
#: About how many rows, drawn from the whole table, costs and selectivities are estimated on; times that each rule runs on one.
SAMPLE_ROWS, REPEATS = 1000, 3
WINDOW = 5
MIN_WORDS, MAX_REPEATED = 10, 20
MAX_SYMBOLS_PER_WORD, MAX_UPPER, MAX_DUP_LINES, MEAN_WORD = 0.1, 0.4, 0.5, (2, 12)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def repeated_words(ws: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text.

    Windows are compared by a 64-bit hash within one document.
    """
    n = F.size(ws)

    def positions(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ranked, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, j: F.coalesce((F.get(s, j - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce((F.get(s, j + 1)["h"] == x["h"]), F.lit(False))),
            lambda x: x["i"])))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(WINDOW)]))
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(positions(h), covered)).otherwise(0))
    return F.when(n > WINDOW, found).otherwise(0)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return F.when(F.contains(text, F.lit("\n")), let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))).otherwise(0)


#: What a document is measured by, each from its text and words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, ws: F.size(ws),
    "word_chars": lambda text, ws: F.length(F.array_join(ws, "")),
    "n_symbols": lambda text, ws: F.length(F.regexp_replace(text, SYMBOLS, "")),
    "n_dup_lines": lambda text, ws: duplicate_lines(text),
    "n_repeat_words": lambda text, ws: repeated_words(ws),
}


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def rules(text: Column, ws: Column, have: dict[str, Column] | None = None) -> dict[str, Column]:
    """What rejects a document, by name; measures that it doesn't ``have`` are taken from the text and the words."""
    get = lambda name: (have or {}).get(name, MEASURES[name](text, ws))
    n, chars = get("n_words"), get("word_chars")
    upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    return {
        "few_words": n < MIN_WORDS,
        "repeated_words": let(get("n_repeat_words"), lambda x: 100 * x > MAX_REPEATED * n),
        "symbols": get("n_symbols") > MAX_SYMBOLS_PER_WORD * n,
        "word_length": let(chars, lambda x: (x < MEAN_WORD[0] * n) | (x > MEAN_WORD[1] * n)),
        "dup_lines": get("n_dup_lines") > MAX_DUP_LINES * (1 + F.size(F.split(text, "\n", -1))),
        "upper_case": upper > MAX_UPPER * chars,
    }


def order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> list[str]:
    """The rules' names by estimated rejections per nanosecond, best first; ties in the stated order.

    One pass over a seeded sample of the whole table: each rule runs between
    two readings of the clock, a few times a row, of which the shortest counts.
    """
    total = docs.count()
    now = lambda: F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    names = list(rules(F.lit(""), F.array().cast("array<string>")))

    def timed(text: Column, ws: Column) -> Column:
        found, parts = rules(text, ws), []
        for r in range(REPEATS):
            for name in names:
                parts += [now().alias(f"{name}_{r}a"), F.coalesce(found[name], F.lit(False)).alias(f"{name}_{r}"), now().alias(f"{name}_{r}b")]
        return F.struct(*parts)

    text = F.coalesce("text", F.lit(""))
    some = docs.sample(False, min(1.0, sample_rows / max(total, 1)), seed).select(text.alias("text"))
    got = some.select(let(words(F.col("text")), lambda ws: timed(F.col("text"), ws)).alias("x"))
    cost = lambda n: F.sum(F.least(*[F.col(f"x.{n}_{r}b") - F.col(f"x.{n}_{r}a") for r in range(REPEATS)]))
    row = got.agg(*[f for n in names for f in (cost(n).alias(f"{n}_cost"), F.count_if(F.col(f"x.{n}_0")).alias(f"{n}_hits"))]).first()
    gain = {n: row[f"{n}_hits"] / max(row[f"{n}_cost"] or 0, 1) for n in names}
    return sorted(names, key=lambda n: -gain[n])


def rejected(names: list[str], found: dict[str, Column]) -> Column:
    """Whether a rule rejects; a CASE leaves the rules after the first that does unevaluated."""
    out = F.when(F.coalesce(found[names[0]], F.lit(False)), True)
    for name in names[1:]:
        out = out.when(F.coalesce(found[name], F.lit(False)), True)
    return out.otherwise(False)


def assess(docs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """doc_id, the base measures, base_failed and kept, one row for each row of ``docs``."""
    with_words = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_words", words(F.col("text")))
    base = with_words.select("doc_id", "text", "_words", *[f(F.col("text"), F.col("_words")).cast("long").alias(n) for n, f in MEASURES.items()])
    found = rules(F.col("text"), F.col("_words"), {n: F.col(n) for n in MEASURES})
    names = names or order(docs)
    failed = found["few_words"] | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rest = [n for n in names if n not in ("few_words", "repeated_words")]  # those two are the base's
    return base.select("doc_id", *MEASURES, failed.alias("base_failed"), (~(failed | rejected(rest, found))).alias("kept"))


def keep(docs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that pass: the cascade as one lazily evaluated expression of the text, with no measure below it."""
    names = names or order(docs)
    text = F.coalesce("text", F.lit(""))
    return docs.where(~let(words(text), lambda ws: rejected(names, rules(text, ws))))
