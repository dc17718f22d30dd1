"""Operators that depend on order: breakers, pacing, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.operators.ranks import placed


def breaker(events: DataFrame, limit: int, key: str = "source_id", neutral: str | None = None) -> DataFrame:
    """By key: the first ``ord`` at which ``limit`` failures stand in a row, null if none.

    ``events``: key, ord, failed.  Rows where the expression ``neutral`` holds
    neither count nor end a run.
    """
    rows = events.where(f"not ({neutral})") if neutral else events
    failures = placed(placed(rows.select(key, "ord", "failed"), [key]).where("failed"), [key], name="_m")
    failures = failures.withColumn("_run", F.col("_n") - F.col("_m"))  # the same for failures in a row
    runs = failures.groupBy(key, "_run").agg(F.count("*").alias("_size"), F.min("_m").alias("_first"))
    longest = runs.groupBy(key).agg(F.max("_size").cast("long").alias("longest_run"))
    at = runs.where(F.col("_size") >= limit).groupBy(key).agg((F.min("_first") + limit - 1).alias("_m"))
    tripped = failures.join(at, [key, "_m"]).select(key, F.col("ord").alias("tripped_at"))
    return events.select(key).distinct().join(longest, key, "left").join(tripped, key, "left").select(key, F.coalesce("longest_run", F.lit(0)).alias("longest_run"), "tripped_at")


def paced(events: DataFrame, base: float, ceiling: float, key: str = "source_id", up: float = 1.5, down: float = 0.5, after: int = 20) -> DataFrame:
    """By key: the delay in force after all its fetches (``ord``, ``throttled``), and how many were throttled.

    A throttled fetch adds ``up``; ``after`` clean ones in a row take ``down``.
    Every throttled fetch starts a new run of clean ones, so the fold needs
    their lengths alone, and a run's easing is one step.
    """
    rows = placed(events.select(key, "ord", "throttled"), [key])
    total = rows.groupBy(key).agg(F.count("*").alias("_total"))
    hits = rows.where("throttled").groupBy(key).agg(F.array_sort(F.collect_list("_n")).alias("_hits"))
    both = total.join(hits, key, "left").withColumn("_hits", F.coalesce("_hits", F.array().cast("array<long>")))

    def eased(value: Column, clean: Column) -> Column:
        steps = F.least(F.floor(clean / after), F.ceil((value - base) / down))
        return F.when(value > base, F.round(F.greatest(F.lit(float(base)), value - down * steps), 2)).otherwise(value)

    def step(s: Column, at: Column) -> Column:
        value = eased(s["value"], at - s["at"] - 1)
        return F.struct(F.when(value < ceiling, F.round(F.least(F.lit(float(ceiling)), value + up), 2)).otherwise(value).alias("value"), at.alias("at"))

    start = F.struct(F.lit(float(base)).alias("value"), F.lit(0).cast("long").alias("at"))
    end = both.withColumn("_s", F.aggregate("_hits", start, step))
    return end.select(key, eased(F.col("_s.value"), F.col("_total") - F.col("_s.at")).alias("delay"), F.size("_hits").cast("long").alias("throttle_events"))


def backoff(attempt: Column, first: float, most: float = 60.0) -> Column:
    """Seconds before another attempt, without the jitter."""
    return F.least(F.lit(most), F.lit(first) * F.pow(F.lit(2.0), attempt))


def retries(status: Column, attempt: Column, most: int = 5) -> Column:
    """What to do after a fetch: ok, retry or raise; transport errors have no status."""
    again = status.isNull() | (status == 429) | (status >= 500)
    return F.when(status.between(200, 299), "ok").when(again & (attempt + 1 < most), "retry").otherwise("raise")
