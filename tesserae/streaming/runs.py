"""Resume, numbering, breaking and pacing over streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tesserae.functions import urls as U


def unseen(links: DataFrame, within: str | None = None, time: str = "ts") -> DataFrame:
    """Each document once, by identity; with a watermark the memory is bounded."""
    keyed = links.withColumn("identity", U.page_identity(F.col("url")))
    return keyed.withWatermark(time, within).dropDuplicatesWithinWatermark(["identity"]) if within else keyed.dropDuplicates(["identity"])


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (country, url) with numbers that go on by country from batch to batch."""

    def number(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (last,) = state.get if state.exists else (0,)
        for batch in batches:
            batch = batch.sort_values("url", kind="stable")
            yield pd.DataFrame({"country": key[0], "url": batch["url"], "doc_num": range(last + 1, last + 1 + len(batch))})
            last += len(batch)
        state.update((last,))

    return rows.select("country", "url").groupBy("country").applyInPandasWithState(number, "country string, url string, doc_num long", "last long", "append", GroupStateTimeout.NoTimeout)


def guarded(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (source_id, ord, failed): by source the run of failures so far, and whether it has reached ``limit``."""

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, tripped = state.get if state.exists else (0, False)
        for batch in batches:
            for failed in batch.sort_values("ord")["failed"]:
                run = run + 1 if failed else 0
                tripped = tripped or run >= limit
        state.update((run, tripped))
        yield pd.DataFrame({"source_id": [key[0]], "run": [run], "tripped": [tripped]})

    return rows.groupBy("source_id").applyInPandasWithState(watch, "source_id string, run long, tripped boolean", "run long, tripped boolean", "update", GroupStateTimeout.NoTimeout)


def paced(rows: DataFrame, base: float, ceiling: float, up: float = 1.5, down: float = 0.5, after: int = 20) -> DataFrame:
    """``rows`` (source_id, ord, throttled): by source the delay now in force; a throttled fetch adds ``up``, ``after`` clean ones in a row take ``down``."""

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        delay, clean = state.get if state.exists else (base, 0)
        for batch in batches:
            for throttled in batch.sort_values("ord")["throttled"]:
                clean += 1
                if throttled:
                    delay, clean = round(min(ceiling, delay + up), 2) if delay < ceiling else delay, 0
                elif clean >= after and delay > base:
                    delay, clean = round(max(base, delay - down), 2), 0
        state.update((delay, clean))
        yield pd.DataFrame({"source_id": [key[0]], "delay": [delay]})

    return rows.groupBy("source_id").applyInPandasWithState(watch, "source_id string, delay double", "delay double, clean long", "update", GroupStateTimeout.NoTimeout)


def windowed(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def run_once(stream: DataFrame, process: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """What has arrived, processed and written batch by batch; a batch that is run again replaces its own files."""

    def each(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
