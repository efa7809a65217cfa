"""Structured Streaming: snapshots merged as they land, retries by timer, host cool-down."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.relational import deactivate_missing, upsert


def merge_snapshots(landed: DataFrame, load: Callable[[], DataFrame], store: Callable[[DataFrame, int], None], keys: list[str], keep: list[str], checkpoint: str):
    """Start a query that merges every landed snapshot into a versioned table.

    A micro-batch is one complete snapshot of its sources: rows of these that it lacks become inactive. ``store``
    gets the new version and the batch number, so a repeated batch writes the same version again.
    """

    def step(batch: DataFrame, number: int) -> None:
        run_id = f"batch-{number}"
        order = F.struct(*[F.col(c) for c in batch.columns if c not in keys])
        rows = batch.groupBy(*keys).agg(F.max(order).alias("x")).select(*keys, "x.*")
        rows = rows.withColumn("last_seen_run_id", F.lit(run_id)).withColumn("active", F.lit(True))
        store(deactivate_missing(upsert(load(), rows, keys, keep), rows, run_id), number)

    return landed.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_activity(results: DataFrame, window: str = "1 hour", late: str = "24 hours") -> DataFrame:
    """Results and failures by stage and window of updated_at; later rows than ``late`` are left out."""
    w = results.withWatermark("updated_at", late).groupBy(F.window("updated_at", window), "stage_name", "stage_version")
    out = w.agg(F.count("*").alias("recent_results"), F.count_if(F.col("status") == "success").alias("successful"), F.count_if(F.col("status") != "success").alias("failed"))
    return out.select(F.col("window.start").alias("from_ts"), F.col("window.end").alias("to_ts"), "stage_name", "stage_version", "recent_results", "successful", "failed")


def due_retries(results: DataFrame) -> DataFrame:
    """(document_key, due_ms): each key whose latest stored result is retryable, when its retry time has come."""

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (due,) = state.get
            state.remove()
            yield pd.DataFrame({"document_key": [key[0]], "due_ms": [due]})
            return
        rows = pd.concat(list(frames)).sort_values("seq")
        last = rows.iloc[-1]
        if last["status"] != "retryable_failure":
            if state.exists:
                state.remove()
            return
        due = int(last["retry_ms"])
        state.update((due,))
        state.setTimeoutDuration(max(1, due - state.getCurrentProcessingTimeMs()))

    rows = results.select("document_key", "status", F.unix_millis("retry_at").alias("retry_ms"), "seq")
    return rows.groupBy("document_key").applyInPandasWithState(step, "document_key string, due_ms long", "due long", "append", GroupStateTimeout.ProcessingTimeTimeout)
