"""Open windows per pool as keyed state, and the point from which a run may resume.

A window is open while the watermark has not reached its end: rows may still
change it.  ``transformWithState`` keeps the open windows of every pool in a
map and closes them by event-time timers, so a pool that is silent for many
micro-batches still holds the resume point back until its window is over.

The rows are reduced to (pool, window) inside each Arrow batch before the
shuffle, so a hot pool costs its task a few rows per batch.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidepool.operators import upsert as U

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OPEN = "chain_id long, pool_address string, lowest_open long, latest long, n_open long, closed_to long, step long"


def _reduced(w: int):
    """(chain, pool, window start, last timestamp, rows) of each Arrow batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ts = batch.column("timestamp")
            start = pc.multiply(pc.divide(ts, w), w)        # timestamps are positive here
            t = pa.table({"chain_id": batch.column("chain_id"), "pool_address": batch.column("pool_address"),
                          "window_start": start, "timestamp": ts})
            out = t.group_by(["chain_id", "pool_address", "window_start"]).aggregate([("timestamp", "max"), ("timestamp", "count")])
            out = out.rename_columns({"timestamp_max": "timestamp", "timestamp_count": "n"})
            yield from out.select(["chain_id", "pool_address", "window_start", "timestamp", "n"]).to_batches()
    return run


class OpenWindows(StatefulProcessor):
    """Map of open windows per pool; one output row whenever it changes."""

    def __init__(self, window_seconds: int):
        self.w = window_seconds

    def init(self, handle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "window_start long", "n long")
        self.seen = handle.getValueState("seen", "latest long, closed_to long")

    def _row(self, key, step: int) -> pd.DataFrame:
        starts = [k[0] for k in self.windows.keys()]
        latest, closed = self.seen.get() if self.seen.exists() else (None, None)
        return pd.DataFrame({
            "chain_id": [key[0]], "pool_address": [key[1]], "lowest_open": pd.array([min(starts, default=None)], dtype="Int64"),
            "latest": pd.array([latest], dtype="Int64"), "n_open": [len(starts)],
            "closed_to": pd.array([closed], dtype="Int64"), "step": [step]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest, closed = self.seen.get() if self.seen.exists() else (None, None)
        for pdf in rows:
            for start, n in pdf.groupby("window_start")["n"].sum().items():
                start = int(start)
                if not self.windows.containsKey((start,)):
                    self.handle.registerTimer((start + self.w) * 1000)
                    self.windows.updateValue((start,), (int(n),))
                else:
                    self.windows.updateValue((start,), (self.windows.getValue((start,))[0] + int(n),))
                latest = start if latest is None else max(latest, start)
        self.seen.update((latest, closed))
        yield self._row(key, 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() // 1000
        if self.windows.containsKey((end - self.w,)):
            self.windows.removeKey((end - self.w,))
        latest, closed = self.seen.get()
        self.seen.update((latest, end if closed is None else max(closed, end)))
        yield self._row(key, end)

    def close(self) -> None:
        pass


def open_windows(events: DataFrame, window_seconds: int, lateness: str) -> DataFrame:
    """Changes of each pool's open windows, from streamed (chain_id, pool_address, timestamp) rows."""
    w = int(window_seconds)
    slim = events.where("timestamp > 0").select("chain_id", "pool_address", "timestamp")
    reduced = slim.mapInArrow(_reduced(w), "chain_id long, pool_address string, window_start long, timestamp long, n long")
    timed = reduced.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", lateness)
    return timed.groupBy("chain_id", "pool_address").transformWithStateInPandas(
        OpenWindows(w), OPEN, outputMode="update", timeMode="eventTime")


def start_open_windows(spark: SparkSession, events: DataFrame, work_dir: str, window_seconds: int, lateness: str,
                       available_now: bool = True) -> StreamingQuery:
    """Write the changes as versions of ``work_dir``/open, one row per pool and micro-batch."""
    path = os.path.join(work_dir, "open")
    conf, key = spark.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key, None)

    def sink(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy("chain_id", "pool_address").agg(F.max_by(F.struct(
            "lowest_open", "latest", "n_open", "closed_to"), "step").alias("s")).select("chain_id", "pool_address", "s.*")
        U.write_version(last, path, batch_id)
    writer = (open_windows(events, window_seconds, lateness).writeStream.outputMode("update").foreachBatch(sink)
              .option("checkpointLocation", os.path.join(work_dir, "open-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    conf.set(key, STATE_STORE)          # the query keeps the provider it starts with
    try:
        return writer.start()
    finally:
        conf.set(key, before) if before else conf.unset(key)


def read_open_windows(spark: SparkSession, work_dir: str) -> DataFrame:
    """chain_id, pool_address, lowest_open (null: none), latest, n_open, closed_to: the latest state of every pool."""
    return U.read_latest(spark, os.path.join(work_dir, "open"), ["chain_id", "pool_address"]).drop(
        "batch_id", "created_at", "updated_at")


def resume_point(pools: DataFrame) -> DataFrame:
    """One row, last_processed_ts: the second before the lowest open window of *all* pools.

    With no window open, the last closed second; 0 without any pool.
    """
    return pools.agg(F.coalesce(F.greatest(F.min("lowest_open") - 1, F.lit(0)), F.max("closed_to") - 1, F.lit(0))
                     .cast("bigint").alias("last_processed_ts"))
