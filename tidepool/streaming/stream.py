"""Structured Streaming version of decode + windowed aggregation.

readStream (explicit schema, file source) -> decode (stateless, stream-static
broadcast join) -> watermark on the event time -> optional dedup within the
watermark -> groupBy(window, pool) with the same fixed-width buffers as the
batch job -> foreachBatch: render, enrich (decimals, TVL, rates) and write
pools, metrics and state as keyed versions of the micro-batch.  A second query
over the same source writes the dead letters (unreadable lines and logs that do
not decode).

``update`` mode re-emits a window with its full running totals whenever it
changes, so the keyed table always holds complete values and windows still
open at the end of input are flushed too (W2).

Late rows (W3, Q1): Spark filters input older than the previous micro-batch's
watermark, and only guarantees to keep rows within the lateness bound, so a
late row can still reopen a window whose state was already evicted and emit
a partial total.  The reference let exactly such a partial row overwrite the
finished window.  The sink therefore drops every incoming window that ends
at or before (highest window start already written - lateness); that horizon
never passes Spark's own watermark, so no window still open is affected.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool import schemas as S
from tidepool.functions import hexcodec as H
from tidepool.operators import aggregate as A
from tidepool.operators import decode as D
from tidepool.operators import enrich as N
from tidepool.operators import ingest as I
from tidepool.operators import upsert as U
from tidepool.session import checkpoint_subdir
from tidepool.sources import logs as L


def read_log_stream(spark: SparkSession, source_dir: str, fmt: str = "json",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw logs from files as they land; JSON lines keep ``_parse_error`` for the dead letters."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fmt == "json":
        return L.parse_json_lines(r.format("text").load(source_dir), S.RAW_LOG)
    return r.schema(S.RAW_LOG).format(fmt).load(source_dir)


def windowed_stream(logs: DataFrame, pool_meta: DataFrame, window_seconds: int, lateness: str,
                    dedup: bool = True, extra_map: dict | None = None) -> DataFrame:
    """Streaming aggregate: one row per (chain, pool, window) with raw buffers.

    Every event's metadata comes from ``pool_meta``, so its own fee tier is the pool's.
    Only what the windows add up is converted and shuffled to the dedup.
    """
    w = int(window_seconds)
    decoded = D.decode_logs(logs, pool_meta, D.routing_map(extra_map), fields=("amount0", "amount1"))
    ev = D.typed_events(decoded).where(F.col("timestamp") > 0).select(
        *I.LOG_KEY, "address", "event_name", "timestamp", F.struct("decoded.amount0", "decoded.amount1").alias("decoded"),
        F.struct("pool_meta.fee").alias("pool_meta"), F.timestamp_seconds("timestamp").alias("event_time"))
    ev = ev.withWatermark("event_time", lateness)
    if dedup:
        ev = ev.dropDuplicatesWithinWatermark(I.LOG_KEY)
    terms = A.event_terms(ev, w, carry=("event_time",))
    keys = [k for k in A.GROUP_KEYS if k != "window_start"]
    g = terms.groupBy(F.window("event_time", f"{w} seconds").alias("_w"), *keys).agg(*A.agg_columns())
    return g.withColumn("window_start", F.unix_seconds(F.col("_w.start"))).drop("_w")


def stream_meta(pool_meta: DataFrame) -> DataFrame:
    """The metadata dimension in the layout of ``aggregate.pool_metadata``."""
    rows = pool_meta.select(
        "chain_id", H.address_key(F.col("address")).alias("pool_address"), F.lower("token0").alias("token0"),
        F.lower("token1").alias("token1"), F.col("fee").cast("bigint").alias("fee"),
        F.col("tick_spacing").cast("int").alias("tick_spacing"))
    return I.first_copy(rows, ["chain_id", "pool_address"], [F.col(c) for c in A.META])


def start_metrics_stream(spark: SparkSession, source_dir: str, pool_meta: DataFrame, tokens: DataFrame,
                         balances: DataFrame, work_dir: str, window_seconds: int,
                         lateness: str = "1 hour", checkpoint: str | None = None, fmt: str = "json",
                         max_files_per_trigger: int | None = None, available_now: bool = True,
                         output_mode: str = "update") -> StreamingQuery:
    """Start the metrics stream writing pools, metrics, late and state below ``work_dir``.

    The micro-batch id is the version id, so a replayed batch rewrites the
    same version folders (idempotent).  ``open`` holds the latest window of
    every pool seen so far, ``state`` the resume point (A10: the second before
    the lowest of them that is not over, over all pools, not only the batch's)
    and the highest window start written, so a batch reads two small tables;
    ``late`` counts the windows that the sink refused (W3).  The tables are
    written one after the other, state last: up to the batch that ``state``
    names, all of them are complete.
    """
    w = int(window_seconds)
    late_s = interval_seconds(lateness)
    meta = stream_meta(pool_meta)
    agg = windowed_stream(read_log_stream(spark, source_dir, fmt, max_files_per_trigger), pool_meta, w, lateness)
    paths = {k: os.path.join(work_dir, k) for k in ("pools", "metrics", "open", "state", "late")}

    def sink(batch: DataFrame, batch_id: int) -> None:
        windows = A.render_windows(batch, w, meta).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            top = _written_top(spark, paths["state"], batch_id)
            if top is not None:
                horizon = F.lit(top - late_s)
                late = windows.where(F.col("window_end") <= horizon)
                U.write_version(late.agg(F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("n_events"), F.lit(0))
                                         .alias("rows")), paths["late"], batch_id)
                kept = windows.where(F.col("window_end") > horizon)
            else:
                kept = windows
            if kept.isEmpty():      # Spark also runs batches without data, to move the watermark
                return
            # The state's partitions are many and its windows few.
            kept = kept.coalesce(spark.sparkContext.defaultParallelism)
            U.write_version(A.pool_registry(kept), paths["pools"], batch_id)
            # Only the balances of the batch's pools take part.
            own = A.drop_missing_meta(kept).select(F.col("chain_id").alias("_c"),
                                                   H.address_key(F.col("pool_address")).alias("_o")).distinct()
            bal = balances.join(own, (balances["chain_id"] == F.col("_c"))
                                & (H.address_key(balances["owner"]) == F.col("_o")), "left_semi")
            U.write_version(N.window_metrics(kept, tokens, bal), paths["metrics"], batch_id)
            here = kept.agg(F.max("window_start").alias("top")).first()["top"]
            now = max(x for x in (here, top) if x is not None)
            U.write_version(_latest_windows(spark, kept, paths["open"], batch_id), paths["open"], batch_id)
            latest = spark.read.parquet(f"{paths['open']}/batch_id={int(batch_id)}")
            # A pool's last window holds the resume point back until it is over.
            running = latest.where(F.col("window_start") + F.lit(w) > F.lit(now - late_s))
            state = A.open_window_state(running).select(
                F.lit(f"aggregator:{w}").alias("name"), "last_processed_ts", F.lit(now).cast("bigint").alias("top"))
            U.write_version(state, paths["state"], batch_id)
        finally:
            windows.unpersist()

    ckpt = checkpoint or checkpoint_subdir(spark, "streams", f"metrics-{w}")
    writer = (agg.writeStream.outputMode(output_mode).foreachBatch(sink)
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def start_errors_stream(spark: SparkSession, source_dir: str, pool_meta: DataFrame, errors_path: str, checkpoint: str,
                        fmt: str = "json", max_files_per_trigger: int | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Dead letters of the stream (P10): unreadable lines and logs that do not decode, appended as they come."""
    logs = read_log_stream(spark, source_dir, fmt, max_files_per_trigger)
    errors = D.decode_errors(D.decode_logs(logs, pool_meta))
    writer = errors.writeStream.format("parquet").option("path", errors_path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int:
    """'10 minutes', '1 hour', '3650 days' -> seconds."""
    n, unit = text.split()
    return int(n) * _UNITS[unit.lower().rstrip("s")]


def _latest_windows(spark: SparkSession, windows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The latest window of every pool so far: the newest earlier version and this batch."""
    from tidepool.plans.jobs import _exists, _folders
    rows = windows.select("chain_id", "pool_address", "window_start")
    last = max((n for n in (_folders(spark, path, "batch_id") if _exists(spark, path) else []) if n < batch_id), default=None)
    if last is not None:
        rows = rows.unionByName(spark.read.parquet(f"{path}/batch_id={last}").select(*rows.columns))
    return rows.groupBy("chain_id", "pool_address").agg(F.max("window_start").alias("window_start"))


def _written_top(spark: SparkSession, state_path: str, batch_id: int):
    """Highest window start written by earlier micro-batches (None before the first)."""
    from tidepool.plans.jobs import _exists
    if not _exists(spark, state_path):
        return None
    r = spark.read.parquet(state_path).where(F.col("batch_id") < batch_id).agg(F.max("top")).first()[0]
    return None if r is None else int(r)


def read_stream_metrics(spark: SparkSession, table_path: str) -> DataFrame:
    return U.read_latest(spark, table_path, list(S.WINDOW_METRICS_KEY)).drop("batch_id", "created_at", "updated_at")


def append_files(df: DataFrame, path: str) -> None:
    """Land a batch of logs as new JSON files, one per partition."""
    df.write.mode("append").json(path)


def _finish(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_once(spark: SparkSession, source_dir: str, pool_meta: DataFrame, tokens: DataFrame,
             balances: DataFrame, work_dir: str, window_seconds: int, lateness: str,
             max_files_per_trigger: int | None = None) -> DataFrame:
    """Process everything available in ``source_dir`` and return the current metrics."""
    _finish(start_metrics_stream(spark, source_dir, pool_meta, tokens, balances, work_dir, window_seconds,
                                 lateness, os.path.join(work_dir, "checkpoint"),
                                 max_files_per_trigger=max_files_per_trigger))
    return read_stream_metrics(spark, os.path.join(work_dir, "metrics"))


def run_errors_once(spark: SparkSession, source_dir: str, pool_meta: DataFrame, work_dir: str) -> DataFrame:
    """Write the dead letters of everything available and return them."""
    path = os.path.join(work_dir, "errors")
    _finish(start_errors_stream(spark, source_dir, pool_meta, path, os.path.join(work_dir, "errors-checkpoint")))
    return spark.read.parquet(path)
