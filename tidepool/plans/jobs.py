"""End-to-end batch jobs: ingest, decode, aggregate (the reference's three commands).

Each job reads tables, runs the operators and writes keyed outputs; progress
state is a small versioned table written last, so a job that dies midway is
simply re-run: the log append adds only logs whose key is not there yet, and
keyed tables are versions that a replay rewrites.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import schemas as S
from tidepool.functions.bigint import idiv
from tidepool.operators import aggregate as A
from tidepool.operators import decode as D
from tidepool.operators import enrich as N
from tidepool.operators import ingest as I
from tidepool.operators import upsert as U
from tidepool.plans.joins import bounded_broadcast
from tidepool.session import cut_lineage
from tidepool.sources import logs as L
from tidepool.sources import sinks as K

DEFAULT_BLOCK_BATCH = 2000     # blocks per landing bucket (reference default batch size)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_state(spark: SparkSession, state_path: str, name: str) -> int | None:
    """Last processed value of one named state (S9); None when absent."""
    if not _exists(spark, state_path):
        return None
    row = (U.read_latest(spark, state_path, ["name"]).where(F.col("name") == name)
           .select("last_processed_ts").first())
    return None if row is None else int(row[0])


def _next_batch(spark: SparkSession, path: str) -> int:
    """One past the highest version; the versions are listed from the folders, not read."""
    if not _exists(spark, path):
        return 1
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return max((int(n.split("=")[1]) for n in names if n.startswith("batch_id=")), default=0) + 1


def ingest_job(spark: SparkSession, landing: str, out_path: str, blocks: DataFrame, addresses: list[str],
               from_block: int, to_block: int = 0, topic0: list[str] | None = None,
               state_path: str | None = None, fmt: str = "parquet",
               block_batch: int = DEFAULT_BLOCK_BATCH) -> int | None:
    """Fetch step as one job (W8): scan filters, resume, dedup, block times, append.

    Output is partitioned by (chain_id, block_bucket) with bucket =
    block div ``block_batch`` (the reference's range plan, P1), holds
    ``topic0`` as a column, and is what ``scan_logs`` prunes and pushes down
    on.  A log without a block header fails the job before anything is
    written.  Only logs that the output's buckets of this range do not hold
    yet are appended, so a run repeated after a crash adds nothing twice.
    Returns the new checkpoint (highest block written).
    """
    name = "indexer:blocks"
    last = load_state(spark, state_path, name) if state_path else None
    start = I.resume_from(from_block, last)
    if to_block and start > to_block:
        return last                     # nothing to do (P12)
    logs = L.read_raw_logs(spark, landing, fmt)
    logs = I.scan_logs(logs, start, to_block, addresses, topic0)
    logs = I.dedup_logs(I.normalize_logs(logs))
    logs = I.attach_block_time(logs, blocks, require=True).drop("block_time_missing")
    logs = logs.select(*S.RAW_LOG.fieldNames(), F.get(F.col("topics"), 0).alias("topic0"),
                       idiv(F.col("block_number"), block_batch).alias("block_bucket"))
    logs = logs.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        top = logs.agg(F.max("block_number")).first()[0]
        if top is not None:
            fresh = logs
            if _exists(spark, out_path):
                there = spark.read.parquet(out_path).where(
                    F.col("block_bucket").between(start // block_batch, int(top) // block_batch))
                fresh = I.new_logs(logs, there)
            K.append_logs(fresh, out_path, partition_by=("chain_id", "block_bucket"))
    finally:
        logs.unpersist()
    if state_path and top is not None:
        U.write_version(U.state_row(spark, name, int(top), last), state_path, _next_batch(spark, state_path))
    return top if top is not None else last


def decode_job(spark: SparkSession, logs: DataFrame, pool_meta: DataFrame, events_out: str, errors_out: str,
               extra_map: dict | None = None, pool_live: DataFrame | None = None, fmt: str = "json") -> dict:
    """Decode step: typed events and dead letters from one plan; returns counters."""
    decoded = D.decode_logs(logs, pool_meta, D.routing_map(extra_map), pool_live)
    return K.write_decoded(decoded, events_out, errors_out, fmt)


def aggregate_job(spark: SparkSession, events: DataFrame, tokens: DataFrame, balances: DataFrame,
                  out_dir: str, window_seconds: int, recompute_from: int | None = None,
                  batch_id: int | None = None, dedup: bool = True, force_state: bool = False) -> dict:
    """Aggregate step with incremental state.

    State name ``aggregator:<w>`` (one per window width).  A run resumes at
    the start of the window holding the first unprocessed second, so a
    window cut by the previous run is recomputed whole; ``recompute_from``
    overrides the start (inclusive, aligned down).  The state only moves back
    with ``force_state``.  Repeated logs count once unless ``dedup`` is off.
    ``events`` may hold unreadable lines (``_parse_error``); they count as
    failed.  Checks pools and metrics against their contracts, then writes
    pools, metrics and state, as keyed versions under ``out_dir``.  Returns
    the batch id, start, state and the run's counters.
    """
    w = int(window_seconds)
    name = f"aggregator:{w}"
    paths = {k: os.path.join(out_dir, k) for k in ("pools", "metrics", "state")}
    previous = load_state(spark, paths["state"], name)
    if recompute_from:
        start = A.align_start(int(recompute_from) - 1, w)
    elif previous:
        start = A.align_start(previous, w)
    else:
        start = 0
    every = events
    events, seen = A.observe_counters(events, w, start)
    if "_parse_error" in events.columns:
        events = events.where(F.col("_parse_error").isNull()).drop("_parse_error")
    windows = A.window_aggregate(events, w, start, dedup).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        batch = batch_id if batch_id is not None else _next_batch(spark, paths["metrics"])
        pools = A.pool_registry(windows).persist(StorageLevel.MEMORY_AND_DISK)
        metrics = N.window_metrics(windows, tokens, balances).persist(StorageLevel.MEMORY_AND_DISK)
        U.require_contract(pools, list(S.POOLS_KEY), list(S.POOLS_NOT_NULL), "pools")
        U.require_contract(metrics, list(S.WINDOW_METRICS_KEY), list(S.WINDOW_METRICS_NOT_NULL), "metrics")
        U.write_version(pools, paths["pools"], batch)
        U.write_version(metrics, paths["metrics"], batch)
        counters = {**A.counted(seen, every, w, start), "decoded": metrics.count()}
        hw = windows.agg(F.max("max_ts")).first()[0]
        pools.unpersist(), metrics.unpersist()
    finally:
        windows.unpersist()
    new_state = max(int(hw), start) if hw is not None else start
    if previous is not None and not force_state:
        new_state = max(new_state, previous)            # never move backwards (Q13)
    state = U.state_row(spark, name, new_state)
    U.require_contract(state, list(S.STATE_KEY), list(S.STATE_NOT_NULL), "state")
    U.write_version(state, paths["state"], batch)
    return {"batch_id": batch, "start_ts": start, "state": new_state, **counters}


def _folders(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The numbers N of the folders ``kind``=N below ``path``."""
    if not _exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))


def read_buffers(spark: SparkSession, path: str, below: int) -> DataFrame | None:
    """Stored window buffers of all runs before run ``below``: the newest base and the deltas behind it."""
    base = max((n for n in _folders(spark, path, "base") if n < below), default=0)
    parts = [f"{path}/base={base}"] if base else []
    parts += [f"{path}/delta={n}" for n in _folders(spark, path, "delta") if base < n < below]
    return spark.read.parquet(*parts) if parts else None


def compact_buffers(spark: SparkSession, path: str) -> int:
    """Merge the base and all deltas into a new base, numbered like the last delta; readers go on as before.

    Older folders stay until ``drop_compacted``, so a reader that listed them before still finds them.
    """
    last = max(_folders(spark, path, "delta"), default=0)
    if last and last not in _folders(spark, path, "base"):
        merged = A.merge_buffers(read_buffers(spark, path, last + 1))
        merged.repartitionByRange("window_start").sortWithinPartitions("window_start").write.mode("overwrite").parquet(
            f"{path}/_making={last}")
        p = spark._jvm.org.apache.hadoop.fs.Path
        made = p(f"{path}/_making={last}")
        made.getFileSystem(spark._jsc.hadoopConfiguration()).rename(made, p(f"{path}/base={last}"))
    return last


def merge_job(spark: SparkSession, events: DataFrame, tokens: DataFrame, balances: DataFrame, out_dir: str,
              window_seconds: int, dedup: bool = True) -> dict:
    """Aggregate only what is new, and merge it into stored buffers.

    Unlike ``aggregate_job``, a resumed run does not read the open windows'
    older events again: it reads ``timestamp > state``, adds a delta of window
    buffers, and rewrites the metrics of the windows the delta touches, from
    the stored buffers of those windows and the delta.  (Older events are read
    only for swaps whose metadata names another fee tier than their window's,
    and for amounts of more than 80 digits.)

    The state counts the runs and is written last, so a run that died is
    repeated under the same number: it reads the same events, and replaces the
    same delta and the same versions.
    """
    w = int(window_seconds)
    name = f"merge:{w}"
    paths = {k: os.path.join(out_dir, k) for k in ("buffers", "pools", "metrics", "state")}
    state = load_state(spark, paths["state"], name) or 0
    run = _next_batch(spark, paths["state"])
    seen_events, seen = A.observe_counters(events, w, state)
    if "_parse_error" in events.columns:
        seen_events = seen_events.where(F.col("_parse_error").isNull()).drop("_parse_error")
    new = cut_lineage(A.window_buffers(A.events_after(seen_events, state, dedup), w))
    span = new.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi"), F.max("max_ts").alias("ts")).first()
    counters = {**A.counted(seen, events, w, state), "decoded": 0}
    if span.lo is None:
        return {"run": run, "start_ts": state, "state": state, **counters}
    new.sortWithinPartitions("window_start").write.mode("overwrite").parquet(f"{paths['buffers']}/delta={run}")
    stored = read_buffers(spark, paths["buffers"], run)
    rows = new
    if stored is not None:
        touched = bounded_broadcast(new.select(*A.GROUP_KEYS).distinct())
        near = stored.where(F.col("window_start").between(span.lo, span.hi))
        rows = A.merge_buffers(new.unionByName(near.join(touched, list(A.GROUP_KEYS), "left_semi")))
    again = events.where(F.col("timestamp") >= F.greatest(F.lit(span.lo), F.lit(1)))
    if "_parse_error" in events.columns:
        again = again.where(F.col("_parse_error").isNull()).drop("_parse_error")
    windows = A.finish_windows(cut_lineage(rows), w, A.events_after(again, 0, dedup))
    metrics = N.window_metrics(windows, tokens, balances).persist(StorageLevel.MEMORY_AND_DISK)
    pools = A.pool_registry(windows)
    U.require_contract(pools, list(S.POOLS_KEY), list(S.POOLS_NOT_NULL), "pools")
    U.require_contract(metrics, list(S.WINDOW_METRICS_KEY), list(S.WINDOW_METRICS_NOT_NULL), "metrics")
    U.write_version(pools, paths["pools"], run)
    U.write_version(metrics, paths["metrics"], run)
    counters["decoded"] = metrics.count()
    metrics.unpersist()
    top = max(int(span.ts), state) if span.ts is not None else state
    U.write_version(U.state_row(spark, name, top), paths["state"], run)
    return {"run": run, "start_ts": state, "state": top, **counters}


def read_metrics(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current pool_window_metrics (latest version per key)."""
    return U.read_latest(spark, os.path.join(out_dir, "metrics"), list(S.WINDOW_METRICS_KEY)).drop(
        "batch_id", "created_at", "updated_at")


def read_metrics_with_times(spark: SparkSession, out_dir: str) -> DataFrame:
    """Metrics with created_at (first write of the key) and updated_at (latest)."""
    return U.read_latest(spark, os.path.join(out_dir, "metrics"), list(S.WINDOW_METRICS_KEY)).drop("batch_id")


def read_pools(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current pools with first_seen_block = LEAST over versions."""
    return U.merge_pools(spark.read.parquet(os.path.join(out_dir, "pools"))).drop(
        "batch_id", "created_at", "updated_at")
