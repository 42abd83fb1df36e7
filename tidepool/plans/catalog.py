"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables through a fixture adapter and then runs
the package's own operators; ``plans.oracles`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import schemas as S
from tidepool.operators import aggregate as A
from tidepool.operators import enrich as N
from tidepool.plans import fixtures as X
from tidepool.plans import oracles as O

DAY = 86_400
HOUR = 3_600

Query = Callable[[SparkSession, str], DataFrame]


def window_swap_metrics(spark: SparkSession, sf_dir: str, w: int = DAY) -> DataFrame:
    """Flagship: swaps, volumes and fees per pool and window, in token units."""
    windows = A.drop_missing_meta(A.window_aggregate(X.typed_events(spark, sf_dir), w))
    d = N.attach_decimals(windows, X.tokens(spark, sf_dir))
    return d.select(
        "chain_id", "pool_address", "window_start", "window_end", "swap_count",
        N.format_raw("volume0_raw", "decimals0").alias("volume0"),
        N.format_raw("volume1_raw", "decimals1").alias("volume1"),
        N.format_raw("fee0_raw", "decimals0").alias("fee0"),
        N.format_raw("fee1_raw", "decimals1").alias("fee1"))


def window_metrics_full(spark: SparkSession, sf_dir: str, w: int = DAY) -> DataFrame:
    """The complete pool_window_metrics row."""
    windows = A.window_aggregate(X.typed_events(spark, sf_dir), w)
    return N.window_metrics(windows, X.tokens(spark, sf_dir), X.balances(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "window_swap_metrics": window_swap_metrics,
    "window_metrics_full": window_metrics_full,
    "window_metrics_1h": lambda s, d: window_metrics_full(s, d, HOUR),
}

ORACLES: dict[str, str] = {
    "window_swap_metrics": O.window_swap_metrics(DAY),
    "window_metrics_full": O.window_metrics_full(DAY),
    "window_metrics_1h": O.window_metrics_full(HOUR),
}


# ---------------------------------------------------------------------------
# Decoding (adapter R).

from tidepool.operators import decode as D  # noqa: E402

_DEC_KEYS = ["chain_id", "block_number", "tx_hash", "log_index", "address"]
_DEC_FIELDS = {
    "Swap": ["sender", "recipient", "amount0", "amount1", "sqrt_price_x96", "liquidity", "tick"],
    "Mint": ["owner", "sender", "tick_lower", "tick_upper", "amount", "amount0", "amount1"],
    "Burn": ["owner", "tick_lower", "tick_upper", "amount", "amount0", "amount1"],
    "Collect": ["owner", "recipient", "tick_lower", "tick_upper", "amount0", "amount1"],
}


def decoded_logs(spark: SparkSession, sf_dir: str, faults: bool = False,
                 extra_map: dict | None = None) -> DataFrame:
    routes = D.routing_map(extra_map)
    return D.decode_logs(X.raw_logs(spark, sf_dir, faults), X.pool_meta(spark, sf_dir), routes)


def decode_event(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        te = D.typed_events(decoded_logs(spark, sf_dir))
        return te.where(F.col("event_name") == kind).select(
            *_DEC_KEYS, *[F.col(f"decoded.{c}").alias(c) for c in _DEC_FIELDS[kind]],
            *[F.col(f"pool_meta.{c}").alias(c) for c in ("token0", "token1", "fee", "tick_spacing")])
    return run


def decode_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.decode_errors(decoded_logs(spark, sf_dir, faults=True))


def decode_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.decode_counters(decoded_logs(spark, sf_dir, faults=True))


def route_topics(extra: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = {X.FORK_SWAP_TOPIC0: " swap "} if extra else None
        d = decoded_logs(spark, sf_dir, faults=True, extra_map=m)
        return d.groupBy("event_name", "outcome").agg(F.count(F.lit(1)).alias("n"))
    return run


for _k in ("Swap", "Mint", "Burn", "Collect"):
    QUERIES[f"decode_{_k.lower()}"] = decode_event(_k)
    ORACLES[f"decode_{_k.lower()}"] = O.decode_event(_k)
QUERIES.update({
    "decode_errors": decode_errors,
    "decode_counters": decode_counters,
    "route_topics": route_topics(False),
    "route_topics_extra_map": route_topics(True),
})
ORACLES.update({
    "decode_errors": O.decode_errors(),
    "decode_counters": O.decode_counters(),
    "route_topics": O.route_topics(False),
    "route_topics_extra_map": O.route_topics(True),
})


# ---------------------------------------------------------------------------
# Aggregation details, state, upserts.

from tidepool.operators import ingest as I  # noqa: E402
from tidepool.operators import upsert as U  # noqa: E402
from tidepool.sources import snapshots as SN  # noqa: E402


def window_block_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = A.window_aggregate(X.typed_events(spark, sf_dir), DAY)
    return w.select("chain_id", "pool_address", "window_start", "first_block", "last_block", "n_events")


def pool_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pools of two runs, the later half first, merged by lowest first block."""
    ev, path = X.typed_events(spark, sf_dir), _fresh(spark, "pools")
    s = _resume_point(ev)
    for run, part in enumerate((ev.where(F.col("timestamp") > s), ev.where(F.col("timestamp") <= s)), start=1):
        pools = A.pool_registry(A.window_aggregate(part, HOUR))
        U.require_contract(pools, list(S.POOLS_KEY), list(S.POOLS_NOT_NULL), "pools")
        U.write_version(pools, path, run)
    return U.merge_pools(spark.read.parquet(path)).select(*S.POOLS.fieldNames())


def fee_floor_per_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.swap_fees(X.typed_events(spark, sf_dir))


def fee_rate_and_apr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_metrics_full(spark, sf_dir, DAY).select(
        "chain_id", "pool_address", "window_start", "fee_rate0", "fee_rate1", "apr")


def tvl_asof_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_metrics_full(spark, sf_dir, HOUR).select(
        "pool_address", "window_start", "tvl0", "tvl1", "tvl_method")


def _resume_point(events: DataFrame) -> int:
    """A stored high-water mark for the demo runs: the middle of the data's time span."""
    from tidepool.functions.bigint import idiv
    r = events.agg(idiv(F.min("timestamp") + F.max("timestamp"), 2).alias("s")).first()
    return int(r["s"])


def _swap_metrics(windows: DataFrame, tokens: DataFrame) -> DataFrame:
    d = N.attach_decimals(A.drop_missing_meta(windows), tokens)
    return d.select(
        "chain_id", "pool_address", "window_start", "window_end", "swap_count",
        N.format_raw("volume0_raw", "decimals0").alias("volume0"),
        N.format_raw("volume1_raw", "decimals1").alias("volume1"),
        N.format_raw("fee0_raw", "decimals0").alias("fee0"),
        N.format_raw("fee1_raw", "decimals1").alias("fee1"))


def incremental_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run resuming after a stored high-water mark: whole windows from the
    boundary of the first unprocessed second (P11, W4, W5)."""
    ev = X.typed_events(spark, sf_dir)
    start = A.align_start(_resume_point(ev), DAY)
    return _swap_metrics(A.window_aggregate(ev, DAY, start_ts=start), X.tokens(spark, sf_dir))


def _fresh(spark: SparkSession, label: str) -> str:
    """A folder of this run's own below the shared checkpoint folder."""
    import uuid

    from tidepool.session import checkpoint_subdir
    return checkpoint_subdir(spark, f"{label}-{uuid.uuid4().hex}")


def state_after_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State written by a first run over the older half and a second over all, and read back."""
    from tidepool.plans import jobs as J
    ev, path, name = X.typed_events(spark, sf_dir), _fresh(spark, "state"), f"aggregator:{DAY}"
    s = _resume_point(ev)
    for run, part in enumerate((ev.where(F.col("timestamp") <= s), ev), start=1):
        top = A.window_aggregate(part, DAY).agg(F.coalesce(F.max("max_ts"), F.lit(0))).first()[0]
        row = U.state_row(spark, name, int(top), J.load_state(spark, path, name))
        U.require_contract(row, list(S.STATE_KEY), list(S.STATE_NOT_NULL), "state")
        U.write_version(row, path, run)
    return U.read_latest(spark, path, ["name"]).select("name", "last_processed_ts")


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.run_counters(X.typed_events(spark, sf_dir), DAY)


def _two_runs(spark: SparkSession, path: str, ev: DataFrame, rows) -> None:
    """``rows(events, start)`` of the older half, then of a run that resumes there, written as versions."""
    s = _resume_point(ev)
    U.write_version(rows(ev.where(F.col("timestamp") <= s), 0), path, 1)
    U.write_version(rows(ev, A.align_start(s, DAY)), path, 2)


def upsert_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs written as versions (the second re-computes from a window
    boundary); the reader view keeps the latest row per key (S7, S10, W6, W9)."""
    ev, tok, path = X.typed_events(spark, sf_dir), X.tokens(spark, sf_dir), _fresh(spark, "upsert")
    _two_runs(spark, path, ev, lambda e, start: _swap_metrics(A.window_aggregate(e, DAY, start), tok))
    key = ["chain_id", "pool_address", "window_start"]
    U.require_contract(U.read_latest(spark, path, key), key, ["swap_count", "volume0", "volume1"], "metrics")
    return U.read_latest(spark, path, key).drop("batch_id", "created_at", "updated_at")


_MIXED_COLS = ["chain_id", "pool_address", "window_start", "token0", "token1", "fee", "swap_count", "volume0_raw",
               "volume1_raw", "fee0_raw", "fee1_raw", "first_block", "last_block", "n_events"]


def incremental_mixed_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first and a resumed run over events that disagree about their pools equal one full run."""
    ev, path = X.typed_events_mixed_meta(spark, sf_dir), _fresh(spark, "mixed")
    _two_runs(spark, path, ev, lambda e, start: A.drop_missing_meta(A.window_aggregate(e, DAY, start)).select(*_MIXED_COLS))
    return U.read_latest(spark, path, ["chain_id", "pool_address", "window_start"]).select(*_MIXED_COLS)


def incremental_merge(spark: SparkSession, sf_dir: str, w: int = DAY) -> DataFrame:
    """Three runs of ``merge_job``, each reading only events behind the state, with the buffers compacted between
    (W2, W4, W5, A3, A4): the metrics equal one full run."""
    from tidepool.plans import jobs as J
    ev, tok, bal, path = X.typed_events(spark, sf_dir), X.tokens(spark, sf_dir), X.balances(spark, sf_dir), _fresh(spark, "merge")
    s = _resume_point(ev)
    for run, top in enumerate((s, s + 10 * HOUR, None)):
        J.merge_job(spark, ev if top is None else ev.where(F.col("timestamp") <= top), tok, bal, path, w)
        if run == 1:
            J.compact_buffers(spark, path + "/buffers")
    return J.read_metrics(spark, path)


ROLLUP_WIDTHS = (300, HOUR, DAY)


def window_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute, hourly and daily windows from one read of the events."""
    rows = A.window_rollup(X.typed_events(spark, sf_dir), list(ROLLUP_WIDTHS))
    return rows.select("chain_id", "pool_address", "window_size_seconds", "window_start", "swap_count", "volume0_raw",
                       "volume1_raw", "fee0_raw", "fee1_raw", "first_block", "last_block", "n_events")


def bad_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = A.window_aggregate(X.typed_events_bad_amounts(spark, sf_dir), DAY)
    return w.select("pool_address", "window_start", "swap_count", "volume0_raw", "volume1_raw",
                    "fee0_raw", "fee1_raw", "n_events")


# ---------------------------------------------------------------------------
# Ingest and snapshots.

SCAN_POOLS = 10              # address list of the scan: pools 0..9
SCAN_TOPICS = ("Swap", "Mint")


def log_scan_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = I.normalize_logs(X.raw_logs(spark, sf_dir)).withColumn("topic0", F.get(F.col("topics"), 0))
    latest = logs.agg(F.max("block_number").alias("m")).first()["m"]
    start = I.resume_from(1, latest // 4)
    addrs = ["0x" + format(p, "x").rjust(40, "0") for p in range(SCAN_POOLS)]
    topics = [D.EVENTS[n].topic0 for n in SCAN_TOPICS]
    s = I.scan_logs(logs, start, 0, addrs, topics)
    return s.select("chain_id", "block_number", "tx_hash", "log_index", "address",
                    "topic0", F.size("topics").cast("bigint").alias("n_topics"))


_LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def dedup_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = X.logs_from_lineitem(spark, sf_dir)
    d = I.dedup_logs(logs, order_by=[F.col(c) for c in _LINEITEM_ORDER])
    return d.select("chain_id", "block_number", "tx_hash", "log_index", "l_partkey", "l_suppkey")


BLOCK_BATCH = 1000


def block_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return I.split_range(spark, lo, hi, BLOCK_BATCH)


def log_with_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = I.attach_block_time(X.raw_logs(spark, sf_dir), X.blocks_from_orders(spark, sf_dir))
    return logs.select("chain_id", "block_number", "log_index", "timestamp", "block_time_missing")


def token_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = SN.build_tokens(X.token_calls(spark, sf_dir))
    return t.select("chain_id", "address", F.col("decimals").cast("bigint").alias("decimals"), "symbol", "name")


def live_meta_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = D.decode_logs(X.raw_logs(spark, sf_dir), X.pool_meta(spark, sf_dir),
                      pool_live=X.pool_live(spark, sf_dir))
    te = D.typed_events(d)
    return te.select("chain_id", "block_number", "log_index",
                     F.col("pool_meta.liquidity").alias("liquidity"),
                     F.col("pool_meta.slot0.sqrt_price_x96").alias("sqrt_price_x96"),
                     F.col("pool_meta.slot0.tick").alias("tick"))


def window_mixed_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of events whose metadata differs in spelling or is missing, by their pool's where they have none."""
    windows = A.window_aggregate(X.typed_events_mixed_meta(spark, sf_dir), DAY, fill_meta=True)
    return A.drop_missing_meta(windows).select(*_MIXED_COLS)


def wide_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of more than 80 digits add up exactly with plain ones."""
    w = A.window_aggregate(X.typed_events_wide(spark, sf_dir), DAY)
    return w.select("pool_address", "window_start", "swap_count", "volume0_raw", "volume1_raw", "fee0_raw", "fee1_raw")


def dedup_removed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies that differ: the unremoved one, then the smallest, whatever the input order."""
    return I.dedup_logs(X.removed_logs_from_lineitem(spark, sf_dir)).select(
        "chain_id", "block_number", "log_index", "removed", "block_hash", "data")


def dup_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated block headers and a log table: every log once, with the smallest time."""
    b = X.blocks_from_orders(spark, sf_dir)
    twice = b.unionByName(b.withColumn("timestamp", F.col("timestamp") + 100))
    logs = I.attach_block_time(X.raw_logs(spark, sf_dir), twice)
    return logs.select("chain_id", "block_number", "log_index", "timestamp", "block_time_missing")


def dup_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A token dimension that repeats tokens does not repeat windows."""
    t = X.tokens(spark, sf_dir)
    twice = t.unionByName(t.withColumn("decimals", F.lit(0).cast("short")))
    return _swap_metrics(A.window_aggregate(X.typed_events(spark, sf_dir), DAY), twice)


def open_window_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.open_window_state(A.window_aggregate(X.typed_events(spark, sf_dir), DAY))


def run_counters_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a resumed run over events with unreadable swaps."""
    start = A.align_start(_resume_point(X.typed_events(spark, sf_dir)), DAY)
    return A.run_counters(X.typed_events_bad_amounts(spark, sf_dir), DAY, start)


QUERIES.update({
    "window_mixed_meta": window_mixed_meta,
    "wide_amounts": wide_amounts,
    "dedup_removed_logs": dedup_removed_logs,
    "dup_snapshots": dup_snapshots,
    "dup_tokens": dup_tokens,
    "open_window_state": open_window_state,
    "run_counters_bad": run_counters_bad,
    "window_block_bounds": window_block_bounds,
    "pool_registry": pool_registry,
    "fee_floor_per_swap": fee_floor_per_swap,
    "fee_rate_and_apr": fee_rate_and_apr,
    "tvl_asof_fallback": tvl_asof_fallback,
    "incremental_recompute": incremental_recompute,
    "state_after_run": state_after_run,
    "run_counters": run_counters,
    "upsert_latest_wins": upsert_latest_wins,
    "incremental_mixed_meta": incremental_mixed_meta,
    "incremental_merge": incremental_merge,
    "window_rollup": window_rollup,
    "bad_amounts": bad_amounts,
    "log_scan_filtered": log_scan_filtered,
    "dedup_logs": dedup_logs,
    "block_ranges": block_ranges,
    "log_with_timestamp": log_with_timestamp,
    "token_dim": token_dim,
    "live_meta_asof": live_meta_asof,
})
ORACLES.update({
    "window_mixed_meta": O.window_mixed_meta(),
    "wide_amounts": O.wide_amounts(),
    "dedup_removed_logs": O.dedup_removed_logs(),
    "dup_snapshots": O.log_with_timestamp(),
    "dup_tokens": O.window_swap_metrics(DAY),
    "open_window_state": O.open_window_state(),
    "run_counters_bad": O.run_counters_bad(),
    "window_block_bounds": O.window_block_bounds(),
    "pool_registry": O.pool_registry(),
    "fee_floor_per_swap": O.fee_floor_per_swap(),
    "fee_rate_and_apr": O.window_metrics_full(DAY, "chain_id, pool_address, window_start, fee_rate0, fee_rate1, apr"),
    "tvl_asof_fallback": O.window_metrics_full(HOUR, "pool_address, window_start, tvl0, tvl1, tvl_method"),
    "incremental_recompute": O.incremental_recompute(),
    "state_after_run": O.state_after_run(),
    "run_counters": O.run_counters(),
    "upsert_latest_wins": O.window_swap_metrics(DAY),
    "incremental_mixed_meta": O.window_mixed_meta(per_window=True),
    "incremental_merge": O.window_metrics_full(DAY),
    "window_rollup": O.window_rollup(ROLLUP_WIDTHS),
    "bad_amounts": O.bad_amounts(),
    "log_scan_filtered": O.log_scan_filtered(SCAN_POOLS, SCAN_TOPICS),
    "dedup_logs": O.dedup_logs(_LINEITEM_ORDER),
    "block_ranges": O.block_ranges(BLOCK_BATCH),
    "log_with_timestamp": O.log_with_timestamp(),
    "token_dim": O.token_dim(),
    "live_meta_asof": O.live_meta_asof(),
})


# ---------------------------------------------------------------------------
# Structured Streaming.

STREAM_SLICES = 2


def _landed(df: DataFrame, path: str) -> DataFrame:
    """A dimension as a table of its own, so that every micro-batch knows its size and none derives it again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stream(spark: SparkSession, sf_dir: str) -> str:
    """Raw logs landed as time-ordered slices, each consumed before the next one lands; the work folder."""
    import uuid

    from tidepool.session import checkpoint_subdir
    from tidepool.streaming import stream as ST

    work = checkpoint_subdir(spark, f"stream-demo-{uuid.uuid4().hex}")
    lo, hi = X.raw_logs(spark, sf_dir).agg(F.min("block_number"), F.max("block_number")).first()
    step = (hi - lo) // STREAM_SLICES + 1
    meta, tokens, bal = (_landed(make(spark, sf_dir), f"{work}/{make.__name__}") for make in (X.pool_meta, X.tokens, X.balances))
    for i in range(STREAM_SLICES):
        ST.append_files(X.raw_logs(spark, sf_dir, blocks=(lo + i * step, lo + (i + 1) * step - 1)), f"{work}/landing")
        ST.run_once(spark, f"{work}/landing", meta, tokens, bal, work, DAY, lateness="1 day")
    return work


def stream_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming job's keyed table equals the batch result."""
    from tidepool.streaming import stream as ST
    return ST.read_stream_metrics(spark, _stream(spark, sf_dir) + "/metrics")


def stream_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming job's pool registry, merged over its micro-batches."""
    pools = U.merge_pools(spark.read.parquet(_stream(spark, sf_dir) + "/pools"))
    return pools.select("chain_id", "pool_address", "token0", "token1", "fee", "tick_spacing", "first_seen_block")


def stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the streaming job over damaged logs."""
    import uuid

    from tidepool.session import checkpoint_subdir
    from tidepool.streaming import stream as ST
    work = checkpoint_subdir(spark, f"stream-errors-{uuid.uuid4().hex}")
    ST.append_files(X.raw_logs(spark, sf_dir, faults=True), f"{work}/landing")
    return ST.run_errors_once(spark, f"{work}/landing", _landed(X.pool_meta(spark, sf_dir), f"{work}/pool_meta"), work)


QUERIES.update({"stream_window_metrics": stream_window_metrics, "stream_pools": stream_pools,
                "stream_errors": stream_errors})
ORACLES.update({"stream_window_metrics": O.window_metrics_full(DAY), "stream_pools": O.pool_registry(DAY),
                "stream_errors": O.decode_errors()})


# Streams with state of their own.

SILENT_POOL = 7              # has no event in the last slice
RESUME_LATENESS_DAYS = 20
LATE_MOD, LATE_REST = 97, 13  # events of the first slice that land with the last one
LATE_SLICES = 3
LATE_DAYS = 3


def _slim_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema("chain_id long, block_number long, tx_hash string, log_index long, pool_address string, "
                                   "timestamp long").parquet(path)


def _slim_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.typed_events(spark, sf_dir).select("chain_id", "block_number", "tx_hash", "log_index",
                                                F.lower("address").alias("pool_address"), "timestamp")


def _done(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _block_slice(rows: DataFrame, n: int):
    """The column that numbers ``n`` equal block ranges from 0."""
    from tidepool.functions.bigint import idiv
    lo, hi = rows.agg(F.min("block_number"), F.max("block_number")).first()
    return idiv(F.col("block_number") - lo, (hi - lo) // n + 1)


def stream_state_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open windows per pool and the resume point over all of them, one pool being silent in the last slice."""
    from tidepool.streaming import open_windows as W
    work, rows = _fresh(spark, "stream-open"), _slim_events(spark, sf_dir)
    part = _block_slice(rows, STREAM_SLICES)
    silent = F.lit("0x" + format(SILENT_POOL, "x").rjust(40, "0"))
    for i in range(STREAM_SLICES):
        landed = rows.where((part == i) & ((F.col("pool_address") != silent) | F.lit(i < STREAM_SLICES - 1)))
        landed.write.mode("append").parquet(f"{work}/landing")
        _done(W.start_open_windows(spark, _slim_stream(spark, f"{work}/landing"), work, DAY, f"{RESUME_LATENESS_DAYS} days"))
    pools = W.read_open_windows(spark, work)
    point = W.resume_point(pools).first()["last_processed_ts"]
    return pools.select("chain_id", "pool_address", "lowest_open", "latest", "n_open",
                        F.lit(point).cast("bigint").alias("last_processed_ts"))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows of a stream, as the rows themselves and as the operator's own counter."""
    from tidepool.streaming import ingest as G
    work, rows = _fresh(spark, "stream-late"), _slim_events(spark, sf_dir)
    part = _block_slice(rows, LATE_SLICES)
    n = F.conv(F.substring("tx_hash", 3, 64), 16, 10).cast("bigint")
    when = F.when((part == 0) & (n % LATE_MOD == LATE_REST), LATE_SLICES - 1).otherwise(part)
    name = "unique-" + work[-32:]
    dropped = G.DroppedRows(name)
    for i in range(LATE_SLICES):
        rows.where(when == i).write.mode("append").parquet(f"{work}/landing")
        events = _slim_stream(spark, f"{work}/landing")
        q = G.start_unique_events(spark, events, work, f"{LATE_DAYS} days", name)
        _done(q)
        for progress in q.recentProgress:
            dropped.take(progress)
        _done(G.start_late_rows(spark, events, work, LATE_DAYS * DAY))
    late = spark.read.parquet(f"{work}/late_rows").groupBy("pool_address").agg(F.count(F.lit(1)).alias("late_rows"))
    return late.withColumn("dropped_by_operator", F.lit(dropped.total).cast("bigint"))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs joined with headers that land a slice later, then the first slice delivered once more."""
    from tidepool.streaming import ingest as G
    work, chain = _fresh(spark, "stream-ingest"), X.CHAIN_ID
    logs_dir, headers_dir = f"{work}/landing-logs", f"{work}/landing-headers"
    logs = X.raw_logs(spark, sf_dir)
    lo, hi = logs.agg(F.min("block_number"), F.max("block_number")).first()
    headers = X.blocks_from_orders(spark, sf_dir).where(F.col("block_number").between(lo, hi))
    step = (hi - lo) // LATE_SLICES + 1

    def land(df: DataFrame, i: int, path: str) -> None:
        df.where(F.col("block_number").between(lo + i * step, lo + (i + 1) * step - 1)).write.mode("append").json(path)
    for i in range(LATE_SLICES + 1):
        land(logs, i % LATE_SLICES, logs_dir)           # at last the first slice again
        land(headers, i - 1, headers_dir)
        if i == LATE_SLICES:
            G.land_heartbeat(spark, logs_dir, headers_dir, chain, hi + 4 * step)
        _done(G.start_ingest(spark, logs_dir, headers_dir, work, 2 * step, chain))
    return G.read_ingested(spark, work).select("chain_id", "block_number", "log_index", "timestamp", "block_time_missing")


QUERIES.update({"stream_state_resume": stream_state_resume, "stream_late_rows": stream_late_rows,
                "stream_ingest": stream_ingest})
ORACLES.update({
    "stream_state_resume": O.stream_state_resume(STREAM_SLICES, SILENT_POOL, RESUME_LATENESS_DAYS * DAY),
    "stream_late_rows": O.stream_late_rows(LATE_SLICES, LATE_MOD, LATE_REST, LATE_DAYS * DAY),
    "stream_ingest": O.log_with_timestamp(),
})


# ---------------------------------------------------------------------------
# Files, combined faults, stored tables.

def jsonl_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of typed events read from JSON lines, some of them damaged (S3)."""
    from tidepool.sources import logs as L
    path = _fresh(spark, "event-lines")
    X.typed_event_lines(spark, sf_dir).write.text(path)
    return A.window_aggregate(L.read_typed_events_jsonl(spark, path), DAY).select(
        "pool_address", "window_start", "swap_count", "volume0_raw", "n_events", "n_failed")


def decode_combined_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs with several faults each: the first error in the fixed order is reported."""
    return D.decode_errors(D.decode_logs(X.raw_logs_combined_faults(spark, sf_dir), X.pool_meta(spark, sf_dir)))


BASE_BUCKETS = 8


def upsert_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run as bucketed base, two resumed ones as deltas, merged, compacted and read again."""
    import uuid
    ev, tok, path = X.typed_events(spark, sf_dir), X.tokens(spark, sf_dir), _fresh(spark, "compacted")
    key, table = ["chain_id", "pool_address", "window_start"], f"tidepool_base_{uuid.uuid4().hex}"
    s = _resume_point(ev)
    U.write_version(_swap_metrics(A.window_aggregate(ev.where(F.col("timestamp") <= s), DAY), tok), f"{path}/v", 1)
    U.write_base(spark.read.parquet(f"{path}/v"), table, f"{path}/base", key, BASE_BUCKETS)
    for run, top in ((2, s + 5 * DAY), (3, None)):
        later = ev if top is None else ev.where(F.col("timestamp") <= top)
        U.write_version(_swap_metrics(A.window_aggregate(later, DAY, A.align_start(s, DAY)), tok), f"{path}/deltas", run)
    merged = U.merge_base(spark, table, spark.read.parquet(f"{path}/deltas"), key, BASE_BUCKETS)
    U.write_base(merged, f"{table}_2", f"{path}/base2", key, BASE_BUCKETS)
    return spark.table(f"{table}_2").drop("created_at", "updated_at")


def log_scan_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered scan over logs laid out by (address, topic0, block) with Bloom filters."""
    from tidepool.sources import sinks as K
    path = _fresh(spark, "clustered")
    logs = I.normalize_logs(X.raw_logs(spark, sf_dir)).withColumn("topic0", F.get(F.col("topics"), 0))
    K.write_clustered(logs, path)
    stored = spark.read.parquet(path)
    latest = stored.agg(F.max("block_number").alias("m")).first()["m"]
    addrs = ["0x" + format(p, "x").rjust(40, "0") for p in range(SCAN_POOLS)]
    s = I.scan_logs(stored, I.resume_from(1, latest // 4), 0, addrs, [D.EVENTS[n].topic0 for n in SCAN_TOPICS])
    return s.select("chain_id", "block_number", "tx_hash", "log_index", "address", "topic0",
                    F.size("topics").cast("bigint").alias("n_topics"))


QUERIES.update({"jsonl_events": jsonl_events, "decode_combined_errors": decode_combined_errors,
                "upsert_compacted": upsert_compacted, "log_scan_clustered": log_scan_clustered})
ORACLES.update({"jsonl_events": O.jsonl_events(), "decode_combined_errors": O.decode_combined_errors(),
                "upsert_compacted": O.window_swap_metrics(DAY), "log_scan_clustered": O.log_scan_filtered(SCAN_POOLS, SCAN_TOPICS)})


def stream_tvl_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TVL of hourly windows from balance snapshots that stream in beside them (J6, W1): equals the batch result."""
    from tidepool.streaming import asof_state as V
    work = _fresh(spark, "stream-asof")
    windows = A.drop_missing_meta(A.window_aggregate(X.typed_events(spark, sf_dir), HOUR))
    windows = N.cut_lineage(N.attach_decimals(windows, X.tokens(spark, sf_dir)))
    sides = N.tvl_sides(windows)
    name = F.to_json(F.struct("pool_address", "window_start", "side"))
    asked = sides.select(*V.KEY, F.col("last_block").alias("position"), F.lit(None).cast("string").alias("value"), name.alias("name"))
    held = X.balances(spark, sf_dir).select(*V.KEY, F.col("block_number").alias("position"), F.col("balance").alias("value"),
                                            F.lit(None).cast("string").alias("name"))
    rows = N.cut_lineage(held.unionByName(asked))
    lo, hi = rows.agg(F.min("position"), F.max("position")).first()
    step = (hi - lo) // STREAM_SLICES + 1
    beat = spark.range(1).select(F.lit(0).cast("bigint").alias("chain_id"), F.lit("").alias("token"), F.lit("").alias("owner"),
                                 F.lit(hi + 2 * step).cast("bigint").alias("position"), F.lit("0").alias("value"),
                                 F.lit(None).cast("string").alias("name"))
    for i in range(STREAM_SLICES + 1):
        part = beat if i == STREAM_SLICES else rows.where(F.col("position").between(lo + i * step, lo + (i + 1) * step - 1))
        part.write.mode("append").parquet(f"{work}/landing")
        _done(V.start_asof(spark, spark.readStream.schema(V.ROW).parquet(f"{work}/landing"), work, step // 2))
    answers = V.read_answers(spark, work).withColumn("_n", F.from_json("name", "pool_address string, window_start long, side int"))
    found = answers.select("chain_id", "_n.*", F.col("value").alias("_b_balance"), F.col("latest_value").alias("_b_latest_balance"))
    return N.metrics_row(N.pick_tvl(windows, found)).select("pool_address", "window_start", "tvl0", "tvl1", "tvl_method")


QUERIES["stream_tvl_asof"] = stream_tvl_asof
ORACLES["stream_tvl_asof"] = ORACLES["tvl_asof_fallback"]


# ---------------------------------------------------------------------------
# Event layouts as a table.

def decode_custom_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth kind of event decoded because its layout is a further row of the spec table."""
    specs = D.spec_table(spark, (*D.EVENTS.values(), X.custom_spec()))
    d = D.decode_by_spec(X.raw_logs_custom(spark, sf_dir), specs).where("event_name = 'Gift' AND outcome = 'decoded'")
    return d.select(*_DEC_KEYS, "event_name", *[F.col("fields")[c].alias(c) for c in ("giver", "low", "high", "receiver", "part0", "part1")])


def decode_spec_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swaps by the spec table: the same values as the fixed decoder's."""
    d = D.decode_by_spec(X.raw_logs(spark, sf_dir), D.spec_table(spark)).where("event_name = 'Swap' AND outcome = 'decoded'")
    return d.select(*_DEC_KEYS, *[F.col("fields")[c].alias(c) for c in _DEC_FIELDS["Swap"]])


QUERIES.update({"decode_custom_event": decode_custom_event, "decode_spec_swap": decode_spec_swap})
ORACLES.update({"decode_custom_event": O.decode_custom_event(), "decode_spec_swap": O.decode_spec_swap()})
