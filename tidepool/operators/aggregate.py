"""Per-pool tumbling-window aggregation of typed events.

Plan shape: scan -> filter (pushed to Parquet) -> limb projection -> partial
HashAggregate -> shuffle on (chain, pool, window, metadata) -> final
HashAggregate -> window buffers -> carry and render.  The events are read once.
Every aggregate buffer is fixed width (BIGINT / DECIMAL), so both aggregation
phases stay hash based, and map-side partial aggregation absorbs hot pools
before the shuffle: the shuffle carries at most one row per group per input
partition, whatever the skew.

``window_buffers`` are mergeable: buffers of one window from different runs, or
of the narrow windows inside a wide one, add up (``merge_buffers``,
``roll_up``); ``finish_windows`` turns them into rows.

A window is keyed by chain, lower-cased pool and window start alone.  Events
may spell a pool's metadata differently or lack it; a window carries the best
spelling among its own events (both tokens known, then smallest tokens, highest
fee), and its swaps pay that fee tier.  So a window's row follows from its
events alone, whichever run computes it.  Buffers are kept per spelling; only
where swaps were counted under another tier than their window's are those
swaps' events read again.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidepool.functions import bigint as B
from tidepool.functions import wide as X
from tidepool.operators.ingest import LOG_KEY, first_copy
from tidepool.plans.joins import bounded_broadcast
from tidepool.session import cut_lineage

_ORD_SHIFT = 10 ** 12          # block numbers stay far below 10^12

META = ("token0", "token1", "fee", "tick_spacing")
N_FEE = B.LIMBS + 1
GROUP_KEYS = ("chain_id", "pool_address", "window_start")
# Copies of one log are told apart by these columns; the smallest is kept.
EVENT_ORDER = ("block_hash", "event_name", "address", "timestamp", "decoded", "pool_meta")


def window_start(ts: Column, window_seconds: int) -> Column:
    """Epoch-aligned tumbling window start: ts - ts % w (A1)."""
    return ts - ts % F.lit(int(window_seconds))


def _limb_cols(prefix: str, limbs, guard: Column) -> list:
    return [F.when(guard, limb).otherwise(F.lit(0)).alias(f"{prefix}{i}") for i, limb in enumerate(limbs)]


def _amounts() -> tuple[str, str, str, str, str, str]:
    return (*B.sql_decimal_parts("decoded.amount0"), *B.sql_decimal_parts("decoded.amount1"))


def _valid_swap(events: DataFrame) -> str:
    """SQL: a swap whose payload reads."""
    _, _, ok0, _, _, ok1 = _amounts()
    decoded_ok = "coalesce(decoded_ok, false)" if "decoded_ok" in events.columns else "true"
    return f"(coalesce(lower(event_name) = 'swap', false) AND {decoded_ok} AND {ok0} AND {ok1})"


# Amount text that may not fit the limb columns (signs and leading zeros count, which only costs speed).
_LONG = f"(coalesce(greatest(length(decoded.amount0), length(decoded.amount1)), 0) > {B.WIDTH})"


META_SQL = {
    "token0": "lower(coalesce(pool_meta.token0, ''))", "token1": "lower(coalesce(pool_meta.token1, ''))",
    "fee": "CAST(coalesce(pool_meta.fee, 0) AS BIGINT)", "tick_spacing": "CAST(coalesce(pool_meta.tick_spacing, 0) AS INT)"}


def event_terms(events: DataFrame, window_seconds: int, carry: tuple = (), fee: str = META_SQL["fee"]) -> DataFrame:
    """Row-level projection: keys, flags and the limbs each event contributes.

    Staged projections, each materialising what the next one reads several
    times (digit text, limbs, carry levels), so that every generated method
    stays small; the limb arithmetic is SQL text parsed once per stage.

    ``fee`` is the tier in SQL, by default the event's own.  Amounts of more
    than WIDTH digits count as swaps here and add nothing (``wide_sums`` adds
    them).
    """
    w = int(window_seconds)
    if w <= 0:
        raise ValueError("window seconds must be > 0")
    d0, n0, _, d1, n1, _ = _amounts()
    valid = _valid_swap(events)
    is_swap = "coalesce(lower(event_name) = 'swap', false)"
    keys = ["chain_id", "pool_address", "window_start", "block_number", *carry, "ts", "valid_swap", "accepted"]
    stage0 = events.selectExpr(
        "chain_id", "lower(address) AS pool_address", f"timestamp - timestamp % {w} AS window_start",
        f"{fee} AS fee", "block_number", *carry, "timestamp AS ts",
        f"{valid} AS valid_swap", f"(NOT {is_swap} OR {valid}) AS accepted",
        f"CASE WHEN {valid} AND NOT {_LONG} THEN {d0} ELSE '' END AS _d0", f"{n0} AS _n0",
        f"CASE WHEN {valid} AND NOT {_LONG} THEN {d1} ELSE '' END AS _d1", f"{n1} AS _n1",
    )
    # Input side of the swap pays the fee; same-sign swaps and fee tier 0 pay none (A4, Q9).
    side = ("CASE WHEN valid_swap AND fee > 0 AND _n0 AND NOT _n1 AND _d1 != '' THEN 1 "
            "WHEN valid_swap AND fee > 0 AND _n1 AND NOT _n0 AND _d0 != '' THEN 0 END")
    limbs = [f"a0_{i}" for i in range(B.LIMBS)] + [f"a1_{i}" for i in range(B.LIMBS)]
    stage1 = stage0.selectExpr(
        *keys, "fee", f"{side} AS _side",
        *[f"{x} AS a0_{i}" for i, x in enumerate(B.sql_digit_limbs("_d0"))],
        *[f"{x} AS a1_{i}" for i, x in enumerate(B.sql_digit_limbs("_d1"))],
    )
    # Fee limbs: products -> one carry level -> shift + second carry level.
    prod = [f"(CASE WHEN _side = 1 THEN a1_{i} ELSE a0_{i} END) * fee" for i in range(B.LIMBS)]
    m = B.sql_spread(prod)
    stage2 = stage1.selectExpr(*keys, "_side", *limbs, *[f"{x} AS _m{i}" for i, x in enumerate(m)])
    q = B.sql_shift_down([f"_m{i}" for i in range(len(m))])
    stage3 = stage2.selectExpr(*keys, "_side", *limbs, *[f"{x} AS _q{i}" for i, x in enumerate(q)])
    fees = B.sql_spread([f"_q{i}" for i in range(len(q))])[:N_FEE]
    return stage3.selectExpr(
        *keys, *limbs,
        *[f"CASE WHEN _side = 0 THEN {x} ELSE 0 END AS f0_{i}" for i, x in enumerate(fees)],
        *[f"CASE WHEN _side = 1 THEN {x} ELSE 0 END AS f1_{i}" for i, x in enumerate(fees)],
    )


def wide_sums(events: DataFrame, window_seconds: int, fees: DataFrame) -> DataFrame:
    """Exact sums of the swaps with over-long amounts: keys, wide_a0, wide_a1, wide_f0, wide_f1 (text).

    ``fees``: the fee tier of each window that has such swaps.

    Every amount becomes one row per limb, the rows are summed by (window,
    measure, limb) with partial aggregation, and each window is folded once.
    """
    w, (d0, n0, _, d1, n1, _) = int(window_seconds), _amounts()
    valid = _valid_swap(events)
    rows = events.where(F.expr(_LONG)).selectExpr(
        "chain_id", "lower(address) AS pool_address", f"timestamp - timestamp % {w} AS window_start",
        f"CASE WHEN {valid} THEN {d0} ELSE '' END AS a0", f"{n0} AS n0",
        f"CASE WHEN {valid} THEN {d1} ELSE '' END AS a1", f"{n1} AS n1")
    rows = rows.join(bounded_broadcast(fees), list(GROUP_KEYS))
    pays0 = F.expr("fee > 0 AND n1 AND NOT n0 AND a0 != ''")
    pays1 = F.expr("fee > 0 AND n0 AND NOT n1 AND a1 != ''")
    rows = rows.withColumn("f0", F.when(pays0, X.fee_floor("a0", "fee"))).withColumn(
        "f1", F.when(pays1, X.fee_floor("a1", "fee")))
    n = X.LIMB_DIGITS
    measures = rows.select(*GROUP_KEYS, F.explode(F.array(*[
        F.struct(F.lit(c).alias("m"), F.coalesce(c, F.lit("")).alias("d")) for c in ("a0", "a1", "f0", "f1")])).alias("x"))
    count = "CAST(ceil(length(x.d) / {0}) AS INT)".format(n)
    limbs = measures.where("x.d != ''").selectExpr(
        *GROUP_KEYS, "x.m AS m",
        f"posexplode(transform(sequence(1, {count}), i -> CAST(substr(lpad(x.d, {count} * {n}, '0'), "
        f"({count} - i) * {n} + 1, {n}) AS DECIMAL(38,0)))) AS (p, v)")
    sums = limbs.groupBy(*GROUP_KEYS, "m", "p").agg(F.sum("v").alias("v"))
    text = sums.groupBy(*GROUP_KEYS, "m").agg(F.sort_array(F.collect_list(F.struct("p", "v"))).alias("x")).select(
        *GROUP_KEYS, "m", X.fold_limbs(F.col("x.p"), F.col("x.v")).alias("t"))
    return text.groupBy(*GROUP_KEYS).pivot("m", ["a0", "a1", "f0", "f1"]).agg(F.first("t")).select(
        *GROUP_KEYS, *[F.col(c).alias(f"wide_{c}") for c in ("a0", "a1", "f0", "f1")])


def _digits(prefix: str, n: int) -> Column:
    return F.expr(B.sql_to_text([f"{prefix}{i}" for i in range(n)]))


def agg_columns() -> list:
    """The aggregate buffers of a window (shared by batch and streaming).

    All fixed width: BIGINT limb sums, a packed DECIMAL for the last block.
    """
    # Last block: block of the latest timestamp, ties -> later block (A6),
    # packed into one DECIMAL so that max() keeps a fixed-width buffer.
    ord_key = (F.col("ts").cast("decimal(38,0)") * F.lit(_ORD_SHIFT)
               + F.col("block_number").cast("decimal(38,0)"))
    return [
        F.sum(F.col("valid_swap").cast("bigint")).alias("swap_count"),
        *[F.sum(f"a0_{i}").alias(f"a0_{i}") for i in range(B.LIMBS)],
        *[F.sum(f"a1_{i}").alias(f"a1_{i}") for i in range(B.LIMBS)],
        *[F.sum(f"f0_{i}").alias(f"f0_{i}") for i in range(N_FEE)],
        *[F.sum(f"f1_{i}").alias(f"f1_{i}") for i in range(N_FEE)],
        F.min(F.when(F.col("block_number") > 0, F.col("block_number"))).alias("first_block"),
        F.max(ord_key).alias("last_ord"),
        F.max(F.when(F.col("accepted"), F.col("ts"))).alias("max_ts"),
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(~F.col("accepted")).alias("n_failed"),
    ]


BUFFER_KEYS = (*GROUP_KEYS, *META)
_SUMS = ("swap_count", *[f"a{s}_{i}" for s in (0, 1) for i in range(B.LIMBS)],
         *[f"f{s}_{i}" for s in (0, 1) for i in range(N_FEE)], "n_events", "n_failed")
_FEES = [f"f{s}_{i}" for s in (0, 1) for i in range(N_FEE)]


def window_buffers(events: DataFrame, window_seconds: int) -> DataFrame:
    """Aggregate buffers per (chain, pool, window, metadata spelling): BUFFER_KEYS, sums, bounds, has_wide.

    ``has_wide``: some amount text has more than 80 characters.  A buffer row
    has a fixed width and merges with others of its key.
    """
    named = events.selectExpr("*", *[f"{x} AS _m_{c}" for c, x in META_SQL.items()], f"{_LONG} AS has_wide")
    terms = event_terms(named, window_seconds, carry=(*[f"_m_{c}" for c in META], "has_wide"))
    keyed = terms.withColumnsRenamed({f"_m_{c}": c for c in META})
    return keyed.groupBy(*BUFFER_KEYS).agg(*agg_columns(), F.max("has_wide").alias("has_wide"))


def merge_buffers(buffers: DataFrame, keys: tuple = BUFFER_KEYS) -> DataFrame:
    """Add up buffers of the same key, from any runs and in any order."""
    return buffers.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.min("first_block").alias("first_block"), F.max("last_ord").alias("last_ord"),
        F.max("max_ts").alias("max_ts"), F.max("has_wide").alias("has_wide"))


def roll_up(buffers: DataFrame, window_seconds: int) -> DataFrame:
    """Buffers of windows of ``window_seconds`` from those of narrower windows that divide it."""
    return merge_buffers(buffers.withColumn("window_start", window_start(F.col("window_start"), window_seconds)))


def _pool_fill(picked: DataFrame, buffers: DataFrame) -> DataFrame:
    """``picked`` where a window without known tokens carries the best spelling among all events of its pool."""
    named = buffers.where((F.col("token0") != "") & (F.col("token1") != "")).select("chain_id", "pool_address", *META).distinct()
    pools = first_copy(named, ["chain_id", "pool_address"], [F.col("token0"), F.col("token1"), F.desc("fee"), F.desc("tick_spacing")])
    pools = pools.withColumnsRenamed({c: f"_q_{c}" for c in pools.columns})
    j = picked.join(bounded_broadcast(pools), F.col("chain_id").eqNullSafe(F.col("_q_chain_id"))
                    & F.col("pool_address").eqNullSafe(F.col("_q_pool_address")), "left")
    blank = ((F.col("_p_token0") == "") | (F.col("_p_token1") == "")) & F.col("_q_token0").isNotNull()
    return j.select(*buffers.columns, *[F.when(blank, F.col(f"_q_{c}")).otherwise(F.col(f"_p_{c}")).alias(f"_p_{c}") for c in META])


def finish_windows(buffers: DataFrame, window_seconds: int, events: DataFrame, fill_meta: bool = False) -> DataFrame:
    """Window rows from materialised buffers, one per GROUP_KEYS.

    With ``fill_meta`` a window whose own events all lack metadata takes its pool's.

    ``events`` (those the buffers were made of) are only read where buffers
    cannot tell: swaps counted under another fee tier than their window's, and
    amounts of more than 80 digits.
    """
    w = int(window_seconds)
    per = buffers.groupBy(*GROUP_KEYS).agg(F.count(F.lit(1)).alias("n"), F.max("has_wide").alias("wide"))
    facts = per.agg(F.max("n").alias("n"), F.max("wide").alias("wide")).first()
    rows, picks = buffers, buffers.select(*BUFFER_KEYS, "has_wide")
    if fill_meta or (facts.n is not None and facts.n > 1):
        complete = (F.col("token0") != "") & (F.col("token1") != "")
        best = Window.partitionBy(*GROUP_KEYS).orderBy(complete.desc(), "token0", "token1", F.desc("fee"), F.desc("tick_spacing"))
        every = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        picked = buffers.select("*", *[F.first(c).over(every).alias(f"_p_{c}") for c in META])
        picked = _pool_fill(picked, buffers) if fill_meta else picked
        odd = cut_lineage(picked.where((F.col("fee") != F.col("_p_fee")) & (F.col("swap_count") > 0)).select(*BUFFER_KEYS, "_p_fee"))
        off = F.col("fee") != F.col("_p_fee")
        plain = picked.select(*GROUP_KEYS, *[F.col(f"_p_{c}").alias(c) for c in META], *[
            F.when(off, F.lit(0)).otherwise(F.col(c)).cast("bigint").alias(c) if c in _FEES else F.col(c)
            for c in (*_SUMS, "first_block", "last_ord", "max_ts", "has_wide")])
        rows = merge_buffers(plain)
        picks = rows.select(*BUFFER_KEYS, "has_wide")
        if not odd.isEmpty():
            again = _other_tier(events, w, odd)
            rows = rows.join(again, list(GROUP_KEYS), "left").select(*[
                (F.col(c) + F.coalesce(F.col(f"_x_{c}"), F.lit(0))).alias(c) if c in _FEES else F.col(c) for c in rows.columns])
    windows = render_windows(rows, w)
    if not facts.wide:
        return windows
    more = wide_sums(events, w, cut_lineage(picks.where("has_wide").select(*GROUP_KEYS, "fee")))
    names = windows.columns
    j = windows.join(more, list(GROUP_KEYS), "left")
    for raw, c in (("volume0_raw", "a0"), ("volume1_raw", "a1"), ("fee0_raw", "f0"), ("fee1_raw", "f1")):
        j = j.withColumn(raw, F.when(F.col(f"wide_{c}").isNull(), F.col(raw)).otherwise(X.add_text(raw, f"wide_{c}")))
    return j.select(*names)


def _other_tier(events: DataFrame, w: int, odd: DataFrame) -> DataFrame:
    """Fee limbs, under their window's tier, of the swaps whose own metadata names another one."""
    keyed = events.selectExpr("*", "lower(address) AS _k_pool", f"timestamp - timestamp % {w} AS _k_start",
                              *[f"{x} AS _k_{c}" for c, x in META_SQL.items()])
    o = odd.withColumnsRenamed({"chain_id": "_o_chain", "pool_address": "_k_pool", "window_start": "_k_start",
                                **{c: f"_k_{c}" for c in META}})
    own = keyed.join(bounded_broadcast(o), ["_k_pool", "_k_start", *[f"_k_{c}" for c in META]]).where(
        F.col("chain_id").eqNullSafe(F.col("_o_chain")))
    return event_terms(own, w, fee="_p_fee").groupBy(*GROUP_KEYS).agg(*[F.sum(c).alias(f"_x_{c}") for c in _FEES])


def render_windows(g: DataFrame, window_seconds: int, pool_meta: DataFrame | None = None) -> DataFrame:
    """Aggregated buffers -> window rows with metadata and exact integer text.

    The metadata are the buffers' own columns, or those of ``pool_meta`` (chain_id, pool_address, META).
    """
    w = int(window_seconds)
    own = list(META) if pool_meta is None else []
    rows = g.select(
        "chain_id", "pool_address",
        F.lit(w).cast("bigint").alias("window_size_seconds"),
        "window_start",
        (F.col("window_start") + F.lit(w)).alias("window_end"), *own,
        "swap_count",
        _digits("a0_", B.LIMBS).alias("volume0_raw"),
        _digits("a1_", B.LIMBS).alias("volume1_raw"),
        _digits("f0_", N_FEE).alias("fee0_raw"),
        _digits("f1_", N_FEE).alias("fee1_raw"),
        F.coalesce(F.col("first_block"), F.lit(0)).cast("bigint").alias("first_block"),
        (F.col("last_ord") % F.lit(_ORD_SHIFT)).cast("bigint").alias("last_block"),
        "max_ts", "n_events", "n_failed",
    )
    return rows if pool_meta is None else _with_meta(rows, pool_meta)


def _with_meta(rows: DataFrame, pool_meta: DataFrame) -> DataFrame:
    meta = pool_meta.select(F.col("chain_id").alias("_mc"), F.col("pool_address").alias("_mp"), *META)
    j = rows.join(bounded_broadcast(meta), rows["chain_id"].eqNullSafe(F.col("_mc"))
                  & rows["pool_address"].eqNullSafe(F.col("_mp")), "left")
    at = rows.columns.index("swap_count")
    blank = {"token0": F.lit(""), "token1": F.lit(""), "fee": F.lit(0).cast("bigint"), "tick_spacing": F.lit(0)}
    return j.select(*rows.columns[:at], *[F.coalesce(F.col(c), blank[c]).alias(c) for c in META], *rows.columns[at:])


def window_rollup(events: DataFrame, widths: list[int], start_ts: int = 0, dedup: bool = False) -> DataFrame:
    """Windows of several widths from one read of the events (W7): each width a multiple of the narrowest.

    The events are shuffled once, as buffers of the narrowest windows; every
    wider width adds up the next narrower one that divides it.
    """
    order = sorted({int(w) for w in widths})
    if not order or order[0] <= 0 or any(w % order[0] for w in order):
        raise ValueError("widths must be positive multiples of the narrowest")
    ev = events_after(events, start_ts, dedup)
    made, out = {}, None
    for w in order:
        below = max((x for x in made if w % x == 0), default=None)
        made[w] = cut_lineage(window_buffers(ev, w) if below is None else roll_up(made[below], w))
        rows = finish_windows(made[w], w, ev)
        out = rows if out is None else out.unionByName(rows)
    return out


def events_after(events: DataFrame, start_ts: int | Column = 0, dedup: bool = False) -> DataFrame:
    """Events with timestamp > start_ts (P11), repeated logs once if ``dedup``.

    The value 0 always skips ts = 0, as the reference does.  The shuffle of
    the dedup is hashed on the log key, which spreads hot pools evenly.
    """
    start = start_ts if isinstance(start_ts, Column) else F.lit(int(start_ts))
    ev = events.where(F.col("timestamp") > start)
    return first_copy(ev, LOG_KEY, [F.col(c) for c in EVENT_ORDER if c in ev.columns]) if dedup else ev


def window_aggregate(events: DataFrame, window_seconds: int, start_ts: int | Column = 0,
                     dedup: bool = False, fill_meta: bool = False) -> DataFrame:
    """Aggregate typed events into one row per (chain, pool, window).

    Output: chain_id, pool_address, window_size_seconds, window_start,
    window_end, token0, token1, fee, tick_spacing, swap_count, volume0_raw,
    volume1_raw, fee0_raw, fee1_raw (exact unscaled integer text),
    first_block, last_block, max_ts (highest accepted timestamp), n_events,
    n_failed.

    ``start_ts``, ``dedup``: see ``events_after``; ``fill_meta``: see ``finish_windows``.  The buffers are
    checkpointed once, so the events are read once, deduplicated once, and
    what the buffers hold decides whether any of them is read again.
    """
    ev = events_after(events, start_ts, dedup)
    return finish_windows(cut_lineage(window_buffers(ev, window_seconds)), window_seconds, ev, fill_meta)


def swap_fees(events: DataFrame) -> DataFrame:
    """Per-swap fee of each side, floored per swap (A4): raw integer text."""
    t = event_terms(events.where(F.lower(F.col("event_name")) == "swap"), 1, carry=("log_index",))
    return t.select("chain_id", "block_number", "log_index", "pool_address",
                    _digits("f0_", N_FEE).alias("fee0"), _digits("f1_", N_FEE).alias("fee1"))


def align_start(resume_ts: int, window_seconds: int) -> int:
    """Exclusive start for a run resuming after ``resume_ts``: the whole window
    holding the first unprocessed second is recomputed (fixes Q2)."""
    first = resume_ts + 1
    return max(first - first % int(window_seconds) - 1, 0)


def drop_missing_meta(windows: DataFrame) -> DataFrame:
    """Windows whose pool has no token0/token1 produce no metric and no pool row."""
    return windows.where((F.col("token0") != "") & (F.col("token1") != ""))


def pool_registry(windows: DataFrame) -> DataFrame:
    """One row per pool: the latest window's metadata and the lowest first block over all windows."""
    latest = F.max_by(F.struct(*META), "window_start").alias("_m")
    return (drop_missing_meta(windows).groupBy("chain_id", "pool_address")
            .agg(latest, F.min("first_block").alias("first_seen_block"))
            .select("chain_id", "pool_address", *[F.col(f"_m.{c}").alias(c) for c in META], "first_seen_block"))


def open_window_state(windows: DataFrame) -> DataFrame:
    """Resume point while windows are still open (A10): one row, last_processed_ts.

    Each pool's latest window may still grow, so the run has to come back to
    the second before the lowest of them; 0 when there is none.
    """
    latest = windows.groupBy("chain_id", "pool_address").agg(F.max("window_start").alias("open"))
    return latest.agg(F.coalesce(F.greatest(F.min("open") - 1, F.lit(0)), F.lit(0)).cast("bigint")
                      .alias("last_processed_ts"))


def observe_counters(events: DataFrame, window_seconds: int, start_ts: int = 0) -> tuple[DataFrame, Observation]:
    """``events`` with the run's row counters (A11) taken in passing: total, skipped, failed.

    They are there after the first action on the returned frame, which so needs no pass of its own.
    """
    unread = F.col("_parse_error").isNotNull() if "_parse_error" in events.columns else F.lit(False)
    late = F.coalesce(F.col("timestamp") > F.lit(int(start_ts)), F.lit(False))
    swap = F.coalesce(F.lower("event_name") == "swap", F.lit(False))
    bad = ~unread & late & swap & ~F.expr(_valid_swap(events))
    seen = Observation()
    return events.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(~unread & ~late).alias("skipped"),
                          F.count_if(unread | bad).alias("failed")), seen


def counted(seen: Observation, events: DataFrame, window_seconds: int, start_ts: int = 0) -> dict:
    """total, skipped, failed of a run observed by ``observe_counters``.

    Where the optimizer saw that no event is new, nothing ran and nothing was
    observed; they are counted then.
    """
    try:
        return dict(seen.get)
    except Py4JJavaError:
        rows = run_counters(events, window_seconds, start_ts).where("counter != 'decoded'").collect()
        return {r.counter: r.value for r in rows}


def run_counters(events: DataFrame, window_seconds: int, start_ts: int = 0) -> DataFrame:
    """Counters of one aggregation run (A11) as (counter, value) rows.

    total, skipped (ts <= start, or a line that could not be read), failed
    (swap payload or line unreadable) and decoded (= windows emitted, as in the
    reference).  The events are reduced to their windows once, and the counters
    are taken over the windows.
    """
    w, in_run = int(window_seconds), F.col("timestamp") > F.lit(int(start_ts))
    unread = F.col("_parse_error").isNotNull() if "_parse_error" in events.columns else F.lit(False)
    valid, swap = F.expr(_valid_swap(events)), F.coalesce(F.lower("event_name") == "swap", F.lit(False))
    rows = events.select(
        "chain_id", F.lower("address").alias("pool_address"), F.expr(f"timestamp - timestamp % {w}").alias("window_start"),
        unread.alias("unread"), (~unread & ~in_run).alias("early"), (~unread & in_run & swap & ~valid).alias("bad"),
        F.expr("coalesce(pool_meta.token0, '') != '' AND coalesce(pool_meta.token1, '') != ''").alias("named"))
    per = rows.groupBy("unread", "early", *GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"), F.max("named").alias("named"))
    # A window is named if any of its events is; per is one row per window.
    runs = ~F.col("unread") & ~F.col("early")
    counts = per.agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("early"), F.col("n"))).alias("skipped"),
        (F.sum("bad") + F.sum(F.when(F.col("unread"), F.col("n")).otherwise(0))).alias("failed"),
        F.count_if(runs & F.col("named")).alias("decoded"))
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("counter"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("value"))
        for n in ("total", "skipped", "failed", "decoded")])).alias("c")).select("c.*")
