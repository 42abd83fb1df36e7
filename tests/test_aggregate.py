"""Windowed aggregation: hand-worked cases and the definitions applied to sets of events."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import typed
from tidepool.operators import aggregate as A


def _agg(spark, rows, w=300, start=0):
    return A.window_aggregate(typed(spark, rows), w, start).orderBy("pool_address", "window_start").collect()


def test_fee_on_input_side(spark):
    r = _agg(spark, [dict(timestamp=10, amount0="-1000", amount1="2000", fee=2500)])[0]
    assert (r.fee0_raw, r.fee1_raw, r.volume0_raw, r.volume1_raw, r.swap_count) == ("0", "5", "1000", "2000", 1)


def test_fee_floored_per_swap(spark):
    rows = [dict(timestamp=10, amount0="399", amount1="-1", fee=2500),
            dict(timestamp=11, amount0="399", amount1="-1", fee=2500)]
    r = _agg(spark, rows)[0]
    assert (r.fee0_raw, r.swap_count) == ("0", 2)


def test_same_sign_and_zero_tier(spark):
    same = _agg(spark, [dict(timestamp=10, amount0="5", amount1="5")])[0]
    assert (same.fee0_raw, same.fee1_raw, same.volume0_raw, same.volume1_raw, same.swap_count) == ("0", "0", "5", "5", 1)
    zero = _agg(spark, [dict(timestamp=10, amount0="-7", amount1="9", fee=0)])[0]
    assert (zero.fee1_raw, zero.volume0_raw, zero.swap_count) == ("0", "7", 1)


def test_empty_and_bad_amounts(spark):
    rows = [dict(timestamp=10, amount0="", amount1="-4"), dict(timestamp=11, amount0="1.5", amount1="3"),
            dict(timestamp=12, decoded_null=True)]
    r = _agg(spark, rows)[0]
    assert (r.swap_count, r.volume0_raw, r.volume1_raw, r.n_events) == (2, "0", "4", 3)


def test_window_edge_and_mint_only(spark):
    r = _agg(spark, [dict(timestamp=300, event_name="Mint", amount0="5", amount1="6")])[0]
    assert (r.window_start, r.window_end, r.swap_count, r.volume0_raw, r.fee0_raw) == (300, 600, 0, "0", "0")


def test_missing_meta_dropped(spark):
    w = A.window_aggregate(typed(spark, [dict(timestamp=10, amount0="1", amount1="-1", token0="")]), 300)
    assert A.drop_missing_meta(w).count() == 0 and w.count() == 1


def test_ts_zero_skipped_and_start(spark):
    rows = [dict(timestamp=0, amount0="1", amount1="-1"), dict(timestamp=50, amount0="1", amount1="-1"),
            dict(timestamp=400, amount0="1", amount1="-1")]
    assert sum(r.swap_count for r in _agg(spark, rows)) == 2
    assert sum(r.swap_count for r in _agg(spark, rows, start=50)) == 1


def test_block_bounds(spark):
    rows = [dict(timestamp=20, block=0), dict(timestamp=20, block=7), dict(timestamp=10, block=5),
            dict(timestamp=20, block=6)]
    r = _agg(spark, [dict(r, amount0="1", amount1="-1") for r in rows])[0]
    assert (r.first_block, r.last_block) == (5, 7)


def _by_definition(events, w, fees):
    """Each measure stated over the set of a (pool, window)'s events, whatever their order."""
    groups = {}
    for e in events:
        if e["timestamp"] > 0:
            groups.setdefault((e["address"].lower(), e["timestamp"] // w * w), []).append(e)
    out = {}
    for (pool, start), own in groups.items():
        swaps = [(int(e["amount0"]), int(e["amount1"])) for e in own if e["event_name"] == "Swap"]
        blocks = [e["block"] for e in own if e["block"] > 0]
        out[pool, start] = (
            len(swaps), str(sum(abs(x) for x, _ in swaps)), str(sum(abs(y) for _, y in swaps)),
            str(sum(x * fees[pool] // 10 ** 6 for x, y in swaps if y < 0 < x)),
            str(sum(y * fees[pool] // 10 ** 6 for x, y in swaps if x < 0 < y)),
            min(blocks, default=0), max((e["timestamp"], e["block"]) for e in own)[1])
    return out


def _measures(rows):
    return {(r.pool_address, r.window_start): (r.swap_count, r.volume0_raw, r.volume1_raw, r.fee0_raw, r.fee1_raw,
                                               r.first_block, r.last_block) for r in rows}


@pytest.mark.parametrize("digits", [60, 200])
def test_matches_definition_in_any_order(spark, digits):
    rng = random.Random(11)
    events, ts, block = [], 1, 1
    fees = {"0xp0": 500, "0xp1": 3000, "0xp2": 0}
    for i in range(400):
        ts += rng.randrange(0, 40)
        block += rng.randrange(0, 2)
        pool = f"0xP{rng.randrange(3)}"
        big = rng.choice([1, 10 ** 20, 10 ** 40, 2 ** 128, 10 ** digits])
        events.append(dict(timestamp=ts, block=block, address=pool, event_name=rng.choice(["Swap", "Swap", "Mint"]),
                           amount0=str(rng.randrange(-big, big)), amount1=str(rng.randrange(-big, big)),
                           fee=fees[pool.lower()], tx=f"0x{i:x}", log_index=i))
    rng.shuffle(events)
    assert _measures(_agg(spark, events)) == _by_definition(events, 300, fees)


def test_metadata_never_splits_a_window(spark):
    rows = [dict(timestamp=10, amount0="2", amount1="-1", token0="0xAAAA", fee=500_000),
            dict(timestamp=11, amount0="10", amount1="-1", token0="0xaaaa", fee=500_000),
            dict(timestamp=12, amount0="7", amount1="-1", token0="", token1="", fee=0),
            dict(timestamp=13, amount0="1", amount1="-1", chain_id=57)]
    got = _agg(spark, [dict(r, address="0xPool") for r in rows])
    assert [(r.chain_id, r.token0, r.fee, r.swap_count, r.volume0_raw, r.fee0_raw) for r in sorted(
        got, key=lambda r: r.chain_id)] == [(56, "0xaaaa", 500_000, 3, "19", "9"), (57, "0xaaaa", 2500, 1, "1", "0")]
    assert A.pool_registry(A.window_aggregate(typed(spark, rows), 300)).count() == 2


def test_repeated_logs_count_once(spark):
    twice = [dict(timestamp=10, amount0="5", amount1="-1", tx="0x1", block=4)] * 2
    assert A.window_aggregate(typed(spark, twice), 300, dedup=True).first().swap_count == 1


def test_pool_registry_min_first_block(spark):
    rows = [dict(timestamp=10, block=9), dict(timestamp=700, block=4)]
    reg = A.pool_registry(A.window_aggregate(typed(spark, rows), 300)).collect()
    assert len(reg) == 1 and reg[0].first_seen_block == 4


def test_align_start():
    assert A.align_start(1000, 300) == 899
    assert A.align_start(899, 300) == 899
    assert A.align_start(0, 300) == 0


def test_counters(spark):
    rows = [dict(timestamp=0), dict(timestamp=10, amount0="x", amount1="1"), dict(timestamp=11, amount0="1", amount1="1")]
    c = {r.counter: r.value for r in A.run_counters(typed(spark, rows), 300).collect()}
    assert c == {"total": 3, "skipped": 1, "failed": 1, "decoded": 1}


def test_open_windows_hold_the_state_back(spark):
    rows = [dict(timestamp=1000, address="0xa"), dict(timestamp=1700, address="0xa"), dict(timestamp=700, address="0xb")]
    w = A.window_aggregate(typed(spark, rows), 300)
    assert A.open_window_state(w).first()[0] == 599
    assert A.open_window_state(w.limit(0)).first()[0] == 0


def test_no_sort_aggregate_in_plan(spark):
    events = typed(spark, [dict(timestamp=10, amount0="1", amount1="-1")])
    plan = _plan(A.window_buffers(events, 300))
    assert "SortAggregate" not in _plan(A.window_aggregate(events, 300))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_metadata_is_the_windows_own(spark):
    rows = [dict(timestamp=10, amount0="1000000", amount1="-1", fee=3000), dict(timestamp=310, amount0="1000000", amount1="-1", fee=500)]
    full = {r.window_start: (r.fee, r.fee0_raw) for r in _agg(spark, rows)}
    resumed = {r.window_start: (r.fee, r.fee0_raw) for r in _agg(spark, rows, start=A.align_start(300, 300))}
    assert full == {0: (3000, "3000"), 300: (500, "500")} and resumed == {300: full[300]}
    # the pool's row has the latest window's metadata
    assert [r.fee for r in A.pool_registry(A.window_aggregate(typed(spark, rows), 300)).collect()] == [500]


def test_swaps_pay_their_windows_tier(spark):
    """Tiers that differ inside one window: the highest named one counts, each swap floored under it."""
    rows = [dict(timestamp=10, amount0="399", amount1="-1", fee=2500), dict(timestamp=11, amount0="399", amount1="-1", fee=100),
            dict(timestamp=12, amount0="-1", amount1="4000", token0="", token1="", fee=9000),
            dict(timestamp=13, amount0="1" + "0" * 90, amount1="-1", fee=100)]
    r = _agg(spark, rows)[0]
    assert (r.fee, r.swap_count, r.fee0_raw, r.fee1_raw) == (2500, 4, str(25 * 10 ** 86), "10")


def test_events_are_read_once(spark, tmp_dir):
    typed(spark, [dict(timestamp=10 + i, amount0="5", amount1="-1") for i in range(20)]).write.parquet(f"{tmp_dir}/ev")
    ev = spark.read.parquet(f"{tmp_dir}/ev")
    once = _plan(A.window_buffers(A.events_after(ev, 7, dedup=True), 300))
    assert once.count("Scan parquet") == 1 and once.count("Window [") == 1 and "GreaterThan(timestamp,7)" in once
    assert "Scan parquet" not in _plan(A.window_aggregate(ev, 300, dedup=True))
    rolled = A.window_rollup(ev, [60, 300, 3600])
    assert "Scan parquet" not in _plan(rolled) and rolled.count() == 3


def test_rollup_equals_each_width(spark):
    rng = random.Random(5)
    rows = [dict(timestamp=rng.randrange(1, 20_000), block=i + 1, address=f"0xp{i % 3}", amount0=str(rng.randrange(-9999, 9999)),
                 amount1=str(rng.randrange(-9999, 9999)), fee=rng.choice([500, 3000])) for i in range(300)]
    cols = ["window_size_seconds", "pool_address", "window_start", "fee", "swap_count", "volume0_raw", "fee0_raw", "fee1_raw", "last_block"]
    got = sorted(map(tuple, A.window_rollup(typed(spark, rows), [300, 900, 3600]).select(cols).collect()))
    alone = [r for w in (300, 900, 3600) for r in map(tuple, A.window_aggregate(typed(spark, rows), w).select(cols).collect())]
    assert got == sorted(alone)
    with pytest.raises(ValueError):
        A.window_rollup(typed(spark, rows), [300, 1000])


def test_buffers_merge_in_any_order(spark):
    rows = [dict(timestamp=1 + 40 * i, block=i + 1, amount0=str(10 ** 30 * (i - 9)), amount1=str(7 - i)) for i in range(20)]
    halves = [A.window_buffers(typed(spark, rows[a::3]), 300) for a in range(3)]
    for order in ((0, 1, 2), (2, 0, 1)):
        b = halves[order[0]].unionByName(halves[order[1]]).unionByName(halves[order[2]])
        got = A.finish_windows(A.merge_buffers(b), 300, typed(spark, rows))
        assert _measures(got.collect()) == _measures(_agg(spark, rows))


def test_counters_in_passing(spark):
    rows = [dict(timestamp=0), dict(timestamp=10, amount0="x", amount1="1"), dict(timestamp=11, amount0="1", amount1="1")]
    ev, seen = A.observe_counters(typed(spark, rows), 300, 5)
    A.window_aggregate(ev, 300, 5, dedup=True)
    assert seen.get == {"total": 3, "skipped": 1, "failed": 1}


def test_unnamed_window_takes_its_pools_metadata(spark):
    blank = dict(token0="", token1="", fee=0)
    ev = typed(spark, [dict(timestamp=301, amount0="1000000", amount1="-1", fee=500),
                       dict(timestamp=901, amount0="2000000", amount1="-1", **blank),
                       dict(timestamp=901, address="0xother", amount0="5", amount1="-1", **blank)])
    got = A.drop_missing_meta(A.window_aggregate(ev, 300, fill_meta=True)).orderBy("window_start").collect()
    assert [(r.window_start, r.token0, r.fee, r.fee0_raw) for r in got] == [(300, "0xaaaa", 500, "500"), (900, "0xaaaa", 500, "1000")]
    assert A.drop_missing_meta(A.window_aggregate(ev, 300)).count() == 1
