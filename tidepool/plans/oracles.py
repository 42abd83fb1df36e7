"""DuckDB SQL restating the fixture adapters and each query's expected result.

These strings are the correctness oracle: they compute the same answers with
plain HUGEINT arithmetic over the driver's views (events, orders, lineitem),
independently of the limb arithmetic used on the Spark side.  Fixture rules
mirror ``plans.fixtures`` one for one.
"""

from __future__ import annotations

from tidepool.functions.ratios import YEAR_SECONDS
from tidepool.plans import fixtures as X


def _case(expr: str, values: list, quote: bool = False) -> str:
    arms = " ".join(f"WHEN {i} THEN {repr(v) if quote else v}" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def hexaddr(expr: str) -> str:
    return f"('0x' || lpad(lower(hex({expr})), 40, '0'))"


KIND_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in X.KIND_BY_EVENT_TYPE.items()) + " END"

# Adapter E as plain values (amounts as BIGINT).
E_CTE = f"""
e AS (
  SELECT event_id, user_id, event_type,
         user_id % {X.N_POOLS} AS pool,
         CAST({X.CHAIN_ID} AS BIGINT) AS chain_id,
         event_id + 1 AS block_number,
         '0x' || lpad(lower(hex(event_id + 1)), 64, '0') AS block_hash,
         '0x' || lpad(lower(hex(event_id)), 64, '0') AS tx_hash,
         event_id % 7 AS log_index,
         {hexaddr(f'user_id % {X.N_POOLS}')} AS address,
         {KIND_SQL} AS event_name,
         epoch_us(ts) // 1000000 AS timestamp,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(round(value * 100) AS BIGINT) * 1000000
           * (CASE WHEN event_id % 2 = 1 THEN -1 ELSE 1 END) AS a0,
         (CAST(json_extract_string(props, '$.k') AS BIGINT) + 1) * 10000000
           * (CASE WHEN event_id % 2 = 1 THEN 1 ELSE -1 END) AS a1,
         CASE WHEN user_id % {X.N_POOLS} = {X.NO_META_POOL} THEN ''
              ELSE {hexaddr(f'(user_id % {X.N_POOLS}) * 2 + {X.TOKEN_BASE}')} END AS token0,
         {hexaddr(f'(user_id % {X.N_POOLS}) * 2 + {X.TOKEN_BASE + 1}')} AS token1,
         CAST({_case(f'(user_id % {X.N_POOLS}) % 5', X.FEE_BY_POOL_MOD5)} AS BIGINT) AS fee,
         CAST({_case(f'(user_id % {X.N_POOLS}) % 5', X.SPACING_BY_POOL_MOD5)} AS INTEGER) AS tick_spacing
  FROM events)"""

TOKENS_CTE = f"""
pools AS (SELECT DISTINCT user_id % {X.N_POOLS} AS pool FROM events),
tok AS (
  SELECT {hexaddr(f'pool * 2 + {X.TOKEN_BASE}')} AS address,
         {_case('pool % 3', X.DECIMALS_BY_MOD3)} AS decimals
  FROM pools WHERE pool % 7 <> 6
  UNION ALL
  SELECT {hexaddr(f'pool * 2 + {X.TOKEN_BASE + 1}')} AS address,
         {_case('(pool + 1) % 3', X.DECIMALS_BY_MOD3)} AS decimals
  FROM pools WHERE pool % 7 <> 6)"""

_T0 = ", ".join(f"'{t}'" for t in X.SNAPSHOT0_TYPES)
_T1 = ", ".join(f"'{t}'" for t in X.SNAPSHOT1_TYPES)
BALANCES_CTE = f"""
bsrc AS (
  SELECT user_id % {X.N_POOLS} AS pool, event_id + 1 AS block_number, event_type
  FROM events WHERE (user_id % {X.N_POOLS}) % 11 <> {X.NO_BALANCE_POOL_MOD11}),
blast AS (
  SELECT pool, max(block_number) AS block_number FROM bsrc
  WHERE pool % 10 = {X.LATEST_ONLY_POOL_MOD10} GROUP BY pool),
snap AS (
  SELECT pool, block_number, 0 AS side FROM bsrc
  WHERE pool % 10 <> {X.LATEST_ONLY_POOL_MOD10} AND event_type IN ({_T0})
  UNION ALL SELECT pool, block_number, 0 FROM blast
  UNION ALL SELECT pool, block_number, 1 FROM bsrc
  WHERE pool % 10 <> {X.LATEST_ONLY_POOL_MOD10} AND event_type IN ({_T1})
  UNION ALL SELECT pool, block_number, 1 FROM blast),
bal AS (
  SELECT {hexaddr(f'pool * 2 + {X.TOKEN_BASE} + side')} AS token,
         {hexaddr('pool')} AS owner, block_number,
         CAST(1000000000000000 * (side + 1)
              + block_number * (CASE WHEN side = 0 THEN {X.BALANCE_STEP[0]} ELSE {X.BALANCE_STEP[1]} END)
              AS HUGEINT) AS balance
  FROM snap)"""


def fmt_units(v: str, d: str) -> str:
    """M1 for a non-negative HUGEINT and decimals in {0, 6, 18}."""
    pow_ = f"(CASE {d} WHEN 6 THEN CAST(1000000 AS HUGEINT) ELSE CAST(1000000000000000000 AS HUGEINT) END)"
    return (f"(CASE WHEN {d} = 0 THEN CAST({v} AS VARCHAR) ELSE "
            f"CAST({v} // {pow_} AS VARCHAR) || '.' || lpad(CAST({v} % {pow_} AS VARCHAR), {d}, '0') END)")


def fixed18(q: str) -> str:
    """An integer scaled by 10^18 as text with 18 fraction digits."""
    unit = "CAST(1000000000000000000 AS HUGEINT)"
    return f"(CAST({q} // {unit} AS VARCHAR) || '.' || lpad(CAST({q} % {unit} AS VARCHAR), 18, '0'))"


def window_agg_cte(w: int, where: str = "timestamp > 0", name: str = "wagg") -> str:
    """A1-A6 over adapter E for window width ``w`` (valid swaps only carry amounts)."""
    return f"""
{name} AS (
  SELECT chain_id, address AS pool_address, timestamp - timestamp % {w} AS window_start,
         token0, token1, fee, tick_spacing,
         CAST(count(*) FILTER (WHERE event_name = 'Swap') AS BIGINT) AS swap_count,
         sum(CASE WHEN event_name = 'Swap' THEN abs(a0) ELSE 0 END) AS v0,
         sum(CASE WHEN event_name = 'Swap' THEN abs(a1) ELSE 0 END) AS v1,
         sum(CASE WHEN event_name = 'Swap' AND fee > 0 AND a1 < 0 AND a0 > 0
                  THEN abs(a0) * fee // 1000000 ELSE 0 END) AS f0,
         sum(CASE WHEN event_name = 'Swap' AND fee > 0 AND a0 < 0 AND a1 > 0
                  THEN abs(a1) * fee // 1000000 ELSE 0 END) AS f1,
         CAST(coalesce(min(CASE WHEN block_number > 0 THEN block_number END), 0) AS BIGINT) AS first_block,
         CAST(max(CAST(timestamp AS HUGEINT) * 1000000000000 + block_number) % 1000000000000 AS BIGINT)
           AS last_block,
         CAST(max(timestamp) AS BIGINT) AS max_ts,
         CAST(count(*) AS BIGINT) AS n_events
  FROM e WHERE {where}
  GROUP BY ALL)"""


DEC_CTE = """
wd AS (
  SELECT w.*, coalesce(t0.decimals, 0) AS d0, coalesce(t1.decimals, 0) AS d1,
         (t0.decimals IS NOT NULL AND t1.decimals IS NOT NULL) AS decimals_known
  FROM wagg w LEFT JOIN tok t0 ON t0.address = lower(w.token0)
              LEFT JOIN tok t1 ON t1.address = lower(w.token1)
  WHERE w.token0 <> '' AND w.token1 <> '')"""


def window_swap_metrics(w: int = 86400, where: str = "timestamp > 0", pre: str = "") -> str:
    return f"""WITH {E_CTE}, {pre}{TOKENS_CTE}, {window_agg_cte(w, where)}, {DEC_CTE}
SELECT chain_id, pool_address, window_start, CAST(window_start + {w} AS BIGINT) AS window_end, swap_count,
       {fmt_units('v0', 'd0')} AS volume0, {fmt_units('v1', 'd1')} AS volume1,
       {fmt_units('f0', 'd0')} AS fee0, {fmt_units('f1', 'd1')} AS fee1
FROM wd"""


def _tvl_ctes() -> str:
    """J6 over wd: as-of balance at last_block for both tokens, else latest."""
    return f"""{BALANCES_CTE},
side AS (
  SELECT wd.pool_address, wd.window_start, s.side,
         (SELECT arg_max(b.balance, b.block_number) FROM bal b
            WHERE b.token = (CASE s.side WHEN 0 THEN lower(wd.token0) ELSE lower(wd.token1) END)
              AND b.owner = wd.pool_address AND b.block_number <= wd.last_block) AS at_block,
         (SELECT arg_max(b.balance, b.block_number) FROM bal b
            WHERE b.token = (CASE s.side WHEN 0 THEN lower(wd.token0) ELSE lower(wd.token1) END)
              AND b.owner = wd.pool_address) AS latest
  FROM wd, (SELECT 0 AS side UNION ALL SELECT 1) s),
tv AS (
  SELECT pool_address, window_start,
         max(at_block) FILTER (WHERE side = 0) AS ab0, max(at_block) FILTER (WHERE side = 1) AS ab1,
         max(latest) FILTER (WHERE side = 0) AS lt0, max(latest) FILTER (WHERE side = 1) AS lt1
  FROM side GROUP BY ALL),
wt AS (
  SELECT wd.*,
         CASE WHEN ab0 IS NOT NULL AND ab1 IS NOT NULL THEN 'balance_of_block'
              WHEN lt0 IS NOT NULL AND lt1 IS NOT NULL THEN 'balance_of_latest'
              ELSE 'unavailable' END AS tvl_method,
         CASE WHEN ab0 IS NOT NULL AND ab1 IS NOT NULL THEN ab0
              WHEN lt0 IS NOT NULL AND lt1 IS NOT NULL THEN lt0 END AS tvl0_raw,
         CASE WHEN ab0 IS NOT NULL AND ab1 IS NOT NULL THEN ab1
              WHEN lt0 IS NOT NULL AND lt1 IS NOT NULL THEN lt1 END AS tvl1_raw
  FROM wd JOIN tv USING (pool_address, window_start)),
wr AS (
  SELECT wt.*,
    CASE WHEN f0 > 0 AND tvl0_raw > 0
         THEN (2 * CAST(f0 AS HUGEINT) * CAST(1000000000000000000 AS HUGEINT) + tvl0_raw) // (2 * tvl0_raw) END AS r0,
    CASE WHEN f1 > 0 AND tvl1_raw > 0
         THEN (2 * CAST(f1 AS HUGEINT) * CAST(1000000000000000000 AS HUGEINT) + tvl1_raw) // (2 * tvl1_raw) END AS r1
  FROM wt),
wa AS (
  SELECT wr.*,
    CASE WHEN r0 IS NOT NULL AND r1 IS NULL THEN r0 WHEN r1 IS NOT NULL AND r0 IS NULL THEN r1 END AS rsel
  FROM wr)"""


def window_metrics_full(w: int = 86400, cols: str = "*") -> str:
    return f"""WITH {E_CTE}, {TOKENS_CTE}, {window_agg_cte(w)}, {DEC_CTE}, {_tvl_ctes()}
SELECT {cols} FROM (SELECT chain_id, pool_address, CAST({w} AS BIGINT) AS window_size_seconds, window_start,
       CAST(window_start + {w} AS BIGINT) AS window_end, swap_count,
       {fmt_units('v0', 'd0')} AS volume0, {fmt_units('v1', 'd1')} AS volume1,
       {fmt_units('f0', 'd0')} AS fee0, {fmt_units('f1', 'd1')} AS fee1,
       CAST(NULL AS VARCHAR) AS fee_usd,
       CASE WHEN r0 IS NOT NULL THEN {fixed18('r0')} END AS fee_rate0,
       CASE WHEN r1 IS NOT NULL THEN {fixed18('r1')} END AS fee_rate1,
       CASE WHEN tvl0_raw IS NOT NULL THEN {fmt_units('tvl0_raw', 'd0')} END AS tvl0,
       CASE WHEN tvl1_raw IS NOT NULL THEN {fmt_units('tvl1_raw', 'd1')} END AS tvl1,
       CAST(NULL AS VARCHAR) AS tvl_usd,
       CASE WHEN rsel IS NOT NULL
            THEN {fixed18(f'((2 * rsel * {YEAR_SECONDS} + {w}) // (2 * {w}))')} END AS apr,
       'approx_from_feeTier' AS fee_method, tvl_method, decimals_known
FROM wa) full_row"""


# ---------------------------------------------------------------------------
# Decoding (adapter R): the oracle restates E's plain values.

ED_CTE = f"""
ed AS (
  SELECT e.*,
         {hexaddr(f'user_id * 2 + {X.PARTY_BASE}')} AS party0,
         {hexaddr(f'user_id * 2 + {X.PARTY_BASE + 1}')} AS party1,
         CAST(event_id % 1000 - 500 AS INTEGER) AS tick,
         CAST(-(k * 10) AS INTEGER) AS tick_lower,
         CAST(k * 10 + 10 AS INTEGER) AS tick_upper,
         CAST(CAST(user_id + 1 AS HUGEINT) * {X.Q64} + event_id AS VARCHAR) AS liquidity,
         CAST(CAST(k + 1 AS HUGEINT) * {X.Q96} AS VARCHAR) AS sqrt_price_x96,
         CAST(cents * 1000 AS VARCHAR) AS amount,
         event_id % {X.FAULT_MOD} AS f
  FROM e)"""

_DEC_KEYS = "chain_id, block_number, tx_hash, log_index, address"


def decode_event(kind: str) -> str:
    cols = {
        "Swap": "party0 AS sender, party1 AS recipient, CAST(a0 AS VARCHAR) AS amount0, "
                "CAST(a1 AS VARCHAR) AS amount1, sqrt_price_x96, liquidity, tick",
        "Mint": "party1 AS owner, party0 AS sender, tick_lower, tick_upper, amount, "
                "CAST(abs(a0) AS VARCHAR) AS amount0, CAST(abs(a1) AS VARCHAR) AS amount1",
        "Burn": "party1 AS owner, tick_lower, tick_upper, amount, "
                "CAST(abs(a0) AS VARCHAR) AS amount0, CAST(abs(a1) AS VARCHAR) AS amount1",
        "Collect": "party1 AS owner, party0 AS recipient, tick_lower, tick_upper, "
                   "CAST(abs(a0) AS VARCHAR) AS amount0, CAST(abs(a1) AS VARCHAR) AS amount1",
    }[kind]
    return f"""WITH {E_CTE}, {ED_CTE}
SELECT {_DEC_KEYS}, {cols}, token0, token1, fee, tick_spacing
FROM ed WHERE event_name = '{kind}'"""


_N_TOPICS = "(CASE WHEN event_name = 'Swap' THEN 3 ELSE 4 END)"
_N_WORDS = "(CASE event_name WHEN 'Swap' THEN 5 WHEN 'Mint' THEN 4 ELSE 3 END)"
_ERROR_SQL = f"""CASE f
    WHEN 1 THEN 'missing topic0'
    WHEN 3 THEN 'invalid pool address: 0x1234'
    WHEN 4 THEN 'pool meta not found: {X.UNKNOWN_POOL}'
    WHEN 5 THEN 'expected ' || {_N_TOPICS} || ' topics, got ' || ({_N_TOPICS} - 1)
    WHEN 6 THEN 'topic length 33'
    WHEN 7 THEN 'invalid topic: invalid hex string'
    WHEN 8 THEN 'invalid data: hex string of odd length'
    WHEN 9 THEN 'unpack ' || event_name || ': abi: cannot marshal in to go type: length insufficient 64 require 96'
    WHEN 10 THEN 'unpack ' || event_name || ': abi: attempting to unmarshall an empty string while arguments are expected'
    WHEN 11 THEN 'int24 overflow: 8388608'
  END"""
_TOPIC0_SQL = ("CASE WHEN f = 1 THEN '' WHEN f = 12 THEN upper(sig) "
               f"WHEN f = 14 AND event_name = 'Swap' THEN '{X.FORK_SWAP_TOPIC0}' ELSE sig END")


def _sig_sql() -> str:
    from tidepool.operators.decode import EVENTS
    return "CASE event_name " + " ".join(f"WHEN '{n}' THEN '{e.topic0}'" for n, e in EVENTS.items()) + " END"


FAULTY_CTE = f"""
fr AS (
  SELECT ed.*, {_sig_sql()} AS sig,
         CASE f WHEN 3 THEN '0x1234' WHEN 4 THEN '{X.UNKNOWN_POOL}' ELSE address END AS log_address
  FROM ed),
fo AS (
  SELECT fr.*, {_TOPIC0_SQL} AS topic0, {_ERROR_SQL} AS error,
         CASE WHEN f = 2 THEN 'skipped'
              WHEN f = 14 AND event_name = 'Swap' THEN 'skipped'
              WHEN f BETWEEN 1 AND 11 THEN 'failed' ELSE 'decoded' END AS outcome
  FROM fr)"""


def decode_errors() -> str:
    return f"""WITH {E_CTE}, {ED_CTE}, {FAULTY_CTE}
SELECT chain_id, block_number, tx_hash, log_index, log_address AS address, topic0, error
FROM fo WHERE outcome = 'failed'"""


def decode_counters() -> str:
    return f"""WITH {E_CTE}, {ED_CTE}, {FAULTY_CTE}
SELECT outcome AS counter, CAST(count(*) AS BIGINT) AS value FROM fo GROUP BY outcome
UNION ALL SELECT 'total', CAST(count(*) AS BIGINT) FROM fo"""


def route_topics(extra_map: bool) -> str:
    fork = "f = 14 AND event_name = 'Swap'"
    name = (f"CASE WHEN f IN (1, 2) THEN NULL WHEN {fork} THEN {'event_name' if extra_map else 'NULL'} "
            "ELSE event_name END")
    outcome = f"CASE WHEN {fork} THEN '{'decoded' if extra_map else 'skipped'}' ELSE outcome END"
    return f"""WITH {E_CTE}, {ED_CTE}, {FAULTY_CTE}
SELECT {name} AS event_name, {outcome} AS outcome, CAST(count(*) AS BIGINT) AS n
FROM fo GROUP BY ALL"""


# ---------------------------------------------------------------------------
# Aggregation details, state, upserts, ingest, snapshots.

def window_rollup(widths: tuple) -> str:
    ctes = ",".join(window_agg_cte(w, name=f"w{w}") for w in widths)
    rows = " UNION ALL ".join(f"""
SELECT chain_id, pool_address, CAST({w} AS BIGINT) AS window_size_seconds, window_start, swap_count,
       CAST(v0 AS VARCHAR) AS volume0_raw, CAST(v1 AS VARCHAR) AS volume1_raw, CAST(f0 AS VARCHAR) AS fee0_raw,
       CAST(f1 AS VARCHAR) AS fee1_raw, first_block, last_block, n_events FROM w{w}""" for w in widths)
    return f"WITH {E_CTE},{ctes}{rows}"


def window_block_bounds(w: int = 86400) -> str:
    return f"""WITH {E_CTE}, {window_agg_cte(w)}
SELECT chain_id, pool_address, window_start, first_block, last_block, n_events FROM wagg"""


def pool_registry(w: int = 3600) -> str:
    return f"""WITH {E_CTE}, {window_agg_cte(w)}
SELECT chain_id, pool_address, token0, token1, fee, tick_spacing,
       CAST(min(first_block) AS BIGINT) AS first_seen_block
FROM wagg WHERE token0 <> '' AND token1 <> '' GROUP BY ALL"""


def fee_floor_per_swap() -> str:
    return f"""WITH {E_CTE}
SELECT chain_id, block_number, log_index, address AS pool_address,
       CAST(CASE WHEN fee > 0 AND a1 < 0 AND a0 > 0 THEN abs(a0) * fee // 1000000 ELSE 0 END AS VARCHAR) AS fee0,
       CAST(CASE WHEN fee > 0 AND a0 < 0 AND a1 > 0 THEN abs(a1) * fee // 1000000 ELSE 0 END AS VARCHAR) AS fee1
FROM e WHERE event_name = 'Swap'"""


_RESUME = "rp AS (SELECT (min(timestamp) + max(timestamp)) // 2 AS s FROM e),"


def incremental_recompute(w: int = 86400) -> str:
    where = f"timestamp > (SELECT greatest((s + 1) - (s + 1) % {w} - 1, 0) FROM rp) AND timestamp > 0"
    return window_swap_metrics(w, where, pre=_RESUME)


def state_after_run(w: int = 86400) -> str:
    return f"""WITH {E_CTE}
SELECT 'aggregator:{w}' AS name, CAST(coalesce(max(timestamp), 0) AS BIGINT) AS last_processed_ts
FROM e WHERE timestamp > 0"""


def run_counters(w: int = 86400) -> str:
    return f"""WITH {E_CTE}, {window_agg_cte(w)}
SELECT 'total' AS counter, CAST(count(*) AS BIGINT) AS value FROM e
UNION ALL SELECT 'skipped', CAST(count(*) FILTER (WHERE timestamp <= 0) AS BIGINT) FROM e
UNION ALL SELECT 'failed', CAST(0 AS BIGINT)
UNION ALL SELECT 'decoded', CAST(count(*) AS BIGINT) FROM wagg WHERE token0 <> '' AND token1 <> ''"""


def bad_amounts(w: int = 86400) -> str:
    m = X.BAD_AMOUNT_MOD
    return f"""WITH {E_CTE},
eb AS (
  SELECT e.*, event_id % {m} AS f,
         NOT (event_name = 'Swap' AND event_id % {m} IN (15, 19)) AS ok,
         CASE WHEN event_name <> 'Swap' THEN a0 WHEN event_id % {m} IN (16, 18) THEN 0
              WHEN event_id % {m} = 17 THEN abs(a0) ELSE a0 END AS b0,
         CASE WHEN event_name = 'Swap' AND event_id % {m} = 18 THEN 0 ELSE a1 END AS b1
  FROM e)
SELECT address AS pool_address, timestamp - timestamp % {w} AS window_start,
       CAST(count(*) FILTER (WHERE event_name = 'Swap' AND ok) AS BIGINT) AS swap_count,
       CAST(sum(CASE WHEN event_name = 'Swap' AND ok THEN abs(b0) ELSE 0 END) AS VARCHAR) AS volume0_raw,
       CAST(sum(CASE WHEN event_name = 'Swap' AND ok THEN abs(b1) ELSE 0 END) AS VARCHAR) AS volume1_raw,
       CAST(sum(CASE WHEN event_name = 'Swap' AND ok AND fee > 0 AND b1 < 0 AND b0 > 0
                     THEN abs(b0) * fee // 1000000 ELSE 0 END) AS VARCHAR) AS fee0_raw,
       CAST(sum(CASE WHEN event_name = 'Swap' AND ok AND fee > 0 AND b0 < 0 AND b1 > 0
                     THEN abs(b1) * fee // 1000000 ELSE 0 END) AS VARCHAR) AS fee1_raw,
       CAST(count(*) AS BIGINT) AS n_events
FROM eb WHERE timestamp > 0
GROUP BY ALL"""


def log_scan_filtered(n_pools: int, kinds: tuple) -> str:
    names = ", ".join(f"'{k}'" for k in kinds)
    return f"""WITH {E_CTE}, mx AS (SELECT max(block_number) // 4 AS c FROM e)
SELECT chain_id, block_number, tx_hash, log_index, address, {_sig_sql()} AS topic0,
       CAST(CASE WHEN event_name = 'Swap' THEN 3 ELSE 4 END AS BIGINT) AS n_topics
FROM e WHERE pool < {n_pools} AND event_name IN ({names})
  AND block_number >= (SELECT CASE WHEN c >= 1 THEN c + 1 ELSE 1 END FROM mx)"""


def dedup_logs(order: list) -> str:
    return f"""SELECT CAST({X.CHAIN_ID} AS BIGINT) AS chain_id, l_orderkey AS block_number,
       '0x' || lpad(lower(hex(l_orderkey)), 64, '0') AS tx_hash, CAST(l_linenumber AS BIGINT) AS log_index,
       l_partkey, l_suppkey
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(order)}) = 1"""


def block_ranges(batch: int) -> str:
    return f"""SELECT r AS from_block, least(r + {batch - 1}, hi) AS to_block
FROM (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders) b,
     generate_series(b.lo, b.hi, {batch}) AS t(r)"""


def log_with_timestamp() -> str:
    return f"""WITH {E_CTE}
SELECT e.chain_id, e.block_number, e.log_index, o.ts AS timestamp, o.ts IS NULL AS block_time_missing
FROM e LEFT JOIN (SELECT o_orderkey * 2 AS bn, epoch_us(o_orderdate) // 1000000 AS ts FROM orders) o
  ON o.bn = e.block_number"""


def token_dim() -> str:
    d = f"p_size * {X.DECIMALS_SCALE}"
    return f"""SELECT CAST({X.CHAIN_ID} AS BIGINT) AS chain_id, {hexaddr(f'p_partkey + {X.TOKEN_ADDRESS_BASE}')} AS address,
       CAST(CASE WHEN {d} <= 255 THEN {d} ELSE 0 END AS BIGINT) AS decimals,
       CASE WHEN {d} <= 255 THEN p_brand ELSE '' END AS symbol,
       CASE WHEN {d} > 255 THEN '' WHEN p_partkey % 3 = 1 THEN p_type
            WHEN p_partkey % 3 = 2 THEN p_name ELSE '' END AS name
FROM part"""


def live_meta_asof() -> str:
    types = ", ".join(f"'{t}'" for t in X.LIVE_TYPES)
    return f"""WITH {E_CTE},
pl AS (
  SELECT address, block_number, CAST(block_number * 7919 AS VARCHAR) AS liquidity,
         CAST(block_number * 13 AS VARCHAR) AS sqrt_price_x96, CAST(block_number % 100 - 50 AS INTEGER) AS tick
  FROM e WHERE event_type IN ({types}) AND pool % 4 <> {X.NO_LIVE_POOL_MOD4})
SELECT e.chain_id, e.block_number, e.log_index, pl.liquidity, pl.sqrt_price_x96, pl.tick
FROM e ASOF LEFT JOIN pl ON e.address = pl.address AND e.block_number >= pl.block_number"""


# ---------------------------------------------------------------------------
# Inputs that disagree, repeat or exceed the usual widths.

def window_mixed_meta(w: int = 86400, per_window: bool = False) -> str:
    """Windows of named pools; ``per_window``: only those named by an event of their own."""
    named_by = f"chain_id, address, timestamp - timestamp % {w}" if per_window else "chain_id, address"
    return f"""WITH {E_CTE},
em AS (
  SELECT * REPLACE (
           CAST(CASE WHEN event_id % 11 = 0 THEN {X.OTHER_CHAIN_ID} ELSE chain_id END AS BIGINT) AS chain_id,
           CAST(CASE WHEN event_id % 13 = 0 THEN 0 ELSE timestamp END AS BIGINT) AS timestamp,
           CAST(CASE WHEN event_id % 17 = 0 THEN 0 ELSE block_number END AS BIGINT) AS block_number)
  FROM e),
ep AS (
  SELECT *, bool_or(event_id % 7 <> 0 AND token0 <> '') OVER (PARTITION BY {named_by}) AS named
  FROM em WHERE timestamp > 0)
SELECT chain_id, address AS pool_address, timestamp - timestamp % {w} AS window_start, token0, token1, fee,
       CAST(count(*) FILTER (WHERE event_name = 'Swap') AS BIGINT) AS swap_count,
       CAST(sum(CASE WHEN event_name = 'Swap' THEN abs(a0) ELSE 0 END) AS VARCHAR) AS volume0_raw,
       CAST(sum(CASE WHEN event_name = 'Swap' THEN abs(a1) ELSE 0 END) AS VARCHAR) AS volume1_raw,
       CAST(sum(CASE WHEN event_name = 'Swap' AND fee > 0 AND a1 < 0 AND a0 > 0
                THEN abs(a0) * fee // 1000000 ELSE 0 END) AS VARCHAR) AS fee0_raw,
       CAST(sum(CASE WHEN event_name = 'Swap' AND fee > 0 AND a0 < 0 AND a1 > 0
                THEN abs(a1) * fee // 1000000 ELSE 0 END) AS VARCHAR) AS fee1_raw,
       CAST(coalesce(min(CASE WHEN block_number > 0 THEN block_number END), 0) AS BIGINT) AS first_block,
       CAST(max(CAST(timestamp AS HUGEINT) * 1000000000000 + block_number) % 1000000000000 AS BIGINT) AS last_block,
       CAST(count(*) AS BIGINT) AS n_events
FROM ep WHERE named GROUP BY ALL"""


def wide_amounts(w: int = 86400) -> str:
    z = X.WIDE_ZEROS
    swap = "event_name = 'Swap'"

    def text(high: str, low: str, zeros: int) -> str:
        """high * 10^zeros + low, as text."""
        return (f"CASE WHEN {high} = 0 THEN CAST({low} AS VARCHAR) "
                f"ELSE CAST({high} AS VARCHAR) || lpad(CAST({low} AS VARCHAR), {zeros}, '0') END")
    pays0 = f"{swap} AND fee > 0 AND a1 < 0 AND a0 > 0"
    pays1 = f"{swap} AND fee > 0 AND a0 < 0 AND a1 > 0"
    return f"""WITH {E_CTE},
x AS (
  SELECT address AS pool_address, timestamp - timestamp % {w} AS window_start,
         CAST(count(*) FILTER (WHERE {swap}) AS BIGINT) AS swap_count,
         sum(CASE WHEN {swap} AND event_id % 3 = 0 THEN abs(cents) ELSE 0 END) AS high0,
         sum(CASE WHEN {swap} AND event_id % 3 <> 0 THEN abs(a0) ELSE 0 END) AS low0,
         sum(CASE WHEN {swap} THEN abs(a1) ELSE 0 END) AS v1,
         sum(CASE WHEN {pays0} AND event_id % 3 = 0 THEN abs(cents) * fee ELSE 0 END) AS fhigh0,
         sum(CASE WHEN {pays0} AND event_id % 3 <> 0 THEN abs(a0) * fee // 1000000 ELSE 0 END) AS flow0,
         sum(CASE WHEN {pays1} THEN abs(a1) * fee // 1000000 ELSE 0 END) AS f1
  FROM e WHERE timestamp > 0 GROUP BY ALL)
SELECT pool_address, window_start, swap_count, {text('high0', 'low0', z)} AS volume0_raw,
       CAST(v1 AS VARCHAR) AS volume1_raw, {text('fhigh0', 'flow0', z - 6)} AS fee0_raw, CAST(f1 AS VARCHAR) AS fee1_raw
FROM x"""


def dedup_removed_logs() -> str:
    return f"""SELECT CAST({X.CHAIN_ID} AS BIGINT) AS chain_id, l_orderkey AS block_number,
       CAST(l_linenumber AS BIGINT) AS log_index, l_linestatus = 'F' AS removed,
       '0x' || lpad(lower(hex(l_partkey)), 64, '0') AS block_hash, '0x' || lpad(lower(hex(l_suppkey)), 64, '0') AS data
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_linestatus = 'F', lpad(lower(hex(l_partkey)), 64, '0'),
                                    lpad(lower(hex(l_suppkey)), 64, '0')) = 1"""


def open_window_state(w: int = 86400) -> str:
    return f"""WITH {E_CTE}, o AS (SELECT max(timestamp - timestamp % {w}) AS s FROM e WHERE timestamp > 0 GROUP BY address)
SELECT CAST(greatest(min(s) - 1, 0) AS BIGINT) AS last_processed_ts FROM o"""


def run_counters_bad(w: int = 86400) -> str:
    m = X.BAD_AMOUNT_MOD
    return f"""WITH {E_CTE}, {_RESUME}
st AS (SELECT greatest((s + 1) - (s + 1) % {w} - 1, 0) AS start FROM rp)
SELECT 'total' AS counter, CAST(count(*) AS BIGINT) AS value FROM e
UNION ALL SELECT 'skipped', CAST(count(*) AS BIGINT) FROM e, st WHERE timestamp <= start
UNION ALL SELECT 'failed', CAST(count(*) AS BIGINT) FROM e, st
          WHERE timestamp > start AND event_name = 'Swap' AND event_id % {m} IN (15, 19)
UNION ALL SELECT 'decoded', CAST(count(DISTINCT (address, timestamp - timestamp % {w})) AS BIGINT) FROM e, st
          WHERE timestamp > start AND token0 <> ''"""


# ---------------------------------------------------------------------------
# Streams.

def _sliced(n: int) -> str:
    """Events with the number of their equal block range."""
    return f"""{E_CTE}, sl AS (
  SELECT e.*, (block_number - lo) // ((hi - lo) // {n} + 1) AS part
  FROM e, (SELECT min(block_number) AS lo, max(block_number) AS hi FROM e))"""


def stream_state_resume(slices: int, silent: int, lateness: int, w: int = 86400) -> str:
    return f"""WITH {_sliced(slices)},
ld AS (SELECT * FROM sl WHERE timestamp > 0 AND NOT (pool = {silent} AND part = {slices - 1})),
o AS (
  SELECT chain_id, address AS pool_address, timestamp - timestamp % {w} AS s,
         timestamp - timestamp % {w} + {w} > (SELECT max(timestamp) FROM ld) - {lateness} AS still
  FROM ld GROUP BY ALL),
p AS (
  SELECT chain_id, pool_address, min(s) FILTER (still) AS lowest_open, max(s) AS latest, count(*) FILTER (still) AS n_open
  FROM o GROUP BY ALL)
SELECT *, (SELECT min(lowest_open) - 1 FROM p) AS last_processed_ts FROM p"""


def stream_late_rows(slices: int, mod: int, rest: int, lateness: int) -> str:
    return f"""WITH {_sliced(slices)},
w AS (SELECT *, CASE WHEN part = 0 AND event_id % {mod} = {rest} THEN {slices - 1} ELSE part END AS lands FROM sl),
t AS (SELECT lands, max(timestamp) AS top FROM w GROUP BY lands),
x AS (SELECT w.*, (SELECT max(top) FROM t WHERE t.lands < w.lands) AS before FROM w)
SELECT address AS pool_address, count(*) AS late_rows, (SELECT count(*) FROM x WHERE timestamp <= before - {lateness}) AS dropped_by_operator
FROM x WHERE timestamp <= before - {lateness} GROUP BY ALL"""


# ---------------------------------------------------------------------------
# Files, combined faults, stored tables.

def jsonl_events(w: int = 86400) -> str:
    f = f"event_id % {X.LINE_MOD}"
    return f"""WITH {E_CTE}
SELECT address AS pool_address, timestamp - timestamp % {w} AS window_start,
       CAST(count(*) FILTER (WHERE event_name = 'Swap' AND {f} <> 25) AS BIGINT) AS swap_count,
       CAST(sum(CASE WHEN event_name = 'Swap' AND {f} <> 25 THEN abs(a0) ELSE 0 END) AS VARCHAR) AS volume0_raw,
       CAST(count(*) AS BIGINT) AS n_events, CAST(count(*) FILTER (WHERE event_name = 'Swap' AND {f} = 25) AS BIGINT) AS n_failed
FROM e WHERE timestamp > 0 AND {f} NOT IN (21, 22, 23, 24) GROUP BY ALL"""


def decode_combined_errors() -> str:
    address = "event_id % 7 = 3"
    empty = "event_id % 11 = 5"
    no_data = "'unpack ' || event_name || ': abi: attempting to unmarshall an empty string while arguments are expected'"
    return f"""WITH {E_CTE}, {ED_CTE}, {FAULTY_CTE},
x AS (
  SELECT *, CASE WHEN f = 1 THEN error WHEN outcome = 'skipped' THEN NULL
                 WHEN {address} THEN 'invalid pool address: 0x1234' WHEN f BETWEEN 3 AND 7 THEN error
                 WHEN {empty} THEN {no_data} WHEN outcome = 'failed' THEN error END AS first_error
  FROM fo)
SELECT chain_id, block_number, tx_hash, log_index, CASE WHEN {address} THEN '0x1234' ELSE log_address END AS address,
       topic0, first_error AS error
FROM x WHERE first_error IS NOT NULL"""


def decode_custom_event() -> str:
    return f"""WITH {E_CTE}, {ED_CTE}
SELECT chain_id, block_number, tx_hash, log_index, address, 'Gift' AS event_name, party1 AS giver, CAST(tick_lower AS VARCHAR) AS low,
       CAST(tick_upper AS VARCHAR) AS high, party0 AS receiver, CAST(abs(a0) AS VARCHAR) AS part0, CAST(abs(a1) AS VARCHAR) AS part1
FROM ed WHERE event_name = 'Collect' AND event_id % 3 = {X.CUSTOM_REST}"""


def decode_spec_swap() -> str:
    return f"""WITH {E_CTE}, {ED_CTE}
SELECT chain_id, block_number, tx_hash, log_index, address, CAST(a0 AS VARCHAR) AS amount0, CAST(a1 AS VARCHAR) AS amount1,
       CAST(tick AS VARCHAR) AS tick, liquidity, sqrt_price_x96, party0 AS sender, party1 AS recipient
FROM ed WHERE event_name = 'Swap'"""
