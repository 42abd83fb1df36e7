"""Deterministic adapters from the driver tables to chain-shaped inputs.

The driver tables are not chain data, so each query starts from one of these
adapters.  Every rule here is restated in DuckDB SQL in ``plans.oracles``;
both must change together.

E  events -> typed events (one per event row)
R  E encoded back into raw logs (topics + ABI hex data), see ``raw_logs``
B  balance snapshots derived from E's blocks
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import schemas as S

# Fixed adapter parameters.
CHAIN_ID = 56
N_POOLS = 20
KIND_BY_EVENT_TYPE = {"view": "Swap", "click": "Swap", "purchase": "Mint", "signup": "Burn",
                      "error": "Collect"}
FEE_BY_POOL_MOD5 = [0, 100, 500, 2500, 10000]
SPACING_BY_POOL_MOD5 = [1, 1, 10, 50, 200]
DECIMALS_BY_MOD3 = [0, 6, 18]
NO_META_POOL = 19            # pool whose token0 is empty (exercises P13)
TOKEN_BASE = 65536           # token addresses: TOKEN_BASE + 2*pool (+1)
PARTY_BASE = 4096            # sender/owner/recipient addresses from user ids
Q96 = 2 ** 96
Q64 = 2 ** 64


def read_driver_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a driver table.

    A table of one split (one row group) would run all per-row work in one
    task; its selected columns are dealt out over the cores.  Nothing is cached.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    return df.repartition(spark.sparkContext.defaultParallelism) if df.rdd.getNumPartitions() == 1 else df


def hex_address(n: Column) -> Column:
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(n)), 40, "0"))


def _pick(index: Column, values: list) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(index == i, F.lit(v)) if out is None else out.when(index == i, F.lit(v))
    return out


def _kind(event_type: Column) -> Column:
    out = None
    for k, v in KIND_BY_EVENT_TYPE.items():
        out = F.when(event_type == k, F.lit(v)) if out is None else out.when(event_type == k, F.lit(v))
    return out


def event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain per-event values shared by adapters E and R."""
    ev = read_driver_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    pool = F.col("user_id") % N_POOLS
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    odd = F.col("event_id") % 2 == 1
    cents = F.round(F.col("value") * 100).cast("bigint")
    a0 = cents * F.lit(1_000_000) * F.when(odd, F.lit(-1)).otherwise(F.lit(1))
    a1 = (k + 1) * F.lit(10_000_000) * F.when(odd, F.lit(1)).otherwise(F.lit(-1))
    return ev.select(
        F.col("event_id"), F.col("user_id"), F.col("event_type"),
        pool.alias("pool"),
        F.lit(CHAIN_ID).cast("bigint").alias("chain_id"),
        (F.col("event_id") + 1).alias("block_number"),
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.col("event_id") + 1)), 64, "0")).alias("block_hash"),
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.col("event_id"))), 64, "0")).alias("tx_hash"),
        (F.col("event_id") % 7).alias("log_index"),
        hex_address(pool).alias("address"),
        _kind(F.col("event_type")).alias("event_name"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        k.alias("k"),
        a0.alias("a0"), a1.alias("a1"),
        cents.alias("cents"),
    )


def _decoded(b: Column) -> Column:
    """Decoded payload per kind (same superset struct for all)."""
    name = F.col("event_name")
    sender = hex_address(F.col("user_id") * 2 + PARTY_BASE)
    other = hex_address(F.col("user_id") * 2 + PARTY_BASE + 1)
    abs0, abs1 = F.abs(F.col("a0")), F.abs(F.col("a1"))
    tick = (F.col("event_id") % 1000 - 500).cast("int")
    tl = (-(F.col("k") * 10)).cast("int")
    tu = (F.col("k") * 10 + 10).cast("int")
    liq = (F.col("user_id") + 1).cast("decimal(38,0)") * F.lit(str(Q64)).cast("decimal(38,0)") + F.col("event_id")
    sqrtp = (F.col("k") + 1).cast("decimal(38,0)") * F.lit(str(Q96)).cast("decimal(38,0)")
    is_swap, is_mint = name == "Swap", name == "Mint"
    is_burn, is_collect = name == "Burn", name == "Collect"
    s = F.lit(None).cast("string")
    i = F.lit(None).cast("int")
    return F.struct(
        F.when(is_swap | is_mint, sender).otherwise(s).alias("sender"),
        F.when(is_swap, other).when(is_collect, sender).otherwise(s).alias("recipient"),
        F.when(is_mint | is_burn | is_collect, other).otherwise(s).alias("owner"),
        F.when(~is_swap, tl).otherwise(i).alias("tick_lower"),
        F.when(~is_swap, tu).otherwise(i).alias("tick_upper"),
        F.when(is_swap, tick).otherwise(i).alias("tick"),
        F.when(is_mint | is_burn, (F.col("cents") * 1000).cast("string")).otherwise(s).alias("amount"),
        F.when(is_swap, F.col("a0").cast("string")).otherwise(abs0.cast("string")).alias("amount0"),
        F.when(is_swap, F.col("a1").cast("string")).otherwise(abs1.cast("string")).alias("amount1"),
        F.when(is_swap, sqrtp.cast("string")).otherwise(s).alias("sqrt_price_x96"),
        F.when(is_swap, liq.cast("string")).otherwise(s).alias("liquidity"),
    )


def pool_meta_cols(pool: Column) -> list:
    """token0, token1, fee, tick_spacing of a fixture pool."""
    token0 = F.when(pool == NO_META_POOL, F.lit("")).otherwise(hex_address(pool * 2 + TOKEN_BASE))
    return [token0.alias("token0"),
            hex_address(pool * 2 + TOKEN_BASE + 1).alias("token1"),
            _pick(pool % 5, FEE_BY_POOL_MOD5).cast("bigint").alias("fee"),
            _pick(pool % 5, SPACING_BY_POOL_MOD5).cast("int").alias("tick_spacing")]


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter E: the events table as typed pool events (TYPED_EVENT schema)."""
    b = event_base(spark, sf_dir)
    meta = pool_meta_cols(F.col("pool"))
    return b.select(
        "chain_id", "block_number", "block_hash", "tx_hash", "log_index", "address",
        "event_name", "timestamp",
        _decoded(b).alias("decoded"),
        F.struct(*meta, F.lit(None).cast("string").alias("liquidity"),
                 F.lit(None).cast(S.SLOT0).alias("slot0")).alias("pool_meta"),
        F.struct(F.lit(None).cast("string").alias("topic0"),
                 F.lit(None).cast("string").alias("data")).alias("raw"),
    )


def pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct fixture pools present in the events table."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select((F.col("user_id") % N_POOLS).alias("pool")).distinct()


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token dimension: decimals by pool % 3 (token1: (pool + 1) % 3); no row
    for pools with pool % 7 = 6."""
    p = pools(spark, sf_dir).where(F.col("pool") % 7 != 6)
    t0 = p.select(hex_address(F.col("pool") * 2 + TOKEN_BASE).alias("address"),
                  _pick(F.col("pool") % 3, DECIMALS_BY_MOD3).alias("decimals"), F.col("pool"))
    t1 = p.select(hex_address(F.col("pool") * 2 + TOKEN_BASE + 1).alias("address"),
                  _pick((F.col("pool") + 1) % 3, DECIMALS_BY_MOD3).alias("decimals"), F.col("pool"))
    return t0.unionByName(t1).select(
        F.lit(CHAIN_ID).cast("bigint").alias("chain_id"), "address",
        F.col("decimals").cast("short").alias("decimals"),
        F.concat(F.lit("TK"), F.col("pool").cast("string")).alias("symbol"),
        F.concat(F.lit("Token "), F.col("pool").cast("string")).alias("name"))


# Event types whose blocks carry a balance snapshot of token0 / token1.
SNAPSHOT0_TYPES = ("view", "click", "purchase", "signup")
SNAPSHOT1_TYPES = ("view", "purchase")
LATEST_ONLY_POOL_MOD10 = 2   # pools keeping only a snapshot at their last event block
NO_BALANCE_POOL_MOD11 = 3    # pools without any snapshot


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: balance snapshots of each pool's two tokens, from every event.

    token0 at the blocks of events whose type is in SNAPSHOT0_TYPES, token1 at
    those in SNAPSHOT1_TYPES (so token1 has gaps where token0 has not); pools
    with pool % 10 = 2 keep only a snapshot at their last event block; pools
    with pool % 11 = 3 have none.  balance = 10^15 * (side + 1) + block * m.
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    b = ev.select((F.col("user_id") % N_POOLS).alias("pool"), (F.col("event_id") + 1).alias("block_number"),
                  "event_type")
    b = b.where(F.col("pool") % 11 != NO_BALANCE_POOL_MOD11)
    last = (b.where(F.col("pool") % 10 == LATEST_ONLY_POOL_MOD10).groupBy("pool")
            .agg(F.max("block_number").alias("block_number")))
    regular = b.where(F.col("pool") % 10 != LATEST_ONLY_POOL_MOD10)
    snap0 = regular.where(F.col("event_type").isin(*SNAPSHOT0_TYPES)).select("pool", "block_number").unionByName(last)
    snap1 = regular.where(F.col("event_type").isin(*SNAPSHOT1_TYPES)).select("pool", "block_number").unionByName(last)

    def rows(df: DataFrame, side: int) -> DataFrame:
        bal = F.lit(10 ** 15 * (side + 1)) + F.col("block_number") * F.lit(BALANCE_STEP[side])
        return df.select(F.lit(CHAIN_ID).cast("bigint").alias("chain_id"),
                         hex_address(F.col("pool") * 2 + TOKEN_BASE + side).alias("token"),
                         hex_address(F.col("pool")).alias("owner"),
                         F.col("block_number"), bal.cast("string").alias("balance"))
    return rows(snap0, 0).unionByName(rows(snap1, 1))


BALANCE_STEP = (1_000_003, 999_983)


# ---------------------------------------------------------------------------
# Adapter R: E encoded as raw logs.

FAULT_MOD = 101              # fault kind of an event = event_id % FAULT_MOD (with faults on)
UNKNOWN_TOPIC0 = "0x" + "ab" * 32
# Topic0 of a fork's Swap that carries two more uint128 words; routed only
# through an extra topic map.
FORK_SWAP_TOPIC0 = "0x19b47279256b2a23a1665c810c8d55a1758940ee09377d4f8d26497a3577dc83"
UNKNOWN_POOL = "0x" + "dead".rjust(40, "0")
INT24_OVERFLOW_WORD = "800000".rjust(64, "0")


def int_word(x: Column) -> Column:
    """Two's-complement 256-bit word of a BIGINT."""
    h = F.lower(F.hex(x))
    return F.when(x < 0, F.lpad(h, 64, "f")).otherwise(F.lpad(h, 64, "0"))


def addr_word(a: Column) -> Column:
    return F.lpad(a.substr(3, 40), 64, "0")


def raw_logs(spark: SparkSession, sf_dir: str, faults: bool = False, blocks: tuple | None = None) -> DataFrame:
    """Adapter R: every event as a raw log (RAW_LOG schema), or those of the blocks from ``blocks[0]`` to ``blocks[1]``.

    With ``faults`` the event with event_id % 101 = f is damaged by kind f:
    1 no topics, 2 unknown topic0, 3 bad pool address, 4 pool without
    metadata, 5 one topic short, 6 33-byte topic, 7 non-hex topic, 8 odd data
    length, 9 data cut to two words, 10 empty data, 11 int24 out of range,
    12 upper-case topic0 (still routed), 13 one extra data word (ignored),
    14 fork Swap topic0 with two extra words (routed only by an extra map).
    """
    from tidepool.operators.decode import EVENTS

    b = event_base(spark, sf_dir)
    if blocks:      # a range of blocks lies in few splits: dealt out over the cores before the encoding
        b = b.where(F.col("block_number").between(*blocks)).repartition(spark.sparkContext.defaultParallelism)
    b = b.withColumn("decoded", _decoded(b))
    f = (F.col("event_id") % FAULT_MOD) if faults else F.lit(0)
    name = F.col("event_name")
    dcd = lambda c: F.col(f"decoded.{c}")
    is_swap = name == "Swap"
    sig = None
    for n, e in EVENTS.items():
        sig = F.when(name == n, F.lit(e.topic0)) if sig is None else sig.when(name == n, F.lit(e.topic0))
    t0 = (F.when(f == 2, F.lit(UNKNOWN_TOPIC0)).when(f == 12, F.upper(sig))
          .when((f == 14) & is_swap, F.lit(FORK_SWAP_TOPIC0)).otherwise(sig))
    first = F.when(is_swap, addr_word(dcd("sender"))).otherwise(addr_word(dcd("owner")))
    t1 = (F.when(f == 6, F.lit("0x" + "ab" * 33)).when(f == 7, F.lit("0xzz"))
          .otherwise(F.concat(F.lit("0x"), first)))
    tl = F.when((f == 11) & ~is_swap, F.lit(INT24_OVERFLOW_WORD)).otherwise(int_word(dcd("tick_lower")))
    t2 = F.concat(F.lit("0x"), F.when(is_swap, addr_word(dcd("recipient"))).otherwise(tl))
    t3 = F.concat(F.lit("0x"), int_word(dcd("tick_upper")))
    topics = F.when(is_swap, F.array(t0, t1, t2)).otherwise(F.array(t0, t1, t2, t3))
    topics = (F.when(f == 1, F.array().cast("array<string>"))
              .when(f == 5, F.slice(topics, 1, F.size(topics) - 1)).otherwise(topics))

    cents = F.col("cents")
    sqrtp = F.concat(F.lpad(F.lower(F.hex(F.col("k") + 1)), 40, "0"), F.lit("0" * 24))
    liq = F.concat(F.lpad(F.lower(F.hex(F.col("user_id") + 1)), 48, "0"),
                   F.lpad(F.lower(F.hex(F.col("event_id"))), 16, "0"))
    tick = F.when(f == 11, F.lit(INT24_OVERFLOW_WORD)).otherwise(int_word(dcd("tick").cast("bigint")))
    abs0, abs1 = int_word(F.abs(F.col("a0"))), int_word(F.abs(F.col("a1")))
    amount = int_word(cents * 1000)
    words = (F.when(is_swap, F.concat(int_word(F.col("a0")), int_word(F.col("a1")), sqrtp, liq, tick))
             .when(name == "Mint", F.concat(addr_word(dcd("sender")), amount, abs0, abs1))
             .when(name == "Burn", F.concat(amount, abs0, abs1))
             .otherwise(F.concat(addr_word(dcd("recipient")), abs0, abs1)))
    extra = F.lpad(F.lower(F.hex(F.col("event_id"))), 64, "0")
    words = (F.when(f == 8, F.concat(words, F.lit("0"))).when(f == 9, words.substr(1, 128))
             .when(f == 10, F.lit("")).when((f == 13) | ((f == 14) & is_swap), F.concat(words, extra, extra))
             .otherwise(words))
    address = (F.when(f == 3, F.lit("0x1234")).when(f == 4, F.lit(UNKNOWN_POOL))
               .otherwise(F.col("address")))
    return b.select(
        "chain_id", "block_number", "block_hash", "tx_hash",
        (F.col("event_id") % 3).alias("tx_index"), "log_index",
        address.alias("address"), topics.alias("topics"),
        F.concat(F.lit("0x"), words).alias("data"),
        F.lit(False).alias("removed"), "timestamp",
        F.lit("2024-01-01T00:00:00Z").alias("ingested_at"),
    )


def pool_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool metadata snapshot for every fixture pool present in events."""
    p = pools(spark, sf_dir)
    return p.select(F.lit(CHAIN_ID).cast("bigint").alias("chain_id"), hex_address(F.col("pool")).alias("address"),
                    *pool_meta_cols(F.col("pool")))


# ---------------------------------------------------------------------------
# Further adapters.

BAD_AMOUNT_MOD = 101         # swap payload damaged by kind event_id % 101 (15..19)


def typed_events_bad_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter E with damaged swap payloads: 15 amount0 "1.5" (unreadable),
    16 amount0 "" (zero), 17 amount0 with a "+" sign, 18 decoded NULL (a swap
    of zero), 19 amount1 "12a" (unreadable)."""
    te = typed_events(spark, sf_dir)
    f = (F.conv(F.substring("tx_hash", 3, 64), 16, 10).cast("bigint")) % BAD_AMOUNT_MOD
    d = F.col("decoded")
    swap = F.col("event_name") == "Swap"
    a0 = (F.when(swap & (f == 15), F.lit("1.5")).when(swap & (f == 16), F.lit(""))
          .when(swap & (f == 17), F.concat(F.lit("+"), F.regexp_replace(d["amount0"], "^-", "")))
          .otherwise(d["amount0"]))
    a1 = F.when(swap & (f == 19), F.lit("12a")).otherwise(d["amount1"])
    new = d.withField("amount0", a0).withField("amount1", a1)
    return te.withColumn("decoded", F.when(swap & (f == 18), F.lit(None)).otherwise(new))


OTHER_CHAIN_ID = 57


def typed_events_mixed_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter E with events that disagree about their pool: every 5th spells its
    tokens in capitals, every 7th has no metadata, every 11th is on another
    chain, every 13th has timestamp 0, every 17th block 0."""
    te = typed_events(spark, sf_dir)
    n = F.conv(F.substring("tx_hash", 3, 64), 16, 10).cast("bigint")
    m = F.col("pool_meta")
    upper = lambda c: F.when(n % 5 == 0, F.concat(F.lit("0x"), F.upper(c.substr(3, 40)))).otherwise(c)
    named = m.withField("token0", F.when(m["token0"] == "", "").otherwise(upper(m["token0"]))) \
        .withField("token1", upper(m["token1"]))
    blank = m.withField("token0", F.lit("")).withField("token1", F.lit("")).withField("fee", F.lit(0).cast("bigint")) \
        .withField("tick_spacing", F.lit(0))
    return te.select(
        F.when(n % 11 == 0, F.lit(OTHER_CHAIN_ID)).otherwise(F.col("chain_id")).cast("bigint").alias("chain_id"),
        F.when(n % 17 == 0, F.lit(0)).otherwise(F.col("block_number")).cast("bigint").alias("block_number"),
        "block_hash", "tx_hash", "log_index", "address", "event_name",
        F.when(n % 13 == 0, F.lit(0)).otherwise(F.col("timestamp")).cast("bigint").alias("timestamp"),
        "decoded", F.when(n % 7 == 0, blank).otherwise(named).alias("pool_meta"), "raw")


WIDE_ZEROS = 90              # a wide amount is the plain one's cents followed by so many zeros


def typed_events_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter E where every third swap moves cents * 10^90 of token0 (over 80 digits)."""
    te = typed_events(spark, sf_dir)
    n = F.conv(F.substring("tx_hash", 3, 64), 16, 10).cast("bigint")
    a0 = F.col("decoded.amount0")
    cents = F.regexp_replace(a0, "000000$", "")
    wide = F.when(cents.isin("0", "-0"), F.lit("0")).otherwise(F.concat(cents, F.lit("0" * WIDE_ZEROS)))
    return te.withColumn("decoded", F.when(
        (F.col("event_name") == "Swap") & (n % 3 == 0), F.col("decoded").withField("amount0", wide))
        .otherwise(F.col("decoded")))


def removed_logs_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of log keys that differ in ``removed``, block hash and data."""
    return logs_from_lineitem(spark, sf_dir).select(
        "chain_id", "block_number", "tx_hash", "log_index", (F.col("l_linestatus") == "F").alias("removed"),
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("l_partkey")), 64, "0")).alias("block_hash"),
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("l_suppkey")), 64, "0")).alias("data"))


LIVE_TYPES = ("click",)      # event types whose blocks carry a pool_live snapshot
NO_LIVE_POOL_MOD4 = 1        # pools with pool % 4 = 1 have no live snapshots


def pool_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live pool state snapshots (J5) at the blocks of 'click' events."""
    b = event_base(spark, sf_dir)
    b = b.where(F.col("event_type").isin(*LIVE_TYPES) & (F.col("pool") % 4 != NO_LIVE_POOL_MOD4))
    return b.select("chain_id", "address", "block_number",
                    (F.col("block_number") * 7919).cast("string").alias("liquidity"),
                    (F.col("block_number") * 13).cast("string").alias("sqrt_price_x96"),
                    (F.col("block_number") % 100 - 50).cast("int").alias("tick"))


def blocks_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block headers: block o_orderkey * 2 at the order date (odd blocks have none)."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(F.lit(CHAIN_ID).cast("bigint").alias("chain_id"),
                    (F.col("o_orderkey") * 2).alias("block_number"),
                    F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("timestamp"))


def logs_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log keys from lineitem: (orderkey, linenumber) repeats, so copies exist."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return li.select(F.lit(CHAIN_ID).cast("bigint").alias("chain_id"),
                     F.col("l_orderkey").alias("block_number"),
                     F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("l_orderkey")), 64, "0")).alias("tx_hash"),
                     F.col("l_linenumber").cast("bigint").alias("log_index"), "*")


TOKEN_ADDRESS_BASE = 1 << 20
DECIMALS_SCALE = 7           # decimals word = p_size * 7 (values over 255 are not uint8)


def token_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw token call results derived from part: decimals word p_size * 7;
    symbol as string (even partkey) else bytes32 of p_brand; name as string
    p_type (partkey % 3 = 1), bytes32 p_name (% 3 = 2), none (% 3 = 0)."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")

    def b32(c):
        return F.rpad(F.lower(F.hex(c)), 64, "0")
    return p.select(
        F.lit(CHAIN_ID).cast("bigint").alias("chain_id"),
        hex_address(k + TOKEN_ADDRESS_BASE).alias("address"),
        F.lpad(F.lower(F.hex(F.col("p_size") * DECIMALS_SCALE)), 64, "0").alias("decimals_word"),
        F.when(k % 2 == 0, F.col("p_brand")).alias("symbol_text"),
        F.concat(F.lit("0x"), b32(F.col("p_brand"))).alias("symbol_word"),
        F.when(k % 3 == 1, F.col("p_type")).alias("name_text"),
        F.when(k % 3 == 2, F.concat(F.lit("0x"), b32(F.col("p_name")))).alias("name_word"))


def raw_logs_combined_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter R with faults, and more of them on the same logs: every 7th has a bad pool
    address besides, every 11th empty data besides."""
    n = F.conv(F.substring("tx_hash", 3, 64), 16, 10).cast("bigint")
    return (raw_logs(spark, sf_dir, faults=True)
            .withColumn("address", F.when(n % 7 == 3, F.lit("0x1234")).otherwise(F.col("address")))
            .withColumn("data", F.when(n % 11 == 5, F.lit("0x")).otherwise(F.col("data"))))


LINE_MOD = 101               # JSON line damaged by kind event_id % 101 (21..25)


def typed_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter E as JSON lines (one ``value`` column): 21 cut short, 22 a negative block, 23 a timestamp in
    quotes, 24 text behind the object, 25 a payload that is text (the event stays, a swap with it fails)."""
    te = typed_events(spark, sf_dir)
    f = (F.conv(F.substring("tx_hash", 3, 64), 16, 10).cast("bigint")) % LINE_MOD
    line = F.to_json(F.struct(*te.columns))
    return te.select(
        F.when(f == 21, F.substring(line, 1, 40)).when(f == 22, F.replace(line, F.lit('"block_number":'), F.lit('"block_number":-')))
        .when(f == 23, F.regexp_replace(line, '"timestamp":([0-9]+)', '"timestamp":"$1"')).when(f == 24, F.concat(line, F.lit(" x")))
        .when(f == 25, F.regexp_replace(line, '"decoded":\\{[^}]*\\}', '"decoded":"text"')).otherwise(line).alias("value"))


CUSTOM_TOPIC0 = "0x" + "5d" * 32
CUSTOM_REST = 1              # Collect logs with event_id % 3 = 1 are sent as the custom event


def custom_spec():
    """A fifth event, known from data alone: a Collect's words under other names."""
    from tidepool.operators.decode import EventSpec
    return EventSpec("Gift", CUSTOM_TOPIC0, (("giver", "address"), ("low", "int24"), ("high", "int24")),
                     (("receiver", "address"), ("part0", "uint"), ("part1", "int256")))


def raw_logs_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter R where every third Collect carries the custom event's topic0."""
    from tidepool.operators.decode import EVENTS
    n = F.conv(F.substring("tx_hash", 3, 64), 16, 10).cast("bigint")
    mine = (F.get("topics", 0) == EVENTS["Collect"].topic0) & (n % 3 == CUSTOM_REST)
    return raw_logs(spark, sf_dir).withColumn("topics", F.when(mine, F.concat(
        F.array(F.lit(CUSTOM_TOPIC0)), F.slice("topics", 2, F.size("topics")))).otherwise(F.col("topics")))
