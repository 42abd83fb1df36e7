"""Record schemas (explicit StructTypes; nothing is inferred)."""

from pyspark.sql import types as T

_L, _S, _I, _B = T.LongType(), T.StringType(), T.IntegerType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(name, typ, True) for name, typ in fields])


# A raw chain log, one per line of the landing files.
RAW_LOG = _struct(
    ("chain_id", _L), ("block_number", _L), ("block_hash", _S), ("tx_hash", _S),
    ("tx_index", _L), ("log_index", _L), ("address", _S), ("topics", T.ArrayType(_S)),
    ("data", _S), ("removed", _B), ("timestamp", _L), ("ingested_at", _S),
)

# Superset of the four event payloads; each event fills its own subset.
DECODED = _struct(
    ("sender", _S), ("recipient", _S), ("owner", _S),
    ("tick_lower", _I), ("tick_upper", _I), ("tick", _I),
    ("amount", _S), ("amount0", _S), ("amount1", _S),
    ("sqrt_price_x96", _S), ("liquidity", _S),
)

SLOT0 = _struct(("sqrt_price_x96", _S), ("tick", _I))

POOL_META = _struct(
    ("token0", _S), ("token1", _S), ("fee", _L), ("tick_spacing", _I),
    ("liquidity", _S), ("slot0", SLOT0),
)

RAW_REF = _struct(("topic0", _S), ("data", _S))

TYPED_EVENT = _struct(
    ("chain_id", _L), ("block_number", _L), ("block_hash", _S), ("tx_hash", _S),
    ("log_index", _L), ("address", _S), ("event_name", _S), ("timestamp", _L),
    ("decoded", DECODED), ("pool_meta", POOL_META), ("raw", RAW_REF),
)

DECODE_ERROR = _struct(
    ("chain_id", _L), ("block_number", _L), ("tx_hash", _S), ("log_index", _L),
    ("address", _S), ("topic0", _S), ("error", _S),
)

POOLS = _struct(
    ("chain_id", _L), ("pool_address", _S), ("token0", _S), ("token1", _S),
    ("fee", _L), ("tick_spacing", _I), ("first_seen_block", _L),
)
POOLS_KEY = ("chain_id", "pool_address")
POOLS_NOT_NULL = (*POOLS_KEY, "token0", "token1", "fee", "tick_spacing", "first_seen_block")

WINDOW_METRICS = _struct(
    ("chain_id", _L), ("pool_address", _S), ("window_size_seconds", _L),
    ("window_start", _L), ("window_end", _L), ("swap_count", _L),
    ("volume0", _S), ("volume1", _S), ("fee0", _S), ("fee1", _S), ("fee_usd", _S),
    ("fee_rate0", _S), ("fee_rate1", _S), ("tvl0", _S), ("tvl1", _S), ("tvl_usd", _S),
    ("apr", _S), ("fee_method", _S), ("tvl_method", _S), ("decimals_known", _B),
)
WINDOW_METRICS_KEY = ("chain_id", "pool_address", "window_size_seconds", "window_start")
WINDOW_METRICS_NOT_NULL = ("chain_id", "pool_address", "window_size_seconds", "window_start",
                           "window_end", "swap_count", "volume0", "volume1", "fee0", "fee1",
                           "fee_method", "tvl_method")

PIPELINE_STATE = _struct(("name", _S), ("last_processed_ts", _L), ("updated_at", T.TimestampType()))

# Snapshot tables that stand in for remote chain lookups.
BLOCKS = _struct(("chain_id", _L), ("block_number", _L), ("timestamp", _L))
POOL_META_TABLE = _struct(
    ("chain_id", _L), ("address", _S), ("token0", _S), ("token1", _S),
    ("fee", _L), ("tick_spacing", _I),
)
POOL_LIVE = _struct(
    ("chain_id", _L), ("address", _S), ("block_number", _L), ("liquidity", _S),
    ("sqrt_price_x96", _S), ("tick", _I),
)
TOKENS = _struct(("chain_id", _L), ("address", _S), ("decimals", T.ShortType()),
                 ("symbol", _S), ("name", _S))
BALANCES = _struct(("chain_id", _L), ("token", _S), ("owner", _S),
                   ("block_number", _L), ("balance", _S))

STATE_KEY = ("name",)
STATE_NOT_NULL = ("name", "last_processed_ts")
