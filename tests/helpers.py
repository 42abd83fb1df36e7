"""Builders for small literal inputs."""

from tidepool import schemas as S
from tidepool.operators.decode import EVENTS


def word(v: int) -> str:
    return format(v % (1 << 256), "064x")


def addr_topic(a: str) -> str:
    return "0x" + a[2:].rjust(64, "0")


def int_topic(v: int) -> str:
    return "0x" + word(v)


def addr_word(a: str) -> str:
    return a[2:].rjust(64, "0")


def raw_log(event: str, topics_after: list, words: list, address: str, block: int = 12345,
            log_index: int = 1, ts: int = 1700000000, chain: int = 56, topic0: str | None = None):
    topics = [topic0 or EVENTS[event].topic0] + topics_after
    data = "0x" + "".join(w if isinstance(w, str) else word(w) for w in words)
    return (chain, block, "0xabc", "0xdef", 0, log_index, address, topics, data, False, ts, "")


def raw_df(spark, rows):
    return spark.createDataFrame(rows, S.RAW_LOG)


def meta_df(spark, rows):
    return spark.createDataFrame(rows, S.POOL_META_TABLE)


def typed(spark, rows):
    """rows: dicts with address, event_name, timestamp, block, amounts, fee, tokens."""
    out = []
    for i, r in enumerate(rows):
        dec = None if r.get("decoded_null") else {
            "amount0": r.get("amount0"), "amount1": r.get("amount1")}
        meta = {"token0": r.get("token0", "0xaaaa"), "token1": r.get("token1", "0xbbbb"),
                "fee": r.get("fee", 2500), "tick_spacing": 60, "liquidity": None, "slot0": None}
        out.append((r.get("chain_id", 56), r.get("block", i + 1), "0xb", r.get("tx", f"0x{i:x}"),
                    r.get("log_index", 0), r.get("address", "0xpool"), r.get("event_name", "Swap"),
                    r["timestamp"], dec, meta, None))
    return spark.createDataFrame(out, S.TYPED_EVENT)
