"""Post-aggregation enrichment: decimals, TVL, rates, final metrics row.

J4, J6, M1-M7.  These lookups run on aggregated window rows, never on
events, exactly like the reference's late lookups at flush time; that keeps
every join here the size of the output, not of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions import bigint as B
from tidepool.functions.hexcodec import address_key, is_hex_address
from tidepool.functions.ratios import fee_rates
from tidepool.operators.asof import asof_answers
from tidepool.operators.aggregate import drop_missing_meta
from tidepool.operators.ingest import first_copy
from tidepool.plans.joins import bounded_broadcast
from tidepool.session import cut_lineage

# Fixed method labels written with every metrics row (M4).
FEE_METHOD = "approx_from_feeTier"
TVL_AT_BLOCK = "balance_of_block"
TVL_LATEST = "balance_of_latest"
TVL_NONE = "unavailable"
WINDOW_KEY = ["chain_id", "pool_address", "window_start"]


def attach_decimals(windows: DataFrame, tokens: DataFrame) -> DataFrame:
    """decimals0/decimals1 from the token dimension.

    A token without a row, or with an invalid address, gets decimals 0, i.e.
    raw integer amounts, as in the reference; ``decimals_known`` tells the
    two cases apart (Q5).  A token that repeats counts once (the most decimals).
    """
    one = first_copy(tokens.select("chain_id", address_key(F.col("address")).alias("address"),
                                   F.col("decimals").cast("int").alias("decimals")),
                     ["chain_id", "address"], [F.col("decimals").desc()])
    dim = bounded_broadcast(one)
    out = windows
    for side in ("0", "1"):
        t = dim.select(F.col("chain_id").alias(f"_tc{side}"), F.col("address").alias(f"_ta{side}"),
                       F.col("decimals").alias(f"_td{side}"))
        tok = F.col(f"token{side}")
        j = out.join(t, (F.col("chain_id") == F.col(f"_tc{side}")) & (address_key(tok) == F.col(f"_ta{side}")), "left")
        known = is_hex_address(tok) & F.col(f"_td{side}").isNotNull()
        out = j.select(*[F.col(c) for c in out.columns],
                       F.when(known, F.col(f"_td{side}")).otherwise(F.lit(0)).alias(f"decimals{side}"),
                       known.alias(f"_known{side}"))
    return (out.withColumn("decimals_known", F.col("_known0") & F.col("_known1"))
            .drop("_known0", "_known1"))


def format_raw(raw: str, decimals: str) -> Column:
    """M1 on unsigned raw digit text (column names)."""
    return F.expr(B.sql_format_units(raw, decimals))


def attach_tvl(windows: DataFrame, balances: DataFrame, bucket_size: int = 10_000) -> DataFrame:
    """Pool balances of both tokens as of the window's last block.

    Both at that block -> balance_of_block; else both at the latest snapshot ->
    balance_of_latest; else NULLs and unavailable.  A mixed result is not kept.
    Adds tvl0_raw, tvl1_raw, tvl_method.
    """
    bal = balances.select(
        "chain_id", address_key(F.col("token")).alias("token"), address_key(F.col("owner")).alias("owner"),
        "block_number", "balance")
    # One as-of pass for both tokens, written once: its answers are joined once per side, and the
    # balances are not read again for the second one.
    found = cut_lineage(asof_answers(tvl_sides(windows), bal, ["chain_id", "token", "owner"], ["chain_id", "token", "owner"],
                                     "last_block", "block_number", ["balance"], bucket_size))
    w = windows
    for side in (0, 1):
        c, t, o, at = (f"_a{side}{x}" for x in "ctop")
        a = found.select(F.col("_k0").alias(c), F.col("_k1").alias(t), F.col("_k2").alias(o), F.col("_p").alias(at),
                         F.col("_found.balance").alias(f"_b{side}_balance"),
                         F.col("_latest.balance").alias(f"_b{side}_latest_balance"))
        w = w.join(a, (F.col("chain_id") == F.col(c)) & (address_key(F.col(f"token{side}")) == F.col(t))
                   & (address_key(F.col("pool_address")) == F.col(o)) & (F.col("last_block") == F.col(at)), "left")
    return _pick(w, windows.columns)


def tvl_sides(windows: DataFrame) -> DataFrame:
    """Two rows per window, one for each token: window key, last_block, owner, side, token."""
    return windows.select(*WINDOW_KEY, "last_block", address_key(F.col("pool_address")).alias("owner"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), address_key(F.col("token0")).alias("token")),
        F.struct(F.lit(1).alias("side"), address_key(F.col("token1")).alias("token")))).alias("_s")).select(
        *WINDOW_KEY, "last_block", "owner", "_s.side", "_s.token")


def pick_tvl(windows: DataFrame, found: DataFrame) -> DataFrame:
    """``windows`` with tvl0_raw, tvl1_raw, tvl_method, from both sides' ``_b_balance`` and ``_b_latest_balance``."""
    both = found.groupBy(*WINDOW_KEY).agg(*[
        F.max(F.when(F.col("side") == side, F.col(f"_b_{c}"))).alias(f"_b{side}_{c}")
        for side in (0, 1) for c in ("balance", "latest_balance")])
    return _pick(windows.join(both, WINDOW_KEY, "left"), windows.columns)


def _pick(w: DataFrame, keep: list[str]) -> DataFrame:
    """Both sides at the block, else both at the latest snapshot, else none."""
    valid = (is_hex_address(F.col("token0")) & is_hex_address(F.col("token1"))
             & is_hex_address(F.col("pool_address")) & (F.col("last_block") > 0))
    at_block = valid & F.col("_b0_balance").isNotNull() & F.col("_b1_balance").isNotNull()
    latest = valid & F.col("_b0_latest_balance").isNotNull() & F.col("_b1_latest_balance").isNotNull()
    method = F.when(at_block, TVL_AT_BLOCK).when(latest, TVL_LATEST).otherwise(TVL_NONE)
    tvl0 = F.when(at_block, F.col("_b0_balance")).when(latest, F.col("_b0_latest_balance"))
    tvl1 = F.when(at_block, F.col("_b1_balance")).when(latest, F.col("_b1_latest_balance"))
    picked = w.select(*keep, tvl0.alias("_tv0"), tvl1.alias("_tv1"), method.alias("tvl_method"))
    return picked.select(*keep, _canon("_tv0").alias("tvl0_raw"),
                         _canon("_tv1").alias("tvl1_raw"), "tvl_method")


def _canon(text: str) -> Column:
    """Balance text -> canonical digits (no sign, no leading zeros, "0" for 0)."""
    digits, _, ok = B.sql_decimal_parts(text)
    return F.expr(f"CASE WHEN {text} IS NOT NULL AND {ok} THEN CASE WHEN {digits} = '' THEN '0' ELSE {digits} END END")


def metrics_row(w: DataFrame) -> DataFrame:
    """Final metrics projection (M1-M7) from windows with decimals and TVL."""
    rates = fee_rates(F.col("fee0_raw"), F.col("fee1_raw"), F.col("tvl0_raw"), F.col("tvl1_raw"),
                      F.col("window_size_seconds"))
    d0, d1 = F.col("decimals0"), F.col("decimals1")
    staged = w.withColumn("_rates", rates)
    return staged.select(
        "chain_id", "pool_address", "window_size_seconds", "window_start", "window_end",
        "swap_count",
        format_raw("volume0_raw", "decimals0").alias("volume0"),
        format_raw("volume1_raw", "decimals1").alias("volume1"),
        format_raw("fee0_raw", "decimals0").alias("fee0"),
        format_raw("fee1_raw", "decimals1").alias("fee1"),
        F.lit(None).cast("string").alias("fee_usd"),
        F.col("_rates.fee_rate0").alias("fee_rate0"),
        F.col("_rates.fee_rate1").alias("fee_rate1"),
        F.when(F.col("tvl0_raw").isNotNull(), format_raw("tvl0_raw", "decimals0")).alias("tvl0"),
        F.when(F.col("tvl1_raw").isNotNull(), format_raw("tvl1_raw", "decimals1")).alias("tvl1"),
        F.lit(None).cast("string").alias("tvl_usd"),
        F.col("_rates.apr").alias("apr"),
        F.lit(FEE_METHOD).alias("fee_method"),
        "tvl_method",
        "decimals_known",
    )


def window_metrics(windows: DataFrame, tokens: DataFrame, balances: DataFrame,
                   bucket_size: int = 10_000) -> DataFrame:
    """Aggregated windows -> pool_window_metrics rows.

    The windows feed several branches (both TVL sides, the as-of keys, the
    joins back), so they are checkpointed once instead of re-aggregating all
    events per branch.
    """
    w = cut_lineage(attach_decimals(drop_missing_meta(windows), tokens))
    w = attach_tvl(w, balances, bucket_size)
    return metrics_row(w)
