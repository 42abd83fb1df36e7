"""Raw-log ingest: range plans, scan filters, normalisation, dedup, block times.

S1, S13, P1-P4, P12, P16, D1, J1.  The log table that the ingest job writes holds
lower-case hex text, ``topic0`` as a column and a ``block_bucket`` partition
column, so there the block range, address and topic0 filters reach the Parquet
reader and whole buckets are pruned.  Logs from elsewhere are filtered by the
same rules on normalised values.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.functions.bigint import idiv
from tidepool.functions.hexcodec import ADDRESS_RE, TOPIC_RE, address_key
from tidepool.plans.joins import bounded_broadcast

LOG_KEY = ["chain_id", "block_number", "tx_hash", "log_index"]
# Copies of one log are told apart by these columns; the smallest is kept.
LOG_ORDER = ["removed", "block_hash", "tx_index", "address", "topics", "data", "timestamp"]
# IN-lists longer than this become a broadcast semi join instead of a literal list.
MAX_INLIST = 1_000


def split_range(spark: SparkSession, start: int, end: int, batch: int) -> DataFrame:
    """Inclusive block chunks [from_block, to_block], the last one short."""
    if batch <= 0:
        raise ValueError("batch size must be > 0")
    if end < start:
        raise ValueError(f"invalid range: from {start} > to {end}")
    return (spark.range(start, end + 1, batch)
            .select(F.col("id").alias("from_block"),
                    F.least(F.col("id") + F.lit(batch - 1), F.lit(end)).alias("to_block")))


def split_range_cols(start: Column, end: Column, batch: int) -> Column:
    """Same plan as an array of structs from column bounds (data-driven ranges)."""
    return F.transform(F.sequence(start, end, F.lit(batch).cast("bigint")),
                       lambda x: F.struct(x.alias("from_block"),
                                          F.least(x + F.lit(batch - 1), end).alias("to_block")))


def parse_addresses(values: list[str]) -> list[str]:
    """Trim, drop blanks, reject non-addresses; lower-case 0x form."""
    out = []
    for v in values:
        v = (v or "").strip()
        if not v:
            continue
        if not re.fullmatch(ADDRESS_RE, v):
            raise ValueError(f"invalid address: {v}")
        out.append("0x" + v[-40:].lower())
    return out


def parse_topic0(values: list[str]) -> list[str]:
    """Trim, drop blanks, require 0x + 32 bytes of hex; lower case."""
    out = []
    for v in values:
        v = (v or "").strip()
        if not v:
            continue
        if not re.fullmatch(TOPIC_RE, v):
            raise ValueError(f"invalid topic0: {v}")
        out.append(v.lower())
    return out


def _member(c: Column, values: list[str], spark: SparkSession, name: str):
    """(predicate, semi-join table) for membership of a lower-cased column."""
    if len(values) <= MAX_INLIST:
        return c.isin(*values), None
    return None, spark.createDataFrame([(v,) for v in values], f"{name} string")


def scan_logs(logs: DataFrame, from_block: int | Column, to_block: int | Column,
              addresses: list[str], topic0: list[str] | None = None, block_batch: int | None = None) -> DataFrame:
    """Inclusive block range, mandatory address list, optional topic0 list.

    topic0 matches position 0 only; an empty list means any.  On a table with
    a ``topic0`` column (written by the ingest job) the filters are plain
    predicates on stored columns; with its ``block_bucket`` column and the
    ``block_batch`` it was written with, the range also selects partitions.
    """
    addrs = parse_addresses(addresses)
    if not addrs:
        raise ValueError("at least one address is required")
    topics = parse_topic0(topic0 or [])
    spark, landed = logs.sparkSession, "topic0" in logs.columns
    lo = from_block if isinstance(from_block, Column) else F.lit(int(from_block))
    hi = to_block if isinstance(to_block, Column) else F.lit(int(to_block)) if to_block else None
    out = logs.where(F.col("block_number") >= lo)
    if hi is not None:      # to = 0: up to the latest block present (S13)
        out = out.where(F.col("block_number") <= hi)
    if block_batch and "block_bucket" in logs.columns:
        out = out.where(F.col("block_bucket") >= idiv(lo, block_batch))
        if hi is not None:
            out = out.where(F.col("block_bucket") <= idiv(hi, block_batch))
    wanted = [(F.col("address") if landed else address_key(F.col("address")), addrs, "_addr")]
    if topics:      # ``get`` keeps an empty topic array from raising under ANSI mode
        wanted.append((F.col("topic0") if landed else F.lower(F.get(F.col("topics"), 0)), topics, "_t0"))
    for column, values, name in wanted:
        pred, table = _member(column, values, spark, name)
        out = out.where(pred) if pred is not None else out.join(
            bounded_broadcast(table), column == table[name], "left_semi")
    return out


def resume_from(from_block: int, checkpoint: int | None) -> int:
    """With a stored checkpoint >= from, restart at checkpoint + 1."""
    if checkpoint is not None and checkpoint >= from_block:
        return checkpoint + 1
    return from_block


def normalize_logs(logs: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Lower-case hex text and one ingest time per batch (P4); ``removed`` kept."""
    at = ingested_at if ingested_at is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return logs.select(
        "chain_id", "block_number", F.lower("block_hash").alias("block_hash"),
        F.lower("tx_hash").alias("tx_hash"), "tx_index", "log_index",
        F.lower("address").alias("address"),
        F.transform("topics", lambda t: F.lower(t)).alias("topics"),
        F.lower("data").alias("data"),
        F.coalesce(F.col("removed"), F.lit(False)).alias("removed"),
        "timestamp", at.alias("ingested_at"))


def drop_removed(logs: DataFrame, enabled: bool = False) -> DataFrame:
    """Optional filter of reorged logs; off by default as in the reference."""
    return logs.where(~F.coalesce(F.col("removed"), F.lit(False))) if enabled else logs


def first_copy(rows: DataFrame, key: list[str], order_by: list[Column]) -> DataFrame:
    """One row per key: the first in a total order, so the survivor does not depend on the shuffle."""
    if not order_by:        # nothing but the key: copies are equal
        return rows.dropDuplicates(key)
    w = Window.partitionBy(*key).orderBy(*order_by)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_logs(logs: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    """One row per (chain, block, tx, log index).

    Copies that differ are ordered by ``order_by`` (default: LOG_ORDER, so an
    unremoved copy wins) and the first is kept.  The shuffle is hashed on the
    full log key, so a hot pool or block does not land in one task, and a
    window sees only the copies of one log.
    """
    return first_copy(logs, LOG_KEY, order_by or [F.col(c) for c in LOG_ORDER if c in logs.columns])


def new_logs(logs: DataFrame, written: DataFrame) -> DataFrame:
    """The logs whose key is not in ``written`` yet: appending them twice adds nothing."""
    return logs.join(written.select(*LOG_KEY), LOG_KEY, "left_anti")


def attach_block_time(logs: DataFrame, blocks: DataFrame, require: bool = False) -> DataFrame:
    """Set ``timestamp`` from the block-header table.

    A log whose block has no header keeps a NULL timestamp and
    ``block_time_missing`` = true; with ``require`` it fails the job, as the
    reference aborts.  A repeated header (the smallest timestamp stands) does
    not repeat logs.  The join is an equi join on (chain, block): shuffled,
    never broadcast, as the header table grows with the chain; the reduction
    to one header per block uses the same partitioning.
    """
    b = blocks.groupBy("chain_id", "block_number").agg(F.min("timestamp").alias("_bt"))
    j = logs.drop("timestamp").join(b, ["chain_id", "block_number"], "left")
    found = F.col("_bt")
    if require:     # the check is part of a column that is kept, so the optimizer cannot drop it
        found = F.coalesce(found, F.raise_error(F.concat(
            F.lit("block timestamp lookup failed: "), F.col("block_number").cast("string"))).cast("bigint"))
    return j.withColumn("timestamp", found).withColumn("block_time_missing", F.col("_bt").isNull()).drop("_bt")
