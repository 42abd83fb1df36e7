"""Snapshot tables that replace remote chain calls.

Each is a plain table read with an explicit schema; ``build_tokens`` turns the
raw results of token calls into the token dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import schemas as S


def read_table(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.BLOCKS)


def read_pool_meta(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.POOL_META_TABLE)


def read_pool_live(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.POOL_LIVE)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.TOKENS)


def read_balances(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.BALANCES)


def bytes32_text(word: Column) -> Column:
    """bytes32 hex -> text with trailing NUL bytes removed."""
    body = F.lower(F.regexp_replace(word, "^0[xX]", ""))
    return F.unhex(F.regexp_replace(body, "(00)+$", "")).cast("string")


def uint8_word(word: Column) -> Column:
    """uint8 ABI word -> value; NULL when the word does not hold a uint8."""
    body = F.lower(F.regexp_replace(word, "^0[xX]", ""))
    ok = (F.length(body) == 64) & (body.substr(1, 62) == F.lit("0" * 62)) & body.rlike("^[0-9a-f]*$")
    return F.when(ok, F.conv(body.substr(63, 2), 16, 10).cast("short"))


def build_tokens(calls: DataFrame) -> DataFrame:
    """Token dimension from raw call results.

    ``calls``: chain_id, address, decimals_word (NULL = call failed),
    symbol_text / name_text (string ABI result, NULL = failed) and
    symbol_word / name_word (bytes32 ABI result, NULL = failed).
    decimals is required: without it the token gets zeros and empty texts,
    as the reference caches on failure.  symbol / name: string result, else
    bytes32 result, else "".
    """
    dec = uint8_word(F.col("decimals_word"))
    ok = dec.isNotNull()

    def text(kind: str) -> Column:
        t = F.coalesce(F.col(f"{kind}_text"), bytes32_text(F.col(f"{kind}_word")), F.lit(""))
        return F.when(ok, t).otherwise(F.lit(""))

    return calls.select(
        "chain_id", F.lower(F.col("address")).alias("address"),
        F.coalesce(dec, F.lit(0).cast("short")).alias("decimals"),
        text("symbol").alias("symbol"), text("name").alias("name"),
        ok.alias("meta_ok"))
