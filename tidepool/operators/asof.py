"""As-of join: attach to each left row the latest right row at or before it.

Spark has no native as-of join.  Positions (block numbers) are cut into
fixed-width buckets, and the work is split so that no step needs a whole key
in one task and nothing is exploded:

1. Left and right rows are stacked and, per (key, bucket), a running
   ``last(value, ignorenulls)`` ordered by position gives each left row the
   latest snapshot inside its own bucket.
2. The same window marks each (key, bucket)'s last snapshot (one row per
   non-empty bucket), with no extra shuffle.
3. A left row with no snapshot in its bucket takes the last snapshot of any
   earlier bucket of its key: a running ``last`` over the small per-bucket
   table, ordered by bucket (at most span / bucket rows per key); the same
   window gives the key's final snapshot (the "latest" fallback).

A hot key (one pool with a third of all events) is spread over its buckets
in every shuffle; the only per-key window runs on the per-bucket summary.
Of right rows that repeat (keys, position) the one with the largest values
counts; they never repeat a left row.

Three forms: ``asof_join`` solves each distinct (key, position) once and joins
the answers back, ``asof_answers`` returns those answers for a caller that joins
them in its own way, and ``asof_rows`` sends the left rows themselves through
the window, for left rows that are costly to compute twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.bigint import idiv


def asof_join(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str],
              left_pos: str, right_pos: str, values: list[str], prefix: str,
              bucket_size: int = 10_000, with_latest: bool = False) -> DataFrame:
    """Left join ``left`` to the right row with equal keys and the greatest
    ``right_pos <= left_pos``.

    Adds ``{prefix}{v}`` for each value column and ``{prefix}pos`` (NULLs when
    no such row).  With ``with_latest`` also ``{prefix}latest_{v}`` and
    ``{prefix}latest_pos``: the key's last row regardless of position.
    """
    # The answer depends only on (key, position): solve it per distinct pair
    # and join back on those columns (no synthetic row ids, which would not
    # survive a recomputation of a shuffled input).
    found = asof_answers(left, right, left_on, right_on, left_pos, right_pos, values, bucket_size)
    cond = [left[c] == found[x] for c, x in zip(left_on, _keys(left_on))] + [left[left_pos] == found["_p"]]
    return left.join(found, cond, "left").select(*left.columns, *_named(values, prefix, with_latest))


def asof_answers(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str],
                 left_pos: str, right_pos: str, values: list[str], bucket_size: int = 10_000) -> DataFrame:
    """One row per distinct (keys, position) of ``left``: ``_k0``.., ``_p``, and the structs ``_found``, ``_latest``
    of (pos, *values)."""
    k = _keys(left_on)
    r = _right(right, right_on, right_pos, values, bucket_size)
    lk = (left.select(*[F.col(c).alias(x) for c, x in zip(left_on, k)], F.col(left_pos).alias("_p"))
          .where(F.col("_p").isNotNull()).distinct().withColumn("_b", idiv(F.col("_p"), int(bucket_size))))

    # 1. Within-bucket fill: right rows (tag 0) sort before left rows (tag 1)
    #    at equal position.  The same window also finds each bucket's last
    #    snapshot (the right row with no right row after it).
    vtype = r.schema["_v"].dataType
    stacked = (r.select(*k, "_b", "_p", F.lit(0).alias("_t"), "_v")
               .unionByName(lk.select(*k, "_b", "_p", F.lit(1).alias("_t"), F.lit(None).cast(vtype).alias("_v"))))
    w_in = Window.partitionBy(*k, "_b").orderBy("_p", "_t", "_v")
    filled = (stacked
              .withColumn("_hit", F.last("_v", ignorenulls=True).over(
                  w_in.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_later", F.sum(1 - F.col("_t")).over(
                  w_in.rowsBetween(1, Window.unboundedFollowing))))
    local = filled.where(F.col("_t") == 1).select(*k, "_b", "_p", "_hit")
    # 2. One row per non-empty (key, bucket): its last snapshot.
    per_bucket = filled.where((F.col("_t") == 0) & F.coalesce(F.col("_later") == 0, F.lit(True)))
    carry = _carry(per_bucket, lk.select(*k, "_b").distinct(), k)
    return local.join(carry, [*k, "_b"], "left").select(
        *k, "_p", F.coalesce(F.col("_hit"), F.col("_carry")).alias("_found"), "_latest")


def asof_rows(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str],
              left_pos: str, right_pos: str, values: list[str], prefix: str, asked: DataFrame,
              bucket_size: int = 10_000, with_latest: bool = False) -> DataFrame:
    """``asof_join`` that reads ``left`` once and shuffles it once.

    The left rows are stacked with the snapshots and filled in one window by
    (key, bucket); the carry-in is joined on that same partitioning.  The
    buckets to carry into come from ``asked``, which must hold the columns
    ``left_on`` and ``left_pos`` with at least the values of ``left`` (more do no
    harm), so that a cheap input of ``left`` can stand for it.  Left rows without
    a key or position stay, with NULLs; they share a bucket, so few are expected.
    """
    k, b, names = _keys(left_on), int(bucket_size), left.columns
    r = _right(right, right_on, right_pos, values, b).where(F.col("_p").isNotNull())
    types = {f.name: f.dataType for f in left.schema.fields}
    rows = left.select(*[F.col(c).alias(x) for c, x in zip(left_on, k)], F.col(left_pos).alias("_p"),
                       F.lit(1).alias("_t"), F.lit(None).cast(r.schema["_v"].dataType).alias("_v"), *names)
    stacked = rows.withColumn("_b", idiv(F.col("_p"), b)).unionByName(
        r.select(*k, "_b", "_p", F.lit(0).alias("_t"), "_v", *[F.lit(None).cast(types[c]).alias(c) for c in names]))
    known = F.col("_p").isNotNull()
    for x in k:
        known = known & F.col(x).isNotNull()
    w_in = Window.partitionBy(*k, "_b").orderBy("_p", "_t", "_v").rowsBetween(Window.unboundedPreceding, 0)
    filled = stacked.withColumn("_hit", F.last("_v", ignorenulls=True).over(w_in)).where(F.col("_t") == 1)

    last = Window.partitionBy(*k, "_b").orderBy(F.col("_v").desc())
    per_bucket = r.withColumn("_rn", F.row_number().over(last)).where(F.col("_rn") == 1)
    wanted = (asked.select(*[F.col(c).alias(x) for c, x in zip(left_on, k)], idiv(F.col(left_pos), b).alias("_b"))
              .where(F.col("_b").isNotNull()).distinct())
    found = filled.join(_carry(per_bucket, wanted, k), [*k, "_b"], "left").withColumn(
        "_found", F.coalesce(F.when(known, F.col("_hit")), F.col("_carry")))
    return found.select(*names, *_named(values, prefix, with_latest))


def _keys(on: list[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(on))]


def _right(right: DataFrame, on: list[str], pos: str, values: list[str], bucket_size: int) -> DataFrame:
    """``_k0``.., ``_p``, ``_b`` and the struct ``_v`` of (pos, *values)."""
    r = right.select(*[F.col(c).alias(x) for c, x in zip(on, _keys(on))], F.col(pos).alias("_p"), *values)
    return r.select(*_keys(on), "_p", idiv(F.col("_p"), int(bucket_size)).alias("_b"),
                    F.struct(F.col("_p").alias("pos"), *values).alias("_v"))


def _carry(per_bucket: DataFrame, wanted: DataFrame, k: list[str]) -> DataFrame:
    """3. Carry-in from earlier buckets over the per-bucket table only; the same
    window gives each key's final snapshot (the latest fallback)."""
    vtype = per_bucket.schema["_v"].dataType
    chain = (per_bucket.select(*k, "_b", F.lit(1).alias("_t"), "_v")
             .unionByName(wanted.select(*k, "_b", F.lit(0).alias("_t"), F.lit(None).cast(vtype).alias("_v"))))
    w_key = Window.partitionBy(*k).orderBy("_b", "_t")
    return (chain
            .withColumn("_carry", F.last("_v", ignorenulls=True).over(w_key.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_latest", F.last("_v", ignorenulls=True).over(
                w_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .where(F.col("_t") == 0).select(*k, "_b", "_carry", "_latest"))


def _named(values: list[str], prefix: str, with_latest: bool) -> list:
    cols = [F.col(f"_found.{v}").alias(f"{prefix}{v}") for v in [*values, "pos"]]
    return cols + ([F.col(f"_latest.{v}").alias(f"{prefix}latest_{v}") for v in [*values, "pos"]] if with_latest else [])
