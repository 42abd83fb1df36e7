"""Sharding by sampled splitters, with DataFrame expressions only.

Records are ordered by (hash of the text, id), so equal texts lie together and
are cut by id only where a shard boundary falls among them.  A size-weighted
sample of the keys (exponential priorities ``-ln(u) / size``, the smallest are
drawn; u is a hash of the record, so a retry draws the same) gives quantile
splitters that cut the order into ranges of about ``RANGE_ROWS`` records.
Ranges that turn out to hold over twice their share are subdivided by splitters
sampled inside them.  A window within each range and the ranges' totals then
give every record its exact position in bytes and rows, and the law ``bytes``
cuts the whole order into shards of equal bytes, to within one key.

Only slim rows (id, size, checksum, key) are shuffled, once, by range; the
driver sees the sample and one total per range, both bounded by ``MAX_RANGES``.

Edge cases: null text has no bytes, size 1; a null id sorts first; rows with one
key (repeated rows) stay in one shard with slots of their own; an empty table
gives an empty result; other columns are ignored by the query and kept by
``write_shards``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import read_table, written

SHARDS = 8
RANGE_ROWS = 100_000            # records of one window task
MIN_RANGES, MAX_RANGES = 64, 65_536
SAMPLE_PER_RANGE = 16
OVERFULL = 2.0                  # times the mean bytes (or rows) of a range
MAX_ROUNDS = 8

_KEYS = "array<struct<h:bigint,i:bigint>>"


def _key(hash_: str = "h", id_: str = "doc_id") -> Column:
    return F.struct(F.col(hash_).alias("h"), F.coalesce(F.col(id_).cast("long"), F.lit(-2 ** 63)).alias("i"))


def _array(values: list, kind: str) -> Column:
    """A constant array as one literal, folded by the optimizer."""
    return F.from_json(F.lit(json.dumps(values)), F.lit(kind))


def _rank(key: Column, splitters: list[tuple[int, int]]) -> Column:
    """How many of the sorted splitters are <= key: a binary search in log2 steps."""
    if not splitters:
        return F.lit(0)
    found, n = _array([{"h": h, "i": i} for h, i in splitters], _KEYS), len(splitters)
    steps = F.array(*[F.lit(1 << b) for b in range(n.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= n) & (F.get(found, at + s - 1) <= key), at + s).otherwise(at))


def _sample(rows: DataFrame, n: int, total: int) -> list[tuple[int, int]]:
    """Keys of a size-weighted sample of at most ``n`` rows of ``total`` bytes, sorted.

    Rows above twice the priority at which ``n`` are expected cannot be among
    them and are dropped where they are read.
    """
    u = (F.shiftrightunsigned(F.xxhash64("h", "doc_id", F.lit(11)), 11) + 0.5) / float(1 << 53)
    got = (rows.select(_key().alias("k"), (-F.log(u) / F.col("size")).alias("p"))
           .filter(F.col("p") <= 2 * n / max(total, 1)).orderBy("p", "k").limit(n).collect())
    return sorted((r.k.h, r.k.i) for r in got)


def _quantiles(sample: list, parts: int) -> set:
    return {sample[len(sample) * j // parts] for j in range(1, parts)} if sample else set()


def splitters(rows: DataFrame) -> list[tuple[int, int]]:
    """Range splitters of ``rows`` (doc_id, size, h): weighted quantiles, overfull ranges subdivided."""
    total = rows.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not total.n:
        return []
    ranges = min(MAX_RANGES, max(MIN_RANGES, -(-total.n // RANGE_ROWS)))
    cuts = _quantiles(_sample(rows, ranges * SAMPLE_PER_RANGE, total.b), ranges)
    fair_bytes, fair_rows = OVERFULL * total.b / ranges, OVERFULL * max(total.n / ranges, RANGE_ROWS)
    for _ in range(MAX_ROUNDS):
        at = rows.withColumn("r", _rank(_key(), sorted(cuts)))
        heavy = {r.r: (max(r.b / fair_bytes, r.n / fair_rows), r.b) for r in at.groupBy("r").agg(
            F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), F.min(_key()).alias("lo"),
            F.max(_key()).alias("hi")).filter("lo != hi").collect()}
        full = {r: x for r, (x, _) in heavy.items() if x > 1}
        if not full or len(cuts) >= 2 * MAX_RANGES:
            break
        parts = int(sum(2 * x + 1 for x in full.values())) + 1
        more = _sample(at.filter(F.col("r").isin(list(full))), min(parts, MAX_RANGES) * SAMPLE_PER_RANGE,
                       sum(heavy[r][1] for r in full))
        new = cuts | _quantiles(more, parts)
        if new == cuts:
            break
        cuts = new
    return sorted(cuts)


def slim_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"),
                       (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
                       F.xxhash64(F.col(text)).alias("h"))


def assign(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, h, shard, slot): contiguous ranges of the key order, equal bytes."""
    rows = written(slim_rows(docs, key, text), "shard-keys")
    cuts = splitters(rows)
    ranged = rows.withColumn("r", _rank(_key(), cuts))
    per = {r.r: (r.b, r.n) for r in ranged.groupBy("r").agg(F.sum("size").alias("b"),
                                                            F.count(F.lit(1)).alias("n")).collect()}
    bytes_before, rows_before, b, n = [], [], 0, 0
    for r in range(len(cuts) + 1):
        bytes_before.append(b), rows_before.append(n)
        b, n = b + per.get(r, (0, 0))[0], n + per.get(r, (0, 0))[1]
    order = Window.partitionBy("r").orderBy("h", F.col("doc_id").asc_nulls_first(), "text_crc32")
    # The default frame of a running sum takes in all rows of the same key, which so get one shard.
    placed = ranged.select(
        "doc_id", "size", "text_crc32", "h",
        (F.get(_array(bytes_before, "array<bigint>"), F.col("r")) + F.sum("size").over(order)).alias("upto"),
        (F.get(_array(rows_before, "array<bigint>"), F.col("r")) + F.row_number().over(order) - 1).alias("row"))
    shard = F.least(F.floor((F.col("upto") - F.col("size") / 2) * shards / F.lit(max(b, 1))), F.lit(shards - 1))
    placed = written(placed.withColumn("shard", shard.cast("int")), "shard-rows")
    first = {r.shard: r.row for r in placed.groupBy("shard").agg(F.min("row").alias("row")).collect()}
    starts = _array([first.get(s, 0) for s in range(shards)], "array<bigint>")
    return placed.select("doc_id", "size", "text_crc32", "h", "shard",
                         (F.col("row") - F.get(starts, F.col("shard"))).alias("slot"))


def shard_starts(assigned: DataFrame) -> list[tuple[int, int, int]]:
    """(h, id, shard) of the first key of each shard that has rows: the splitters that route a record."""
    got = assigned.groupBy("shard").agg(F.min(_key()).alias("k")).orderBy("shard").collect()
    return [(r.k.h, r.k.i, r.shard) for r in got]


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id", text: str = "text",
                 files_per_shard: int = 8) -> DataFrame:
    """Write whole records under ``path``/shard=N and return the assignment.

    A record is routed by its key through the shards' first keys, and by a hash
    of the record to one of ``files_per_shard`` files: one shuffle of the records.
    A column of the input that is named ``shard`` is written as ``shard_in``, since the
    folders carry that name.
    """
    assigned = assign(docs, shards, key, text)
    starts = shard_starts(assigned)
    if not starts:
        return assigned
    names = _array([s for *_, s in starts], "array<int>")
    routed = docs.withColumnRenamed("shard", "shard_in").withColumn("_route_h", F.xxhash64(F.col(text)))
    where = F.get(names, F.greatest(_rank(_key("_route_h", key), [(h, i) for h, i, _ in starts]) - 1, F.lit(0)))
    routed = routed.withColumn("shard", where).withColumn("_route_f", F.pmod(F.xxhash64(key, "_route_h"),
                                                                             F.lit(files_per_shard)))
    routed.repartition(shards * files_per_shard, "shard", "_route_f").drop("_route_h", "_route_f").write.mode(
        "overwrite").partitionBy("shard").parquet(path)
    return assigned


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """Contract query: shard and slot of every document, by the law ``bytes``."""
    return assign(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"))
