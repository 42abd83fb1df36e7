"""Streaming ingest: logs joined with block headers as two streams (J1, S11, W8), and late rows accounted for.

Both streams carry their block number as an event time (one second per block),
so a watermark is a block height: a log waits in state for its header until both
streams have passed its block by the allowed number of blocks, and goes to the dead letters
then.  One query serves one chain, since heights of different chains cannot share a watermark.

Repeated logs are dropped in state, and the sink appends only keys that the table
does not hold yet in the batch's blocks, so a replayed or re-delivered batch adds
nothing.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidepool import schemas as S
from tidepool.functions.bigint import idiv
from tidepool.operators import ingest as I
from tidepool.operators import upsert as U
from tidepool.sources import sinks as K

HEARTBEAT = "heartbeat"
BLOCK_BATCH = 2000


def _height(df: DataFrame, blocks_late: int) -> DataFrame:
    return df.withColumn("block_at", F.timestamp_seconds("block_number")).withWatermark("block_at", f"{int(blocks_late)} seconds")


def join_headers(logs: DataFrame, headers: DataFrame, blocks_late: int) -> DataFrame:
    """Streamed logs with their block's time; ``block_time_missing`` once no header came in time.

    Of repeated headers the first one stands.
    """
    own = _height(I.normalize_logs(logs), blocks_late).dropDuplicates([*I.LOG_KEY, "block_at"]).drop("timestamp")
    h = _height(headers, blocks_late).dropDuplicates(["chain_id", "block_number", "block_at"]).select(
        F.col("chain_id").alias("_hc"), F.col("block_at").alias("_ha"), F.col("timestamp").alias("_ht"))
    j = own.join(h, (F.col("chain_id") == F.col("_hc")) & (F.col("block_at") == F.col("_ha")), "leftOuter")
    return j.withColumn("timestamp", F.col("_ht")).withColumn("block_time_missing", F.col("_ht").isNull()).drop(
        "_hc", "_ha", "_ht", "block_at")


def start_ingest(spark: SparkSession, logs_dir: str, headers_dir: str, work_dir: str, blocks_late: int, chain_id: int,
                 available_now: bool = True) -> StreamingQuery:
    """Append logs with block times to ``work_dir``/logs and those without header to ``work_dir``/missing."""
    logs = spark.readStream.schema(S.RAW_LOG).json(logs_dir).where(F.col("chain_id") == chain_id)
    headers = spark.readStream.schema(S.BLOCKS).json(headers_dir).where(F.col("chain_id") == chain_id)
    joined = join_headers(logs, headers, blocks_late).where(F.col("tx_hash") != HEARTBEAT)

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*S.RAW_LOG.fieldNames(), F.get("topics", 0).alias("topic0"), "block_time_missing",
                            idiv(F.col("block_number"), BLOCK_BATCH).alias("block_bucket")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            span = rows.agg(F.min("block_bucket").alias("lo"), F.max("block_bucket").alias("hi")).first()
            if span.lo is None:
                return
            for name, part in (("logs", rows.where(~F.col("block_time_missing"))), ("missing", rows.where("block_time_missing"))):
                path = os.path.join(work_dir, name)
                part = part.drop("block_time_missing")
                if _there(spark, path):
                    held = spark.read.schema(part.schema).parquet(path).where(F.col("block_bucket").between(span.lo, span.hi))
                    part = I.new_logs(part, held)
                K.append_logs(part, path, partition_by=("chain_id", "block_bucket"))
        finally:
            rows.unpersist()
    writer = joined.writeStream.outputMode("append").foreachBatch(sink).option(
        "checkpointLocation", os.path.join(work_dir, "ingest-checkpoint"))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def _there(spark: SparkSession, path: str) -> bool:
    from tidepool.plans.jobs import _exists
    return _exists(spark, path)


def land_heartbeat(spark: SparkSession, logs_dir: str, headers_dir: str, chain_id: int, block: int) -> None:
    """Move both streams to ``block``, so that everything below the watermark is settled; leaves no row behind."""
    log = spark.range(1).select(F.lit(chain_id).cast("bigint").alias("chain_id"), F.lit(block).cast("bigint").alias("block_number"),
                                F.lit(HEARTBEAT).alias("tx_hash"), F.lit(0).cast("bigint").alias("log_index"))
    log.write.mode("append").json(logs_dir)
    log.select("chain_id", "block_number", F.lit(0).cast("bigint").alias("timestamp")).write.mode("append").json(headers_dir)


def read_ingested(spark: SparkSession, work_dir: str) -> DataFrame:
    """All settled logs: timestamp null and ``block_time_missing`` for those without header."""
    def part(name: str, missing: bool) -> DataFrame:
        path = os.path.join(work_dir, name)
        rows = spark.read.schema(S.RAW_LOG).parquet(path) if _there(spark, path) else spark.createDataFrame([], S.RAW_LOG)
        return rows.select(*S.RAW_LOG.fieldNames()).withColumn("block_time_missing", F.lit(missing))
    return part("logs", False).unionByName(part("missing", True))


# ---------------------------------------------------------------------------
# Late rows.

class DroppedRows(StreamingQueryListener):
    """Rows that a query's first stateful operator has dropped behind its watermark, from its progress reports."""

    def __init__(self, name: str):
        self.name, self.by_batch = name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.take(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def take(self, progress) -> None:
        if progress.name == self.name and progress.stateOperators:
            # Operators are listed from the sink up; the last one reads the source.
            self.by_batch[progress.batchId] = progress.stateOperators[-1].numRowsDroppedByWatermark

    @property
    def total(self) -> int:
        return sum(self.by_batch.values())


def start_unique_events(spark: SparkSession, events: DataFrame, work_dir: str, lateness: str, name: str,
                        available_now: bool = True) -> StreamingQuery:
    """Events once each, written as versions of ``work_dir``/unique; what comes behind the watermark is dropped.

    The rows dropped are reported by ``DroppedRows(name)`` and, row by row, by ``start_late_rows``.
    """
    timed = events.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", lateness)
    unique = timed.dropDuplicatesWithinWatermark(I.LOG_KEY).drop("event_time")
    writer = unique.writeStream.queryName(name).outputMode("append").foreachBatch(
        lambda batch, batch_id: U.write_version(batch, os.path.join(work_dir, "unique"), batch_id)).option(
        "checkpointLocation", os.path.join(work_dir, "unique-checkpoint"))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def start_late_rows(spark: SparkSession, events: DataFrame, work_dir: str, lateness_seconds: int,
                    available_now: bool = True) -> StreamingQuery:
    """The late rows themselves, as versions of ``work_dir``/late_rows.

    Late: the timestamp is at or before the highest one of all earlier
    micro-batches less the lateness, which is what a stateful operator with that
    watermark drops.  The highest timestamp so far is kept as a version per batch.
    """
    tops, path = os.path.join(work_dir, "late_tops"), os.path.join(work_dir, "late_rows")

    def sink(batch: DataFrame, batch_id: int) -> None:
        top = None
        if _there(spark, tops):
            top = spark.read.parquet(tops).where(F.col("batch_id") < batch_id).agg(F.max("top")).first()[0]
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            late = rows.where(F.col("timestamp") <= F.lit(top - lateness_seconds)) if top is not None else rows.limit(0)
            U.write_version(late, path, batch_id)
            U.write_version(rows.agg(F.max("timestamp").alias("top")), tops, batch_id)
        finally:
            rows.unpersist()
    writer = events.writeStream.outputMode("append").foreachBatch(sink).option(
        "checkpointLocation", os.path.join(work_dir, "late-checkpoint"))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()
