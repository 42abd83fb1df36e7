"""Writers: log landing (append), typed events and dead letters, metrics versions.

S4-S7.  The decode split is one plan persisted once and written twice, so
the two outputs come from the same classification.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidepool.operators import decode as D


def append_logs(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple = ()) -> None:
    """Append a batch of raw logs (S4); an empty batch writes nothing.

    Rows are dealt by ``partition_by`` first, so a batch adds one file to each
    folder it touches, not one per folder and task.
    """
    if partition_by:
        df.repartition(*partition_by).write.mode("append").format(fmt).partitionBy(*partition_by).save(path)
    else:
        df.write.mode("append").format(fmt).save(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Overwrite a folder of JSON lines; NULL fields are left out."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_decoded(decoded: DataFrame, events_path: str, errors_path: str, fmt: str = "json") -> dict:
    """Write typed events and dead letters from one classification.

    Returns the run counters total / decoded / skipped / failed, gathered with
    an ``Observation`` during the first write (no extra pass).
    """
    obs = Observation("decode_counters")
    outcome = F.col("outcome")
    staged = decoded.observe(
        obs,
        F.count(F.lit(1)).alias("total"),
        F.sum((outcome == D.OUTCOME_DECODED).cast("bigint")).alias("decoded"),
        F.sum((outcome == D.OUTCOME_SKIPPED).cast("bigint")).alias("skipped"),
        F.sum((outcome == D.OUTCOME_FAILED).cast("bigint")).alias("failed"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        events = D.typed_events(staged)
        errors = D.decode_errors(staged)
        if fmt == "json":
            write_json_lines(events, events_path)
            counters = {k: int(v or 0) for k, v in obs.get.items()}
            write_json_lines(errors, errors_path)
        else:
            events.write.mode("overwrite").format(fmt).save(events_path)
            counters = {k: int(v or 0) for k, v in obs.get.items()}
            errors.write.mode("overwrite").format(fmt).save(errors_path)
    finally:
        staged.unpersist()
    return counters


CLUSTER_KEY = ("address", "topic0", "block_number")


def write_clustered(logs: DataFrame, path: str, partitions: int | None = None, row_group_bytes: int | None = None) -> None:
    """Logs ordered by (address, topic0, block) over the whole table, with Bloom filters on address and topic0.

    A scan for a few pools then reads the row groups whose range and filter
    hold them.  The split points come from a sample of the keys, so a hot pool
    takes as many files as its share of the rows.
    """
    by = [F.col(c) for c in CLUSTER_KEY]
    dealt = logs.repartitionByRange(partitions, *by) if partitions else logs.repartitionByRange(*by)
    writer = dealt.sortWithinPartitions(*by).write.mode("overwrite")
    for c in CLUSTER_KEY[:2]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
