"""Keyed upserts without a table format that supports MERGE.

Each batch is appended as a new version (``batch_id``); readers keep the
latest version of every key.  Replaying a batch with the same id rewrites the
same rows, so a replay is idempotent.  ``created_at`` is the first version's
time, ``updated_at`` the latest one's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool import schemas as S


def latest_versions(versions: DataFrame, key: list[str], version_col: str = "batch_id") -> DataFrame:
    """Keep the row of the highest version per key (reader view of the table).

    With a ``written_at`` column, ``created_at`` is the key's first write and
    ``updated_at`` its latest one (the reference's insert / on-conflict times).
    """
    w = Window.partitionBy(*key).orderBy(F.col(version_col).desc())
    out = versions.withColumn("_rn", F.row_number().over(w))
    if "written_at" in versions.columns:
        out = (out.withColumn("created_at", F.min("written_at").over(Window.partitionBy(*key)))
               .withColumnRenamed("written_at", "updated_at"))
    return out.where(F.col("_rn") == 1).drop("_rn")


def merge_pools(versions: DataFrame) -> DataFrame:
    """Pool registry merge: latest metadata, first_seen_block = LEAST over versions."""
    key = list(S.POOLS_KEY)
    first = versions.groupBy(*key).agg(F.min("first_seen_block").alias("_first"))
    latest = latest_versions(versions, key)
    return (latest.join(first, key).withColumn("first_seen_block", F.col("_first")).drop("_first"))


def write_version(df: DataFrame, path: str, batch_id: int) -> None:
    """Append (or replace) one version folder of a keyed table."""
    (df.withColumn("written_at", F.current_timestamp())
       .write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={int(batch_id)}"))


def read_latest(spark, path: str, key: list[str]) -> DataFrame:
    """Reader view: the latest version of every key across all batch folders."""
    return latest_versions(spark.read.parquet(path), key)


def check_table(df: DataFrame, key: list[str], not_null: list[str]) -> DataFrame:
    """Schema contract check (S10): rows breaking NOT NULL, and duplicated keys."""
    broken = F.lit(False)
    for c in not_null:
        broken = broken | F.col(c).isNull()
    nulls = df.where(broken).select(
        F.lit("null").alias("problem"), F.to_json(F.struct(*key)).alias("key"))
    dups = (df.groupBy(*key).count().where(F.col("count") > 1)
            .select(F.lit("duplicate key").alias("problem"), F.to_json(F.struct(*key)).alias("key")))
    return nulls.unionByName(dups)


def require_contract(df: DataFrame, key: list[str], not_null: list[str], table: str) -> None:
    """Fail before anything is written when rows break the table's contract."""
    problems = check_table(df, key, not_null).limit(5).collect()
    if problems:
        raise ValueError(f"{table}: " + "; ".join(f"{p.problem} {p.key}" for p in problems))


def state_row(spark, name: str, last_ts, previous: int | None = None, force: bool = False) -> DataFrame:
    """pipeline_state row (S9); never moves backwards unless forced (Q13)."""
    if not name:
        raise ValueError("state name must not be empty")
    v = F.lit(last_ts) if not hasattr(last_ts, "_jc") else last_ts
    if previous is not None and not force:
        v = F.greatest(v, F.lit(int(previous)))
    return spark.range(1).select(F.lit(name).alias("name"), v.cast("bigint").alias("last_processed_ts"),
                                 F.current_timestamp().alias("updated_at"))


# ---------------------------------------------------------------------------
# Compaction onto a bucketed base.

def write_base(df: DataFrame, table: str, path: str, key: list[str], buckets: int) -> None:
    """A table of the latest rows, bucketed and sorted by ``key``: the base that deltas are merged onto.

    ``df`` is dealt by the key first, so every bucket is one file; written_at
    becomes created_at and updated_at where the rows have not got them yet.
    """
    rows = df.drop("batch_id", "_rn")
    if "written_at" in rows.columns:
        rows = rows.withColumn("created_at", F.col("written_at")).withColumnRenamed("written_at", "updated_at")
    (rows.repartition(buckets, *key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *key).sortBy(*key).saveAsTable(table))


def merge_base(spark, table: str, deltas: DataFrame, key: list[str], buckets: int) -> DataFrame:
    """The base with all later versions of its keys laid over it: latest row wins, created_at is the first write.

    Only the deltas are shuffled, into the base's buckets; the base is read
    bucket by bucket in its own order.
    """
    base = spark.table(table)
    news = latest_versions(deltas.repartition(buckets, *key), key).drop("batch_id")
    news = news.withColumnsRenamed({c: f"_n_{c}" for c in news.columns})
    on = [base[c] == news[f"_n_{c}"] for c in key]
    j = base.join(news.hint("merge"), on, "full_outer")
    new = F.col(f"_n_{key[0]}").isNotNull()
    cols = [F.least("created_at", "_n_created_at").alias(c) if c == "created_at" else
            F.when(new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in base.columns]
    return j.select(*cols)
