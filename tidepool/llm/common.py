"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import checkpoint_subdir, cut_lineage

# Rows and bytes of one Arrow batch handed to Python: long texts make small batches.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20


def ship_by_value(name: str) -> None:
    """Pickle module ``name`` with the functions sent to workers, so executors need no install."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship_by_value(__name__)


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session by rows and bytes (long texts)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again.

    Cuts lineage; the rows are kept compressed and survive a lost executor.
    """
    spark = df.sparkSession
    path = checkpoint_subdir(spark, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    return cut_lineage(df)


def hash_share(df: DataFrame, n: float, *keys: str) -> DataFrame:
    """About ``n`` rows by the hash of ``keys``, dropped where they are read: the same rows whatever the partitioning."""
    total = df.count()
    u = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(17)), 11) / float(1 << 53)
    return df.filter(u < n / total) if total > n else df


def bounded_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most ``n`` rows by the hash of ``keys``, for small rows: the last cut is made in one task.

    One and a half times the wanted share is read, so that cut sees a bounded
    number of rows however many partitions there are.
    """
    return hash_share(df, 1.5 * n, *keys).orderBy(F.xxhash64(*keys, F.lit(17)), *keys).limit(n)


def shared_uri(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark itself would use for it (``fs.defaultFS`` if it names none)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def shared_files(uri: str):
    """(pyarrow file system, folder) of a qualified uri, on driver and executors alike."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def publish(files, source: str, target: str) -> None:
    """Rename a finished file into place, over one that an earlier attempt of the task has left."""
    from pyarrow import fs
    if files.get_file_info(target).type != fs.FileType.NotFound:
        files.delete_file(target)
    files.move(source, target)


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shipped(spark: SparkSession, value):
    """``value`` broadcast as bytes that hold its classes by value, so workers need no install; see ``opened``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(share):
    """A value from ``shipped``: read once per worker, and let go with the broadcast itself."""
    if not hasattr(share, "_opened"):
        share._opened = cloudpickle.loads(share.value)
    return share._opened


def worker_state(key: str, make):
    """A value kept for the life of a Python worker, whichever task asks for it.

    Functions shipped by value get fresh module globals in every task, so
    expensive read-only state (a tokenizer, a word cache) hangs on a module of
    its own in ``sys.modules``.
    """
    holder = sys.modules.setdefault("_tidepool_worker_state", types.ModuleType("_tidepool_worker_state"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)
