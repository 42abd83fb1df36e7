"""Session construction and shared-folder resolution."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC for unix-second windows, ANSI
# arithmetic (overflow raises instead of wrapping), AQE for runtime
# re-planning (broadcast switch on measured sizes, skew-join split,
# partition coalescing).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Generated methods above 8 KB are never JIT-compiled by HotSpot; past
    # this size Spark splits the stage into per-operator code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# SQL settings the queries depend on; all can be set on a running session.
RUNTIME_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session created elsewhere."""
    for key, value in RUNTIME_SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "tidepool",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and is read as is.  Only
    when it is unset and everything runs in this one process (unit tests, a
    laptop) do we pick a fresh local folder; a cluster without it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_subdir(spark: SparkSession, *parts: str) -> str:
    """A folder below the shared checkpoint root, e.g. for a stream's state."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, *parts) if "://" not in root else "/".join([root.rstrip("/"), *parts])


def cut_lineage(df):
    """Materialise ``df`` into the shared checkpoint folder and return it.

    Used where an expensive result (e.g. the aggregated windows) feeds several
    branches: each branch then reads the written rows instead of recomputing
    the aggregation over all events, and the rows survive executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
