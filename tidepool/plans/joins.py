"""Plan helpers: broadcast only behind a size check, a boundary for filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Estimated bytes of a dimension that are shipped to every executor.
MAX_BROADCAST_BYTES = 32 << 20


def bounded_broadcast(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark ``dim`` for broadcast only if its estimated size is within ``max_bytes``.

    The estimate is the optimizer's (file sizes below filters and joins), so
    the check runs no job and does not compute the dimension twice.  Past the
    bound the plain DataFrame is returned: the planner shuffles both sides and
    AQE may still switch to a broadcast from measured sizes.
    """
    size = int(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(dim) if size <= max_bytes else dim


def settled(rows: DataFrame) -> DataFrame:
    """``rows`` behind a generator: a filter or projection on them reads the finished columns.

    Without it the optimizer moves a filter on a derived column below the
    projections that derive it and computes them anew for every use.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))
