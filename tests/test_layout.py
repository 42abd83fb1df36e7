"""Stored layouts: a bucketed base under deltas, and clustered logs that are skipped."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidepool.operators import ingest as I
from tidepool.operators import upsert as U
from tidepool.sources import sinks as K

TOPIC = "0x" + "c4" * 32


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deltas_are_merged_onto_a_base_that_is_not_shuffled(spark, tmp_dir):
    rows = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    U.write_version(rows(0, 1000, "base"), f"{tmp_dir}/v", 1)
    U.write_base(spark.read.parquet(f"{tmp_dir}/v"), "base_of_test", f"{tmp_dir}/base", ["k"], 4)
    U.write_version(rows(990, 1005, "two"), f"{tmp_dir}/d", 2)
    U.write_version(rows(995, 1010, "three"), f"{tmp_dir}/d", 3)
    merged = U.merge_base(spark, "base_of_test", spark.read.parquet(f"{tmp_dir}/d"), ["k"], 4)
    got = {r.k: r for r in merged.collect()}
    assert len(got) == 1010
    assert [got[k].v for k in (0, 989, 990, 994, 995, 1004, 1009)] == ["base", "base", "two", "two", "three", "three", "three"]
    assert got[992].created_at < got[992].updated_at and got[1007].created_at == got[1007].updated_at
    plan = _plan(merged).split("== Initial Plan ==")[-1]
    # the only exchange stands above the deltas, below their window
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan
    before_base = plan[:plan.index("Bucketed: true")]
    assert "Exchange" not in before_base[before_base.index("SortMergeJoin"):]
    U.write_base(merged, "base_of_test_2", f"{tmp_dir}/base2", ["k"], 4)
    assert sorted((r.k, r.v) for r in spark.table("base_of_test_2").collect()) == sorted((k, r.v) for k, r in got.items())
    for t in ("base_of_test", "base_of_test_2"):
        spark.sql(f"DROP TABLE {t}")


def test_a_scan_of_clustered_logs_skips_row_groups(spark, tmp_dir):
    n, pools = 200_000, 50
    pool = F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.xxhash64(F.col("id") % pools))), 40, "0"))
    logs = spark.range(n).select(F.lit(56).cast("bigint").alias("chain_id"), (F.col("id") + 1).alias("block_number"), pool.alias("address"),
                                 F.lit(TOPIC).alias("topic0"), F.array(F.lit(TOPIC)).alias("topics"),
                                 F.sha2(F.col("id").cast("string"), 256).alias("data"))
    K.write_clustered(logs.repartition(4), f"{tmp_dir}/c", partitions=4, row_group_bytes=1 << 20)
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in glob.glob(f"{tmp_dir}/c/*.parquet")
              for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    one = logs.first().address
    at = groups[0].column(2).path_in_schema
    assert at == "address"
    held = [g for g in groups if g.column(2).statistics.min <= one <= g.column(2).statistics.max]
    assert len(groups) >= 8 and len(held) <= 2
    found = I.scan_logs(spark.read.parquet(f"{tmp_dir}/c"), 1, 0, [one], [TOPIC])
    assert len(found.collect()) == n // pools
    plan = found._jdf.queryExecution().executedPlan()
    read = [int(m._2().value()) for m in _metrics(spark, plan) if m._1() == "numOutputRows"]
    # what the Parquet reader handed on: the rows of those row groups, not of the table
    assert max(read) <= sum(g.num_rows for g in held) < n / 3


def _metrics(spark, plan):
    """(name, metric) pairs of the plan's file scan."""
    leaves = plan.collectLeaves()
    it = leaves.apply(0).metrics().iterator()
    out = []
    while it.hasNext():
        out.append(it.next())
    return out
