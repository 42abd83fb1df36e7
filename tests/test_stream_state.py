"""Streams with state of their own: open windows, headers joined as a stream, late rows."""

from pyspark.sql import functions as F

from helpers import addr_topic, meta_df, raw_log
from tidepool import schemas as S
from tidepool.streaming import ingest as G
from tidepool.streaming import open_windows as W
from tidepool.streaming import stream as ST

SLIM = "chain_id long, block_number long, tx_hash string, log_index long, pool_address string, timestamp long"
A, B = "0x" + "11" * 20, "0x" + "22" * 20
T0, T1 = "0x" + "aa" * 20, "0x" + "bb" * 20


def _land(spark, path, rows):
    spark.createDataFrame(rows, SLIM).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SLIM).parquet(path)


def _row(pool, ts, n=0):
    return (56, ts, f"0x{n:x}", 0, pool, ts)


def _open(spark, work):
    pools = W.read_open_windows(spark, work)
    return ({r.pool_address: (r.lowest_open, r.latest, r.n_open) for r in pools.collect()}, W.resume_point(pools).first()[0])


def test_a_silent_pool_holds_the_resume_point(spark, tmp_dir):
    src, work = f"{tmp_dir}/in", f"{tmp_dir}/work"

    def run(rows):
        W.start_open_windows(spark, _land(spark, src, rows), work, 300, "20 minutes").awaitTermination()
        return _open(spark, work)
    assert run([_row(A, 99_950), _row(B, 99_960), _row(A, 99_970)]) == ({A: (99_900, 99_900, 1), B: (99_900, 99_900, 1)}, 99_899)
    # only A moves on: B's window is still open, and so is A's first
    assert run([_row(A, 100_700)]) == ({A: (99_900, 100_500, 2), B: (99_900, 99_900, 1)}, 99_899)
    # the watermark passes 100,200 - timers close the first windows of both pools
    assert run([_row(A, 101_500)]) == ({A: (100_500, 101_400, 2), B: (None, 99_900, 0)}, 100_499)


def test_metrics_stream_state_covers_pools_outside_the_batch(spark, tmp_dir):
    src, work = f"{tmp_dir}/landing", f"{tmp_dir}/work"
    meta = meta_df(spark, [(56, p, T0, T1, 2500, 60) for p in (A, B)])
    tokens = spark.createDataFrame([(56, T0, 0, "A", "A")], S.TOKENS)
    bal = spark.createDataFrame([(56, T0, A, 1, "10")], S.BALANCES)

    def swap(pool, block, ts):
        return raw_log("Swap", [addr_topic(T0), addr_topic(T1)], [-1000, 2000, 3, 4, 5], pool, block=block, ts=ts)
    for rows, want in (([swap(A, 1, 99_950), swap(B, 2, 99_960)], 99_899), ([swap(A, 3, 100_700)], 99_899), ([swap(A, 4, 105_000)], 104_999)):
        ST.append_files(spark.createDataFrame(rows, S.RAW_LOG), src)
        ST.run_once(spark, src, meta, tokens, bal, work, 300, lateness="1 hour")
        state = spark.read.parquet(f"{work}/state").orderBy(F.desc("batch_id")).first()
        assert state.last_processed_ts == want


def test_headers_join_as_a_stream(spark, tmp_dir):
    logs_dir, headers_dir, work = f"{tmp_dir}/logs", f"{tmp_dir}/headers", f"{tmp_dir}/work"

    def step(logs, headers, heartbeat=None):
        spark.createDataFrame([raw_log("Swap", [], [], A, block=b, log_index=i, ts=None) for b, i in logs], S.RAW_LOG).write.mode("append").json(logs_dir)
        spark.createDataFrame([(56, b, 1000 + b) for b in headers], S.BLOCKS).write.mode("append").json(headers_dir)
        if heartbeat:
            G.land_heartbeat(spark, logs_dir, headers_dir, 56, heartbeat)
        q = G.start_ingest(spark, logs_dir, headers_dir, work, 50, 56)
        q.awaitTermination()
        assert q.exception() is None
        return sorted((r.block_number, r.log_index, r.timestamp) for r in G.read_ingested(spark, work).collect())
    assert step([(10, 0), (10, 0), (11, 0), (12, 0)], [10]) == [(10, 0, 1010)]
    # the header of 11 comes late and is waited for; 12 has none yet
    assert step([(30, 1)], [11, 11, 30]) == [(10, 0, 1010), (11, 0, 1011), (30, 1, 1030)]
    done = [(10, 0, 1010), (11, 0, 1011), (12, 0, None), (30, 1, 1030)]
    assert step([(30, 2)], [], heartbeat=200) == sorted(done + [(30, 2, 1030)])
    # delivered again, within and behind the watermark: nothing is added
    assert step([(10, 0), (12, 0), (30, 1)], [10, 12, 30]) == sorted(done + [(30, 2, 1030)])
    missing = spark.read.parquet(f"{work}/missing")
    assert [(r.block_number, r.timestamp) for r in missing.collect()] == [(12, None)]


def test_late_rows_are_counted_exactly(spark, tmp_dir):
    src, work = f"{tmp_dir}/in", f"{tmp_dir}/work"
    dropped = G.DroppedRows("late-test")
    slices = [[_row(A, 10_000, 1), _row(B, 10_500, 2)], [_row(A, 9_900, 3), _row(A, 9_901, 4), _row(B, 12_000, 5), _row(A, 9_900, 3)],
              [_row(A, 11_400, 6), _row(A, 11_401, 7), _row(B, 1, 8)]]
    for rows in slices:
        events = _land(spark, src, rows)
        q = G.start_unique_events(spark, events, work, "10 minutes", "late-test")
        q.awaitTermination()
        for p in q.recentProgress:
            dropped.take(p)
        G.start_late_rows(spark, events, work, 600).awaitTermination()
    late = sorted(r.timestamp for r in spark.read.parquet(f"{work}/late_rows").collect())
    assert late == [1, 9_900, 9_900, 11_400] and dropped.total == len(late)
    assert sorted(r.timestamp for r in spark.read.parquet(f"{work}/unique").collect()) == [9_901, 10_000, 10_500, 11_401, 12_000]


def test_asof_answers_wait_for_the_watermark(spark, tmp_dir):
    from tidepool.streaming import asof_state as V
    src, work = f"{tmp_dir}/in", f"{tmp_dir}/work"

    def run(*rows):
        spark.createDataFrame([(56, "t", o, p, v, n) for o, p, v, n in rows], V.ROW).coalesce(1).write.mode("append").parquet(src)
        q = V.start_asof(spark, spark.readStream.schema(V.ROW).parquet(src), work, 100)
        q.awaitTermination()
        assert q.exception() is None
        return {r.name: (r.value, r.latest_value) for r in V.read_answers(spark, work).collect()}
    first = run((A, 10, "1", None), (A, 50, None, "a50"), (B, 5, None, "b5"), (A, 50, "3", None), (A, 50, "2", None))
    assert first == {}
    # a snapshot that comes late but in time is seen; questions at a snapshot's own position see it
    assert run((A, 30, "2", None), (A, 160, None, "a160"), (A, 40, None, "a40")) == {"a50": ("3", "3"), "b5": (None, None), "a40": ("2", "3")}
    assert run((B, 300, "9", None), (A, 170, "7", None), (A, 290, None, "a290"))["a160"] == ("3", "7")
    done = run((A, 900, "8", None))
    assert done["a290"] == ("7", "8") and done["b5"] == (None, "9") and len(done) == 5
