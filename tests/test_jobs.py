"""End-to-end batch jobs: files in and out, counters, incremental state, replay, upserts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import addr_topic, meta_df, raw_log, typed
from tidepool import schemas as S
from tidepool.operators import aggregate as A
from tidepool.operators import upsert as U
from tidepool.operators.decode import SWAP
from tidepool.plans import jobs as P
from tidepool.sources import logs as L

POOL = "0x" + "11" * 20
T0, T1 = "0x" + "aa" * 20, "0x" + "bb" * 20


def _write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_raw_log_json_round_trip(spark, tmp_dir):
    rec = dict(chain_id=56, block_number=36000000, block_hash="0xabc123", tx_hash="0xdef456", tx_index=7,
               log_index=12, address=POOL, topics=["0xaaa", "0xbbb"], data="0xdeadbeef", removed=False,
               timestamp=1700000000, ingested_at="2024-01-01T00:00:00Z")
    _write_lines(f"{tmp_dir}/in/a.jsonl", [json.dumps(rec)])
    df = L.read_raw_logs_jsonl(spark, f"{tmp_dir}/in")
    out = f"{tmp_dir}/out"
    df.drop("_parse_error").write.json(out)
    back = L.read_raw_logs_jsonl(spark, out).drop("_parse_error").first().asDict()
    assert back == rec


def test_decode_job_outputs_and_counters(spark, tmp_dir):
    good = raw_log("Swap", [addr_topic(T0), addr_topic(T1)], [-1000, 2000, 3, 4, -15], POOL)
    cols = S.RAW_LOG.fieldNames()
    lines = [json.dumps(dict(zip(cols, good))), "not json", "",
             json.dumps(dict(zip(cols, raw_log("Swap", [], [], POOL, topic0="0x" + "ab" * 32))))]
    _write_lines(f"{tmp_dir}/raw/part.jsonl", lines)
    logs = L.read_raw_logs_jsonl(spark, f"{tmp_dir}/raw")
    meta = meta_df(spark, [(56, POOL, T0, T1, 2500, 60)])
    counters = P.decode_job(spark, logs, meta, f"{tmp_dir}/events", f"{tmp_dir}/errors")
    assert counters == {"total": 3, "decoded": 1, "skipped": 1, "failed": 1}
    ev = L.read_typed_events_jsonl(spark, f"{tmp_dir}/events").collect()
    assert len(ev) == 1 and ev[0].decoded.amount0 == "-1000" and ev[0].decoded_ok
    err = spark.read.json(f"{tmp_dir}/errors").collect()
    assert [e.error for e in err] == ["invalid json line"]


def _events(spark, rows):
    return typed(spark, [dict(r, token0=T0, token1=T1, address=POOL) for r in rows])


def test_aggregate_job_incremental_and_replay(spark, tmp_dir):
    tokens = spark.createDataFrame([(56, T0, 6, "A", "A"), (56, T1, 0, "B", "B")], S.TOKENS)
    bal = spark.createDataFrame([(56, T0, POOL, 1, "1000000"), (56, T1, POOL, 1, "5000")], S.BALANCES)
    first = [dict(timestamp=310, block=1, amount0="-1000", amount1="2000"),
             dict(timestamp=320, block=2, amount0="10", amount1="-20")]
    more = first + [dict(timestamp=330, block=3, amount0="1", amount1="-1"),
                    dict(timestamp=700, block=4, amount0="1", amount1="-1")]
    out = f"{tmp_dir}/agg"
    r1 = P.aggregate_job(spark, _events(spark, first), tokens, bal, out, 300)
    assert r1["state"] == 320
    r2 = P.aggregate_job(spark, _events(spark, more), tokens, bal, out, 300)
    assert r2["start_ts"] == 299 and r2["state"] == 700
    m = {r.window_start: r for r in P.read_metrics(spark, out).collect()}
    # the window cut by the first run is recomputed whole, not replaced by its tail
    assert m[300].swap_count == 3 and m[300].volume0 == "0.001011" and m[600].swap_count == 1
    assert m[300].tvl_method == "balance_of_block" and m[300].fee_method == "approx_from_feeTier"
    # replaying the same batch id rewrites the same version: same table
    before = sorted(map(tuple, P.read_metrics(spark, out).drop("batch_id").collect()))
    P.aggregate_job(spark, _events(spark, more), tokens, bal, out, 300, recompute_from=300,
                    batch_id=r2["batch_id"])
    after = sorted(map(tuple, P.read_metrics(spark, out).drop("batch_id").collect()))
    assert before == after
    pools = P.read_pools(spark, out).collect()
    assert len(pools) == 1 and pools[0].first_seen_block == 1
    check = U.check_table(P.read_metrics(spark, out), list(S.WINDOW_METRICS_KEY), list(S.WINDOW_METRICS_NOT_NULL))
    assert check.count() == 0
    assert P.load_state(spark, f"{out}/state", "aggregator:300") == 700


def test_state_never_moves_back(spark):
    row = U.state_row(spark, "aggregator:300", 5, previous=9).first()
    assert row.last_processed_ts == 9
    assert U.state_row(spark, "aggregator:300", 5, previous=9, force=True).first().last_processed_ts == 5


def test_merge_pools_least(spark):
    v = spark.createDataFrame([(56, POOL, T0, T1, 500, 10, 7, 1), (56, POOL, T0, T1, 500, 10, 9, 2)],
                              "chain_id long, pool_address string, token0 string, token1 string, fee long, "
                              "tick_spacing int, first_seen_block long, batch_id long")
    r = U.merge_pools(v).first()
    assert r.first_seen_block == 7 and r.batch_id == 2


def test_ingest_job_and_pushdown(spark, tmp_dir):
    from tidepool.operators import ingest as I
    pool = "0x" + "AB" * 20
    rows = [raw_log("Swap", [], [], pool, block=b) for b in (10, 11, 11, 12, 4000)]
    rows.append(raw_log("Swap", [], [], "0x" + "22" * 20, block=11))
    spark.createDataFrame(rows, S.RAW_LOG).write.parquet(f"{tmp_dir}/landing")
    blocks = spark.createDataFrame([(56, b, 1000 + b) for b in (10, 11, 12, 4000)], S.BLOCKS)
    top = P.ingest_job(spark, f"{tmp_dir}/landing", f"{tmp_dir}/logs", blocks, [pool], 11, 0,
                       state_path=f"{tmp_dir}/state")
    assert top == 4000
    out = spark.read.parquet(f"{tmp_dir}/logs")
    assert sorted(r.block_number for r in out.collect()) == [11, 12, 4000]      # deduplicated, range from 11
    assert {r.block_bucket for r in out.collect()} == {0, 2}
    assert out.first().address == pool.lower() and out.first().timestamp == 1000 + out.first().block_number
    # resume: nothing new after the checkpoint
    assert P.ingest_job(spark, f"{tmp_dir}/landing", f"{tmp_dir}/logs", blocks, [pool], 11, 0,
                        state_path=f"{tmp_dir}/state") == 4000
    # a run that starts over (its state was lost) adds nothing
    P.ingest_job(spark, f"{tmp_dir}/landing", f"{tmp_dir}/logs", blocks, [pool], 11, 0)
    P.ingest_job(spark, f"{tmp_dir}/landing", f"{tmp_dir}/logs", blocks, [pool], 10, 0)
    assert sorted(r.block_number for r in spark.read.parquet(f"{tmp_dir}/logs").collect()) == [10, 11, 12, 4000]
    # filters reach the Parquet scan, and whole buckets are pruned
    plan = I.scan_logs(spark.read.parquet(f"{tmp_dir}/logs"), 11, 20, [pool], [SWAP.topic0], P.DEFAULT_BLOCK_BATCH) \
        ._jdf.queryExecution().executedPlan().toString()
    pushed, parts = plan.split("PushedFilters")[1][:600], plan.split("PartitionFilters")[1][:200]
    assert all(c in pushed for c in ("block_number", "address", "topic0")) and "block_bucket" in parts


def test_missing_header_fails_the_job(spark, tmp_dir):
    pool = "0x" + "ab" * 20
    spark.createDataFrame([raw_log("Swap", [], [], pool, block=b) for b in (1, 2)], S.RAW_LOG).write.parquet(
        f"{tmp_dir}/landing")
    blocks = spark.createDataFrame([(56, 1, 1001)], S.BLOCKS)
    with pytest.raises(Exception, match="block timestamp lookup failed"):
        P.ingest_job(spark, f"{tmp_dir}/landing", f"{tmp_dir}/logs", blocks, [pool], 1, 0, state_path=f"{tmp_dir}/st")
    assert not os.path.exists(f"{tmp_dir}/logs") and not os.path.exists(f"{tmp_dir}/st")


def _typed_line(**change):
    line = dict(chain_id=56, block_number=1, block_hash="0xb", tx_hash="0x1", log_index=0, address=POOL,
                event_name="Swap", timestamp=310, decoded=dict(amount0="-1000", amount1="2000"),
                pool_meta=dict(token0=T0, token1=T1, fee=2500, tick_spacing=60), raw=dict(topic0="0x", data="0x"))
    line.update(change)
    return json.dumps({k: v for k, v in line.items() if v != "absent"})


def test_json_line_checks(spark, tmp_dir):
    good = _typed_line()
    soft = [_typed_line(decoded=dict(amount0=5, amount1="1")), _typed_line(decoded="text"), _typed_line(decoded="absent")]
    null = _typed_line(decoded=None, tx_hash="0x2")
    bad = [good + " x", good + good, _typed_line(block_number=-1), _typed_line(address=7), _typed_line(timestamp=1.5),
           _typed_line(log_index="0"), _typed_line(pool_meta=dict(token0=1)), "[]", "nope", _typed_line(timestamp=2 ** 63)]
    cased = good.replace("block_number", "Block_Number").replace("amount0", "Amount0")
    _write_lines(f"{tmp_dir}/ev/a.jsonl", [good, *soft, null, *bad, cased, "null", "  "])
    rows = L.read_typed_events_jsonl(spark, f"{tmp_dir}/ev", keep_bad=True).collect()
    assert len(rows) == 7 + len(bad)
    assert sum(r._parse_error is not None for r in rows) == len(bad)
    read = [r for r in rows if r._parse_error is None]
    assert [r.decoded_ok for r in read] == [True, False, False, False, True, True, False]
    assert read[5].block_number == 1 and read[0].decoded.amount0 == "-1000" and read[6].address == ""
    ev = L.read_typed_events_jsonl(spark, f"{tmp_dir}/ev", keep_bad=True)
    counts = {r.counter: r.value for r in A.run_counters(ev, 300).collect()}
    assert counts == {"total": len(rows), "skipped": 1, "failed": len(bad) + 3, "decoded": 1}
    w = A.window_aggregate(ev.where("_parse_error is null"), 300).first()
    assert (w.n_events, w.swap_count, w.n_failed) == (6, 3, 3)


def test_raw_log_line_checks(spark, tmp_dir):
    rec = dict(chain_id=56, block_number=1, address=POOL, topics=["0xa"], data="0x", removed=False)
    lines = [rec, dict(rec, topics=["0xa", 1]), dict(rec, removed="no"), dict(rec, data=5), dict(rec, tx_index=-2),
             dict(rec, topics=None)]
    _write_lines(f"{tmp_dir}/raw/a.jsonl", [json.dumps(x) for x in lines] + [json.dumps(rec) + ","])
    got = L.read_raw_logs_jsonl(spark, f"{tmp_dir}/raw").collect()
    assert [r._parse_error is None for r in got] == [True, False, False, False, False, True, False]
    assert got[0].block_hash == "" and got[0].topics == ["0xa"] and got[5].topics is None


def test_recompute_keeps_the_state_and_counts(spark, tmp_dir):
    tokens = spark.createDataFrame([(56, T0, 6, "A", "A")], S.TOKENS)
    bal = spark.createDataFrame([(56, T0, POOL, 1, "1")], S.BALANCES)
    late = _events(spark, [dict(timestamp=700, amount0="1", amount1="-1", tx="0x9")] * 2)
    early = _events(spark, [dict(timestamp=310, amount0="x", amount1="-1")])
    out = f"{tmp_dir}/agg"
    r = P.aggregate_job(spark, late, tokens, bal, out, 300)
    assert (r["state"], r["total"], r["failed"]) == (700, 2, 0)
    assert [m.swap_count for m in P.read_metrics(spark, out).collect()] == [2]      # two blocks, so two logs
    r = P.aggregate_job(spark, early, tokens, bal, out, 300, recompute_from=300)
    assert (r["state"], r["failed"]) == (700, 1)
    assert P.aggregate_job(spark, early, tokens, bal, out, 300, recompute_from=300, force_state=True)["state"] < 700
    same = _events(spark, [dict(timestamp=700, amount0="1", amount1="-1", tx="0x9", block=3)] * 2)
    P.aggregate_job(spark, same, tokens, bal, f"{tmp_dir}/b", 300)
    assert P.read_metrics(spark, f"{tmp_dir}/b").first().swap_count == 1


def test_contract_is_checked_before_writing(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (1, "a")], "k int, v string")
    assert {p.problem for p in U.check_table(df, ["k"], ["v"]).collect()} == {"null", "duplicate key"}
    with pytest.raises(ValueError, match="t: "):
        U.require_contract(df, ["k"], ["v"], "t")


def test_metrics_created_and_updated(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    U.write_version(df, f"{tmp_dir}/t", 1)
    U.write_version(df.withColumn("v", F.lit("b")), f"{tmp_dir}/t", 2)
    r = U.read_latest(spark, f"{tmp_dir}/t", ["k"]).first()
    assert r.v == "b" and r.created_at <= r.updated_at and r.batch_id == 2


def test_merge_job_reads_only_new_events(spark, tmp_dir, monkeypatch):
    tokens = spark.createDataFrame([(56, T0, 6, "A", "A"), (56, T1, 0, "B", "B")], S.TOKENS)
    bal = spark.createDataFrame([(56, T0, POOL, 1, "1000000"), (56, T1, POOL, 1, "5000")], S.BALANCES)
    rows = [dict(timestamp=301 + 40 * i, block=i + 1, amount0=str(1000 * (-1) ** i), amount1=str(-2000 * (-1) ** i)) for i in range(30)]
    rows.append(dict(timestamp=900, block=40, amount0="x", amount1="1"))
    whole, out = f"{tmp_dir}/whole", f"{tmp_dir}/out"
    P.aggregate_job(spark, _events(spark, rows), tokens, bal, whole, 300)
    want = sorted(map(tuple, P.read_metrics(spark, whole).collect()))
    first = P.merge_job(spark, _events(spark, rows[:10]), tokens, bal, out, 300)
    assert (first["run"], first["start_ts"], first["state"], first["total"]) == (1, 0, 661, 10)
    # a run that dies before its state is written is repeated under the same number
    write = U.write_version
    monkeypatch.setattr(U, "write_version", lambda df, path, n: write(df, path, n) if not path.endswith("state") else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        P.merge_job(spark, _events(spark, rows[:20]), tokens, bal, out, 300)
    monkeypatch.undo()
    second = P.merge_job(spark, _events(spark, rows[:20]), tokens, bal, out, 300)
    assert (second["run"], second["skipped"], second["state"]) == (2, 10, 1061)
    # only what lies behind the state counts, as the reference's rule says: the bad swap at 900 came too late
    assert P.compact_buffers(spark, f"{out}/buffers") == 2 and P.compact_buffers(spark, f"{out}/buffers") == 2
    third = P.merge_job(spark, _events(spark, rows), tokens, bal, out, 300)
    assert (third["run"], third["start_ts"], third["state"], third["failed"]) == (3, 1061, 1461, 0)
    assert sorted(map(tuple, P.read_metrics(spark, out).collect())) == want
    assert P.merge_job(spark, _events(spark, rows), tokens, bal, out, 300)["state"] == 1461
    assert sorted(map(tuple, P.read_pools(spark, out).collect())) == sorted(map(tuple, P.read_pools(spark, whole).collect()))
    base = spark.read.parquet(f"{out}/buffers/base=2")
    assert base.count() == base.select(*A.GROUP_KEYS).distinct().count()


def test_merged_windows_pay_their_own_tier(spark, tmp_dir):
    """A later run names another tier for a window that is already stored: its older swaps are counted again."""
    tokens = spark.createDataFrame([(56, T0, 0, "A", "A")], S.TOKENS)
    bal = spark.createDataFrame([(56, T0, POOL, 1, "1")], S.BALANCES)
    rows = [dict(timestamp=301, block=1, amount0="1000000", amount1="-1", fee=500), dict(timestamp=302, block=2, amount0="1000000", amount1="-1", fee=3000)]
    P.merge_job(spark, _events(spark, rows[:1]), tokens, bal, f"{tmp_dir}/o", 300)
    assert P.read_metrics(spark, f"{tmp_dir}/o").first().fee0 == "500"
    P.merge_job(spark, _events(spark, rows), tokens, bal, f"{tmp_dir}/o", 300)
    assert P.read_metrics(spark, f"{tmp_dir}/o").first().fee0 == "6000"


def test_filtered_lines_are_parsed_once(spark, tmp_dir):
    _write_lines(f"{tmp_dir}/ev/a.jsonl", [_typed_line(), _typed_line(block_number=-1)])
    ev = L.read_typed_events_jsonl(spark, f"{tmp_dir}/ev").where("timestamp > 0 and decoded.amount0 = '-1000'")
    assert ev._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert [r.block_number for r in ev.collect()] == [1]


def test_partitioned_append_writes_one_file_per_folder(spark, tmp_dir):
    import glob
    from tidepool.sources import sinks as K
    rows = spark.range(0, 4000, 1, 8).selectExpr("id", "56L AS chain_id", "id % 5 AS block_bucket")
    K.append_logs(rows, f"{tmp_dir}/t", partition_by=("chain_id", "block_bucket"))
    assert len(glob.glob(f"{tmp_dir}/t/*/*/*.parquet")) == 5 and spark.read.parquet(f"{tmp_dir}/t").count() == 4000
