"""Range plans, list parsing, scan filters, dedup, block times, as-of joins, TVL."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import raw_df, raw_log
from tidepool.operators import enrich as N
from tidepool.operators import ingest as I
from tidepool.operators.asof import asof_join, asof_rows
from tidepool.operators.decode import SWAP


def test_split_range(spark):
    got = [tuple(r) for r in I.split_range(spark, 100, 105, 2).collect()]
    assert got == [(100, 101), (102, 103), (104, 105)]
    assert [tuple(r) for r in I.split_range(spark, 5, 5, 10).collect()] == [(5, 5)]
    with pytest.raises(ValueError):
        I.split_range(spark, 10, 9, 1)
    with pytest.raises(ValueError):
        I.split_range(spark, 1, 10, 0)


def test_parse_lists():
    assert I.parse_addresses([" 0xAbCdEf0123456789abcdef0123456789ABCDEF01 ", ""]) == \
        ["0xabcdef0123456789abcdef0123456789abcdef01"]
    with pytest.raises(ValueError):
        I.parse_addresses(["0x123"])
    with pytest.raises(ValueError):
        I.parse_topic0(["0x12"])
    assert I.parse_topic0([SWAP.topic0.upper().replace("0X", "0x")]) == [SWAP.topic0]


def test_scan_filters_with_empty_topics(spark):
    pool = "0x" + "11" * 20
    rows = [raw_log("Swap", [], [], pool, block=b) for b in (5, 6, 7)]
    rows.append((56, 6, "0xabc", "0xdef", 0, 9, pool, [], "0x", False, 1, ""))
    rows.append(raw_log("Swap", [], [], "0x" + "22" * 20, block=6))
    df = raw_df(spark, rows)
    assert I.scan_logs(df, 6, 7, [pool]).count() == 3
    assert I.scan_logs(df, 6, 0, [pool], [SWAP.topic0]).count() == 2
    assert I.resume_from(1, 10) == 11 and I.resume_from(20, 10) == 20


def test_dedup_first_wins(spark):
    df = spark.createDataFrame([(56, 1, "0xa", 0, 3, "x"), (56, 1, "0xa", 0, 1, "y"), (56, 2, "0xa", 0, 1, "z")],
                               "chain_id long, block_number long, tx_hash string, log_index long, o int, v string")
    got = sorted((r.block_number, r.v) for r in I.dedup_logs(df, [F.col("o")]).collect())
    assert got == [(1, "y"), (2, "z")]
    assert I.dedup_logs(df.drop("o", "v")).count() == 2


def test_block_time_missing(spark):
    logs = raw_df(spark, [raw_log("Swap", [], [], "0x" + "11" * 20, block=b) for b in (1, 2)])
    blocks = spark.createDataFrame([(56, 1, 111)], "chain_id long, block_number long, timestamp long")
    got = sorted((r.block_number, r.timestamp, r.block_time_missing)
                 for r in I.attach_block_time(logs, blocks).collect())
    assert got == [(1, 111, False), (2, None, True)]
    with pytest.raises(Exception, match="block timestamp lookup failed: 2"):
        I.attach_block_time(logs, blocks, require=True).collect()
    twice = blocks.union(blocks).union(spark.createDataFrame([(56, 1, 99)], blocks.schema))
    assert sorted(r.timestamp or 0 for r in I.attach_block_time(logs, twice).collect()) == [0, 99]


def test_dedup_survivor_is_fixed(spark):
    base = raw_log("Swap", [], [], "0x" + "11" * 20, block=1)
    removed = (*base[:9], True, *base[10:])
    other = (*base[:2], "0xaaa", *base[3:])
    for rows in ([base, removed, other], [other, removed, base], [removed, base, other]):
        got = I.dedup_logs(raw_df(spark, rows)).collect()
        assert [(r.removed, r.block_hash) for r in got] == [(False, "0xaaa")]


def test_unprefixed_addresses_and_line_feeds(spark):
    pool = "11" * 20
    df = raw_df(spark, [raw_log("Swap", [], [], pool, block=5), raw_log("Swap", [], [], "0x" + pool + "\n", block=5)])
    assert I.scan_logs(df, 5, 5, ["0x" + pool]).count() == 1
    with pytest.raises(ValueError):
        I.parse_addresses(["0x" + pool + "z"])


def test_asof_join_matches_brute_force(spark):
    rng = random.Random(3)
    right = [(k, p, f"v{k}-{p}") for k in range(3) for p in sorted(rng.sample(range(0, 500), 15))]
    left = [(i, rng.randrange(4), rng.randrange(0, 600)) for i in range(300)]
    r = spark.createDataFrame(right, "k int, p long, v string")
    l = spark.createDataFrame(left, "id int, k int, pos long")
    got = {x.id: (x.b_v, x.b_latest_v) for x in asof_join(l, r, ["k"], ["k"], "pos", "p", ["v"], "b_",
                                                           bucket_size=37, with_latest=True).collect()}
    for i, k, pos in left:
        cands = [(p, v) for kk, p, v in right if kk == k and p <= pos]
        allk = [(p, v) for kk, p, v in right if kk == k]
        want = max(cands)[1] if cands else None
        latest = max(allk)[1] if allk else None
        assert got[i] == (want, latest), (i, k, pos)


def test_asof_rows_matches_brute_force(spark):
    rng = random.Random(5)
    right = [(k, p, f"v{k}-{p}") for k in range(3) for p in sorted(rng.sample(range(0, 500), 15))]
    right += [(0, right[0][1], "w"), (None, 10, "null key"), (1, None, "null position")]
    left = [(i, rng.randrange(4), rng.randrange(0, 600)) for i in range(300)]
    left += [(300, None, 20), (301, 1, None), (302, None, None), (303, 1, 77), (303, 1, 77)]
    r = spark.createDataFrame(right, "k int, p long, v string")
    l = spark.createDataFrame(left, "id int, k int, pos long")
    asked = l.select("k", "pos").unionByName(l.select("k", (F.col("pos") + 1000).alias("pos")))
    got = asof_rows(l, r, ["k"], ["k"], "pos", "p", ["v"], "b_", asked, bucket_size=37, with_latest=True).collect()
    assert sorted(x.id for x in got) == sorted(i for i, _, _ in left)
    for x in got:
        own = [(p, v) for kk, p, v in right if kk is not None and p is not None and kk == x.k]
        before = [(p, v) for p, v in own if x.pos is not None and p <= x.pos]
        assert x.b_v == (max(before)[1] if before else None), x
        assert x.b_latest_v == (max(own)[1] if own and x.pos is not None else None), x


def test_tvl_is_picked_without_string_aggregates(spark, capsys):
    w = spark.createDataFrame([(56, "0x" + "11" * 20, 0, "0x" + "aa" * 20, "0x" + "aa" * 20, 100)],
                              "chain_id long, pool_address string, window_start long, token0 string, "
                              "token1 string, last_block long")
    bal = spark.createDataFrame([(56, "0x" + "AA" * 20, "0x" + "11" * 20, 50, "010")],
                                "chain_id long, token string, owner string, block_number long, balance string")
    found = N.attach_tvl(w, bal)
    assert tuple(found.select("tvl0_raw", "tvl1_raw", "tvl_method").first()) == ("10", "10", "balance_of_block")
    found.explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_tvl_mixed_falls_back_to_latest(spark):
    w = spark.createDataFrame([(56, "0x" + "11" * 20, 0, "0x" + "aa" * 20, "0x" + "bb" * 20, 100)],
                              "chain_id long, pool_address string, window_start long, token0 string, "
                              "token1 string, last_block long")
    bal = spark.createDataFrame([
        (56, "0x" + "aa" * 20, "0x" + "11" * 20, 50, "10"),
        (56, "0x" + "aa" * 20, "0x" + "11" * 20, 150, "11"),
        (56, "0x" + "bb" * 20, "0x" + "11" * 20, 150, "20"),
    ], "chain_id long, token string, owner string, block_number long, balance string")
    r = N.attach_tvl(w, bal).first()
    assert (r.tvl_method, r.tvl0_raw, r.tvl1_raw) == ("balance_of_latest", "11", "20")
    none = N.attach_tvl(w, bal.where(F.col("token") == "0x" + "aa" * 20)).first()
    assert (none.tvl_method, none.tvl0_raw) == ("unavailable", None)
