import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import nearest as N
from tidepool.llm import sharding as S

NAN, INF = float("nan"), float("inf")


def brute(rows, k):
    dims = [len(v) for _, v in rows if v and None not in v]
    fine = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(np.array(v, dtype=float)).all() and np.any(np.array(v, dtype=float))]
    dim = max(set(dims), key=lambda d: (sum(len(v) == d for _, v in fine), d), default=0)
    fine = [(i, v) for i, v in fine if len(v) == dim]
    out = {}
    for n, (q, x) in enumerate(fine):
        if q % 20 == 0:
            out[q] = sorted(((-float(np.dot(x, y)), i) for i, y in fine if i != q))[:k]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12)


def test_odd_vectors_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [NAN, 1.0]),
            (6, [INF, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [-1.0, 0.0]), (9, [2.0, 0.0]), (None, [1.0, 1.0]), (40, None)]
    rows += [(100 + i, [0.25, 0.5]) for i in range(60)]      # one vector many times
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, score double")
    same(result(N.nearest(df, F.col("id") % 20 == 0)), brute(rows, N.K))
    few = df.filter("vec_id < 30")
    same(result(N.nearest(few, F.col("id") % 20 == 0)), brute([r for r in rows if r[0] is not None and r[0] < 30], N.K))
    assert N.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_recall_and_exact_scores(spark, sf, monkeypatch):
    monkeypatch.setattr(N, "SHARD_ROWS", 200)
    monkeypatch.setattr(N, "BLOCK_QUERIES", 10)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = result(N.op4_nearest_neighbours(spark, sf)), brute(rows, N.K)
    assert got.keys() == want.keys() and all(len(v) == N.K for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * N.K * len(want)
    x = {i: np.array(v, dtype=float) for i, v in rows}
    for q, found in got.items():
        assert found == sorted(found)
        assert all(abs(-s - float(np.dot(x[q], x[i]))) < 1e-12 for s, i in found)


def test_recall_of_sparse_queries_beside_a_dense_group(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_QUERIES", 100)
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    dense = unit(unit(rng.standard_normal((1, 32))) + 0.09 * rng.standard_normal((2800, 32)))
    x = np.vstack([dense, unit(rng.standard_normal((1200, 32)))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got, want = result(N.nearest(df, F.col("id") % 20 == 0)), brute(rows, N.K)
    assert got.keys() == want.keys() and all(len(v) == N.K for v in got.values())
    recall = {q: len({i for _, i in got[q]} & {i for _, i in want[q]}) / N.K for q in want}
    assert np.mean([recall[q] for q in want if q < 2800]) >= 0.93
    assert np.mean([recall[q] for q in want if q >= 2800]) >= 0.93


@pytest.mark.parametrize("r", [0.6, 1.2, 1.36, 1.41])
def test_visits_make_the_target_at_every_distance(r):
    tables, rng = N.Tables(64), np.random.default_rng(5)
    q = rng.standard_normal((20, 64))
    slots, place = tables.slots(q)
    met = []
    for i, visit in enumerate(tables.probes(slots, place, np.full(20, r))):
        away = rng.standard_normal((300, 64))
        away *= r / np.linalg.norm(away, axis=1, keepdims=True)
        codes = tables.codes(tables.slots(q[i] + away)[0])
        met.append(1.0 if visit is None else np.mean(
            np.any([np.isin(codes[:, t], visit[t]) for t in range(N.TABLES)], axis=0)))
    assert np.mean(met) >= N.TARGET - 0.015


def test_out_of_reach_queries_see_all_rows(spark, monkeypatch):
    monkeypatch.setattr(N, "MORE_CHANGES", 0)
    monkeypatch.setattr(N, "MAX_CHANGES", 0)
    x = np.random.default_rng(6).standard_normal((600, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    same(result(N.nearest(df, F.col("id") % 20 == 0)), brute(rows, N.K))


def check_shards(rows, pairs, shards, slack):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    total = sum(r.size for r in rows)
    for s in range(shards):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= slack
    assert {r.shard for r in rows} <= set(range(shards))


def test_sharding_query(spark, sf, sf_texts):
    rows = S.op10_sharding(spark, sf).collect()
    check_shards(rows, sf_texts, 8, 2 * max(len(t.encode()) + 1 for _, t in sf_texts))
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


@pytest.fixture(scope="module")
def skewed():
    return ([(i, "same text in a third of the rows") for i in range(400)] + [(1000 + i, f"{i} " * (i % 40)) for i in range(800)]
            + [(5, "same text in a third of the rows")] * 2 + [(None, "a"), (None, None), (9999, ""), (9998, "é" * 3000)])


def test_hot_texts_are_cut_by_id(docs_of, skewed, monkeypatch):
    monkeypatch.setattr(S, "RANGE_ROWS", 20)
    rows = S.assign(docs_of(skewed)).collect()
    check_shards(rows, skewed, 8, 6001 * 2)
    assert len({r.shard for r in rows if r.size == 33}) > 1
    cuts = S.splitters(S.slim_rows(docs_of(skewed)))
    assert cuts == sorted(set(cuts)) and len(cuts) >= 63
    assert S.assign(docs_of(skewed).limit(0)).count() == 0


def test_whole_records_are_written(spark, docs_of, skewed, tmp_path):
    docs = docs_of(skewed)
    rows = S.write_shards(docs, str(tmp_path / "out"), files_per_shard=2).collect()
    back = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "text", "shard").collect()
    key = lambda i, size, crc, s: (str(i), size, crc, s)
    assert sorted(key(r.doc_id, r.size, r.text_crc32, r.shard) for r in rows) == sorted(
        key(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), r.shard) for r in back)
    own = docs.withColumn("shard", F.lit("mine"))
    S.write_shards(own, str(tmp_path / "own"), files_per_shard=2)
    again = spark.read.parquet(str(tmp_path / "own"))
    assert {r.shard_in for r in again.collect()} == {"mine"} and again.count() == own.count()


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    """Repeated ids with different vectors, as candidates and as queries; repeated rows; a query twice."""
    rng = np.random.default_rng(8)
    rows = [(int(i), rng.standard_normal(8).tolist()) for i in rng.integers(0, 60, 150)]
    rows += [(5, rows[0][1]), (20, rows[1][1]), rows[2], rows[2], (40, rows[3][1]), (40, rows[3][1]), (40, rows[4][1])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    found = {}
    for r in N.nearest(df, F.col("id") % 20 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    want = {}
    for at, (q, x) in enumerate(rows):
        if q % 20 == 0:
            others = sorted((-round(float(np.dot(x, y)), 9), i) for j, (i, y) in enumerate(rows) if j != at)[:N.K]
            want.setdefault(q, []).extend((k + 1, i, -s) for k, (s, i) in enumerate(others))
    assert found.keys() == want.keys()
    assert all(sorted(found[q]) == sorted(want[q]) for q in want)
