import hashlib
import math
import random

import duckdb
import numpy as np

from tidepool.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster int, planes string"


def brute(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = [hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    cents = [v for _, v in sorted(zip(name, [v for _, v in kept]))][:k]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds if cents else 0):
        own = [near(v)[1] for _, v in kept]
        new = []
        for n, c in enumerate(cents):
            members = [v for (_, v), o in zip(kept, own) if o == n]
            new.append([sum(x) // len(members) for x in zip(*members)] if members else c)
        cents = new
    got = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in got:
        inertia[c] = inertia.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted([(i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in got], key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in C.digests(*C.cluster(df, **kw)).collect()), key=str)


def vectors(n, scale=1.0, seed=3):
    r = random.Random(seed)
    return [(i, [r.uniform(-scale, scale) for _ in range(64)]) for i in range(n)]


ODD = [(900, None), (901, [1.0] * 63), (902, [1.0] * 63 + [None]), (903, [float("nan")] + [0.0] * 63), (904, [float("inf")] * 64)]


def test_nulls_repeats_and_short_vectors(spark):
    rows = vectors(60) + ODD + [(None, [0.5] * 64), (3, [0.25] * 64), (3, [0.25] * 64), (7, [0.0] * 64), (8, [-0.015] * 64)]
    assert run(spark, rows) == brute(rows)


def test_a_dense_group_with_a_third_of_all_rows(spark):
    rows = vectors(80) + [(1000 + i, [0.125] * 64) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    assert run(spark, vectors(5)) == brute(vectors(5))
    assert run(spark, ODD) == [] and run(spark, ODD[:0]) == []


def test_empty_clusters_stay(spark):
    same = [(i, [1.0] * 64) for i in range(30)]
    got = run(spark, same)
    assert got == brute(same) and {r[1] for r in got} == {0}


def test_large_magnitudes_are_exact(spark):
    rows = vectors(30, scale=3e5, seed=5)
    assert run(spark, rows) == brute(rows)
    rows = vectors(20, scale=5e6, seed=6)          # over 27 planes: Python integers in the tasks
    assert run(spark, rows) == brute(rows)
    huge = [(i, [1e300 * (i + 1)] * 64) for i in range(3)]
    assert [r[2] for r in run(spark, huge)] == [0, 0, 0]


def test_planes_round_trip_and_dot():
    r = np.random.default_rng(1)
    x = r.integers(-500, 500, (40, 64))
    planes = C.pack_planes(x, 10)
    assert planes.dtype == np.uint64 and [C.unpack(p.tobytes(), 10) for p in planes] == x.tolist()
    assert (C.dot(planes, planes[7]) == x @ x[7]).all()


def test_query_equals_sql(spark, sf):
    got = sorted(tuple(r) for r in C.op12_centroid_clusters(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert got == sorted(con.execute(C.OP12_SQL).fetchall())
