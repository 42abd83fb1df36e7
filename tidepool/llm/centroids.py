"""Centroid clustering by bit planes.

A vector of 64 integers is kept as bit planes: plane b holds bit b of all 64
components (two's complement) in one unsigned 64-bit word, the highest plane
being the sign.  The dot product of two vectors is then exact and made of
popcounts,

    x . c  =  sum over planes i, j of  weight(i) * weight(j) * popcount(x_i & c_j)

with weight 2^b, the sign plane's negative, and a squared distance is
x . x - 2 x . c + c . c.  ``pack`` turns a table of vectors into planes once;
each round reads the planes (8 bytes per plane instead of 256 per vector), finds
the nearest centroid of every vector, and sums bit counts per cluster inside
each task before one shuffle of at most ``k`` rows per task.  The driver holds
the ``k`` centroids and nothing else; they travel to the tasks as plain
integers.

The number of planes follows from the largest magnitude in the table.  Up to 27
planes all sums fit 64-bit words; beyond, tasks compute with Python integers, as
exactly and slower.

Edge cases: a vector that is null, has other than 64 components, or holds a null
or non-finite one takes no part and has no output row; repeated rows and ids are
vectors of their own; a null id is written ``null`` where its hash orders it; vectors of one
hash are ordered by their components; with fewer than ``k`` vectors there are
as many centroids; an empty table gives an empty result; other columns are
ignored.  Results are 64-bit: a distance or sum beyond that is given as
2^63 - 1.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import read_table, ship_by_value, written

ship_by_value(__name__)

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
FAST_PLANES = 27                # 64 * 2^27 * 2^27 and its sums over a batch stay below 2^63
LONG_MAX = 2 ** 63 - 1
BIG = "decimal(38,0)"


def plane_weights(n: int) -> list[int]:
    return [1 << b for b in range(n - 1)] + [-(1 << (n - 1))]


def pack_planes(values: np.ndarray, n: int) -> np.ndarray:
    """Integers (rows, 64) -> words (rows, n): component j is bit j of every word."""
    out = np.empty((len(values), n), dtype=np.uint64)
    for b in range(n):
        bits = ((values >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def unpack_bits(plane: np.ndarray) -> np.ndarray:
    """One word per row -> (rows, 64) of 0 and 1."""
    return np.unpackbits(np.ascontiguousarray(plane, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact dot products of plane rows ``x`` with one vector's planes ``y`` (or with as many rows)."""
    wx, wy = plane_weights(x.shape[1]), plane_weights(y.shape[-1])
    exact = np.int64 if len(wx) <= FAST_PLANES and len(wy) <= FAST_PLANES else object
    total = np.zeros(len(x), dtype=exact)
    for i, a in enumerate(wx):
        for j, b in enumerate(wy):
            total += np.bitwise_count(x[:, i] & y[..., j]).astype(exact) * (a * b)
    return total


def nearest(x: np.ndarray, centroids: list[list[int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each row's nearest centroid; ties go to the smaller number."""
    own, best, which = dot(x, x), None, np.zeros(len(x), dtype=np.int32)
    kind = np.int64 if n <= FAST_PLANES else object
    for k, c in enumerate(centroids):
        y = pack_planes(np.array([c], dtype=kind), n)[0]
        d = own - 2 * dot(x, y) + sum(v * v for v in c)
        if best is None:
            best = d
        else:
            closer = np.asarray(d < best, dtype=bool)
            best, which = np.where(closer, d, best), np.where(closer, k, which)
    return which, best


def _words(batch, n: int) -> np.ndarray:
    raw = pa.chunked_array([batch.column("planes")]).combine_chunks()
    return np.frombuffer(b"".join(raw.to_pylist()), dtype="<u8").reshape(-1, n)


def kept_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): usable vectors as integers floor(64 * x), each a decimal."""
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    usable = (F.size("x") == DIMENSIONS) & F.forall(
        "x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return rows.select(F.col(vec_id).alias("vec_id"), x.alias("x")).where(F.coalesce(usable, F.lit(False)))


def _integers(x: list[float]) -> list[int]:
    """floor(64 * x) exactly: the product with a power of two only overflows, so it is taken in integers there."""
    import math
    return [math.floor(SCALE * e) if abs(e) < 1e300 else int(e) * SCALE for e in x]


def _pack(n: int):
    def run(batches):
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            if n <= FAST_PLANES:
                ints = np.floor(flat * SCALE).astype(np.int64)
            else:
                ints = np.array([_integers(r) for r in flat.tolist()], dtype=object).reshape(-1, DIMENSIONS)
            planes = pack_planes(ints, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([r.tobytes() for r in planes], pa.binary())], names=["vec_id", "planes"])
    return run


def pack(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, planes binary) of the usable vectors, written to the shared folder, and the number of planes."""
    kept = kept_vectors(rows, vec_id, vector)
    top = kept.agg(F.max(F.array_max(F.transform("x", lambda e: F.abs(e)))).alias("m")).first().m
    if top is None:
        n = 1
    else:
        n = (abs(_integers([top])[0]) + 1).bit_length() + 1
    kind = kept.schema["vec_id"].dataType.simpleString()
    return written(kept.mapInArrow(_pack(n), f"vec_id {kind}, planes binary"), "bit-planes"), n


def unpack(planes: bytes, n: int) -> list[int]:
    bits = [unpack_bits(np.frombuffer(planes, "<u8")[b:b + 1])[0] for b in range(n)]
    return [sum(w * int(bits[b][j]) for b, w in enumerate(plane_weights(n))) for j in range(DIMENSIONS)]


def first_centroids(packed: DataFrame, n: int, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The k vectors of smallest SHA-256 of ``seed:vec_id``, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)

    # Equal hashes (repeated ids) are ordered by components: the sort key is one text of padded numbers.
    digits = len(str(1 << n)) + 1

    def order(batches):
        for batch in batches:
            text = ["".join(f"{v + (1 << n):0{digits}d}" for v in unpack(p, n)) for p in batch.column("planes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("planes"), pa.array(text)],
                                             names=["h", "planes", "o"])
    hashed = packed.select(name.alias("h"), "planes")
    # Only rows up to the k-th hash are unpacked: the cut is a threshold on the hash, ties included.
    edge = hashed.select("h").orderBy("h").limit(k).agg(F.max("h").alias("h")).first().h
    if edge is None:
        return []
    few = hashed.where(F.col("h") <= edge).mapInArrow(order, "h string, planes binary, o string")
    return [unpack(bytes(r.planes), n) for r in few.orderBy("h", "o").limit(k).collect()]


def _partial_sums(centroids: list[list[int]], n: int):
    def run(batches):
        k = len(centroids)
        sums, counts = [[0] * DIMENSIONS for _ in range(k)], [0] * k
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _words(batch, n)
            which, _ = nearest(x, centroids, n)
            for c in np.unique(which).tolist():
                own = x[which == c]
                counts[c] += len(own)
                for b, w in enumerate(plane_weights(n)):
                    ones = unpack_bits(own[:, b]).sum(axis=0, dtype=np.int64).tolist()
                    sums[c] = [s + w * o for s, o in zip(sums[c], ones)]
        yield from _sum_rows(sums, counts)
    return run


def _sum_rows(sums, counts):
    rows = [{"cluster": c, "n": counts[c], "j": j, "s": str(sums[c][j])}
            for c in range(len(counts)) if counts[c] for j in range(DIMENSIONS)]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("j", pa.int32()),
                                                          ("s", pa.string())]))


def move(packed: DataFrame, centroids: list[list[int]], n: int) -> list[list[int]]:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    part = packed.mapInArrow(_partial_sums(centroids, n), "cluster int, n long, j int, s string")
    if n <= FAST_PLANES:
        got = part.groupBy("cluster", "j").agg(F.sum(F.col("s").cast(BIG)).alias("s"), F.sum("n").alias("n")).collect()
        total = {(r.cluster, r.j): (int(r.s), r.n) for r in got}
    else:
        # Sums of any length: added limb by limb, 18 digits each, with the sign.
        digits = F.regexp_replace("s", "-", "")
        limbs = part.select("cluster", "j", "n", F.when(F.col("s").startswith("-"), -1).otherwise(1).alias("sign"), digits.alias("d"))
        limbs = limbs.select("cluster", "j", "n", "sign", F.posexplode(F.expr(
            "transform(sequence(1, CAST(ceil(length(d) / 18) AS INT)), i -> CAST(substr(lpad(d, CAST(ceil(length(d) / 18) AS INT) * 18, '0'), "
            "(CAST(ceil(length(d) / 18) AS INT) - i) * 18 + 1, 18) AS BIGINT))")).alias("p", "v"))
        got = limbs.groupBy("cluster", "j", "p").agg(F.sum((F.col("v") * F.col("sign")).cast(BIG)).alias("s"),
                                                     F.sum("n").alias("n")).collect()
        total = {}
        for r in got:
            s, m = total.get((r.cluster, r.j), (0, 0))
            total[r.cluster, r.j] = (s + int(r.s) * 10 ** (18 * r.p), max(m, r.n))
    out = []
    for k, c in enumerate(centroids):
        out.append([total[k, j][0] // total[k, j][1] for j in range(DIMENSIONS)] if (k, 0) in total else c)
    return out


def _assign(centroids: list[list[int]], n: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            which, d = nearest(_words(batch, n), centroids, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(which, pa.int32()),
                 pa.array([min(int(v), LONG_MAX) for v in d.tolist()], pa.int64())],
                names=["vec_id", "cluster", "distance"])
    return run


def cluster(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, vec_id: str = "vec_id",
            vector: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every usable vector, and the final centroids."""
    packed, n = pack(rows, vec_id, vector)
    centroids = first_centroids(packed, n, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = move(packed, centroids, n)
    kind = packed.schema["vec_id"].dataType.simpleString()
    assigned = packed.mapInArrow(_assign(centroids, n), f"vec_id {kind}, cluster int, distance long") if centroids else \
        packed.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
    return assigned, centroids


def digests(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The assignment with its inertia per cluster and in all, and a digest of each row's centroid."""
    assigned = written(assigned, "clusters")
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast(BIG)).alias("s")).collect()}
    every = min(sum(sums.values()), LONG_MAX)

    def by_cluster(values, kind):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    inertia = [min(sums.get(c, 0), LONG_MAX) for c in range(len(names))]
    return assigned.select("vec_id", "cluster", "distance", by_cluster(inertia, "long").alias("cluster_inertia"),
                           F.lit(every).cast("long").alias("inertia"), by_cluster(names, "string").alias("centroid_sha256"))


def op12_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    """Contract query: 16 clusters of all embeddings after 3 rounds."""
    return digests(*cluster(read_table(spark, sf_dir, "embeddings")))


def _sql() -> str:
    rounds, parts = ROUNDS, []
    near = """
a{r} AS (SELECT row, vec_id, v, cluster, distance FROM (
  SELECT k.row, k.vec_id, k.v, c.cluster,
         list_sum(list_transform(range(1, 65), lambda j: (k.v[j] - c.v[j]) * (k.v[j] - c.v[j])))::BIGINT AS distance,
         row_number() OVER (PARTITION BY k.row ORDER BY distance, c.cluster) AS n
  FROM kept k, c{r} c) WHERE n = 1)"""
    step = """
s{r} AS (SELECT cluster, j, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS j FROM a{p}) GROUP BY ALL),
c{r} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{p} c LEFT JOIN (
  SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM s{r} GROUP BY cluster) m USING (cluster))"""
    for r in range(rounds + 1):
        if r:
            parts.append(step.format(r=r, p=r - 1))
        parts.append(near.format(r=r))
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS cluster, v FROM (
  SELECT sha256('{SEED}:' || coalesce(vec_id::VARCHAR, 'null')) AS h, v FROM kept ORDER BY h, v LIMIT {CLUSTERS})),
{",".join(parts)}
SELECT a.vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)
"""


OP12_SQL = _sql()
