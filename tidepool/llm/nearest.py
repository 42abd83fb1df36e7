"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and given one more component,
sqrt(1 - |x|^2), queries are scaled to length one, so that the largest inner
product is the smallest Euclidean distance.  Each of TABLES tables has HASHES
Gaussian projections cut into slots of WIDTH.  For a neighbour at distance r
the difference of a projection is normal with deviation r, which gives every
perturbation of the query's slots (up to MAX_CHANGES of them moved by one) a
probability of holding the neighbour.  The buckets of all tables are visited in
descending order of that estimate until at least one holds the neighbour with
probability TARGET.  Where all buckets of MAX_CHANGES moves do not reach it,
those of up to MORE_CHANGES are taken, and where these do not either, as at the
distances of high dimensions or unequal norms, the query is compared with all
rows.

r is a query's own.  A first round takes FIRST_SHARE of the K-th distances of a
bounded sample of queries, measured against all rows.  The K-th distance a
query found there is never below its true one, so a query for which it is
above the first round's r is searched again with it; the others have already
visited what their own distance calls for.

Work is dealt out as blocks of queries times shards of rows (by a hash of the
id), so a bucket, however full, is spread over all shards and no group grows
with the data; in a group the buckets of all tables are merged per query, the
candidates are scored exactly, and K + 1 go on.  Equal vectors are one
candidate, under a number of its own: the K + 1 smallest ids stand for it, which is
all that can be in a result.  Equal query vectors are one search.  Queries for which the buckets held fewer than K others are searched
once more against all rows, in the same blocks and shards.

Scores are sums of exact products in extended precision, rounded once.  Edge
cases: null or zero vectors, vectors with a null or non-finite component, rows
without an id and vectors whose length is not the most frequent one (the larger
on ties) take no part; of repeated ids each row is a candidate, and each row
that is a query has a ranking of its own, in which only that row is left out
(rows of one id and one vector are alike: one of them is); a table of at
most K + 1 vectors gives all others; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import bounded_sample, checkpointed, read_table, ship_by_value

ship_by_value(__name__)

K = 20
TABLES, HASHES, WIDTH, MAX_CHANGES, MORE_CHANGES = 24, 10, 2.3, 2, 3
TARGET = 0.95
SEED = 7
SAMPLE_QUERIES = 128            # queries whose K-th distance is measured to set the first round's r
FIRST_SHARE = 0.9               # share of them whose distance the first round covers
BLOCK_QUERIES = 512
SHARD_ROWS = 65_536

_HIT = "query_id long, rep long, lead long, score double"     # lead: the smallest id of rep's rows


class Moves:
    """Every perturbation of at most ``most`` slots."""

    def __init__(self, most: int, multiplier: np.ndarray):
        moves = [np.zeros(HASHES, dtype=np.int8)]
        for k in range(1, most + 1):
            for at in itertools.combinations(range(HASHES), k):
                for signs in itertools.product((-1, 1), repeat=k):
                    move = np.zeros(HASHES, dtype=np.int8)
                    move[list(at)] = signs
                    moves.append(move)
        moves = np.array(moves)
        self.down, self.up = (moves == -1).astype(float), (moves == 1).astype(float)
        self.codes = (moves * multiplier).sum(axis=1)

    def visits(self, log_stay: np.ndarray, log_down: np.ndarray, log_up: np.ndarray) -> list[np.ndarray] | None:
        """Per table the moves to make, of all tables the likeliest that reach TARGET; None if all do not."""
        log = log_down @ self.down.T + log_up @ self.up.T + log_stay.sum(axis=1, keepdims=True)
        order = np.argsort(-log, axis=None, kind="stable")
        table, mass = order // log.shape[1], np.exp(log.ravel()[order])

        def reached(n: int) -> bool:
            held = np.bincount(table[:n], mass[:n], TABLES)
            return np.log1p(-np.minimum(held, 1 - 1e-12)).sum() <= math.log(1 - TARGET)
        if not reached(len(order)):
            return None
        low, high = 1, len(order)
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if reached(mid) else (mid + 1, high)
        taken, table = order[:low] % log.shape[1], table[:low]
        return [taken[table == t] for t in range(TABLES)]


class Tables:
    """Projections and perturbations, the same in every task."""

    def __init__(self, dim: int):
        rng = np.random.default_rng(SEED)
        self.a = rng.standard_normal((dim, TABLES * HASHES))
        self.b = rng.uniform(0, WIDTH, TABLES * HASHES)
        self.multiplier = rng.integers(1, 2 ** 62, HASHES, dtype=np.int64) * 2 + 1
        self.moves = [Moves(k, self.multiplier) for k in (MAX_CHANGES, MORE_CHANGES)]

    def slots(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot numbers, places within the slots), each (rows, TABLES, HASHES)."""
        at = (x @ self.a + self.b) / WIDTH
        low = np.floor(at)
        return low.astype(np.int64).reshape(-1, TABLES, HASHES), (at - low).reshape(-1, TABLES, HASHES)

    def codes(self, slots: np.ndarray) -> np.ndarray:
        return (slots * self.multiplier).sum(axis=-1)

    def probes(self, slots: np.ndarray, place: np.ndarray, r: np.ndarray) -> list[list[np.ndarray] | None]:
        """Per query (with its ``r``) the bucket codes to visit in each table; None where buckets do not make TARGET."""
        s = np.maximum(r, 1e-9)[:, None, None] / WIDTH
        cdf = lambda z: 0.5 * (1 + _erf(z / math.sqrt(2)))
        stay = np.maximum(cdf((1 - place) / s) - cdf(-place / s), 1e-300)
        down = np.maximum(cdf(-place / s) - cdf(-(1 + place) / s), 1e-300)
        up = np.maximum(cdf((2 - place) / s) - cdf((1 - place) / s), 1e-300)
        base, out = self.codes(slots), []
        for q in range(len(slots)):
            logs = np.log(stay[q]), np.log(down[q] / stay[q]), np.log(up[q] / stay[q])
            for moves in self.moves:
                visit = moves.visits(*logs)
                if visit is not None:
                    break
            out.append(None if visit is None else [base[q, t] + moves.codes[visit[t]] for t in range(TABLES)])
        return out


def _erf(x: np.ndarray) -> np.ndarray:
    """Error function (Abramowitz and Stegun 7.1.26), accurate enough to order buckets."""
    t = 1 / (1 + 0.3275911 * np.abs(x))
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return np.sign(x) * (1 - poly * np.exp(-x * x))


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows scaled by the largest norm, with the component that makes their length one."""
    x = x / largest
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])


def _unit(q: np.ndarray) -> np.ndarray:
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    return np.hstack([q, np.zeros((len(q), 1))])


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (x.astype(np.longdouble) * q.astype(np.longdouble)).sum(axis=1).astype(np.float64)


def _screen(scores: np.ndarray, n: int, slack: float) -> np.ndarray:
    """Indices that can be among the n best when every score may be off by ``slack``."""
    if len(scores) <= n or not np.isfinite(scores).all():
        return np.arange(len(scores))
    floor = np.partition(scores, len(scores) - n)[len(scores) - n]
    return np.flatnonzero(scores >= floor - 2 * slack)


def _hits(q_ids, q, ids, leads, x, chosen) -> pa.Table:
    """K + 1 best of the chosen rows per query: screened in single precision, ranked by exact scores."""
    out_q, out_r, out_l, out_s = [], [], [], []
    x32, q32 = x.astype(np.float32), np.asarray(q, dtype=np.float32)
    # What rounding to single precision can move a score by, for the longest row.
    slack = 2.0 ** -21 * (x.shape[1] + 2) * math.sqrt(float((x * x).sum(axis=1).max(initial=0)))
    for i, at in enumerate(chosen):
        if len(at):
            at = at[_screen(x32[at] @ q32[i], K + 1, slack * float(np.linalg.norm(q[i])))]
            score = exact_scores(x[at], q[i])
            top = np.lexsort((ids[at], leads[at], -score))[:K + 1]
            out_q.append(np.full(len(top), q_ids[i])), out_r.append(ids[at[top]])
            out_l.append(leads[at[top]]), out_s.append(score[top])
    empty = [np.zeros(0)]
    return pa.table([pa.array(np.concatenate(c or empty).astype(k)) for c, k in
                     ((out_q, "i8"), (out_r, "i8"), (out_l, "i8"), (out_s, "f8"))], names=["query_id", "rep", "lead", "score"])


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def search_block(q_ids, q, ids, leads, x, largest: float, r: np.ndarray) -> pa.Table:
    """K + 1 best candidates of each query among the rows whose buckets it visits; all rows where
    its r is infinite or its buckets do not make TARGET."""
    tables = Tables(x.shape[1] + 1)
    codes = tables.codes(tables.slots(lifted(x, largest))[0])
    index = []
    for t in range(TABLES):
        order = np.argsort(codes[:, t], kind="stable")
        index.append((order, codes[order, t]))
    slots, place = tables.slots(_unit(q))

    def chosen():
        every = np.arange(len(ids))
        for lo in range(0, len(q), 64):
            at = np.arange(lo, min(lo + 64, len(q)))
            near = at[np.isfinite(r[at])]
            visits = dict(zip(near.tolist(), tables.probes(slots[near], place[near], r[near])))
            for i in at.tolist():
                if visits.get(i) is None:
                    yield every
                    continue
                seen = np.zeros(len(ids), dtype=bool)
                for (order, sorted_), wanted in zip(index, visits[i]):
                    a, b = np.searchsorted(sorted_, wanted, "left"), np.searchsorted(sorted_, wanted, "right")
                    some = b > a
                    a, n = a[some], (b - a)[some]
                    seen[order[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]] = True
                yield np.flatnonzero(seen)
    return _hits(q_ids, q, ids, leads, x, chosen())


def _searcher(largest: float):
    def run(key, rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _hits([], np.zeros((0, 1)), np.zeros(0), np.zeros(0), np.zeros((0, 1)), [])
        return search_block(queries.column("query_id").to_numpy(), _matrix(queries.column("v")),
                            rows.column("rep").to_numpy(), rows.column("lead").to_numpy(), _matrix(rows.column("v")), largest,
                            queries.column("r").to_numpy())
    return run


def _scanner(share):
    def run(batches):
        q_ids, q = share.value
        for batch in batches:
            x, ids, leads = _matrix(batch.column("v")), batch.column("rep").to_numpy(), batch.column("lead").to_numpy()
            every = np.arange(len(ids))
            yield from _hits(q_ids, q, ids, leads, x, (every for _ in q_ids)).to_batches()
    return run


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part: finite, not zero, of the table's length."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & (F.size("v") > 0) & fine & F.exists("v", lambda c: c != 0))
    dim = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (dim.n if dim else 0))


def nearest(vectors: DataFrame, query_filter, key: str = "vec_id", vector: str = "embedding",
            k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` <= K nearest found of every row for which ``query_filter`` holds.

    ``query_filter`` is a column condition on ``id``.  Every other row of the
    table is a candidate, however equal.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector).withColumn("h", F.xxhash64("v"))
    # Each different vector goes by the number of its first row; the ids of its rows may be those of others too.
    same = Window.partitionBy("h", "v").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumn("u", F.monotonically_increasing_id()).select(
        "h", "id", "v", F.row_number().over(same).alias("n"), F.first("u").over(same).alias("rep"),
        F.first("id").over(same).alias("lead"))
    members = checkpointed(ranked.filter(F.col("n") <= K + 1))
    reps = members.filter("n = 1").select("h", "rep", "lead", "v")
    asked = rows.filter(query_filter).groupBy("h", "v", F.col("id").alias("query_id")).agg(F.count(F.lit(1)).alias("copies"))
    asked = checkpointed(asked.join(reps.select("h", "v", F.col("rep").alias("q")), ["h", "v"]).select("query_id", "copies", "q"))
    queries = checkpointed(asked.select("q").distinct().join(reps, F.col("q") == F.col("rep")).select(
        F.col("q").alias("query_id"), "v"))
    reps = reps.drop("h")
    size = reps.agg(F.count(F.lit(1)).alias("n"), F.max(
        F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("s")).first()
    n_queries = queries.count()
    if not size.n or not n_queries:
        return _finish(members, asked, spark.createDataFrame([], _HIT), k)
    largest = math.sqrt(size.s)
    r = _kth_distance(reps, queries, largest)
    first = checkpointed(_search(reps, queries.withColumn("r", F.lit(r)), size.n, n_queries, largest))
    # A query's own r; fewer than K others (a query mostly finds itself) call for the exact search.
    found = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
    own = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("s") / (norm * largest)))
    again = checkpointed(queries.join(found, "query_id", "left").select(
        "query_id", "v", F.when(F.col("n") >= min(K + 1, size.n), own).otherwise(float("inf")).alias("r"))
        .filter(F.col("r") > r))
    n_again = again.count()
    hits = first if not n_again else _best(
        first.union(_search(reps, again, size.n, n_again, largest)).dropDuplicates(["query_id", "rep"]))
    return _finish(members, asked, hits, k)


def _best(hits: DataFrame) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "lead", "rep")
    return hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= K + 1).drop("n")


def _search(reps: DataFrame, queries: DataFrame, n_rows: int, n_queries: int, largest: float) -> DataFrame:
    """K + 1 best hits of ``queries`` (query_id, v, r), searched in blocks of queries times shards of rows."""
    shards, blocks = -(-n_rows // SHARD_ROWS), -(-n_queries // BLOCK_QUERIES)
    left = reps.withColumn("s", F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(shards))) \
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("b", F.pmod(F.xxhash64("query_id", F.lit(5)), F.lit(blocks)).cast("int")) \
        .withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    return _best(left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInArrow(_searcher(largest), _HIT))


def _kth_distance(reps: DataFrame, queries: DataFrame, largest: float) -> float:
    """Distance, in the lifted space, that covers the K-th neighbour of FIRST_SHARE of a bounded sample of queries."""
    some = bounded_sample(queries, SAMPLE_QUERIES, "query_id").collect()
    block = np.array([s.query_id for s in some]), np.array([s.v for s in some])
    hits = reps.mapInArrow(_scanner(reps.sparkSession.sparkContext.broadcast(block)), _HIT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "lead", "rep")
    last = (hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= K + 1)
            .groupBy("query_id").agg(F.min("score").alias("s")).collect())
    norm = dict(zip(block[0].tolist(), np.linalg.norm(block[1], axis=1).tolist()))
    d = [math.sqrt(max(0.0, 2 - 2 * x.s / (norm[x.query_id] * largest))) for x in last]
    return float(np.quantile(d, FIRST_SHARE)) if d else 1.0


def _finish(members: DataFrame, asked: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """Candidates spread to the rows that share their vector, each query's own row left out, ranked.

    The K + 1 best rows of a query vector are one short list, from which each
    of its query rows takes out its own.
    """
    rows = hits.join(members.select("rep", "id", "n"), "rep")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id", "lead", "rep", "n")
    top = rows.withColumn("o", F.row_number().over(best)).filter(F.col("o") <= K + 1)
    lists = top.groupBy(F.col("query_id").alias("q")).agg(F.sort_array(F.collect_list(F.struct("o", "rep", "id", "score"))).alias("found"))
    each = asked.join(lists, "q").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    own = F.array_position(F.transform("found", lambda x: (x["rep"] == F.col("q")) & (x["id"] == F.col("query_id"))), True)
    others = F.slice(F.filter("found", lambda x, i: i + 1 != own), 1, k)
    ranked = each.withColumn("own", own).select("query_id", F.posexplode(others).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))


def op4_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """Contract query: the 20 nearest of every row whose id is divisible by 20."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
