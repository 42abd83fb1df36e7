"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Fingerprint: A-Z lower-cased, words split at ASCII white space, every run of
``SHINGLE`` words joined by a space is hashed with XXH64 (UTF-8, seed 42); a
bit is set when it is set in over half the hashes (repeats count).  A text of
fewer words has one shingle, a text without words the fingerprint zero.

Self-join: distinct fingerprints are the leaves of a binary trie.  Node pairs
are traversed together from the root: a pair descends to its child pairs,
adding one error where the branch bits differ, and is pruned once the errors
exceed the budget; pairs of single leaves finish on the rest of their bits at
once.  The top of the trie is cut into subtrees of at most ``MAX_LEAVES``
fingerprints from a histogram of prefixes (bounded, whatever the input), so a
dense region of the fingerprint space is split by deeper prefixes.  Each
subtree is packed into one row, and every pair of subtrees within the budget
is one group of the join.  A group returns a spanning forest of its links,
never all pairs.

Exact copies share a fingerprint and are one leaf, so copies cost nothing in
the join.  Components are taken over leaves named by their smallest document.

Edge cases: null text is a text without words; repeated rows of a document
count as copies; null ids are fingerprinted but belong to no component (null);
an empty table gives an empty result; other columns, whatever their names, are
ignored, and kept by ``keep_one_each``.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import checkpointed, read_table, ship_by_value
from tidepool.llm.components import connected_components

ship_by_value(__name__)

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BITS = 64
HISTOGRAM_BITS = 14             # prefixes counted to cut the trie: at most 2^14 rows reach the driver
MAX_LEAVES = 32_768             # fingerprints of a subtree before it is cut deeper; more on large inputs, see _subtrees
PAIRS_AT_ONCE = 1 << 20         # node pairs held while traversing
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    xxh, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, n, HASHES_AT_ONCE):
        part = words[lo:min(n, lo + HASHES_AT_ONCE) + shingle - 1]
        if shingle == 3 and len(words) >= 3:
            h = [xxh(b"%b %b %b" % t, SEED) for t in zip(part, part[1:], part[2:])]
        else:
            h = [xxh(b" ".join(part[i:i + shingle]), SEED) for i in range(min(n - lo, HASHES_AT_ONCE))]
        bits = np.unpackbits(np.array(h, dtype=">u8").view(np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8)).view(">u8")[0])


def _fingerprinter(shingle: int):
    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64), pa.int64())],
                                             names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _fingerprinter(shingle), "doc_id long, fp long")


# --- the trie join ---------------------------------------------------------------------------

def _prefix(col, bits: int):
    return F.shiftrightunsigned(col, BITS - bits) if bits else F.lit(0).cast("long")


def _cut(counts: dict[int, int], depth: int, root: tuple[int, int], limit: int) -> list[tuple[int, int, int]]:
    """Subtrees (bits, prefix, size) under ``root``, each of at most ``limit`` fingerprints or ``depth`` bits deep."""
    level, sums = {depth: counts}, counts
    for b in range(depth - 1, root[0] - 1, -1):
        up: dict[int, int] = {}
        for p, n in sums.items():
            up[p >> 1] = up.get(p >> 1, 0) + n
        level[b] = sums = up
    nodes, stack = [], [root]
    while stack:
        b, p = stack.pop()
        n = level[b].get(p, 0)
        if n and (n <= limit or b == depth):
            nodes.append((b, p, n))
        elif n:
            stack += [(b + 1, 2 * p), (b + 1, 2 * p + 1)]
    return nodes


def _subtrees(leaves: DataFrame) -> list[tuple[int, int]]:
    """The cut of the trie: one histogram over all leaves, then deeper ones below prefixes that hold too many."""
    def histogram(df, depth):
        return {r.p: r.n for r in df.groupBy(_prefix(F.col("fp"), depth).alias("p"))
                .agg(F.count(F.lit(1)).alias("n")).collect()}
    depth = HISTOGRAM_BITS
    counts = histogram(leaves, depth)
    limit = max(MAX_LEAVES, sum(counts.values()) >> 13)
    nodes, done = _cut(counts, depth, (0, 0), limit), []
    while True:
        hot = [p for b, p, n in nodes if b == depth and n > limit]
        done += [(b, p) for b, p, n in nodes if not (b == depth and n > limit)]
        if not hot:
            return sorted(done, key=lambda x: x[1] << (BITS - x[0]))
        deeper = min(depth + 8, BITS)
        counts, nodes = histogram(leaves.filter(_prefix(F.col("fp"), depth).isin(hot)), deeper), []
        for p in hot:
            own = {q: n for q, n in counts.items() if q >> (deeper - depth) == p}
            nodes += _cut(own, deeper, (depth, p), limit)
        depth = deeper


def _node_pairs(nodes: list[tuple[int, int]], max_bits: int) -> list[tuple[int, int, int]]:
    """Pairs i <= j of subtrees whose common prefixes differ in e <= ``max_bits`` bits, as (i, j, e)."""
    at = {n: i for i, n in enumerate(nodes)}
    inner = {(b, p >> (d - b)) for d, p in nodes for b in range(d)}
    pairs, stack = {}, [((0, 0), (0, 0), 0)]
    kids = lambda x: [k for k in ((x[0] + 1, 2 * x[1]), (x[0] + 1, 2 * x[1] + 1))
                      if k in inner or k in at] if x in inner else [x]
    while stack:
        u, v, e = stack.pop()
        if u in at and v in at:
            pairs[min(at[u], at[v]), max(at[u], at[v])] = e
            continue
        for x in kids(u) if u in inner or v in inner else []:
            for y in kids(v):
                if u == v and x > y:
                    continue
                b = min(x[0], y[0])
                e = ((x[1] >> (x[0] - b)) ^ (y[1] >> (y[0] - b))).bit_count()
                if e <= max_bits:
                    stack.append((x, y, e))
    return sorted((i, j, e) for (i, j), e in pairs.items())


def _levels(fp: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per trie level from ``top`` bits: for each node the index of its 0-child and 1-child, or -1."""
    out, nodes = [], np.unique(fp >> np.uint64(BITS - top)) if top else np.zeros(1, dtype=np.uint64)
    for b in range(top + 1, BITS + 1):
        below = np.unique(fp >> np.uint64(BITS - b))
        parent = np.searchsorted(nodes, below >> np.uint64(1))
        kid = np.full((2, len(nodes)), -1, dtype=np.int32)
        kid[(below & np.uint64(1)).astype(np.int64), parent] = np.arange(len(below), dtype=np.int32)
        out.append((kid[0], kid[1]))
        nodes = below
        if len(nodes) == len(fp):       # every node is a single fingerprint: nothing left to branch
            break
    return out


def trie_pairs(a: np.ndarray, b: np.ndarray | None, top: int, errors: int, max_bits: int):
    """Yield index pairs of sorted distinct fingerprints within ``max_bits``.

    ``a`` and ``b`` (``a`` with itself if None) are subtrees of ``top`` bits
    whose prefixes differ in ``errors`` bits.
    """
    same, b = b is None, a if b is None else b
    la = _levels(a, top)
    lb = la if same else _levels(b, top)
    stack = [(0, np.zeros(1, np.int32), np.zeros(1, np.int32), np.full(1, errors, np.int8))]
    while stack:
        level, u, v, d = stack.pop()
        if len(u) > PAIRS_AT_ONCE:
            half = len(u) // 2
            stack += [(level, u[half:], v[half:], d[half:]), (level, u[:half], v[:half], d[:half])]
            continue
        if level >= len(la) and level >= len(lb):
            near = np.bitwise_count(a[u] ^ b[v]) <= max_bits
            if same:
                near &= u < v
            yield u[near], v[near]
            continue
        nu, nv, nd = [], [], []
        for x in (0, 1):
            for y in (0, 1):
                cu = la[level][x][u] if level < len(la) else np.where(
                    (a[u] >> np.uint64(BITS - top - level - 1)) & np.uint64(1) == x, u, -1)
                cv = lb[level][y][v] if level < len(lb) else np.where(
                    (b[v] >> np.uint64(BITS - top - level - 1)) & np.uint64(1) == y, v, -1)
                e = d + np.int8(x != y)
                keep = (cu >= 0) & (cv >= 0) & (e <= max_bits)
                if same:
                    keep &= cu <= cv
                nu.append(cu[keep].astype(np.int32)), nv.append(cv[keep].astype(np.int32)), nd.append(e[keep])
        stack.append((level + 1, np.concatenate(nu), np.concatenate(nv), np.concatenate(nd)))


class Forest:
    """Union-find that keeps the smallest index as the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        up = self.up
        while len(u):
            ru, rv = up[u], up[v]
            while (far := up[ru] != ru).any():
                ru = np.where(far, up[ru], ru)
            while (far := up[rv] != rv).any():
                rv = np.where(far, up[rv], rv)
            apart = ru != rv
            u, v = np.maximum(ru, rv)[apart], np.minimum(ru, rv)[apart]
            np.minimum.at(up, u, v)

    def roots(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up


def _pack_leaf(table: pa.Table) -> pa.Table:
    """One row for a subtree: its fingerprints in ascending order and their nodes."""
    fp = table.column("fp").to_numpy().view(np.uint64)
    order = np.argsort(fp, kind="stable")
    return pa.table({"leaf": pa.array([table.column("leaf")[0].as_py()], pa.int32()),
                     "fps": pa.array([fp[order].tobytes()], pa.binary()),
                     "nodes": pa.array([table.column("node").to_numpy()[order].tobytes()], pa.binary())})


def _joiner(max_bits: int):
    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["side"])
        (a, na), *other = [(np.frombuffer(r["fps"], np.uint64), np.frombuffer(r["nodes"], np.int64)) for r in rows]
        b, names = (other[0][0], np.concatenate([na, other[0][1]])) if other else (None, na)
        forest = Forest(len(names))
        shift = len(a) if other else 0
        for u, v in trie_pairs(a, b, rows[0]["top"], rows[0]["errors"], max_bits):
            forest.link(u.astype(np.int64), v.astype(np.int64) + shift)
        root = forest.roots()
        moved = np.flatnonzero(root != np.arange(len(names)))
        return pa.table({"a": pa.array(names[moved]), "b": pa.array(names[root[moved]])})
    return join


def _leaf_of(fp, nodes: list[tuple[int, int]]):
    """Number of the subtree that holds a fingerprint: a binary search over the subtrees' first fingerprints."""
    unsigned = lambda x: x - (1 << 63)  # noqa: E731  the order of unsigned numbers, in signed longs
    first = F.from_json(F.lit(json.dumps([unsigned(p << (BITS - b)) for b, p in nodes])), F.lit("array<bigint>"))
    key, n = fp.bitwiseXOR(F.lit(-2 ** 63)), len(nodes)
    steps = F.array(*[F.lit(1 << b) for b in range(n.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= n) & (F.get(first, at + s - 1) <= key), at + s).otherwise(at)) - 1


def near_links(leaves: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``leaves`` (fp, node), fp distinct: links (a, b) that connect all fingerprints within ``max_bits``.

    ``leaves`` is read twice (histogram, join), so it should be materialised.
    """
    spark, nodes, rows = leaves.sparkSession, _subtrees(leaves), []
    if not nodes:
        return leaves.select(F.col("node").alias("a"), F.col("node").alias("b"))
    for g, (i, j, errors) in enumerate(_node_pairs(nodes, max_bits)):
        top = min(nodes[i][0], nodes[j][0])
        rows += [(i, g, 0, top, errors)] + [(j, g, 1, top, errors)] * (i != j)
    # Bounded by the number of subtrees (at most about 2^14 beyond small inputs) times their near prefixes.
    routes = spark.createDataFrame(rows, "leaf int, grp long, side int, top int, errors int")
    packed = leaves.withColumn("leaf", _leaf_of(F.col("fp"), nodes)).groupBy("leaf").applyInArrow(
        _pack_leaf, "leaf int, fps binary, nodes binary")
    return packed.join(routes, "leaf").groupBy("grp").applyInArrow(_joiner(max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``; component_id is the smallest doc_id reachable."""
    fps = checkpointed(fingerprints(docs, key, text, shingle))
    leaves = checkpointed(fps.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    parts = connected_components(near_links(leaves, max_bits))
    named = leaves.join(parts, "node", "left").select(
        F.col("fp"), F.coalesce("component", "node").alias("component_id"))
    # A fingerprint shared by very many copies is a hot key of a plain equi-join, which AQE splits.
    return fps.join(named, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: the one of the smallest id.

    Groups are of rows, by their own fingerprints: rows that share an id but
    not their text are told apart, and each stays unless its text has a
    near-duplicate.  Of a group's rows with the smallest id the first by
    fingerprint and text hash stays; rows without an id are in no group and stay.
    Columns of any other name are kept; those named ``_sim_...`` are this operator's own.
    """
    named = docs.filter(F.col(key).isNotNull()).withColumn("_sim_hash", F.xxhash64(text))
    row = F.struct(F.col(key).cast("long").alias("id"), F.col("_sim_hash").alias("h"))
    fps = checkpointed(named.select(row.alias("row"), F.col(text).alias("t")).mapInArrow(
        _fingerprinter(shingle), "doc_id struct<id:long,h:long>, fp long").select("doc_id.id", "doc_id.h", "fp"))
    leaves = checkpointed(fps.select("fp").distinct().withColumn("node", F.col("fp")))
    parts = connected_components(near_links(leaves, max_bits))
    # First row of each fingerprint, then of each component; a frequent fingerprint is reduced before the join.
    first = fps.groupBy("fp").agg(F.min(F.struct("id", "fp", "h")).alias("row"))
    joined = first.join(parts, first["fp"] == parts["node"], "left").select(F.coalesce("component", "fp").alias("c"), "row")
    stay = joined.groupBy("c").agg(F.min("row").alias("row")).select(F.col("row.id").alias("_sim_id"), F.col("row.h").alias("_sim_h"))
    kept = named.join(stay, (F.col(key).cast("long") == F.col("_sim_id")) & (F.col("_sim_hash") == F.col("_sim_h")), "left_semi")
    order = Window.partitionBy(key, "_sim_hash").orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    one = kept.withColumn("_sim_rank", F.row_number().over(order)).filter("_sim_rank = 1").select(*docs.columns)
    return one.unionByName(docs.filter(F.col(key).isNull()))


def hex_digits(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op6_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint and component of every document of ``documents``."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
