"""Exact dedup by an extendible-hash index on shared files.

Texts are equal when they are identical after each run of white space has become one
space.  Rows are dealt to owner tasks by ranges of (hash of the text, id, input
split): an owner holds a range of hash keys, and a key with a large share of all
rows (one text copied everywhere) goes over several owners.

Each owner keeps an extendible-hash index of its range: a directory of 2^depth
entries leads by the hash's low bits to buckets of ``BUCKET_KEYS`` keys; an
overfull bucket is split, and the directory doubled when the bucket was already
as deep as it (keys alike in their low 22 bits stay in one bucket of any size).  Texts of one hash are chained under its key, and a
row joins an entry of the chain only if the text's bytes are the same.  The bytes of each
different text are appended to segment files in the shared folder; an owner
keeps the last segment and a bounded cache in memory and reads the others back
by offset.  At the end it writes directory and buckets to its index file and
returns one slim row per document.

Only the lowest and highest key of an owner can occur at another owner.  Those
entries (a few per owner) are put together by hash and SHA-256 of the text, by
an aggregation, and brought back to the rows by (owner, hash, SHA-256), so
copies of one text are never gathered anywhere.

``lookup`` tests further documents against a written index: the same hash ranges, bytes
compared again.

Files are written under the attempt's name; an owner that runs twice writes two
sets, and the index file, which is renamed into place at the end, names the set
it goes with.

Edge cases: null text counts as empty; a null id counts as larger than all
others; rows of one id and equal texts are copies of each other and exactly one
stays; an empty table gives an empty result; other columns are ignored by the
query, kept by ``drop_copies`` (whose own column names start with ``_copy_``).
"""

from __future__ import annotations

import struct
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import publish, read_table, shared_files, shared_uri, ship_by_value, written
from tidepool.session import checkpoint_subdir

ship_by_value(__name__)

BUCKET_KEYS = 64
MAX_DEPTH = 22                  # directory of 4 million entries; buckets that deep hold what comes
SEGMENT_BYTES = 32 << 20
CACHE_BYTES = 32 << 20
MAGIC = b"TPXHASH1"
ENTRY = "<QiQIq32s"             # hash, segment, offset, stored bytes, rows, SHA-256 of the text


def normalised(text: Column) -> Column:
    """The text with each run of space, tab, line feed, vertical tab, form feed and return as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


class TextFiles:
    """Different texts in segment files: the open segment in memory, closed ones read by offset."""

    def __init__(self, uri: str, name: str, segment_bytes: int = SEGMENT_BYTES, cache_bytes: int = CACHE_BYTES):
        self.fs, self.folder = shared_files(uri)
        self.name, self.limit, self.cache_limit = name, segment_bytes, cache_bytes
        self.segment, self.open, self.cache, self.cached = 0, bytearray(), OrderedDict(), 0
        self.packer, self.unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

    def path(self, segment: int) -> str:
        return f"{self.folder}/{self.name}.{segment:05d}.txt"

    def add(self, text: bytes) -> tuple[int, int, int]:
        """(segment, offset, stored bytes) of a text just written."""
        stored = self.packer.compress(text)
        at = (self.segment, len(self.open), len(stored))
        self.open += stored
        if len(self.open) >= self.limit:
            self.flush()
        return at

    def flush(self) -> None:
        if self.open:
            with self.fs.open_output_stream(self.path(self.segment)) as f:
                f.write(bytes(self.open))
            self.segment, self.open = self.segment + 1, bytearray()

    def read(self, at: tuple[int, int, int]) -> bytes:
        segment, offset, size = at
        if at in self.cache:
            self.cache.move_to_end(at)
            return self.cache[at]
        if segment == self.segment and self.open:
            stored = bytes(self.open[offset:offset + size])
        else:
            with self.fs.open_input_file(self.path(segment)) as f:
                stored = f.read_at(size, offset)
        text = self.unpacker.decompress(stored)
        self.cache[at], self.cached = text, self.cached + len(text)
        while self.cached > self.cache_limit and len(self.cache) > 1:
            self.cached -= len(self.cache.popitem(last=False)[1])
        return text


class Bucket:
    __slots__ = ("depth", "keys")

    def __init__(self, depth: int):
        self.depth, self.keys = depth, {}       # hash -> chain of entry numbers


class ExtendibleIndex:
    """Directory and buckets over 64-bit keys; the entries of one key are a chain.

    An entry is (hash, place of its text, SHA-256, rows); chains hold entry numbers.
    """

    def __init__(self, texts: TextFiles, bucket_keys: int = BUCKET_KEYS):
        self.texts, self.bucket_keys = texts, bucket_keys
        self.depth, self.directory = 0, [Bucket(0)]
        self.hash, self.place, self.digest, self.rows = [], [], [], []

    def bucket(self, h: int) -> Bucket:
        return self.directory[h & ((1 << self.depth) - 1)]

    def find(self, h: int, text: bytes) -> int:
        """The entry whose text has the same bytes, or -1."""
        for e in self.bucket(h).keys.get(h, ()):
            if self.texts.read(self.place[e]) == text:
                return e
        return -1

    def insert(self, h: int, text: bytes, digest: bytes) -> int:
        """The entry of ``text``, new or old, with one more row."""
        e = self.find(h, text)
        if e < 0:
            e = len(self.hash)
            self.hash.append(h), self.place.append(self.texts.add(text)), self.digest.append(digest), self.rows.append(0)
            b = self.bucket(h)
            b.keys.setdefault(h, []).append(e)
            while len(b.keys) > self.bucket_keys and b.depth < MAX_DEPTH:
                self._split(b)
                b = self.bucket(h)
        self.rows[e] += 1
        return e

    def _split(self, b: Bucket) -> None:
        if b.depth == self.depth:
            self.directory += self.directory
            self.depth += 1
        bit, twins = 1 << b.depth, (Bucket(b.depth + 1), Bucket(b.depth + 1))
        for h, chain in b.keys.items():
            twins[bool(h & bit)].keys[h] = chain
        low = next(iter(b.keys)) & (bit - 1)
        for i in range(low, 1 << self.depth, bit):
            self.directory[i] = twins[bool(i & bit)]

    def to_bytes(self) -> bytes:
        """Magic, name of the text files, depth, directory of bucket offsets, buckets."""
        number, pages, offsets, at = {}, [], [], 0
        for b in self.directory:
            if id(b) not in number:
                number[id(b)] = len(pages)
                entries = [e for chain in b.keys.values() for e in chain]
                page = struct.pack("<I", len(entries)) + b"".join(
                    struct.pack(ENTRY, self.hash[e], *self.place[e], self.rows[e], self.digest[e]) for e in entries)
                pages.append(page), offsets.append(at)
                at += len(page)
        where = np.array([offsets[number[id(b)]] for b in self.directory], dtype="<u8").tobytes()
        name = self.texts.name.encode()
        return MAGIC + struct.pack("<II", len(name), self.depth) + name + where + b"".join(pages)


class WrittenIndex:
    """An owner's index file, opened for lookups: one directory entry and one bucket per key."""

    def __init__(self, uri: str, path: str):
        fs, folder = shared_files(uri)
        with fs.open_input_file(f"{folder}/{path}") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError("not an index file")
        size, self.depth = struct.unpack_from("<II", raw, 8)
        self.texts = TextFiles(uri, raw[16:16 + size].decode())
        self.where, self.raw = np.frombuffer(raw, "<u8", 1 << self.depth, 16 + size), raw
        self.base = 16 + size + (8 << self.depth)

    def find(self, h: int, text: bytes) -> bytes | None:
        """SHA-256 of the indexed text with the same bytes."""
        at = self.base + int(self.where[h & ((1 << self.depth) - 1)])
        (n,) = struct.unpack_from("<I", self.raw, at)
        for i in range(n):
            h_, segment, offset, size, _, digest = struct.unpack_from(ENTRY, self.raw, at + 4 + i * struct.calcsize(ENTRY))
            if h_ == h and self.texts.read((segment, offset, size)) == text:
                return digest
        return None


def index_name(owner: int) -> str:
    return f"owner-{owner:06d}.idx"


OWNED = "id long, owner int, h long, digest binary, edge boolean, first boolean, low long, has_id boolean, n long"


def _own(uri: str, bucket_keys: int, segment_bytes: int):
    """Index one owner's rows; one row per document: its entry's smallest id and size at this owner.

    ``first``: this row is the owner's one with that smallest id; ``edge``: the key may occur at other owners.
    """
    def run(batches):
        owner = TaskContext.get().partitionId()
        texts = TextFiles(uri, f"owner-{owner:06d}-{uuid.uuid4().hex}", segment_bytes)
        index, ids, entries = ExtendibleIndex(texts, bucket_keys), [], []
        for batch in batches:
            own = [index.insert(h & (2 ** 64 - 1), t, d) for h, t, d in zip(
                batch.column("h").to_pylist(), batch.column("t").to_pylist(), batch.column("digest").to_pylist())]
            entries.append(np.array(own, dtype=np.int64))
            ids.append(batch.column("id"))
        if not index.hash:
            return
        texts.flush()
        final = f"{texts.folder}/{index_name(owner)}"
        with texts.fs.open_output_stream(f"{final}.{texts.name}") as f:
            f.write(index.to_bytes())
        publish(texts.fs, f"{final}.{texts.name}", final)
        entry = np.concatenate(entries)
        ids = pa.chunked_array(ids).combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        value = ids.fill_null(0).to_numpy(zero_copy_only=False)
        # The first row of each entry by (no id, id, arrival).
        order = np.lexsort((np.arange(len(entry)), value, ~known, entry))
        lead = order[np.r_[True, np.diff(entry[order]) > 0]]
        first = np.zeros(len(entry), dtype=bool)
        first[lead] = True
        hashes = np.array(index.hash, dtype=np.uint64).view(np.int64)
        edge = (hashes == hashes.min()) | (hashes == hashes.max())
        low, has, n = value[lead], known[lead], np.array(index.rows, dtype=np.int64)
        for a in range(0, len(entry), 10_000):
            e = entry[a:a + 10_000]
            yield pa.RecordBatch.from_arrays(
                [ids[a:a + 10_000], pa.array(np.full(len(e), owner, np.int32)), pa.array(hashes[e]),
                 pa.array([index.digest[i] for i in e.tolist()], pa.binary()), pa.array(edge[e]),
                 pa.array(first[a:a + 10_000]), pa.array(low[e]), pa.array(has[e]), pa.array(n[e])],
                names=["id", "owner", "h", "digest", "edge", "first", "low", "has_id", "n"])
    return run


def new_folder(spark) -> str:
    return shared_uri(spark, checkpoint_subdir(spark, f"exact-index-{uuid.uuid4().hex}"))


def keyed(docs: DataFrame, key: str, text: str, key_hash: Column | None = None) -> DataFrame:
    """(id, h, digest, t): the normalised text with its 64-bit key and SHA-256."""
    rows = docs.select(F.col(key).cast("long").alias("id"), normalised(F.col(text)).alias("t"))
    return rows.select("id", (F.xxhash64("t") if key_hash is None else key_hash).alias("h"),
                       F.unhex(F.sha2("t", 256)).alias("digest"), F.col("t").cast("binary").alias("t"))


def owned_rows(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", owners: int | None = None,
               bucket_keys: int = BUCKET_KEYS, segment_bytes: int = SEGMENT_BYTES, key_hash: Column | None = None) -> DataFrame:
    """Build the index below ``folder``; one slim row per document, written to the shared folder."""
    fs, path = shared_files(folder)
    fs.create_dir(path, recursive=True)
    rows = keyed(docs, key, text, key_hash).withColumn("split", F.spark_partition_id())
    # The hash first; the id and the input split only divide a key that many rows share.
    n = owners or max(docs.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(n, "h", "id", "split").select("id", "h", "digest", "t")
    return written(dealt.mapInArrow(_own(folder, bucket_keys, segment_bytes), OWNED), "exact-rows")


def classes(owned: DataFrame) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) of every document, keys of several owners put together."""
    parts = owned.where("edge AND first").select("owner", "h", "digest", "low", "has_id", "n")
    # Smallest id over the owners, rows without id last; ``at`` is the owner that holds that row.
    ids = F.when(F.col("has_id"), F.col("low"))
    whole = parts.groupBy("h", "digest").agg(F.min(ids).alias("keep"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("owners"))
    shared = parts.join(whole.where("owners > 1"), ["h", "digest"])
    at = shared.where(F.expr("CASE WHEN keep IS NULL THEN NOT has_id ELSE has_id AND low = keep END")).groupBy(
        "h", "digest").agg(F.min("owner").alias("at"))
    fixes = shared.join(at, ["h", "digest"]).select(
        F.col("owner").alias("_o"), F.col("h").alias("_h"), F.col("digest").alias("_d"), "keep", "size", "at")
    own = F.col("_o").isNull()
    j = owned.join(fixes, (F.col("owner") == F.col("_o")) & (F.col("h") == F.col("_h")) & (F.col("digest") == F.col("_d"))
                   & F.col("edge"), "left")
    return j.select("id", F.when(own, ids).otherwise(F.col("keep")).alias("keep_id"),
                    F.when(own, F.col("n")).otherwise(F.col("size")).alias("group_size"),
                    (F.col("first") & (own | (F.col("owner") == F.col("at")))).alias("kept"), "digest")


def deduplicate(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """(id, keep_id, group_size, kept, digest), one row per document; the index stays in ``folder``."""
    return classes(owned_rows(docs, folder or new_folder(docs.sparkSession), **options))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the first of the smallest id; all columns are kept.

    A row is recognised by id and text; several identical ones differ in their
    other columns only, and the first by a hash of those stays.
    """
    stay = deduplicate(docs, key=key, text=text).where("kept").select(F.col("id").alias("_copy_id"), F.col("digest").alias("_copy_digest"))
    marked = docs.withColumn("_copy_key", F.unhex(F.sha2(normalised(F.col(text)), 256)))
    j = marked.join(stay, (F.col("_copy_key") == F.col("_copy_digest")) & F.col(key).cast("long").eqNullSafe(F.col("_copy_id")), "left_semi")
    w = Window.partitionBy("_copy_key").orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    return j.withColumn("_copy_n", F.row_number().over(w)).where("_copy_n = 1").drop("_copy_key", "_copy_n")


def _look(uri: str):
    def run(batches):
        number, index = None, None
        for batch in batches:
            out = []
            for h, t, owner in zip(*(batch.column(c).to_pylist() for c in ("h", "t", "owner"))):
                if owner is not None and owner != number:
                    number, index = owner, WrittenIndex(uri, index_name(owner))
                out.append(index.find(h & (2 ** 64 - 1), t) if owner is not None else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x is not None for x in out]),
                                              pa.array(out, pa.binary())], names=["id", "known", "digest"])
    return run


def lookup(docs: DataFrame, owned: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
           key_hash: Column | None = None) -> DataFrame:
    """(id, known, digest): whether each document's text is in the index at ``folder`` that ``owned`` came from.

    Each key is looked up at the first owner of each text chained under it: one for all but colliding hashes, which
    are looked up at several and put together again.
    """
    rows = keyed(docs, key, text, key_hash).withColumn("row", F.struct(F.spark_partition_id(), F.monotonically_increasing_id()))
    rows = written(rows.select("id", "h", "t", F.to_json("row").alias("row")), "exact-asked")
    places = owned.groupBy("h", "digest").agg(F.min("owner").alias("owner")).select("h", "owner").distinct()
    asked = rows.join(places, "h", "left").repartitionByRange("owner", "h", "row").sortWithinPartitions("owner")
    hits = asked.select("id", "h", "t", "owner").mapInArrow(_look(folder), "id long, known boolean, digest binary")
    return hits


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: one row per document with the document that stays for it."""
    return deduplicate(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP13_SQL = """
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, row) AS n FROM t)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, n = 1 AS kept, sha256(t) AS text_sha256
FROM r WINDOW w AS (PARTITION BY t)
"""
