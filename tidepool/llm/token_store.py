"""Token ids as raw binary shards with a minimal perfect hash index.

``write`` orders the documents by id (a range exchange), encodes each in the
task that holds its range, and writes per shard

    shard-N.ids   the ids of its documents one after another, unsigned
                  little-endian, 16 bits wide, nothing else
    shard-N.mph   magic, the number of keys, the perfect hash, and per slot the
                  key's fingerprint (32 bits), its offset in ids, its number of
                  ids and of documents

and returns the manifest, one row per shard.  A document's key is its id and
the how-manieth document of that id in the shard it is, so ids may repeat; the
slot of the first one tells how many there are.  ``read`` goes the other way:
it routes ids to shards by the manifest's ranges, looks each up in constant
time, checks the fingerprint, and reads only the ids' bytes, neighbours at once.

Files are written under a name of the attempt and then renamed, so a task that
runs twice leaves one whole file.  A folder without a scheme is the one that Spark
would take it for (``fs.defaultFS``); it is reached with ``pyarrow.fs``, so any
shared folder that knows will do (file, s3, gs, hdfs).

Edge cases: null text is the end id alone; a null id sorts first and is a key;
rows of one id are ordered by a hash of their text; an empty table writes no
shard; unknown ids return no row; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import tokens
from tidepool.llm.common import publish, read_table, shared_files, shared_uri, ship_by_value
from tidepool.llm.perfect_hash import PerfectHash, fingerprints
from tidepool.session import checkpoint_subdir

ship_by_value(__name__)

MAGIC = b"TPMPH001"
ID_TYPE = "<u2"
READ_BYTES = 8 << 20
MAX_SHARDS = 1_000_000          # manifest rows that are shipped to every task

_SLOT = np.dtype([("print", "<u4"), ("start", "<u8"), ("n", "<u4"), ("docs", "<u4")])
MANIFEST = "shard int, first long, last long, has_null boolean, n_docs long, n_ids long"


def key_hash(doc_id: int | None, copy: int = 0) -> int:
    return xxhash.xxh64_intdigest(("null" if doc_id is None else str(doc_id)) + (f"/{copy}" if copy else ""))


def _names(folder: str, shard: int) -> tuple[str, str]:
    return f"{folder}/shard-{shard:06d}.ids", f"{folder}/shard-{shard:06d}.mph"


def index_bytes(ids: list, starts: list[int], sizes: list[int]) -> bytes:
    """The index of one shard from its documents in order."""
    copies: dict = {}
    hashes = np.zeros(len(ids), dtype=np.uint64)
    for i, k in enumerate(ids):
        c = copies.get(k, 0)
        hashes[i], copies[k] = key_hash(k, c), c + 1
    mph = PerfectHash.build(hashes)
    slots = np.zeros(len(mph), dtype=_SLOT)
    at = mph.slots(hashes)
    slots["print"][at], slots["start"][at], slots["n"][at] = fingerprints(hashes), starts, sizes
    slots["docs"][at] = [copies[k] for k in ids]
    return MAGIC + np.array([len(slots)], "<i8").tobytes() + mph.to_bytes() + slots.tobytes()


class Index:
    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not an index file")
        n = int(np.frombuffer(raw, "<i8", 1, 8)[0])
        self.mph, at = PerfectHash.from_bytes(raw[16:])
        self.slots = np.frombuffer(raw, _SLOT, n, 16 + at)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, slot rows) of key hashes."""
        at = self.mph.slots(hashes)
        known = at >= 0
        known[known] = self.slots["print"][at[known]] == fingerprints(hashes)[known]
        return known, self.slots[at[known]]


def _write(uri: str, path: str | None, end_id: int):
    def run(batches):
        encoder, shard = tokens.encoder(path), TaskContext.get().partitionId()
        (fs, folder), attempt = shared_files(uri), uuid.uuid4().hex
        ids_name, index_name = _names(folder, shard)
        keys, starts, sizes, total, out = [], [], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or fs.open_output_stream(f"{ids_name}.{attempt}")
            ids, at = encoder.encode_batch(batch.column(1))
            # The end id goes behind each document's ids.
            flat = np.insert(ids, at[1:], end_id).astype(ID_TYPE)
            out.write(flat.tobytes())
            n = np.diff(at) + 1
            starts += (total + np.cumsum(n) - n).tolist()
            sizes += n.tolist()
            keys += batch.column(0).to_pylist()
            total += len(flat)
        if out is None:
            return
        out.close()
        with fs.open_output_stream(f"{index_name}.{attempt}") as f:
            f.write(index_bytes(keys, starts, sizes))
        publish(fs, f"{ids_name}.{attempt}", ids_name)
        publish(fs, f"{index_name}.{attempt}", index_name)
        known = [k for k in keys if k is not None]
        yield pa.RecordBatch.from_pylist([{
            "shard": shard, "first": known[0] if known else None, "last": known[-1] if known else None,
            "has_null": len(known) < len(keys), "n_docs": len(keys), "n_ids": total}], pa.schema([
                ("shard", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("has_null", pa.bool_()),
                ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
    return run


def write(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
          end_id: int = tokens.END_ID, shards: int | None = None) -> list[dict]:
    """Write ``docs`` in ascending id order below ``folder``; the manifest, with each shard's first id position.

    The number of shards follows the input's splits unless it is given.
    """
    folder = shared_uri(docs.sparkSession, folder)
    fs, path = shared_files(folder)
    fs.create_dir(path, recursive=True)
    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t"))
    n = shards or max(1, slim.rdd.getNumPartitions())
    if n > MAX_SHARDS:
        raise ValueError(f"{n} shards; the manifest is bounded to {MAX_SHARDS}")
    ordered = slim.withColumn("h", F.xxhash64("t")).repartitionByRange(n, "key", "h").sortWithinPartitions("key", "h")
    rows = ordered.select("key", "t").mapInArrow(_write(folder, tokenizer, end_id), MANIFEST).collect()
    out, start = [], 0
    for r in sorted(rows, key=lambda r: r.shard):
        out.append({**r.asDict(), "start": start})
        start += r.n_ids
    return out


def _route(share):
    def run(batches):
        shards = share.value
        known = [s for s in shards if s["first"] is not None]
        first, last = (np.array([s[c] for s in known], dtype=np.int64) for c in ("first", "last"))
        number = np.array([s["shard"] for s in known], dtype=np.int32)
        nulls = [s["shard"] for s in shards if s["has_null"]]
        for batch in batches:
            out_key, out_shard = [], []
            keys = batch.column(0)
            if keys.null_count:
                out_key += [None] * len(nulls)
                out_shard += nulls
            values = keys.drop_null().to_numpy()
            lo, hi = np.searchsorted(last, values, "left"), np.searchsorted(first, values, "right")
            for i in range(int((hi - lo).max(initial=0))):      # one shard, unless an id goes over a boundary
                has = lo + i < hi
                out_key += values[has].tolist()
                out_shard += number[(lo + i)[has]].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out_key, pa.int64()), pa.array(out_shard, pa.int32())],
                                             names=["key", "shard"])
    return run


def _lookup(folder_uri: str, share, payload: bool):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        base = {s["shard"]: s["start"] for s in share.value}[shard]
        fs, folder = shared_files(folder_uri)
        ids_name, index_name = _names(folder, shard)
        with fs.open_input_file(index_name) as f:
            index = Index(f.read())
        keys = table.column("key").to_pylist()
        hashes = np.array([key_hash(k) for k in keys], dtype=np.uint64)
        known, slots = index.find(hashes)
        found = [k for k, ok in zip(keys, known.tolist()) if ok]
        more = [(k, c) for k, n in zip(found, slots["docs"].tolist()) for c in range(1, n)]
        if more:
            _, extra = index.find(np.array([key_hash(k, c) for k, c in more], dtype=np.uint64))
            found, slots = found + [k for k, _ in more], np.concatenate([slots, extra])
        order = np.argsort(slots["start"], kind="stable")
        width, out = np.dtype(ID_TYPE).itemsize, []
        with fs.open_input_file(ids_name) as f:
            i = 0
            while i < len(order):
                lo = int(slots["start"][order[i]])
                hi, j = lo + int(slots["n"][order[i]]), i + 1
                while j < len(order) and int(slots["start"][order[j]]) == hi and (hi - lo) * width < READ_BYTES:
                    hi, j = hi + int(slots["n"][order[j]]), j + 1
                ids = np.frombuffer(f.read_at((hi - lo) * width, lo * width), dtype=ID_TYPE)
                for s in order[i:j].tolist():
                    a = int(slots["start"][s]) - lo
                    out.append((found[s], base + lo + a, ids[a:a + int(slots["n"][s])].astype("<u4").tobytes()))
                i = j
        cols = {"key": pa.array([o[0] for o in out], pa.int64()), "start": pa.array([o[1] for o in out], pa.int64()),
                "n_tokens": pa.array([len(o[2]) // 4 for o in out], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(o[2]) for o in out], pa.int64())}
        return pa.table(cols | ({"ids": pa.array([o[2] for o in out], pa.binary())} if payload else {}))
    return run


def read(keys: DataFrame, folder: str, manifest: list[dict], key: str = "doc_id", payload: bool = True) -> DataFrame:
    """Documents of the ids in ``keys``: key, start (ids before it in all shards), n_tokens, ids_crc32, and ids.

    ids (unless ``payload`` is off) are unsigned 32-bit little-endian.  Each id is looked up once however often
    it is asked for.
    """
    spark = keys.sparkSession
    share = spark.sparkContext.broadcast(manifest)
    asked = keys.select(F.col(key).cast("long").alias("key")).distinct()
    # One task per shard: what a task reads is a shard's payload, however few bytes its keys have.
    routed = asked.mapInArrow(_route(share), "key long, shard int").distinct().repartition(max(1, len(manifest)), "shard")
    folder = shared_uri(spark, folder)
    return routed.groupBy("shard").applyInArrow(
        _lookup(folder, share, payload),
        "key long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if payload else "")) \
        .withColumnRenamed("key", key)


def new_folder(spark: SparkSession) -> str:
    return checkpoint_subdir(spark, f"token-store-{uuid.uuid4().hex}")


def op9_token_store(spark, sf_dir: str) -> DataFrame:
    """Contract query: write every document's ids, and read them back by key."""
    docs = read_table(spark, sf_dir, "documents")
    folder = new_folder(spark)
    manifest = write(docs, folder)
    return read(docs, folder, manifest, payload=False).select("doc_id", "start", "n_tokens", "ids_crc32")
