"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Class k holds pieces of at most capacity / k tokens and more than
capacity / (k + 1); a bin of class k is filled with exactly k pieces, so a
worker needs one open bin per class and no look at other workers.  Documents
may be cut: whole capacities first (class 1, no padding), then the rest stays
whole if k copies of it fill a bin to ``1 - MAX_WASTE``, and otherwise gives up
a piece of exactly floor(capacity / k) tokens and goes on with what is left, so
a closed bin is padded by less than ``MAX_WASTE`` of it.

When a worker's rows end, the open bins are at most one per class.  Their
pieces are laid end to end (a piece may be cut once more at a sequence
boundary), so that a worker leaves one short sequence, which is closed at the
powers of two of its length: those need no padding.  Everything happens in the
map task that reads the documents: no shuffle, and memory for one batch of
texts plus the open bins.

A sequence id is the task's partition number and a running number within it.
Edge cases: null text is a document of the end id alone; repeated rows and ids
are documents of their own; an empty table gives no rows; the document key is
carried as it is (also null), other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import tokens
from tidepool.llm.common import read_table, ship_by_value

ship_by_value(__name__)

CAPACITY = 2_048
MAX_WASTE = 1 / 64
ROWS_AT_ONCE = 4_096

PIECE_COLUMNS = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def cut(n: int, capacity: int = CAPACITY, max_waste: float = MAX_WASTE) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of ``n`` tokens, in order."""
    out = [(capacity, 1)] * (n // capacity)
    n %= capacity
    while n:
        k = capacity // n
        if k * n >= capacity * (1 - max_waste):
            out.append((n, k))
            break
        size = capacity // (k + 1)
        if size == 0 or n - size < 0:
            out.append((n, k))
            break
        out.append((size, k + 1))
        n -= size
    return out


class Packer:
    """Bins of one worker; ``take`` and ``finish`` return rows (piece, sequence number, offset)."""

    def __init__(self, capacity: int = CAPACITY, max_waste: float = MAX_WASTE):
        self.capacity, self.max_waste = capacity, max_waste
        self.open: dict[int, list] = {}
        self.sequences = 0
        self.cuts: dict[int, list] = {}

    def take(self, key, ids: np.ndarray):
        at, total = 0, len(ids)
        rest = total % self.capacity
        if rest not in self.cuts:
            self.cuts[rest] = cut(rest, self.capacity, self.max_waste)
        for size, k in [(self.capacity, 1)] * (total // self.capacity) + self.cuts[rest]:
            bin_ = self.open.setdefault(k, [])
            bin_.append((key, at, ids[at:at + size], total))
            at += size
            if len(bin_) == k:
                yield from self._close(self.open.pop(k))

    def _close(self, pieces):
        offset = 0
        for p in pieces:
            yield p, self.sequences, offset
            offset += len(p[2])
        self.sequences += 1

    def finish(self):
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) for p in left)
        bounds = [self.capacity] * (total // self.capacity)
        short = total % self.capacity
        bounds += [1 << b for b in range(short.bit_length() - 1, -1, -1) if short >> b & 1]
        for room in bounds:
            fill = []
            while room:
                key, start, ids, n = left.pop(0)
                fill.append((key, start, ids[:room], n))
                if len(ids) > room:
                    left.insert(0, (key, start + room, ids[room:], n))
                room -= len(fill[-1][2])
            yield from self._close(fill)


def _pack(path: str | None, end_id: int, capacity: int, max_waste: float, key_type: pa.DataType):
    def run(batches):
        encoder, packer = tokens.encoder(path), Packer(capacity, max_waste)
        base = TaskContext.get().partitionId() << 33

        def table(rows):
            return pa.RecordBatch.from_arrays([
                pa.array([p[0] for p, _, _ in rows], key_type),
                pa.array([p[1] for p, _, _ in rows], pa.int64()),
                pa.array([len(p[2]) for p, _, _ in rows], pa.int64()),
                pa.array([p[3] for p, _, _ in rows], pa.int64()),
                pa.array([base + s for _, s, _ in rows], pa.int64()),
                pa.array([o for _, _, o in rows], pa.int64()),
                pa.array([p[2].tobytes() for p, _, _ in rows], pa.binary()),
            ], names=["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
        rows = []
        for batch in batches:
            ids, at = encoder.encode_batch(batch.column(1))
            keys = batch.column(0).to_pylist()
            for i, key in enumerate(keys):
                for row in packer.take(key, np.append(ids[at[i]:at[i + 1]], np.uint32(end_id)).astype("<u4")):
                    rows.append(row)
                    if len(rows) == ROWS_AT_ONCE:
                        yield table(rows)
                        rows = []
        for row in packer.finish():
            rows.append(row)
            if len(rows) == ROWS_AT_ONCE:
                yield table(rows)
                rows = []
        if rows:
            yield table(rows)
    return run


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         end_id: int = tokens.END_ID, capacity: int = CAPACITY, max_waste: float = MAX_WASTE) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32 binary)."""
    from pyspark.sql.pandas.types import to_arrow_type
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("t"))
    kind = slim.schema["key"].dataType
    out = slim.mapInArrow(_pack(tokenizer, end_id, capacity, max_waste, to_arrow_type(kind)),
                          f"key {kind.simpleString()}, {PIECE_COLUMNS}")
    return out.withColumnRenamed("key", key)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op5_packing(spark, sf_dir: str) -> DataFrame:
    """Contract query: where every piece of every document went."""
    return digests(pack(read_table(spark, sf_dir, "documents")))
