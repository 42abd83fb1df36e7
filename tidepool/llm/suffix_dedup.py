"""Removal of repeated byte strings across all documents, by bucket-pointer refinement.

Every byte covered by a LENGTH-byte string that also starts earlier (a smaller
document, or the same one further left) is removed; strings are judged on the
input and never cross documents.

1.  Map: each text is cut into segments, runs of windows with one anchor (see
    ``suffix_buckets``).  A segment is named by its anchor's q-gram bucket and
    by its refinement to the whole segment.  Segments seen before in the same
    task are repeats at once; of the others one slim entry per name goes to the
    partition of its q-gram bucket.
2.  Reduce, per partition of q-gram buckets: of segments with one name all but
    the first are repeats.  A bucket that keeps several names is refined: its
    segments are requested.
3.  The requested segments' bytes are fetched from the texts and sorted again,
    with exact identifiers now: 8-gram buckets, then pairs with the identifiers
    8, 16, 32 and 36 bytes later, keeping only buckets of several offsets.
    Windows left in one bucket are equal; all but the first are repeats.
    Buckets of more than ``HOT`` names, or ``LOCAL_HOT`` in one task (a passage
    in very many documents), send their windows' own names instead, dealt by
    name, so no group is large.
4.  The repeats' byte ranges are joined with the texts.

Entries travel packed, one binary value per task and partition.  The text is
shuffled once, by document, for steps 3 and 4 together.

Edge cases: null text is empty; a null id sorts before every id; rows that
repeat both id and text are one document and all get its result, rows of one id
with different texts are ordered by a hash of the text; texts shorter than
LENGTH bytes lose nothing; an empty table gives an empty result; other columns
are ignored (``deduplicate`` keeps them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import suffix_buckets as sb
from tidepool.llm.common import read_table, ship_by_value, written

ship_by_value(__name__)

HOT = 1_024                     # names of one q-gram bucket that are refined together
LOCAL_HOT = 128                 # names of one q-gram bucket that one task passes on; beyond it the bucket is hot
PARTS_PER_PARTITION = 2
PART_BYTES = 16 << 20           # text bytes that one part of the names or segments stands for at most, about

NULL_ID = -2 ** 63
_DOCS = np.dtype([("d", "<i8"), ("h", "<i8")])
_ENTRY = np.dtype([("q", "<u8"), ("c", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("windows", "u1"), ("state", "u1")])
_NAMED = np.dtype([("x", "<u8"), ("y", "<u8"), ("doc", "<u4"), ("start", "<u4")])
_SEGMENT = np.dtype([("doc", "<u4"), ("start", "<u4"), ("size", "<u2")])
_SPAN = np.dtype([("a", "<u4"), ("b", "<u4")])
_DOC_SPAN = np.dtype([("doc", "<u4"), ("a", "<u4"), ("b", "<u4")])
_REQUEST = np.dtype([("start", "<u4"), ("windows", "<u2"), ("hot", "<u2"), ("part", "<u4")])
HOT_HERE = 1                    # state of an entry whose bucket one task found hot

_PACKED = "part int, kind int, docs binary, entries binary, more binary"
_FOUND = "d long, h long, kind int, data binary"
SPANS, REQUESTS = 0, 1


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                      names=["part", "kind", "docs", "entries", "more"])


def _by_part(part: np.ndarray, docs: np.ndarray, entries: np.ndarray, kind: int, more: list | None = None):
    """One row per part, with the documents that its entries name renumbered."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for own in np.split(order, cuts) if len(order) else []:
        e = entries[own]
        used, e["doc"] = np.unique(e["doc"], return_inverse=True)
        yield (int(part[own[0]]), kind, docs[used].tobytes(), e.tobytes(),
               b"".join(more[i] for i in own) if more is not None else b"")


def _unpacked(table: pa.Table, kind: int, dtype: np.dtype):
    """Documents, entries (with documents numbered over all rows) and the rows' other bytes."""
    docs, entries, more, n = [], [], [], 0
    for k, d, e, m in zip(*(table.column(c).to_pylist() for c in ("kind", "docs", "entries", "more"))):
        if k == kind:
            own = np.frombuffer(e, dtype=dtype).copy()
            own["doc"] += n
            docs.append(np.frombuffer(d, dtype=_DOCS))
            n += len(docs[-1])
            entries.append(own), more.append(m)
    if not docs:
        return np.zeros(0, _DOCS), np.zeros(0, dtype), b""
    return np.concatenate(docs), np.concatenate(entries), b"".join(more)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                      names=["d", "h", "kind", "data"])


def _per_doc(docs: np.ndarray, doc: np.ndarray, data: np.ndarray, kind: int) -> list[tuple]:
    """One row per document with its records, in ascending order."""
    order = np.lexsort((data[data.dtype.names[0]], doc))
    cuts = np.flatnonzero(np.diff(doc[order])) + 1
    return [(int(docs[doc[own[0]]]["d"]), int(docs[doc[own[0]]]["h"]), kind, data[own].tobytes())
            for own in (np.split(order, cuts) if len(order) else [])]


def _place(docs: np.ndarray, doc: np.ndarray, start: np.ndarray):
    """Sort columns of "starts earlier", least significant first."""
    return start, docs["h"][doc], docs["d"][doc]


def _repeats(docs: np.ndarray, doc, start, names: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by (names, place), and per sorted entry: 1 new name, 0 the same place as its first, -1 repeat."""
    order = np.lexsort((*_place(docs, doc, start), *names))
    same = np.ones(len(order), dtype=bool)
    for x in names:
        same[1:] &= x[order][1:] == x[order][:-1]
    same[:1] = False
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order)))) if len(order) else order
    own = np.ones(len(order), dtype=bool)
    for x in _place(docs, doc, start):
        own &= x[order] == x[order][first]
    return order, np.where(~same, 1, np.where(own, 0, -1))


def _texts(batch, column: int = 2):
    for d, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(column).to_pylist()):
        yield d, h, t.encode("utf-8", "replace") if t else b""


def _pieces(texts):
    """Buffers of whole texts, at most about PIECE bytes; a longer text in pieces that overlap by LENGTH - 1."""
    group, size = [], 0
    for doc, raw in texts:
        if len(raw) < sb.LENGTH:
            continue
        for at in range(0, len(raw) - sb.LENGTH + 1, sb.PIECE):
            part = raw[at:at + sb.PIECE + sb.LENGTH - 1]
            if group and size + len(part) > sb.PIECE + sb.LENGTH:
                yield group
                group, size = [], 0
            group.append((doc, at, part))
            size += len(part)
    if group:
        yield group


def _name_segments(parts: int):
    def run(batches):
        docs, found = [], []
        for batch in batches:
            base = len(docs)
            rows = list(_texts(batch))
            docs += [(d, h) for d, h, _ in rows]
            for group in _pieces((base + i, raw) for i, (_, _, raw) in enumerate(rows)):
                sizes = np.array([len(p) for *_, p in group])
                stops = np.cumsum(sizes)
                s = sb.Segments(np.frombuffer(b"".join(p for *_, p in group), dtype=np.uint8), stops - sizes, stops)
                own = np.zeros(len(s.q), _ENTRY)
                own["q"], own["c"], own["windows"] = s.q, s.c, s.windows
                own["doc"] = np.array([g[0] for g in group])[s.text]
                own["start"] = s.start - (stops - sizes)[s.text] + np.array([g[1] for g in group])[s.text]
                found.append(own)
        if not found:
            return
        docs, e = np.array(docs, dtype=_DOCS), np.concatenate(found)
        order, how = _repeats(docs, e["doc"], e["start"], (e["c"], e["q"]))
        again, e, how = e[order[how < 0]], e[order[how >= 0]], how[how >= 0]
        new = np.concatenate([[True], e["q"][1:] != e["q"][:-1]])
        bucket = np.cumsum(new) - 1
        many = np.bincount(bucket, weights=how == 1) > LOCAL_HOT
        e["state"][many[bucket]] = HOT_HERE
        # A hot bucket's entries are dealt by name; one of them tells the bucket's own partition.
        dealt = np.where(e["state"] == HOT_HERE, e["c"], e["q"])
        marks = np.flatnonzero(new & many[bucket])
        dealt, e = np.concatenate([dealt, e["q"][marks]]), np.concatenate([e, e[marks]])
        rows = list(_by_part((dealt % np.uint64(parts)).astype(np.int64), docs, e, 0))
        yield _packed(rows + _known_spans(docs, again["doc"], _segment_spans(again), parts))
    return run


def _segment_spans(e: np.ndarray) -> np.ndarray:
    spans = np.zeros(len(e), _SPAN)
    spans["a"], spans["b"] = e["start"], e["start"] + e["windows"] + (sb.LENGTH - 1)
    return spans


def _merged(doc: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Touching spans of a document joined; among one document's spans a later start has a later end."""
    order = np.lexsort((spans["a"], doc))
    doc, spans = doc[order], spans[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (spans["a"][1:] > spans["b"][:-1])
    first = np.flatnonzero(new)
    out = np.zeros(len(first), _DOC_SPAN)
    out["doc"], out["a"] = doc[first], spans["a"][first]
    out["b"] = spans["b"][np.append(first[1:], len(doc)) - 1] if len(doc) else 0
    return out


def _known_spans(docs: np.ndarray, doc: np.ndarray, spans: np.ndarray, parts: int) -> list[tuple]:
    """Rows that carry spans a task is sure of: all of a document's to one part."""
    e = _merged(doc, spans)
    return list(_by_part(np.abs(docs["h"][e["doc"]] % parts), docs, e, 2))


def _carried(table: pa.Table) -> list[tuple]:
    docs, e, _ = _unpacked(table, 2, _DOC_SPAN)
    spans = np.zeros(len(e), _SPAN)
    spans["a"], spans["b"] = e["a"], e["b"]
    return _per_doc(docs, e["doc"], spans, SPANS)


def _refine_buckets(table: pa.Table) -> pa.Table:
    docs, e, _ = _unpacked(table, 0, _ENTRY)
    rows, spans = _carried(table), _segment_spans(e)
    # Entries of buckets that a task found hot are refined by window names, wherever they are.
    order, how = _repeats(docs, e["doc"], e["start"], (e["c"], e["q"]))
    e, spans = e[order], spans[order]
    local = e["state"] == HOT_HERE
    new = np.ones(len(e), dtype=bool)
    new[1:] = e["q"][1:] != e["q"][:-1]
    bucket = np.cumsum(new) - 1
    names = np.bincount(bucket, weights=how == 1) if len(e) else np.zeros(0)
    hot = (np.bincount(bucket, weights=local) > 0) | (names > HOT) if len(e) else np.zeros(0, bool)
    repeat = how < 0
    again = _merged(e["doc"][repeat], spans[repeat])
    rows += _per_doc(docs, again["doc"], again[["a", "b"]].astype(_SPAN), SPANS)
    ask = ~repeat & ((names > 1) | hot)[bucket] if len(e) else repeat
    r = np.zeros(int(ask.sum()), _REQUEST)
    r["start"], r["windows"], r["hot"] = e["start"][ask], e["windows"][ask], hot[bucket][ask]
    r["part"] = e["q"][ask] >> np.uint64(32)        # one bucket's segments meet again
    rows += _per_doc(docs, e["doc"][ask], r, REQUESTS)
    return pa.Table.from_batches([_found(rows)])


def _fetch(parts: int):
    def run(batches):
        docs, segments, where, raw_of, named = [], [], [], [], []
        for batch in batches:
            asked = batch.column(3).to_pylist()
            for (d, h, raw), req in zip(_texts(batch), asked):
                r = np.unique(np.frombuffer(b"".join(req), dtype=_REQUEST))
                doc = len(docs)
                docs.append((d, h))
                for start, windows, hot, part in r.tolist():
                    piece = raw[start:start + windows + sb.LENGTH - 1]
                    if hot:
                        x, y = sb.window_names(np.frombuffer(piece, dtype=np.uint8))
                        own = np.zeros(len(x), _NAMED)
                        own["x"], own["y"], own["doc"] = x, y, doc
                        own["start"] = np.arange(start, start + len(x))
                        named.append(own)
                    else:
                        segments.append((doc, start, len(piece)))
                        where.append(part)
                        raw_of.append(piece)
        docs = np.array(docs, dtype=_DOCS)
        rows = []
        if segments:
            part = np.array(where, dtype=np.int64) % parts
            rows += _by_part(part, docs, np.array(segments, dtype=_SEGMENT), 0, raw_of)
        if named:
            e = np.concatenate(named)
            order, how = _repeats(docs, e["doc"], e["start"], (e["y"], e["x"]))
            e, keep = e[order], how >= 0
            # A window seen earlier in this task is a repeat; its first occurrence stands for the task.
            rows += _by_part((e["x"][keep] % np.uint64(parts)).astype(np.int64), docs, e[keep], 1)
            rows += _known_spans(docs, *_windows_to_spans(e["doc"][~keep], e["start"][~keep]), parts)
        yield _packed(rows)
    return run


def exact_classes(raw: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets with at least LENGTH bytes left whose LENGTH-byte string occurs twice or more, and its class.

    ``left``: bytes from each offset to the end of its text.  Buckets of one
    offset are dropped after each refinement; identifiers of the rest are reused.
    """
    at = np.flatnonzero(left >= 8)
    ids = np.full(len(raw), -1, dtype=np.int64)
    key = sb.grams(raw)[at] if len(at) else np.zeros(0, np.uint64)
    for depth, later in ((8, 0), (16, 8), (32, 16), (64, 32), (sb.LENGTH, sb.LENGTH - 64)):
        if later:
            at = at[left[at] >= depth]
            other = ids[at + later]
            at, other = at[other >= 0], other[other >= 0]
            key = ids[at] * np.int64(len(raw) + 1) + other
        _, name, n = np.unique(key, return_inverse=True, return_counts=True)
        several = n[name] > 1
        ids[:] = -1
        at = at[several]
        ids[at] = name[several]
    return at, ids[at]


def _windows_to_spans(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((start, doc))
    doc, start = doc[order].astype(np.int64), start[order].astype(np.int64)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    spans = np.zeros(len(first), _SPAN)
    spans["a"], spans["b"] = start[first], start[last] + sb.LENGTH
    return doc[first], spans


def _compare(table: pa.Table) -> pa.Table:
    rows = []
    docs, s, raw = _unpacked(table, 0, _SEGMENT)
    if len(s):
        size = s["size"].astype(np.int64)
        begin = np.cumsum(size) - size
        buf = np.frombuffer(raw, dtype=np.uint8)
        own = np.repeat(np.arange(len(s)), size)
        inside = np.arange(len(buf)) - begin[own]
        at, cls = exact_classes(buf, size[own] - inside)
        doc, start = s["doc"][own[at]], s["start"][own[at]].astype(np.int64) + inside[at]
        order, how = _repeats(docs, doc, start, (cls,))
        again = order[how < 0]
        rows += _per_doc(docs, *_windows_to_spans(doc[again], start[again]), SPANS)
    docs, e, _ = _unpacked(table, 1, _NAMED)
    order, how = _repeats(docs, e["doc"], e["start"], (e["y"], e["x"]))
    again = e[order][how < 0]
    rows += _per_doc(docs, *_windows_to_spans(again["doc"], again["start"]), SPANS)
    rows += _carried(table)
    return pa.Table.from_batches([_found(rows)])


def _union(blobs: list | None) -> np.ndarray:
    """Disjoint byte spans in order."""
    s = np.frombuffer(b"".join(blobs or []), dtype=_SPAN)
    if not len(s):
        return s
    s = s[np.argsort(s["a"], kind="stable")]
    reach = np.maximum.accumulate(s["b"])
    new = np.ones(len(s), dtype=bool)
    new[1:] = s["a"][1:] > reach[:-1]
    first = np.flatnonzero(new)
    out = np.zeros(len(first), _SPAN)
    out["a"], out["b"] = s["a"][first], reach[np.append(first[1:], len(s)) - 1]
    return out


def _kept(raw: bytes, spans: np.ndarray) -> bytes:
    at, out = 0, []
    for a, b in spans.tolist():
        out.append(raw[at:a])
        at = b
    return b"".join(out) + raw[at:]


def _digest(batches):
    for batch in batches:
        sizes, removed, spans, digest = [], [], [], []
        for (_, _, raw), blobs in zip(_texts(batch), batch.column(3).to_pylist()):
            s = _union(blobs)
            sizes.append(len(raw)), spans.append(len(s))
            removed.append(int((s["b"].astype(np.int64) - s["a"]).sum()))
            digest.append(hashlib.sha256(_kept(raw, s)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(4), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(digest, pa.string())], names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cutter(names: list[str], text: str):
    def run(batches):
        col = names.index(text)
        for batch in batches:
            kept = [None if t is None else _kept(t.encode("utf-8", "replace"), _union(s)).decode("utf-8", "ignore")
                    for t, s in zip(batch.column(col).to_pylist(), batch.column("_spans").to_pylist())]
            arrays = [batch.column(i) for i in range(len(names))]
            arrays[col] = pa.array(kept, arrays[col].type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("d"),
                       F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("t"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, h, spans): the repeats of each document that has any, as packed byte ranges that may overlap."""
    spark = docs.sparkSession
    texts = _keyed(docs, key, text)
    size = texts.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    # A part is one table in one task's memory, so their number follows the bytes, not the session alone.
    parts = max(PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    named = texts.mapInArrow(_name_segments(parts), _PACKED)
    first = written(named.groupBy("part").applyInArrow(_refine_buckets, _FOUND), "suffix-buckets")
    asked = first.filter(F.col("kind") == REQUESTS).groupBy("d", "h").agg(F.collect_list("data").alias("asked"))
    wanted = texts.join(asked.hint("shuffle_hash"), ["d", "h"]).select("d", "h", "t", "asked")
    second = wanted.mapInArrow(_fetch(parts), _PACKED).groupBy("part").applyInArrow(_compare, _FOUND)
    return (first.filter(F.col("kind") == SPANS).select("d", "h", "data").union(second.select("d", "h", "data"))
            .groupBy("d", "h").agg(F.collect_list("data").alias("spans")))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; a character that loses a byte is dropped."""
    spans = repeated_spans(docs, key, text).select(F.col("d").alias("_d"), F.col("h").alias("_h"),
                                                   F.col("spans").alias("_spans"))
    same = (F.coalesce(docs[key].cast("long"), F.lit(NULL_ID)) == F.col("_d")) & (F.xxhash64(docs[text]) == F.col("_h"))
    return docs.join(spans.hint("shuffle_hash"), same, "left").mapInArrow(_cutter(docs.columns, text), docs.schema)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``."""
    texts = _keyed(docs, key, text)
    joined = texts.join(repeated_spans(docs, key, text).hint("shuffle_hash"), ["d", "h"], "left").select(
        "d", "h", "t", "spans", F.when(F.col("d") != NULL_ID, F.col("d")).alias("key"))
    return joined.mapInArrow(_digest, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string") \
        .withColumnRenamed("key", key)


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: what is left of every document of ``documents``."""
    return report(read_table(spark, sf_dir, "documents"))
