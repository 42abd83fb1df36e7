"""Benchmark decontamination with a broadcast set of normalised benchmark n-grams.

Normalisation: A-Z are lower-cased; a word is a run of characters outside
``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F`` (digits, a-z, every non-ASCII character).
A window is ``window`` consecutive words of an item; an item with fewer words,
but not none, is one window.  A document word inside an occurrence of a window
is *hit*.

The windows of the benchmark are word-id tuples over the benchmark's own
vocabulary.  Each worker maps a document's words to those ids, looks up the
rolling hash of every run of known words in the window hash set, and verifies
each hash hit against the window's ids, so no hash collision counts.  The set
is broadcast in blocks of items of at most ``MAX_BLOCK_BYTES`` text; a larger
benchmark takes one pass over the documents per block and the hit intervals
are merged per document, so the answer does not depend on the number of blocks.

Edge cases: null or word-less texts have no words and are never contaminated;
null benchmark texts and items without words have no windows; repeated
documents are judged each on its own; repeated items count by ``item_id``
(items with a null id mark words, but are not listed).  Other columns of the
inputs are ignored by the report and kept untouched by the filters.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import opened, read_table, ship_by_value, shipped, written

ship_by_value(__name__)

WINDOW = 13
MIN_HIT_SHARE = 20              # contaminated: n_hit > 0 and 20 * n_hit >= n_words
MAX_BLOCK_BYTES = 32 << 20      # benchmark text whose windows are broadcast at once
CHUNK_BYTES = 4 << 20           # text scanned at once within one document

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MULT = 0x9E3779B97F4A7C15

SCAN_SCHEMA = ("{key} {key_type}, text_hash long, n_words long, n_hit long, items array<string>, "
               "word_runs array<struct<start:long,stop:long>>, char_spans array<struct<start:long,stop:long>>")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "replace").lower()) if text else []


class WindowSet:
    """The windows of some benchmark items, by length and rolling hash."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.owners: dict[int, dict[tuple, set]] = {}      # length -> window ids -> item ids
        for item_id, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]
            if not ids:
                continue
            n = min(window, len(ids))
            table = self.owners.setdefault(n, {})
            for i in range(len(ids) - n + 1):
                table.setdefault(tuple(ids[i:i + n]), set()).add(item_id)
        self.hashes = {n: np.unique(np.array([self._hash(np.array([w], dtype=np.int64), n)[0] for w in t],
                                             dtype=np.uint64)) for n, t in self.owners.items()}

    @staticmethod
    def _hash(windows: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(windows), dtype=np.uint64)
        for j in range(n):
            out = (out ^ (windows[:, j].astype(np.uint64) + np.uint64(1))) * np.uint64(_MULT)
        return out

    def ids(self, text: str | None) -> np.ndarray:
        """Word ids of a whole text, -1 for words the benchmark does not have."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        raw, out, at, get = text.encode("utf-8", "replace").lower(), [], 0, self.vocab.get
        while at < len(raw):
            end = min(len(raw), at + CHUNK_BYTES)
            while end < len(raw) and _WORD.match(raw, end):    # never cut inside a word
                end = _WORD.match(raw, end).end()
            found = _WORD.findall(raw, at, end)
            out.append(np.fromiter((get(w, -1) for w in found), dtype=np.int32, count=len(found)))
            at = end
        return np.concatenate(out)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, set]:
        """Mask of hit positions over ``ids`` (documents separated by -1) and (position, length, items) hits."""
        mask, found = np.zeros(len(ids) + 1, dtype=np.int32), []
        known = ids >= 0
        for n, table in self.owners.items():
            if len(ids) < n:
                continue
            run = np.concatenate([[0], np.cumsum(known)])
            at = np.flatnonzero(run[n:] - run[:-n] == n)       # starts of n known words
            for lo in range(0, len(at), 1 << 18):
                part = at[lo:lo + (1 << 18)]
                h = self._hash(ids[part[:, None] + np.arange(n)], n)
                sure = np.searchsorted(self.hashes[n], h)
                sure = self.hashes[n][np.minimum(sure, len(self.hashes[n]) - 1)] == h
                for p in part[sure].tolist():
                    owners = table.get(tuple(ids[p:p + n].tolist()))
                    if owners is not None:
                        mask[p] += 1
                        mask[p + n] -= 1
                        found.append((p, owners))
        return np.cumsum(mask[:-1]) > 0, found


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _char_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character spans [first word's start, last word's end) of runs of words."""
    raw, spans, k = text.encode("utf-8", "replace").lower(), [], 0
    for i, m in enumerate(_WORD.finditer(raw)):
        if k == len(runs):
            break
        if i == runs[k][0]:
            start = m.start()
        if i == runs[k][1] - 1:
            spans.append((start, m.end()))
            k += 1
    edges = sorted({x for s in spans for x in s})
    chars, at, n = {}, 0, 0
    for e in edges:
        n += len(raw[at:e].decode("utf-8", "replace"))
        chars[e], at = n, e
    return [(chars[a], chars[b]) for a, b in spans]


def _scanner(share, with_chars: bool):
    def scan(batches):
        windows = opened(share)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            per_doc = [windows.ids(t) for t in texts]
            gap = np.full(1, -1, dtype=np.int32)
            starts = np.cumsum([0] + [len(x) + 1 for x in per_doc])
            flat = np.concatenate([x for ids in per_doc for x in (ids, gap)]) if per_doc else gap
            mask, found = windows.hits(flat)
            items: dict[int, set] = {}
            if found:
                docs = np.searchsorted(starts, [p for p, _ in found], side="right") - 1
                for d, (_, owners) in zip(docs.tolist(), found):
                    items.setdefault(d, set()).update(owners)
            runs = [_runs(mask[starts[i]:starts[i] + len(ids)]) if i in items else []
                    for i, ids in enumerate(per_doc)]
            yield pa.RecordBatch.from_arrays([
                keys, batch.column(2),
                pa.array([len(x) for x in per_doc], pa.int64()),
                pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()),
                pa.array([sorted(str(x) for x in items.get(i, ()) if x is not None)
                          for i in range(len(texts))], pa.list_(pa.string())),
                pa.array([[{"start": a, "stop": b} for a, b in r] for r in runs], _SPANS),
                pa.array([[{"start": a, "stop": b} for a, b in _char_spans(t, r)] if with_chars and r else []
                          for t, r in zip(texts, runs)], _SPANS),
            ], names=["key", "text_hash", "n_words", "n_hit", "items", "word_runs", "char_spans"])
    return scan


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _blocks(benchmark: DataFrame, item_id: str, text: str):
    """Items in blocks of bounded text, read through an iterator (one partition at a time).

    Two blocks at most are in the driver: the one in work and the one read ahead.
    """
    block, size = [], 0
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).filter("t is not null")
    for row in rows.toLocalIterator():
        block.append((row.i, row.t))
        size += len(row.t.encode("utf-8", "replace"))
        if size >= MAX_BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
         with_chars: bool = True) -> DataFrame:
    """One row per document row: key, n_words, n_hit, items (ids as sorted strings), hit word runs, character spans."""
    return _scan(docs, _blocks(benchmark, item_id, item_text), key, text, window, with_chars).drop("text_hash")


def _scan(docs: DataFrame, blocks, key: str, text: str, window: int, with_chars: bool) -> DataFrame:
    """Hits of one block in one pass; of several, each pass is written before the next block is read."""
    spark = docs.sparkSession
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("text_hash"))
    schema = SCAN_SCHEMA.format(key="key", key_type=slim.schema["key"].dataType.simpleString())
    blocks, parts = iter(blocks), []
    block, ahead = next(blocks, []), next(blocks, None)
    while True:
        share = shipped(spark, WindowSet(block, window))
        part = slim.mapInArrow(_scanner(share, with_chars), schema)
        if ahead is None and not parts:
            return part.withColumnRenamed("key", key)
        parts.append(written(part, "benchmark-hits"))
        share.destroy()
        if ahead is None:
            return _merge_blocks(parts).withColumnRenamed("key", key)
        block, ahead = ahead, next(blocks, None)


def _merge_blocks(parts: list[DataFrame]) -> DataFrame:
    """Union of the hits over the blocks of a large benchmark: a few small rows per document."""
    rows = parts[0].withColumn("block", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        rows = rows.unionByName(p.withColumn("block", F.lit(i)))
    none = F.array().cast("array<struct<start:long,stop:long>>")

    def union(col):
        last = lambda acc: F.element_at(acc, -1)
        return F.aggregate(F.array_sort(F.flatten(F.collect_list(col))), none, lambda acc, x: F.when(
            (F.size(acc) > 0) & (last(acc)["stop"] >= x["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                last(acc)["start"].alias("start"), F.greatest(last(acc)["stop"], x["stop"]).alias("stop")))))
            .otherwise(F.concat(acc, F.array(x))))
    one = rows.groupBy("key", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.count_if(F.col("block") == 0).alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        union("word_runs").alias("word_runs"), union("char_spans").alias("char_spans"))
    one = one.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return one.select("key", "text_hash", "n_words",
                      F.aggregate("word_runs", F.lit(0).cast("long"),
                                  lambda a, x: a + x["stop"] - x["start"]).alias("n_hit"),
                      "items", "word_runs", "char_spans")


def contaminated(min_hit_share: int = MIN_HIT_SHARE):
    return (F.col("n_hit") > 0) & (F.lit(min_hit_share) * F.col("n_hit") >= F.col("n_words"))


def _cleaner(share, mode: str, names: list[str], text: str, min_hit_share: int):
    def clean(batches):
        windows, col = opened(share), names.index(text)
        for batch in batches:
            texts, keep = batch.column(col).to_pylist(), []
            for i, t in enumerate(texts):
                ids = windows.ids(t)
                mask, found = windows.hits(ids)
                n_hit = int(mask.sum()) if found else 0
                bad = n_hit > 0 and min_hit_share * n_hit >= len(ids)
                keep.append(mode == "spans" or not bad)
                if mode == "spans" and n_hit:
                    texts[i] = _without(t, _char_spans(t, _runs(mask)))
            if mode == "spans":
                batch = batch.set_column(col, batch.schema.field(col), pa.array(texts, batch.schema.field(col).type))
            yield batch.filter(pa.array(keep, pa.bool_()))
    return clean


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", key: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  min_hit_share: int = MIN_HIT_SHARE) -> DataFrame:
    """``docs`` without contaminated documents, or (``mode="spans"``) with every hit run cut out of its text.

    One map pass and no shuffle: a document's hits are found where it is.
    A benchmark of several blocks needs its hits merged first, so there the
    verdicts and spans come back by a join on (key, hash of the text).
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode must be documents or spans, not {mode}")
    blocks = _blocks(benchmark, item_id, item_text)
    block, ahead = next(blocks, []), next(blocks, None)
    if ahead is None:
        share = shipped(docs.sparkSession, WindowSet(block, window))
        return docs.mapInArrow(_cleaner(share, mode, docs.columns, text, min_hit_share), docs.schema)
    found = _scan(docs, itertools.chain([block, ahead], blocks), key, text, window, mode == "spans").filter(
        contaminated(min_hit_share) if mode == "documents" else F.col("n_hit") > 0)
    found = found.select(F.col(key).alias("_hit_key"), F.col("text_hash").alias("_hit_hash"),
                         F.col("char_spans").alias("_hit_spans")).distinct()
    same = docs[key].eqNullSafe(F.col("_hit_key")) & (F.xxhash64(docs[text]) == F.col("_hit_hash"))
    if mode == "documents":
        return docs.join(found, same, "left_anti")
    joined, names = docs.join(found, same, "left"), docs.columns
    return joined.mapInArrow(_cutter(names, text), docs.schema)


def _cutter(names: list[str], text: str):
    def cut(batches):
        col = names.index(text)
        for batch in batches:
            spans, texts = batch.column(batch.schema.get_field_index("_hit_spans")).to_pylist(), batch.column(col)
            kept = [_without(t, [(s["start"], s["stop"]) for s in sp]) if sp else t
                    for t, sp in zip(texts.to_pylist(), spans)]
            arrays = [batch.column(i) for i in range(len(names))]
            arrays[col] = pa.array(kept, texts.type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return cut


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    at, out = 0, []
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return "".join(out) + text[at:]


def items_digest(items):
    return F.sha2(F.array_join(items, ","), 256)


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contract query: hit counts and verdict of every document of ``documents``."""
    found = scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), with_chars=False)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        items_digest(F.col("items")).alias("items_sha256"),
                        contaminated().alias("contaminated"))

