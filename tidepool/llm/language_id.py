"""Language identification by compression with per-language zstandard dictionaries.

Each language has a raw-content dictionary: all words of the whole texts of a
bounded sample of its labelled rows.  A text that is judged is reduced to its words (runs of letters,
lower-cased), each once, so that repeated lines do not drown the rest (measured: this
decides held-out texts better than compressing every repeat, see README), and cut
into blocks of ``BLOCK_BYTES`` so that all of them are judged against the
dictionary; each block is compressed once per language, and the language with
the smallest total wins (ties: the smaller name).  The score is the relative margin
to the runner-up, ``(second - best) / second``, between 0 and 1.  Texts with a
margin below ``min_margin`` are rejected, as are those without a letter.

Edge cases: null text, and text without a letter, gives ``und``, score 0 and is
rejected; without any labelled row, and so in an empty table, everything is ``und``; of more than
``MAX_LANGUAGES`` languages the most frequent are learned; other columns, whatever their names, are ignored
by ``predict`` and kept by ``keep_identified``; with one learned
language the runner-up is compression without a dictionary.  Rows are judged
one by one, so repeated rows agree.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import read_table, ship_by_value

ship_by_value(__name__)

UNKNOWN = "und"
SAMPLE_DOCS = 256               # labelled texts per language that the dictionary is taken from, by hash of the key
MAX_LANGUAGES = 256             # bound of the broadcast model: the words of at most 256 * 256 texts
BLOCK_BYTES = 2_048
LEVEL = 3
MIN_MATCH = 3                   # short matches: languages differ in their syllables
MIN_MARGIN = 0.01

_LETTERS = re.compile(r"[^\W\d_]+")


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Language -> dictionary content, from a bounded sample of the rows with a text and a language."""
    rows = (labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
            .filter("t is not null and l is not null"))
    counts = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r.l: r.n for r in counts.orderBy(F.desc("n"), "l").limit(MAX_LANGUAGES).collect()}
    # Rows beyond one and a half times the share that is wanted of their language
    # are dropped where they are read; only the others carry their text on.
    share = F.lit(0.0)
    for name, n in sorted(sizes.items()):
        share = F.when(F.col("l") == name, F.lit(min(1.0, 1.5 * SAMPLE_DOCS / n))).otherwise(share)
    u = F.shiftrightunsigned(F.xxhash64("k", F.lit(19)), 11) / float(1 << 53)
    order = Window.partitionBy("l").orderBy("u", "k", F.xxhash64("t"), "t")
    sample = (rows.withColumn("u", u).filter(F.col("u") < share)
              .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_DOCS))
    found: dict[str, list] = {}
    for r in sample.select("l", "rank", "t").toLocalIterator():
        found.setdefault(r.l, []).append((r.rank, " ".join(_LETTERS.findall(r.t.lower())).encode("utf-8", "replace")))
    return {l: b" ".join(w for _, w in sorted(rows)) for l, rows in found.items()}


def _words(text: str) -> bytes:
    return " ".join(dict.fromkeys(_LETTERS.findall(text.lower()))).encode("utf-8", "replace")


def _compressors(model: dict[str, bytes]):
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MIN_MATCH, write_checksum=0,
                                                         write_content_size=0)
    out = {}
    for name, content in sorted(model.items()):
        d = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=how)
        out[name] = zstandard.ZstdCompressor(dict_data=d, compression_params=how)
    if len(out) == 1:
        out[UNKNOWN] = zstandard.ZstdCompressor(compression_params=how)
    return out


def classify(text: str | None, compressors: dict) -> tuple[str, float]:
    if not text or not compressors or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    raw = _words(text)
    blocks = [raw[i:i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), name) for name, c in compressors.items())
    if not sizes[0][0]:             # letters, but no word that survives normalisation
        return sizes[0][1], 0.0
    best, second = sizes[0], sizes[1]
    if best[1] == UNKNOWN:          # one language, and it does not help
        return second[1], 0.0
    return best[1], (second[0] - best[0]) / second[0]


def _predictor(share):
    def run(batches):
        compressors = _compressors(share.value)
        for batch in batches:
            got = [classify(t, compressors) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["key", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: dict[str, bytes], key: str = "doc_id", text: str = "text",
            min_margin: float = MIN_MARGIN) -> DataFrame:
    """(key, lang_pred, score, rejected) per row of ``docs``; only the text is looked at."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("t"))
    share = docs.sparkSession.sparkContext.broadcast(model)
    out = slim.mapInArrow(_predictor(share), f"key {slim.schema['key'].dataType.simpleString()}, "
                                             "lang_pred string, score double")
    return out.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_margin)) \
        .withColumnRenamed("key", key)


def _filter(share, col: int, min_margin: float):
    def run(batches):
        compressors = _compressors(share.value)
        for batch in batches:
            got = [classify(t, compressors) for t in batch.column(col).to_pylist()]
            yield batch.filter(pa.array([n != UNKNOWN and s >= min_margin for n, s in got], pa.bool_()))
    return run


def keep_identified(docs: DataFrame, model: dict[str, bytes], text: str = "text",
                    min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` without the rows that are rejected, in one map pass."""
    share = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_filter(share, docs.columns.index(text), min_margin), docs.schema)


def held_out(key: str = "doc_id") -> Column:
    """The evaluation fold: crc32 of the id as text, mod 5, is 0 (a null id is not in it)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame) -> dict[str, bytes]:
    return fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query: predicted language of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    return predict(docs, learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
