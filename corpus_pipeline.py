"""Corpus cleaning and packing: ``documents`` to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what the next one gets, with
the columns of ``documents``; the last returns the packed pieces.  The learning
stages fit on the documents they are given.

Edge cases, by stage: a null or empty text, or one without a letter, has no
language and goes in the first; rows without an id stay in the second, and rows
of one id are decided each; a text without words is clean and without secrets;
a null path counts as none.  Further columns, whatever their names, pass through
all but the last.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import decontaminate, language_id, packing, secret_scan, simhash
from tidepool.llm.common import bounded_batches, read_table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the others go."""
    bounded_batches(spark)
    return language_id.keep_identified(docs, language_id.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    bounded_batches(spark)
    return simhash.keep_one_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not repeat benchmark passages."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    bounded_batches(spark)
    prose, forest = secret_scan.learn(docs)
    return secret_scan.redact(docs, prose, forest)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    bounded_batches(spark)
    return packing.digests(packing.pack(docs))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]

# Compression, fingerprints, a trained forest and tokenizer ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
