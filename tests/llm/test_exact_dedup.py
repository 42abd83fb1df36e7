import hashlib
import os
import re

import duckdb
from pyspark.sql import functions as F

from tidepool.llm import exact_dedup as X
from tidepool.llm.common import shared_uri


def norm(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


def brute(pairs):
    by = {}
    for i, t in pairs:
        by.setdefault(norm(t), []).append(i)
    out = []
    for t, ids in by.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        left = 1
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), i == keep and left > 0, hashlib.sha256(t.encode()).hexdigest()))
            left -= i == keep
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()), key=str)


PAIRS = [(1, "a  b"), (2, "a\tb"), (3, "a\n\x0b\x0c\r b"), (4, " a b"), (5, None), (6, ""), (7, " "), (8, "\t"), (None, "a b"), (None, "n"), (None, "n"),
         (9, "a b"), (10, "x" * 300_000), (11, "x" * 300_000), (12, "x" * 299_999 + "y"), (13, "dup"), (13, "dup"), (13, "other"), (0, "é"), (14, "é ")]


def test_classes_and_edge_cases(spark, docs_of):
    assert rows_of(X.deduplicate(docs_of(PAIRS))) == brute(PAIRS)


def test_one_text_in_a_third_of_all_rows_goes_over_several_owners(spark, docs_of):
    pairs = [(i, f"text {i % 150}") for i in range(400)] + [(1000 - i, "hot\t\ttext") for i in range(300)] + [(None, "hot text")] * 5
    owned = X.owned_rows(docs_of(pairs, 6), X.new_folder(spark), owners=9)
    hot = hashlib.sha256(b"hot text").digest()
    assert owned.where(F.col("digest") == F.lit(hot)).select("owner").distinct().count() > 2
    assert rows_of(X.classes(owned)) == brute(pairs)


def test_repeated_rows_of_one_id_keep_one(spark, docs_of):
    pairs = [(5, "same")] * 200 + [(6, "same")] * 10 + [(7, f"t{i}") for i in range(50)]
    assert rows_of(X.deduplicate(docs_of(pairs, 7), owners=8)) == brute(pairs)


def test_colliding_hashes_are_chained_and_compared(spark, docs_of):
    pairs = [(i, f"t {i % 40}") for i in range(200)]
    got = X.deduplicate(docs_of(pairs), owners=3, bucket_keys=2, segment_bytes=64, key_hash=F.length("t").cast("long"))
    assert rows_of(got) == brute(pairs)


def test_directory_doubles_and_segments_are_read_back(tmp_path, monkeypatch):
    monkeypatch.setattr(X, "MAX_DEPTH", 12)
    texts = X.TextFiles(f"file://{tmp_path}", "own", segment_bytes=50, cache_bytes=100)
    index = X.ExtendibleIndex(texts, bucket_keys=3)
    keys = [(i * 2654435761) % 2 ** 64 for i in range(200)] + [8, 8 + 2 ** 60, 8 + 2 ** 61, 8 + 2 ** 62, 8 + 2 ** 63]
    first = [index.insert(h, f"text {h}".encode(), bytes(32)) for h in keys]
    assert first == list(range(len(keys))) and index.depth > 5
    assert [index.insert(h, f"text {h}".encode(), bytes(32)) for h in keys] == first
    assert index.insert(keys[0], b"another", bytes(32)) == len(keys)
    assert all(len(b.keys) <= 3 or b.depth == 12 for b in index.directory) and set(index.rows) == {1, 2}
    for i, b in enumerate(index.directory):
        assert all(h & ((1 << b.depth) - 1) == i & ((1 << b.depth) - 1) for h in b.keys)
    texts.flush()
    assert len(os.listdir(tmp_path)) > 3
    with open(tmp_path / "i.idx", "wb") as f:
        f.write(index.to_bytes())
    again = X.WrittenIndex(f"file://{tmp_path}", "i.idx")
    assert all(again.find(h, f"text {h}".encode()) == bytes(32) for h in keys)
    assert again.find(keys[1], b"another") is None and again.find(12345, b"x") is None


def test_lookup_against_a_written_index(spark, docs_of):
    folder = X.new_folder(spark)
    owned = X.owned_rows(docs_of(PAIRS), folder, owners=4)
    asked = [(i, t) for i, t in PAIRS] + [(50, "new"), (51, "A b"), (None, None)]
    got = {(r.id, r.known) for r in X.lookup(docs_of(asked), owned, folder).collect()}
    texts = {norm(t) for _, t in PAIRS}
    assert got == {(i, norm(t) in texts) for i, t in asked}


def test_drop_copies_keeps_all_columns(spark, docs_of):
    df = docs_of(PAIRS)
    out = X.drop_copies(df)
    assert out.columns == df.columns
    kept = [(i, t) for i, _, _, k, t in brute(PAIRS) if k]
    assert sorted(((r.doc_id, hashlib.sha256(norm(r.text).encode()).hexdigest()) for r in out.collect()), key=str) == sorted(kept, key=str)


def test_empty_table(spark, docs_of):
    assert X.deduplicate(docs_of(PAIRS).limit(0)).count() == 0


def test_folders_carry_the_scheme_spark_would_use(spark, tmp_path):
    assert shared_uri(spark, str(tmp_path)) == f"file://{tmp_path}"


def test_query_equals_sql(spark, sf):
    got = sorted(tuple(r) for r in X.op13_exact_dedup(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(con.execute(X.OP13_SQL).fetchall())


