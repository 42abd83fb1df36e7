import hashlib
import re

import pytest

from tidepool.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return WORD.findall(low)


def brute(docs, items, n=13):
    out = []
    for key, text in docs:
        w, hit, owners = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            k = min(n, len(p))
            if not k:
                continue
            for win in {tuple(p[i:i + k]) for i in range(len(p) - k + 1)}:
                for i in range(len(w) - k + 1):
                    if tuple(w[i:i + k]) == win:
                        hit.update(range(i, i + k))
                        owners.add(str(item))
        out.append((key, len(w), len(hit), len(owners), hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEM = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
ITEMS = [(1, ITEM), (10, "Été ÉCOLE"), (2, None), (3, " ?! "), (10, "alpha beta"), (None, "gamma")]
DOCS = [
    (1, None), (2, ""), (3, "...?"), (4, ITEM.upper() + "!"), (5, "x " * 900 + ITEM), (6, "a Été École b"),
    (6, "a Été École b"), (7, "alpha-beta " * 3), (None, "gamma ray"), (8, "one two three four five"),
    (9, "alphabeta alpha betas"), (11, ("word " * 300 + ITEM + " ") * 20), (12, "Été écolE"),
]


def report(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]),
                    hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
                    r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [D.MAX_BLOCK_BYTES, 1])
def test_equals_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(D, "MAX_BLOCK_BYTES", block)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute(DOCS, [(i, t) if i is not None else ("", t) for i, t in ITEMS if i is not None])
    got = report(D.scan(docs_of(DOCS), bench))
    # An item without an id marks words and is not listed.
    want = [(k, n, 1, 0, h, True) if k is None else (k, n, m, c, h, b) for k, n, m, c, h, b in want]
    assert got == sorted(want, key=str)


def test_query_on_driver_tables(spark, sf, sf_texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = [tuple(r) for r in D.op1_decontamination(spark, sf).collect()]
    assert sorted(got, key=str) == brute(sf_texts, items)


def test_small_chunks_cut_between_words(monkeypatch):
    monkeypatch.setattr(D, "CHUNK_BYTES", 3)
    s = D.WindowSet([(1, ITEM)], 13)
    text = "zz " + ITEM + " école"
    assert s.ids(text).tolist() == [-1] + list(range(15)) + [-1]


@pytest.mark.parametrize("block", [D.MAX_BLOCK_BYTES, 1])
def test_documents_and_spans_are_removed(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(D, "MAX_BLOCK_BYTES", block)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(DOCS)
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    bad = {str(r[0]) for r in brute(DOCS, ITEMS) if r[-1]}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in DOCS if str(i) not in bad)
    cut = {r.doc_id: r.text for r in D.decontaminate(docs, bench, "spans").collect()}
    assert cut[4] == "!" and cut[6] == "a  b" and cut[1] is None and cut[9] == "alphabeta alpha betas"
    assert cut[5] == "x " * 900 and cut[11] == ("word " * 300 + " ") * 20


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in D.scan(docs_of([(1, "a b")]), none).collect()] == [0]
    assert D.scan(docs_of([(1, "a")]).limit(0), none).count() == 0
    with pytest.raises(ValueError):
        D.decontaminate(docs_of([(1, "a")]), none, "words")


def test_benchmark_of_many_blocks_is_taken_one_at_a_time(spark, docs_of, monkeypatch):
    items = [(i, " ".join(f"b{i}w{k}" for k in range(20))) for i in range(12)]
    docs = docs_of([(i, f"start {t} end") for i, t in items[:9]] + [(50, "clean words only " * 20), (51, None)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, D.scan(docs, bench).collect()))
    kept = sorted(r.doc_id for r in D.decontaminate(docs, bench).collect())
    seen = []
    real = D.WindowSet

    class Counted(real):
        def __init__(self, block, window):
            seen.append(len(block))
            super().__init__(block, window)
    monkeypatch.setattr(D, "MAX_BLOCK_BYTES", 250)
    monkeypatch.setattr(D, "WindowSet", Counted)
    assert sorted(map(str, D.scan(docs, bench).collect())) == whole and len(seen) > 3 and max(seen) <= 3
    assert sorted(r.doc_id for r in D.decontaminate(docs, bench).collect()) == kept == [50, 51]


def test_workers_need_no_install(tmp_path):
    """The queries run where workers cannot import this package."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from tidepool.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)
def there(_):
    try:
        import tidepool
        return [True]
    except ImportError:
        return [False]
assert not any(spark.sparkContext.parallelize(range(2), 2).mapPartitions(there).collect())
import __spark_entry__ as E
for name in ("op1_decontamination", "op2_secret_scan"):
    print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and "op1_decontamination 200" in done.stdout, done.stderr[-2000:]
