import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepool.llm import simhash as S
from tidepool.llm.components import connected_components


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]


def slow_print(t):
    w = words(t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_parts(pairs):
    """pairs: (node, fingerprint) -> node -> smallest node reachable within 3 bits per link."""
    up = {n: n for n, _ in pairs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, (a, f) in enumerate(pairs):
        for b, g in pairs[:i]:
            if (f ^ g).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {n: root(n) for n, _ in pairs}


BASE = " ".join(f"w{i}" for i in range(400))
DOCS = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "a b"), (7, "A B c D a b c d"), (8, BASE),
        (9, BASE + " x"), (9, BASE + " x"), (10, BASE + " y z"), (11, "   é É"), (None, BASE),
        (12, "rep " * 5000), (13, BASE.upper())]


def test_equals_brute_force(docs_of, sf_texts):
    pairs = DOCS + [(i + 100, t) for i, t in sf_texts]
    got = S.near_duplicates(docs_of(pairs)).collect()
    assert len(got) == len(pairs)
    prints = {i: slow_print(t) for i, t in pairs}
    parts = slow_parts([(i, f) for i, f in prints.items() if i is not None])
    for r in got:
        assert r.fp & (2 ** 64 - 1) == prints[r.doc_id]
        assert r.component_id == parts.get(r.doc_id)
    assert parts[9] == 8 and parts[13] == 8 and parts[3] == 1


def test_one_document_of_each_group_stays(docs_of):
    docs = docs_of(DOCS)
    got = S.keep_one_each(docs)
    assert got.columns == docs.columns
    parts = slow_parts(list({i: slow_print(t) for i, t in DOCS if i is not None}.items()))
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted([str(x) for x in set(parts.values())] + ["None"])
    assert S.near_duplicates(docs.limit(0)).count() == 0
    assert S.keep_one_each(docs.limit(0)).count() == 0


def _joined(prints, spark, monkeypatch, leaves):
    monkeypatch.setattr(S, "MAX_LEAVES", leaves)
    rows = [(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(prints)]
    links = S.near_links(spark.createDataFrame(rows, "fp long, node long"))
    got = {r.node: r.component for r in connected_components(links).collect()}
    return {i: got.get(i, i) for i in range(len(prints))}


def test_trie_join_with_dense_regions(spark, monkeypatch):
    rng = random.Random(3)
    prints = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(8):
            prints.add(f)
            for _ in range(rng.randrange(1, 5)):
                f ^= 1 << rng.randrange(64)
    hot = rng.getrandbits(64)                # most of the rows share 50 bits: the cut goes past the histogram
    prints |= {hot ^ rng.getrandbits(14) for _ in range(300)}
    prints = sorted(prints)
    want = slow_parts(list(enumerate(prints)))
    assert _joined(prints, spark, monkeypatch, 16) == want
    assert _joined(prints, spark, monkeypatch, 4096) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=40, unique=True), st.integers(0, 2 ** 64 - 1),
       st.lists(st.integers(0, 2 ** 12 - 1), max_size=40, unique=True))
def test_pairs_of_one_trie(some, base, near):
    fp = np.array(sorted({*some, *((base & ~0xFFF) | n for n in near)}), dtype=np.uint64)
    got = sorted((int(a), int(b)) for u, v in S.trie_pairs(fp, None, 0, 0, 3) for a, b in zip(u, v))
    assert got == [(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp))
                   if (int(fp[i]) ^ int(fp[j])).bit_count() <= 3]


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 150), (5, 5)]
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}
    assert connected_components(df.limit(0)).count() == 0


def test_rows_of_one_id_are_decided_each(docs_of):
    """Two texts under one id both stay unless another row is near them; a copy under a larger id goes."""
    words = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(4)]
    docs = docs_of([(1, words[0]), (1, words[1]), (2, words[1]), (3, words[2]), (3, words[2]), (0, words[3]), (4, words[0] + " "), (None, words[0])])
    got = sorted((str(r.doc_id), r.text) for r in S.keep_one_each(docs).collect())
    assert got == sorted([("1", words[0]), ("1", words[1]), ("3", words[2]), ("0", words[3]), ("None", words[0])])
