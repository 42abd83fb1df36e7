import hashlib
import random

import numpy as np
import pytest

from tidepool.llm import suffix_buckets as sb
from tidepool.llm import suffix_dedup as S


def brute(pairs, n=sb.LENGTH):
    """pairs (id, text) -> {(id, text): (n_bytes, n_removed, n_spans, sha)}; no rule of ties is needed but (id, hash)."""
    seen, out = set(), {}
    for key, text in pairs:
        raw = (text or "").encode()
        if (key, text) in out:
            continue
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - n + 1):
            w = raw[i:i + n]
            if w in seen:
                gone[i:i + n] = True
            seen.add(w)
        runs = int((np.diff(gone.astype(int)) == 1).sum() + (gone[0] if len(raw) else 0))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[key, text] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def cases(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = text(120), text(30)
    out = [(0, base), (1, None), (2, ""), (3, "x" * 99), (4, "y" * 100), (5, "y" * 101), (6, "ab" * 400), (7, base),
           (7, base), (None, passage + " " + text(20)), (8, base[:300] + "#" + base[300:]), (9, base[50:149]),
           (10, base[50:150]), (11, text(5) + base[-150:]), (12, "z" + base), (13, passage * 3)]
    out += [(20 + i, text(rng.randrange(0, 40)) + passage[:rng.randrange(60, 160)] + text(12)) for i in range(40)]
    return out


@pytest.mark.parametrize("hot,local,piece", [(1024, 128, 1 << 18), (3, 128, 1 << 18), (3, 1, 500)])
def test_equals_brute_force(spark, docs_of, monkeypatch, hot, local, piece):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "LOCAL_HOT", local)
    monkeypatch.setattr(sb, "PIECE", piece)
    pairs = cases()
    want = brute(sorted(pairs, key=lambda p: -1 if p[0] is None else p[0]))
    assert result(S.report(docs_of(pairs))) == sorted(((k, *want[k, t]) for k, t in pairs), key=str)


def test_query_on_driver_tables(spark, sf, sf_texts):
    want = brute(sorted(sf_texts))
    assert result(S.op8_suffix_dedup(spark, sf)) == sorted(((k, *want[k, t]) for k, t in sf_texts), key=str)


def test_texts_are_cut(spark, docs_of):
    docs = docs_of(cases())
    got = {r.doc_id: r.text for r in S.deduplicate(docs).collect()}
    assert S.deduplicate(docs).columns == docs.columns
    assert got[10] == "" and got[1] is None and got[4] == "y" * 100 and got[3] == "x" * 99
    assert S.report(docs.limit(0)).count() == 0


def test_classes_of_offsets():
    raw = np.frombuffer(b"abc" * 60 + b"q" * 120, dtype=np.uint8)
    left = np.concatenate([np.arange(180, 0, -1), np.arange(120, 0, -1)])
    at, cls = sb_classes = S.exact_classes(raw, left)
    assert set(at.tolist()) == {*range(0, 81), *range(180, 201)}
    assert len(set(cls.tolist())) == 4 and len(sb_classes) == 2


def test_segments_cover_every_window_once():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 100, 3000).astype(np.uint8)
    starts, stops = np.array([0, 50, 149, 1200]), np.array([50, 149, 1200, 3000])
    s = sb.Segments(raw, starts, stops)
    got = sorted((t, i) for t, a, n in zip(s.text, s.start, s.windows) for i in range(a, a + n))
    assert got == [(t, i) for t in range(4) for i in range(starts[t], stops[t] - 99)]
    assert s.windows.max() <= sb.SPAN
