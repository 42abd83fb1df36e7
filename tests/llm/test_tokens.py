import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidepool.llm import packing as P
from tidepool.llm import token_store as S
from tidepool.llm import tokens
from tidepool.llm.perfect_hash import PerfectHash, fingerprints


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, dtype="<u4").tobytes()


def odd_texts(n=400):
    rng = random.Random(2)
    pools = [range(256), [*range(32, 127), 39, 115, 116, 32], range(0x300, 0x370), [0x3A3, 0x130, 0x2028, 0x200D, 0x85]]
    return ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_ids_equal_the_library(library, sf_texts):
    texts = odd_texts() + [t for _, t in sf_texts[:60]] + [
        None, "", " ", "a <|endoftext|> b<|startoftext|>", "it's we'LL 'tis", "ﬁ Å Å", "日本 語 ٣", "x" * 30_000]
    e = tokens.encoder()
    ids, at = e.encode_batch(pa.array(["skip", *texts]).slice(1))
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == ids_of(library, t) == np.frombuffer(e.encode(t), "<u4").tolist(), t


def test_cache_is_bounded(monkeypatch, library):
    import public_tokenizers
    monkeypatch.setattr(tokens, "CACHE_PIECES", 10)
    e = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    assert np.frombuffer(e.encode(text), "<u4").tolist() == ids_of(library, text) and len(e.pieces) <= 10


@pytest.mark.parametrize("capacity", [2048, 16, 7, 1])
def test_cuts(capacity):
    for n in range(0, 3 * capacity + 1):
        pieces = P.cut(n, capacity)
        assert sum(s for s, _ in pieces) == n and all(s > 0 for s, _ in pieces)
        for s, k in pieces:
            assert k * s <= capacity and k * s >= capacity * (1 - P.MAX_WASTE) - k


DOCS = [(1, "one two three"), (2, None), (3, ""), (3, "three"), (3, "three"), (None, "no id"), (None, None),
        (4, "word " * 9_000), (5, "a"), (-6, "minus")] + [(100 + i, "t " * (i * 7 % 300)) for i in range(150)]


def check_pieces(rows, docs, library, capacity):
    """Every id once, no gaps in sequences; the padding."""
    streams, sequences = {}, {}
    for r in rows:
        streams.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, r.length, bytes(r.ids)))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = {}
    for k, t in docs:
        ids = ids_of(library, t) + [1]
        want.setdefault((str(k), len(ids)), []).append(raw(ids))
    for key, texts in want.items():
        got = sorted(streams[key])
        assert sum(n for _, n, _ in got) == sum(len(t) // 4 for t in texts)
        if len(texts) == 1:
            assert b"".join(b for _, _, b in got) == texts[0]
            assert [a for a, _, _ in got] == [sum(n for _, n, _ in got[:i]) for i in range(len(got))]
    padding = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        total = sum(n for _, n in parts)
        assert total <= capacity
        padding += 0 if total & (total - 1) == 0 else capacity - total
    return padding


def test_packing(docs_of, library):
    docs = docs_of(DOCS)
    rows = P.pack(docs).collect()
    tokens_ = sum(r.length for r in rows)
    assert check_pieces(rows, DOCS, library, P.CAPACITY) <= tokens_ / 64
    assert len({r.sequence_id for r in rows}) < len(DOCS)
    assert P.pack(docs.limit(0)).count() == 0


def test_packing_query(spark, sf, sf_texts, library):
    want = {k: ids_of(library, t) + [1] for k, t in sf_texts}
    got = {}
    for r in P.op5_packing(spark, sf).collect():
        assert r.ids_crc32 == zlib.crc32(raw(want[r.doc_id][r.start:r.start + r.length]))
        assert r.doc_tokens == len(want[r.doc_id])
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {k: len(v) for k, v in want.items()}


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 63, 5_000):
        keys = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        mph, _ = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
        assert sorted(mph.slots(keys).tolist()) == list(range(n)) and len(mph) == n
        assert len(fingerprints(keys)) == n


def test_equal_hashes_and_unknown_keys(monkeypatch):
    monkeypatch.setattr("tidepool.llm.perfect_hash.MAX_LEVELS", 1)
    keys = np.arange(1, 300, dtype=np.uint64)
    mph = PerfectHash.build(keys)
    assert len(mph.rest) and sorted(mph.slots(keys).tolist()) == list(range(299))
    index = S.Index(S.index_bytes([1, 2, 2, None], [0, 5, 6, 9], [5, 1, 3, 2]))
    known, slots = index.find(np.array([S.key_hash(k) for k in (2, 77, None)], dtype=np.uint64))
    assert known.tolist() == [True, False, True] and slots["start"].tolist() == [5, 9] and slots["docs"].tolist() == [2, 1]


def test_store_round_trip(spark, docs_of, library, tmp_path):
    docs = docs_of(DOCS)
    folder = str(tmp_path / "store")
    manifest = S.write(docs, folder, shards=5)
    got = sorted(((str(r.doc_id), r.start, bytes(r.ids)) for r in S.read(docs, folder, manifest).collect()),
                 key=lambda r: r[1])
    at = 0
    for _, start, ids in got:                       # all ids, in one order without gaps
        assert start == at
        at += len(ids) // 4
    assert [k for k, *_ in got] == [str(k) for k in sorted((k for k, _ in DOCS), key=lambda k: -99 if k is None else k)]
    assert sorted((k, i) for k, _, i in got) == sorted((str(k), raw(ids_of(library, t) + [1])) for k, t in DOCS)
    one = S.read(spark.createDataFrame([(4,), (4,), (12345,)], "doc_id long"), folder, manifest).collect()
    assert len(one) == 1 and one[0].n_tokens == 9_001 and one[0].ids_crc32 == zlib.crc32(one[0].ids)
    assert S.write(docs.limit(0), str(tmp_path / "none")) == []
    assert S.read(docs, str(tmp_path / "none"), []).count() == 0


def test_store_query(spark, sf, sf_texts, library):
    want, at = {}, 0
    for k, t in sorted(sf_texts):
        ids = ids_of(library, t) + [1]
        want[k] = (at, len(ids), zlib.crc32(raw(ids)))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in S.op9_token_store(spark, sf).collect()} == want
