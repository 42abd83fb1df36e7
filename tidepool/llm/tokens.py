"""Token ids of whole texts with a public tokenizer file, through a cache of word pieces.

``word_bpe_49k.json`` normalises (NFC, white space, lower case), splits into
pieces that never span white space, and applies BPE to each piece on its own.
So the ids of a text are the ids of its pieces, and a piece seen before need
not be merged again.  Words within Latin-1 are normalised and split here by the
same rules (there NFC changes nothing and lower-casing is one-to-one, which the
tests check against the library over that whole range); every other word goes
through the library whole.  A piece not in the cache is encoded by the library.

The cache lives as long as its Python worker and is emptied at ``CACHE_PIECES``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidepool.llm.common import ship_by_value, worker_state

ship_by_value(__name__)

WORD_BPE = "word_bpe_49k.json"
END_ID = 1                      # the contract's end id, appended to every document
CACHE_PIECES = 1_000_000

_LATIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d"
                    "|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                    "|[^ \\t\\n\\x0b\\x0c\\r\x85\xa0a-z0-9\xaa\xb5\xba\xdf-\xf6\xf8-\xff\xb2\xb3\xb9\xbc-\xbe]+")


class _Pieces(dict):
    """piece -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, model, byte_chars):
        super().__init__()
        self.model, self.byte_chars = model, byte_chars
        self.packed = [i.to_bytes(4, "little") for i in range(1 << 16)]

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.clear()
        shown = piece.encode("utf-8", "replace").decode("latin-1").translate(self.byte_chars)
        out = b"".join([self.packed[t.id] for t in self.model.tokenize(shown)])
        self[piece] = out
        return out


def _byte_chars() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and up, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts under a word-level BPE file, as the library gives them without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        if self.lib.get_vocab_size() > 1 << 16:
            raise ValueError("ids over 16 bits")
        self.pieces = _Pieces(self.lib.model, _byte_chars())
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]

    def encode(self, text: str | None) -> bytes:
        """Unsigned 32-bit little-endian ids of one text."""
        return b"".join(map(self._word, (text or "").split(" ")))

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none) in one array of uint32, and the offsets of the texts in it.

        No piece spans a space, so the words between spaces are encoded once
        per distinct word of the batch.
        """
        words = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), " ")
        coded = words.flatten().dictionary_encode()
        packed = [self._word(w) for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        ids = np.frombuffer(b"".join(packed), dtype="<u4")
        at = coded.indices.to_numpy()
        n = sizes[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        source = np.repeat((np.cumsum(sizes) - sizes)[at] - ends[:-1], n)
        source += np.arange(len(source))
        return ids[source], ends[words.offsets.to_numpy() - words.offsets[0].as_py()]

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.pieces[word.lower()]
        try:
            word.encode("latin-1")
        except UnicodeEncodeError:
            return self._by_library(word)
        if "<" in word and any(s in word for s in self.special):
            return self._by_library(word)
        return b"".join(map(self.pieces.__getitem__, _LATIN.findall(word.lower())))

    def _by_library(self, word: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.lib.encode(word, add_special_tokens=False).ids])


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for ``path`` (default: the public word-level BPE file)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(WORD_BPE)
    return worker_state("encoder:" + path, lambda: Encoder(path))
