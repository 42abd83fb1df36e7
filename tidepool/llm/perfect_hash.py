"""Minimal perfect hash over 64-bit keys, in bit levels, with a fingerprint per slot.

Level after level every key left is dealt to one of twice as many positions;
keys alone at their position are settled there (one bit), the others go on.  A
key's slot is the number of bits set before its own, so n keys get the slots
0..n-1 and a lookup costs a few bit tests whatever n is.  Keys that are still
together after MAX_LEVELS (equal hashes) go to a short sorted list.
"""

from __future__ import annotations

import numpy as np

from tidepool.llm.common import ship_by_value

ship_by_value(__name__)

GAMMA = 2
MAX_LEVELS = 40


def spread(h: np.ndarray, level: int) -> np.ndarray:
    """A fresh 64-bit hash of the keys for each level."""
    z = h + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2 ** 64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (spread(h, MAX_LEVELS) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, sizes: np.ndarray, words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = sizes, words, rest
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """``keys``: distinct uint64 hashes (equal ones share a slot)."""
        left, sizes, words = np.unique(keys), [], []
        for level in range(MAX_LEVELS):
            if not len(left):
                break
            m = -(-GAMMA * len(left) // 64) * 64
            at = (spread(left, level) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"), left)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not built in gets -1 or any slot (ask the fingerprint)."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, m in enumerate(self.sizes.tolist()):
            at = (spread(keys[todo], level) % np.uint64(m)).astype(np.int64) + self.base[level]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.rank[at >> 6] + below)[hit]
            todo = todo[~hit]
        if len(self.rest) and len(todo):
            i = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            known = self.rest[i] == keys[todo]
            out[todo[known]] = self.rank[-1] + i[known]
        return out

    def __len__(self) -> int:
        return int(self.rank[-1]) + len(self.rest)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.words), len(self.rest)], dtype="<i8")
        return b"".join(x.tobytes() for x in (head, self.sizes.astype("<i8"), self.words.astype("<u8"),
                                              self.rest.astype("<u8")))

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple["PerfectHash", int]:
        n = np.frombuffer(raw, "<i8", 3).tolist()
        at, parts = 24, []
        for count, kind in zip(n, ("<i8", "<u8", "<u8")):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += 8 * count
        return cls(*parts), at
