"""Bucket identifiers of the byte strings at every offset of a buffer, by bucket-pointer refinement.

The bucket of an offset under its first 8 bytes is the 8-gram itself.  A bucket
of twice the depth is named by the bucket at the offset and the bucket at the
offset as many bytes later, so each refinement reuses the identifiers of the
one before: 8 -> 16 -> 32 -> 64 -> 100 (64 and 64 at 36 bytes later).  The names
are 64-bit mixes of the two identifiers, the same in every task, so buckets of
different tasks are compared by a shuffle of names instead of a shared rank.
"""

from __future__ import annotations

import numpy as np

from tidepool.llm.common import ship_by_value

ship_by_value(__name__)

LENGTH = 100                    # bytes of a repeated string
Q = 32                          # depth at which the anchors are chosen
SPAN = LENGTH - Q + 1           # offsets of a window that can be its anchor
PIECE = 1 << 18                 # offsets handled at once; a longer text is cut into pieces
_POS_BITS = 20

# Odd multipliers of two independent families of names.
_A = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_B = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def mix(x: np.ndarray, y: np.ndarray, family: int = 0) -> np.ndarray:
    """Name of the pair of identifiers (x, y)."""
    z = x * _A[family]
    z ^= z >> np.uint64(32)
    z += y
    z *= _B[family]
    z ^= z >> np.uint64(29)
    return z


def grams(buf: np.ndarray) -> np.ndarray:
    """Initial buckets: the 8 bytes at every offset as one number."""
    n = max(0, len(buf) - 7)
    return np.ndarray(shape=(n,), dtype="<u8", buffer=buf, strides=(1,)).astype(np.uint64) if n else \
        np.zeros(0, dtype=np.uint64)


def refine(b: np.ndarray, depth: int, family: int = 0) -> np.ndarray:
    """Buckets of twice the depth."""
    n = max(0, len(b) - depth)
    return mix(b[:n], b[depth:depth + n], family)


def buckets(buf: np.ndarray, depth: int = Q, family: int = 0) -> np.ndarray:
    b, d = grams(buf), 8
    while d < depth:
        b, d = refine(b, d, family), 2 * d
    return b


def _sliding_min(key: np.ndarray, span: int) -> np.ndarray:
    m, w = key, 1
    while 2 * w <= span:
        m, w = np.minimum(m[:len(m) - w], m[w:]), 2 * w
    rest = span - w
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


class Segments:
    """Runs of windows that share an anchor, over the texts of one buffer.

    Every window of LENGTH bytes is in one segment.  Its anchor is the offset in
    it whose Q-byte bucket is smallest (the first on ties), so equal windows
    have anchors in one bucket, at the same place in the window.
    """

    def __init__(self, buf: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        """``buf`` holds the texts [starts, stops), at most PIECE + LENGTH bytes, in ascending order."""
        b32 = buckets(buf)
        key = (b32 * _A[1]) >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)
        key |= np.arange(len(key), dtype=np.uint64)
        low = _sliding_min(key, SPAN) if len(key) >= SPAN else np.zeros(0, dtype=np.uint64)
        anchor = (low & np.uint64((1 << _POS_BITS) - 1)).astype(np.int64)
        n = np.maximum(stops - starts - LENGTH + 1, 0)
        text = np.repeat(np.arange(len(starts)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[text]
        a = anchor[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        self.text = text[first]
        self.start = at[first]
        self.windows = np.diff(np.append(first, len(at)))
        anchors = a[first]
        self.q = b32[anchors]
        end = self.start + self.windows + LENGTH - 1
        deep = lambda x: mix(b32[x], b32[x + 32], 1)
        c = mix(deep(self.start), deep((self.start + end - 64) // 2), 1)
        c = mix(c, deep(end - 64), 1)
        self.c = mix(c, ((anchors - self.start) << 16 | self.windows).astype(np.uint64), 1)


def window_names(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two names of every window of LENGTH bytes: depth 64, refined by the identifier 36 bytes later."""
    out = []
    for family in (0, 1):
        b = buckets(buf, 64, family)
        n = max(0, len(buf) - LENGTH + 1)
        out.append(mix(b[:n], b[LENGTH - 64:LENGTH - 64 + n], family))
    return out[0], out[1]
