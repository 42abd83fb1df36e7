"""Mixed-case checksummed address text (EIP-55), F11.

Addresses stay lower case inside every job (the canonical key); this
rendering is an optional last step.  It needs Keccak-256, which the Python
standard library does not provide (hashlib's sha3_256 uses different
padding), so a compact Keccak-f[1600] lives here.  It runs once per distinct
address (``checksum_addresses`` deduplicates first, then joins back).
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MASK = (1 << 64) - 1
# Keccak-f[1600] rotation offsets and round constants are generated from
# their defining rules (FIPS 202 rho offsets and the rc LFSR) below.


def _rho_offsets():
    rot = [[0] * 5 for _ in range(5)]
    x, y = 1, 0
    for t in range(24):
        rot[x][y] = ((t + 1) * (t + 2) // 2) % 64
        x, y = y, (2 * x + 3 * y) % 5
    return rot


def _round_constants():
    def rc_bit(t):
        r = 1
        for _ in range(t % 255):
            r <<= 1
            if r & 0x100:
                r ^= 0x171
        return r & 1
    out = []
    for i in range(24):
        c = 0
        for j in range(7):
            if rc_bit(j + 7 * i):
                c |= 1 << ((1 << j) - 1)
        out.append(c)
    return out


_ROT = _rho_offsets()
_RC = _round_constants()


def _rotl(v: int, n: int) -> int:
    return ((v << n) | (v >> (64 - n))) & _MASK if n else v


def _keccak_f(a):
    for rc in _RC:
        c = [a[x][0] ^ a[x][1] ^ a[x][2] ^ a[x][3] ^ a[x][4] for x in range(5)]
        d = [c[(x - 1) % 5] ^ _rotl(c[(x + 1) % 5], 1) for x in range(5)]
        a = [[a[x][y] ^ d[x] for y in range(5)] for x in range(5)]
        b = [[0] * 5 for _ in range(5)]
        for x in range(5):
            for y in range(5):
                b[y][(2 * x + 3 * y) % 5] = _rotl(a[x][y], _ROT[x][y])
        a = [[b[x][y] ^ (~b[(x + 1) % 5][y] & b[(x + 2) % 5][y]) for y in range(5)] for x in range(5)]
        a[0][0] ^= rc
    return a


def _sponge256(data: bytes, domain: int) -> bytes:
    rate = 136
    pad = rate - len(data) % rate
    if pad == 1:
        msg = bytes(data) + bytes([domain | 0x80])
    else:
        msg = bytes(data) + bytes([domain]) + b"\x00" * (pad - 2) + b"\x80"
    a = [[0] * 5 for _ in range(5)]
    for off in range(0, len(msg), rate):
        block = msg[off:off + rate]
        for i in range(rate // 8):
            x, y = i % 5, i // 5
            a[x][y] ^= int.from_bytes(block[8 * i:8 * i + 8], "little")
        a = _keccak_f(a)
    return b"".join(a[i % 5][i // 5].to_bytes(8, "little") for i in range(4))


def keccak256(data: bytes) -> bytes:
    """Keccak-256 as used by Ethereum (domain byte 0x01)."""
    return _sponge256(data, 0x01)


def to_checksum(address: str | None) -> str | None:
    """0x + 40 hex -> EIP-55 mixed case; other input is returned unchanged."""
    if address is None:
        return None
    body = address[2:] if address[:2] in ("0x", "0X") else address
    if len(body) != 40:
        return address
    body = body.lower()
    h = keccak256(body.encode()).hex()
    return "0x" + "".join(ch.upper() if ch.isalpha() and int(h[i], 16) >= 8 else ch
                          for i, ch in enumerate(body))


@F.pandas_udf(T.StringType())
def _checksum_udf(a: pd.Series) -> pd.Series:
    return a.map(to_checksum)


def checksum_addresses(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace address columns by their checksummed text (distinct addresses only)."""
    distinct = None
    for c in cols:
        d = df.select(F.lower(F.col(c)).alias("_a")).where(F.col("_a").isNotNull())
        distinct = d if distinct is None else distinct.unionByName(d)
    table = distinct.distinct().select("_a", _checksum_udf(F.col("_a")).alias("_cs"))
    out = df
    for c in cols:
        t = table.select(F.col("_a").alias(f"_a_{c}"), F.col("_cs").alias(f"_cs_{c}"))
        out = (out.join(t, F.lower(out[c]) == t[f"_a_{c}"], "left")
               .withColumn(c, F.coalesce(F.col(f"_cs_{c}"), F.col(c))).drop(f"_a_{c}", f"_cs_{c}"))
    return out
