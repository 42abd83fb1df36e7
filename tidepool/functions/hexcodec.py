"""Hex text checks and EVM word access as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 64            # hex digits per 32-byte ABI word

# Whole-text patterns (Java: \\z, Python: fullmatch; "$" would let a line feed through).
ADDRESS_RE = r"(0[xX])?[0-9a-fA-F]{40}"
TOPIC_RE = r"0[xX][0-9a-fA-F]{64}"


def is_hex_address(c: Column) -> Column:
    """20-byte hex address, optional 0x prefix."""
    return F.coalesce(c.rlike(f"^{ADDRESS_RE}\\z"), F.lit(False))


def address_key(c: Column) -> Column:
    """Canonical lower-case 0x address (F16)."""
    body = F.when(F.lower(c.substr(1, 2)) == "0x", c.substr(F.lit(3), F.length(c))).otherwise(c)
    return F.concat(F.lit("0x"), F.lower(body))


def hex_body(c: Column) -> Column:
    """Text after a 0x / 0X prefix."""
    return c.substr(F.lit(3), F.length(c))


def has_prefix(c: Column) -> Column:
    return F.lower(c.substr(1, 2)) == "0x"


def hex_error(c: Column) -> Column:
    """Decode check of 0x-prefixed hex text; NULL when valid, else the message."""
    body = hex_body(c)
    return (F.when(c.isNull() | (c == ""), F.lit("empty hex string"))
            .when(~has_prefix(c), F.lit("hex string without 0x prefix"))
            .when(~body.rlike(r"^[0-9a-fA-F]*\z"), F.lit("invalid hex string"))
            .when(F.length(body) % 2 == 1, F.lit("hex string of odd length")))


def word(data_body: Column, i: int) -> Column:
    """The i-th 32-byte word (64 hex digits) of a hex body."""
    return data_body.substr(1 + WORD * i, WORD)


def topic_word(topic: Column) -> Column:
    """A topic as a full word: shorter topics are left-padded with zeros."""
    return F.lpad(F.lower(hex_body(topic)), WORD, "0")


def word_address(w: Column) -> Column:
    """Address from the last 20 bytes of a word (F10), lower case."""
    return F.concat(F.lit("0x"), F.lower(w.substr(25, 40)))


def word_int24(w: Column) -> Column:
    """int24 from a word whose int256 value is in range, else NULL."""
    top = F.lower(w.substr(1, 58))
    low = F.lower(w.substr(59, 6))
    pos = (top == "0" * 58) & (low.substr(1, 1) < F.lit("8"))
    negv = (top == "f" * 58) & (low.substr(1, 1) >= F.lit("8"))
    v = F.conv(low, 16, 10).cast("int")
    return F.when(pos, v).when(negv, v - F.lit(1 << 24))
