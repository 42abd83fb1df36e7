"""Exact 256-bit integers as Spark SQL expressions.

Spark's widest exact type is DECIMAL(38,0), which cannot hold a uint128 or an
int256.  Values therefore travel as decimal text at rest and, while they are
being computed on, as little-endian base-10^8 limbs held in ordinary BIGINT
columns.  Every operation below is SQL text over column names, so it runs inside
whole-stage codegen, composes with partial (map-side) aggregation and works in
Structured Streaming unchanged; ``selectExpr`` parses each expression once in
the JVM instead of composing it from many driver-side calls.

No operation carries limb by limb: fees use two chain-free carry levels and
rendering folds three limbs into one DECIMAL(38,0) chunk, so generated code
stays well below the JVM method size limit.

Bounds (all checked by the tests against Python ints):

* a parsed limb is < 10^8; ten limbs hold 80 digits (2^256 has 78); longer
  values take the rows of ``functions.wide``;
* fee limbs are < 1.0001e8;
* ``sum`` of a limb column overflows only after ~9.2e10 rows in one group, and
  ANSI mode turns such an overflow into an error instead of a wrong value;
* every product formed stays below 2^63.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 8
BASE = 10 ** DIGITS
LIMBS = 10
WIDTH = DIGITS * LIMBS
_CHUNK = 3                         # limbs per DECIMAL chunk when rendering
_CHUNK_DIGITS = DIGITS * _CHUNK    # 24


def idiv(a: Column, b) -> Column:
    """Exact integral division (SQL ``div``); never goes through DOUBLE."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def sql_decimal_parts(text: str) -> tuple[str, str, str]:
    """(digits, neg, ok) SQL for base-10 integer text.

    "" and NULL read as 0; an optional sign; digits only.  ``digits`` has no
    sign and no leading zeros ("" for zero) and may be longer than WIDTH.
    """
    s = f"coalesce({text}, '')"
    body = f"(CASE WHEN substr({s}, 1, 1) IN ('+', '-') THEN substr({s}, 2) ELSE {s} END)"
    digits = f"trim(LEADING '0' FROM {body})"
    ok = f"({s} = '' OR {s} RLIKE '^[+-]?[0-9]+" + r"\\z')"
    neg = f"({ok} AND substr({s}, 1, 1) = '-' AND {digits} != '')"
    return f"(CASE WHEN {ok} THEN {digits} ELSE '' END)", neg, ok


def sql_digit_limbs(digits: str) -> list:
    """Digit text of at most WIDTH digits -> normalised little-endian limbs."""
    return [f"CAST(substr(lpad({digits}, {WIDTH}, '0'), {WIDTH - DIGITS * (i + 1) + 1}, {DIGITS}) AS BIGINT)"
            for i in range(LIMBS)]


def sql_spread(values: list) -> list:
    """One carry level without a chain: v_i = hi_i * BASE + lo_i -> lo_i + hi_(i-1); one limb more."""
    lo = [f"(({v}) % {BASE})" for v in values]
    hi = [f"(({v}) div {BASE})" for v in values]
    return [lo[0]] + [f"({lo[i]} + {hi[i - 1]})" for i in range(1, len(values))] + [hi[-1]]


def sql_shift_down(m: list, shift: int = 6) -> list:
    """floor(N / 10^shift) of N = sum m_i BASE^i (limbs may exceed BASE).

    As 10^shift divides the limb base, only the lowest limb decides the floor.
    """
    unit, up = 10 ** shift, 10 ** (DIGITS - shift)
    return [f"(({m[0]}) div {unit} + ({m[1]}) * {up})"] + [f"(({m[i + 1]}) * {up})" for i in range(1, len(m) - 1)]


def sql_to_text(limbs: list) -> str:
    """Digit text of non-negative limbs (each any value below 2^63, e.g. group sums); "0" for zero.

    Three limbs at a time are folded into one DECIMAL(38,0) chunk (< 9.3e34);
    carries run between chunks only.
    """
    dec = "DECIMAL(38,0)"
    chunks = []
    for j in range(0, len(limbs), _CHUNK):
        terms = [f"CAST({x} AS {dec})" if t == 0 else f"CAST({x} AS {dec}) * CAST({BASE ** t} AS {dec})"
                 for t, x in enumerate(limbs[j:j + _CHUNK])]
        chunks.append("(" + " + ".join(terms) + ")")
    unit = f"CAST('{10 ** _CHUNK_DIGITS}' AS {dec})"
    parts, k = [], None
    for c in chunks:
        t = c if k is None else f"({c} + {k})"
        parts.append(f"lpad(CAST({t} % {unit} AS STRING), {_CHUNK_DIGITS}, '0')")
        k = f"({t} div {unit})"
    s = f"trim(LEADING '0' FROM concat(CAST({k} AS STRING), {', '.join(reversed(parts))}))"
    return f"(CASE WHEN {s} = '' THEN '0' ELSE {s} END)"


def sql_format_units(digits: str, decimals: str) -> str:
    """Fixed-point text of unsigned digit text scaled by 10^-decimals (M1)."""
    d = f"CAST({decimals} AS INT)"
    padded = f"(CASE WHEN length({digits}) <= {d} THEN lpad({digits}, {d} + 1, '0') ELSE {digits} END)"
    fixed = (f"concat(substr({padded}, 1, length({padded}) - {d}), '.', "
             f"substr({padded}, length({padded}) - {d} + 1, {d}))")
    return f"(CASE WHEN {d} <= 0 THEN {digits} ELSE {fixed} END)"
