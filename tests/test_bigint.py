"""256-bit limb arithmetic against Python ints (edges and seeded random values), in the forms the jobs run."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.functions import bigint as B
from tidepool.functions import wide as X
from tidepool.functions.hexwords import word_text

EDGES = [0, 1, -1, 2 ** 63 - 1, -(2 ** 63), 2 ** 64, 2 ** 127, 2 ** 128 - 1, 2 ** 160 - 1,
         2 ** 255 - 1, -(2 ** 255), 10 ** 77, -(10 ** 8), 99999999, 100000000]
rng = random.Random(7)
RANDOM = [rng.randrange(-(2 ** 255), 2 ** 255) for _ in range(40)] + [rng.randrange(0, 10 ** 20) for _ in range(20)]
VALUES = EDGES + RANDOM


def parsed(df):
    """Staged like the jobs do: text -> (digits, neg, ok) -> limbs."""
    d, n, ok = B.sql_decimal_parts("s")
    a = df.selectExpr("*", f"{d} AS d", f"{n} AS neg", f"{ok} AS ok")
    return a.selectExpr("*", *[f"{x} AS l{i}" for i, x in enumerate(B.sql_digit_limbs("d"))])


def rendered(prefix="l", n=B.LIMBS):
    return F.expr(B.sql_to_text([f"{prefix}{i}" for i in range(n)]))


def test_parse_and_render_roundtrip(spark):
    out = parsed(spark.createDataFrame([(str(v),) for v in VALUES], "s string")).select(
        rendered().alias("t"), "neg", "ok").collect()
    assert [("-" if r.neg else "") + r.t for r in out] == [str(v) for v in VALUES]
    assert all(r.ok for r in out)


@pytest.mark.parametrize("text,ok,digits", [
    ("", True, ""), (None, True, ""), ("+42", True, "42"), ("-0", True, ""), ("007", True, "7"),
    ("1.5", False, ""), ("12a", False, ""), ("0x10", False, ""), ("12\n", False, ""), ("1" * 81, True, "1" * 81),
])
def test_parse_edge_texts(spark, text, ok, digits):
    d, n, valid = B.sql_decimal_parts("s")
    r = spark.createDataFrame([(text,)], "s string").selectExpr(f"{d} AS d", f"{n} AS neg", f"{valid} AS ok").first()
    assert (r.ok, r.d, r.neg) == (ok, digits, False)


def test_fee_floor_matches_python(spark):
    fees = [0, 1, 100, 500, 2500, 3000, 10000, 1_000_000, 2 ** 32 - 1]
    rows = [(str(abs(v)), f) for v in VALUES for f in fees]
    df = parsed(spark.createDataFrame(rows, "s string, fee long"))
    m = B.sql_spread([f"l{i} * fee" for i in range(B.LIMBS)])
    q_in = df.selectExpr("s", "fee", *[f"{x} AS m{i}" for i, x in enumerate(m)])
    q = B.sql_shift_down([f"m{i}" for i in range(len(m))])
    f_in = q_in.selectExpr("s", "fee", *[f"{x} AS q{i}" for i, x in enumerate(q)])
    f = B.sql_spread([f"q{i}" for i in range(len(q))])[:B.LIMBS + 1]
    out = f_in.selectExpr("s", "fee", *[f"{x} AS f{i}" for i, x in enumerate(f)])
    got = out.select("s", "fee", rendered("f", B.LIMBS + 1).alias("t"), X.fee_floor("s", "fee").alias("u")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.t == r.u == str(int(r.s) * r.fee // 10 ** 6)


def test_limb_sums_render(spark):
    vals = [abs(v) for v in VALUES] * 3
    df = parsed(spark.createDataFrame([(str(v), i % 4) for i, v in enumerate(vals)], "s string, g int"))
    agg = df.groupBy("g").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(B.LIMBS)])
    got = {r.g: r.t for r in agg.select("g", rendered().alias("t")).collect()}
    assert got == {g: str(sum(v for i, v in enumerate(vals) if i % 4 == g)) for g in range(4)}


def test_hex_words():
    for v in VALUES:
        w = format(v % (1 << 256), "064x")
        assert word_text(w, True) == str((v + 2 ** 255) % 2 ** 256 - 2 ** 255)
        assert word_text(w, False) == str(v % (1 << 256))


@pytest.mark.parametrize("value,decimals,expect", [
    ("1234500", 6, "1.234500"), ("1234500", 0, "1234500"), ("1234500", 18, "0.000000000001234500"),
    ("0", 6, "0.000000"), ("5", 1, "0.5"), ("12", 2, "0.12"), ("9" * 100, 99, "9." + "9" * 99),
])
def test_format_units(spark, value, decimals, expect):
    df = spark.createDataFrame([(value, decimals)], "v string, d int")
    assert df.select(F.expr(B.sql_format_units("v", "d"))).first()[0] == expect
