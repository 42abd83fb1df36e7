"""Fee rate and annualised rate (exact, halves away from zero)."""

import pytest

from tidepool.functions.ratios import rates_row


@pytest.mark.parametrize("fee,tvl,expect", [
    ("1", "3", "0.333333333333333333"), ("2", "3", "0.666666666666666667"),
    ("0", "3", None), ("1", "0", None), ("1", None, None), ("5", "2", "2.500000000000000000"),
])
def test_rate(fee, tvl, expect):
    assert rates_row(fee, "0", tvl, None, 300)[0] == expect


def test_apr_from_single_rate():
    # rate 0.000001 over 300 s -> 0.000001 * 31536000 / 300
    r0, r1, apr = rates_row("1", "0", "1000000", None, 300)
    assert (r0, r1, apr) == ("0.000001000000000000", None, "0.105120000000000000")


def test_apr_needs_exactly_one_rate():
    assert rates_row("1", "1", "10", "10", 300)[2] is None
    assert rates_row("0", "0", "10", "10", 300)[2] is None


def test_rates_udf(spark):
    from pyspark.sql import functions as F

    from tidepool.functions.ratios import fee_rates
    df = spark.createDataFrame([("1", "0", "3", None, 300)], "f0 string, f1 string, t0 string, t1 string, w long")
    r = df.select(fee_rates(F.col("f0"), F.col("f1"), F.col("t0"), F.col("t1"), F.col("w")).alias("r")).first().r
    assert r.fee_rate0 == "0.333333333333333333" and r.fee_rate1 is None
    assert r.apr == rates_row("1", "0", "3", None, 300)[2]
