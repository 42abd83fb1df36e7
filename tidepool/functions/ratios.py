"""Fee rate and annualised rate (exact rational arithmetic).

A rate is fee / balance rounded to 18 fraction digits, halves away from zero;
the annualised rate is taken from the already rounded rate and rounded again.
Both need division of integers of up to ~100 digits, which no Spark type can
do exactly, so they run as one Arrow-batched pandas UDF on Python ints.  It is
applied once per aggregated window row, never per event.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Result scale and seconds in a 365-day year.
RATIO_SCALE = 18
YEAR_SECONDS = 365 * 24 * 60 * 60

_UNIT = 10 ** RATIO_SCALE

# Ship this module's code with the UDF so executors need no install of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _round_div(num: int, den: int) -> int:
    """round(num / den) with halves away from zero, for num >= 0, den > 0."""
    return (2 * num + den) // (2 * den)


def _fixed(q: int) -> str:
    sign = "-" if q < 0 else ""
    s = str(abs(q)).rjust(RATIO_SCALE + 1, "0")
    return f"{sign}{s[:-RATIO_SCALE]}.{s[-RATIO_SCALE:]}"


def rate_scaled(fee: str | None, tvl: str | None) -> int | None:
    """fee / tvl as an integer scaled by 10^18; None when either is 0 or absent."""
    if fee is None or tvl is None:
        return None
    f, t = int(fee), int(tvl)
    if f == 0 or t == 0:
        return None
    q = _round_div(abs(f) * _UNIT, abs(t))
    return -q if (f < 0) != (t < 0) else q


def apr_scaled(rate0: int | None, rate1: int | None, window_seconds: int) -> int | None:
    """Annualised rate from exactly one present rate; None otherwise."""
    if not window_seconds:
        return None
    if rate0 is not None and rate1 is None:
        r = rate0
    elif rate1 is not None and rate0 is None:
        r = rate1
    else:
        return None
    q = _round_div(abs(r) * YEAR_SECONDS, window_seconds)
    return -q if r < 0 else q


def rates_row(fee0, fee1, tvl0, tvl1, window_seconds):
    r0, r1 = rate_scaled(fee0, tvl0), rate_scaled(fee1, tvl1)
    apr = apr_scaled(r0, r1, int(window_seconds))
    return (None if r0 is None else _fixed(r0), None if r1 is None else _fixed(r1),
            None if apr is None else _fixed(apr))


RATES_TYPE = T.StructType([
    T.StructField("fee_rate0", T.StringType()),
    T.StructField("fee_rate1", T.StringType()),
    T.StructField("apr", T.StringType()),
])


def _none(v):
    return None if v is None or (isinstance(v, float) and pd.isna(v)) else v


@F.pandas_udf(RATES_TYPE)
def _rates_udf(fee0: pd.Series, fee1: pd.Series, tvl0: pd.Series, tvl1: pd.Series,
               window_seconds: pd.Series) -> pd.DataFrame:
    rows = [rates_row(_none(a), _none(b), _none(c), _none(d), w)
            for a, b, c, d, w in zip(fee0, fee1, tvl0, tvl1, window_seconds)]
    return pd.DataFrame(rows, columns=["fee_rate0", "fee_rate1", "apr"])


def fee_rates(fee0: Column, fee1: Column, tvl0: Column, tvl1: Column,
              window_seconds: Column) -> Column:
    """struct(fee_rate0, fee_rate1, apr) from raw integer texts."""
    return _rates_udf(fee0, fee1, tvl0, tvl1, window_seconds.cast("long"))
