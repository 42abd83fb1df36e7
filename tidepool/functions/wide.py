"""Exact helpers for integers wider than the limb columns (Arrow batches, rare rows only).

A pool event's amounts fit 78 digits; text from elsewhere may be longer.  Such
values are cut into base-10^8 limbs that are summed as rows, so a hot window is
pre-aggregated like any other; only the last step per window folds them.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMB_DIGITS = 8


def _text(value: int) -> str:
    limit = sys.get_int_max_str_digits()
    sys.set_int_max_str_digits(0)
    try:
        return str(value)
    finally:
        sys.set_int_max_str_digits(limit)


def _int(text: str | None) -> int:
    limit = sys.get_int_max_str_digits()
    sys.set_int_max_str_digits(0)
    try:
        return int(text or "0")
    finally:
        sys.set_int_max_str_digits(limit)


@F.pandas_udf(T.StringType())
def fee_floor(digits: pd.Series, fee: pd.Series) -> pd.Series:
    """floor(amount * fee / 10^6) of unsigned digit text."""
    return pd.Series([_text(_int(d) * int(f) // 10 ** 6) for d, f in zip(digits, fee)], dtype=object)


@F.pandas_udf(T.StringType())
def fold_limbs(positions: pd.Series, sums: pd.Series) -> pd.Series:
    """sum(sums[i] * 10^(8 * positions[i])) as digit text."""
    return pd.Series([_text(sum(int(s) * 10 ** (LIMB_DIGITS * int(p)) for p, s in zip(ps, ss)))
                      for ps, ss in zip(positions, sums)], dtype=object)


@F.pandas_udf(T.StringType())
def add_text(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_text(_int(x) + _int(y)) for x, y in zip(a, b)], dtype=object)
