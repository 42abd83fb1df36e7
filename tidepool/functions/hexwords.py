"""Word -> decimal text for ABI integers, as one Arrow-batched pandas UDF.

Spark has no 256-bit integer type.  Decoding several words per log with
column arithmetic makes the decode stage too large for one generated method
(whole-stage codegen then switches off), so the decoder hands the words of a
row to this helper in one Arrow batch call and gets their exact decimal text
back.  It is applied to decoded rows only (other rows pass NULL).
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TOP = 1 << 255
_WRAP = 1 << 256


def word_text(word: str | None, signed: bool) -> str | None:
    """Hex word (no 0x) -> decimal text; two's complement when ``signed``."""
    if not word or len(word) != 64:
        return None
    try:
        v = int(word, 16)
    except ValueError:
        return None
    if signed and v >= _TOP:
        v -= _WRAP
    return str(v)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _words_udf(words: pd.Series, signed: pd.Series) -> pd.Series:
    return pd.Series([None if ws is None else [word_text(w, bool(s)) for w, s in zip(ws, ss)]
                      for ws, ss in zip(words, signed)], dtype=object)


def words_text(words: list[Column], signed: list[Column]) -> Column:
    """array<string> of the decimal texts of ``words`` (NULL word -> NULL)."""
    return _words_udf(F.array(*words), F.array(*[s.cast("boolean") for s in signed]))


def word_array_text(words: Column, signed: Column) -> Column:
    """The same for an array column of words and one of flags, of any length."""
    return _words_udf(words, signed)
