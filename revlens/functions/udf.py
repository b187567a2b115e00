"""The escape hatch for a row-wise Python function over a column.

Prefer the Column builders in :mod:`revlens.functions.text`; when a caller's function has no
built-in equivalent, wrap it as an Arrow-batched pandas UDF (never a row-at-a-time UDF).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def vectorized(fn, return_type: str):
    """``fn(value) -> value`` applied per element inside Arrow batches."""

    @F.pandas_udf(return_type)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else fn(v))

    return run


def apply(col: Column, fn, return_type: str) -> Column:
    return vectorized(fn, return_type)(col)
