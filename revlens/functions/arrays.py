"""Exploding array columns without re-evaluating them.

For ``explode(expr)`` the optimizer infers ``size(expr) > 0 AND isnotnull(expr)`` and pushes
it below the projection that computes ``expr``, so a costly array expression (a whole
cleaning pipeline) is evaluated three times per row. ``explode_outer`` infers no such filter;
its extra null row for an empty array is dropped right after. Array elements produced by the
text functions are never null, so the result equals ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, keep: list, arr: Column | str, name: str, pos: str | None = None) -> DataFrame:
    """``df.select(*keep, explode(arr) as name)`` (``posexplode`` when ``pos`` is given)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    if pos:
        out = df.select(*keep, F.posexplode_outer(a).alias(pos, name))
    else:
        out = df.select(*keep, F.explode_outer(a).alias(name))
    return out.where(F.col(name).isNotNull())
