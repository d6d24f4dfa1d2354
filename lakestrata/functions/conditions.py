"""Join conditions over key lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_condition(left: DataFrame, right: DataFrame, keys, right_keys=None, null_safe: bool = False) -> Column:
    """AND of ``left.k = right.k`` over the keys (``<=>`` when ``null_safe``)."""
    right_keys = list(right_keys or keys)
    parts = [
        left[lk].eqNullSafe(right[rk]) if null_safe else left[lk] == right[rk]
        for lk, rk in zip(keys, right_keys)
    ]
    return reduce(lambda a, b: a & b, parts)


def null_safe_key_condition(left: DataFrame, right: DataFrame, keys) -> Column:
    """String keys match NULL to NULL (``<=>``); other types use plain equality."""
    types = dict((f.name, f.dataType) for f in left.schema.fields)
    parts = []
    for k in keys:
        if isinstance(types.get(k), T.StringType):
            parts.append(left[k].eqNullSafe(right[k]))
        else:
            parts.append(left[k] == right[k])
    return reduce(lambda a, b: a & b, parts)


def padded(c, width: int = 15) -> Column:
    """Key as text left-padded with zeros to ``width``; a longer key keeps all its characters (lpad would cut it, and
    different keys would match)."""
    c = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def padded_key_condition(left: DataFrame, right: DataFrame, pairs, width: int = 15) -> Column:
    """AND of ``padded(l) = padded(r)`` over ``(left_col, right_col)`` pairs."""
    parts = [padded(left[lc], width) == padded(right[rc], width) for lc, rc in pairs]
    return reduce(lambda a, b: a & b, parts)
