"""One row per key (latest or first by a sequence column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys, order_by, keep: str = "latest", tiebreak: bool = True) -> DataFrame:
    """Keep one row per key: the greatest ``order_by`` (``keep='latest'``) or the smallest (``'first'``).

    Ties are broken by every remaining column so the choice is deterministic under retries. Spark plans
    ``row_number() = 1`` as a WindowGroupLimit that also runs *before* the shuffle, so a key holding a
    large share of the rows is cut to one candidate per map task before it is exchanged.
    """
    keys = list(keys)
    order_by = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    order_names = {o for o in order_by if isinstance(o, str)}
    rest = [c for c in df.columns if c not in keys and c not in order_names] if tiebreak else []
    cols = [F.col(o) if isinstance(o, str) else o for o in order_by] + [F.col(c) for c in rest]
    if keep == "latest":
        ordering = [c.desc_nulls_last() for c in cols]
    elif keep == "first":
        ordering = [c.asc_nulls_first() for c in cols]
    else:
        raise ValueError(f"keep must be 'latest' or 'first', got {keep!r}")
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
