"""Change detection between a target and a batch: by column compare, by hash, and new keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.hashing import row_hash


def compare_columns(old: DataFrame, new: DataFrame, keys, ignore=(), include_new: bool = True) -> list[str]:
    """Columns to compare: those of the batch minus keys and ignored ones; with ``include_new`` a column
    missing from the target is compared with NULL."""
    skip = set(keys) | set(ignore)
    cols = [c for c in new.columns if c not in skip]
    if not include_new:
        cols = [c for c in cols if c in old.columns]
    return cols


def any_difference(old_alias: str, new_alias: str, cols, old_columns, null_safe: bool = True) -> Column:
    """OR over columns of ``NOT (old.c <=> new.c)`` (or ``old.c <> new.c`` when not null-safe).

    An empty list means nothing changed.
    """
    parts = []
    for c in cols:
        o = F.col(f"{old_alias}.{c}") if c in old_columns else F.lit(None)
        n = F.col(f"{new_alias}.{c}")
        parts.append(~o.eqNullSafe(n) if null_safe else (o != n))
    if not parts:
        return F.lit(False)
    return reduce(lambda a, b: a | b, parts)


def changed_rows(old: DataFrame, new: DataFrame, keys, ignore=(), null_safe: bool = True) -> DataFrame:
    """Batch rows whose key exists in ``old`` and where at least one compared column differs.

    ``null_safe=False`` reproduces a plain ``<>`` compare, which misses NULL <-> value changes.
    """
    keys = list(keys)
    cols = compare_columns(old, new, keys, ignore, include_new=True)
    cond = any_difference("a", "b", cols, set(old.columns), null_safe)
    if not null_safe:
        cond = F.coalesce(cond, F.lit(False))
    return old.alias("a").join(new.alias("b"), keys, "inner").filter(cond).select(
        *[F.col(k) for k in keys], *[F.col(f"b.{c}") for c in new.columns if c not in keys])


def changed_by_hash(active: DataFrame, batch: DataFrame, keys, attrs, src_hash: str = "_src_hash",
                    tgt_hash: str = "_tgt_hash") -> DataFrame:
    """Batch rows whose attribute hash differs from the active target row of the same key."""
    keys = list(keys)
    s = batch.withColumn(src_hash, row_hash(attrs))
    t = active.select(*keys, row_hash(attrs).alias(tgt_hash))
    return s.join(t, keys, "inner").filter(F.col(src_hash) != F.col(tgt_hash)).drop(tgt_hash)


def new_rows(batch: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Batch rows whose key is not in the target (left anti join)."""
    keys = list(keys)
    return batch.join(target.select(*keys), keys, "left_anti")
