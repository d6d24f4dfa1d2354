"""Row hashes for hash-based change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: separator between hashed values.
HASH_SEPARATOR = "||"


def row_hash(cols, sep: str = HASH_SEPARATOR) -> Column:
    """md5 over the values as text, NULL as '' (so NULL and '' hash alike, as the stored hashes do)."""
    return F.md5(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def with_row_hash(df: DataFrame, cols, hash_col: str = "_hash") -> DataFrame:
    return df.withColumn(hash_col, row_hash(cols))
