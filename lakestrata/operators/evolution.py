"""Contract-gated schema evolution on append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestrata.contract import EXTRACT_TAG, evolution_allowed
from lakestrata.sources.tables import path_exists, write_table


def target_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns of the table stored at ``path`` (schema only; no data is read)."""
    if not path_exists(spark, path):
        return []
    return spark.read.option("mergeSchema", "true").parquet(path).columns


def gated_append(spark: SparkSession, df: DataFrame, path: str, contract_columns, mode: str = "append",
                 partition_by=(EXTRACT_TAG,)) -> bool:
    """Append ``df`` when every column new to the target is declared by the contract; returns whether
    it wrote. The stored files carry their own schema; readers merge them (``mergeSchema``)."""
    tcols = target_columns(spark, path)
    if not evolution_allowed(df.columns, tcols, contract_columns):
        return False
    parts = [p for p in partition_by if p in df.columns]
    write_table(df, path, mode=mode, partition_by=parts)
    return True


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)
