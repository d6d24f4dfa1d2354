"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import scratch_dir

ABSENT_ID = -(1 << 63)  # stands for a null id inside an operator, so that null ids still join


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so that queries run from any folder."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    import lakestrata

    top = Path(lakestrata.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="lakestrata-package-")) / "lakestrata_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f"lakestrata/{f.relative_to(top)}")
    spark.sparkContext.addPyFile(str(target))  # Spark's file server hands it to every executor
    _shipped.add(app)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """The stored size of the tables that a frame reads, or 0 where one has no known size (an estimate of the whole
    plan would multiply the sides of a join); used only to choose a number of partitions."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes) if all(n < 1 << 60 for n in sizes) else 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def partitions_for(df: DataFrame, bytes_each: int) -> int:
    """At least ``spark.sql.shuffle.partitions``; more where the input is large (bounded by 100,000)."""
    return max(shuffle_partitions(df.sparkSession), min(100_000, input_bytes(df) // bytes_each + 1))


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` (long, nulls as ABSENT_ID) and ``text`` (nulls as empty)."""
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(ABSENT_ID)).alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def public_id(name: str = "id"):
    """The id as users see it: ABSENT_ID becomes null again."""
    return F.when(F.col(name) != ABSENT_ID, F.col(name))


def by_bytes(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes each (a longer row is a range of its own)."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixing permutation of 64-bit values (multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def told_apart(base: DataFrame) -> DataFrame:
    """``base`` (id, text) with ``th``, which tells rows with the same id apart: a hash of the text where an id
    occurs more than once, else 0 (so it costs nothing to carry). The repeated ids are normally few or none, and
    Spark broadcasts their stored table only where it is small."""
    repeated = stored(base.groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("again")), "repeated-ids")
    return base.join(repeated, "id", "left").select(
        "id", "text", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("th"))
