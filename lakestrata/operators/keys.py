"""Dense surrogate keys without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` on its own makes Spark gather every row into one task. Here the order is cut into ranges
at points taken from a bounded sample of the order columns. The cut points are literals, so every pass over the rows
agrees on the ranges. One pass over the order columns alone counts the rows of every range (combined before the
shuffle); prefix sums of these counts are where the ranges begin. The rows are then shuffled once, by range, and
numbered inside their range. The result is exactly the global row number, and nothing is stored: a lost
executor recomputes its ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_B, _POS, _N, _START = "_dk_range", "_dk_pos", "_dk_n", "_dk_start"
RANGE_BYTES = 64 << 20
MAX_RANGES = 100_000
SAMPLE_A_RANGE = 32
MAX_SAMPLE = 200_000
MAX_SPELLED = 1024
BRANCHES = 4


def max_key(df: DataFrame, key_col: str, alias: str = "max_sk") -> DataFrame:
    """One-row frame with the largest key, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(F.col(key_col)).cast("long"), F.lit(0).cast("long")).alias(alias))


def range_count(df: DataFrame) -> int:
    """One range for every ``RANGE_BYTES`` of the tables that ``df`` reads, at least the shuffle partitions."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(n for n in sizes if n < 1 << 60)  # a leaf of unknown size says nothing
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MAX_RANGES, known // RANGE_BYTES + 1))


def cut_points(df: DataFrame, order_cols: list[Column], ranges: int) -> list[T.Row]:
    """At most ``ranges`` - 1 values of the order columns, ascending, that cut them about evenly (quantiles of a sample of at
    most 200,000 rows)."""
    if ranges < 2:
        return []
    keys = df.select(*(c.alias(f"k{i}") for i, c in enumerate(order_cols)))
    sample = keys.orderBy(F.rand(11)).limit(min(MAX_SAMPLE, SAMPLE_A_RANGE * ranges))
    rows = sample.distinct().orderBy(*(F.col(c).asc_nulls_first() for c in keys.columns)).collect()
    at = sorted({i * len(rows) // ranges for i in range(1, ranges)} - {0})
    return [rows[i] for i in at]


def _reached(order_cols: list[Column], cut: list[Column | None]) -> Column:
    """The order columns are at or above a cut point, compared one after the other (None: NULL, which comes first)."""
    col, value, last = order_cols[0], cut[0], len(cut) == 1
    if value is None:
        return F.lit(True) if last else col.isNotNull() | _reached(order_cols[1:], cut[1:])
    return col >= value if last else (col > value) | (col.eqNullSafe(value) & _reached(order_cols[1:], cut[1:]))


def _spelled(order_cols: list[Column], cuts: list, low: int, high: int) -> Column:
    """How many cut points are not above a row that is at or above the first ``low`` of them and below those from ``high``
    on: a search tree of CASE expressions."""
    if low == high:
        return F.lit(low)
    step, found = -(-(high - low) // BRANCHES), F
    for i in reversed(range(low, high, step)):
        found = found.when(_reached(order_cols, cuts[i]), _spelled(order_cols, cuts, i + 1, min(i + step, high)))
    return found.otherwise(F.lit(low))


def _halved(row: Column, cuts: list[list[Column]]) -> Column:
    """What ``_spelled`` finds, by a binary search in an array: slower by row, as short for any number of cut points."""
    points = F.array(*(F.struct(*(v.alias(f"k{i}") for i, v in enumerate(cut))) for cut in cuts))
    pair = lambda low, high: F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))

    def halve(found: Column, _: Column) -> Column:
        low, high = found["low"], found["high"]
        middle = F.shiftright(low + high, 1)
        inside = F.when(F.get(points, middle) <= row, pair(middle + 1, high)).otherwise(pair(low, middle))
        return F.when(low < high, inside).otherwise(found)

    steps = F.array(*(F.lit(0) for _ in range(len(cuts).bit_length())))
    return F.aggregate(steps, pair(F.lit(0), F.lit(len(cuts))), halve, lambda found: found["low"])


def range_of(order_cols: list[Column], types: list[T.DataType], cuts: list) -> Column:
    """How many cut points are not above a row (NULLs come first, as in the order). The order columns are bound to the lambda,
    so they are computed once a row, not at every step of the search (Spark puts their expressions wherever they are named);
    and a lambda is not compiled, so a long search tree is no long method."""
    if not cuts:
        return F.lit(0)
    names = [f"k{i}" for i in range(len(order_cols))]
    row = F.struct(*(c.alias(n) for c, n in zip(order_cols, names)))
    if len(cuts) <= MAX_SPELLED:
        points = [[None if v is None else F.lit(v).cast(t) for v, t in zip(cut, types)] for cut in cuts]
        search = lambda r: _spelled([r[n] for n in names], points, 0, len(points))
    else:
        points = [[F.lit(v).cast(t) for v, t in zip(cut, types)] for cut in cuts]
        search = lambda r: _halved(r, points)
    return F.get(F.transform(F.array(row), search), 0)


def dense_keys(df: DataFrame, order_cols, key_col: str, offset=0, num_ranges: int | None = None) -> DataFrame:
    """Add ``key_col = offset + row_number() over (order by order_cols)``.

    ``offset`` is an int or a one-row DataFrame whose first column holds it (e.g. ``max_key`` of the
    target), so the offset never travels through the driver. ``df`` is evaluated three times (a sample, counts of the order
    columns, the rows), so an expensive or random one should be stored before. Order columns should be unique per row
    (ties are numbered in an arbitrary order, and lie in one range).
    """
    spark = df.sparkSession
    n = int(num_ranges or range_count(df))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    types = [f.dataType for f in df.select(*order_cols).schema]
    of = range_of(order_cols, types, cut_points(df, order_cols, n))
    counts = df.select(of.alias(_B)).groupBy(_B).agg(F.count(F.lit(1)).alias(_N))
    if isinstance(offset, DataFrame):
        base = offset.select(F.lit(-1).alias(_B), F.col(offset.columns[0]).cast("long").alias(_N))
    else:
        base = spark.range(1).select(F.lit(-1).alias(_B), F.lit(int(offset)).cast("long").alias(_N))
    # At most MAX_RANGES + 1 rows: an unpartitioned window here is bounded by construction.
    starts = (
        counts.unionByName(base)
        .withColumn(_START, F.coalesce(
            F.sum(_N).over(Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .filter(F.col(_B) >= 0)
        .select(_B, _START)
    )
    w = Window.partitionBy(_B).orderBy(*(c.asc_nulls_first() for c in order_cols))
    placed = df.withColumn(_B, of).repartition(n, _B)
    return (
        placed.withColumn(_POS, F.row_number().over(w))
        .join(F.broadcast(starts), _B)
        .withColumn(key_col, (F.col(_START) + F.col(_POS)).cast("long"))
        .drop(_B, _POS, _START)
    )


def assign_surrogate_keys(batch: DataFrame, key_col: str, order_cols, target: DataFrame | None = None,
                          initial: int = 1) -> DataFrame:
    """Surrogate keys for a batch: ``initial, initial+1, ...`` on a first load, after ``max(target.key)``
    otherwise, in business-key order."""
    if target is None:
        return dense_keys(batch, order_cols, key_col, offset=initial - 1)
    base = target.agg((F.coalesce(F.max(key_col), F.lit(0)) + F.lit(initial - 1)).cast("long").alias("o"))
    return dense_keys(batch, order_cols, key_col, offset=base)
