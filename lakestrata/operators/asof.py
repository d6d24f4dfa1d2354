"""As-of lookup by one ordered pass, for dimensions with very many versions of a key.

The range join of ``resolve_lookups`` pairs every fact with every version of its key before the dates are compared: rows of
a key times its versions. Here the asked (key, day) pairs are reduced to the different ones first, laid beside the
versions in one union, and ordered by key and day; the last version begun is carried forward to the days asked. A key thus
brings at most one row a day and its versions into the window, however many facts it has, and the facts meet the answers by
an equi-join with at most one partner each (a hot key there is split by AQE's skew join).

Defined results: a fact whose key or date is NULL, that lies before the first version, or in a gap between versions, gets NULL.
Where versions overlap, the one that begins last counts (of those the one that ends last, then the largest surrogate key), so no
fact row is multiplied. Versions without a start are not valid at any time; without an end they are open to 9999-12-31.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.contract import END_DATE, START_DATE


def carry_forward_lookup(df: DataFrame, dimension: DataFrame, surrogate_key: str, keys, as_of_col: str, dim_keys=None,
                         target_column: str | None = None, close: str = "same_day") -> DataFrame:
    """``df`` with the surrogate key of the version valid at ``as_of_col``. ``close='same_day'`` reads validity as
    ``[start, end)``, ``'day_before'`` as ``[start, end]``. An existing column of the target's name is replaced."""
    if close not in ("same_day", "day_before"):
        raise ValueError(f"close must be same_day/day_before, got {close!r}")
    keys, dim_keys, out = list(keys), list(dim_keys or keys), target_column or surrogate_key
    types = dict(dimension.dtypes)
    names = [f"_asof_k{i}" for i in range(len(keys))]
    facts = df.withColumns({**{n: F.col(k).try_cast(types[d]) for n, k, d in zip(names, keys, dim_keys)},
                            "_asof_t": F.col(as_of_col).cast("date")})
    known = reduce(lambda a, b: a & b, (F.col(n).isNotNull() for n in [*names, "_asof_t"]))
    asked = facts.select(*names, "_asof_t").where(known).distinct().withColumn("_asof_v", F.lit(None).cast(
        f"struct<until:date,sk:{types[surrogate_key]}>"))
    versions = dimension.select(*(F.col(k).alias(n) for n, k in zip(names, dim_keys)), F.col(START_DATE).cast("date").alias("_asof_t"),
                                F.struct(F.col(END_DATE).cast("date").alias("until"), F.col(surrogate_key).alias("sk")).alias("_asof_v")).where(known)
    open_end = F.lit("9999-12-31").cast("date")
    order = ["_asof_t", F.col("_asof_v").isNull(), F.coalesce("_asof_v.until", open_end), "_asof_v.sk"]  # versions before the days asked
    begun = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = versions.unionByName(asked).withColumn("_asof_last", F.last("_asof_v", ignorenulls=True).over(begun)).where("_asof_v IS NULL")
    until = F.coalesce("_asof_last.until", open_end)
    valid = F.col("_asof_t") < until if close == "same_day" else F.col("_asof_t") <= until
    answers = last.where(F.col("_asof_last").isNotNull() & valid).select(*names, "_asof_t", F.col("_asof_last.sk").alias("_asof_sk"))
    kept = [c for c in df.columns if c != out]
    return facts.join(answers, [*names, "_asof_t"], "left").select(*(F.col(f"`{c}`") for c in kept), F.col("_asof_sk").alias(out))
