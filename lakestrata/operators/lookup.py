"""Surrogate-key lookups from facts (or dependent dimensions) into dimensions.

A fact row finds its dimension surrogate key by a left join on the natural key(s). Versions:
``'all'`` joins every version (one fact row per matching version), ``'current'`` only the open version,
``'as_of'`` the version valid on the fact's date (``operators.asof`` has a form for very many versions of a key,
``'as_of_ordered'`` here). The join is an equi-join on the natural keys (the
validity range is an extra condition), so Spark shuffles both sides on the keys or broadcasts the
dimension when AQE measures it under the broadcast threshold; a hot key on the fact side is split by
AQE's skew-join handling.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.contract import END_DATE, IS_ACTIVE, START_DATE
from lakestrata.operators.asof import carry_forward_lookup
from lakestrata.operators.merge import OPEN_END


@dataclass
class Lookup:
    dimension: DataFrame
    surrogate_key: str
    keys: tuple                      # fact-side natural key columns
    dim_keys: tuple | None = None    # dimension-side columns (default: same names)
    versions: str | None = None      # overrides the call's ``versions``
    target_column: str | None = None  # name of the looked-up key in the output (default: surrogate_key)


def _current_filter(dim: DataFrame):
    if "_slice" in dim.columns:  # a sliced SCD2 table: partition pruning to the open slice
        return F.col("_slice") == F.lit("current")
    if END_DATE in dim.columns:
        return F.col(END_DATE) == F.lit(OPEN_END)
    if IS_ACTIVE in dim.columns:
        return F.col(IS_ACTIVE) == F.lit(True)
    return F.lit(True)


def resolve_lookups(df: DataFrame, lookups, versions: str = "current", as_of_col: str | None = None,
                    close: str = "same_day") -> DataFrame:
    """Add one surrogate-key column per lookup (NULL when no dimension row matches).

    Fact keys are cast (``try_cast``) to the dimension key type so mixed string/int keys join.
    ``close='same_day'`` reads validity as half-open ``[start, end)``; ``'day_before'`` as ``[start, end]``.
    """
    dtypes = {}
    for i, lk in enumerate(lookups):
        mode = lk.versions or versions
        dim = lk.dimension
        dkeys = list(lk.dim_keys or lk.keys)
        fkeys = list(lk.keys)
        out = lk.target_column or lk.surrogate_key
        dtypes = dict(dim.dtypes)
        if mode in ("as_of", "as_of_ordered") and not as_of_col:
            raise ValueError(f"versions={mode!r} needs as_of_col")
        if mode == "as_of_ordered":
            df = carry_forward_lookup(df, dim, lk.surrogate_key, fkeys, as_of_col, dkeys, out, close)
            continue
        if mode == "current":
            dim = dim.filter(_current_filter(dim))
        elif mode not in ("all", "as_of"):
            raise ValueError(f"versions must be all/current/as_of/as_of_ordered, got {mode!r}")
        names = {k: f"_lk{i}_{k}" for k in dkeys}
        sel = [F.col(k).alias(names[k]) for k in dkeys] + [F.col(lk.surrogate_key).alias(f"_lk{i}_sk")]
        if mode == "as_of":
            sel += [F.col(START_DATE).alias(f"_lk{i}_s"), F.col(END_DATE).alias(f"_lk{i}_e")]
        d = dim.select(*sel)
        if out in df.columns:
            df = df.drop(out)
        cond = None
        for fk, dk in zip(fkeys, dkeys):
            c = df[fk].try_cast(dtypes[dk]) == d[names[dk]]
            cond = c if cond is None else cond & c
        if mode == "as_of":
            t = df[as_of_col].cast("date")
            upper = t < d[f"_lk{i}_e"] if close == "same_day" else t <= d[f"_lk{i}_e"]
            cond = cond & (t >= d[f"_lk{i}_s"]) & upper
        df = (df.join(d, cond, "left").withColumnRenamed(f"_lk{i}_sk", out)
              .drop(*names.values(), f"_lk{i}_s", f"_lk{i}_e"))
    return df


# ---------------------------------------------------------------------- reference lookup metadata
@dataclass
class RefSpec:
    """One surrogate key to fill, gathered from field-level reference metadata."""
    sk: str
    fields: list = field(default_factory=list)       # fact columns
    ref_fields: list = field(default_factory=list)   # dimension columns
    ref_sk: str = ""
    dimension: str = ""
    dimension_type: str = "type1"


def reference_specs(field_schema) -> list[RefSpec]:
    """Turn field dicts with comma lists (skField, refField, refSkField, refDimension, refDimensionType)
    into one spec per surrogate key; fields naming the same key form a composite key.

    Driver-side metadata only (a handful of fields); no data is touched.
    """
    specs: dict[str, RefSpec] = {}
    for f in field_schema:
        if not f.get("skField"):
            continue
        sks = [s.strip() for s in f["skField"].split(",")]
        refs = [s.strip() for s in (f.get("refField") or "").split(",")]
        ref_sks = [s.strip() for s in (f.get("refSkField") or "").split(",")]
        dims = [s.strip() for s in (f.get("refDimension") or "").split(",")]
        types = [s.strip() for s in (f.get("refDimensionType") or "").split(",")]
        for i, sk in enumerate(sks):
            spec = specs.get(sk)
            if spec is None:
                spec = RefSpec(sk=sk, ref_sk=ref_sks[i] if i < len(ref_sks) else sk,
                               dimension=dims[i] if i < len(dims) else "",
                               dimension_type=(types[i] if i < len(types) and types[i] else "type1"))
                specs[sk] = spec
            spec.fields.append(f["name"].strip())
            spec.ref_fields.append(refs[i] if i < len(refs) else f["name"].strip())
    return list(specs.values())


def lookups_from_specs(specs, dimensions: dict, as_of: bool = True) -> list[Lookup]:
    """Type-2 dimensions are looked up as of the fact date (or current); type-1 ones by key alone."""
    out = []
    for s in specs:
        mode = ("as_of" if as_of else "current") if s.dimension_type.lower() == "type2" else "all"
        out.append(Lookup(dimensions[s.dimension], s.ref_sk, tuple(s.fields), tuple(s.ref_fields), mode, s.sk))
    return out
