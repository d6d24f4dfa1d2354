"""Contract-driven column expressions: pattern cleansing, casts, key filling, projection.

Each function builds ONE ``select`` so the plan stays a single Project that whole-stage codegen fuses
with the scan; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.contract import Contract, spark_type_of

# Replacements for values that fail a contract pattern, by word in the column name, and by type.
NAME_DEFAULTS = {"email": "unknown@example.com", "phone": "0000000000"}
TYPE_DEFAULTS = {T.DateType(): "1800-01-01", T.TimestampType(): "1800-01-01 00:00:00", T.StringType(): ""}
DEFAULT_TIMESTAMP = TYPE_DEFAULTS[T.TimestampType()]


def default_value(column_name: str, type_name: str):
    """Replacement for a value failing its pattern: a rule for a word of the column's name, else one for its type
    (numbers become 0, types without a rule the empty text)."""
    named = [value for word, value in NAME_DEFAULTS.items() if word in column_name.lower()]
    dtype = spark_type_of(type_name)
    return named[0] if named else 0 if isinstance(dtype, T.NumericType) else TYPE_DEFAULTS.get(dtype, "")


def pattern_clean(df: DataFrame, contract: Contract) -> DataFrame:
    """Keep a value when it matches the field pattern (regex find), else the default; NULL counts as a miss.

    The default literal is cast to the column's current type so a string column stays a string.
    """
    types = dict(df.dtypes)
    exprs = []
    for name in df.columns:
        c = F.col(name)
        f = next((x for x in contract.fields if x.name == name and x.pattern), None)
        if f is None:
            exprs.append(c)
            continue
        lit = F.lit(default_value(name, f.type)).cast(types[name])
        exprs.append(F.when(c.rlike(f.pattern), c).otherwise(lit).alias(name))
    return df.select(*exprs)


def contract_cast(df: DataFrame, contract: Contract, strict: bool = False) -> DataFrame:
    """Cast every contract column to its declared type (``try_cast``: bad values become NULL).

    Columns absent from the input appear as typed NULLs; columns outside the contract pass through.
    ``strict=True`` uses plain ``cast`` (raises on bad input under ANSI mode).
    """
    present = set(df.columns)
    exprs = []
    for name in df.columns:
        f = next((x for x in contract.fields if x.name == name), None)
        if f is None:
            exprs.append(F.col(name))
        else:
            t = f.spark_type()
            exprs.append((F.col(name).cast(t) if strict else F.col(name).try_cast(t)).alias(name))
    for f in contract.fields:
        if f.name not in present:
            exprs.append(F.lit(None).cast(f.spark_type()).alias(f.name))
    return df.select(*exprs)


def _key_default(dtype: T.DataType):
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                          T.DecimalType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(_dt.date(1800, 1, 1))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(DEFAULT_TIMESTAMP).cast(dtype)
    return None  # booleans and others stay NULL (reported by the contract checks)


def fill_null_keys(df: DataFrame, keys) -> DataFrame:
    """Replace NULL key values by a type default: '' for strings, 0 for numbers, 1800-01-01 for dates."""
    keys = set(keys)
    exprs = []
    for f in df.schema.fields:
        d = _key_default(f.dataType) if f.name in keys else None
        exprs.append(F.coalesce(F.col(f.name), d).alias(f.name) if d is not None else F.col(f.name))
    return df.select(*exprs)


def is_unkeyed(df: DataFrame, keys) -> Column:
    """Rows with a key that is NULL or was filled by ``fill_null_keys``: nothing tells such rows apart."""
    keys = set(keys)
    found = F.lit(False)
    for f in df.schema.fields:
        if f.name in keys:
            d = _key_default(f.dataType)
            found = found | F.col(f.name).isNull() | (F.col(f.name) == d if d is not None else F.lit(False))
    return found


# Storage type of each contract type in the coarse projection; other types are kept as they are.
COARSE_TYPES = ((T.StringType, "string"), (T.IntegralType, "long"), (T.FractionalType, "double"), (T.BooleanType, "boolean"),
                (T.DatetimeType, "timestamp"))
COARSE_KEPT = ("short", "byte")
TEXT_NAMES = ("string", "varchar", "char", "text")


def _coarse_type(type_name: str):
    dtype = spark_type_of(type_name)
    name = (type_name or "string").lower()
    if name in COARSE_KEPT or isinstance(dtype, T.StringType) and name not in TEXT_NAMES:
        return None
    return next((coarse for kind, coarse in COARSE_TYPES if isinstance(dtype, kind)), None)


def project_to_contract(df: DataFrame, contract: Contract, coarse: bool = False) -> DataFrame:
    """Select the contract columns in contract order; absent columns become NULL.

    ``coarse=False`` casts to the declared types. ``coarse=True`` uses the storage-level mapping (ints to
    long, decimals and floats to double, dates to timestamp, other names kept) and string-typed NULLs for
    absent columns.
    """
    present = set(df.columns)
    exprs = []
    for f in contract.fields:
        if f.name in present:
            if coarse:
                ct = _coarse_type(f.type)
                exprs.append(F.col(f.name).try_cast(ct).alias(f.name) if ct else F.col(f.name))
            else:
                exprs.append(F.col(f.name).try_cast(f.spark_type()).alias(f.name))
        else:
            t = T.StringType() if coarse else spark_type_of(f.type, f.precision, f.scale)
            exprs.append(F.lit(None).cast(t).alias(f.name))
    return df.select(*exprs)


def reorder_sk_last(df: DataFrame, sk_cols) -> DataFrame:
    sk_cols = [c for c in sk_cols if c in df.columns]
    return df.select(*[c for c in df.columns if c not in sk_cols], *sk_cols)
