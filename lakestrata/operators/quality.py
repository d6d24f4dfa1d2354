"""Contract checks (required, type, pattern, enum, unique, primary key) and lineage references.

``contract_checks`` computes every per-row check in ONE aggregation pass (partial aggregation, no
shuffle of rows); uniqueness needs a group-by per unique column, whose partial aggregation also
collapses a hot value before the exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.contract import Contract


def _row_checks(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    """(check, column, failing-row predicate) for every per-row rule of the contract."""
    out = []
    present = set(df.columns)
    for f in contract.fields:
        if f.name not in present:
            if f.required:
                out.append(("required", f.name, F.lit(True)))
            continue
        c = F.col(f.name)
        if f.required:
            out.append(("required", f.name, c.isNull()))
        if f.type.lower() not in ("string", "varchar", "char", "text"):
            out.append(("type", f.name, c.isNotNull() & c.try_cast(f.spark_type()).isNull()))
        if f.pattern:
            out.append(("pattern", f.name, c.isNotNull() & ~c.rlike(f.pattern)))
        if f.enum:
            out.append(("enum", f.name, c.isNotNull() & ~c.isin(list(f.enum))))
    return out


def _duplicate_keys(df: DataFrame, cols) -> DataFrame:
    """Key values held by more than one row (NULLs excluded), with their row counts."""
    cols = list(cols)
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.filter(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("_cnt"))
            .filter(F.col("_cnt") > 1))


def _unique_rules(contract: Contract, present) -> list[tuple[str, str, list]]:
    rules = [("unique", f.name, [f.name]) for f in contract.fields if f.unique and f.name in present]
    pk = [k for k in contract.primary_key if k in present]
    if pk and len(pk) == len(contract.primary_key):
        rules.append(("primary_key", ",".join(pk), pk))
    return rules


def _rules_by_key(contract: Contract, present) -> list[tuple[list, list[tuple[str, str]]]]:
    """The unique rules grouped by their key columns, so each key set is aggregated once: (columns, [(check, name)])."""
    groups: dict[tuple, list] = {}
    for chk, name, cols in _unique_rules(contract, present):
        groups.setdefault(tuple(cols), []).append((chk, name))
    return [(list(cols), rules) for cols, rules in groups.items()]


def contract_checks(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per (check, column): ``total`` rows and ``failed`` rows. Run on the raw (string) data so
    type failures are visible before the cast hides them as NULLs."""
    checks = _row_checks(df, contract)
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.sum(F.when(pred, 1).otherwise(0)).cast("long").alias(f"{chk}|{col}") for chk, col, pred in checks]
    wide = df.agg(*aggs)
    parts = []
    if checks:
        parts.append(
            wide.unpivot("_total", [f"{chk}|{col}" for chk, col, _ in checks], "_name", "failed")
            .select(F.split("_name", r"\|").getItem(0).alias("check"),
                    F.split("_name", r"\|").getItem(1).alias("column_name"),
                    F.col("_total").cast("long").alias("total"), F.col("failed").cast("long")))
    for cols, rules in _rules_by_key(contract, set(df.columns)):
        # group sizes per key value (NULL keys form groups too, so the sum is the row total)
        nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_cnt"), F.max(nn).alias("_nn"))
        sums = groups.agg(
            F.coalesce(F.sum("_cnt"), F.lit(0)).cast("long").alias("total"),
            F.coalesce(F.sum(F.when(F.col("_nn") & (F.col("_cnt") > 1), F.col("_cnt"))), F.lit(0))
            .cast("long").alias("failed"))
        parts.append(sums.select(F.inline(_labels(rules)), "total", "failed"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _labels(rules) -> Column:
    return F.array(*[F.struct(F.lit(chk).alias("check"), F.lit(name).alias("column_name")) for chk, name in rules])


def contract_violations(df: DataFrame, contract: Contract, id_cols) -> DataFrame:
    """One row per violated (row, check, column), identified by ``id_cols``."""
    id_cols = list(id_cols)
    checks = _row_checks(df, contract)
    arr = F.array(*[F.when(p, F.struct(F.lit(chk).alias("check"), F.lit(col).alias("column_name")))
                    for chk, col, p in checks])
    per_row = (df.select(*id_cols, F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("_v"))
               .select(*id_cols, "_v.check", "_v.column_name"))
    parts = [per_row]
    for cols, rules in _rules_by_key(contract, set(df.columns)):
        dup = _duplicate_keys(df, cols).select(*cols)
        parts.append(df.join(dup, cols, "left_semi").select(*id_cols, F.inline(_labels(rules))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def lineage_edges(df: DataFrame, refs_col: str, id_cols) -> DataFrame:
    """Explode ``namespace.name.field`` references into edges; references with fewer than three parts
    are skipped; the namespace keeps every leading part."""
    id_cols = list(id_cols)
    parts = F.split(F.trim(F.col("_ref")), r"\.")
    n = F.size(parts)
    return (df.select(*id_cols, F.explode(F.col(refs_col)).alias("_ref"))
            .withColumn("_p", parts).withColumn("_n", n)
            .filter(F.col("_n") >= 3)
            .select(*id_cols,
                    F.array_join(F.slice(F.col("_p"), 1, F.col("_n") - 2), ".").alias("namespace"),
                    F.element_at(F.col("_p"), -2).alias("name"),
                    F.element_at(F.col("_p"), -1).alias("field")))


def column_table(df: DataFrame) -> DataFrame:
    """The columns of a frame as rows (position, column_name, data_type, nullable): schema metadata to store or compare
    with a contract."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def unreadable_keys(raw: DataFrame, contract: Contract) -> Column:
    """Rows that hold a key value which the contract's type cannot read (a missing key is no such row)."""
    bad = [F.col(k).isNotNull() & F.col(k).try_cast(contract.field(k).spark_type()).isNull()
           for k in contract.keys if k in raw.columns]
    return reduce(lambda a, b: a | b, bad, F.lit(False))


def quarantine_split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with a ``violations`` text listing ``check:column`` in contract
    order). Uniqueness is included: rows whose unique value or key is duplicated are quarantined; the
    duplicate keys come from a partially aggregated group-by, joined back on the key."""
    checks = _row_checks(df, contract)
    tags = [F.when(p, F.lit(f"{chk}:{col}")) for chk, col, p in checks]
    marked = df
    for i, (cols, rules) in enumerate(_rules_by_key(contract, set(df.columns))):
        flag = f"_dup{i}"
        dup = _duplicate_keys(df, cols).select(*cols, F.lit(True).alias(flag))
        marked = marked.join(dup, cols, "left")
        tags += [F.when(F.col(flag), F.lit(f"{chk}:{name}")) for chk, name in rules]
    flags = [c for c in marked.columns if c.startswith("_dup")]
    marked = marked.withColumn("violations", F.concat_ws(",", *tags)).drop(*flags)
    ok = F.col("violations") == F.lit("")
    return marked.filter(ok).drop("violations"), marked.filter(~ok)
