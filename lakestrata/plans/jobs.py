"""Layer jobs: bronze -> silver (cleanse), silver -> gold (dimension state or fact append).

Each job is a thin composition of the operators; the decision of what to do is made from the contract
(table type, keys, dependencies), never from counting data. No job drops rows: appends are plain (or replace a
load of the same id), rows whose keys cannot be read go to a quarantine table, and the rows of a dimension
whose key was missing, which share the member of the default key, are all kept beside it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakestrata import contract as C
from lakestrata.functions.cleansing import contract_cast, fill_null_keys, is_unkeyed, pattern_clean
from lakestrata.operators.dedup import one_per_key
from lakestrata.operators.lookup import Lookup, resolve_lookups
from lakestrata.operators.merge import (scd1_changes, scd1_first_load, scd1_state, scd2_changes, scd2_first_load, scd2_hash_changes,
                                        scd2_hash_first_load, scd2_state)
from lakestrata.operators.quality import unreadable_keys
from lakestrata.session import Scratch
from lakestrata.sources.control import LOG_SCHEMA, append_log
from lakestrata.sources.keyed_store import open_rows, publish_changes, top_key
from lakestrata.sources.loads import append_table, publish_load
from lakestrata.sources.tables import append_load, incremental_read, missing_tables

SILVER_PARTITIONS = (C.EXTRACT_TAG,)


def silver_split(bronze: DataFrame, contract: C.Contract, watermark=None, watermark_col: str = C.INGEST_TS,
                 dedup: bool = False) -> tuple[DataFrame, DataFrame]:
    """(silver rows, quarantined bronze rows) of the bronze rows newer than the watermark.

    Rows whose key has a value that cannot be read stay as they came, in quarantine. The others are cleansed by
    pattern (on strings), cast, and get defaults for missing keys; with ``dedup`` only the latest row per key by
    ingest time stays (for batches that hold several deliveries of one entity).
    """
    df = bronze if watermark is None else incremental_read(bronze, watermark_col, watermark)
    bad = unreadable_keys(df, contract)
    good = fill_null_keys(contract_cast(pattern_clean(df.filter(~bad), contract), contract), contract.keys)
    if dedup and contract.keys and C.INGEST_TS in good.columns:
        good = one_per_key(good, list(contract.keys), C.INGEST_TS, "latest")
    first = [c for c in contract.columns if c in good.columns]
    return good.select(*first, *[c for c in good.columns if c not in first]), df.filter(bad)


def silver_batch(bronze: DataFrame, contract: C.Contract, watermark=None, watermark_col: str = C.INGEST_TS,
                 dedup: bool = False) -> DataFrame:
    """The silver rows of ``silver_split``."""
    return silver_split(bronze, contract, watermark, watermark_col, dedup)[0]


def gold_dimension(target: DataFrame | None, batch: DataFrame, contract: C.Contract, as_of,
                   dimensions: dict | None = None) -> DataFrame:
    """Next state of a gold dimension (SCD1 or SCD2) after resolving its dependency keys."""
    if contract.dependencies:
        batch = resolve_dependencies(batch, contract, dimensions or {}, versions="current")
    if target is None and contract.table_type == "SCD2":
        batch = batch.drop(*[c for c in (C.START_DATE, C.END_DATE) if c in batch.columns])
    if contract.table_type not in ("SCD1", "SCD2"):
        raise ValueError(f"{contract.name}: table type {contract.table_type} is not a dimension")
    state = scd1_state if contract.table_type == "SCD1" else scd2_state
    return state(target, batch, list(contract.keys), _surrogate_key(contract), as_of)


def _surrogate_key(contract: C.Contract) -> str:
    sks = contract.own_surrogate_keys()
    if not sks:
        raise ValueError(f"{contract.name}: no surrogate key in the contract")
    return sks[0]


def catalog_dimensions(spark: SparkSession, contract: C.Contract, given: dict | None = None) -> dict:
    """The dependency tables of a contract: those given, the others from the catalog."""
    wanted = [d.table for d in contract.dependencies if d.table not in (given or {})]
    absent = missing_tables(spark, wanted)
    if absent:
        raise LookupError(f"missing dependency tables: {absent}")
    return {**(given or {}), **{t: spark.table(t) for t in wanted}}


def resolve_dependencies(df: DataFrame, contract: C.Contract, dimensions: dict, versions: str = "current",
                         as_of_col: str | None = None) -> DataFrame:
    missing = [d.table for d in contract.dependencies if d.table not in dimensions]
    if missing:
        raise LookupError(f"missing dependency tables: {missing}")
    lookups = [Lookup(dimensions[d.table], d.surrogate_key, d.natural_keys) for d in contract.dependencies]
    return resolve_lookups(df, lookups, versions=versions, as_of_col=as_of_col)


def gold_fact(batch: DataFrame, contract: C.Contract, dimensions: dict, as_of, versions: str = "current",
              as_of_col: str | None = None) -> DataFrame:
    """Fact rows with dimension surrogate keys and audit dates."""
    df = resolve_dependencies(batch, contract, dimensions, versions, as_of_col)
    d = F.lit(as_of).cast("date")
    return df.withColumns({C.CREATE_DATE: d, C.UPDATE_DATE: d})


def append_fact(spark: SparkSession, fact: DataFrame, path: str, load_id: str | None = None,
                partition_by=(C.EXTRACT_TAG,)) -> str:
    """Append fact rows to a folder; a load with the id of an earlier one replaces it. Returns the load id."""
    return append_load(spark, fact, path, load_id, partition_by)


# ------------------------------------------------------------------------------ layer runs on tables
def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df``, and how many rows of it were written, known once it is: counted on the way, by no pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _log(spark: SparkSession, log: str | None, stage: str, entity: str, load_id, status: str, message: str) -> None:
    if log:
        row = (load_id, _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds"), "lakestrata", stage, entity, None, status, message)
        append_log(spark.createDataFrame([row], LOG_SCHEMA), log)


def run_silver_job(spark: SparkSession, bronze: DataFrame, contract: C.Contract, table: str, root: str,
                   watermark=None, load_id: str | None = None, dedup: bool = False, log: str | None = None) -> bool:
    """Bronze -> silver table, with quarantined rows in ``<table>__quarantine``. Returns whether rows were written: not
    if the batch has columns that neither the table nor the contract knows. ``load_id`` (for instance the bronze batch
    number) makes a repeated run replace its earlier rows, in both tables by one switch. With ``log``, the run adds a row to
    the log table at that path: how many rows it wrote and put in quarantine, counted as they were written."""
    good, bad = silver_split(bronze, contract, watermark, dedup=dedup)
    known = spark.table(table).columns if spark.catalog.tableExists(table) else good.columns
    if not C.evolution_allowed(good.columns, known, contract.columns):
        _log(spark, log, "silver", table, load_id, "REFUSED", f"columns not in the contract: {sorted(set(good.columns) - set(known) - set(contract.columns))}")
        return False
    (good, written), (bad, apart) = _counted(good, "written"), _counted(bad, "quarantined")
    load_id = publish_load(spark, {table: (good, SILVER_PARTITIONS), f"{table}__quarantine": (bad, ())}, root, load_id)
    if log:
        _log(spark, log, "silver", table, load_id, "SUCCESS", f"written {written.get['rows']}, quarantined {apart.get['rows']}")
    return True


def run_gold_job(spark: SparkSession, silver: DataFrame, contract: C.Contract, table: str, root: str, as_of,
                 dimensions: dict | None = None, watermark=None, watermark_col: str = C.INGEST_TS,
                 versions: str = "current", as_of_col: str | None = None, load_id: str | None = None) -> None:
    """Silver -> gold table by contract type. SCD1 and SCD2: only new rows and this run's closed rows are written; the rows
    whose key was missing share one member, with the latest values, and are all kept in ``<table>__unkeyed``. FACT: appended, with the
    dimension keys of ``versions`` (current, all, as_of with ``as_of_col``). A load id of an earlier load replaces what that
    load appended. Dependencies not given in ``dimensions`` are read from the catalog."""
    batch = silver if watermark is None else incremental_read(silver, watermark_col, watermark)
    batch = batch.drop("_load_id")
    dims = catalog_dimensions(spark, contract, dimensions)
    if contract.table_type == "FACT":
        append_table(spark, gold_fact(batch, contract, dims, as_of, versions, as_of_col), table, root, load_id,
                     SILVER_PARTITIONS)
        return
    if contract.table_type not in ("SCD1", "SCD2"):
        raise ValueError(f"{contract.name}: unknown table type {contract.table_type}")
    keys, sk = list(contract.keys), _surrogate_key(contract)
    append_table(spark, batch.filter(is_unkeyed(batch, keys)), f"{table}__unkeyed", f"{root.rstrip('/')}/unkeyed", load_id)
    batch = one_per_key(batch, keys, watermark_col, "latest")
    if contract.dependencies:
        batch = resolve_dependencies(batch, contract, dims, versions="current")
    closed, history, known = None, contract.table_type == "SCD2", spark.catalog.tableExists(table)
    with Scratch(spark) as scratch:
        if not known:
            fresh = (scd2_first_load if history else scd1_first_load)(batch, keys, sk, as_of)
        elif history:
            closed, fresh = scd2_changes(open_rows(spark, table), batch, keys, sk, as_of, top_key(spark, table), keep=scratch.stored)
        else:
            fresh = scd1_changes(open_rows(spark, table), batch, keys, sk, as_of, top_key(spark, table), keep=scratch.stored)
        publish_changes(spark, table, root, keys, sk, fresh, closed, history)


def run_hash_dimension_job(spark: SparkSession, batch: DataFrame, keys, attrs, sk: str, table: str, root: str, as_of) -> None:
    """Flag-form SCD2 driven by a row hash, stored as a table: only new versions and closed rows are written."""
    keys, attrs, closed = list(keys), list(attrs), None
    with Scratch(spark) as scratch:
        if spark.catalog.tableExists(table):
            closed, fresh = scd2_hash_changes(open_rows(spark, table), batch, keys, attrs, sk, as_of, top_key(spark, table),
                                              keep=scratch.stored)
        else:
            fresh = scd2_hash_first_load(batch, keys, attrs, sk, as_of)
        publish_changes(spark, table, root, keys, sk, fresh, closed)
