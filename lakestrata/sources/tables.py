"""Table reads and writes: incremental scans, partitioned writes, catalog registration, publishing.

Publishing never overwrites what may be read, and becomes visible by one statement:

* ``publish_state`` writes a whole state to a fresh ``v=<n>`` folder and repoints the table at it.
* ``sources.loads`` adds loads that can be corrected; ``sources.keyed_store`` keeps the current rows of a dimension and its
  history. Both write only what changed, to partitions of a data table (``<name>__data``), and show it by a view ``name``.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


LOAD_ID = "_load_id"


def incremental_read(df: DataFrame, column: str, watermark) -> DataFrame:
    """Rows strictly newer than the watermark; the predicate reaches the parquet scan (PushedFilters)."""
    return df.filter(F.col(column) > F.lit(watermark))


def tag_range_read(df: DataFrame, after_tag: str, tag_col: str = "extract_timestamp") -> DataFrame:
    """Incremental read on the batch-tag partition column: prunes whole partitions."""
    return df.filter(F.col(tag_col) > F.lit(after_tag))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None, fmt: str = "parquet",
                replace_partitions: bool = False) -> None:
    """Write a table. ``overwrite`` replaces everything below ``path``, unless ``replace_partitions`` limits it to the
    partitions that ``df`` holds; the session's setting has no say."""
    writer = df.write.format(fmt).mode(mode).option("partitionOverwriteMode", "dynamic" if replace_partitions else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """External table over a path (first load)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    spark.sql(f"REFRESH TABLE {name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def missing_tables(spark: SparkSession, names) -> list[str]:
    """Dependencies that are not in the catalog (the caller raises with the list)."""
    return [n for n in names if not spark.catalog.tableExists(n)]


def _next_version(location: str | None) -> int:
    m = re.search(r"/v=(\d+)[^/]*/?$", location or "")
    return int(m.group(1)) + 1 if m else 1


def table_location(spark: SparkSession, name: str) -> str | None:
    """Storage folder of a catalog table (one metadata row)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"] if rows else None


def quoted(name: str) -> str:
    """A table name as SQL, every part in backticks."""
    return ".".join(column_list([p]) for p in name.split("."))


def column_list(names) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def text_literal(value) -> str:
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _columns_ddl(fields) -> str:
    return ", ".join(f"{column_list([f.name])} {f.dataType.simpleString()}" for f in fields)


def create_table(spark: SparkSession, name: str, df: DataFrame, path: str, partition_by=(), fmt: str = "parquet",
                 bucket_by=(), buckets: int = 0) -> None:
    """An empty catalog table with the columns of ``df``, partitioned by its ``partition_by`` columns, and bucketed if
    ``bucket_by`` is given."""
    parts = f"PARTITIONED BY ({column_list(partition_by)})" if partition_by else ""
    dealt = f"CLUSTERED BY ({column_list(bucket_by)}) INTO {buckets} BUCKETS" if bucket_by else ""
    spark.sql(f"CREATE TABLE {quoted(name)} ({_columns_ddl(df.schema.fields)}) USING {fmt} {parts} {dealt} LOCATION {text_literal(path)}")


def add_columns(spark: SparkSession, name: str, df: DataFrame) -> list[str]:
    """Add the columns that the catalog table lacks; older files read as NULL there. Returns their names."""
    have = set(spark.table(name).columns)
    new = [f for f in df.schema.fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({_columns_ddl(new)})")
    return [f.name for f in new]


def _spec(spec: dict) -> str:
    return "PARTITION (" + ", ".join(f"{column_list([k])}={text_literal(v)}" for k, v in spec.items()) + ")"


def add_partitions(spark: SparkSession, name: str, partitions) -> None:
    """Register (spec, location) pairs with one statement."""
    specs = " ".join(f"{_spec(spec)} LOCATION {text_literal(path)}" for spec, path in partitions)
    if specs:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS {specs}")


def drop_partitions(spark: SparkSession, name: str, specs) -> None:
    """Forget partitions (the files of an external table stay)."""
    listed = ", ".join(_spec(s) for s in specs)
    if listed:
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {listed}")


def partition_spec(spark: SparkSession, path: str) -> dict[str, str]:
    """The values in a partition path (``a=1/b=x%20y``), unescaped."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return {unescape(k): unescape(v) for k, v in (p.split("=", 1) for p in path.strip("/").split("/") if "=" in p)}


def full_path(spark: SparkSession, path: str) -> str:
    """A path as the file system spells it."""
    p, fs = _hadoop_path(spark, path)
    return str(fs.makeQualified(p).toString())


def list_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The folders ``depth`` levels below a path (metadata; names that begin with _ or . are left out)."""
    level = [path]
    for _ in range(depth):
        below = []
        for folder in level:
            p, fs = _hadoop_path(spark, folder)
            if fs.exists(p):
                below += [str(s.getPath().toString()) for s in fs.listStatus(p)
                          if s.isDirectory() and (s.getPath().getName()[0] not in "_." or "=" in s.getPath().getName())]
        level = below
    return level


def remove_folder(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def append_load(spark: SparkSession, df: DataFrame, path: str, load_id: str | None = None, partition_by=()) -> str:
    """Append rows below ``path`` in a folder of the load, which the same ``load_id`` replaces as a whole (files only:
    ``sources.loads`` does it for catalog tables, by one switch). By default every call is a load of its own. Returns the
    load id."""
    load_id = load_id or uuid.uuid4().hex[:16]
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    write_table(df.drop(LOAD_ID), f"{path.rstrip('/')}/{LOAD_ID}={escape(load_id)}", partition_by=list(partition_by))
    return load_id


def publish_state(spark: SparkSession, state: DataFrame, name: str, root: str, fmt: str = "parquet") -> str:
    """Write ``state`` to ``<root>/v=<n>`` and point table ``name`` at it; returns the new location. Columns new to the
    catalog are added before the switch."""
    location = table_location(spark, name) if spark.catalog.tableExists(name) else None
    path = f"{root.rstrip('/')}/v={_next_version(location)}-{uuid.uuid4().hex[:8]}"
    write_table(state, path, mode="overwrite", fmt=fmt)
    if location is None:
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    else:
        add_columns(spark, name, state)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {name}")
    return path


def published(spark: SparkSession, name: str) -> dict | None:
    """What the view of a published table records about it."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    return next((json.loads(r["value"]) for r in rows if r["key"] == "lakestrata.published"), None)


def replace_view(spark: SparkSession, name: str, record, select: str) -> None:
    """Create or replace the view of a published table, with its record: one statement."""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} TBLPROPERTIES ('lakestrata.published' = {text_literal(json.dumps(record))}) AS {select}")
