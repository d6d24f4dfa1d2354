"""Landing zone: delimited files in, quoted files out, file listing and the new-file filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.timefmt import file_entity, file_name_timestamp

# Landing CSV dialect (comma separated, double-quote quoting, backslash escape, header row).
CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": "\\", "header": "true"}


def read_landing_csv(spark: SparkSession, paths, columns=None) -> DataFrame:
    """Read landing CSV with every value as a string (conversion happens in the silver cast).

    ``columns`` fixes the expected header names (all strings); otherwise the header row names them.
    Files with different headers must be read per header (see ``streaming.bronze``): a multi-file CSV
    read maps columns by position.
    """
    reader = spark.read.options(**CSV_OPTIONS)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    else:
        reader = reader.option("inferSchema", "false")
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def write_landing_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write every value quoted, with a header row (one folder of part files per call)."""
    (df.select(*[F.col(c).cast("string") for c in df.columns]).write.mode(mode)
     .options(**CSV_OPTIONS).option("quoteAll", "true").csv(path))


def list_landed_files(spark: SparkSession, root: str, glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """Paths, names, sizes and modification times of landed files; file contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                        F.col("length"), F.col("modificationTime").alias("modified"))


def with_file_stamp(files: DataFrame, name_col: str = "name") -> DataFrame:
    """Add ``entity`` and ``file_ts`` parsed from ``<entity>_<yyyyMMdd_HHmmss>.<ext>``."""
    return files.withColumn("entity", file_entity(name_col)).withColumn("file_ts", file_name_timestamp(name_col))


def new_files_since(files: DataFrame, watermarks: DataFrame, name_col: str = "name",
                    entity_col: str = "entity_name", watermark_col: str = "watermark_value") -> DataFrame:
    """Files whose name timestamp is after their entity's watermark (entities without a watermark row
    take every file). The watermark table has one row per entity; it is joined on the entity, so a
    very large listing is shuffled once on the entity, or the watermark table is broadcast when AQE
    measures it small."""
    stamped = with_file_stamp(files, name_col)
    wm = watermarks.select(F.col(entity_col).alias("_wm_entity"), F.col(watermark_col).cast("timestamp_ntz").alias("_wm"))
    joined = stamped.join(wm, stamped["entity"] == wm["_wm_entity"], "left")
    keep = F.col("file_ts").isNotNull() & (F.col("_wm").isNull() | (F.col("file_ts") > F.col("_wm")))
    return joined.filter(keep).drop("_wm_entity", "_wm")


FILE_KEY = ("path", "length", "modified")


def take_unseen(spark: SparkSession, files: DataFrame, seen: str, root: str, run_id: str) -> DataFrame:
    """The files of a listing (``list_landed_files``) that no other run took, and note them as taken by ``run_id``.

    A file is known by path, length and modification time: one that was written anew under its old name is taken again,
    and two of the same second are told apart. The state is the table ``seen``, one load a run (``sources.loads``), so a
    run that is repeated under its id takes the same files again, and also those that landed since. Only the three columns
    of the state are joined; nothing passes the driver."""
    from lakestrata.sources.loads import LOAD_ID, append_table

    rows = files.select("path", "name", "length", "modified")
    if spark.catalog.tableExists(seen):
        others = spark.table(seen).filter(F.col(LOAD_ID) != run_id).select(*FILE_KEY)
        rows = rows.join(others, list(FILE_KEY), "left_anti")
    append_table(spark, rows, seen, root, run_id)
    return spark.table(seen).filter(F.col(LOAD_ID) == run_id).drop(LOAD_ID)
