"""Landing -> bronze as an incremental file stream, reading CSV columns by header name.

Discovery is a Structured Streaming ``binaryFile`` source that selects only ``path`` (file contents are
not read by the source); the checkpoint remembers which files were processed, and
``trigger(availableNow=True)`` drains what is there and stops. Each micro-batch is handled in
``foreachBatch``:

1. the header line of every new file is read (the head of the file only; one line per file reaches the driver);
2. files are grouped by header, and each group is one ``spark.read.csv(header=True)`` (columns by name);
3. groups are combined with ``unionByName(allowMissingColumns=True)`` (new columns appear, absent ones are
   NULL), the batch tag and ingest time are added, and the batch is written to ``batch_id=<n>`` with
   overwrite, so a replayed micro-batch replaces its own output instead of duplicating it.

A multi-file CSV read maps columns by position, so files whose headers differ in order would silently
swap values; grouping by header avoids that.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.contract import EXTRACT_TAG, INGEST_TS
from lakestrata.functions.timefmt import batch_tag
from lakestrata.sources.landing import CSV_OPTIONS
from lakestrata.sources.tables import write_table

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def header_lines(spark: SparkSession, paths, workers: int = 16) -> dict[str, str]:
    """The first line of each file, read through Spark's file systems; only the head of a file is read."""
    from concurrent.futures import ThreadPoolExecutor

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def first_line(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(p.getFileSystem(conf).open(p), "UTF-8"))
        try:
            return reader.readLine() or ""
        finally:
            reader.close()

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return dict(zip(paths, pool.map(first_line, paths)))


def _header_names(header: str) -> list[str]:
    """Column names of one header line, parsed with the landing CSV dialect."""
    return next(csv.reader([header], delimiter=CSV_OPTIONS["sep"], quotechar=CSV_OPTIONS["quote"],
                           escapechar=CSV_OPTIONS["escape"]))


def read_by_header(spark: SparkSession, paths, rescue_column: str | None = None) -> DataFrame | None:
    """Read CSV files whose headers may differ, matching columns by name. Every value is a string.

    Files sharing a header are one read with that header as an all-string schema (so positions are right
    inside the group). With ``rescue_column`` set, lines that do not fit the header (wrong field count)
    are kept whole in that column instead of being dropped or misread.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for path, header in header_lines(spark, list(paths)).items():  # one per new file (bounded by maxFilesPerTrigger)
        if header:  # a file without a first line holds nothing
            groups[header].append(path)
    frames = []
    for header, ps in sorted(groups.items()):
        fields = [T.StructField(n, T.StringType()) for n in _header_names(header)]
        reader = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "true")
        if rescue_column:
            fields.append(T.StructField(rescue_column, T.StringType()))
            # without pruning: a parser that reads only some columns does not notice surplus fields
            reader = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rescue_column)
                      .option("columnPruning", "false"))
        frames.append(reader.schema(T.StructType(fields)).csv(sorted(ps))
                      .withColumn("_source_file", F.col("_metadata.file_path")))
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ingest_batch(spark: SparkSession, paths, table: str, target: str, batch_id: int, ingest_ts=None,
                 tag_source: str = "folder", rescue_column: str | None = None) -> None:
    df = read_by_header(spark, paths, rescue_column)
    if df is None:
        return
    ts = F.lit(ingest_ts).cast("timestamp") if ingest_ts is not None else F.current_timestamp()
    out = (df.withColumn(EXTRACT_TAG, batch_tag("_source_file", table, tag_source))
           .withColumn(INGEST_TS, ts).drop("_source_file"))
    write_table(out, f"{target.rstrip('/')}/batch_id={batch_id}", partition_by=[EXTRACT_TAG])


def run_bronze_ingest(spark: SparkSession, landing_root: str, table: str, target: str, checkpoint: str,
                      ingest_ts=None, max_files: int = 1000, glob: str = "*.csv", tag_source: str = "folder",
                      wait: bool = True, rescue_column: str | None = None, after_write=None):
    """Start the availableNow stream for one table; returns the query (finished when ``wait``). ``after_write(batch_id)``
    is called when a batch's files are written and not yet committed by the stream."""
    discovery = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                 .option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
                 .option("maxFilesPerTrigger", str(max_files))
                 .load(landing_root).select("path"))

    def _batch(paths_df: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in paths_df.collect()]  # file names only, at most max_files
        if paths:
            ingest_batch(paths_df.sparkSession, paths, table, target, batch_id, ingest_ts, tag_source, rescue_column)
            if after_write is not None:
                after_write(batch_id)

    query = (discovery.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query


def read_bronze(spark: SparkSession, target: str) -> DataFrame:
    """All bronze batches with merged schemas (``batch_id`` and the batch tag are partition columns)."""
    return spark.read.option("mergeSchema", "true").parquet(target)
