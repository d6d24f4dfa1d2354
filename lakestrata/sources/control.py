"""Control tables: high-water marks per entity, run log rows, holiday calendar."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WATERMARK_SCHEMA = T.StructType([
    T.StructField("Id", T.IntegerType()), T.StructField("SourceSystem", T.StringType()),
    T.StructField("EntityName", T.StringType()), T.StructField("WatermarkValue", T.TimestampNTZType()),
    T.StructField("LastUpdatedOn", T.TimestampNTZType()), T.StructField("Source", T.StringType()),
])
HOLIDAY_SCHEMA = T.StructType([
    T.StructField("HolidayID", T.IntegerType()), T.StructField("HolidayDate", T.DateType()),
    T.StructField("HolidayName", T.StringType()), T.StructField("HolidayDay", T.StringType()),
    T.StructField("HolidayYear", T.IntegerType()),
])
LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                           ("job_run_id", "timestamp", "pipeline_name", "stage", "entity", "file_name",
                            "status", "message")])
# Stage and message of the extra row written when a run fails.
FINAL_STAGE = "Pipeline Final Status Logging"
FINAL_MESSAGE_PREFIX = "Pipeline failed with error"


def watermark_lookup(control: DataFrame, source: str) -> DataFrame:
    """Watermark rows of one source: (source, entity_name, watermark_value)."""
    return (control.filter(F.col("Source") == F.lit(source))
            .select(F.col("Source").alias("source"), F.col("EntityName").alias("entity_name"),
                    F.col("WatermarkValue").alias("watermark_value")))


def advance_watermarks(control: DataFrame, file_events: DataFrame, as_of=None) -> DataFrame:
    """New control state: per (source, entity) the watermark becomes max(old, newest landed file).

    ``file_events`` has (source, entity_name, file_ts). Many files of one entity reduce by partial
    aggregation before the shuffle (the max wins, not the last writer); entities seen for the first
    time get a row (full outer join). ``as_of`` stamps LastUpdatedOn of advanced rows.
    """
    latest = file_events.groupBy("source", "entity_name").agg(F.max("file_ts").alias("_new"))
    c = control.alias("c")
    joined = c.join(latest.alias("n"), (F.col("c.Source") == F.col("n.source")) &
                    (F.col("c.EntityName") == F.col("n.entity_name")), "full_outer")
    new_wm = F.greatest(F.col("c.WatermarkValue"), F.col("n._new").cast("timestamp_ntz"))
    advanced = F.col("n._new").isNotNull() & (F.col("c.WatermarkValue").isNull() |
                                              (F.col("n._new") > F.col("c.WatermarkValue")))
    stamp = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.col("n._new").cast("timestamp_ntz")
    return joined.select(
        F.col("c.Id").alias("Id"),
        F.coalesce(F.col("c.SourceSystem"), F.col("n.source")).alias("SourceSystem"),
        F.coalesce(F.col("c.EntityName"), F.col("n.entity_name")).alias("EntityName"),
        new_wm.alias("WatermarkValue"),
        F.when(advanced, stamp).otherwise(F.col("c.LastUpdatedOn")).alias("LastUpdatedOn"),
        F.coalesce(F.col("c.Source"), F.col("n.source")).alias("Source"),
    )


def log_rows(runs: DataFrame) -> DataFrame:
    """Run-log rows to append: every run once, failed runs (status ERROR) a second time as the final
    pipeline status."""
    base = runs.select(*[F.col(f.name).cast("string") for f in LOG_SCHEMA.fields])
    final = (base.filter(F.col("status") == F.lit("ERROR"))
             .withColumn("stage", F.lit(FINAL_STAGE))
             .withColumn("message", F.concat(F.lit(FINAL_MESSAGE_PREFIX), F.coalesce(F.col("message"), F.lit("")))))
    return base.unionByName(final)


def holiday_counts(calendar: DataFrame, run_dates: DataFrame, date_col: str = "run_date") -> DataFrame:
    """Holidays on each run date (0 when none): the scheduler gate's lookup, for many dates at once.

    The calendar is pre-aggregated to one row per date before the join."""
    per_day = calendar.groupBy(F.col("HolidayDate").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    return (run_dates.join(per_day, run_dates[date_col] == per_day["_d"], "left")
            .select(F.col(date_col), F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("holiday_count")))


def append_log(runs: DataFrame, path: str) -> None:
    """Append the run-log rows (``log_rows``) to the log table at ``path``."""
    log_rows(runs).write.mode("append").parquet(path)


# ------------------------------------------------------------------ the control table, by versions
def _fs_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def control_version(spark: SparkSession, root: str) -> int:
    """The newest committed version of a control table, 0 if there is none."""
    p, fs = _fs_path(spark, f"{root.rstrip('/')}/commits")
    return max((int(s.getPath().getName()) for s in fs.listStatus(p)), default=0) if fs.exists(p) else 0


def read_control(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The control table as of a version (default: the newest)."""
    root = root.rstrip("/")
    version = control_version(spark, root) if version is None else version
    folder = spark.read.text(f"{root}/commits/{version}").first()[0]
    return spark.read.parquet(f"{root}/states/{folder}")


def commit_control(spark: SparkSession, root: str, state: DataFrame, expected: int) -> bool:
    """Write ``state`` and make it version ``expected`` + 1, unless someone else did that first. The commit is the rename of a
    small finished file to the version's name, which fails where the name is taken (a distributed file system decides that
    in one step; a local one, for tests, looks first). Returns whether this writer made the version."""
    root, folder = root.rstrip("/"), uuid.uuid4().hex
    state.write.parquet(f"{root}/states/{folder}")
    draft, fs = _fs_path(spark, f"{root}/drafts/{folder}")
    out = fs.create(draft)
    out.write(bytearray(folder.encode()))
    out.close()
    version, _ = _fs_path(spark, f"{root}/commits/{expected + 1}")
    fs.mkdirs(version.getParent())
    return not fs.exists(version) and bool(fs.rename(draft, version))


def advance_control(spark: SparkSession, root: str, file_events: DataFrame, as_of=None, attempts: int = 50) -> int:
    """``advance_watermarks`` on a versioned control table: read, advance, commit; where another job committed meanwhile, again
    from its state, so that no job's advance is lost. Returns the version committed."""
    for _ in range(attempts):
        version = control_version(spark, root)
        if commit_control(spark, root, advance_watermarks(read_control(spark, root, version), file_events, as_of), version):
            return version + 1
    raise RuntimeError(f"the control table changed under {attempts} attempts to advance it")
