import datetime as dt
import os

from pyspark.sql import functions as F

from lakestrata.functions.timefmt import (batch_tag, file_entity, file_name_timestamp, format_batch_tag,
                                          local_batch_tag)
from lakestrata.session import scratch_dir
from lakestrata.sources import control
from lakestrata.sources.landing import list_landed_files, new_files_since, read_landing_csv, write_landing_csv
from lakestrata.sources.tables import publish_state
from lakestrata.streaming.bronze import read_bronze, run_bronze_ingest


def test_time_functions(spark):
    df = spark.createDataFrame([("my_entity_20240131_235959.csv", "2025-08-24T11:23:39.0000000",
                                 "/raw/t/t_20240101_000000/t_20240202_010101.csv")], "n string, iso string, p string")
    r = df.select(file_entity("n").alias("e"), file_name_timestamp("n").alias("ts"),
                  format_batch_tag("iso").alias("tag"), batch_tag("p", "t").alias("folder"),
                  batch_tag("p", "t", source="file").alias("file")).first()
    assert r.e == "my_entity" and r.ts == dt.datetime(2024, 1, 31, 23, 59, 59)
    assert r.tag == "20250824_112339"
    assert r.folder == "DH_T_20240101_000000" and r.file == "DH_T_20240202_010101"
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 20, 0),)], "t timestamp_ntz")
    assert ts.select(local_batch_tag("t")).first()[0] == "20240102_013000"


def test_csv_roundtrip_keeps_nulls_and_quotes(spark):
    path = scratch_dir(spark, "t-csv") + "/x"
    df = spark.createDataFrame([("1", 'a "q", b', None), ("2", "plain", "z")], "id string, s string, n string")
    write_landing_csv(df, path)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert '"plain"' in text
    back = read_landing_csv(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_listing_and_new_files(spark):
    root = scratch_dir(spark, "t-list")
    for name in ("orders_20240101_000000.csv", "orders_20240301_000000.csv", "cust_x_20240201_000000.csv"):
        with open(os.path.join(root, name), "w") as fh:
            fh.write("a\n1\n")
    files = list_landed_files(spark, root)
    wm = spark.createDataFrame([("orders", dt.datetime(2024, 2, 1))], "entity_name string, watermark_value timestamp_ntz")
    got = sorted(r.name for r in new_files_since(files, wm).collect())
    assert got == ["cust_x_20240201_000000.csv", "orders_20240301_000000.csv"]


def test_watermark_advance_takes_max_and_adds_entities(spark):
    ctl = spark.createDataFrame([(1, "s", "a", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5), "src")],
                                control.WATERMARK_SCHEMA)
    fe = spark.createDataFrame([("src", "a", dt.datetime(2024, 1, 9)), ("src", "a", dt.datetime(2024, 1, 3)),
                                ("src", "b", dt.datetime(2024, 1, 1))], "source string, entity_name string, file_ts timestamp_ntz")
    got = {r.EntityName: r.WatermarkValue for r in control.advance_watermarks(ctl, fe).collect()}
    assert got == {"a": dt.datetime(2024, 1, 9), "b": dt.datetime(2024, 1, 1)}


def test_log_rows_add_final_status(spark):
    runs = spark.createDataFrame([("1", "t", "p", "bronze", "e", "f", "ERROR", "boom"),
                                  ("2", "t", "p", "bronze", "e", "f", "SUCCESS", "ok")], control.LOG_SCHEMA)
    rows = control.log_rows(runs).collect()
    assert len(rows) == 3
    assert any(r.stage == control.FINAL_STAGE and r.message == "Pipeline failed with errorboom" for r in rows)


def test_bronze_stream_by_header_and_replay(spark):
    root = scratch_dir(spark, "t-bronze")
    land, target, ckpt = f"{root}/landing/t", f"{root}/bronze", f"{root}/_ckpt"
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, v string")
    write_landing_csv(a, f"{land}/t_20240101_000000")
    run_bronze_ingest(spark, land, "t", target, ckpt, ingest_ts="2024-01-01 00:00:00")
    b = spark.createDataFrame([("z", "3", "new")], "v string, id string, extra string")  # reordered + new column
    write_landing_csv(b, f"{land}/t_20240102_000000")
    run_bronze_ingest(spark, land, "t", target, ckpt, ingest_ts="2024-01-02 00:00:00")
    run_bronze_ingest(spark, land, "t", target, ckpt, ingest_ts="2024-01-03 00:00:00")  # nothing new
    out = sorted((r.id, r.v, r.extra, r.extract_timestamp) for r in read_bronze(spark, target).collect())
    assert out == [("1", "x", None, "DH_T_20240101_000000"), ("2", "y", None, "DH_T_20240101_000000"),
                   ("3", "z", "new", "DH_T_20240102_000000")]


def test_publish_state_repoints_table(spark):
    root = scratch_dir(spark, "t-publish")
    spark.sql("DROP TABLE IF EXISTS lakestrata_pub")
    p1 = publish_state(spark, spark.range(3), "lakestrata_pub", root)
    p2 = publish_state(spark, spark.table("lakestrata_pub").filter("id > 0"), "lakestrata_pub", root)
    assert p1 != p2 and "/v=2-" in p2
    assert sorted(r.id for r in spark.table("lakestrata_pub").collect()) == [1, 2]
    spark.sql("DROP TABLE IF EXISTS lakestrata_pub")


def test_rescued_lines_are_kept(spark):
    from lakestrata.streaming.bronze import read_by_header

    root = scratch_dir(spark, "t-rescue")
    with open(f"{root}/t_20240101_000000.csv", "w") as fh:
        fh.write('"id","v"\n"1","x"\n"2","y","surplus"\n')
    df = read_by_header(spark, [f"{root}/t_20240101_000000.csv"], rescue_column="_rescued")
    rows = {r.id: r._rescued for r in df.collect()}
    assert rows["1"] is None and rows["2"] == '"2","y","surplus"'


def test_parse_date_and_column_table(spark):
    from lakestrata.functions.timefmt import parse_date
    from lakestrata.operators.quality import column_table

    df = spark.createDataFrame([("2024-02-29",), ("nope",)], "s string")
    assert [r[0] for r in df.select(parse_date("s")).collect()] == [dt.date(2024, 2, 29), None]
    assert [tuple(r) for r in column_table(df).collect()] == [(1, "s", "string", True)]


def test_deploy_views_collects_errors(spark, tmp_path):
    import pytest

    from lakestrata.plans.views import deploy_views

    (tmp_path / "cx").mkdir()
    (tmp_path / "cx" / "v.sql").write_text(
        "CREATE OR REPLACE TEMP VIEW lakestrata_v AS SELECT 1 AS x FROM env_dev_tab;\\n;")
    spark.range(2).createOrReplaceTempView("env_prod_tab")
    ran = deploy_views(spark, str(tmp_path), {"env_dev": "env_prod"})
    assert len(ran) == 1 and spark.table("lakestrata_v").count() == 2
    (tmp_path / "cx" / "w.sql").write_text("SELECT * FROM missing_table_xyz")
    with pytest.raises(RuntimeError):
        deploy_views(spark, str(tmp_path))


def test_incremental_reads_reach_the_scan(spark):
    from lakestrata.sources.tables import incremental_read, tag_range_read, write_table

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = incremental_read(orders, "o_orderdate", F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in plan
    path = scratch_dir(spark, "t-tags") + "/t"
    df = spark.range(6).withColumn("extract_timestamp", F.concat(F.lit("DH_T_2024010"), (F.col("id") % 3).cast("string")))
    write_table(df, path, partition_by=["extract_timestamp"])
    newer = tag_range_read(spark.read.parquet(path), "DH_T_20240101")
    assert sorted(r.id for r in newer.collect()) == [2, 5]
    assert "PartitionFilters: [isnotnull(extract_timestamp" in newer._jdf.queryExecution().executedPlan().toString()


def test_bronze_stream_one_file_per_batch(spark):
    root = scratch_dir(spark, "t-bronze-many")
    land, target, ckpt = f"{root}/landing/t", f"{root}/bronze", f"{root}/_ckpt"
    a = spark.createDataFrame([(str(i), f"v{i}") for i in range(12)], "id string, v string").repartition(4)
    write_landing_csv(a, f"{land}/t_20240101_000000")  # several part files, each with its own header
    run_bronze_ingest(spark, land, "t", target, ckpt, ingest_ts="2024-01-01 00:00:00", max_files=1)
    run_bronze_ingest(spark, land, "t", target, ckpt, ingest_ts="2024-01-02 00:00:00", max_files=1)  # replay
    out = read_bronze(spark, target)
    assert out.select("batch_id").distinct().count() > 1  # one micro-batch per file
    assert sorted((r.id, r.v) for r in out.collect()) == sorted((str(i), f"v{i}") for i in range(12))


def test_rescued_lines_come_from_many_files(spark, monkeypatch):
    from conftest import SF_SMALL
    from lakestrata.plans import table_queries
    from lakestrata.streaming import bronze

    seen, read = [], bronze.read_by_header
    monkeypatch.setattr(bronze, "read_by_header", lambda s, paths, **kw: seen.extend(paths) or read(s, paths, **kw))
    rows = table_queries.q_rescued_lines(spark, SF_SMALL).collect()
    keys = [r.s_suppkey for r in spark.read.parquet(f"{SF_SMALL}/supplier.parquet").select("s_suppkey").collect()]
    assert len(seen) > 1 and len(rows) == len(keys)
    assert {r.supplier_id for r in rows if r.rescued is None} == {str(k) for k in keys if k % 3}
