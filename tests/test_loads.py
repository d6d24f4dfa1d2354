"""Loads that are corrected: fewer partitions, no rows, quarantine; losses before the switch; loads side by side."""
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lakestrata import contract as C
from lakestrata.plans import fixtures as fx
from lakestrata.plans.jobs import run_silver_job
from lakestrata.session import scratch_dir
from lakestrata.sources import loads as L
from lakestrata.sources.tables import append_load, published
from conftest import SF_SMALL

ROWS = "tag string, x int"


def frame(spark, *rows, schema=ROWS):
    return spark.createDataFrame(list(rows), schema)


def got(spark, name, *columns):
    return sorted(tuple(r) for r in spark.table(name).select(*(columns or ("tag", "x"))).collect())


def test_a_load_is_replaced_whatever_it_brings(spark):
    root, name = scratch_dir(spark, "t-loads"), "lakestrata_loads_1"
    put = lambda load, *rows: L.append_table(spark, frame(spark, *rows), name, root, load, ["tag"])
    put("L1", ("A", 1), ("B", 2))
    put("L2", ("A", 3), (None, 4))
    put("L1", ("A", 10))  # fewer partitions
    assert got(spark, name, "x") == [(3,), (4,), (10,)]
    put("L2")  # nothing at all
    assert got(spark, name) == [("A", 10)]
    put("L2", ("C", 5))
    assert got(spark, name) == [("A", 10), ("C", 5)]
    assert sorted(r["load_id"] for r in L.loads_of(spark, name).filter("counts").collect()) == ["L1", "L2"]
    assert L.loads_of(spark, name).count() == 5
    removed = L.vacuum_loads(spark, [name], root)
    assert len(removed) == 3 and got(spark, name) == [("A", 10), ("C", 5)]
    assert spark.sql(f"SHOW PARTITIONS {name}__data").count() == 2 and L.loads_of(spark, name).count() == 2
    put("L1", ("D", 7))
    assert got(spark, name) == [("C", 5), ("D", 7)]


def test_values_with_quotes_and_new_columns(spark):
    root, name = scratch_dir(spark, "t-loads-it's"), "lakestrata_loads_2"
    L.append_table(spark, frame(spark, ("it's a=b/c %20", 1)), name, root, "it's", ["tag"])
    more = frame(spark, ("plain", 2)).withColumn("extra", F.lit("e"))
    L.append_table(spark, more, name, root, "two", ["tag"])
    assert sorted(map(str, spark.table(name).select("tag", "x", "extra", "_load_id").collect())) == sorted(map(str, [
        spark.createDataFrame([("it's a=b/c %20", 1, None, "it's")], "tag string, x int, extra string, _load_id string").first(),
        spark.createDataFrame([("plain", 2, "e", "two")], "tag string, x int, extra string, _load_id string").first()]))
    L.append_table(spark, frame(spark), name, root, "it's", ["tag"])
    assert got(spark, name) == [("plain", 2)]


def test_a_loss_before_the_switch_changes_nothing(spark, monkeypatch):
    root, name = scratch_dir(spark, "t-loads-loss"), "lakestrata_loads_3"
    put = lambda load, *rows: L.publish_load(spark, {name: (frame(spark, *rows), ["tag"]), f"{name}__q": (frame(spark, *rows), [])}, root, load)
    put("L1", ("A", 1), ("B", 2))
    real, calls = type(spark).sql, {}

    def failing(n):
        calls["n"] = 0

        def sql(self, *a, **k):
            if str(a[0]).split()[0] in ("ALTER", "CREATE", "REFRESH"):
                calls["n"] += 1
                if calls["n"] == n:
                    raise RuntimeError("lost")
            return real(self, *a, **k)

        return sql

    for n in range(1, 5):
        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", failing(n))
            with pytest.raises(RuntimeError):
                put("L1", ("A", 9))
        if n < 4:
            assert got(spark, name) == got(spark, f"{name}__q") == [("A", 1), ("B", 2)]
    put("L1", ("A", 9))
    assert got(spark, name) == got(spark, f"{name}__q") == [("A", 9)]
    L.vacuum_loads(spark, [name, f"{name}__q"], root)
    assert got(spark, name) == got(spark, f"{name}__q") == [("A", 9)]


def test_loads_side_by_side(spark):
    root, name = scratch_dir(spark, "t-loads-many"), "lakestrata_loads_4"
    L.append_table(spark, frame(spark, ("A", 0)), name, root, "L0", ["tag"])
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: L.append_table(spark, frame(spark, ("A", i), ("B", -i)), name, root, f"L{i}", ["tag"]), range(1, 7)))
    assert got(spark, name) == sorted([("A", i) for i in range(7)] + [("B", -i) for i in range(1, 7)])


def test_replaced_runs_are_not_read(spark):
    root, name = scratch_dir(spark, "t-loads-prune"), "lakestrata_loads_5"
    for load, n in (("L1", 1), ("L2", 2), ("L1", 3)):
        L.append_table(spark, frame(spark, ("A", n)), name, root, load, ["tag"])
    plan = spark.table(name).filter("tag = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "tag" in plan[plan.index("PartitionFilters"):]
    assert got(spark, name) == [("A", 2), ("A", 3)]


def test_silver_replay_empties_the_quarantine(spark):
    root, table = scratch_dir(spark, "t-loads-silver"), "lakestrata_loads_silver"
    raw = fx.raw_customers(spark, SF_SMALL, "all")
    key = F.col("customer_id")
    wrong = raw.withColumn("customer_id", F.when(key.cast("long") % 4 == 0, F.concat(F.lit("key "), key)).otherwise(key))
    run_silver_job(spark, wrong, C.SILVER_CUSTOMERS, table, root, load_id="one")
    bad = spark.table(f"{table}__quarantine").count()
    assert bad > 0 and spark.table(table).count() == raw.count() - bad
    run_silver_job(spark, raw, C.SILVER_CUSTOMERS, table, root, load_id="one")
    assert spark.table(f"{table}__quarantine").count() == 0 and spark.table(table).count() == raw.count()
    assert published(spark, table) == published(spark, f"{table}__quarantine")


def test_a_folder_load_is_replaced_as_a_whole(spark):
    path = scratch_dir(spark, "t-folder-load") + "/t"
    for load, rows in (("L1", [("A", 1), ("B", 2)]), ("L2", [("A", 3)]), ("L1", [("A", 4)])):
        append_load(spark, frame(spark, *rows), path, load, ["tag"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("tag", "x", "_load_id").collect()) == [("A", 3, "L2"), ("A", 4, "L1")]
    append_load(spark, frame(spark), path, "L2", ["tag"])
    assert [tuple(r) for r in spark.read.parquet(path).select("tag", "x").collect()] == [("A", 4)]


def test_run_log_counts_rows_as_they_are_written(spark):
    root, table = scratch_dir(spark, "t-run-log"), "lakestrata_run_log"
    raw = fx.raw_customers(spark, SF_SMALL, "all")
    for load, rows in (("one", raw), ("one", raw.filter("false"))):
        assert run_silver_job(spark, rows, C.SILVER_CUSTOMERS, table, f"{root}/silver", load_id=load, log=f"{root}/log")
    got = sorted(r.message for r in spark.read.parquet(f"{root}/log").collect())
    assert got == sorted([f"written {raw.count()}, quarantined 0", "written 0, quarantined 0"])
