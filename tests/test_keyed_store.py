"""The store of current rows and history: many runs against the state algebra, what a run writes, what a plan moves."""
import math
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.merge import scd1_changes, scd1_state, scd2_changes, scd2_hash_changes, scd2_hash_state, scd2_state
from lakestrata.session import Scratch, scratch_dir
from lakestrata.sources import keyed_store as K
from lakestrata.sources.tables import published

BATCH = "k long, a string, b int"


def rows_of(df, *drop):
    df = df.drop(*drop)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def batches(seed, runs, keys=60, size=8):
    rng = random.Random(seed)
    yield [(k, f"a{k}", 0) for k in range(keys)]
    for r in range(1, runs):
        picked = rng.sample(range(keys + 10 * r), size)
        yield [(k, rng.choice([f"a{k}", f"x{r}", None]), rng.randint(0, 1)) for k in picked]


def run_scd2(spark, name, root, batch, day, buckets=3):
    with Scratch(spark) as scratch:
        if published(spark, name) is None:
            from lakestrata.operators.merge import scd2_first_load

            return K.publish_changes(spark, name, root, ["k"], "sk", scd2_first_load(batch, ["k"], "sk", day), buckets=buckets)
        closed, fresh = scd2_changes(K.open_rows(spark, name), batch, ["k"], "sk", day, K.top_key(spark, name), keep=scratch.stored)
        return K.publish_changes(spark, name, root, ["k"], "sk", fresh, closed)


def test_scd2_runs_equal_the_state_algebra(spark):
    root, name = scratch_dir(spark, "t-store"), "lakestrata_store_runs"
    state = None
    for r, rows in enumerate(batches(1, 7)):
        batch, day = spark.createDataFrame(rows, BATCH), f"2024-01-{r + 1:02d}"
        for _ in range(1 + (r == 4)):  # one run is repeated
            run_scd2(spark, name, root, batch, day)
        state = scd2_state(state, batch, ["k"], "sk", day)
        state = spark.createDataFrame(state.collect(), state.schema)
        assert rows_of(spark.table(name), "_slice") == rows_of(state)
    shown = spark.table(name)
    assert rows_of(K.open_rows(spark, name)) == rows_of(shown.filter("_slice = 'current'"), "_slice") == rows_of(
        state.filter("effective_end_date = DATE '9999-12-31'"))


def test_many_runs_keep_few_slices_and_write_little(spark):
    root, name, size, keys = scratch_dir(spark, "t-store-many"), "lakestrata_store_many", 10, 400
    newest = {k: (k, -1, k) for k in range(keys)}
    first = spark.createDataFrame(list(newest.values()), "k long, v int, sk long")
    K.publish_changes(spark, name, root, ["k"], "sk", first, buckets=2)
    written, most = 0, 0
    for r in range(20):
        fresh = [((r * 7 + i) % (keys + 50), r, 1000 + r * size + i) for i in range(size)]
        gone = spark.createDataFrame([newest[k] for k, _, _ in fresh if k in newest] or [(0, 0, 0)], "k long, v int, sk long")
        before = {s["slice"] for kind in ("open", "closed") for s in published(spark, name)[kind]}
        record = K.publish_changes(spark, name, root, ["k"], "sk", spark.createDataFrame(fresh, "k long, v int, sk long"), gone)
        newest |= {k: (k, v, s) for k, v, s in fresh}
        written += sum(s["rows"] for kind in ("open", "closed") for s in record[kind] if s["slice"] not in before)
        most = max(most, len(record["open"]), len(record["closed"]))
    limit = math.log2(20 * size) + 1
    assert most <= limit and written < 2 * 20 * size * limit  # every row at most once a level, and the first load never again
    assert sorted(tuple(r) for r in K.open_rows(spark, name).select("k", "v", "sk").collect()) == sorted(newest.values())
    assert record["open"][0]["rows"] == keys
    live = len(record["open"]) + len(record["closed"]) + len(record["dead"])
    assert spark.sql(f"SHOW PARTITIONS {name}__data").count() == live  # merged slices are removed


def test_buckets_grow_when_all_is_merged(spark, monkeypatch):
    monkeypatch.setattr(K, "ROWS_A_BUCKET", 20)
    root, name = scratch_dir(spark, "t-store-grow"), "lakestrata_store_grow"
    schema, want = "k long, v int, sk long", {}
    for r in range(5):
        rows = [(k, r, k) for k in range(r * 20, r * 20 + 40)]
        past = spark.createDataFrame([want[k] for k, _, _ in rows if k in want], schema)
        fresh = spark.createDataFrame(rows, schema)
        if r == 3:  # a column arrives
            fresh = fresh.withColumn("extra", F.lit("x"))
        record = K.publish_changes(spark, name, root, ["k"], "sk", fresh, past, buckets=2)
        want |= {k: (k, v, s) for k, v, s in rows}
    assert record["buckets"] >= 4 and record["table"] != f"{name}__data"
    shown = spark.table(name)
    assert sorted(tuple(r) for r in shown.filter("_slice = 'current'").select("k", "v", "sk").collect()) == sorted(want.values())
    assert shown.filter("_slice = 'closed'").count() == 80 and shown.filter("extra = 'x'").count() > 0


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_the_batch_is_shuffled(spark, no_broadcast):
    root, name = scratch_dir(spark, "t-store-plan"), "lakestrata_store_plan"
    rows = list(batches(2, 2, keys=300, size=20))
    for r in range(2):
        run_scd2(spark, name, root, spark.createDataFrame(rows[r], BATCH), f"2024-02-0{r + 1}", buckets=8)
    assert len(published(spark, name)["open"]) == 2  # two levels, merged on read
    batch = spark.createDataFrame([(1, "zz", 5), (900, "new", 6)], BATCH)
    seen = []
    scd2_changes(K.open_rows(spark, name), batch, ["k"], "sk", "2024-02-03", 999, keep=lambda df, _: (seen.append(df), df)[1])
    plan = exchanges(seen[0])
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2 and plan.count("Bucketed: true") == 2
    moved = plan[plan.index("Exchange"):].splitlines()[1]  # what lies below the one exchange
    assert "FileScan" not in moved
    assert {r.k: r._status for r in seen[0].collect()} == {1: 1, 900: 0}


def test_scd1_and_hash_changes_equal_the_state_functions(spark):
    first = spark.createDataFrame([(k, f"a{k}", k) for k in range(30)], BATCH)
    second = spark.createDataFrame([(k, f"b{k}", 1) for k in range(25, 40)], BATCH)
    one = scd1_state(None, first, ["k"], "sk", "2024-01-01").withColumn("note", F.lit("kept"))
    got = scd1_changes(one, second, ["k"], "sk", "2024-01-02", 30)
    want = scd1_state(one, second, ["k"], "sk", "2024-01-02").filter("k >= 25")
    assert rows_of(got.select(*want.columns)) == rows_of(want)
    base = scd2_hash_state(None, first, ["k"], ["a", "b"], "sk", "2024-01-01")
    closed, fresh = scd2_hash_changes(base, second, ["k"], ["a", "b"], "sk", "2024-01-02", 30)
    want = scd2_hash_state(base, second, ["k"], ["a", "b"], "sk", "2024-01-02")
    same = base.join(second, "k", "left_anti")
    assert rows_of(same.unionByName(closed).unionByName(fresh)) == rows_of(want)


def test_names_and_values_with_quotes(spark):
    root = scratch_dir(spark, "t-store-quote's")
    for r in range(2):
        rows = spark.createDataFrame([(f"it's {i}", r, i) for i in range(5)], "`the 'key'` string, v int, sk long")
        K.publish_changes(spark, "lakestrata_store_quote", root, ["the 'key'"], "sk", rows, history=False, buckets=2)
    got = spark.table("lakestrata_store_quote")
    assert got.columns == ["the 'key'", "v", "sk"] and sorted(r[1] for r in got.collect()) == [1] * 5
