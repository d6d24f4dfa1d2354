from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestrata.operators.dedup import one_per_key
from lakestrata.operators.keys import assign_surrogate_keys, dense_keys, max_key
from conftest import SF_MID


def test_dense_keys_with_extra_columns_and_many_ranges(spark):
    """Rows wider than the key (so Catalyst prunes the counting side differently) still number exactly."""
    c = spark.read.parquet(f"{SF_MID}/customer.parquet")
    got = dense_keys(c, ["c_custkey"], "k", num_ranges=13)
    want = c.withColumn("k", F.row_number().over(Window.orderBy("c_custkey")).cast("long"))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_dense_keys_equal_row_number_composite(spark):
    o = spark.read.parquet(f"{SF_MID}/orders.parquet").select("o_custkey", "o_orderkey")
    got = dense_keys(o, ["o_custkey", "o_orderkey"], "k", num_ranges=7)
    want = o.withColumn("k", F.row_number().over(Window.orderBy("o_custkey", "o_orderkey")).cast("long"))
    assert got.count() == want.count() == 15000
    assert got.exceptAll(want).count() == 0


def test_dense_keys_offset_frame_and_plan_has_no_single_partition_exchange(spark):
    c = spark.read.parquet(f"{SF_MID}/customer.parquet").select("c_custkey")
    base = spark.createDataFrame([(41,)], "m long")
    got = dense_keys(c, ["c_custkey"], "k", offset=base)
    ks = sorted(r.k for r in got.collect())
    assert ks == list(range(42, 42 + 1500))
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the only single-partition step works on the per-range counts, never on the rows
    assert plan.count("SinglePartition") <= 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 50), st.text(alphabet="abc", max_size=3)), unique=True, max_size=40),
       st.integers(1, 5))
def test_dense_keys_property_is_one_to_n(spark, rows, ranges):
    if not rows:
        return
    df = spark.createDataFrame(rows, "a int, b string")
    got = dense_keys(df, ["a", "b"], "k", num_ranges=ranges).collect()
    ordered = sorted(rows, key=lambda r: (r[0], r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.k)] == ordered
    assert sorted(r.k for r in got) == list(range(1, len(rows) + 1))


def test_assign_surrogate_keys_continue_after_target(spark):
    a = spark.createDataFrame([(3,), (1,), (2,)], "id int")
    first = assign_surrogate_keys(a, "sk", ["id"])
    b = spark.createDataFrame([(10,), (5,)], "id int")
    later = assign_surrogate_keys(b, "sk", ["id"], target=first)
    assert sorted((r.id, r.sk) for r in first.unionByName(later).collect()) == [
        (1, 1), (2, 2), (3, 3), (5, 4), (10, 5)]
    assert max_key(spark.createDataFrame([], "sk long"), "sk").first()[0] == 0


def test_one_per_key_latest_and_first(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 7, "y"), (1, None, "z"), (2, 1, "q")], "k int, seq int, v string")
    latest = {r.k: r.v for r in one_per_key(df, ["k"], "seq", "latest").collect()}
    first = {r.k: r.v for r in one_per_key(df, ["k"], "seq", "first").collect()}
    assert latest == {1: "y", 2: "q"}
    assert first == {1: "z", 2: "q"}  # NULL sorts first ascending, as ORDER BY seq does


def test_one_per_key_uses_partial_group_limit(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    plan = one_per_key(li, ["l_orderkey", "l_linenumber"], "l_shipdate")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_range_search_computes_the_order_columns_once_and_agrees_with_counting(spark):
    from pyspark.sql import types as T

    from lakestrata.operators import keys

    rows = [(None if i % 11 == 0 else i % 37, None if i % 7 == 0 else f"v{i % 5}") for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string")
    order = lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in r)
    cuts = sorted(set(rows), key=order)[::3]
    types = [T.IntegerType(), T.StringType()]
    want = sorted(sum(order(c) <= order(r) for c in cuts) for r in rows)
    most = keys.MAX_SPELLED
    try:
        for keys.MAX_SPELLED in (most, 1):  # search tree, binary search
            of = keys.range_of([F.col("a"), F.col("b")], types, cuts)
            assert sorted(r[0] for r in df.select(of).collect()) == want
            dear = df.select((F.length(F.repeat(F.col("b"), 3)) + F.col("a")).alias("k"))
            found = dear.select(keys.range_of([F.col("k")], [T.IntegerType()], [(i,) for i in range(40)]).alias("r"))
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("repeat(") == 1
    finally:
        keys.MAX_SPELLED = most


def test_gold_products_group_the_order_lines_once(spark, monkeypatch):
    from lakestrata.plans import fixtures as fx
    from lakestrata.plans import star

    key, real = [], star.gold_dimension
    monkeypatch.setattr(star, "gold_dimension", lambda target, batch, *a: (
        key.append(batch) if "product_id" in batch.columns else None, real(target, batch, *a))[1])
    star.Gold(spark, "/root/testdata/sf0.001").layers()
    read = [f for b in key for f in b.inputFiles()]
    assert read and not any("lineitem" in f for f in read)
    assert fx.silver_products(spark, "/root/testdata/sf0.001").count() == key[0].count()
