"""Landing -> bronze -> silver -> gold on catalog tables, twice, against the direct state algebra."""
from pyspark.sql import functions as F

from lakestrata import contract as C
from lakestrata.plans import fixtures as fx
from lakestrata.plans.jobs import run_gold_job, run_silver_job
from lakestrata.operators.merge import scd1_state
from lakestrata.session import scratch_dir
from lakestrata.sources.landing import write_landing_csv
from lakestrata.sources.tables import published
from lakestrata.streaming.bronze import read_bronze, run_bronze_ingest
from conftest import SF_SMALL
SF_MID_OR_SMALL = "/root/testdata/sf0.01"

COLS = ["supplier_id", "name", "phone", "address"]


def test_medallion_run_twice(spark):
    root = scratch_dir(spark, "t-jobs")
    land, bronze, ckpt = f"{root}/landing/suppliers", f"{root}/bronze", f"{root}/_ckpt"
    runs = [("1", "20240101_000000", "2024-01-01 06:00:00", fx.B1_ASOF),
            ("2", "20240201_000000", "2024-02-01 06:00:00", fx.B2_ASOF)]
    for batch, stamp, ingest, as_of in runs:
        write_landing_csv(fx.raw_suppliers(spark, SF_SMALL, batch).select(*COLS), f"{land}/suppliers_{stamp}")
        run_bronze_ingest(spark, land, "suppliers", bronze, ckpt, ingest_ts=ingest)
        new = read_bronze(spark, bronze).filter(F.col(C.EXTRACT_TAG) == f"DH_SUPPLIERS_{stamp}").drop("batch_id")
        for _ in range(2):  # a load repeated under its id adds nothing
            assert run_silver_job(spark, new, C.SILVER_SUPPLIERS, "lakestrata_silver_sup", f"{root}/silver", load_id=batch)
        silver = spark.table("lakestrata_silver_sup").filter(F.col(C.EXTRACT_TAG) == f"DH_SUPPLIERS_{stamp}")
        run_gold_job(spark, silver, C.GOLD_SUPPLIERS, "lakestrata_gold_sup", f"{root}/gold", as_of)

    gold = spark.table("lakestrata_gold_sup").drop(C.EXTRACT_TAG, C.INGEST_TS)
    s1 = scd1_state(None, fx.silver_suppliers(spark, SF_SMALL, "1"), ["supplier_id"], "supplier_id_sk", fx.B1_ASOF)
    s2 = scd1_state(s1, fx.silver_suppliers(spark, SF_SMALL, "2"), ["supplier_id"], "supplier_id_sk", fx.B2_ASOF)
    want = s2.drop(C.EXTRACT_TAG, C.INGEST_TS).select(*gold.columns)
    assert gold.count() == want.count() > 0
    assert gold.exceptAll(want).count() == 0
    assert spark.table("lakestrata_silver_sup").count() == sum(
        fx.raw_suppliers(spark, SF_SMALL, b).count() for b in ("1", "2"))


def test_scd2_gold_job_keeps_history_in_place(spark):
    from lakestrata.operators.merge import scd2_state

    root = scratch_dir(spark, "t-jobs-scd2")
    for batch, as_of in (("1", fx.B1_ASOF), ("2", fx.B2_ASOF), ("2", fx.B2_ASOF)):  # the last run is a replay
        run_gold_job(spark, fx.silver_customers(spark, SF_SMALL, batch), C.GOLD_CUSTOMERS, "lakestrata_gold_cust",
                     f"{root}/gold", as_of)
    table = spark.table("lakestrata_gold_cust")
    slices = sorted(r[0] for r in table.select("_slice").distinct().collect())
    assert slices == ["closed", "current"]
    assert [x["slice"][:13] for x in published(spark, "lakestrata_gold_cust")["closed"]] == ["closed-000002"]  # the replay closed nothing
    t1 = scd2_state(None, fx.silver_customers(spark, SF_SMALL, "1"), ["customer_id"], "customer_id_sk", fx.B1_ASOF)
    want = scd2_state(t1, fx.silver_customers(spark, SF_SMALL, "2"), ["customer_id"], "customer_id_sk", fx.B2_ASOF)
    got = table.drop("_slice").drop(C.INGEST_TS)
    want = want.drop(C.INGEST_TS).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    plan = table.filter("_slice = 'current'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "open-00000" in plan and "closed-" not in plan


def test_fact_job_append_is_replay_safe(spark):
    from lakestrata.plans.star import Gold

    root = scratch_dir(spark, "t-jobs-fact")
    g = Gold(spark, SF_SMALL)
    dims = {"gold.consumer.dim_customers": g.customers(), "gold.consumer.dim_products": g.products()}
    silver = fx.silver_orders(spark, SF_SMALL)
    tagged = silver.withColumn(C.EXTRACT_TAG, F.when(F.col("order_date") < F.lit(fx.B2_ASOF), "DH_ORDERS_A")
                               .otherwise("DH_ORDERS_B"))
    for tag in ("DH_ORDERS_A", "DH_ORDERS_B", "DH_ORDERS_B"):
        run_gold_job(spark, tagged.filter(F.col(C.EXTRACT_TAG) == tag), C.GOLD_ORDERS, "lakestrata_gold_fact",
                     f"{root}/gold", fx.FACT_ASOF, dimensions=dims, load_id=tag)
    table = spark.table("lakestrata_gold_fact")
    assert table.count() == silver.count()
    assert table.filter(F.col("customer_id_sk").isNull()).count() == 0


def test_scd2_delta_reads_only_the_current_slice(spark):
    from lakestrata.operators.merge import scd2_delta

    root = scratch_dir(spark, "t-jobs-slice")
    for batch, as_of in (("1", fx.B1_ASOF), ("2", fx.B2_ASOF)):
        run_gold_job(spark, fx.silver_customers(spark, SF_SMALL, batch), C.GOLD_CUSTOMERS, "lakestrata_gold_slice",
                     f"{root}/gold", as_of)
    closed, current = scd2_delta(spark.table("lakestrata_gold_slice"), fx.silver_customers(spark, SF_SMALL, "2"),
                                 ["customer_id"], "customer_id_sk", fx.B2_ASOF)
    assert closed.count() == 0  # replay of the last batch
    plan = current._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "gold_slice" in ln]
    assert scans and all("PartitionFilters: [" in ln and "open-00000" in ln and "closed-" not in ln for ln in scans)


def test_current_lookup_prunes_to_open_slice(spark):
    from lakestrata.operators.lookup import Lookup, resolve_lookups

    root = scratch_dir(spark, "t-jobs-lookup")
    for batch, as_of in (("1", fx.B1_ASOF), ("2", fx.B2_ASOF)):
        run_gold_job(spark, fx.silver_customers(spark, SF_SMALL, batch), C.GOLD_CUSTOMERS, "lakestrata_gold_lk",
                     f"{root}/gold", as_of)
    dim = spark.table("lakestrata_gold_lk")
    fact = fx.silver_orders(spark, SF_SMALL).select("order_id", "customer_id")
    out = resolve_lookups(fact, [Lookup(dim, "customer_id_sk", ("customer_id",))])
    assert out.count() == fact.count() and out.filter(F.col("customer_id_sk").isNull()).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "open-00000" in plan and "closed-" not in plan


def test_concurrent_layer_build_equals_sequential(spark):
    from lakestrata.plans.star import Gold

    par = Gold(spark, SF_SMALL).build()
    seq = Gold(spark, SF_SMALL)
    for name in ("customers", "suppliers", "products", "fact"):
        a, b = getattr(par, name)(), getattr(seq, name)()
        assert a.count() == b.count() > 0
        assert a.exceptAll(b.select(*a.columns)).count() == 0, name


def test_scd1_job_writes_only_the_batch(spark):
    from lakestrata.operators.merge import scd1_state

    root = scratch_dir(spark, "t-scd1-store")
    b1 = fx.silver_suppliers(spark, SF_MID_OR_SMALL, "1")
    b2 = fx.silver_suppliers(spark, SF_MID_OR_SMALL, "2").filter(F.col("supplier_id") < 20)  # a small batch
    for batch, as_of in ((b1, fx.B1_ASOF), (b2, fx.B2_ASOF)):
        run_gold_job(spark, batch, C.GOLD_SUPPLIERS, "lakestrata_scd1_b", root, as_of)
    levels = published(spark, "lakestrata_scd1_b")["open"]
    assert [x["rows"] for x in levels] == [b1.count(), b2.count()] and 0 < b2.count() < b1.count() / 2
    got = spark.table("lakestrata_scd1_b")
    want = scd1_state(scd1_state(None, b1, ["supplier_id"], "supplier_id_sk", fx.B1_ASOF), b2, ["supplier_id"],
                      "supplier_id_sk", fx.B2_ASOF).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_rows_without_a_key_are_all_kept(spark):
    root = scratch_dir(spark, "t-unkeyed")
    raw = fx.raw_customers(spark, SF_SMALL, "all")
    key = F.col("customer_id").cast("long")
    raw = raw.withColumn("customer_id", F.when(key % 4 != 0, F.col("customer_id")))
    run_silver_job(spark, raw, C.SILVER_CUSTOMERS, "lakestrata_unk_silver", f"{root}/silver")
    silver = spark.table("lakestrata_unk_silver")
    for _ in range(2):  # the load repeated
        run_gold_job(spark, silver, C.GOLD_CUSTOMERS, "lakestrata_unk_gold", f"{root}/gold", fx.B1_ASOF, load_id="one")
    gold, apart = spark.table("lakestrata_unk_gold"), spark.table("lakestrata_unk_gold__unkeyed")
    missing = raw.filter("customer_id IS NULL").count()
    assert apart.count() == missing > 1 and apart.select("name").distinct().count() == missing
    assert gold.filter("customer_id <> 0").count() == raw.count() - missing and gold.filter("customer_id = 0").count() == 1


def _fail_at(monkeypatch, spark, n):
    """Make the n-th SQL statement fail."""
    calls = {"n": 0}
    real = type(spark).sql

    def sql(self, *a, **k):
        if a and str(a[0]).lstrip().split()[0] in ("ALTER", "CREATE", "REFRESH", "DROP"):
            calls["n"] += 1
            if calls["n"] == n:
                raise RuntimeError("lost")
        return real(self, *a, **k)

    monkeypatch.setattr(type(spark), "sql", sql)
    return calls


def _run_with_losses(spark, monkeypatch, publish, name):
    """Run ``publish`` with a failure at each statement in turn; readers see the old state until a run succeeds."""
    before = sorted(map(tuple, spark.table(name).collect()))
    for n in range(1, 40):
        with monkeypatch.context() as m:
            _fail_at(m, spark, n)
            try:
                publish()
                return
            except RuntimeError:
                pass
        assert sorted(map(tuple, spark.table(name).collect())) == before
    raise AssertionError("more statements than expected")


def test_scd2_publish_survives_a_loss_at_any_statement(spark, monkeypatch):
    from lakestrata.operators.merge import scd2_state

    root, name = scratch_dir(spark, "t-loss2"), "lakestrata_loss2"
    b1, b2 = (fx.silver_customers(spark, SF_SMALL, b) for b in ("1", "2"))
    run_gold_job(spark, b1, C.GOLD_CUSTOMERS, name, root, fx.B1_ASOF)
    b2 = b2.withColumn("plan_name", F.lit("new"))
    _run_with_losses(spark, monkeypatch, lambda: run_gold_job(spark, b2, C.GOLD_CUSTOMERS, name, root, fx.B2_ASOF), name)
    got = spark.table(name).drop("_slice", C.INGEST_TS)
    keys = ["customer_id"], "customer_id_sk"
    want = scd2_state(scd2_state(None, b1, *keys, fx.B1_ASOF), b2, *keys, fx.B2_ASOF).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    n = spark.table(name).count()
    run_gold_job(spark, b2, C.GOLD_CUSTOMERS, name, root, fx.B2_ASOF)  # a replay after the new column adds nothing
    assert spark.table(name).count() == n


def test_scd1_publish_survives_a_loss_at_any_statement(spark, monkeypatch):
    root, name = scratch_dir(spark, "t-loss1"), "lakestrata_loss1"
    b1, b2 = (fx.silver_suppliers(spark, SF_SMALL, b) for b in ("1", "2"))
    run_gold_job(spark, b1, C.GOLD_SUPPLIERS, name, root, fx.B1_ASOF)
    _run_with_losses(spark, monkeypatch, lambda: run_gold_job(spark, b2, C.GOLD_SUPPLIERS, name, root, fx.B2_ASOF), name)
    got = spark.table(name).drop(C.INGEST_TS)
    keys = ["supplier_id"], "supplier_id_sk"
    want = scd1_state(scd1_state(None, b1, *keys, fx.B1_ASOF), b2, *keys, fx.B2_ASOF).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_overwrite_replaces_the_whole_table(spark):
    from lakestrata.sources.tables import write_table

    path = scratch_dir(spark, "t-overwrite") + "/t"
    write_table(spark.createDataFrame([("a", 1), ("a", 2), ("a", 3)], "p string, x int"), path, partition_by=["p"])
    write_table(spark.createDataFrame([("b", 4), ("b", 5)], "p string, x int"), path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 2


def test_keys_beyond_int_survive(spark):
    from lakestrata.plans.jobs import silver_batch

    raw = fx.raw_customers(spark, SF_SMALL, "all").withColumn("customer_id", F.lit("3000000000"))
    assert silver_batch(raw, C.SILVER_CUSTOMERS).select("customer_id").distinct().collect()[0][0] == 3_000_000_000


def test_dependencies_come_from_the_catalog(spark):
    import pytest
    from dataclasses import replace

    root = scratch_dir(spark, "t-deps")
    contract = replace(C.GOLD_ORDERS, dependencies=(C.Dependency("lakestrata_dep_dim", "customer_id_sk", ("customer_id",)),))
    silver = fx.silver_orders(spark, SF_SMALL)
    with pytest.raises(LookupError):
        run_gold_job(spark, silver, contract, "lakestrata_dep_fact", root, fx.FACT_ASOF)
    run_gold_job(spark, fx.silver_customers(spark, SF_SMALL, "all"), C.GOLD_CUSTOMERS, "lakestrata_dep_dim", root, fx.B1_ASOF)
    run_gold_job(spark, silver, contract, "lakestrata_dep_fact", root, fx.FACT_ASOF)
    fact = spark.table("lakestrata_dep_fact")
    assert fact.count() == silver.count() and fact.filter("customer_id_sk is null").count() == 0


def test_flagged_surrogate_and_business_keys():
    doc = {"models": {"t": {"fields": {"id": {"type": "long"}, "key": {"type": "long", "surrogateKey": True}},
                            "businessKeys": ["id"]}}, "info": {"description": "SCD1 table"}}
    c = C.contract_from_dict(doc)
    assert c.own_surrogate_keys() == ["key"] and c.keys == ("id",) and c.table_type == "SCD1"
