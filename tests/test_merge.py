import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import merge
from lakestrata.plans import fixtures as fx
from conftest import SF_SMALL

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
OPEN = merge.OPEN_END


def _batch(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, city string")


def _state(spark):
    t = merge.scd2_first_load(_batch(spark, [(1, "a", "X"), (2, "b", None), (3, "c", "Z")]), ["id"], "sk", D1)
    b = _batch(spark, [(1, "a", "X"), (2, "b", "Y"), (4, "d", "W")])  # same, NULL->value, new
    return t, b


def test_scd2_state_versions(spark):
    t, b = _state(spark)
    s = merge.scd2_state(t, b, ["id"], "sk", D2)
    rows = sorted((r.id, r.sk, r.city, r.effective_start_date, r.effective_end_date) for r in s.collect())
    assert rows == [(1, 1, "X", D1, OPEN), (2, 2, None, D1, D2), (2, 5, "Y", D2, OPEN), (3, 3, "Z", D1, OPEN),
                    (4, 4, "W", D2, OPEN)]  # new keys are numbered before changed keys


def test_scd2_rerun_is_noop_and_invariants(spark):
    t, b = _state(spark)
    s1 = merge.scd2_state(t, b, ["id"], "sk", D2)
    s2 = merge.scd2_state(s1, b, ["id"], "sk", dt.date(2024, 3, 1))
    assert s1.exceptAll(s2).count() == 0 and s2.exceptAll(s1).count() == 0
    open_per_key = s2.filter(F.col("effective_end_date") == OPEN).groupBy("id").count()
    assert open_per_key.filter("count <> 1").count() == 0
    assert s2.select("sk").distinct().count() == s2.count()
    # intervals of one key do not overlap (half-open [start, end))
    a, c = s2.alias("a"), s2.alias("c")
    overlap = a.join(c, (F.col("a.id") == F.col("c.id")) & (F.col("a.sk") < F.col("c.sk")) &
                     (F.col("a.effective_start_date") < F.col("c.effective_end_date")) &
                     (F.col("c.effective_start_date") < F.col("a.effective_end_date")))
    assert overlap.count() == 0


def test_scd2_prepare_and_merge_equal_state(spark):
    t, b = _state(spark)
    src = merge.scd2_prepare(t, b, ["id"], "sk")
    via_merge = merge.scd2_merge(t, src, ["sk"], D2)
    direct = merge.scd2_state(t, b, ["id"], "sk", D2)
    assert via_merge.exceptAll(direct.select(*via_merge.columns)).count() == 0
    assert direct.count() == via_merge.count()


def test_scd2_close_day_before(spark):
    t, b = _state(spark)
    s = merge.scd2_state(t, b, ["id"], "sk", D2, close="day_before")
    closed = s.filter(F.col("effective_end_date") != OPEN).first()
    assert closed.effective_end_date == D2 - dt.timedelta(days=1)


def test_scd1_state_keeps_sk_and_create_date(spark):
    t = merge.scd1_state(None, _batch(spark, [(1, "a", "X"), (2, "b", "Y")]), ["id"], "sk", D1)
    s = merge.scd1_state(t, _batch(spark, [(2, "b2", "Y"), (3, "c", "Z")]), ["id"], "sk", D2)
    rows = sorted((r.id, r.sk, r.name, r.create_date, r.update_date) for r in s.collect())
    assert rows == [(1, 1, "a", D1, D1), (2, 2, "b2", D1, D2), (3, 3, "c", D2, D2)]


def test_scd1_upsert(spark):
    cols = ["id", "name", "city"]
    t = merge.scd1_upsert(None, _batch(spark, [(2, "b", "Y"), (1, "a", "X")]), ["id"], cols, "sk")
    s = merge.scd1_upsert(t, _batch(spark, [(2, "b2", None), (0, "z", "Q")]), ["id"], cols, "sk")
    assert sorted(tuple(r) for r in s.select("id", "name", "city", "sk").collect()) == [
        (0, "z", "Q", 3), (1, "a", "X", 1), (2, "b2", None, 2)]


def test_scd2_hash_state(spark):
    attrs = ["name", "city"]
    t = merge.scd2_hash_first_load(_batch(spark, [(1, "a", "X"), (2, "b", None)]), ["id"], attrs, "sk", D1)
    s = merge.scd2_hash_state(t, _batch(spark, [(1, "a", "X"), (2, "b", "Y"), (3, "c", "Z")]), ["id"], attrs,
                              "sk", D2)
    rows = sorted((r.id, r.sk, r.is_active, r.effective_end_date) for r in s.collect())
    assert rows == [(1, 1, True, OPEN), (2, 2, False, D2 - dt.timedelta(days=1)), (2, 3, True, OPEN),
                    (3, 4, True, OPEN)]  # changed and new keys numbered together, in key order


def test_gold_customers_fixture_invariants(spark):
    from lakestrata.plans.star import Gold

    g = Gold(spark, SF_SMALL).customers()
    assert g.filter(F.col("effective_end_date") == OPEN).groupBy("customer_id").count().filter("count>1").count() == 0
    assert g.select("customer_id_sk").distinct().count() == g.count()


def test_scd2_merge_changes_only_batch(spark):
    """A batch with changes and no new keys: every changed key still gets a fresh surrogate key."""
    from lakestrata.plans.star import Gold

    t1 = Gold(spark, SF_SMALL).customers(1)
    b = fx.silver_customers(spark, SF_SMALL, "2b")
    via_merge = merge.scd2_merge(t1, merge.scd2_prepare(t1, b, ["customer_id"], "customer_id_sk"),
                                 ["customer_id_sk"], D2)
    direct = merge.scd2_state(t1, b, ["customer_id"], "customer_id_sk", D2)
    assert via_merge.count() == direct.count() > t1.count()
    assert via_merge.exceptAll(direct.select(*via_merge.columns)).count() == 0
    assert via_merge.select("customer_id_sk").distinct().count() == via_merge.count()
