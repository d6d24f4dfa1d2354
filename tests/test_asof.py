"""The ordered as-of lookup equals the range join, and its rows do not multiply."""
import datetime as dt
import random

import pytest

from lakestrata.operators.asof import carry_forward_lookup
from lakestrata.operators.lookup import Lookup, resolve_lookups

DAY = dt.date(2024, 1, 1)
DIM = "cid long, effective_start_date date, effective_end_date date, cid_sk long"


def rows(df):
    return sorted(df.collect(), key=str)


def versions(rng, keys, n):
    """Versions side by side, with gaps and empty ones."""
    out = []
    for k in range(keys):
        at = DAY
        for _ in range(rng.randint(n // 2, n)):
            at += dt.timedelta(rng.choice([0, 0, 1, 3]))
            end = at + dt.timedelta(rng.choice([0, 2, 6]))
            out.append((k, at, end, 1000 * k + len(out)))
            at = end
    return out


@pytest.mark.parametrize("close", ["same_day", "day_before"])
def test_equals_the_range_join(spark, close):
    rng = random.Random(3)
    dim = versions(rng, 12, 15)
    if close == "day_before":  # inclusive ends: no day belongs to two versions
        dim = [(k, s, e - dt.timedelta(1), sk) for k, s, e, sk in dim if e > s]
    dim = spark.createDataFrame(dim, DIM)
    facts = [(i, rng.choice([None, "x", *map(str, range(14))]), rng.choice([None, DAY + dt.timedelta(rng.randint(-3, 40))]), 7) for i in range(400)]
    facts = spark.createDataFrame(facts + facts[:20], "n long, cid string, d date, cid_sk long")
    look = [Lookup(dim, "cid_sk", ("cid",))]
    want = resolve_lookups(facts, look, "as_of", "d", close)
    got = resolve_lookups(facts, look, "as_of_ordered", "d", close)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got) == rows(want) and got.count() == 420 and got.filter("cid_sk IS NOT NULL").count() > 50


def test_overlaps_ties_and_open_ends(spark):
    day = lambda n: DAY + dt.timedelta(n)
    dim = spark.createDataFrame([(1, day(0), day(9), 1), (1, day(3), day(5), 2), (1, day(3), day(6), 3), (1, day(3), day(6), 4), (2, day(0), None, 5),
                                 (3, None, None, 6), (None, day(0), None, 7)], DIM)
    facts = spark.createDataFrame([(k, day(n)) for k in (1, 2, 3, None) for n in (-1, 0, 2, 3, 6, 20)], "cid long, d date")
    got = [r.cid_sk for r in carry_forward_lookup(facts, dim, "cid_sk", ["cid"], "d").orderBy("cid", "d").collect()]
    assert got == [None] * 6 + [None, 1, 1, 4, None, None] + [None, 5, 5, 5, 5, 5] + [None] * 6
    none = carry_forward_lookup(facts, dim.limit(0), "cid_sk", ["cid"], "d")
    assert none.count() == 24 and none.filter("cid_sk IS NOT NULL").count() == 0
    assert carry_forward_lookup(facts.limit(0), dim, "cid_sk", ["cid"], "d").count() == 0
    with pytest.raises(ValueError):
        resolve_lookups(facts, [Lookup(dim, "cid_sk", ("cid",))], "as_of_ordered")


def test_a_hot_key_brings_one_row_a_day_to_the_window(spark, tmp_path):
    """A third of the facts ask for one key: the ordered pass sees its different days, not its facts."""
    facts = spark.range(60_000).selectExpr("IF(id % 3 = 0, 0, id) AS cid", "date_add(DATE '2024-01-01', CAST(id % 90 AS INT)) AS d")
    dim = spark.range(90).selectExpr("0L AS cid", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS effective_start_date",
                                     "date_add(DATE '2024-01-02', CAST(id AS INT)) AS effective_end_date", "id AS cid_sk")
    got = carry_forward_lookup(facts, dim, "cid_sk", ["cid"], "d")
    assert got.count() == 60_000 and got.filter("cid_sk = datediff(d, DATE '2024-01-01')").count() == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.index("Window") < plan.index("HashAggregate")  # the pairs are reduced below the window
