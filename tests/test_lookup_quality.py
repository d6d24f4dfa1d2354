import datetime as dt

from pyspark.sql import functions as F

from lakestrata import contract as C
from lakestrata.operators.lookup import Lookup, lookups_from_specs, reference_specs, resolve_lookups
from lakestrata.operators.quality import contract_checks, contract_violations, lineage_edges

OPEN = dt.date(9999, 12, 31)


def _dim(spark):
    return spark.createDataFrame(
        [(1, 10, dt.date(2020, 1, 1), dt.date(2021, 1, 1)), (1, 11, dt.date(2021, 1, 1), OPEN),
         (2, 20, dt.date(2020, 1, 1), OPEN)],
        "cid int, cid_sk long, effective_start_date date, effective_end_date date")


def _fact(spark):
    return spark.createDataFrame([("1", dt.date(2020, 6, 1)), ("1", dt.date(2021, 1, 1)), ("3", dt.date(2020, 1, 1))],
                                 "cid string, d date")


def test_lookup_versions(spark):
    dim, fact = _dim(spark), _fact(spark)
    lk = [Lookup(dim, "cid_sk", ("cid",))]
    cur = sorted((r.d, r.cid_sk) for r in resolve_lookups(fact, lk).collect())
    assert cur == [(dt.date(2020, 1, 1), None), (dt.date(2020, 6, 1), 11), (dt.date(2021, 1, 1), 11)]
    allv = resolve_lookups(fact, lk, versions="all")
    assert allv.count() == 5  # fan-out over both versions of key 1
    asof = sorted((r.d, r.cid_sk) for r in resolve_lookups(fact, lk, versions="as_of", as_of_col="d").collect())
    assert asof == [(dt.date(2020, 1, 1), None), (dt.date(2020, 6, 1), 10), (dt.date(2021, 1, 1), 11)]


def test_reference_specs_group_composite_keys():
    fields = [{"name": "a", "skField": "x_sk, y_sk", "refField": "ra, rya", "refSkField": "x_sk, y_sk",
               "refDimension": "dx, dy", "refDimensionType": "type2, type1"},
              {"name": "b", "skField": "y_sk", "refField": "ryb", "refSkField": "y_sk", "refDimension": "dy"}]
    specs = {s.sk: s for s in reference_specs(fields)}
    assert specs["x_sk"].fields == ["a"] and specs["x_sk"].dimension_type == "type2"
    assert specs["y_sk"].fields == ["a", "b"] and specs["y_sk"].ref_fields == ["rya", "ryb"]


def test_contract_checks_and_violations(spark):
    c = C.Contract("t", (C.Field("id", "int", required=True, unique=True),
                         C.Field("mail", "string", pattern=C.EMAIL_PATTERN),
                         C.Field("kind", "string", enum=("a", "b"))), primary_key=("id",))
    df = spark.createDataFrame([("1", "x@y.zz", "a"), ("1", "bad", "c"), ("q", None, None), (None, "u@v.ww", "b")],
                               "id string, mail string, kind string")
    got = {(r.check, r.column_name): (r.total, r.failed) for r in contract_checks(df, c).collect()}
    assert got[("required", "id")] == (4, 1)
    assert got[("type", "id")] == (4, 1)
    assert got[("pattern", "mail")] == (4, 1)
    assert got[("enum", "kind")] == (4, 1)
    assert got[("unique", "id")] == (4, 2)
    v = {(r.id, r.check) for r in contract_violations(df, c, ["id"]).collect()}
    assert ("1", "unique") in v and ("1", "pattern") in v and ("q", "type") in v and (None, "required") in v


def test_lineage_edges(spark):
    df = spark.createDataFrame([(1, ["a.b.c", "cat.sch.tab.col", "too.short"])], "id int, refs array<string>")
    got = sorted(tuple(r) for r in lineage_edges(df, "refs", ["id"]).collect())
    assert got == [(1, "a", "b", "c"), (1, "cat.sch", "tab", "col")]


def test_quarantine_split_partitions_rows(spark):
    from lakestrata.operators.quality import quarantine_split

    c = C.Contract("t", (C.Field("id", "int", required=True, unique=True),
                         C.Field("mail", "string", pattern=C.EMAIL_PATTERN)), primary_key=("id",))
    df = spark.createDataFrame([("1", "x@y.zz"), ("1", "a@b.cc"), ("2", "bad"), ("3", "u@v.ww"), (None, None)],
                               "id string, mail string")
    good, bad = quarantine_split(df, c)
    assert sorted(r.id for r in good.collect()) == ["3"]
    reasons = {(r.id, r.mail): r.violations for r in bad.collect()}
    assert reasons[("2", "bad")] == "pattern:mail"
    assert reasons[("1", "x@y.zz")] == "unique:id,primary_key:id"
    assert reasons[(None, None)] == "required:id"
    assert good.count() + bad.count() == df.count()


def test_business_keys_and_log_append(spark, tmp_path):
    from lakestrata.sources import control

    c = C.contract_from_dict({"models": {"m": {"fields": {"a": {"type": "int"}}, "primaryKey": ["a"],
                                               "businessKeys": ["b1", "b2"]}}})
    assert c.keys == ("b1", "b2") and c.primary_key == ("a",)
    runs = spark.createDataFrame([("1", "t", "p", "s", "e", "f", "ERROR", "x")], control.LOG_SCHEMA)
    control.append_log(runs, str(tmp_path / "log"))
    control.append_log(runs, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
