"""The two-employee example: a plain <> compare misses a NULL -> value change; the null-safe one does not."""
from pyspark.sql import types as T

from lakestrata.operators.changes import changed_rows


def _frames(spark):
    target = spark.createDataFrame(
        [(1, "Alice", "Finance", "2024-01-01", "9999-12-31"), (2, "Bob", "IT", "2024-01-01", "9999-12-31")],
        "emp_id int, name string, dept string, effective_start_date string, effective_end_date string")
    source = spark.createDataFrame(
        [(1, "Alice", "HR", "NY", "2024-02-01", "9999-12-31"), (2, "Bob", "IT", "SF", "2024-02-01", "9999-12-31")],
        T.StructType([T.StructField("emp_id", T.IntegerType()), T.StructField("name", T.StringType()),
                      T.StructField("dept", T.StringType()), T.StructField("location", T.StringType()),
                      T.StructField("effective_start_date", T.StringType()),
                      T.StructField("effective_end_date", T.StringType())]))
    return target, source


def test_unsafe_compare_finds_only_the_dept_change(spark):
    target, source = _frames(spark)
    out = changed_rows(target, source, ["emp_id"], ignore=["effective_start_date", "effective_end_date"],
                       null_safe=False)
    assert sorted(r.emp_id for r in out.collect()) == [1]


def test_null_safe_compare_finds_both(spark):
    target, source = _frames(spark)
    out = changed_rows(target, source, ["emp_id"], ignore=["effective_start_date", "effective_end_date"])
    rows = {r.emp_id: r for r in out.collect()}
    assert sorted(rows) == [1, 2]
    assert rows[1].dept == "HR" and rows[2].location == "SF"
