import datetime as dt

from lakestrata import contract as C
from lakestrata.functions.cleansing import (contract_cast, default_value, fill_null_keys, pattern_clean,
                                            project_to_contract)


def test_default_value_name_rule_beats_type():
    assert default_value("contact_email", "int") == "unknown@example.com"
    assert default_value("phone_no", "string") == "0000000000"
    assert default_value("qty", "decimal") == 0
    assert default_value("d", "date") == "1800-01-01"
    assert default_value("x", "string") == ""


def test_pattern_clean_nulls_become_default_and_type_kept(spark):
    c = C.Contract("t", (C.Field("code", "int", pattern=r"^[0-9]+$"), C.Field("email", "string", pattern=C.EMAIL_PATTERN)))
    df = spark.createDataFrame([("12", "a@b.co"), ("x", None), (None, "bad")], "code string, email string")
    out = pattern_clean(df, c)
    assert dict(out.dtypes)["code"] == "string"
    assert [tuple(r) for r in out.collect()] == [("12", "a@b.co"), ("0", "unknown@example.com"),
                                                 ("0", "unknown@example.com")]


def test_contract_cast_is_lenient_and_adds_absent_columns(spark):
    c = C.Contract("t", (C.Field("n", "int"), C.Field("d", "date"), C.Field("p", "decimal"), C.Field("gone", "long")))
    df = spark.createDataFrame([("7", "2024-01-02", "1.5"), ("x", "nope", None)], "n string, d string, p string")
    out = contract_cast(df, c)
    assert dict(out.dtypes) == {"n": "int", "d": "date", "p": "decimal(30,10)", "gone": "bigint"}
    rows = out.collect()
    assert rows[0].n == 7 and rows[0].d == dt.date(2024, 1, 2) and rows[1].n is None and rows[1].d is None


def test_fill_null_keys_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, i int, d date, b boolean")
    r = fill_null_keys(df, ["s", "i", "d", "b"]).first()
    assert (r.s, r.i, r.d, r.b) == ("", 0, dt.date(1800, 1, 1), None)


def test_project_to_contract_coarse(spark):
    c = C.Contract("t", (C.Field("a", "int"), C.Field("b", "decimal"), C.Field("c", "date"), C.Field("z", "long")))
    df = spark.createDataFrame([(1, "2.5", "2024-01-01")], "a int, b string, c string")
    out = project_to_contract(df, c, coarse=True)
    assert out.columns == ["a", "b", "c", "z"]
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "timestamp", "z": "string"}


def test_table_type_whole_word_and_explicit():
    assert C.table_type_from_description("SCD2 Product dimension") == "SCD2"
    assert C.table_type_from_description("MANUFACTURER table") == "UNKNOWN"
    assert C.table_type_from_description("FACT Order table (curated)") == "FACT"
    assert C.table_type_from_description("anything", "scd1") == "SCD1"


def test_contract_from_yaml(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("""
info: {description: SCD1 Supplier dimension}
models:
  m:
    fields:
      supplier_id: {type: int, required: true, unique: true}
      phone: {type: string, pattern: "^[0-9]+$"}
      supplier_id_sk: {type: long}
      nation_sk: {type: long}
    primaryKey: [supplier_id]
    dependencies:
      - {table: gold.nation, surrogateKey: nation_sk, naturalKeys: [nation_id]}
""")
    c = C.load_contract(str(p))
    assert c.table_type == "SCD1" and c.primary_key == ("supplier_id",)
    assert c.surrogate_keys() == ["supplier_id_sk", "nation_sk"] and c.own_surrogate_keys() == ["supplier_id_sk"]
    assert c.to_struct_type()["supplier_id"].nullable is False


def test_evolution_gate():
    assert C.evolution_allowed(["a", "b", "n"], ["a", "b"], ["a", "b", "n"])
    assert not C.evolution_allowed(["a", "x"], ["a"], ["a", "b"])
    assert C.evolution_allowed(["a"], ["a", "b"], [])
