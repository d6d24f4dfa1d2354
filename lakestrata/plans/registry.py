"""Registered queries: one per operator, each with an independent DuckDB oracle statement.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator over whole test tables (or batches Spark
derives from them). ``ORACLE[name]`` recomputes the same rows in DuckDB from the same parquet tables.
Ingest times and other timestamps are rendered as text on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata import contract as C
from lakestrata.functions.cleansing import contract_cast, fill_null_keys, pattern_clean, project_to_contract
from lakestrata.functions.cleansing import reorder_sk_last
from lakestrata.functions.conditions import null_safe_key_condition, padded_key_condition
from lakestrata.functions.hashing import row_hash
from lakestrata.functions.timefmt import format_batch_tag, iso_text, local_batch_tag
from lakestrata.operators import changes, merge
from lakestrata.operators.dedup import one_per_key
from lakestrata.operators.evolution import gated_append, read_evolved
from lakestrata.operators.keys import assign_surrogate_keys, dense_keys, max_key
from lakestrata.operators.lookup import lookups_from_specs, reference_specs, resolve_lookups
from lakestrata.operators.quality import contract_checks, contract_violations, lineage_edges
from lakestrata.plans import fixtures as fx
from lakestrata.plans import star, views
from lakestrata.plans.star import portable, with_ctes
from lakestrata.session import scratch_dir
from lakestrata.sources import control
from lakestrata.sources.landing import new_files_since, read_landing_csv, write_landing_csv
from lakestrata.sources.tables import incremental_read, write_table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _t(spark, d, name):
    return fx.table(spark, d, name)


def _ts_sql(col: str) -> str:
    return f"strftime(TRY_CAST({col} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')"


# ====================================================================== contract cleansing (customer)
@register("contract_cast", with_ctes(f"""SELECT TRY_CAST(customer_id AS BIGINT) AS customer_id, name, email, phone,
  address, TRY_CAST(loyalty_points AS INTEGER) AS loyalty_points, extract_timestamp,
  {_ts_sql('dbx_extract_timestamp')} AS dbx_extract_timestamp FROM raw_call"""))
def q_contract_cast(spark, d):
    return portable(contract_cast(fx.raw_customers(spark, d, "all"), C.SILVER_CUSTOMERS))


@register("pattern_clean", with_ctes(f"""SELECT customer_id, name,
  CASE WHEN regexp_matches(email, '{C.EMAIL_PATTERN}') THEN email ELSE 'unknown@example.com' END AS email,
  CASE WHEN regexp_matches(phone, '{C.PHONE_PATTERN}') THEN phone ELSE '0000000000' END AS phone,
  address, loyalty_points, extract_timestamp, dbx_extract_timestamp FROM raw_call"""))
def q_pattern_clean(spark, d):
    return pattern_clean(fx.raw_customers(spark, d, "all"), C.SILVER_CUSTOMERS)


@register("fill_null_keys", """SELECT o_orderkey,
  COALESCE(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END, '') AS priority,
  COALESCE(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END, 0) AS custkey,
  COALESCE(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END, DATE '1800-01-01') AS order_date,
  COALESCE(CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END, 0) AS total
FROM orders""")
def q_fill_null_keys(spark, d):
    k = F.col("o_orderkey")
    o = _t(spark, d, "orders").select(
        "o_orderkey",
        F.when(k % 7 == 0, None).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 11 == 0, None).otherwise(F.col("o_custkey")).alias("custkey"),
        F.when(k % 13 == 0, None).otherwise(F.col("o_orderdate").cast("date")).alias("order_date"),
        F.when(k % 17 == 0, None).otherwise(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"))
    return fill_null_keys(o, ["priority", "custkey", "order_date", "total"])


_PROJECT_CONTRACT = C.GOLD_CUSTOMERS.with_fields(C.Field("region_name", "string"))


@register("project_to_contract", with_ctes("""SELECT CAST(customer_id AS BIGINT) AS customer_id, name, email, phone,
  address, loyalty_points, extract_timestamp, dbx_extract_timestamp,
  CAST(NULL AS VARCHAR) AS customer_id_sk, CAST(NULL AS VARCHAR) AS effective_start_date,
  CAST(NULL AS VARCHAR) AS effective_end_date, region_name FROM
  (SELECT s.*, r.r_name AS region_name FROM sil_call s JOIN customer c ON c.c_custkey = s.customer_id
     JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey) x"""))
def q_project_to_contract(spark, d):
    regions = (_t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
               .join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
               .select(F.col("c_custkey"), F.col("r_name").alias("region_name")))
    s = fx.silver_customers(spark, d, "all")
    s = s.join(regions, s["customer_id"] == regions["c_custkey"]).drop("c_custkey")
    return portable(project_to_contract(s, _PROJECT_CONTRACT, coarse=True))


@register("reorder_sk_last", with_ctes("SELECT * FROM gold_call"))
def q_reorder_sk_last(spark, d):
    g = merge.scd2_first_load(fx.silver_customers(spark, d, "all"), ["customer_id"], "customer_id_sk", fx.B1_ASOF)
    return portable(reorder_sk_last(g.select("customer_id_sk", *[c for c in g.columns if c != "customer_id_sk"]),
                                    ["customer_id_sk"]))


_HASH_SQL = "md5(concat_ws('||', " + ", ".join(
    f"COALESCE(CAST({c} AS VARCHAR), '')" for c in star.COMPARE_CUSTOMERS) + "))"


@register("row_hash", with_ctes(f"SELECT customer_id, {_HASH_SQL} AS _hash FROM sil_call"))
def q_row_hash(spark, d):
    return fx.silver_customers(spark, d, "all").select("customer_id", row_hash(star.COMPARE_CUSTOMERS).alias("_hash"))


# --------------------------------------------------------------------------- contract checks
def _checks_sql(contract: C.Contract, src: str) -> tuple[str, str]:
    """Oracle text for the per-row rules and for the violations, generated from the contract fields."""
    rows, viol = [], []
    for f in contract.fields:
        preds = []
        if f.required:
            preds.append(("required", f"{f.name} IS NULL"))
        if f.type.lower() not in ("string", "varchar", "char", "text"):
            t = {"int": "INTEGER", "integer": "INTEGER", "long": "BIGINT", "timestamp": "TIMESTAMP",
                 "date": "DATE"}[f.type.lower()]
            preds.append(("type", f"{f.name} IS NOT NULL AND TRY_CAST({f.name} AS {t}) IS NULL"))
        if f.pattern:
            preds.append(("pattern", f"{f.name} IS NOT NULL AND NOT regexp_matches({f.name}, '{f.pattern}')"))
        for chk, p in preds:
            rows.append(f"SELECT '{chk}' AS \"check\", '{f.name}' AS column_name, COUNT(*) AS total, "
                        f"CAST(SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM {src}")
            viol.append(f"SELECT customer_id, '{chk}' AS \"check\", '{f.name}' AS column_name FROM {src} WHERE {p}")
    for chk, col in (("unique", "customer_id"), ("primary_key", "customer_id")):
        rows.append(f"""SELECT '{chk}' AS "check", '{col}' AS column_name, CAST(SUM(n) AS BIGINT) AS total,
          CAST(COALESCE(SUM(CASE WHEN k IS NOT NULL AND n > 1 THEN n END), 0) AS BIGINT) AS failed
          FROM (SELECT {col} AS k, COUNT(*) AS n FROM {src} GROUP BY {col}) g""")
        viol.append(f"""SELECT customer_id, '{chk}' AS "check", '{col}' AS column_name FROM {src}
          WHERE {col} IN (SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1)""")
    return " UNION ALL ".join(rows), " UNION ALL ".join(viol)


_CHK_SQL, _VIOL_SQL = _checks_sql(C.SILVER_CUSTOMERS, "raw_both")
_RAW_BOTH = [("raw_both", "SELECT * FROM raw_c1 UNION ALL SELECT * FROM raw_c2")]


def _raw_both(spark, d):
    return fx.raw_customers(spark, d, "1").unionByName(fx.raw_customers(spark, d, "2"))


@register("contract_checks", with_ctes(_CHK_SQL, _RAW_BOTH))
def q_contract_checks(spark, d):
    return contract_checks(_raw_both(spark, d), C.SILVER_CUSTOMERS)


@register("contract_violations", with_ctes(_VIOL_SQL, _RAW_BOTH))
def q_contract_violations(spark, d):
    return contract_violations(_raw_both(spark, d), C.SILVER_CUSTOMERS, ["customer_id"])


# ------------------------------------------------------------------------- schema evolution
_EVOLVED_SQL = [("evolved", """SELECT s.*, r.r_name AS region_name FROM sil_c2 s JOIN customer c ON c.c_custkey = s.customer_id
     JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey""")]
_EVOLVED_OUT = "SELECT *, CAST(NULL AS VARCHAR) AS region_name FROM sil_c1 UNION ALL BY NAME SELECT * FROM evolved"


def _evolved_batch(spark, d):
    regions = (_t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
               .join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
               .select(F.col("c_custkey"), F.col("r_name").alias("region_name")))
    s = fx.silver_customers(spark, d, "2")
    return s.join(regions, s["customer_id"] == regions["c_custkey"]).drop("c_custkey")


def _evolution_run(spark, d, with_refused: bool):
    path = scratch_dir(spark, "evolved") + "/dim_customers"
    allowed = C.SILVER_CUSTOMERS.columns + ["region_name"]
    write_table(fx.silver_customers(spark, d, "1"), path, mode="overwrite", partition_by=[C.EXTRACT_TAG])
    ok = gated_append(spark, _evolved_batch(spark, d), path, allowed)
    refused = None
    if with_refused:  # a column the contract does not declare: nothing is written
        refused = gated_append(spark, fx.silver_customers(spark, d, "2b").withColumn("secret_note", F.lit("x")),
                               path, allowed)
    if not ok or refused:
        raise AssertionError("schema gate decided wrongly")
    return portable(read_evolved(spark, path))


@register("evolved_append", with_ctes(_EVOLVED_OUT, _EVOLVED_SQL))
def q_evolved_append(spark, d):
    return _evolution_run(spark, d, with_refused=False)


@register("schema_evolution_gate", with_ctes(_EVOLVED_OUT, _EVOLVED_SQL))
def q_schema_evolution_gate(spark, d):
    return _evolution_run(spark, d, with_refused=True)


@register("partitioned_write_roundtrip", with_ctes("SELECT * FROM sil_c1 UNION ALL SELECT * FROM sil_c2"))
def q_partitioned_write_roundtrip(spark, d):
    path = scratch_dir(spark, "partitioned") + "/silver_customers"
    both = fx.silver_customers(spark, d, "1").unionByName(fx.silver_customers(spark, d, "2"))
    write_table(both, path, mode="overwrite", partition_by=[C.EXTRACT_TAG])
    return portable(spark.read.parquet(path))  # both batch-tag partitions, read back whole


# ====================================================================== dedup and keys
_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus"]


def _dedup_sql(direction: str, nulls: str) -> str:
    order = ", ".join(f"{c} {direction} NULLS {nulls}" for c in ["l_shipdate"] + _LI_REST)
    return f"""SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


@register("dedup_latest", _dedup_sql("DESC", "LAST"))
def q_dedup_latest(spark, d):
    return portable(one_per_key(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", "latest"))


@register("dedup_first", _dedup_sql("ASC", "FIRST"))
def q_dedup_first(spark, d):
    return portable(one_per_key(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", "first"))


@register("dense_keys", """SELECT o_custkey, o_orderkey,
  CAST(row_number() OVER (ORDER BY o_custkey NULLS FIRST, o_orderkey NULLS FIRST) AS BIGINT) AS order_sk FROM orders""")
def q_dense_keys(spark, d):
    return dense_keys(_t(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], "order_sk")


@register("assign_surrogate_keys", """WITH t AS (SELECT c_custkey, c_name,
    CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_sk FROM customer WHERE c_custkey % 10 <> 9)
  SELECT * FROM t UNION ALL
  SELECT c_custkey, c_name, CAST((SELECT COALESCE(MAX(customer_sk), 0) FROM t)
         + row_number() OVER (ORDER BY c_custkey) AS BIGINT) FROM customer WHERE c_custkey % 10 = 9""")
def q_assign_surrogate_keys(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    first = assign_surrogate_keys(c.filter(F.col("c_custkey") % 10 != 9), "customer_sk", ["c_custkey"])
    later = assign_surrogate_keys(c.filter(F.col("c_custkey") % 10 == 9), "customer_sk", ["c_custkey"], target=first)
    return first.unionByName(later)


@register("max_surrogate_key", with_ctes("SELECT CAST(COALESCE(MAX(customer_id_sk), 0) AS BIGINT) AS max_sk FROM gold_c2"))
def q_max_surrogate_key(spark, d):
    return max_key(star.gold_customers(spark, d), "customer_id_sk")


@register("incremental_read", """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
  FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01 00:00:00'""")
def q_incremental_read(spark, d):
    o = incremental_read(_t(spark, d, "orders"), "o_orderdate", F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
    return portable(o.select("o_orderkey", "o_custkey", "o_orderdate"))


# ====================================================================== change detection (customer batches)
_NS_DIFF = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in star.COMPARE_CUSTOMERS)
_UNSAFE_DIFF = " OR ".join(f"a.{c} <> b.{c}" for c in star.COMPARE_CUSTOMERS)
_IGNORE = ["customer_id_sk", *C.SYSTEM_COLUMNS]


@register("new_rows_anti", with_ctes("""SELECT b.* FROM sil_c2 b
  WHERE NOT EXISTS (SELECT 1 FROM gold_c1 t WHERE t.customer_id = b.customer_id)"""))
def q_new_rows_anti(spark, d):
    return portable(changes.new_rows(fx.silver_customers(spark, d, "2"), star.gold_customers(spark, d, 1),
                                     ["customer_id"]))


@register("changed_records", with_ctes(f"SELECT b.* FROM gold_c1 a JOIN sil_c2 b ON a.customer_id = b.customer_id WHERE {_NS_DIFF}"))
def q_changed_records(spark, d):
    return portable(changes.changed_rows(star.gold_customers(spark, d, 1), fx.silver_customers(spark, d, "2"),
                                         ["customer_id"], ignore=_IGNORE))


@register("changed_records_unsafe", with_ctes(f"SELECT b.* FROM gold_c1 a JOIN sil_c2 b ON a.customer_id = b.customer_id WHERE {_UNSAFE_DIFF}"))
def q_changed_records_unsafe(spark, d):
    return portable(changes.changed_rows(star.gold_customers(spark, d, 1), fx.silver_customers(spark, d, "2"),
                                         ["customer_id"], ignore=_IGNORE, null_safe=False))


_HASH_B = _HASH_SQL.replace("COALESCE(CAST(", "COALESCE(CAST(b.")
_HASH_A = _HASH_SQL.replace("COALESCE(CAST(", "COALESCE(CAST(a.")


@register("changed_by_hash", with_ctes(f"""SELECT b.*, {_HASH_B} AS _src_hash FROM sil_c2 b
  JOIN gold_c1 a ON a.customer_id = b.customer_id WHERE {_HASH_B} <> {_HASH_A}"""))
def q_changed_by_hash(spark, d):
    return portable(changes.changed_by_hash(star.gold_customers(spark, d, 1), fx.silver_customers(spark, d, "2"),
                                            ["customer_id"], star.COMPARE_CUSTOMERS))


# ====================================================================== SCD2 (validity dates)
@register("scd2_gold", with_ctes("SELECT * FROM gold_c2"))
def q_scd2_gold(spark, d):
    return portable(star.gold_customers(spark, d, 2))


@register("scd2_merge", with_ctes("SELECT * FROM gold_c2"))
def q_scd2_merge(spark, d):
    t1 = star.Gold(spark, d).customers(1)
    src = merge.scd2_prepare(t1, fx.silver_customers(spark, d, "2"), ["customer_id"], "customer_id_sk")
    return portable(merge.scd2_merge(t1, src, ["customer_id_sk"], fx.B2_ASOF))


@register("scd2_current", with_ctes("SELECT * FROM gold_c2 WHERE effective_end_date = DATE '9999-12-31'"))
def q_scd2_current(spark, d):
    return portable(merge.current_versions(star.gold_customers(spark, d, 2)))


# ---------------------------------------------------------------------- SCD2 (hash + active flag)
_H = [
    ("hash_c1", f"""SELECT s.*, DATE '{fx.B1_ASOF}' AS effective_start_date,
        CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_id_sk,
        DATE '9999-12-31' AS effective_end_date, TRUE AS is_active, {_HASH_SQL} AS _hash FROM sil_c1 s"""),
    ("hash_src", f"SELECT s.*, DATE '{fx.B2_ASOF}' AS effective_start_date, {_HASH_SQL} AS _hash FROM sil_c2 s"),
    ("hash_cls", """SELECT s.*, a._hash AS _tgt_hash FROM hash_src s
        LEFT JOIN (SELECT customer_id, _hash FROM hash_c1 WHERE is_active) a ON a.customer_id = s.customer_id"""),
    ("hash_c2", """SELECT t.* REPLACE (
          CASE WHEN x.customer_id IS NOT NULL AND t.is_active THEN x._new_end ELSE t.effective_end_date END AS effective_end_date,
          CASE WHEN x.customer_id IS NOT NULL AND t.is_active THEN FALSE ELSE t.is_active END AS is_active)
        FROM hash_c1 t LEFT JOIN (SELECT customer_id, CAST(effective_start_date - INTERVAL 1 DAY AS DATE) AS _new_end
                                  FROM hash_cls WHERE _tgt_hash IS NOT NULL AND _tgt_hash <> _hash) x
          ON x.customer_id = t.customer_id
        UNION ALL BY NAME
        SELECT * EXCLUDE (_tgt_hash), CAST((SELECT COALESCE(MAX(customer_id_sk), 0) FROM hash_c1)
               + row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_id_sk,
          DATE '9999-12-31' AS effective_end_date, TRUE AS is_active
        FROM hash_cls WHERE _tgt_hash IS NULL OR _tgt_hash <> _hash"""),
]


def _hash_state(spark, d):
    t1 = merge.scd2_hash_first_load(fx.silver_customers(spark, d, "1"), ["customer_id"], star.COMPARE_CUSTOMERS,
                                    "customer_id_sk", fx.B1_ASOF)
    return merge.scd2_hash_state(t1, fx.silver_customers(spark, d, "2"), ["customer_id"], star.COMPARE_CUSTOMERS,
                                 "customer_id_sk", fx.B2_ASOF)


@register("scd2_hash", with_ctes("SELECT * FROM hash_c2", _H))
def q_scd2_hash(spark, d):
    return portable(_hash_state(spark, d))


@register("scd2_hash_current", with_ctes("SELECT * FROM hash_c2 WHERE is_active", _H))
def q_scd2_hash_current(spark, d):
    return portable(merge.active_versions(_hash_state(spark, d)))


# ====================================================================== SCD1 (suppliers)
@register("scd1_gold", with_ctes("SELECT * FROM gold_s2"))
def q_scd1_gold(spark, d):
    return portable(star.gold_suppliers(spark, d, 2))


@register("scd1_merge", with_ctes("SELECT * FROM gold_s2"))
def q_scd1_merge(spark, d):
    s1 = star.Gold(spark, d).suppliers(1)
    src = merge.scd1_prepare(s1, fx.silver_suppliers(spark, d, "2"), ["supplier_id"], "supplier_id_sk", fx.B2_ASOF)
    return portable(merge.scd1_merge(s1, src, ["supplier_id_sk"]))


_SUP_COLS = ["supplier_id", "name", "phone", "address", C.EXTRACT_TAG, C.INGEST_TS]
_UPSERT = [
    ("ups1", "SELECT *, CAST(row_number() OVER (ORDER BY supplier_id) AS BIGINT) AS supplier_id_sk FROM sil_s1"),
    ("ups2", """SELECT t.* FROM ups1 t WHERE NOT EXISTS (SELECT 1 FROM sil_s2 b WHERE b.supplier_id = t.supplier_id)
      UNION ALL BY NAME SELECT b.*, t.supplier_id_sk FROM sil_s2 b JOIN ups1 t ON b.supplier_id = t.supplier_id
      UNION ALL BY NAME SELECT b.*, CAST((SELECT COALESCE(MAX(supplier_id_sk), 0) FROM ups1)
          + row_number() OVER (ORDER BY b.supplier_id) AS BIGINT) AS supplier_id_sk
        FROM sil_s2 b WHERE NOT EXISTS (SELECT 1 FROM ups1 t WHERE t.supplier_id = b.supplier_id)"""),
]


@register("scd1_upsert", with_ctes("SELECT * FROM ups2", _UPSERT))
def q_scd1_upsert(spark, d):
    t = merge.scd1_upsert(None, fx.silver_suppliers(spark, d, "1"), ["supplier_id"], _SUP_COLS, "supplier_id_sk")
    return portable(merge.scd1_upsert(t, fx.silver_suppliers(spark, d, "2"), ["supplier_id"], _SUP_COLS,
                                      "supplier_id_sk"))


# ====================================================================== lookups and facts
_FACT_OUT = ["order_id", "customer_id", "product_id", "supplier_id", "order_date", "customer_id_sk", "product_id_sk"]


def _fact_sql(mode: str) -> str:
    return with_ctes(f"SELECT {', '.join(_FACT_OUT)} FROM fact_{mode}")


@register("fact_key_lookup", _fact_sql("all"))
def q_fact_key_lookup(spark, d):
    return star.Gold.shared(spark, d).orders("all").select(*_FACT_OUT)


@register("fact_key_lookup_current", _fact_sql("current"))
def q_fact_key_lookup_current(spark, d):
    return star.Gold.shared(spark, d).orders("current").select(*_FACT_OUT)


@register("fact_key_lookup_asof", _fact_sql("as_of"))
def q_fact_key_lookup_asof(spark, d):
    return star.Gold.shared(spark, d).orders("as_of").select(*_FACT_OUT)


# Field-level reference metadata with comma lists: one type-2 key, one composite type-1 key.
REF_FIELDS = [
    {"name": "customer_id", "skField": "customer_id_sk", "refField": "customer_id", "refSkField": "customer_id_sk",
     "refDimension": "dim_customers", "refDimensionType": "type2"},
    {"name": "product_id", "skField": "product_supplier_sk", "refField": "product_id",
     "refSkField": "product_id_sk", "refDimension": "dim_products", "refDimensionType": "type1"},
    {"name": "supplier_id", "skField": "product_supplier_sk", "refField": "supplier_id",
     "refSkField": "product_id_sk", "refDimension": "dim_products", "refDimensionType": "type1"},
]


@register("multi_ref_lookup", with_ctes("""SELECT o.order_id, o.customer_id, o.product_id, o.supplier_id, o.order_date,
    c.customer_id_sk, p.product_id_sk AS product_supplier_sk
  FROM sil_o o
  LEFT JOIN gold_c2 c ON o.customer_id = c.customer_id
    AND o.order_date >= c.effective_start_date AND o.order_date < c.effective_end_date
  LEFT JOIN gold_p p ON o.product_id = p.product_id AND CAST(o.supplier_id AS VARCHAR) = p.supplier_id"""))
def q_multi_ref_lookup(spark, d):
    g = star.Gold.shared(spark, d)
    dims = {"dim_customers": g.customers(), "dim_products": g.products()}
    lookups = lookups_from_specs(reference_specs(REF_FIELDS), dims, as_of=True)
    out = resolve_lookups(g.silver_orders(), lookups, as_of_col="order_date")
    return out.select("order_id", "customer_id", "product_id", "supplier_id", "order_date", "customer_id_sk",
                      "product_supplier_sk")


@register("null_safe_key_join", with_ctes("""SELECT a.customer_id, a.phone, a.address AS address_before,
    b.address AS address_after FROM raw_c1 a JOIN raw_c2 b
  ON a.customer_id = b.customer_id AND a.phone IS NOT DISTINCT FROM b.phone"""))
def q_null_safe_key_join(spark, d):
    a = fx.raw_customers(spark, d, "1").alias("a")
    b = fx.raw_customers(spark, d, "2").alias("b")
    return a.join(b, null_safe_key_condition(a, b, ["customer_id", "phone"])).select(
        F.col("a.customer_id"), F.col("a.phone"), F.col("a.address").alias("address_before"),
        F.col("b.address").alias("address_after"))


@register("padded_key_join", """SELECT c.cust_code, o.o_orderkey FROM
  (SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS cust_code FROM customer) c
  JOIN orders o ON lpad(c.cust_code, 15, '0') = lpad(CAST(o.o_custkey AS VARCHAR), 15, '0')""")
def q_padded_key_join(spark, d):
    c = _t(spark, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("cust_code"))
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return c.join(o, padded_key_condition(c, o, [("cust_code", "o_custkey")])).select("cust_code", "o_orderkey")


_FACT_TAG_SQL = "CASE WHEN order_date < DATE '1998-07-01' THEN 'DH_ORDERS_A' ELSE 'DH_ORDERS_B' END"


@register("fact_append", with_ctes(f"""SELECT order_id, customer_id_sk, product_id_sk, quantity, total_price,
  order_date, create_date, update_date, {_FACT_TAG_SQL} AS extract_timestamp FROM fact_current"""))
def q_fact_append(spark, d):
    from lakestrata.plans.jobs import append_fact

    fact = star.Gold.shared(spark, d).fact().withColumn(
        C.EXTRACT_TAG, F.when(F.col("order_date") < F.lit(fx.B2_ASOF), "DH_ORDERS_A").otherwise("DH_ORDERS_B"))
    fact = fact.select("order_id", "customer_id_sk", "product_id_sk", "quantity", "total_price", "order_date",
                       C.CREATE_DATE, C.UPDATE_DATE, C.EXTRACT_TAG)
    path = scratch_dir(spark, "fact") + "/fact_orders"
    for load, tag in (("1", "DH_ORDERS_A"), ("2", "DH_ORDERS_B"), ("2", "DH_ORDERS_B")):  # the last is a replay
        append_fact(spark, fact.filter(F.col(C.EXTRACT_TAG) == tag), path, load_id=load)
    return spark.read.parquet(path).drop("_load_id")


# ====================================================================== gold views
def _views_inputs(spark, d):
    g = star.Gold.shared(spark, d).build()  # stored once per application; later calls reuse the tables
    return g.fact(), g.customers(), g.products(), g.suppliers()


@register("loyalty_segments", with_ctes("""SELECT x.customer_id, x.name AS customer_name, x.pts AS loyalty_points,
    CASE WHEN x.pts >= 301 THEN 'Platinum' WHEN x.pts >= 201 THEN 'Gold' WHEN x.pts >= 100 THEN 'Silver' ELSE 'Bronze' END
      AS loyalty_tier, COUNT(DISTINCT x.order_id) AS total_orders, CAST(SUM(x.total_price) AS DECIMAL(18,2)) AS total_spent
  FROM (SELECT c.customer_id, c.name, COALESCE(c.loyalty_points, 0) AS pts, f.order_id, f.total_price
        FROM gold_c2 c, fact_current f WHERE f.customer_id_sk = c.customer_id_sk AND year(c.effective_end_date) = 9999) x
  GROUP BY ALL"""))
def q_loyalty_segments(spark, d):
    fact, cust, _, _ = _views_inputs(spark, d)
    return views.loyalty_segments(fact, cust)


def _share_sql(threshold: float) -> str:
    """Oracle: one grouped pass, then each supplier's share of its category by a window."""
    return with_ctes(f"""SELECT supplier_id, supplier_name, category, CAST(revenue AS DECIMAL(18,2)) AS category_revenue,
    CAST(revenue AS DOUBLE) / n_lines AS avg_order_value, total_orders, ROUND(part * 100, 2) AS revenue_share_pct,
    IF(part > {threshold}, 'Dominant Supplier', 'Competitive Market') AS supplier_role
  FROM (SELECT *, CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER (PARTITION BY category) AS DOUBLE) AS part
        FROM (SELECT sup.supplier_id, sup.name AS supplier_name, prod.category, SUM(f.total_price) AS revenue,
                COUNT(f.total_price) AS n_lines, COUNT(DISTINCT f.order_id) AS total_orders
              FROM gold_p prod JOIN gold_s2 sup USING (supplier_id_sk) JOIN fact_current f USING (product_id_sk)
              GROUP BY ALL) g) h""")


@register("supplier_category", _share_sql(views.DOMINANCE_SHARE))
def q_supplier_category(spark, d):
    fact, _, prod, sup = _views_inputs(spark, d)
    return views.supplier_category(fact, prod, sup)


@register("category_share_window", _share_sql(0.02))
def q_category_share_window(spark, d):
    fact, _, prod, sup = _views_inputs(spark, d)
    return views.category_share_window(fact, prod, sup, threshold=0.02)


# ====================================================================== control tables (derived from events)
_TS_FMT = "'%Y-%m-%d %H:%M:%S'"
_SOURCE_OF = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'consumer' ELSE 'web' END"
_CTL_SQL = [("ctl", f"""SELECT ascii(event_type) AS Id, 'events' AS SourceSystem, event_type AS EntityName,
      max(ts) AS WatermarkValue, max(ts) AS LastUpdatedOn, {_SOURCE_OF} AS Source
    FROM events WHERE event_type <> 'view' AND ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY event_type"""),
            ("files", """SELECT event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' AS name,
      event_type AS entity, date_trunc('second', ts) AS file_ts FROM events""")]


def _source_of(c):
    return F.when(c.isin("purchase", "signup"), "consumer").otherwise("web")


def _control_table(spark, d) -> DataFrame:
    """Watermark control rows: newest event before 2024-01-15 per entity (the 'view' entity has none yet)."""
    ev = _t(spark, d, "events")
    return (ev.filter((F.col("event_type") != "view") & (F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")))
            .groupBy("event_type")
            .agg(F.max("ts").alias("WatermarkValue"))
            .select(F.ascii("event_type").alias("Id"), F.lit("events").alias("SourceSystem"),
                    F.col("event_type").alias("EntityName"), "WatermarkValue",
                    F.col("WatermarkValue").alias("LastUpdatedOn"), _source_of(F.col("event_type")).alias("Source")))


def _landed_files(spark, d) -> DataFrame:
    """One landed file per event: ``<event_type>_<yyyyMMdd_HHmmss>.csv``."""
    ev = _t(spark, d, "events")
    return ev.select(F.concat(F.col("event_type"), F.lit("_"), F.date_format("ts", "yyyyMMdd_HHmmss"),
                              F.lit(".csv")).alias("name"))


@register("new_files_since", with_ctes(f"""SELECT f.name, f.entity, strftime(f.file_ts, {_TS_FMT}) AS file_ts
  FROM files f LEFT JOIN ctl ON ctl.EntityName = f.entity
  WHERE ctl.WatermarkValue IS NULL OR f.file_ts > ctl.WatermarkValue""", _CTL_SQL))
def q_new_files_since(spark, d):
    wm = _control_table(spark, d).select(F.col("EntityName").alias("entity_name"),
                                         F.col("WatermarkValue").alias("watermark_value"))
    return portable(new_files_since(_landed_files(spark, d), wm).select("name", "entity", "file_ts"))


@register("watermark_lookup", with_ctes(f"""SELECT Source AS source, EntityName AS entity_name,
  strftime(WatermarkValue, {_TS_FMT}) AS watermark_value FROM ctl WHERE Source = 'consumer'""", _CTL_SQL))
def q_watermark_lookup(spark, d):
    return portable(control.watermark_lookup(_control_table(spark, d), "consumer"))


@register("watermark_advance", with_ctes(f"""SELECT c.Id, COALESCE(c.SourceSystem, n.source) AS SourceSystem,
    COALESCE(c.EntityName, n.entity_name) AS EntityName,
    strftime(greatest(c.WatermarkValue, n._new), {_TS_FMT}) AS WatermarkValue,
    strftime(CASE WHEN n._new IS NOT NULL AND (c.WatermarkValue IS NULL OR n._new > c.WatermarkValue)
             THEN n._new ELSE c.LastUpdatedOn END, {_TS_FMT}) AS LastUpdatedOn,
    COALESCE(c.Source, n.source) AS Source
  FROM ctl c FULL OUTER JOIN (
    SELECT CASE WHEN entity IN ('purchase', 'signup') THEN 'consumer' ELSE 'web' END AS source,
      entity AS entity_name, max(file_ts) AS _new FROM files GROUP BY 1, 2) n
  ON c.Source = n.source AND c.EntityName = n.entity_name""", _CTL_SQL))
def q_watermark_advance(spark, d):
    from lakestrata.sources.landing import with_file_stamp

    fe = with_file_stamp(_landed_files(spark, d)).select(
        _source_of(F.col("entity")).alias("source"), F.col("entity").alias("entity_name"), "file_ts")
    return portable(control.advance_watermarks(_control_table(spark, d), fe))


@register("format_batch_tag", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0' AS iso_ts,
  strftime(ts, '%Y%m%d_%H%M%S') AS tag FROM events""")
def q_format_batch_tag(spark, d):
    ev = _t(spark, d, "events").select("event_id", iso_text("ts").alias("iso_ts"))
    return ev.withColumn("tag", format_batch_tag("iso_ts"))


@register("batch_tag_local", """SELECT event_id,
  strftime(ts + INTERVAL '5 hours 30 minutes', '%Y%m%d_%H%M%S') AS local_tag FROM events""")
def q_batch_tag_local(spark, d):
    return _t(spark, d, "events").select("event_id", local_batch_tag("ts").alias("local_tag"))


@register("holiday_count", """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
    WHERE dayofmonth(o_orderdate) = 1),
  cal AS (SELECT n_nationkey AS HolidayID, d AS HolidayDate FROM days JOIN nation ON month(d) - 1 = n_nationkey % 12),
  runs AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders)
  SELECT r.run_date, CAST(COUNT(c.HolidayID) AS BIGINT) AS holiday_count
  FROM runs r LEFT JOIN cal c ON c.HolidayDate = r.run_date GROUP BY r.run_date""")
def q_holiday_count(spark, d):
    o = _t(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    n = _t(spark, d, "nation")
    days = o.filter(F.dayofmonth("d") == 1).distinct()
    cal = days.join(n, (F.month("d") - 1) == (F.col("n_nationkey") % 12)).select(
        F.col("n_nationkey").alias("HolidayID"), F.col("d").alias("HolidayDate"),
        F.concat(F.lit("Founding day of "), F.col("n_name")).alias("HolidayName"),
        F.date_format("d", "EEEE").alias("HolidayDay"), F.year("d").alias("HolidayYear"))
    runs = o.select(F.col("d").alias("run_date")).distinct()
    return control.holiday_counts(cal, runs)


@register("audit_log_rows", """WITH runs AS (SELECT CAST(event_id AS VARCHAR) AS job_run_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", 'PL_' || upper(event_type) AS pipeline_name, 'bronze' AS stage,
    event_type AS entity, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' AS file_name,
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS status, props AS message FROM events)
  SELECT * FROM runs UNION ALL
  SELECT job_run_id, "timestamp", pipeline_name, 'Pipeline Final Status Logging' AS stage, entity, file_name, status,
    'Pipeline failed with error' || COALESCE(message, '') AS message FROM runs WHERE status = 'ERROR'""")
def q_audit_log_rows(spark, d):
    ev = _t(spark, d, "events")
    runs = ev.select(
        F.col("event_id").cast("string").alias("job_run_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("PL_"), F.upper("event_type")).alias("pipeline_name"), F.lit("bronze").alias("stage"),
        F.col("event_type").alias("entity"),
        F.concat(F.col("event_type"), F.lit("_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".csv")).alias("file_name"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("SUCCESS").alias("status"),
        F.col("props").alias("message"))
    return control.log_rows(runs)


@register("lineage_edges", """WITH r AS (SELECT p_partkey, unnest([
      concat_ws('.', 'warehouse', lower(replace(p_brand, '#', '')), 'part', p_type),
      concat_ws('.', lower(replace(p_brand, '#', '')), p_type),
      concat_ws('.', 'lake', 'sales', 'lineitem', p_name, 'l_' || CAST(p_partkey AS VARCHAR))]) AS ref FROM part),
  s AS (SELECT p_partkey, string_split(trim(ref), '.') AS p FROM r)
  SELECT p_partkey, array_to_string(p[1:len(p) - 2], '.') AS namespace, p[len(p) - 1] AS name, p[len(p)] AS field
  FROM s WHERE len(p) >= 3""")
def q_lineage_edges(spark, d):
    p = _t(spark, d, "part")
    brand = F.lower(F.regexp_replace("p_brand", "#", ""))
    refs = F.array(
        F.concat_ws(".", F.lit("warehouse"), brand, F.lit("part"), F.col("p_type")),
        F.concat_ws(".", brand, F.col("p_type")),
        F.concat_ws(".", F.lit("lake"), F.lit("sales"), F.lit("lineitem"), F.col("p_name"),
                    F.concat(F.lit("l_"), F.col("p_partkey").cast("string"))))
    return lineage_edges(p.select("p_partkey", refs.alias("refs")), "refs", ["p_partkey"])


# ====================================================================== landing files and the bronze stream
@register("csv_landing_roundtrip", with_ctes("SELECT * FROM raw_sall"))
def q_csv_landing_roundtrip(spark, d):
    raw = fx.raw_suppliers(spark, d, "all")
    path = scratch_dir(spark, "landing") + "/suppliers"
    write_landing_csv(raw, path)
    return read_landing_csv(spark, path)


_LANDING_COLS = ["event_id", "user_id", "event_type", "ts", "props"]
_SPLIT_STAMPS = ("20240101_000000", "20240102_000000", "20240103_000000")
_BRONZE_SQL = f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, props,
    CASE WHEN event_id % 3 = 2 THEN 'extra ' || event_id END AS note, '2024-01-03 00:00:00' AS ingested_at,
    'DH_EVENTS_' || CASE event_id % 3 WHEN 0 THEN '{_SPLIT_STAMPS[0]}' WHEN 1 THEN '{_SPLIT_STAMPS[1]}'
                                      ELSE '{_SPLIT_STAMPS[2]}' END AS extract_timestamp
  FROM events"""


def _bronze_run(spark, d, crash: bool):
    """Every event, landed in three folders: two first, the third later with reordered columns and one more column. With
    ``crash`` the second run fails after its files are written and before the stream commits, and is started again."""
    from lakestrata.streaming.bronze import read_bronze, run_bronze_ingest

    root = scratch_dir(spark, "bronze")
    landing, target, ckpt = f"{root}/landing/events", f"{root}/bronze/events", f"{root}/_checkpoint"
    raw = _t(spark, d, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).select(
        *[F.col(c).cast("string").alias(c) for c in _LANDING_COLS])
    k = F.col("event_id").cast("long") % 3

    def ingest(**more):
        run_bronze_ingest(spark, landing, "events", target, ckpt, ingest_ts="2024-01-03 00:00:00", **more)

    write_landing_csv(raw.filter(k == 0), f"{landing}/events_{_SPLIT_STAMPS[0]}")
    write_landing_csv(raw.filter(k == 1), f"{landing}/events_{_SPLIT_STAMPS[1]}")
    ingest()
    third = raw.filter(k == 2).withColumn("note", F.concat(F.lit("extra "), F.col("event_id")))
    write_landing_csv(third.select("note", *reversed(_LANDING_COLS)), f"{landing}/events_{_SPLIT_STAMPS[2]}")
    if crash:
        def fail(batch_id):
            raise RuntimeError("lost before the commit")

        try:
            ingest(after_write=fail)
        except Exception as exc:  # the stream reports the failure of its batch
            if "lost before the commit" not in str(exc):
                raise
        else:
            raise AssertionError("the run was meant to fail")
    ingest()
    at = F.date_format(C.INGEST_TS, "yyyy-MM-dd HH:mm:ss").alias("ingested_at")
    return read_bronze(spark, target).select(*_LANDING_COLS, "note", at, C.EXTRACT_TAG)


@register("bronze_ingest", _BRONZE_SQL)
def q_bronze_ingest(spark, d):
    return _bronze_run(spark, d, crash=False)


@register("bronze_ingest_replay", _BRONZE_SQL)
def q_bronze_ingest_replay(spark, d):
    return _bronze_run(spark, d, crash=True)


# ====================================================================== more contract and layer queries
def _product_checks_sql() -> str:
    c = fx.PRODUCTS_CONTRACT
    rows = []
    enum_list = ", ".join(f"'{v}'" for v in fx.PRODUCT_CATEGORIES)
    for f in c.fields:
        preds = []
        if f.required:
            preds.append(("required", f"{f.name} IS NULL"))
        if f.type.lower() not in ("string",):
            t = {"int": "INTEGER", "long": "BIGINT", "decimal": "DECIMAL(30,10)", "timestamp": "TIMESTAMP"}[f.type.lower()]
            preds.append(("type", f"{f.name} IS NOT NULL AND TRY_CAST({f.name} AS {t}) IS NULL"))
        if f.enum:
            preds.append(("enum", f"{f.name} IS NOT NULL AND {f.name} NOT IN ({enum_list})"))
        for chk, p in preds:
            rows.append(f"SELECT '{chk}' AS \"check\", '{f.name}' AS column_name, COUNT(*) AS total, "
                        f"CAST(SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM raw_p")
    for chk in ("unique", "primary_key"):
        rows.append(f"""SELECT '{chk}' AS "check", 'product_id' AS column_name, CAST(SUM(n) AS BIGINT) AS total,
          CAST(COALESCE(SUM(CASE WHEN k IS NOT NULL AND n > 1 THEN n END), 0) AS BIGINT) AS failed
          FROM (SELECT product_id AS k, COUNT(*) AS n FROM raw_p GROUP BY product_id) g""")
    return with_ctes(" UNION ALL ".join(rows))


@register("product_contract_checks", _product_checks_sql())
def q_product_contract_checks(spark, d):
    return contract_checks(fx.raw_products(spark, d), fx.PRODUCTS_CONTRACT)


_BRONZE_CUST = [("bronze_c", """SELECT * REPLACE (CAST(dbx_extract_timestamp AS TIMESTAMP) AS dbx_extract_timestamp)
    FROM (SELECT * FROM raw_c1 UNION ALL SELECT * FROM raw_c2) r""")]


@register("silver_incremental_load", with_ctes(f"""SELECT COALESCE(TRY_CAST(customer_id AS BIGINT), 0) AS customer_id, name,
    CASE WHEN regexp_matches(email, '{C.EMAIL_PATTERN}') THEN email ELSE 'unknown@example.com' END AS email,
    CASE WHEN regexp_matches(phone, '{C.PHONE_PATTERN}') THEN phone ELSE '0000000000' END AS phone,
    address, TRY_CAST(loyalty_points AS INTEGER) AS loyalty_points, extract_timestamp,
    strftime(dbx_extract_timestamp, '%Y-%m-%d %H:%M:%S') AS dbx_extract_timestamp
  FROM bronze_c WHERE dbx_extract_timestamp > TIMESTAMP '1996-01-01 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY COALESCE(TRY_CAST(customer_id AS BIGINT), 0)
                             ORDER BY dbx_extract_timestamp DESC) = 1""", _BRONZE_CUST))
def q_silver_incremental_load(spark, d):
    from lakestrata.plans.jobs import silver_batch

    bronze = _raw_both(spark, d).withColumn(C.INGEST_TS, F.col(C.INGEST_TS).cast("timestamp"))
    return portable(silver_batch(bronze, C.SILVER_CUSTOMERS, watermark=F.lit("1996-01-01 00:00:00").cast("timestamp"), dedup=True))


def _quarantine_sql() -> str:
    tags = []
    for f in C.SILVER_CUSTOMERS.fields:
        c = f"r.{f.name}"
        if f.required:
            tags.append(f"CASE WHEN {c} IS NULL THEN 'required:{f.name}' END")
        if f.type.lower() not in ("string",):
            t = {"int": "INTEGER", "integer": "INTEGER", "long": "BIGINT", "timestamp": "TIMESTAMP"}[f.type.lower()]
            tags.append(f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL THEN 'type:{f.name}' END")
        if f.pattern:
            tags.append(f"CASE WHEN {c} IS NOT NULL AND NOT regexp_matches({c}, '{f.pattern}') "
                        f"THEN 'pattern:{f.name}' END")
    tags += ["CASE WHEN d.customer_id IS NOT NULL THEN 'unique:customer_id' END",
             "CASE WHEN d.customer_id IS NOT NULL THEN 'primary_key:customer_id' END"]
    cols = ", ".join(f"r.{c}" for c in fx.CUSTOMER_COLS)
    return with_ctes(f"""SELECT * FROM (SELECT {cols}, concat_ws(',', {', '.join(tags)}) AS violations
      FROM raw_both r LEFT JOIN (SELECT customer_id FROM raw_both WHERE customer_id IS NOT NULL
                                 GROUP BY customer_id HAVING COUNT(*) > 1) d ON r.customer_id = d.customer_id) q
      WHERE violations <> ''""", _RAW_BOTH)


@register("contract_quarantine", _quarantine_sql())
def q_contract_quarantine(spark, d):
    from lakestrata.operators.quality import quarantine_split

    _, bad = quarantine_split(_raw_both(spark, d), C.SILVER_CUSTOMERS)
    return bad


from lakestrata.plans import table_queries  # noqa: E402,F401  (registers the table jobs)
