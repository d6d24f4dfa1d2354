"""Load batches derived from the TPC-H-style test tables, each with a DuckDB SQL twin.

Every Spark builder here has a ``*_sql`` counterpart producing the same rows as a CTE body, so the
oracle can rebuild the identical inputs. Raw (landing) batches are all strings; silver batches are
cleansed and cast by the contract; gold states come from the merge algebra.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import contract as C
from lakestrata.functions.cleansing import contract_cast, fill_null_keys, pattern_clean

# Fixed parameters of the test batches.
B1_ASOF = _dt.date(1995, 1, 1)
B2_ASOF = _dt.date(1998, 7, 1)
FACT_ASOF = _dt.date(2001, 9, 1)
INGEST_TS = {1: "1995-01-01 06:00:00", 2: "1998-07-01 06:00:00"}
STAMP = {1: "19950101_000000", 2: "19980701_000000"}
PRODUCT_CATEGORIES = ("STANDARD", "MEDIUM", "ECONOMY", "LARGE", "SMALL")  # the six p_type values minus PROMO


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# ------------------------------------------------------------------------------------ customers
def _phone(k: Column) -> Column:
    return (F.when(k % 4 == 0, F.concat(F.lit("+91 "), F.lpad(_s(k), 10, "0")))
            .when(k % 4 == 1, F.lit("12")).when(k % 4 == 2, F.lit(None)).otherwise(F.lit("0123456789")))


def _phone_sql(k: str) -> str:
    return (f"CASE {k} % 4 WHEN 0 THEN '+91 ' || lpad(CAST({k} AS VARCHAR), 10, '0') WHEN 1 THEN '12' "
            f"WHEN 2 THEN NULL ELSE '0123456789' END")


def raw_customers(spark: SparkSession, sf_dir: str, batch: str = "1") -> DataFrame:
    """Landing customers (all strings). Batch '1': keys %10<>9; '2': keys %3=0 or %10=9 with changes;
    '2b': batch 2 without its new keys; 'all': every customer with batch 1 values."""
    k = F.col("c_custkey")
    cust = table(spark, sf_dir, "customer")
    if batch in ("1", "all"):
        cust = cust.filter(k % 10 != 9) if batch == "1" else cust
        null_points = (k % 17 == 0) | (k % 21 == 0)
        address = F.col("c_mktsegment")
    else:
        cust = cust.filter((k % 3 == 0) | (k % 10 == 9)) if batch == "2" else cust.filter(k % 3 == 0)
        null_points = (k % 17 == 0) | (k % 15 == 0)
        address = F.when(k % 9 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment"))
    n = 1 if batch in ("1", "all") else 2
    return cust.select(
        _s(k).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.lit("not-an-email"))
        .otherwise(F.concat(F.lit("c"), _s(k), F.lit("@mail.example.com"))).alias("email"),
        _phone(k).alias("phone"),
        address.alias("address"),
        F.when(null_points, F.lit(None)).when(k % 29 == 0, F.lit("n/a"))
        .otherwise(_s((k * 7) % 401)).alias("loyalty_points"),
        F.lit(f"DH_CUSTOMERS_{STAMP[n]}").alias(C.EXTRACT_TAG),
        F.lit(INGEST_TS[n]).alias(C.INGEST_TS),
    )


def raw_customers_sql(batch: str = "1") -> str:
    k = "c_custkey"
    if batch in ("1", "all"):
        where = f"{k} % 10 <> 9" if batch == "1" else "TRUE"
        nulls, address = f"{k} % 17 = 0 OR {k} % 21 = 0", "c_mktsegment"
    else:
        where = f"{k} % 3 = 0 OR {k} % 10 = 9" if batch == "2" else f"{k} % 3 = 0"
        nulls = f"{k} % 17 = 0 OR {k} % 15 = 0"
        address = f"CASE WHEN {k} % 9 = 0 THEN 'CHANGED' ELSE c_mktsegment END"
    n = 1 if batch in ("1", "all") else 2
    return f"""SELECT CAST({k} AS VARCHAR) AS customer_id, c_name AS name,
      CASE {k} % 5 WHEN 0 THEN NULL WHEN 1 THEN 'not-an-email'
           ELSE 'c' || CAST({k} AS VARCHAR) || '@mail.example.com' END AS email,
      {_phone_sql(k)} AS phone, {address} AS address,
      CASE WHEN {nulls} THEN NULL WHEN {k} % 29 = 0 THEN 'n/a' ELSE CAST(({k} * 7) % 401 AS VARCHAR) END
        AS loyalty_points,
      'DH_CUSTOMERS_{STAMP[n]}' AS extract_timestamp, '{INGEST_TS[n]}' AS dbx_extract_timestamp
    FROM customer WHERE {where}"""


def silver(raw: DataFrame, contract: C.Contract) -> DataFrame:
    """Bronze -> silver: patterns on the raw strings, then the contract cast, then key filling."""
    return fill_null_keys(contract_cast(pattern_clean(raw, contract), contract), contract.primary_key)


def silver_customers(spark, sf_dir, batch="1") -> DataFrame:
    return silver(raw_customers(spark, sf_dir, batch), C.SILVER_CUSTOMERS)


def silver_customers_sql(raw: str) -> str:
    """SQL twin of ``silver`` for the customer contract; ``raw`` is a CTE name. The ingest timestamp
    stays text in the oracle (Spark outputs render it the same way)."""
    return f"""SELECT COALESCE(TRY_CAST(customer_id AS BIGINT), 0) AS customer_id, name,
      CASE WHEN regexp_matches(email, '{C.EMAIL_PATTERN}') THEN email ELSE 'unknown@example.com' END AS email,
      CASE WHEN regexp_matches(phone, '{C.PHONE_PATTERN}') THEN phone ELSE '0000000000' END AS phone,
      address, TRY_CAST(loyalty_points AS INTEGER) AS loyalty_points, extract_timestamp, dbx_extract_timestamp
    FROM {raw}"""


CUSTOMER_COLS = ["customer_id", "name", "email", "phone", "address", "loyalty_points", "extract_timestamp",
                 "dbx_extract_timestamp"]


# ------------------------------------------------------------------------------------ suppliers
def raw_suppliers(spark: SparkSession, sf_dir: str, batch: str = "1") -> DataFrame:
    """Landing suppliers (all strings). Batch '1': keys %4<>3; '2': odd keys, renamed where %3=0 and
    moved where %5=0 (together they cover every supplier); 'all': the whole table as batch 1 values."""
    k = F.col("s_suppkey")
    sup = table(spark, sf_dir, "supplier")
    n = 1 if batch == "1" else 2
    if batch in ("1", "all"):
        sup = sup.filter(k % 4 != 3) if batch == "1" else sup
        name, address = F.col("s_name"), _s(F.col("s_nationkey"))
    else:
        sup = sup.filter(k % 2 == 1)
        name = F.when(k % 3 == 0, F.concat(F.col("s_name"), F.lit(" Ltd"))).otherwise(F.col("s_name"))
        address = F.when(k % 5 == 0, F.lit("MOVED")).otherwise(_s(F.col("s_nationkey")))
    return sup.select(_s(k).alias("supplier_id"), name.alias("name"), _phone(k).alias("phone"),
                      address.alias("address"), F.lit(f"DH_SUPPLIERS_{STAMP[n]}").alias(C.EXTRACT_TAG),
                      F.lit(INGEST_TS[n]).alias(C.INGEST_TS))


def raw_suppliers_sql(batch: str = "1") -> str:
    k = "s_suppkey"
    n = 1 if batch == "1" else 2
    if batch in ("1", "all"):
        where = f"{k} % 4 <> 3" if batch == "1" else "TRUE"
        name, address = "s_name", "CAST(s_nationkey AS VARCHAR)"
    else:
        where = f"{k} % 2 = 1"
        name = f"CASE WHEN {k} % 3 = 0 THEN s_name || ' Ltd' ELSE s_name END"
        address = f"CASE WHEN {k} % 5 = 0 THEN 'MOVED' ELSE CAST(s_nationkey AS VARCHAR) END"
    return f"""SELECT CAST({k} AS VARCHAR) AS supplier_id, {name} AS name, {_phone_sql(k)} AS phone,
      {address} AS address, 'DH_SUPPLIERS_{STAMP[n]}' AS extract_timestamp,
      '{INGEST_TS[n]}' AS dbx_extract_timestamp
    FROM supplier WHERE {where}"""


def silver_suppliers(spark, sf_dir, batch="1") -> DataFrame:
    return silver(raw_suppliers(spark, sf_dir, batch), C.SILVER_SUPPLIERS)


def silver_suppliers_sql(raw: str) -> str:
    return f"""SELECT COALESCE(TRY_CAST(supplier_id AS BIGINT), 0) AS supplier_id, name,
      CASE WHEN regexp_matches(phone, '{C.PHONE_PATTERN}') THEN phone ELSE '0000000000' END AS phone,
      address, extract_timestamp, dbx_extract_timestamp
    FROM {raw}"""


# ------------------------------------------------------------------------------------- products
PRODUCTS_CONTRACT = C.silver_products(PRODUCT_CATEGORIES)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing products: parts with their smallest selling supplier (NULL if never sold)."""
    first_sup = (table(spark, sf_dir, "lineitem").groupBy("l_partkey")
                 .agg(F.min("l_suppkey").alias("_sup")))
    part = table(spark, sf_dir, "part")
    return part.join(first_sup, part["p_partkey"] == first_sup["l_partkey"], "left").select(
        _s(F.col("p_partkey")).alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        _s(F.col("p_retailprice").cast("decimal(12,2)")).alias("price"),
        _s(F.col("_sup")).alias("supplier_id"),
        F.lit("DH_PRODUCTS_19950101_000000").alias(C.EXTRACT_TAG), F.lit(INGEST_TS[1]).alias(C.INGEST_TS))


RAW_PRODUCTS_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
      CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price, CAST(s._sup AS VARCHAR) AS supplier_id,
      'DH_PRODUCTS_19950101_000000' AS extract_timestamp, '1995-01-01 06:00:00' AS dbx_extract_timestamp
    FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS _sup FROM lineitem GROUP BY l_partkey) s
      ON part.p_partkey = s.l_partkey"""


def silver_products(spark, sf_dir) -> DataFrame:
    return silver(raw_products(spark, sf_dir), PRODUCTS_CONTRACT)


def silver_products_sql(raw: str) -> str:
    return f"""SELECT COALESCE(TRY_CAST(product_id AS BIGINT), 0) AS product_id, product_name, category,
      TRY_CAST(price AS DECIMAL(30,10)) AS price, supplier_id, extract_timestamp, dbx_extract_timestamp
    FROM {raw}"""


# --------------------------------------------------------------------------------------- orders
def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing order lines (all strings): lineitem joined to its order."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select(
        _s(F.col("l_orderkey")).alias("order_id"), _s(F.col("o_custkey")).alias("customer_id"),
        _s(F.col("l_partkey")).alias("product_id"), _s(F.col("l_suppkey")).alias("supplier_id"),
        _s(F.col("l_quantity").cast("long")).alias("quantity"),
        _s(F.col("l_extendedprice").cast("decimal(12,2)")).alias("total_price"),
        _s(F.col("o_orderdate").cast("date")).alias("order_date"),
        F.lit("DH_ORDERS_20010901_000000").alias(C.EXTRACT_TAG), F.lit("2001-09-01 06:00:00").alias(C.INGEST_TS))


RAW_ORDERS_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
      CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS supplier_id,
      CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
      CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS total_price,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
      'DH_ORDERS_20010901_000000' AS extract_timestamp, '2001-09-01 06:00:00' AS dbx_extract_timestamp
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

ORDERS_CONTRACT = C.SILVER_ORDERS.with_fields(C.Field("supplier_id", "long"))


def silver_orders(spark, sf_dir) -> DataFrame:
    return silver(raw_orders(spark, sf_dir), ORDERS_CONTRACT)


def silver_orders_sql(raw: str) -> str:
    return f"""SELECT COALESCE(TRY_CAST(order_id AS BIGINT), 0) AS order_id,
      TRY_CAST(customer_id AS BIGINT) AS customer_id, TRY_CAST(product_id AS BIGINT) AS product_id,
      TRY_CAST(supplier_id AS BIGINT) AS supplier_id, TRY_CAST(quantity AS INTEGER) AS quantity,
      TRY_CAST(total_price AS DECIMAL(12,2)) AS total_price, TRY_CAST(order_date AS DATE) AS order_date,
      extract_timestamp, dbx_extract_timestamp
    FROM {raw}"""
