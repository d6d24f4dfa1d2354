"""The gold star schema built from the fixture batches, plus SQL twins of the state algebra.

Spark side: dimension states via ``operators.merge`` and facts via ``operators.lookup``.
SQL side: CTE text for DuckDB that computes the same states with window functions and joins, used only
as the independent oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import contract as C
from lakestrata.plans import fixtures as fx
from lakestrata.plans.jobs import gold_dimension, gold_fact

GOLD_PRODUCTS = C.gold_products(fx.PRODUCT_CATEGORIES)

OPEN_SQL = "DATE '9999-12-31'"


def _d(date) -> str:
    return f"DATE '{date.isoformat()}'"


# ------------------------------------------------------------------------------------ Spark side
def materialize(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a state to the shared scratch folder and read it back: the lineage is cut (a lost executor
    recomputes from the stored files, not from raw data), and the reader gets file statistics for
    broadcast decisions and pushed-down filters."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class Gold:
    """The gold layer for one run: every state is computed once, stored, and read back by later steps
    (as the gold jobs do with their tables)."""

    def __init__(self, spark: SparkSession, sf_dir: str, store: bool = True):
        from lakestrata.session import scratch_dir

        self.spark, self.sf_dir, self.store = spark, sf_dir, store
        self.root = scratch_dir(spark, "gold") if store else None
        self._cache: dict = {}

    _shared: dict = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Gold":
        """The gold layer of a data folder, built once per application and then served to every view
        (views read the stored gold tables, as in the lakehouse)."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in cls._shared:
            cls._shared[key] = cls(spark, sf_dir)
        return cls._shared[key]

    def _keep(self, name: str, build) -> DataFrame:
        if name not in self._cache:
            df = build()
            self._cache[name] = materialize(self.spark, df, f"{self.root}/{name}") if self.store else df
        return self._cache[name]

    def customers(self, upto: int = 2, second: str = "2") -> DataFrame:
        sp, d = self.spark, self.sf_dir
        t1 = self._keep("dim_customers_v1", lambda: gold_dimension(
            None, fx.silver_customers(sp, d, "1"), C.GOLD_CUSTOMERS, fx.B1_ASOF))
        if upto == 1:
            return t1
        return self._keep(f"dim_customers_v2_{second}", lambda: gold_dimension(
            t1, fx.silver_customers(sp, d, second), C.GOLD_CUSTOMERS, fx.B2_ASOF))

    def suppliers(self, upto: int = 2) -> DataFrame:
        sp, d = self.spark, self.sf_dir
        s1 = self._keep("dim_suppliers_v1", lambda: gold_dimension(
            None, fx.silver_suppliers(sp, d, "1"), C.GOLD_SUPPLIERS, fx.B1_ASOF))
        if upto == 1:
            return s1
        return self._keep("dim_suppliers_v2", lambda: gold_dimension(
            s1, fx.silver_suppliers(sp, d, "2"), C.GOLD_SUPPLIERS, fx.B2_ASOF))

    def products(self) -> DataFrame:
        # the supplier key is looked up with every supplier row (SCD1 keeps one row per supplier)
        return self._keep("dim_products_v1", lambda: gold_dimension(
            None, self.silver_products(), GOLD_PRODUCTS, fx.B1_ASOF,
            {"gold.consumer.dim_suppliers": self.suppliers()}))

    def silver_products(self) -> DataFrame:
        """The silver products, stored: the order lines are grouped once, however often the key numbering reads them."""
        return self._keep("silver_products", lambda: fx.silver_products(self.spark, self.sf_dir))

    def silver_orders(self) -> DataFrame:
        """The silver order lines, cleansed and cast once and stored (the silver layer table)."""
        return self._keep("silver_orders", lambda: fx.silver_orders(self.spark, self.sf_dir))

    def orders(self, versions: str = "current") -> DataFrame:
        """Fact rows with dimension keys looked up (all / current / as-of versions) from stored silver."""
        self.layers()
        dims = {"gold.consumer.dim_customers": self.customers(), "gold.consumer.dim_products": self.products()}
        return gold_fact(self.silver_orders(), C.GOLD_ORDERS, dims, fx.FACT_ASOF, versions=versions,
                         as_of_col="order_date")

    def fact(self) -> DataFrame:
        """The stored gold fact table (current-version keys), as the views read it."""
        return self._keep("fact_orders", lambda: self.orders("current"))

    def layers(self, workers: int = 4) -> "Gold":
        """Build what the fact needs. Independent entities (silver orders; silver products; customers; suppliers) run as
        concurrent Spark jobs, as the entity loads run in parallel; the products wait for their suppliers."""
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=workers) as pool:
            chains = [pool.submit(job) for job in (self.silver_orders, self.silver_products, self.customers, self.suppliers)]
            for job in chains:
                job.result()
        self.products()
        return self

    def build(self, workers: int = 4) -> "Gold":
        """Build every layer table; the fact waits for its dimensions."""
        self.layers(workers)
        self.fact()
        return self


def gold_customers(spark: SparkSession, sf_dir: str, upto: int = 2, second: str = "2") -> DataFrame:
    return Gold(spark, sf_dir).customers(upto, second)


def gold_suppliers(spark: SparkSession, sf_dir: str, upto: int = 2) -> DataFrame:
    return Gold(spark, sf_dir).suppliers(upto)


def gold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Gold(spark, sf_dir).products()


def gold_orders(spark: SparkSession, sf_dir: str, versions: str = "current") -> DataFrame:
    return Gold(spark, sf_dir).orders(versions)


def portable(df: DataFrame) -> DataFrame:
    """Render timestamp columns as ``yyyy-MM-dd HH:mm:ss`` text (the oracle keeps ingest times as text)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# -------------------------------------------------------------------------------------- SQL side
def scd2_first_sql(batch: str, keys, sk: str, as_of) -> str:
    order = ", ".join(f"{k} NULLS FIRST" for k in keys)
    return (f"SELECT b.*, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {sk}, {_d(as_of)} AS "
            f"effective_start_date, {OPEN_SQL} AS effective_end_date FROM {batch} b")


def scd2_state_ctes(p: str, target: str, batch: str, keys, sk: str, compare, as_of, close="same_day") -> list:
    """CTEs ``{p}_cls`` and ``{p}`` (the new state) for SCD2 with validity dates."""
    on = " AND ".join(f"b.{k} = c.{k}" for k in keys)
    diff = " OR ".join(f"b.{c} IS DISTINCT FROM c.{c}" for c in compare) or "FALSE"
    end = _d(as_of) if close == "same_day" else f"({_d(as_of)} - INTERVAL 1 DAY)::DATE"
    order = ", ".join(f"{k} NULLS FIRST" for k in keys)
    xon = " AND ".join(f"t.{k} = x.{k}" for k in keys)
    return [
        (f"{p}_cls", f"""SELECT b.*, CASE WHEN c.{sk} IS NULL THEN 0 WHEN {diff} THEN 1 ELSE 2 END AS _status
          FROM {batch} b LEFT JOIN (SELECT * FROM {target} WHERE effective_end_date = {OPEN_SQL}) c ON {on}"""),
        (p, f"""SELECT * FROM {target} WHERE effective_end_date IS DISTINCT FROM {OPEN_SQL}
          UNION ALL BY NAME
          SELECT t.* REPLACE (CASE WHEN x._hit THEN {end} ELSE t.effective_end_date END AS effective_end_date)
          FROM {target} t LEFT JOIN (SELECT {", ".join(keys)}, TRUE AS _hit FROM {p}_cls WHERE _status = 1) x
            ON {xon}
          WHERE t.effective_end_date = {OPEN_SQL}
          UNION ALL BY NAME
          SELECT * EXCLUDE (_status),
            CAST((SELECT COALESCE(MAX({sk}), 0) FROM {target}) + row_number() OVER (ORDER BY _status, {order})
                 AS BIGINT) AS {sk},
            {_d(as_of)} AS effective_start_date, {OPEN_SQL} AS effective_end_date
          FROM {p}_cls WHERE _status < 2"""),
    ]


def scd1_first_sql(batch: str, keys, sk: str, as_of) -> str:
    order = ", ".join(f"{k} NULLS FIRST" for k in keys)
    return (f"SELECT b.*, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {sk}, {_d(as_of)} AS create_date, "
            f"{_d(as_of)} AS update_date FROM {batch} b")


def scd1_state_sql(target: str, batch: str, keys, sk: str, as_of) -> str:
    on = " AND ".join(f"b.{k} = t.{k}" for k in keys)
    order = ", ".join(f"b.{k} NULLS FIRST" for k in keys)
    return f"""SELECT t.* FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {batch} b WHERE {on})
      UNION ALL BY NAME
      SELECT b.*, t.{sk}, t.create_date, {_d(as_of)} AS update_date FROM {batch} b JOIN {target} t ON {on}
      UNION ALL BY NAME
      SELECT b.*, CAST((SELECT COALESCE(MAX({sk}), 0) FROM {target}) + row_number() OVER (ORDER BY {order}) AS BIGINT)
          AS {sk}, {_d(as_of)} AS create_date, {_d(as_of)} AS update_date
      FROM {batch} b WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})"""


COMPARE_CUSTOMERS = ["name", "email", "phone", "address", "loyalty_points"]


def base_ctes() -> dict:
    """Name -> SQL of every fixture/gold CTE; ``with_ctes`` picks the ones a query needs, in order."""
    c = {
        "raw_c1": fx.raw_customers_sql("1"), "raw_c2": fx.raw_customers_sql("2"),
        "raw_c2b": fx.raw_customers_sql("2b"), "raw_call": fx.raw_customers_sql("all"),
        "sil_call": fx.silver_customers_sql("raw_call"),
        "gold_call": scd2_first_sql("sil_call", ["customer_id"], "customer_id_sk", fx.B1_ASOF),
        "sil_c1": fx.silver_customers_sql("raw_c1"), "sil_c2": fx.silver_customers_sql("raw_c2"),
        "sil_c2b": fx.silver_customers_sql("raw_c2b"),
        "gold_c1": scd2_first_sql("sil_c1", ["customer_id"], "customer_id_sk", fx.B1_ASOF),
        "raw_s1": fx.raw_suppliers_sql("1"), "raw_s2": fx.raw_suppliers_sql("2"),
        "raw_sall": fx.raw_suppliers_sql("all"),
        "sil_s1": fx.silver_suppliers_sql("raw_s1"), "sil_s2": fx.silver_suppliers_sql("raw_s2"),
        "gold_s1": scd1_first_sql("sil_s1", ["supplier_id"], "supplier_id_sk", fx.B1_ASOF),
        "gold_s2": scd1_state_sql("gold_s1", "sil_s2", ["supplier_id"], "supplier_id_sk", fx.B2_ASOF),
        "raw_p": fx.RAW_PRODUCTS_SQL, "sil_p": fx.silver_products_sql("raw_p"),
        "look_p": """SELECT s.*, sup.supplier_id_sk FROM sil_p s
                     LEFT JOIN gold_s2 sup ON TRY_CAST(s.supplier_id AS BIGINT) = sup.supplier_id""",
        "gold_p": scd2_first_sql("look_p", ["product_id"], "product_id_sk", fx.B1_ASOF),
        "raw_o": fx.RAW_ORDERS_SQL, "sil_o": fx.silver_orders_sql("raw_o"),
    }
    for name, sql in scd2_state_ctes("gold_c2", "gold_c1", "sil_c2", ["customer_id"], "customer_id_sk",
                                     COMPARE_CUSTOMERS, fx.B2_ASOF):
        c[name] = sql
    for mode, cond in (("current", "AND {a}.effective_end_date = " + OPEN_SQL),
                       ("all", ""),
                       ("as_of", "AND o.order_date >= {a}.effective_start_date AND o.order_date < {a}.effective_end_date")):
        c[f"fact_{mode}"] = f"""SELECT o.*, c.customer_id_sk, p.product_id_sk,
            {_d(fx.FACT_ASOF)} AS create_date, {_d(fx.FACT_ASOF)} AS update_date
          FROM sil_o o
          LEFT JOIN gold_c2 c ON o.customer_id = c.customer_id {cond.format(a='c')}
          LEFT JOIN gold_p p ON o.product_id = p.product_id {cond.format(a='p')}"""
    return c


_DEPS_ORDER = ["raw_c1", "raw_c2", "raw_c2b", "raw_call", "sil_call", "gold_call", "sil_c1", "sil_c2", "sil_c2b", "gold_c1", "gold_c2_cls", "gold_c2",
               "raw_s1", "raw_s2", "raw_sall", "sil_s1", "sil_s2", "gold_s1", "gold_s2", "raw_p", "sil_p", "look_p", "gold_p",
               "raw_o", "sil_o", "fact_current", "fact_all", "fact_as_of"]


def with_ctes(body: str, extra: list | None = None) -> str:
    """Prefix ``body`` with every base CTE it (transitively) mentions, plus ``extra`` (name, sql) pairs."""
    import re

    base = base_ctes()
    extra = list(extra or [])
    texts = body + " ".join(s for _, s in extra)
    needed: set[str] = set()
    frontier = [texts]
    while frontier:
        t = frontier.pop()
        for name in base:
            if name not in needed and re.search(rf"\b{name}\b", t):
                needed.add(name)
                frontier.append(base[name])
    parts = [(n, base[n]) for n in _DEPS_ORDER if n in needed] + extra
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in parts) + "\n" + body
