"""Registered queries that run the table jobs as a user would: catalog tables, repeated loads, new columns.

They share the registry's dicts and oracle fragments. Each call uses catalog tables of its own name below the shared
scratch folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestrata import contract as C
from lakestrata.plans import fixtures as fx
from lakestrata.plans import star
from lakestrata.plans.jobs import run_gold_job, run_hash_dimension_job, run_silver_job
from lakestrata.plans.registry import _EVOLVED_OUT, _EVOLVED_SQL, _FACT_OUT, _H, _evolved_batch, _t, register
from lakestrata.plans.star import portable, with_ctes
from lakestrata.functions.timefmt import parse_date
from lakestrata.operators.lookup import Lookup, resolve_lookups
from lakestrata.session import scratch_dir
from lakestrata.plans.views import deploy_views
from lakestrata.sources.landing import list_landed_files, new_files_since, take_unseen, write_landing_csv
from lakestrata.sources.tables import LOAD_ID, create_schema, register_table

_TAG = "DH_CUSTOMERS_19950101_000000"


def _names(spark, kind: str) -> tuple[str, str]:
    """A table name and a folder that nobody else uses."""
    return f"lakestrata_{kind}_{uuid.uuid4().hex[:10]}", scratch_dir(spark, kind)


@register("silver_table_load", with_ctes("SELECT * FROM sil_o"))
def q_silver_table_load(spark, d):
    """All order lines through the silver job, the load repeated under its id: no line is lost or doubled."""
    table, root = _names(spark, "silver_orders")
    for _ in range(2):
        run_silver_job(spark, fx.raw_orders(spark, d), fx.ORDERS_CONTRACT, table, root, load_id="batch-1")
    return portable(spark.table(table).drop(LOAD_ID))


@register("silver_late_rows", with_ctes("SELECT * FROM sil_call"))
def q_silver_late_rows(spark, d):
    """Two deliveries under one batch tag: the late rows are appended."""
    table, root = _names(spark, "silver_late")
    raw = fx.raw_customers(spark, d, "all")
    late = F.col("customer_id").cast("long") % 2 == 1
    run_silver_job(spark, raw.filter(~late), C.SILVER_CUSTOMERS, table, root)
    run_silver_job(spark, raw.filter(late), C.SILVER_CUSTOMERS, table, root)
    return portable(spark.table(table).drop(LOAD_ID))


@register("silver_bad_keys", """SELECT CASE WHEN c_custkey % 4 = 0 THEN 'key ' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END
    AS customer_id, c_name AS name, IF(c_custkey % 4 = 0, 'quarantine', 'silver') AS kept_in FROM customer""")
def q_silver_bad_keys(spark, d):
    """Every fourth key cannot be read: those rows are in quarantine, the others in the table."""
    table, root = _names(spark, "silver_bad")
    raw = fx.raw_customers(spark, d, "all")
    key = F.col("customer_id")
    raw = raw.withColumn("customer_id", F.when(key.cast("long") % 4 == 0, F.concat(F.lit("key "), key)).otherwise(key))
    run_silver_job(spark, raw, C.SILVER_CUSTOMERS, table, root)
    parts = [spark.table(t).select(key.cast("string").alias("customer_id"), "name", F.lit(kept).alias("kept_in"))
             for t, kept in ((table, "silver"), (f"{table}__quarantine", "quarantine"))]
    return parts[0].unionByName(parts[1])


@register("load_replay", """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, 'silver' AS kept_in, 'a' AS load_id
    FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT CASE WHEN c_custkey % 4 = 0 THEN 'key ' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END, c_name,
    IF(c_custkey % 4 = 0, 'quarantine', 'silver'), 'c' FROM customer WHERE c_custkey % 3 = 1""")
def q_load_replay(spark, d):
    """Three loads. The first comes again with fewer tags and its keys corrected, the second with no rows at all: nothing of
    what they brought before is left, neither in the table nor in quarantine."""
    table, root = _names(spark, "load_replay")
    key, n = F.col("customer_id"), F.col("customer_id").cast("long")
    raw = fx.raw_customers(spark, d, "all").withColumn(C.EXTRACT_TAG, F.concat(F.lit("TAG_"), (n % 3).cast("string")))
    wrong = raw.withColumn("customer_id", F.when(n % 4 == 0, F.concat(F.lit("key "), key)).otherwise(key))
    tag = F.col(C.EXTRACT_TAG)
    for load, rows in (("a", wrong), ("b", wrong.filter(tag == "TAG_2")), ("c", wrong.filter(tag == "TAG_1")),
                       ("a", raw.filter(tag == "TAG_0")), ("b", raw.filter("false"))):
        run_silver_job(spark, rows, C.SILVER_CUSTOMERS, table, root, load_id=load)
    parts = [spark.table(t).select(key.cast("string").alias("customer_id"), "name", F.lit(kept).alias("kept_in"), F.col(LOAD_ID).alias("load_id"))
             for t, kept in ((table, "silver"), (f"{table}__quarantine", "quarantine"))]
    return parts[0].unionByName(parts[1])


@register("scd2_small_runs", f"""WITH v AS (SELECT c_custkey, 0 AS run, c_name AS name FROM customer
    UNION ALL SELECT c_custkey, unnest(range(1, 7)), NULL FROM customer),
  changed AS (SELECT c_custkey, run, coalesce(name, 'renamed in ' || run) AS name FROM v WHERE run = 0 OR (c_custkey + run) % 40 < 4),
  ordered AS (SELECT *, lead(run) OVER (PARTITION BY c_custkey ORDER BY run) AS next_run FROM changed)
  SELECT c_custkey AS customer_id, name, DATE '2024-03-01' + CAST(run AS INTEGER) AS effective_start_date,
    CASE WHEN next_run IS NULL THEN DATE '9999-12-31' ELSE DATE '2024-03-01' + CAST(next_run AS INTEGER) END AS effective_end_date,
    CAST(row_number() OVER (ORDER BY run, c_custkey) AS BIGINT) AS customer_id_sk FROM ordered""")
def q_scd2_small_runs(spark, d):
    """A first load of all customers and six small batches through the SCD2 job's store: versions, validity and keys."""
    table, root = _names(spark, "small_runs")
    base = fx.silver_customers(spark, d, "all").select("customer_id", "name", C.INGEST_TS)
    run_gold_job(spark, base, C.GOLD_CUSTOMERS, table, root, "2024-03-01")
    for run in range(1, 7):
        batch = base.filter((F.col("customer_id") + run) % 40 < 4).withColumn("name", F.lit(f"renamed in {run}"))
        run_gold_job(spark, batch, C.GOLD_CUSTOMERS, table, root, f"2024-03-0{1 + run}")
    return spark.table(table).select("customer_id", "name", "effective_start_date", "effective_end_date", "customer_id_sk")


@register("unkeyed_rows", """SELECT c_name AS name, 'apart' AS kept_in FROM customer WHERE c_custkey % 4 = 0
  UNION ALL SELECT c_name, 'gold' FROM customer WHERE c_custkey % 4 <> 0""")
def q_unkeyed_rows(spark, d):
    """Every fourth customer comes without a key: the dimension has one member for them, and all of them are kept."""
    table, root = _names(spark, "unkeyed")
    raw = fx.raw_customers(spark, d, "all")
    raw = raw.withColumn("customer_id", F.when(F.col("customer_id").cast("long") % 4 != 0, F.col("customer_id")))
    run_silver_job(spark, raw, C.SILVER_CUSTOMERS, f"{table}_silver", f"{root}/silver")
    run_gold_job(spark, spark.table(f"{table}_silver"), C.GOLD_CUSTOMERS, table, f"{root}/gold", fx.B1_ASOF)
    gold = spark.table(table).filter("customer_id <> 0").select("name", F.lit("gold").alias("kept_in"))
    return gold.unionByName(spark.table(f"{table}__unkeyed").select("name", F.lit("apart").alias("kept_in")))


@register("evolved_table_append", with_ctes(_EVOLVED_OUT, _EVOLVED_SQL))
def q_evolved_table_append(spark, d):
    """A declared new column arrives in a catalog table; an undeclared one is refused."""
    table, root = _names(spark, "evolved")
    contract = C.SILVER_CUSTOMERS.with_fields(C.Field("region_name", "string"))
    run_silver_job(spark, fx.raw_customers(spark, d, "1"), C.SILVER_CUSTOMERS, table, root)
    regions = _evolved_batch(spark, d).select(F.col("customer_id").alias("_k"), "region_name")
    second = fx.raw_customers(spark, d, "2")
    second = second.join(regions, second["customer_id"].cast("long") == F.col("_k")).drop("_k")
    if not run_silver_job(spark, second, contract, table, root):
        raise AssertionError("a declared column was refused")
    if run_silver_job(spark, fx.raw_customers(spark, d, "2b").withColumn("secret_note", F.lit("x")), contract, table, root):
        raise AssertionError("an undeclared column was taken")
    return portable(spark.table(table).drop(LOAD_ID))


@register("asof_many_versions", """WITH v AS (SELECT DISTINCT s_nationkey AS nation, CAST(l_shipdate AS DATE) AS begun FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
  spans AS (SELECT nation, begun, lead(begun) OVER (PARTITION BY nation ORDER BY begun) AS ended FROM v)
  SELECT o_orderkey, spans.nation * 100000 + date_diff('day', DATE '1970-01-01', begun) AS version_sk
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey ASOF LEFT JOIN spans ON c_nationkey = spans.nation AND CAST(o_orderdate AS DATE) >= begun""")
def q_asof_many_versions(spark, d):
    """A dimension with a version for every day on which a nation's suppliers shipped, looked up for all orders by date."""
    supplied = _t(spark, d, "lineitem").join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    v = supplied.select(F.col("s_nationkey").alias("nation"), F.col("l_shipdate").cast("date").alias(C.START_DATE)).distinct()
    ended = F.lead(C.START_DATE).over(Window.partitionBy("nation").orderBy(C.START_DATE))
    day = F.datediff(C.START_DATE, F.lit("1970-01-01").cast("date"))
    dim = v.withColumns({C.END_DATE: F.coalesce(ended, F.lit("9999-12-31").cast("date")), "version_sk": F.col("nation").cast("long") * 100000 + day})
    facts = _t(spark, d, "orders").join(_t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    out = resolve_lookups(facts, [Lookup(dim, "version_sk", ("c_nationkey",), ("nation",))], versions="as_of_ordered", as_of_col="o_orderdate")
    return out.select("o_orderkey", "version_sk")


_SCD2_TABLE_SQL = with_ctes(f"""SELECT t.* REPLACE (CASE WHEN t.customer_id IN (SELECT customer_id FROM sil_c2)
      THEN DATE '{fx.B2_ASOF}' ELSE t.effective_end_date END AS effective_end_date), CAST(NULL AS VARCHAR) AS plan_name
  FROM gold_c1 t
  UNION ALL BY NAME
  SELECT b.*, 'new' AS plan_name, DATE '{fx.B2_ASOF}' AS effective_start_date, DATE '9999-12-31' AS effective_end_date,
    CAST((SELECT MAX(customer_id_sk) FROM gold_c1) + row_number() OVER (
      ORDER BY b.customer_id IN (SELECT customer_id FROM gold_c1), b.customer_id) AS BIGINT) AS customer_id_sk
  FROM sil_c2 b""")


@register("scd2_table_load", _SCD2_TABLE_SQL)
def q_scd2_table_load(spark, d):
    """The SCD2 job on a catalog table: a second batch brings a new column (so that every key in it changes), and is run
    three times."""
    table, root = _names(spark, "gold_scd2")
    contract = C.GOLD_CUSTOMERS
    run_gold_job(spark, fx.silver_customers(spark, d, "1"), contract, table, root, fx.B1_ASOF)
    second = fx.silver_customers(spark, d, "2").withColumn("plan_name", F.lit("new"))
    for _ in range(3):
        run_gold_job(spark, second, contract, table, root, fx.B2_ASOF)
    return portable(spark.table(table).drop("_slice"))


@register("scd1_table_load", with_ctes("SELECT * FROM gold_s2"))
def q_scd1_table_load(spark, d):
    """The SCD1 job on a catalog table, bucket by bucket; the last batch is run twice."""
    table, root = _names(spark, "gold_scd1")
    for batch, as_of in (("1", fx.B1_ASOF), ("2", fx.B2_ASOF), ("2", fx.B2_ASOF)):
        run_gold_job(spark, fx.silver_suppliers(spark, d, batch), C.GOLD_SUPPLIERS, table, root, as_of)
    return portable(spark.table(table))


@register("hash_table_load", with_ctes("SELECT * FROM hash_c2", _H))
def q_hash_table_load(spark, d):
    """Flag-form SCD2 as a stored table over two batches."""
    table, root = _names(spark, "gold_hash")
    for batch, as_of in (("1", fx.B1_ASOF), ("2", fx.B2_ASOF)):
        run_hash_dimension_job(spark, fx.silver_customers(spark, d, batch), ["customer_id"], star.COMPARE_CUSTOMERS,
                               "customer_id_sk", table, root, as_of)
    return portable(spark.table(table).drop("_slice"))


@register("fact_table_load_asof", with_ctes(f"SELECT {', '.join(_FACT_OUT)} FROM fact_as_of"))
def q_fact_table_load_asof(spark, d):
    """The fact job with the dimension versions valid at the order date, its load repeated under its id."""
    table, root = _names(spark, "gold_fact")
    g = star.Gold.shared(spark, d).layers()
    dims = {"gold.consumer.dim_customers": g.customers(), "gold.consumer.dim_products": g.products()}
    for _ in range(2):
        run_gold_job(spark, g.silver_orders(), C.GOLD_ORDERS, table, root, fx.FACT_ASOF, dimensions=dims, versions="as_of",
                     as_of_col="order_date", load_id="batch-1")
    return spark.table(table).select(*_FACT_OUT)


@register("external_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def q_external_table(spark, d):
    """A schema is created and an external table registered over stored files, twice without effect."""
    name, root = _names(spark, "schema")
    path = f"{root}/suppliers"
    _t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey").write.parquet(path)
    for _ in range(2):
        create_schema(spark, name)
        register_table(spark, f"{name}.suppliers", path)
    return spark.table(f"{name}.suppliers")


@register("landed_files_since", """WITH landed AS (SELECT event_type AS entity, max(ts) AS last_ts FROM events GROUP BY 1),
  marks AS (SELECT event_type AS entity, max(ts) AS mark FROM events
            WHERE event_type NOT IN ('view', 'error') AND ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1
            UNION ALL SELECT 'error', max(ts) + INTERVAL 1 DAY FROM events WHERE event_type = 'error')
  SELECT l.entity, l.entity || '_' || strftime(l.last_ts, '%Y%m%d_%H%M%S') || '.csv' AS name
  FROM landed l LEFT JOIN marks m USING (entity) WHERE m.mark IS NULL OR date_trunc('second', l.last_ts) > m.mark""")
def q_landed_files_since(spark, d):
    """Files landed on storage, listed there, and filtered by the watermark of their entity."""
    _, root = _names(spark, "landed")
    ev = _t(spark, d, "events")
    last = ev.groupBy("event_type").agg(F.max("ts").alias("last"))
    for r in last.collect():  # one folder for each of the few event types
        write_landing_csv(ev.filter(F.col("event_type") == r["event_type"]),
                          f"{root}/{r['event_type']}_{r['last']:%Y%m%d_%H%M%S}.csv")
    files = list_landed_files(spark, root).select(F.element_at(F.split("path", "/"), -2).alias("name")).distinct()
    early = ev.filter(~F.col("event_type").isin("view", "error") & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    marks = early.groupBy(F.col("event_type").alias("entity_name")).agg(F.max("ts").alias("watermark_value"))
    done = last.filter("event_type = 'error'").select("event_type", F.col("last") + F.expr("INTERVAL 1 DAY"))
    return new_files_since(files, marks.union(done)).select("entity", "name")


@register("job_run_metrics", """SELECT load, status, message FROM (VALUES ('one', 0), ('two', 1), ('three', 2)) v(load, n),
  LATERAL (SELECT CASE WHEN n < 2 THEN 'SUCCESS' ELSE 'REFUSED' END AS status,
    CASE n WHEN 0 THEN 'written ' || count(*) FILTER (c_custkey % 4 <> 0) || ', quarantined ' || count(*) FILTER (c_custkey % 4 = 0)
      WHEN 1 THEN 'written ' || count(*) FILTER (c_custkey % 3 = 0) || ', quarantined 0'
      ELSE 'columns not in the contract: [''secret_note'']' END AS message FROM customer)""")
def q_job_run_metrics(spark, d):
    """The run log of three silver runs: one with unreadable keys, one with part of the rows, one that is refused."""
    table, root = _names(spark, "run_metrics")
    key, n, log = F.col("customer_id"), F.col("customer_id").cast("long"), f"{root}/log"
    raw = fx.raw_customers(spark, d, "all")
    wrong = raw.withColumn("customer_id", F.when(n % 4 == 0, F.concat(F.lit("key "), key)).otherwise(key))
    for load, rows in (("one", wrong), ("two", raw.filter(n % 3 == 0)), ("three", raw.withColumn("secret_note", F.lit("x")))):
        run_silver_job(spark, rows, C.SILVER_CUSTOMERS, table, f"{root}/silver", load_id=load, log=log)
    return spark.read.parquet(log).select(F.col("job_run_id").alias("load"), "status", "message")


_LISTING = "SELECT event_type || '_' || strftime(ts, '%Y%m%d') || '.csv' AS path, count(*) AS length, max(ts) AS modified FROM events"


@register("relanded_files", f"""SELECT path, length FROM ({_LISTING} GROUP BY 1)
  ANTI JOIN ({_LISTING} WHERE ts < TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1) USING (path, length, modified)""")
def q_relanded_files(spark, d):
    """One file for each event type and day, listed twice: in between, the files of one day were written anew and others
    landed. The second run, which is repeated, takes just those."""
    seen, root = _names(spark, "seen")

    def listing(events):
        path = F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv"))
        return events.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("length"), F.max("ts").alias("modified")).withColumn("name", F.col("path"))

    events = _t(spark, d, "events")
    take_unseen(spark, listing(events.filter("ts < TIMESTAMP_NTZ '2024-01-15 12:00:00'")), seen, root, "run-1")
    for _ in range(2):
        taken = take_unseen(spark, listing(events), seen, root, "run-2")
    return taken.select("path", "length")


@register("deployed_views", """SELECT n_name || '; nation' AS label, count(*) AS customers
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def q_deployed_views(spark, d):
    """Scripts of views in two schemas; the one deployed first reads those deployed after it."""
    name, root = _names(spark, "views")
    scripts = {"a": ("report.sql", f"""-- customers; by nation
        CREATE OR REPLACE VIEW {name}_a.report AS SELECT label, count(*) AS customers
        FROM {name}_b.customers JOIN {name}_b.nations ON c_nationkey = n_nationkey GROUP BY label;"""),
               "b": ("views.sql", f"""CREATE OR REPLACE VIEW {name}_b.customers AS SELECT * FROM parquet.`env_dir/customer.parquet`;
        CREATE OR REPLACE VIEW {name}_b.nations AS /* the label; in quotes */
        SELECT n_nationkey, n_name || '; nation' AS label FROM parquet.`env_dir/nation.parquet`""")}
    for sub, (file, text) in scripts.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}_{sub}/{file}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(text.encode()))
        out.close()
    deploy_views(spark, root, {"env_dir": d.rstrip("/")}, create_schemas=True)
    return spark.table(f"{name}_a.report")


@register("rescued_lines", """SELECT CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS supplier_id,
    CASE WHEN s_suppkey % 3 = 0 THEN '"' || s_suppkey || '","' || s_name || '","surplus"' END AS rescued FROM supplier""")
def q_rescued_lines(spark, d):
    """Lines with more fields than the header keep their text in the rescue column; no line is lost."""
    from lakestrata.streaming.bronze import read_by_header

    _, root = _names(spark, "rescued")
    quoted = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    line = F.concat(quoted("s_suppkey"), F.lit(","), quoted("s_name"),
                    F.when(F.col("s_suppkey") % 3 == 0, F.lit(',"surplus"')).otherwise(F.lit("")))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))  # each with the header line at its head
    header = spark.range(files).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("n"),
                                       F.lit('"supplier_id","name"').alias("value"))
    rows = _t(spark, d, "supplier").select(F.pmod(F.hash("s_suppkey"), F.lit(files)).alias("bucket"), F.lit(1), line)
    lines = header.union(rows).repartition(files, "bucket").sortWithinPartitions("bucket", "n")
    lines.drop("n").write.partitionBy("bucket").text(f"{root}/suppliers_20240101_000000.csv")
    paths = [r["path"] for r in list_landed_files(spark, f"{root}/suppliers_20240101_000000.csv", glob="*.txt").select("path").collect()]
    out = read_by_header(spark, paths, rescue_column="_rescued")
    return out.select(F.when(F.col("_rescued").isNull(), F.col("supplier_id")).alias("supplier_id"), F.col("_rescued").alias("rescued"))


@register("parse_dates", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_date FROM orders""")
def q_parse_dates(spark, d):
    """ISO text to dates; unreadable text gives NULL."""
    text = F.when(F.col("o_orderkey") % 5 == 0, F.lit("31/12/1999")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _t(spark, d, "orders").select("o_orderkey", parse_date(text).alias("order_date"))
