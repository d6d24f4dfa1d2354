"""Gold analytical views (customer loyalty segments, supplier share per category) and view deployment."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.contract import END_DATE
from lakestrata.operators.merge import OPEN_END
from lakestrata.sources.tables import list_folders, quoted

# Loyalty tier names and bounds; supplier role names and the default dominance share.
TIERS = ("Bronze", "Silver", "Gold", "Platinum")
DOMINANT, COMPETITIVE = "Dominant Supplier", "Competitive Market"
DOMINANCE_SHARE = 0.6


def loyalty_tier(points: str = "loyalty_points"):
    """<100 (or NULL) Bronze, 100..200 Silver, 200..300 Gold, >300 Platinum; the bounds 200 and 300 fall in
    the lower tier because the BETWEEN ranges overlap and the first match wins."""
    p = F.col(points)
    return (F.when(F.coalesce(p, F.lit(0)) < 100, F.lit(TIERS[0]))
            .when(p.between(100, 200), F.lit(TIERS[1]))
            .when(p.between(200, 300), F.lit(TIERS[2]))
            .when(p > 300, F.lit(TIERS[3])))


def loyalty_segments(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Per current customer version: points, tier, distinct orders and money spent.

    Partial aggregation runs before the shuffle; COUNT(DISTINCT) becomes a two-level aggregate so a
    customer with a large share of the orders is pre-reduced per map task.
    """
    cur = customers.filter(F.col(END_DATE) == F.lit(OPEN_END)).select(
        "customer_id_sk", "customer_id", "name", "loyalty_points")
    f = fact.select("customer_id_sk", "order_id", "total_price")
    return (f.join(cur, "customer_id_sk")
            .groupBy("customer_id", "name", "loyalty_points")
            .agg(F.count_distinct("order_id").alias("total_orders"),
                 F.sum("total_price").cast("decimal(18,2)").alias("total_spent"))
            .select("customer_id", F.col("name").alias("customer_name"),
                    F.coalesce(F.col("loyalty_points"), F.lit(0)).alias("loyalty_points"),
                    loyalty_tier().alias("loyalty_tier"), "total_orders", "total_spent"))


def _supplier_category_sales(fact: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    p = products.select("product_id_sk", "supplier_id_sk", "category")
    s = suppliers.select("supplier_id_sk", "supplier_id", F.col("name").alias("supplier_name"))
    f = fact.select("product_id_sk", "order_id", "total_price")
    return (f.join(p, "product_id_sk").join(s, "supplier_id_sk")
            .groupBy("supplier_id", "supplier_name", "category")
            .agg(F.sum("total_price").cast("decimal(18,2)").alias("category_revenue"),
                 (F.sum("total_price").cast("double") / F.count("total_price")).alias("avg_order_value"),
                 F.count_distinct("order_id").alias("total_orders")))


def _finish_share(df: DataFrame, total_col: str, threshold: float) -> DataFrame:
    share = F.col("category_revenue").cast("double") / F.col(total_col).cast("double")
    return df.select("supplier_id", "supplier_name", "category", "category_revenue", "avg_order_value",
                     "total_orders", F.round(share * 100, 2).alias("revenue_share_pct"),
                     F.when(share > threshold, F.lit(DOMINANT)).otherwise(F.lit(COMPETITIVE)).alias("supplier_role"))


def supplier_category(fact: DataFrame, products: DataFrame, suppliers: DataFrame,
                      threshold: float = DOMINANCE_SHARE) -> DataFrame:
    """Revenue per supplier and category and its share of the category total (second-level aggregate
    joined back; the totals have one row per category)."""
    scs = _supplier_category_sales(fact, products, suppliers)
    totals = scs.groupBy("category").agg(F.sum("category_revenue").alias("total_category_revenue"))
    return _finish_share(scs.join(totals, "category"), "total_category_revenue", threshold)


def category_share_window(fact: DataFrame, products: DataFrame, suppliers: DataFrame,
                          threshold: float = DOMINANCE_SHARE) -> DataFrame:
    """The share as a window over the category says it, computed in two levels: a window would gather all suppliers
    of a category in one task, sums of (supplier, category) groups do not."""
    return supplier_category(fact, products, suppliers, threshold)


#: What a statement consists of where a semicolon does not end it: quoted text and names, comments; else any character.
_PIECE = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/|.""", re.DOTALL)


def split_statements(text: str) -> list[str]:
    """The statements of an SQL script. A semicolon in quotes, in a quoted name or in a comment ends none; comments are
    left out."""
    out, now = [], []
    for piece in _PIECE.findall(text):
        if piece == ";":
            out.append("".join(now))
            now = []
        else:
            now.append(" " if piece.startswith("--") or piece.startswith("/*") else piece)
    return [s.strip() for s in [*out, "".join(now)] if s.strip()]


def _waits_for_another(exc: Exception) -> bool:
    """Did a statement fail because a table or view is not there (yet)?"""
    return "TABLE_OR_VIEW_NOT_FOUND" in str(exc) or "SCHEMA_NOT_FOUND" in str(exc)


def deploy_views(spark: SparkSession, root: str, substitutions: dict | None = None, min_len: int = 10,
                 create_schemas: bool = False) -> list[str]:
    """Run every ``.sql`` file below ``root`` (one schema per sub-folder, created first when
    ``create_schemas``): environment names substituted, statements split (``split_statements``), those of ``min_len``
    characters or fewer skipped with a warning.

    Views may read each other across files and folders: a statement that misses a table or view is tried again after the
    others, as long as a round gets further. What is left, and every other failure, is raised together at the end. Returns the
    files in the order in which their statements ran."""
    waiting, errors, ran = [], [], []
    for folder in sorted(list_folders(spark, root, 1)):
        if create_schemas:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(folder.rsplit('/', 1)[1])}")
        scripts = spark.read.format("binaryFile").option("pathGlobFilter", "*.sql").load(folder)
        for path, text in scripts.select("path", F.col("content").cast("string")).orderBy("path").collect():
            for old, new in (substitutions or {}).items():
                text = text.replace(old, new)
            for stmt in split_statements(text):
                if len(stmt) <= min_len:
                    warnings.warn(f"{path}: skipped a short statement: {stmt!r}", stacklevel=2)
                else:
                    waiting.append((path, stmt))
    while waiting:
        later = []
        for path, stmt in waiting:
            try:
                spark.sql(stmt)
                ran.append(path)
            except Exception as exc:  # raised below
                (later if _waits_for_another(exc) else errors).append((path, stmt, str(exc).split("JVM stacktrace")[0]))
        if len(later) == len(waiting):
            errors += later
            break
        waiting = [(path, stmt) for path, stmt, _ in later]
    if errors:
        raise RuntimeError("view deployment failed:\n" + "\n".join(f"{path}: {why}" for path, _, why in errors))
    return ran
