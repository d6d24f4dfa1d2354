"""A store of current rows by business key, and their history, that writes only what changes.

**Levels.** A run adds its new rows as one *open* slice and the rows it closes as one *closed* slice; nothing older is
rewritten. A row is current if no newer run brought a row of its key, so reading merges the open slices by one anti-join
on the key. When a slice is no smaller than half of the one before it, the two are merged into one that holds the newest row of
every key (closed slices: all rows). Sizes then fall by half from slice to slice, so there are at most log2(rows) + 1 of
either kind, and a row is rewritten at most that often.

**No shuffle of the store.** ``<name>__data`` is bucketed by the key, and every slice is written with the same hash, so
the anti-join and the join of a batch to the current rows (``operators.merge``) read the store where it lies; only the
batch moves. When all open slices are merged and buckets have outgrown ``ROWS_A_BUCKET``, the merged slice goes to a
data table of twice the buckets or more.

**One switch.** The view ``name`` lists the slices that count; replacing it makes a run visible. A run that fails before it
leaves slices that no view lists. Slices that a merge replaced are removed by the run after, when readers of the view before
are done.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sources.tables import (add_columns, column_list, create_table, drop_partitions, published, quoted, remove_folder,
                                       replace_view, table_location, text_literal)

SLICE, RUN, CURRENT, CLOSED = "_slice", "_run", "current", "closed"
ROWS_A_BUCKET = 16_000_000


def _in(slices) -> str:
    return f"{SLICE} IN ({', '.join(text_literal(s['slice']) for s in slices)})" if slices else "false"


def _by_table(slices) -> dict[str, list]:
    out: dict[str, list] = {}
    for s in slices:
        out.setdefault(s["table"], []).append(s)
    return out


def _newest_sql(slices, keys, columns: str) -> str:
    """The rows of open slices (oldest first, all in one table) that no newer slice replaces."""
    table = quoted(slices[0]["table"])
    if len(slices) == 1:
        return f"SELECT {columns} FROM {table} WHERE {_in(slices)}"
    names = [column_list([k]) for k in keys]
    newer = ", ".join(f"{n} AS `_n{i}`" for i, n in enumerate(names))
    same = " AND ".join(f"{n} = `_n{i}`" for i, n in enumerate(names))
    return f"""SELECT {columns} FROM (SELECT * FROM {table} WHERE {_in(slices)}) LEFT ANTI JOIN
        (SELECT {newer}, {RUN} AS `_newer` FROM {table} WHERE {_in(slices[1:])}) ON {same} AND {RUN} < `_newer`"""


def open_rows(spark: SparkSession, name: str) -> DataFrame:
    """The current rows, partitioned by the key's buckets as they are stored."""
    record = published(spark, name)
    table = spark.table(record["table"])
    return spark.sql(_newest_sql(record["open"], record["keys"], column_list(c for c in table.columns if c not in (SLICE, RUN))))


def top_key(spark: SparkSession, name: str) -> int:
    """The largest surrogate key given so far (kept in the view's record)."""
    return published(spark, name)["top"]


class _Run:
    """One run's slices of a store."""

    def __init__(self, spark: SparkSession, name: str, root: str, record: dict):
        self.spark, self.name, self.root, self.record = spark, name, root.rstrip("/"), record
        self.run = record["run"] + 1
        self.table = record["table"]

    def write(self, df: DataFrame, kind: str, run: int | None, sk: str | None = None) -> dict | None:
        """A new slice with the rows of ``df``; None if there are none. ``run`` None: the rows have their run."""
        name = f"{kind}-{self.run:06d}-{uuid.uuid4().hex[:8]}"
        df = df.drop(SLICE) if run is None else df.drop(SLICE, RUN).withColumn(RUN, F.lit(run).cast("long"))
        add_columns(self.spark, self.table, df)
        to = self.spark.table(self.table).schema
        have = set(df.columns)
        placed = df.select(*(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in to if f.name != SLICE), F.lit(name).alias(SLICE))
        placed.repartition(self.record["buckets"], *self.record["keys"]).write.mode("append").insertInto(self.table)
        top = F.max(sk).cast("long") if sk else F.lit(None)
        rows, top = self.spark.table(self.table).where(F.col(SLICE) == name).agg(F.count(F.lit(1)), top).first()
        return {"slice": name, "rows": rows, "table": self.table, "top": top or 0} if rows else None

    def merged_from(self, slices: list[dict]) -> int:
        """From which slice on all are merged: while one is at most twice what comes after it."""
        at, after = len(slices) - 1, slices[-1]["rows"] if slices else 0
        while at > 0 and slices[at - 1]["rows"] <= 2 * after:
            at -= 1
            after += slices[at]["rows"]
        return max(at, 0)

    def compact(self, slices: list[dict], kind: str, dead: list[dict]) -> list[dict]:
        at = self.merged_from(slices)
        if at >= len(slices) - 1:
            return slices
        gone = slices[at:]
        if kind == "open":
            rows = self.spark.sql(_newest_sql(gone, self.record["keys"], "*"))
            needed = -(-sum(s["rows"] for s in gone) // ROWS_A_BUCKET)
            if at == 0 and needed > self.record["buckets"]:
                self.grow(max(needed, 2 * self.record["buckets"]))
        else:
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                          (self.spark.table(t).where(_in(s)) for t, s in _by_table(gone).items()))
        new = self.write(rows, kind, None)
        dead += gone
        return slices[:at] + [new]

    def grow(self, buckets: int) -> None:
        """A data table of more buckets, for the slices from now on."""
        old = self.spark.table(self.table)
        self.table = f"{self.name}__data_{self.run}"
        self.record |= {"buckets": buckets, "table": self.table}
        _create(self.spark, self.table, old, f"{self.root}/table-{uuid.uuid4().hex[:8]}", self.record["keys"], buckets)


def _create(spark: SparkSession, table: str, df: DataFrame, path: str, keys, buckets: int) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")  # of a run that did not finish: no view shows it
    create_table(spark, table, df, path, [SLICE], bucket_by=list(keys), buckets=buckets)


def _forget(spark: SparkSession, slices: list[dict]) -> None:
    for table, of in _by_table(slices).items():
        if spark.catalog.tableExists(table):
            drop_partitions(spark, table, [{SLICE: s["slice"]} for s in of])
            location = table_location(spark, table)
            for s in of:
                remove_folder(spark, f"{location}/{SLICE}={s['slice']}")


def publish_changes(spark: SparkSession, name: str, root: str, keys, sk: str, fresh: DataFrame, closed: DataFrame | None = None,
                    history: bool = True, buckets: int | None = None) -> dict:
    """Publish a run: ``fresh``, new current rows (one a key; they replace the current rows of their keys), and ``closed``,
    rows that go to history. ``history=False`` is a store of current rows only. The key columns must not be NULL. The first run
    fixes the number of ``buckets`` (default: the shuffle partitions); merges raise it. Returns the record."""
    keys, before = list(keys), published(spark, name)
    record = dict(before) if before else {"run": 0, "keys": keys, "table": f"{name}__data", "open": [], "closed": [], "dead": [], "top": 0,
                                          "history": history, "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))}
    if before is None:
        empty = fresh.drop(SLICE, RUN).withColumns({RUN: F.lit(0).cast("long"), SLICE: F.lit("")})
        _create(spark, record["table"], empty, f"{root.rstrip('/')}/table-{uuid.uuid4().hex[:8]}", keys, record["buckets"])
    run, dead = _Run(spark, name, root, record), []
    new = run.write(fresh, "open", run.run, sk)
    out = run.write(closed, "closed", run.run) if closed is not None else None
    levels = run.compact(record["open"] + ([new] if new else []), "open", dead)
    past = run.compact(record["closed"] + ([out] if out else []), "closed", dead)
    record |= {"run": run.run, "open": levels, "closed": past, "dead": dead, "top": max(record["top"], new["top"] if new else 0)}
    tables = {record["table"], *_by_table(levels + past)}
    widest = spark.table(record["table"])
    for t in tables - {record["table"]}:
        add_columns(spark, t, widest)
    for t in tables:
        spark.sql(f"REFRESH TABLE {quoted(t)}")
    columns = column_list(c for c in widest.columns if c not in (SLICE, RUN))
    shown = _newest_sql(levels, keys, columns) if levels else f"SELECT {columns} FROM {quoted(record['table'])} WHERE false"
    if record["history"]:
        shown = f"SELECT {columns}, '{CURRENT}' AS {SLICE} FROM ({shown})" + "".join(
            f" UNION ALL SELECT {columns}, '{CLOSED}' AS {SLICE} FROM {quoted(t)} WHERE {_in(of)}" for t, of in _by_table(past).items())
    replace_view(spark, name, record, shown)
    if before:
        _forget(spark, before["dead"])
    return record
