"""Tables that grow by loads, where a load can be corrected.

A load writes its rows to folders of its own (a *run*) and registers them as partitions of ``<name>__data``. The *manifest*,
a small table beside the data with one row a run, says which run of every load id counts: the last one. The view ``name``
shows the rows of those runs. Appending the manifest row is the only switch: a load that fails before it changes nothing
that readers see, and a load that comes again under its id replaces exactly the rows of that load, whatever partitions
it had, even if it brings fewer of them or no rows at all.

Several tables can share a manifest (``publish_load`` takes them together), so rows and their quarantine change at once.
Loads of different ids can run side by side, because the manifest is only added to. ``vacuum_loads`` removes runs that
no longer count; it is the one operation that wants the tables to itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sources.tables import (LOAD_ID, add_columns, add_partitions, column_list, create_table, drop_partitions, full_path, list_folders,
                                       partition_spec, published, quoted, remove_folder, replace_view, write_table)

RUN = "_run"
MANIFEST = "load_id string, run string, seq long, partitions array<struct<table: string, path: string>>"


def _live(path: str) -> str:
    """The run that counts of every load id."""
    return f"(SELECT load_id, max(struct(seq, run)).run AS run FROM parquet.`{path}` WHERE seq > 0 GROUP BY load_id)"


def _note(spark: SparkSession, path: str, entry: tuple, name: str) -> None:
    """Add an entry to the manifest: one file, which is there or not, in a folder of its own (so that loads side by side
    never meet in one)."""
    write_table(spark.createDataFrame([entry], MANIFEST).coalesce(1), f"{path}/entry={name}")


def _show(spark: SparkSession, name: str, record: Mapping) -> None:
    data = f"{name}__data"
    columns = column_list(c for c in spark.table(data).columns if c != RUN)
    replace_view(spark, name, record, f"""SELECT {columns} FROM {data} LEFT SEMI JOIN {_live(record['manifest'])} live
        ON {LOAD_ID} = live.load_id AND {RUN} = live.run""")


def publish_load(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, Sequence[str]]], root: str,
                 load_id: str | None = None) -> str:
    """Add a load to the ``tables`` ({name: (rows, partition columns)}), all by one switch. The id of an earlier load
    replaces that load in all of them; by default every call is a load of its own. Columns new to a table are added, older
    rows read as NULL there. Returns the load id."""
    root, load_id = root.rstrip("/"), load_id or uuid.uuid4().hex[:16]
    run, names = uuid.uuid4().hex[:16], list(tables)
    record = next((r for r in (published(spark, n) for n in names) if r), None)
    if record is None:
        record = {"manifest": f"{root}/_manifest-{run}"}
        _note(spark, record["manifest"], (None, "", 0, []), "start")
    listed = []
    for n, (name, (rows, by)) in enumerate(tables.items()):
        data, out = f"{name}__data", full_path(spark, f"{root}/loads/{run}/{n}")
        rows = rows.drop(LOAD_ID, RUN)
        write_table(rows, out, partition_by=list(by))
        tagged = rows.withColumns({LOAD_ID: F.lit(load_id), RUN: F.lit(run)})
        if not spark.catalog.tableExists(data):
            create_table(spark, data, tagged, f"{root}/table-{n}", [*by, LOAD_ID, RUN])
        added = add_columns(spark, data, tagged)
        folders = list_folders(spark, out, len(by))
        add_partitions(spark, data, [({**partition_spec(spark, f[len(out):]), LOAD_ID: load_id, RUN: run}, f) for f in folders])
        spark.sql(f"REFRESH TABLE {quoted(data)}")
        if added or published(spark, name) is None:
            _show(spark, name, record)
        listed += [(name, f) for f in folders]
    last = spark.read.parquet(record["manifest"]).agg(F.max("seq")).first()[0]
    _note(spark, record["manifest"], (load_id, run, last + 1, listed), run)  # the switch
    for name in names:
        spark.sql(f"REFRESH TABLE {quoted(name)}")
    return load_id


def append_table(spark: SparkSession, df: DataFrame, name: str, root: str, load_id: str | None = None,
                 partition_by: Sequence[str] = ()) -> str:
    """``publish_load`` of one table."""
    return publish_load(spark, {name: (df, partition_by)}, root, load_id)


def loads_of(spark: SparkSession, name: str) -> DataFrame:
    """The manifest of a table: (load_id, run, seq, partitions, counts), one row a run, whether it counts or was replaced."""
    path = published(spark, name)["manifest"]
    runs = spark.read.parquet(path).where("seq > 0").drop("entry")
    live = spark.sql(f"SELECT load_id, run, true AS counts FROM {_live(path)}")
    return runs.join(live, ["load_id", "run"], "left").withColumn("counts", F.coalesce("counts", F.lit(False)))


def vacuum_loads(spark: SparkSession, names: Sequence[str], root: str) -> list[str]:
    """Remove the runs that no longer count, and what unfinished runs left behind, and write the manifest anew as one file.
    Nothing else may use the tables meanwhile. Returns the runs removed (a row of metadata each)."""
    root = root.rstrip("/")
    record = published(spark, names[0])
    live = spark.sql(f"SELECT m.* FROM parquet.`{record['manifest']}` m JOIN {_live(record['manifest'])} l USING (load_id, run)")
    new = {"manifest": f"{root}/_manifest-{uuid.uuid4().hex[:16]}"}
    seed = spark.createDataFrame([(None, "", 0, [])], MANIFEST)
    write_table(seed.union(live.select(*seed.columns)).coalesce(1), f"{new['manifest']}/entry=start")
    keep = {r["run"] for r in spark.read.parquet(new["manifest"]).select("run").collect()}
    for name in names:
        _show(spark, name, new)
    remove_folder(spark, record["manifest"])
    for name in names:
        parts = spark.sql(f"SHOW PARTITIONS {quoted(name + '__data')}")
        dead = parts.where(~F.element_at(F.split("partition", "="), -1).isin(*keep)).collect()  # names of dead partitions
        drop_partitions(spark, f"{name}__data", [partition_spec(spark, r["partition"]) for r in dead])
        spark.sql(f"REFRESH TABLE {quoted(name + '__data')}")
    gone = [f for f in list_folders(spark, f"{root}/loads", 1) if f.rsplit("/", 1)[1] not in keep]
    for folder in gone:
        remove_folder(spark, folder)
    return [f.rsplit("/", 1)[1] for f in gone]
