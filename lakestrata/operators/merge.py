"""Slowly changing dimensions as join algebra that returns the new table state.

No MERGE statement is needed: each function takes the current target state and a batch (one row per
business key, see ``dedup.one_per_key``) and returns the next state as DataFrames, which the caller
publishes: the full state with ``sources.tables.publish_state``, or for SCD2 only the change
(``scd2_delta``: rows closed by this run + the new open set). Stored tables (``sources.keyed_store``) take just the
change: ``scd1_changes``, ``scd2_changes`` and ``scd2_hash_changes`` classify a batch by one join to the current rows, which
are not shuffled, and give the rows to add and the rows to close.
Closed history is passed through untouched and never joined. Every clock is the ``as_of`` parameter.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.contract import (CREATE_DATE, END_DATE, IS_ACTIVE, ROW_HASH, START_DATE, SYSTEM_COLUMNS,
                                 UPDATE_DATE)
from lakestrata.functions.hashing import row_hash
from lakestrata.operators.keys import dense_keys, max_key

# Fixed value: end date of an open (current) version.
OPEN_END = _dt.date(9999, 12, 31)
NEW, CHANGED, SAME = 0, 1, 2


def _date(d) -> Column:
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))).cast("date")


def is_open(end_col: str = END_DATE) -> Column:
    """Open-version predicate written so the parquet scan receives it (EqualTo pushdown)."""
    return F.col(end_col) == F.lit(OPEN_END)


def is_closed(end_col: str = END_DATE) -> Column:
    """History rows (anything not open, NULL end included); pushed down as Or(Not(EqualTo), IsNull)."""
    return (F.col(end_col) != F.lit(OPEN_END)) | F.col(end_col).isNull()


def current_versions(dim: DataFrame, end_col: str = END_DATE) -> DataFrame:
    """Open versions of an SCD2 table (date form, end date 9999-12-31)."""
    return dim.filter(F.col(end_col) == F.lit(OPEN_END))


def active_versions(dim: DataFrame, flag: str = IS_ACTIVE) -> DataFrame:
    """Active versions of a flag-form SCD2 table."""
    return dim.filter(F.col(flag) == F.lit(True))


def _union(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ---------------------------------------------------------------------------------------------- SCD1
def scd1_merge(target: DataFrame, source: DataFrame, on) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *, as a state function.

    Matched target rows take every source column; target columns the source lacks keep their value;
    unmatched source rows are inserted; unmatched target rows stay.
    """
    on = [on] if isinstance(on, str) else list(on)
    untouched = target.join(source.select(*on), on, "left_anti")
    extra = [c for c in target.columns if c not in source.columns]
    if extra:
        source = source.join(target.select(*on, *extra), on, "left")
    return _union(untouched, source)


def scd1_first_load(batch: DataFrame, keys, sk: str, as_of) -> DataFrame:
    d = _date(as_of)
    return (dense_keys(batch.drop(sk), list(keys), sk, offset=0)
            .withColumns({CREATE_DATE: d, UPDATE_DATE: d}))


def scd1_prepare(target: DataFrame, batch: DataFrame, keys, sk: str, as_of, offset=None) -> DataFrame:
    """Batch rows ready to merge: known keys keep their surrogate key and create date (update date =
    as_of); new keys get the next surrogate keys in key order (create = update = as_of), after
    ``offset`` (a one-row frame; default: the target's maximum key)."""
    keys = list(keys)
    d = _date(as_of)
    slim = target.select(*keys, F.col(sk).alias("_t_sk"), F.col(CREATE_DATE).alias("_t_create"))
    cls = batch.drop(sk, CREATE_DATE, UPDATE_DATE).join(slim, keys, "left")
    old = (cls.filter(F.col("_t_sk").isNotNull())
           .withColumns({sk: F.col("_t_sk"), CREATE_DATE: F.col("_t_create"), UPDATE_DATE: d})
           .drop("_t_sk", "_t_create"))
    new = dense_keys(cls.filter(F.col("_t_sk").isNull()).drop("_t_sk", "_t_create"), keys, sk,
                     offset=max_key(target, sk) if offset is None else offset)
    new = new.withColumns({CREATE_DATE: d, UPDATE_DATE: d})
    return _union(old, new)


def scd1_state(target: DataFrame | None, batch: DataFrame, keys, sk: str, as_of) -> DataFrame:
    """SCD1 gold load: first load when there is no target, else prepare + merge on the surrogate key."""
    if target is None:
        return scd1_first_load(batch, keys, sk, as_of)
    return scd1_merge(target, scd1_prepare(target, batch, keys, sk, as_of), [sk])


def scd1_upsert(target: DataFrame | None, batch: DataFrame, keys, columns, sk: str | None = None) -> DataFrame:
    """Path-style SCD1: matched keys get the batch's non-key, non-surrogate columns; new keys are
    inserted with the next surrogate keys. A first load has ``columns`` plus the key; later loads keep the
    target's columns."""
    keys = list(keys)
    columns = [c for c in columns if c != sk]
    src = batch.select(*columns)
    if target is None:
        out = dense_keys(src, keys, sk, offset=0) if sk else src
        return out.select(*columns, *([sk] if sk else []))
    upd = [c for c in columns if c not in keys]
    t_rest = [c for c in target.columns if c not in upd and c not in keys]
    matched = src.join(target.select(*keys, *t_rest), keys, "inner")
    untouched = target.join(src.select(*keys), keys, "left_anti")
    new = src.join(target.select(*keys), keys, "left_anti")
    if sk:
        new = dense_keys(new, keys, sk, offset=max_key(target, sk))
    out_cols = target.columns
    return _union(untouched.select(*out_cols), matched, new).select(*out_cols)


# ---------------------------------------------------------------------------------------------- SCD2
def scd2_first_load(batch: DataFrame, keys, sk: str, as_of) -> DataFrame:
    return (dense_keys(batch.drop(sk, START_DATE, END_DATE), list(keys), sk, offset=0)
            .withColumns({START_DATE: _date(as_of), END_DATE: F.lit(OPEN_END)}))


def classify_against_current(cur: DataFrame, batch: DataFrame, keys, sk: str, ignore=(),
                             keep_sk: bool = False) -> DataFrame:
    """One left join of the batch to the open versions: ``_status`` NEW / CHANGED / SAME.

    Compared columns: batch columns minus keys, surrogate key and system columns. The compare is
    null-safe; a batch column the target lacks compares with NULL.
    """
    keys = list(keys)
    skip = set(keys) | {sk} | set(SYSTEM_COLUMNS) | set(ignore)
    cols = [c for c in batch.columns if c not in skip]
    cur_cols = set(cur.columns)
    slim = cur.select(*keys, F.col(sk).alias("_cur_sk"),
                      *[F.col(c).alias("_cur_" + c) for c in cols if c in cur_cols])
    diffs = [~(F.col("_cur_" + c) if c in cur_cols else F.lit(None)).eqNullSafe(F.col(c)) for c in cols]
    differs = reduce(lambda a, b: a | b, diffs) if diffs else F.lit(False)
    status = (F.when(F.col("_cur_sk").isNull(), F.lit(NEW))
              .when(differs, F.lit(CHANGED)).otherwise(F.lit(SAME)))
    out = batch.join(slim, keys, "left").withColumn("_status", status)
    return out.drop(*([] if keep_sk else ["_cur_sk"]), *["_cur_" + c for c in cols if c in cur_cols])


SLICE, CURRENT_SLICE = "_slice", "current"


def split_versions(target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(open versions, history). A table of ``sources.keyed_store`` shows them as ``_slice``, so the split reads only
    the slices of its side; otherwise the end-date predicates are pushed to the scan."""
    if SLICE in target.columns:
        return (target.filter(F.col(SLICE) == CURRENT_SLICE).drop(SLICE),
                target.filter(F.col(SLICE) != CURRENT_SLICE).drop(SLICE))
    return target.filter(is_open()), target.filter(is_closed())


def scd2_delta(target: DataFrame, batch: DataFrame, keys, sk: str, as_of, close: str = "same_day",
               ignore=()) -> tuple[DataFrame, DataFrame]:
    """The change an SCD2 batch makes: ``(closed, current)``.

    ``closed``: open rows of changed keys, now ended (``as_of``, or the day before with
    ``close='day_before'``), to be added to history. ``current``: the new set of open rows, i.e. untouched
    open rows plus new versions for new and changed keys, numbered after max(sk), new keys first, then
    changed keys, each in key order. History is not read (for an unsliced table, only its key column is
    scanned for the maximum).
    """
    keys = list(keys)
    d = _date(as_of)
    end_day = d if close == "same_day" else F.date_sub(d, 1)
    batch = batch.drop(sk, START_DATE, END_DATE, SLICE)
    cur, _ = split_versions(target)
    cls = classify_against_current(cur, batch, keys, sk, ignore)
    ins = cls.filter(F.col("_status") != SAME).withColumn("_is_changed", F.col("_status")).drop("_status")
    # In a sliced table the open slice holds the largest key: a row leaves it only when a new version with
    # a larger key replaces it. So the history slices are not read at all.
    top = max_key(cur if SLICE in target.columns else target, sk)
    ins = (dense_keys(ins, ["_is_changed", *keys], sk, offset=top).drop("_is_changed")
           .withColumns({START_DATE: d, END_DATE: F.lit(OPEN_END)}))
    expire = cls.filter(F.col("_status") == CHANGED).select(*keys, F.lit(True).alias("_expire"))
    marked = cur.join(expire, keys, "left")
    closed = marked.filter(F.col("_expire")).withColumn(END_DATE, end_day).drop("_expire")
    still_open = marked.filter(F.col("_expire").isNull()).drop("_expire")
    return closed, _union(still_open, ins)


def scd2_state(target: DataFrame | None, batch: DataFrame, keys, sk: str, as_of, close: str = "same_day",
               ignore=()) -> DataFrame:
    """SCD2 with validity dates: the full next state = history + ``scd2_delta`` (closed + current).

    Re-running the same batch changes nothing.
    """
    keys = list(keys)
    if target is None:
        return scd2_first_load(batch, keys, sk, as_of)
    closed, current = scd2_delta(target, batch, keys, sk, as_of, close, ignore)
    _, hist = split_versions(target)
    return _union(hist, closed, current)


def scd2_prepare(target: DataFrame, batch: DataFrame, keys, sk: str) -> DataFrame:
    """Merge source for ``scd2_merge``: changed keys once with their open surrogate key (to close) and
    once with a new one (to insert), new keys with a new one; numbering after max(sk), new keys first."""
    keys = list(keys)
    batch = batch.drop(sk, START_DATE, END_DATE)
    cls = classify_against_current(target.filter(is_open()), batch, keys, sk, keep_sk=True)
    old = cls.filter(F.col("_status") == CHANGED).withColumn(sk, F.col("_cur_sk")).drop("_status", "_cur_sk")
    fresh = (cls.filter(F.col("_status") != SAME).withColumn("_is_changed", F.col("_status"))
             .drop("_status", "_cur_sk"))
    fresh = dense_keys(fresh, ["_is_changed", *keys], sk, offset=max_key(target, sk)).drop("_is_changed")
    return _union(old, fresh)


def scd2_merge(target: DataFrame, source: DataFrame, on, as_of, ignore=()) -> DataFrame:
    """MERGE on surrogate key(s) against open rows: a matched open row whose compared columns differ
    (null-safe) is closed at ``as_of``; an unmatched source row is inserted open from ``as_of``.

    Compared columns are all source columns except ``on`` and the validity dates (plus ``ignore``).
    """
    on = [on] if isinstance(on, str) else list(on)
    d = _date(as_of)
    cur = target.filter(is_open())
    hist = target.filter(is_closed())
    src = source.drop(START_DATE, END_DATE)
    skip = set(on) | {START_DATE, END_DATE} | set(ignore)
    cols = [c for c in src.columns if c not in skip]
    cur_cols = set(cur.columns)
    slim = cur.select(*on, F.lit(True).alias("_m"), *[F.col(c).alias("_cur_" + c) for c in cols if c in cur_cols])
    diffs = [~(F.col("_cur_" + c) if c in cur_cols else F.lit(None)).eqNullSafe(F.col(c)) for c in cols]
    differs = reduce(lambda a, b: a | b, diffs) if diffs else F.lit(False)
    cls = src.join(slim, on, "left")
    expire = cls.filter(F.col("_m") & differs).select(*on, F.lit(True).alias("_expire"))
    cur_out = (cur.join(expire, on, "left")
               .withColumn(END_DATE, F.when(F.col("_expire"), d).otherwise(F.col(END_DATE))).drop("_expire"))
    ins = (cls.filter(F.col("_m").isNull()).select(*src.columns)
           .withColumns({START_DATE: d, END_DATE: F.lit(OPEN_END)}))
    return _union(hist, cur_out, ins)


# --------------------------------------------------------------------------------------- SCD2 (hash)
def scd2_hash_first_load(batch: DataFrame, keys, attrs, sk: str, as_of) -> DataFrame:
    src = batch if START_DATE in batch.columns else batch.withColumn(START_DATE, _date(as_of))
    return (dense_keys(src.drop(sk), list(keys), sk, offset=0)
            .withColumns({END_DATE: F.lit(OPEN_END), IS_ACTIVE: F.lit(True), ROW_HASH: row_hash(attrs)}))


def scd2_hash_state(target: DataFrame | None, batch: DataFrame, keys, attrs, sk: str, as_of) -> DataFrame:
    """Flag-form SCD2 driven by an attribute hash.

    A changed active row becomes inactive with end = (batch start - 1 day); new and changed keys are
    inserted active and open, numbered after max(sk) in key order. Only ``_hash`` is stored.
    """
    keys = list(keys)
    if target is None:
        return scd2_hash_first_load(batch, keys, attrs, sk, as_of)
    src = batch if START_DATE in batch.columns else batch.withColumn(START_DATE, _date(as_of))
    src = src.drop(sk, END_DATE, IS_ACTIVE).withColumn(ROW_HASH, row_hash(attrs))
    active = target.filter(F.col(IS_ACTIVE) == F.lit(True)).select(*keys, F.col(ROW_HASH).alias("_tgt_hash"))
    cls = src.join(active, keys, "left")
    changed = cls.filter(F.col("_tgt_hash").isNotNull() & (F.col("_tgt_hash") != F.col(ROW_HASH)))
    close = changed.select(*keys, F.date_sub(F.col(START_DATE), 1).alias("_new_end"))
    hit = F.col("_new_end").isNotNull()
    still = target.filter(F.col(IS_ACTIVE) == F.lit(True)).join(close, keys, "left")
    tgt_out = still.withColumns({END_DATE: F.when(hit, F.col("_new_end")).otherwise(F.col(END_DATE)),
                                 IS_ACTIVE: ~hit}).drop("_new_end")
    past = target.filter(~F.col(IS_ACTIVE).eqNullSafe(F.lit(True)))  # history passes by the joins
    ins = cls.filter(F.col("_tgt_hash").isNull() | (F.col("_tgt_hash") != F.col(ROW_HASH))).drop("_tgt_hash")
    ins = (dense_keys(ins, keys, sk, offset=max_key(target, sk))
           .withColumns({END_DATE: F.lit(OPEN_END), IS_ACTIVE: F.lit(True)}))
    return _union(past, tgt_out, ins)


# --------------------------------------------------------------------------- changes to a stored table
def classified(current: DataFrame, batch: DataFrame, keys, differs) -> DataFrame:
    """The one pass over the current rows: the batch, each row with the current row of its key as ``_old`` (NULL if there is
    none) and ``_status`` NEW / CHANGED / SAME. ``differs(old, batch)`` is the condition of a change. Keys are compared in
    the store's types, so a store bucketed by them stays where it is."""
    keys = list(keys)
    batch = batch.withColumns({k: F.col(k).cast(current.schema[k].dataType) for k in keys})
    old = current.select(*keys, F.struct(*(F.col(c) for c in current.columns)).alias("_old"))
    out = batch.join(old, keys, "left")
    status = F.when(F.col("_old").isNull(), NEW).when(differs(set(current.columns), batch), CHANGED).otherwise(SAME)
    return out.withColumn("_status", status)


def _old_differs(keys, sk: str, ignore=()):
    """Any column of the batch but keys, surrogate key and system columns differs, NULLs being equal."""
    skip = set(keys) | {sk} | set(SYSTEM_COLUMNS) | set(ignore)

    def differs(have: set[str], batch: DataFrame) -> Column:
        old = lambda c: F.col("_old")[c] if c in have else F.lit(None)
        return reduce(lambda a, b: a | b, (~old(c).eqNullSafe(F.col(c)) for c in batch.columns if c not in skip), F.lit(False))

    return differs


def scd1_changes(current: DataFrame, batch: DataFrame, keys, sk: str, as_of, top: int, keep=lambda df, name: df) -> DataFrame:
    """The rows an SCD1 batch writes: known keys keep surrogate key, create date and the columns that the batch lacks; new
    keys are numbered after ``top`` in key order. ``keep(frame, name)`` may store the classified batch, which is
    used twice."""
    d, have = _date(as_of), set(current.columns)
    batch = batch.drop(sk, CREATE_DATE, UPDATE_DATE)
    rows = keep(classified(current, batch, keys, lambda *_: F.lit(True)), "scd1")
    lacking = {c: F.col("_old")[c] for c in current.columns if c not in batch.columns and c not in (CREATE_DATE, UPDATE_DATE)}
    old = rows.filter(F.col("_status") != NEW).withColumns({
        **lacking, CREATE_DATE: F.col("_old")[CREATE_DATE] if CREATE_DATE in have else d, UPDATE_DATE: d})
    new = dense_keys(rows.filter(F.col("_status") == NEW), list(keys), sk, offset=top).withColumns({CREATE_DATE: d, UPDATE_DATE: d})
    return _union(old.drop("_old", "_status"), new.drop("_old", "_status"))


def scd2_changes(current: DataFrame, batch: DataFrame, keys, sk: str, as_of, top: int, close: str = "same_day", ignore=(),
                 keep=lambda df, name: df) -> tuple[DataFrame, DataFrame]:
    """(closed, fresh) of an SCD2 batch with validity dates: the same rows as ``scd2_delta`` closes and opens."""
    keys, d = list(keys), _date(as_of)
    batch = batch.drop(sk, START_DATE, END_DATE, SLICE)
    rows = classified(current, batch, keys, _old_differs(keys, sk, ignore))
    rows = keep(rows.filter(F.col("_status") != SAME), "scd2")
    closed = rows.filter(F.col("_status") == CHANGED).select("_old.*").withColumn(
        END_DATE, d if close == "same_day" else F.date_sub(d, 1))
    fresh = dense_keys(rows.drop("_old"), ["_status", *keys], sk, offset=top).drop("_status")
    return closed, fresh.withColumns({START_DATE: d, END_DATE: F.lit(OPEN_END)})


def scd2_hash_changes(current: DataFrame, batch: DataFrame, keys, attrs, sk: str, as_of, top: int,
                      keep=lambda df, name: df) -> tuple[DataFrame, DataFrame]:
    """(closed, fresh) of a flag-form SCD2 batch: the same rows as ``scd2_hash_state`` closes and inserts."""
    keys = list(keys)
    src = batch if START_DATE in batch.columns else batch.withColumn(START_DATE, _date(as_of))
    src = src.drop(sk, END_DATE, IS_ACTIVE, SLICE).withColumn(ROW_HASH, row_hash(attrs))
    rows = classified(current, src, keys, lambda *_: F.col("_old")[ROW_HASH] != F.col(ROW_HASH))
    rows = keep(rows.filter(F.col("_status") != SAME), "scd2-hash")
    closed = rows.filter(F.col("_status") == CHANGED).select("_old.*", F.date_sub(F.col(START_DATE), 1).alias("_end"))
    closed = closed.withColumns({END_DATE: F.col("_end"), IS_ACTIVE: F.lit(False)}).drop("_end")
    fresh = dense_keys(rows.drop("_old", "_status"), keys, sk, offset=top)
    return closed, fresh.withColumns({END_DATE: F.lit(OPEN_END), IS_ACTIVE: F.lit(True)})
