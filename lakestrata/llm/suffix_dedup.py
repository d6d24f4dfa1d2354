"""Repeated byte strings, by a logarithmic family of suffix arrays in every shard.

A window is ``size`` bytes of one document. Windows are dealt to shards by their minimiser (a run of ``GRAM``
bytes), consecutive windows with one minimiser as one string, so equal windows always meet in a shard. There
the strings arrive in batches. Each batch gets a sparse suffix array: one suffix per string, the one that starts
at its minimiser, ordered by a hash of its first ``GRAM`` bytes. Every match of ``size`` bytes contains the
minimisers of its windows, so these suffixes suffice to find it. The batch's array is merge-scanned against
itself and every level of the index; suffixes that begin alike are compared to the right and to the left of
the minimiser, and where both lengths cover a window, the later of the two places loses those windows. The batch
then becomes a level, and levels of equal size are merged, so a shard keeps a logarithmic number of them.

Equal strings collapse to their first place in each chunk and in each batch. A minimiser with more than ``HOT``
different strings leaves the shard: its windows are dealt out by their own text in a second step, and strings
that arrive later follow them, so the index of a shard stays bounded by its different, ordinary strings.

"Earlier" means a smaller id, or the same id and an earlier start. Windows are judged on the input. Defined
results: a null or empty text has no bytes; texts shorter than a window lose nothing; rows that repeat a
document (same id and text) are one place, so each gets the same result; a null id counts as the smallest; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import _superstrings as S
from lakestrata.llm._common import by_bytes, id_and_text, partitions_for, public_id, stored, told_apart

GRAM = 20
BATCH_BYTES = 1 << 23
HOT = 20_000
PAIRWISE = 64  # up to so many strings, pairs are compared; beyond, their windows are sorted

_FOUND = "id long, th long, start long, n long, shard int, packed binary"
_FOUND_SCHEMA = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("n", pa.int64()),
                           ("shard", pa.int32()), ("packed", pa.binary())])


def super_strings(parts: list[bytes], size: int):
    """For byte strings: part, first byte, minimiser, its offset and the string of each run of windows."""
    text = b"".join(parts)
    data = np.frombuffer(text, dtype=np.uint8)
    if len(data) < size:
        return [], np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    before = np.cumsum(lengths) - lengths
    part = np.repeat(np.arange(len(parts)), lengths)
    at = np.arange(len(data) - GRAM + 1)
    with np.errstate(over="ignore"):
        grams = S.run_hashes(data, at, at + GRAM)
    valid = part[: len(part) - size + 1] == part[size - 1:]
    first, n, minimiser, place = S.runs(grams, valid, size - GRAM + 1)
    strings = [text[b:e] for b, e in zip(first.tolist(), (first + n + size - 1).tolist())]
    return part[first], first - before[part[first]], minimiser, place - first, strings


def first_places(strings: list[bytes], ids, starts, hashes):
    """Collapse equal strings: the rows that hold a first place, and the rows that do not. Rows that repeat the
    very same place fall away."""
    different, which = S.distinct(strings)
    order = np.lexsort((hashes, starts, ids, which))
    lead = np.ones(len(order), dtype=bool)
    lead[1:] = np.diff(which[order]) != 0
    same = np.zeros(len(order), dtype=bool)
    a, b = order[1:], order[:-1]
    same[1:] = ~lead[1:] & (ids[a] == ids[b]) & (starts[a] == starts[b]) & (hashes[a] == hashes[b])
    # a repeat of the first place is no later place; chains of repeats end at the first
    head = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    is_head = (ids[order] == ids[head]) & (starts[order] == starts[head]) & (hashes[order] == hashes[head])
    return order[lead], order[~is_head & ~same]


def _partition(size: int, shards: int):
    def run(batches):
        for batch in batches:
            ids, hashes = batch.column("id").to_numpy(), batch.column("th").to_numpy()
            texts = batch.column("text")
            lengths = pc.binary_length(texts).to_pylist()
            limit = S.CHUNK_BYTES
            for b, e in by_bytes(lengths, S.PACK_BYTES):
                owner, offset, parts = [], [], []
                for i in range(b, e):
                    if lengths[i] >= size:
                        data = texts[i].as_py().encode()
                        for at in range(0, max(1, len(data) - size + 1), limit) if len(data) > 2 * limit else (0,):
                            owner.append(i)
                            offset.append(at)
                            parts.append(data[at: at + limit + size - 1] if len(data) > 2 * limit else data)
                found = []
                for lo, hi in by_bytes([len(p) for p in parts], limit):
                    part, first, minimiser, anchor, text = super_strings(parts[lo:hi], size)
                    if text:
                        row = np.array(owner[lo:hi])[part]
                        found.append((text, ids[row], hashes[row], first + np.array(offset[lo:hi])[part], minimiser, anchor))
                if not found:
                    continue
                strings = [x for f in found for x in f[0]]
                i, h, first, minimiser, anchor = (np.concatenate(c) for c in list(zip(*found))[1:])
                heads, later = first_places(strings, i, first, h)
                shard = S.shard_of(minimiser, shards)
                out = []
                for s, rows in S.grouped(shard[heads]):
                    r = heads[rows]
                    out.append((s, S.pack([strings[x] for x in r.tolist()], minimiser[r].astype(np.int64), anchor[r],
                                          i[r], first[r], h[r])))
                n = np.fromiter((len(strings[x]) - size + 1 for x in later.tolist()), np.int64, len(later))
                yield _found([i[later], h[later], first[later], n], [s for s, _ in out], [p for _, p in out])

    return run


def _found(columns=(), shard=(), packed=()) -> pa.RecordBatch:
    n, m = len(columns[0]) if len(columns) else 0, len(shard)
    arrays = [pa.concat_arrays([pa.array(columns[c] if n else [], pa.int64()), pa.nulls(m, pa.int64())]) for c in range(4)]
    return pa.record_batch([*arrays, pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(shard, pa.int32())]),
                            pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(packed, pa.binary())])],
                           schema=_FOUND_SCHEMA)


def same_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def same_suffix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[len(a) - n:], b[len(b) - n:]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_length() + 7) // 8


class Level:
    """A sorted suffix array: minimiser hashes in order, with the strings and places of the suffixes."""

    def __init__(self, grams, strings, meta):
        order = np.argsort(grams, kind="stable")  # two sorted runs merge in one pass
        self.grams, self.meta = grams[order], meta[order]  # meta rows: anchor, id, start, th
        self.strings = [strings[i] for i in order.tolist()]

    def rows(self, gram) -> range:
        return range(int(np.searchsorted(self.grams, gram)), int(np.searchsorted(self.grams, gram, side="right")))

    def without(self, grams) -> "Level":
        stay = np.flatnonzero(~np.isin(self.grams, grams))
        return Level(self.grams[stay], [self.strings[i] for i in stay.tolist()], self.meta[stay])


class Index:
    """The logarithmic family of one shard. ``insert`` returns the windows that lose their place."""

    def __init__(self, size: int, hot: int):
        self.size, self.hot = size, hot
        self.levels: dict[int, Level] = {}
        self.hot_grams: set[int] = set()

    def insert(self, grams, strings, meta):
        """(losses as rows of id, th, start, n; strings and places of minimisers that are hot)."""
        lost: list[tuple[int, int, int, int]] = []
        dealt: list[tuple[bytes, list[int]]] = []
        if self.hot_grams:
            hot = np.isin(grams, np.array(list(self.hot_grams), dtype=np.uint64))
            dealt += [(strings[i], meta[i].tolist()) for i in np.flatnonzero(hot).tolist()]
            stay = np.flatnonzero(~hot)
            grams, strings, meta = grams[stay], [strings[i] for i in stay.tolist()], meta[stay]
        batch = Level(grams, strings, meta)
        different, first, count = np.unique(batch.grams, return_index=True, return_counts=True)
        met = count > 1
        for level in self.levels.values():  # the merge-scan: both arrays are in the same order
            met |= np.isin(different, level.grams)
        overfull = []
        for at in np.flatnonzero(met).tolist():
            new = [(batch.strings[i], *batch.meta[i].tolist()) for i in range(first[at], first[at] + count[at])]
            old = [(level.strings[i], *level.meta[i].tolist()) for level in self.levels.values()
                   for i in level.rows(different[at])]
            if len(new) + len(old) > self.hot:
                overfull.append(different[at])
                dealt += [(s, list(m)) for s, *m in new + old]
            elif len(new) + len(old) > PAIRWISE:
                lost += self._sort_windows(new + old)
            else:
                lost += self._compare(new, old)
        if overfull:
            gone = np.array(overfull, dtype=np.uint64)
            self.hot_grams |= {int(g) for g in overfull}
            batch = batch.without(gone)
            self.levels = {k: v.without(gone) for k, v in self.levels.items()}
        rank = 0
        while rank in self.levels:
            other = self.levels.pop(rank)
            batch = Level(np.concatenate([other.grams, batch.grams]), other.strings + batch.strings,
                          np.concatenate([other.meta, batch.meta]))
            rank += 1
        self.levels[rank] = batch
        return lost, dealt

    def _compare(self, new, old):
        size = self.size
        for x, (s, sa, si, sf, sh) in enumerate(new):
            s_left, s_right = s[:sa], s[sa:]
            for t, ta, ti, tf, th in old + new[:x]:
                right = same_prefix(s_right, t[ta:])
                left = same_suffix(s_left, t[:ta])
                if left + right < size or (si, sf + sa, sh) == (ti, tf + ta, th):
                    continue
                n = left + right - size + 1
                if (si, sf + sa, sh) > (ti, tf + ta, th):
                    yield si, sh, sf + sa - left, n
                else:
                    yield ti, th, tf + ta - left, n

    def _sort_windows(self, members):
        """Equal windows have their minimiser at the same offset: sort the windows of one offset at a time."""
        size = self.size
        for offset in range(size - GRAM + 1):
            cut = []
            for s, a, i, f, h in members:
                b = a - offset
                if b >= 0 and b + size <= len(s):
                    cut.append((s[b: b + size], i, f + b, h))
            cut.sort()
            for x, y in zip(cut, cut[1:]):
                if x[0] == y[0]:
                    # in order, so the first of a run of equals is the earliest; repeats of one place are one
                    if x[1:] != y[1:]:
                        yield y[1], y[3], y[2], 1


def _scan(size: int, shards: int, hot: int):
    """A task's packed strings, batch by batch through the index."""

    def run(batches):
        index = Index(size, hot)
        held, bytes_held = [], 0
        for batch in batches:
            for packed in batch.column("packed").to_pylist():
                strings, columns = S.unpack(packed)
                held.append((strings, columns))
                bytes_held += sum(map(len, strings))
                if bytes_held >= BATCH_BYTES:
                    yield from _insert(index, held, size, shards)
                    held, bytes_held = [], 0
        if held:
            yield from _insert(index, held, size, shards)

    return run


def _insert(index: Index, held, size: int, shards: int):
    strings = [s for part, _ in held for s in part]
    grams, anchor, ids, starts, hashes = (np.concatenate([c[k] for _, c in held]) for k in range(5))
    heads, later = first_places(strings, ids, starts, hashes)
    if len(later):
        n = np.fromiter((len(strings[x]) - size + 1 for x in later.tolist()), np.int64, len(later))
        yield _found([ids[later], hashes[later], starts[later], n])
    meta = np.stack([anchor, ids, starts, hashes], axis=1)[heads]
    lost, dealt = index.insert(grams[heads].astype(np.uint64), [strings[i] for i in heads.tolist()], meta)
    if lost:
        yield _found(np.array(lost, dtype=np.int64).T)
    for at in range(0, len(dealt), 4096):
        yield _deal_windows(dealt[at: at + 4096], size, shards)


def _deal_windows(dealt, size: int, shards: int) -> pa.RecordBatch:
    """The windows of hot minimisers, packed by a hash of their own text."""
    from xxhash import xxh64_intdigest

    windows, where = [], []
    for s, (_, i, f, h) in dealt:
        for b in range(len(s) - size + 1):
            windows.append(s[b: b + size])
            where.append((i, f + b, h))
    where = np.array(where, dtype=np.int64).reshape(-1, 3)
    shard = np.fromiter((xxh64_intdigest(w) % shards for w in windows), np.int64, len(windows))
    out = [(s, S.pack([windows[r] for r in rows.tolist()], where[rows, 0], where[rows, 1], where[rows, 2]))
           for s, rows in S.grouped(shard)]
    return _found((), [s for s, _ in out], [p for _, p in out])


def _first_windows(batches):
    """Second step: every window of a hot minimiser but the first of its equals loses its place."""
    first: dict[bytes, tuple[int, int, int]] = {}
    for batch in batches:
        lost = []
        for packed in batch.column("packed").to_pylist():
            windows, columns = S.unpack(packed)
            for w, place in zip(windows, zip(*(c.tolist() for c in columns))):
                held = first.setdefault(w, place)
                if place > held:
                    lost.append((place[0], place[2], place[1], 1))
                elif place < held:
                    first[w] = place
                    lost.append((held[0], held[2], held[1], 1))
        if lost:
            yield _found(np.array(lost, dtype=np.int64).T)


def repeated_strings(docs: DataFrame, n: int, size: int = 100, hot: int = HOT) -> DataFrame:
    """``docs`` (id, text, th): runs (id, th, start, n) of windows that also start at an earlier place. ``n`` shards."""
    dealt = docs.mapInArrow(_partition(size, n), _FOUND).repartitionById(n, F.coalesce("shard", F.pmod(F.xxhash64("id", "start"), F.lit(n)).cast("int")))
    found = stored(dealt.mapInArrow(_pass_on(_scan(size, n, hot)), _FOUND), "suffix-matches")
    second = found.where("shard is not null").repartitionById(n, F.col("shard")).mapInArrow(_first_windows, _FOUND)
    return found.where("shard is null").union(second).select("id", "th", "start", "n")


def _pass_on(scan):
    """Losses already found on the way pass; packed strings go to the scan."""

    def run(batches):
        passed: list[pa.RecordBatch] = []

        def strings():
            for batch in batches:
                found = pc.is_null(batch.column("packed"))
                passed.append(batch.filter(found))
                yield batch.filter(pc.invert(found))

        for out in scan(strings()):
            while passed:
                yield passed.pop()
            yield out
        yield from passed

    return run


def _cut(size: int):
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            ids, texts, cuts = (batch.column(c) for c in ("id", "text", "cuts"))
            lengths = pc.binary_length(texts).to_pylist()
            for b, e in by_bytes(lengths, S.PACK_BYTES):
                rows = []
                for i in range(b, e):
                    data = texts[i].as_py().encode()
                    kept, removed, spans, at = [], 0, 0, 0
                    for s, n in sorted((c["start"], c["n"]) for c in cuts[i].as_py()) if cuts[i].is_valid else ():
                        end = s + n + size - 1
                        if end <= at:
                            continue
                        if s > at or not spans:
                            kept.append(data[at:s])
                            spans += 1
                            removed += end - s
                        else:
                            removed += end - at
                        at = end
                    kept.append(data[at:])
                    rows.append((len(data), removed, spans, b"".join(kept)))
                yield pa.record_batch([ids[b:e], *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:]))],
                                      schema=schema)

    return run


def remove_repeated_strings(docs: DataFrame, size: int = 100, hot: int = HOT, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes left) of every row."""
    base = told_apart(id_and_text(docs, id_col, text_col))
    n = partitions_for(docs, 6 << 20)  # of the input as read: a join has no usable size estimate
    runs = (repeated_strings(base, n, size, hot).groupBy("id", "th")
            .agg(F.collect_list(F.struct("start", "n")).alias("cuts")))
    out = base.join(runs, ["id", "th"], "left").select("id", "text", "cuts").mapInArrow(
        _cut(size), "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(public_id().alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
