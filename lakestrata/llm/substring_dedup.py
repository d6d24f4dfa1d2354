"""Repeated word windows (substring dedup) by super-k-mer partitioning.

A window is ``size`` consecutive words of one document. Consecutive windows with the same minimiser (a run of
``GRAM`` words) form a super-k-mer, packed as one string of its words; about three times the text travels,
compressed, instead of ``size`` times. Super-k-mers go to the bucket of their minimiser, equal ones collapsed
within each chunk first. In a bucket, equal super-k-mers are counted whole. Those that share a minimiser but
differ are cut into windows, which are sorted, and runs of equal windows counted. Everything is compared as
strings, so counts are exact.

A minimiser with more than ``HOT`` different super-k-mers leaves its bucket: its windows are dealt out again by
their own text, in a second step, so no task sorts an unbounded group.

Removed are all words covered by a window that starts in at least two places. Defined results: a null or empty
text has no words; documents shorter than a window lose nothing; repeated rows (same id and text) count as
separate places, so their windows are repeated; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import _superstrings as S
from lakestrata.llm._common import by_bytes, id_and_text, partitions_for, public_id, stored, told_apart

GRAM = 5
HOT = 20_000

_FOUND = "id long, th long, start long, n long, shard int, packed binary"
_FOUND_SCHEMA = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("n", pa.int64()),
                           ("shard", pa.int32()), ("packed", pa.binary())])


def pieces(words: list[bytes], size: int, limit: int):
    """(first word, words) parts of a long document; they overlap so that each window is in just one part."""
    if sum(map(len, words)) + len(words) <= limit:
        yield 0, words
        return
    begin = total = 0
    for i, w in enumerate(words):
        total += len(w) + 1
        if total > limit and i - begin >= 2 * size:
            yield begin, words[begin:i]
            begin = i - size + 1
            total = sum(map(len, words[begin: i + 1])) + size
    yield begin, words[begin:]


def super_kmers(parts: list[list[bytes]], size: int):
    """For parts (lists of words): part, first word, number of windows, minimiser and string of each run."""
    text = b"\n".join(b" ".join(p) for p in parts)
    data = np.frombuffer(text, dtype=np.uint8)
    ends = np.append(np.flatnonzero((data == 32) | (data == 10)), len(data))
    starts = np.append(0, ends[:-1] + 1)
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    real = ends > starts  # parts without words leave empty entries
    starts, ends = starts[real], ends[real]
    part = np.repeat(np.arange(len(parts)), counts)
    if len(starts) < size:
        return [], [], [], np.zeros(0, np.uint64), []
    with np.errstate(over="ignore"):
        one = S.run_hashes(data, starts, ends)
        grams = np.zeros(len(one) - GRAM + 1, dtype=np.uint64)
        for j in range(GRAM):
            grams = grams * np.uint64(0x2545F4914F6CDD1D) + one[j: len(one) - GRAM + 1 + j]
        grams = S.mix64(grams)
    valid = part[: len(part) - size + 1] == part[size - 1:]
    first, n, minimiser, _ = S.runs(grams, valid, size - GRAM + 1)
    strings = [text[b:e] for b, e in zip(starts[first].tolist(), ends[first + n + size - 2].tolist())]
    before = np.cumsum(counts) - counts
    return part[first], first - before[part[first]], n, minimiser, strings


def _partition(size: int, shards: int):
    def run(batches):
        for batch in batches:
            ids, hashes = batch.column("id").to_numpy(), batch.column("th").to_numpy()
            texts = batch.column("text")
            lengths = pc.binary_length(texts).to_pylist()
            for b, e in by_bytes(lengths, S.PACK_BYTES):
                owner, offset, parts = [], [], []
                for i in range(b, e):
                    words = texts[i].as_py().encode().split()
                    if len(words) >= size:
                        for at, part in pieces(words, size, S.CHUNK_BYTES):
                            owner.append(i)
                            offset.append(at)
                            parts.append(part)
                found = []
                for lo, hi in by_bytes([sum(map(len, p)) + len(p) for p in parts], S.CHUNK_BYTES):
                    part, first, _, minimiser, text = super_kmers(parts[lo:hi], size)
                    if len(text):
                        row = np.array(owner[lo:hi])[part]
                        found.append((text, ids[row], hashes[row], first + np.array(offset[lo:hi])[part], minimiser))
                if not found:
                    continue
                strings = [x for f in found for x in f[0]]
                i, h, first, minimiser = (np.concatenate(c) for c in list(zip(*found))[1:])
                out = []
                for shard, rows in S.grouped(S.shard_of(minimiser, shards)):
                    different, which = S.distinct([strings[r] for r in rows.tolist()])
                    lead = np.zeros(len(different), dtype=np.int64)
                    lead[which] = minimiser[rows].astype(np.int64)
                    out.append((shard, S.pack(different, lead, which, i[rows], h[rows], first[rows])))
                yield pa.record_batch([pa.array([s for s, _ in out], pa.int32()),
                                       pa.array([p for _, p in out], pa.binary())], names=["shard", "packed"])

    return run


def _windows(string: bytes, size: int) -> list[bytes]:
    """Every window of a super-k-mer."""
    lengths = [len(w) for w in string.split(b" ")]
    ends = list(accumulate(lengths, lambda a, b: a + b + 1))
    return [string[e - n: f] for e, n, f in zip(ends, lengths, ends[size - 1:])]


class Bucket:
    """The super-k-mers of a task, row by row. Only different strings are kept, each with its first place: when a
    string comes again, its places are repeated and go out at once."""

    def __init__(self, size: int, shards: int, hot: int):
        self.size, self.shards, self.hot = size, shards, hot
        self.place: dict[bytes, tuple[int, int, int] | None] = {}  # None: known to be repeated, its places are out
        self.of_lead: dict[int, list[bytes]] = {}
        self.hot_leads: set[int] = set()

    def add(self, packed: bytes):
        """Take one packed row; yields what it settles."""
        strings, (lead, which, ids, hashes, first) = S.unpack(packed)
        times = np.bincount(which, minlength=len(strings))
        again, out, dealt = times >= 2, [], []
        where = np.empty(len(strings), dtype=np.int64)
        where[which] = np.arange(len(which))
        for at, (s, m, n) in enumerate(zip(strings, lead.tolist(), times.tolist())):
            here = None if n > 1 else (int(ids[where[at]]), int(hashes[where[at]]), int(first[where[at]]))
            if m in self.hot_leads:
                dealt.append((s, here))
            elif s in self.place:
                again[at] = True
                if self.place[s] is not None:
                    out.append((s, self.place[s]))
                    self.place[s] = None
            else:
                self.place[s] = here
                group = self.of_lead.setdefault(m, [])
                group.append(s)
                if len(group) > self.hot:  # the group leaves; what comes later follows it
                    self.hot_leads.add(m)
                    dealt += [(x, self.place.pop(x)) for x in self.of_lead.pop(m)]
        yield from self._whole([(strings[w], (i, h, f)) for w, i, h, f in zip(
            which[again[which]].tolist(), ids[again[which]].tolist(), hashes[again[which]].tolist(), first[again[which]].tolist())] + out)
        yield from self._deal(dealt)

    def _whole(self, repeated):
        """All windows of these (string, place) are repeated."""
        if repeated:
            i, h, f = zip(*(p for _, p in repeated))
            yield _found([i, h, f, [s.count(b" ") + 2 - self.size for s, _ in repeated]])

    def _deal(self, dealt):
        for at in range(0, len(dealt), 4096):
            yield _deal_windows(dealt[at: at + 4096], self.size, self.shards)

    def finish(self):
        """Count the windows of strings that share a minimiser but differ."""
        for group in self.of_lead.values():
            if len(group) < 2 or all(self.place[s] is None for s in group):
                continue
            windows, owner, offset = [], [], []
            for s in group:
                cut = _windows(s, self.size)
                windows += cut
                owner += [s] * len(cut)
                offset += range(len(cut))
            order = sorted(range(len(windows)), key=windows.__getitem__)
            hit = {x for a, b in zip(order, order[1:]) if windows[a] == windows[b] for x in (a, b)}
            rows = [(*self.place[owner[x]][:2], self.place[owner[x]][2] + offset[x], 1) for x in sorted(hit)
                    if self.place[owner[x]] is not None]
            if rows:
                yield _found(list(zip(*rows)))


def _found(columns=(), shard=(), packed=()) -> pa.RecordBatch:
    n, m = len(columns[0]) if len(columns) else 0, len(shard)
    arrays = [pa.concat_arrays([pa.array(columns[c] if n else [], pa.int64()), pa.nulls(m, pa.int64())]) for c in range(4)]
    return pa.record_batch([*arrays, pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(shard, pa.int32())]),
                            pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(packed, pa.binary())])],
                           schema=_FOUND_SCHEMA)


def _count(size: int, shards: int, hot: int):
    """Buckets to repeated runs (id, th, first word, number of windows) and packed windows of hot minimisers."""

    def run(batches):
        bucket = Bucket(size, shards, hot)
        for batch in batches:
            for packed in batch.column("packed"):
                yield from bucket.add(packed.as_py())
        yield from bucket.finish()

    return run


def _deal_windows(dealt, size: int, shards: int) -> pa.RecordBatch:
    """The windows of super-k-mers of hot minimisers, packed by a hash of their own text. Those of a super-k-mer that
    is repeated as a whole travel without places: its places are out already."""
    from xxhash import xxh64_intdigest

    windows, known, where = [], [], []
    for s, place in dealt:
        cut = _windows(s, size)
        windows += cut
        known += [place is None] * len(cut)
        i, h, f = place or (0, 0, 0)
        where += [(i, h, f + j) for j in range(len(cut))]
    where = np.array(where, dtype=np.int64).reshape(-1, 3)
    known = np.array(known)
    shard = np.fromiter((xxh64_intdigest(w) % shards for w in windows), np.int64, len(windows))
    out = []
    for s, rows in S.grouped(shard):
        w = where[rows]
        out.append((s, S.pack([windows[r] for r in rows.tolist()], known[rows], w[:, 0], w[:, 1], w[:, 2])))
    return _found((), [s for s, _ in out], [p for _, p in out])


def _count_windows(batches):
    """Second step: windows of hot minimisers, each at the task of its own text."""
    first: dict[bytes, int] = {}
    which, known, places = [], [], []
    for batch in batches:
        for packed in batch.column("packed").to_pylist():
            windows, (k, i, h, f) = S.unpack(packed)
            which.append(np.fromiter((first.setdefault(w, len(first)) for w in windows), np.int64, len(windows)))
            known.append(k)
            places.append(np.stack([i, h, f]))
    if not which:
        return
    which, known, places = np.concatenate(which), np.concatenate(known), np.concatenate(places, axis=1)
    times = np.bincount(which, weights=1 + known)
    hit = (times[which] >= 2) & (known == 0)
    yield _found([*places[:, hit], np.ones(int(hit.sum()), np.int64)])


def repeated_runs(docs: DataFrame, n: int, size: int = 35, hot: int = HOT) -> DataFrame:
    """``docs`` (id, text, th): runs (id, th, start, n) of windows that start in at least two places. ``n`` shards."""
    packed = docs.mapInArrow(_partition(size, n), "shard int, packed binary").repartitionById(n, F.col("shard"))
    found = stored(packed.mapInArrow(_count(size, n, hot), _FOUND), "super-kmers")
    second = found.where("shard is not null").repartitionById(n, F.col("shard")).mapInArrow(_count_windows, _FOUND)
    return found.where("shard is null").union(second).select("id", "th", "start", "n")


def _cut(size: int):
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches):
        for batch in batches:
            ids, texts, cuts = (batch.column(c) for c in ("id", "text", "cuts"))
            lengths = pc.binary_length(texts).to_pylist()
            for b, e in by_bytes(lengths, S.PACK_BYTES):
                rows = []
                for i in range(b, e):
                    words = texts[i].as_py().encode().split()
                    kept = words
                    if cuts[i].is_valid:
                        edge = np.zeros(len(words) + 1, dtype=np.int64)
                        for c in cuts[i].as_py():
                            edge[c["start"]] += 1
                            edge[c["start"] + c["n"] + size - 1] -= 1
                        keep = np.cumsum(edge[:-1]) == 0
                        kept = [w for w, k in zip(words, keep.tolist()) if k]
                    rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
                yield pa.record_batch([ids[b:e], *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:]))],
                                      schema=schema)

    return run


def remove_repeated_windows(docs: DataFrame, size: int = 35, hot: int = HOT, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by one space) of every row."""
    base = told_apart(id_and_text(docs, id_col, text_col))
    n = partitions_for(docs, 8 << 20)  # of the input as read: a join has no usable size estimate
    runs = (repeated_runs(base, n, size, hot).groupBy("id", "th")
            .agg(F.collect_list(F.struct("start", "n")).alias("cuts")))
    out = base.join(runs, ["id", "th"], "left").select("id", "text", "cuts").mapInArrow(
        _cut(size), "id long, n_words long, n_removed long, kept string")
    return out.select(public_id().alias(id_col), "n_words", "n_removed", "kept")
