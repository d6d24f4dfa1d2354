"""SimHash near-duplicates with keys from a perfect error-correcting code.

**Fingerprints.** Lower-case A-Z, words split at ASCII white space, shingles of ``k`` words (a shorter text is
one shingle of all its words, an empty one has fingerprint zero). Each shingle, repeats included, votes with
its XXH64 (seed 42); a bit is set where more than half of the hashes have it.

**Keys.** The 64 bits are three segments of 22, 21 and 21 bits, read as words of the binary Golay code of
length 23. That code is perfect: each word lies within 3 bits of exactly one codeword; a word at distance 3
lies at distance 4 from five more. If two fingerprints differ in at most 3 bits, the errors of some two
segments are at most 1 each (the largest of three errors sums takes the rest). If two words differ in one bit,
the codeword nearest to the first is within 4 bits of the second. So each fingerprint is *filed* under the
nearest codewords of each pair of segments (3 keys of 24 bits) and *looked up* under all codewords within 4
bits (about 85 keys), and every pair within 3 bits meets. Candidates are then compared bit by bit.

**Scale.** Equal fingerprints are collapsed first (grouped, combined before the shuffle), so exact copies cost
one row. Keys travel packed by shard. A bucket emits a forest of links, not its pairs; a bucket with more
than ``HOT_PAIRS`` comparisons leaves its task as pairs of blocks, which are dealt out and compared in a second
step. Components come from ``components``.

Defined results: null or empty texts have fingerprint zero and are linked like any other; rows with the same id
are one document; a null id is a document whose component counts as the smallest (null); an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm._common import ABSENT_ID, id_and_text, partitions_for, public_id, shuffle_partitions, stored
from lakestrata.llm.components import components

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
PAIRS = ((0, 1), (0, 2), (1, 2))
MAX_BITS = 3
GOLAY = 0b101011100011  # fixed value: generator polynomial of the code of length 23
HOT_PAIRS = 1 << 24
BLOCK = 1 << 12
VOTE_ROWS = 1 << 15


def fingerprint(text: str, k: int = 3) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= k:
        return xxh64_intdigest(joined, SEED)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends[: n - k])]
    hashes = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1:])], dtype=np.uint64)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), VOTE_ROWS):
        rows = hashes[at: at + VOTE_ROWS].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint's bits as a signed long. With ``hashed``, ``th`` is the text's hash."""
    names = ["id", "th"] if hashed else ["id"]

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), k) for t in batch.column("text")], dtype=np.uint64)
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(fps.view(np.int64))], names=[*names, "fp"])

    base = id_and_text(docs, id_col, text_col)
    return (base.withColumn("th", F.xxhash64("text")) if hashed else base).mapInArrow(
        run, "".join(f"{c} long, " for c in names) + "fp long")


@lru_cache(maxsize=1)
def _code():
    """Remainders of all 23-bit words' halves, the error pattern of each remainder, and for each remainder the
    codewords (besides zero) within 4 bits of its error pattern, padded with zero."""
    def remainder(x):
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        return x

    low = np.array([remainder(x) for x in range(1 << 12)], dtype=np.int64)
    high = np.array([remainder(x << 12) for x in range(1 << 11)], dtype=np.int64)
    leader = np.zeros(1 << 11, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            leader[low[e & 4095] ^ high[e >> 12]] = e
    sevens = [c for m in range(1 << 12) if (c := (m << 11) ^ remainder(m << 11)).bit_count() == 7]
    near = np.zeros((1 << 11, 6), dtype=np.int64)
    for s, e in enumerate(leader.tolist()):
        if e.bit_count() == 3:
            near[s, 1:] = [c for c in sevens if c & e == e]
    return low, high, leader, near


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: the 12-bit index of the nearest codeword, and those of all codewords within 4 bits
    (six columns; a word closer than 3 bits repeats its only one)."""
    low, high, leader, near = _code()
    s = low[words & 4095] ^ high[words >> 12]
    c = words ^ leader[s]
    return c >> 11, (c[:, None] ^ near[s]) >> 11


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys to file under (and whose), and keys to look up (and whose): the pair of segments above 24 bits."""
    found = [codewords(((fps >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64))
             for at, width in SEGMENTS]
    own = np.arange(len(fps))
    file_keys = np.concatenate([p << 24 | found[i][0] << 12 | found[j][0] for p, (i, j) in enumerate(PAIRS)])
    look, whose = [], []
    for p, (i, j) in enumerate(PAIRS):
        one, two = found[i][1], found[j][1]
        single_one = one[:, 1] == one[:, 0]
        single_two = two[:, 1] == two[:, 0]
        for a in range(6):
            for b in range(6):
                rows = own[~((a > 0) & single_one) & ~((b > 0) & single_two)]
                look.append(p << 24 | one[rows, a] << 12 | two[rows, b])
                whose.append(rows)
    return file_keys, np.tile(own, len(PAIRS)), np.concatenate(look), np.concatenate(whose)


class Forest:
    """Links reduced to a spanning forest, by union-find over a task's nodes."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        p = self.parent
        root = x
        while (up := p.get(root, root)) != root:
            root = up
        while (up := p.get(x, x)) != root:
            p[x], x = root, up
        return root

    def link(self, a, b) -> None:
        for x, y in zip(a, b):
            rx, ry = self.find(x), self.find(y)
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)

    def links(self) -> tuple[list[int], list[int]]:
        a = [x for x in self.parent if self.parent[x] != x]
        return a, [self.find(x) for x in a]


def _close(f: np.ndarray, g: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(f ^ g) <= bits


def link_block(ff, fi, gf, gi, bits: int, forest: Forest) -> None:
    """Link every filed fingerprint with the looked-up ones near it, each node being expanded only once: a
    search through the two-sided graph, so a dense bucket costs about one pass."""
    left, right = np.arange(len(ff)), np.arange(len(gf))
    while len(left) and len(right):
        todo = [(True, int(left[0]))]
        left = left[1:]
        while todo:
            filed, x = todo.pop()
            if filed:
                hit = _close(ff[x], gf[right], bits)
                new, right = right[hit], right[~hit]
                forest.link([int(fi[x])] * len(new), gi[new].tolist())
            else:
                hit = _close(gf[x], ff[left], bits)
                new, left = left[hit], left[~hit]
                forest.link([int(gi[x])] * len(new), fi[new].tolist())
            todo += [(not filed, int(y)) for y in new]


_SHARD = "shard int, filed boolean, keys binary, fps binary, ids binary"
_LINKS = "a long, b long, filed_fps binary, filed_ids binary, look_fps binary, look_ids binary"
_LINK_NAMES = ["a", "b", "filed_fps", "filed_ids", "look_fps", "look_ids"]


def _pack_keys(n_shards: int):
    """Batches of (id, fp) to rows of packed keys, one for each shard and side."""

    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(ids), 1 << 13):
                i, f = ids[at: at + (1 << 13)], fps[at: at + (1 << 13)]
                fk, fo, lk, lo = keys(f)
                for filed, k, o in ((True, fk, fo), (False, lk, lo)):
                    shard = (k * 0x9E3779B1 >> 7) % n_shards
                    order = np.argsort(shard, kind="stable")
                    cut = np.searchsorted(shard[order], np.arange(n_shards + 1))
                    rows = [(s, order[cut[s]: cut[s + 1]]) for s in range(n_shards) if cut[s + 1] > cut[s]]
                    yield pa.record_batch([
                        pa.array([s for s, _ in rows], pa.int32()), pa.array([filed] * len(rows), pa.bool_()),
                        pa.array([k[r].astype(np.int64).tobytes() for _, r in rows], pa.binary()),
                        pa.array([f[o[r]].tobytes() for _, r in rows], pa.binary()),
                        pa.array([i[o[r]].tobytes() for _, r in rows], pa.binary())],
                        names=["shard", "filed", "keys", "fps", "ids"])

    return run


def _sides(batches):
    """All rows of a task, joined and sorted by key: filed, then looked up."""
    parts = {True: ([], [], []), False: ([], [], [])}
    for batch in batches:
        for filed, k, f, i in zip(*(batch.column(c).to_pylist() for c in ("filed", "keys", "fps", "ids"))):
            for part, data, kind in zip(parts[filed], (k, f, i), (np.int64, np.uint64, np.int64)):
                part.append(np.frombuffer(data, dtype=kind))
    for filed in (True, False):
        k, f, i = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts[filed])
        order = np.argsort(k, kind="stable")
        yield k[order], f[order].view(np.uint64), i[order]


def _match(bits: int):
    """Packed keys of some shards to links, and pairs of blocks of hot buckets."""

    def run(batches):
        (fk, ff, fi), (lk, lf, li) = _sides(batches)
        forest, blocks = Forest(), []
        bucket, first, count = np.unique(fk, return_index=True, return_counts=True)
        begin, end = np.searchsorted(lk, bucket), np.searchsorted(lk, bucket, side="right")
        pairs = count * (end - begin)
        small = np.flatnonzero((pairs > 0) & (pairs <= 1024))
        at = 0
        while at < len(small):  # expand the small buckets together, at most about a million pairs at a time
            upto = max(at + 1, int(np.searchsorted(np.cumsum(pairs[small[at:]]), 1 << 20)) + at)
            b = small[at:upto]
            n, width = pairs[b], (end - begin)[b]
            owner = np.repeat(np.arange(len(b)), n)
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x = first[b][owner] + within // width[owner]
            y = begin[b][owner] + within % width[owner]
            good = _close(ff[x], lf[y], bits) & (fi[x] != li[y])
            forest.link(fi[x[good]].tolist(), li[y[good]].tolist())
            at = upto
        for b in np.flatnonzero(pairs > 1024):
            fs, ls = slice(first[b], first[b] + count[b]), slice(begin[b], end[b])
            if pairs[b] <= HOT_PAIRS:
                link_block(ff[fs], fi[fs], lf[ls], li[ls], bits, forest)
                continue
            for x in range(fs.start, fs.stop, BLOCK):
                for y in range(ls.start, ls.stop, BLOCK):
                    xs, ys = slice(x, min(x + BLOCK, fs.stop)), slice(y, min(y + BLOCK, ls.stop))
                    blocks.append([ff[xs].tobytes(), fi[xs].tobytes(), lf[ys].tobytes(), li[ys].tobytes()])
                    if len(blocks) >= 64:
                        yield _link_rows([], [], blocks)
                        blocks = []
        yield _link_rows(*forest.links(), blocks)

    return run


def _link_rows(a, b, blocks) -> pa.RecordBatch:
    columns = [pa.array(a + [None] * len(blocks), pa.int64()), pa.array(b + [None] * len(blocks), pa.int64())]
    for c in range(4):
        columns.append(pa.array([None] * len(a) + [x[c] for x in blocks], pa.binary()))
    return pa.record_batch(columns, names=_LINK_NAMES)


def _match_blocks(bits: int):
    def run(batches):
        for batch in batches:
            forest = Forest()
            for row in zip(*(batch.column(c).to_pylist() for c in _LINK_NAMES[2:])):
                ff, fi, lf, li = (np.frombuffer(x, dtype=t) for x, t in zip(row, (np.uint64, np.int64) * 2))
                link_block(ff, fi, lf, li, bits, forest)
            a, b = forest.links()
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def fingerprint_links(nodes: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``nodes`` (id, fp) with distinct fp: links (a, b) that connect exactly what pairs within ``bits`` connect."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the keys guarantee distances up to {MAX_BITS}")
    spark = nodes.sparkSession
    n = partitions_for(nodes, 1 << 19)  # about 88 keys of 24 bytes for each 16-byte row
    packed = nodes.mapInArrow(_pack_keys(n), _SHARD).repartition(n, "shard")
    found = stored(packed.mapInArrow(_match(bits), _LINKS), "simhash-links")
    hot = (found.where("a is null").repartition(shuffle_partitions(spark))
           .mapInArrow(_match_blocks(bits), "a long, b long"))
    return found.where("a is not null").select("a", "b").union(hot)


def near_duplicates(docs: DataFrame, k: int = 3, bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id_col``, ``fp`` (signed long) and ``component_id`` for every row of ``docs``."""
    fps = stored(fingerprints(docs, k, id_col, text_col), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    same_id = fps.join(nodes.withColumnRenamed("id", "low"), "fp").where("id <> low").select(
        F.col("id").alias("a"), F.col("low").alias("b"))
    repeated = fps.groupBy("id").agg(F.min("fp").alias("f"), F.max("fp").alias("g")).where("f <> g").select("id")
    links = fingerprint_links(nodes, bits).union(same_id.join(repeated.withColumnRenamed("id", "a"), "a", "left_semi"))
    found = components(links)
    of_fp = nodes.join(found, F.col("id") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "id").alias("component_id"))
    return fps.join(of_fp, "fp").select(public_id().alias(id_col), "fp", public_id("component_id").alias("component_id"))


def keep_first(docs: DataFrame, k: int = 3, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (columns unchanged) that are the first document of their component, in the order of doc_id
    and text hash. Rows that share a doc_id are told apart by their texts; of those equal in both one stays. Rows
    without a doc_id all stay."""
    fps = stored(fingerprints(docs, k, hashed=True), "fingerprints")
    nodes = stored(fps.select("fp").distinct().select(F.col("fp").alias("id"), "fp"), "nodes")
    found = components(fingerprint_links(nodes, bits))
    of_fp = nodes.join(found, F.col("id") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("component"))
    first = F.min(F.struct("id", "th")).alias("first")
    firsts = fps.join(of_fp, "fp").groupBy("component").agg(first).where(F.col("first.id") != ABSENT_ID).select(
        F.col("first.id").alias("first_id"), F.col("first.th").alias("first_th"))
    same = (F.col("doc_id").cast("long") == F.col("first_id")) & (
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("first_th"))
    kept = docs.join(firsts, same).dropDuplicates(["first_id", "first_th"])
    return kept.select(*docs.columns).union(docs.where("doc_id is null"))
