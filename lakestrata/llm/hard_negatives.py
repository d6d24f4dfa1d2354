"""Hard-negative mining with anchor-clustered shared lists (MAXIMUS-style).

**Question.** An anchor's positives are its best rows of the same label. For each positive of score P the hard negatives are
the best rows of other labels whose score is between ``low`` and ``high`` percent of P: similar, but not so similar that
they may be unlabelled positives. Scores are integer inner products of floor(scale * x).

**Lists.** Anchors are clustered by direction (spherical k-means, centres fitted on a bounded sample). Let t be the largest
angle between a cluster's centre and a member. A row x at angle a from the centre scores at most |u| |x| cos(max(0, a - t))
with any member u. So a cluster sorts its candidates by |x| cos(max(0, a - t)) once, and every member walks that one list
from the top. A member is done when the bound of the rest, times its own norm, is below what it needs: the k-th score it
has, or the lowest score that counts. Members walk together in bounded batches, one matrix product a stretch of the list.

**On Spark.** Rows are dealt by direction into regions (nearest of a bounded number of centres) and hot regions by
hash, so a shard has about ``ROWS_EACH`` rows. A shard's part of a list is sorted where the shard is. Anchors travel, rows
stay: an anchor first visits one shard of its own region, which gives it a certified floor, and then all shards whose
region can hold something as good. A shard is copied only for every ``ANCHORS_EACH`` anchors that visit it. Positives are
found first, then negatives, both by the same walk; the best of each shard are merged by a ranked window.

Of equal vectors of one label only the smallest ids can be in a result, so only ``max(positives + 1, negatives)`` of
them are searched: a vector that a third of all rows share is no hot group.

Defined results: rows with a null id, null label, null vector, or null or non-finite components take no part; shorter vectors
count as padded with zeros, empty ones score 0; rows with an anchor's own id are never its positives; repeated rows (same
id, label and vector) count each; anchors that are repeated rows count once; fewer rows than asked give all; a positive of
negative score has no negatives (no score is between 50 and 95 percent of it); empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm._common import stored
from lakestrata.llm.metric_search import matrix

ROWS_EACH = 16384
MAX_REGIONS = 512
ANCHORS_EACH = 65_536
ANCHORS_A_CLUSTER = 64
MAX_CLUSTERS = 1024
SAMPLE_A_CENTRE = 16
SAMPLE_NUMBERS = 1 << 21  # components of all sampled vectors together
BATCH = 512  # members that walk a list together
SLACK = 1e-7  # radians, for rounding
LARGE = 1 << 62


def norms(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64, copy=False)
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angles of all rows to all unit centres; a zero vector is at no angle to anything."""
    n = norms(x)[:, None]
    cosine = (x.astype(np.float64, copy=False) @ centres.T) / np.where(n > 0, n, 1.0)
    return np.where(n > 0, np.arccos(np.clip(cosine, -1.0, 1.0)), 0.0)


def centres_of(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of at most ``k`` clusters of directions (spherical k-means)."""
    n = norms(sample)
    units = np.unique(sample[n > 0] / n[n > 0, None], axis=0)
    if not len(units):
        return np.eye(1, sample.shape[1])
    centres = units[np.linspace(0, len(units) - 1, min(k, len(units))).astype(int)]
    for _ in range(rounds):
        near = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        length = norms(sums)
        centres = np.where(length[:, None] > 1e-12, sums / np.maximum(length, 1e-12)[:, None], centres)
    return centres


def walk(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, centre: np.ndarray, u: np.ndarray, own: np.ndarray, label: np.ndarray,
         asks: tuple[np.ndarray, np.ndarray, np.ndarray], same: bool, k: int):
    """Members ``u`` (ids ``own``, labels ``label``) of one cluster walk the cluster's list of rows ``x``.

    ``asks`` = (member, cap, floor) of every question: the ``k`` best rows with floor <= score <= cap whose label equals the
    member's (``same``) or differs. Yields (questions, rows, scores) in batches.
    """
    far, size = angles(x, centre[None])[:, 0], norms(x)
    reach = float(angles(u, centre[None]).max()) + SLACK
    bound = size * np.cos(np.maximum(0.0, far - reach))
    order = np.argsort(-bound, kind="stable")  # the shared list
    bound = np.append(bound[order], -np.inf)
    length = norms(u)
    exact = float(size.max(initial=0.0)) * float(length.max(initial=0.0)) < 2.0 ** 52
    kind = np.float64 if exact else np.int64
    listed, listed_ids, listed_labels = x[order].astype(kind), ids[order], labels[order]
    slack = 1e-9 * length * float(size.max(initial=0.0)) + 1e-6
    member, cap, floor = asks
    for begin in range(0, len(u), BATCH):
        at_most = min(begin + BATCH, len(u))
        q = np.flatnonzero((member >= begin) & (member < at_most))
        if not len(q):
            continue
        need = floor[q].copy()
        got = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))  # question (in q), row of the list, score
        at, step = 0, 64
        while at < len(listed):
            active = np.flatnonzero(length[member[q]] * bound[at] + slack[member[q]] >= need)
            if not len(active):
                break  # certified: nothing further down can count
            who, place = np.unique(member[q[active]], return_inverse=True)
            scores = (u[who].astype(kind) @ listed[at: at + step].T)[place]
            fits = (scores >= need[active, None]) & (scores <= cap[q[active], None])
            rows_label, rows_id = listed_labels[at: at + step], listed_ids[at: at + step]
            fits &= (rows_label[None] == label[member[q[active]], None]) == same
            if same:
                fits &= rows_id[None] != own[member[q[active]], None]
            asked, row = np.nonzero(fits)
            if len(asked):
                got = tuple(np.concatenate(p) for p in zip(got, (active[asked], row + at, scores[asked, row].astype(np.int64))))
                best = np.lexsort((listed_ids[got[1]], -got[2], got[0]))
                of = got[0][best]
                first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                nth = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
                got = tuple(p[best[nth < k]] for p in got)
                full = nth == k - 1  # these questions have k rows: only as good a score still counts
                need[of[full]] = np.maximum(need[of[full]], got[2][np.cumsum(nth < k)[full] - 1])
            at += step
            step = min(2 * step, 2048)
        yield q[got[0]], order[got[1]], got[2]


_FOUND = pa.schema([("id", pa.int64()), ("ah", pa.int64()), ("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
                    ("copies", pa.int32())])
FOUND = "id long, ah long, q long, vec_id long, score long, copies int"


def _visit(dim: int, centres: np.ndarray, same: bool, k: int):
    """The anchors that visit a shard, cluster by cluster."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [_FOUND.empty_table()]
        if rows.num_rows and anchors.num_rows:
            x, ids = matrix(rows["v"], dim), rows["id"].to_numpy()
            copies = rows["copies"].to_numpy()
            names = np.concatenate([rows["label"].to_numpy(zero_copy_only=False), anchors["label"].to_numpy(zero_copy_only=False)])
            codes = np.unique(names.astype(str), return_inverse=True)[1]
            x_label, u_label = codes[: len(ids)], codes[len(ids):]
            u, own, ah = matrix(anchors["v"], dim), anchors["id"].to_numpy(), anchors["ah"].to_numpy()
            cluster = anchors["cluster"].to_numpy()
            asks = anchors["asks"].combine_chunks()
            asks_of = np.repeat(np.arange(len(u)), np.diff(asks.offsets.to_numpy()))
            q, cap, floor = (asks.flatten().field(f).to_numpy() for f in ("q", "cap", "floor"))
            part = cluster if not same else cluster.astype(np.int64) * (codes.max() + 1) + u_label
            for p in np.unique(part):  # with ``same``, a cluster has one list a label
                who = np.flatnonzero(part == p)
                here = np.flatnonzero(x_label == u_label[who[0]]) if same else np.arange(len(ids))
                ask = np.flatnonzero(np.isin(asks_of, who))
                if not len(here) or not len(ask):
                    continue
                member = np.searchsorted(who, asks_of[ask])
                for a, row, score in walk(x[here], ids[here], x_label[here], centres[cluster[who[0]]], u[who], own[who],
                                          u_label[who], (member, cap[ask], floor[ask]), same, k):
                    a, row = ask[a], here[row]
                    columns = (own[asks_of[a]], ah[asks_of[a]], q[a], ids[row], score, copies[row])
                    out.append(pa.table([pa.array(c) for c in columns], schema=_FOUND))
        return pa.concat_tables(out)

    return run


def _place(centres: np.ndarray, dim: int, column: str, angle: bool):
    """The nearest centre of every row, as ``column``; with ``angle`` also the angle to it and the norm."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("v"), dim)
                a = angles(x, centres)
                near = a.argmin(axis=1)
                extra = [pa.array(a[np.arange(len(near)), near]), pa.array(norms(x))] if angle else []
                yield pa.record_batch([*batch.columns, pa.array(near.astype(np.int32)), *extra],
                                      names=[*batch.schema.names, column, *(["angle", "norm"] if angle else [])])

    return run


def _route(centres: np.ndarray, reach: np.ndarray, longest: np.ndarray, pieces: np.ndarray, dim: int):
    """Send every anchor to the shards of the regions that may hold a row it needs."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            u = matrix(batch.column("v"), dim)
            length = norms(u)[:, None]
            gap = np.maximum(0.0, angles(u, centres) - reach[None] - SLACK)
            most = length * longest[None] * np.maximum(0.0, np.cos(gap))
            asks = batch.column("asks")
            need = np.minimum.reduceat(asks.flatten().field("floor").to_numpy(), asks.offsets.to_numpy()[:-1] - asks.offsets[0].as_py())
            row, region = np.nonzero((most * (1 + 1e-9) + 1e-6 >= need[:, None]) & (pieces > 0)[None])
            row, region = np.repeat(row, pieces[region]), np.repeat(region, pieces[region])
            if len(row):
                new = np.append(True, (np.diff(row) != 0) | (np.diff(region) != 0))
                piece = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
                yield pa.record_batch([*(c.take(pa.array(row)) for c in batch.columns), pa.array(region.astype(np.int32)),
                                       pa.array(piece.astype(np.int32))], names=[*batch.schema.names, "region", "piece"])

    return run


def _ddl(df: DataFrame, more: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", " + more


def _sample(df: DataFrame, k: int, dim: int) -> np.ndarray:
    """Bounded: at most 16 rows a centre, and 2^21 numbers in all."""
    rows = max(1, min(SAMPLE_A_CENTRE * k, SAMPLE_NUMBERS // dim))
    return matrix(df.orderBy(F.xxhash64("id", "v"), "id").limit(rows).select("v").toArrow()["v"], dim)


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k)


def _each_copy(found: DataFrame, k: int) -> DataFrame:
    """One row a repeated row, the first ``k`` of every question, ranked."""
    return _best(found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))), k, "id", "ah", "q")


class Shards:
    """The rows, dealt into shards by direction; anchors visit them."""

    def __init__(self, rows: DataFrame, n: int, dim: int):
        regions = min(MAX_REGIONS, -(-n // ROWS_EACH))
        self.dim, self.centres = dim, centres_of(_sample(rows, regions, dim), regions)
        placed = stored(rows.mapInArrow(_place(self.centres, dim, "region", True), _ddl(rows, "region int, angle double, norm double")),
                        "regions")
        stats = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("a"), F.max("norm").alias("m")).collect()
        k = len(self.centres)  # one row a region
        self.reach, self.longest, self.pieces = np.zeros(k), np.zeros(k), np.zeros(k, dtype=np.int64)
        for s in stats:
            self.reach[s["region"]], self.longest[s["region"]], self.pieces[s["region"]] = s["a"], s["m"], -(-s["n"] // ROWS_EACH)
        self.placed = placed.withColumn("piece", self.piece_of("id")).drop("angle", "norm")

    def piece_of(self, key: str) -> Column:
        pieces = F.element_at(F.array(*(F.lit(int(max(1, p))) for p in self.pieces)), F.col("region") + 1)
        return F.pmod(F.xxhash64(key), pieces).cast("int")

    def visited(self, anchors: DataFrame, visits: DataFrame, clusters: np.ndarray, same: bool, k: int) -> DataFrame:
        """What ``visits`` (anchors with region and piece) find; a shard has a copy for every ANCHORS_EACH visitors."""
        visits = stored(visits, "visits")
        busy = (visits.groupBy("region", "piece").agg(F.ceil(F.count(F.lit(1)) / F.lit(ANCHORS_EACH)).cast("int").alias("groups")))
        shards = self.placed.join(busy, ["region", "piece"]).withColumn("g", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        visits = visits.join(busy, ["region", "piece"]).withColumn("g", F.pmod(F.xxhash64("id", "ah"), "groups").cast("int"))
        key = ["region", "piece", "g"]
        return (shards.select(*key, "id", "label", "v", "copies").groupBy(*key)
                .cogroup(visits.select(*key, "id", "ah", "label", "v", "cluster", "asks").groupBy(*key))
                .applyInArrow(_visit(self.dim, clusters, same, k), FOUND))

    def search(self, anchors: DataFrame, clusters: np.ndarray, same: bool, k: int) -> DataFrame:
        """The ``k`` best rows of every question: first at home, then wherever something as good may be."""
        home = anchors.mapInArrow(_place(self.centres, self.dim, "region", False), _ddl(anchors, "region int"))
        at_home = self.visited(anchors, home.withColumn("piece", self.piece_of("ah")), clusters, same, k)
        kth = _best(at_home, k, "id", "ah", "q").where(F.col("nth") == k).select("id", "ah", "q", "score")
        known = kth.groupBy("id", "ah").agg(F.map_from_entries(F.collect_list(F.struct("q", "score"))).alias("kth"))
        raised = F.transform("asks", lambda a: F.struct(
            a["q"].alias("q"), a["cap"].alias("cap"), F.greatest(a["floor"], F.coalesce(F.col("kth")[a["q"]], a["floor"])).alias("floor")))
        ready = anchors.join(known, ["id", "ah"], "left").withColumn("asks", raised).drop("kth")
        routed = ready.mapInArrow(_route(self.centres, self.reach, self.longest, self.pieces, self.dim),
                                  _ddl(ready, "region int, piece int"))
        return _best(self.visited(anchors, routed, clusters, same, k), k, "id", "ah", "q")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for the rows of ``vectors`` that are
    anchors (a condition on ``id``) and each of their ``positives`` best rows of the same label, the ``negatives`` best rows of
    other labels that score between ``low`` and ``high`` percent of the positive."""
    spark = vectors.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    base = stored(vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("v")), "vectors")
    n, dim = base.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    anchors = stored(base.where(is_anchor).distinct().withColumn("ah", F.xxhash64("label", "v")), "anchors")
    n_anchors = anchors.count()
    if not n or not n_anchors:
        return spark.createDataFrame([], result)
    dim = max(1, dim)
    alike = Window.partitionBy("v", "label").orderBy("id")
    most = max(positives, negatives)
    rows = (base.groupBy("id", "label", "v").agg(F.least(F.count(F.lit(1)), F.lit(most)).cast("int").alias("copies"))
            .withColumn("nth", F.row_number().over(alike)).where(F.col("nth") <= max(positives + 1, negatives)).drop("nth"))
    shards = Shards(rows, n, dim)
    k = min(MAX_CLUSTERS, -(-n_anchors // ANCHORS_A_CLUSTER))
    clusters = centres_of(_sample(anchors, k, dim), k)
    anchors = stored(anchors.mapInArrow(_place(clusters, dim, "cluster", False), _ddl(anchors, "cluster int")), "anchors")

    def ask(q, cap, floor) -> Column:
        return F.struct(q.alias("q"), cap.alias("cap"), floor.alias("floor"))

    anything = F.array(ask(F.lit(0).cast("long"), F.lit(LARGE), F.lit(-LARGE)))
    found = shards.search(anchors.withColumn("asks", anything), clusters, True, positives)
    positive = stored(_each_copy(found.drop("nth"), positives).select(
        "id", "ah", F.col("vec_id").alias("positive_id"), F.col("score").alias("p")), "positives")
    percent = lambda c, share: c.cast("decimal(38,0)") * F.lit(share) / F.lit(100)
    asked = (positive.select("id", "ah", "p").distinct()
             .withColumn("cap", F.floor(percent(F.col("p"), high)).cast("long"))
             .withColumn("floor", F.ceil(percent(F.col("p"), low)).cast("long")).where("floor <= cap")
             .groupBy("id", "ah").agg(F.collect_list(ask(F.col("p"), F.col("cap"), F.col("floor"))).alias("asks")))  # at most one a positive
    found = shards.search(anchors.join(asked, ["id", "ah"]), clusters, False, negatives)
    negative = _each_copy(found.drop("nth"), negatives).withColumnRenamed("q", "p")
    return (positive.join(negative, ["id", "ah", "p"])
            .select(F.col("id").alias("anchor_id"), "positive_id", F.col("nth").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    F.col("p").alias("positive_score"), F.col("score").alias("negative_score")))
