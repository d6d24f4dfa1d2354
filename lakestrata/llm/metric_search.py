"""Exact top-k inner-product search with M-trees, best first.

**Metric.** With M the largest squared norm, a row x becomes (x, sqrt(M - |x|^2)) and a query q becomes (q, 0).
Then the Euclidean distance is sqrt(|q|^2 + M - 2 q.x): the nearest rows are those with the largest inner
product. Components are integers, so scores are exact; distances only steer the search and get a small margin.

**Index.** A bounded sample of rows (``MAX_REGIONS`` at most, documented bound) are the pivots of the top
level; every row joins the region of its nearest pivot, and each region keeps its covering radius and number of
rows. A region of more than ``ROWS_EACH`` rows is split by hash into trees of about that size. A tree is an
M-tree of paged nodes: an entry has its vector, the distance to its parent's vector and, if it routes, a covering
radius and a child page. All rows are indexed.

**Search.** Each query first searches a tree of its own region; the k-th distance found bounds the rest. It then
visits just the trees whose region can hold something nearer: distance to the pivot less covering radius.
In a tree, pages wait in a queue ordered by their smallest possible distance. Entries are passed over without
computing a distance where |d(q, parent) - d(entry, parent)| less the covering radius exceeds the k-th
distance. Queries visit trees in blocks; the k best of each tree are merged by a ranked window.

Of equal vectors only the k+1 smallest different ids can ever be in a result (one may be the query's own), each at most
k times, so only those are indexed (rows counted by vector and id, then a ranked window limited before the shuffle): a
vector that a third of all rows share costs at most k (k+1) rows, k+1 where ids are unique.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter vectors count
as padded with zeros; rows with a null id take no part; repeated rows (same id) are candidates each; a query never
gets a row with its own id; fewer candidates than k give all; no candidates or an empty table give no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm._common import stored

MAX_REGIONS = 512
ROWS_EACH = 16384
PAGE = 1536
FANOUT = 16
QUERIES_EACH = 20_000
EXACT_FLOAT = 2.0 ** 52


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): components floor(scale * x) of the vectors that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (df.where(F.col(id_col).isNotNull() & x.isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("v")))


def matrix(column, dim: int) -> np.ndarray:
    """A list column as rows of ``dim`` components, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if dim and len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(lengths)), lengths)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with the added coordinate that makes all norms equal."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(0.0, top - np.einsum("ij,ij->i", x, x)))
    return np.hstack([x, rest[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, square))


class Page:
    """A node. Its entries' vectors lie together, with their distances to the parent's vector; a routing page has
    covering radii and child pages, a leaf has ids and integer components."""

    __slots__ = ("points", "to_parent", "radii", "children", "ids", "x")

    def __init__(self, points, to_parent, radii=None, children=None, ids=None, x=None):
        self.points, self.to_parent, self.radii, self.children, self.ids, self.x = points, to_parent, radii, children, ids, x


def build(points: np.ndarray, x: np.ndarray, ids: np.ndarray, parent: np.ndarray) -> Page:
    """The page tree over rows (lifted points, components, ids) below a parent vector."""
    if len(ids) <= PAGE:
        return Page(None, distances(points, parent[None])[:, 0], ids=ids, x=x)
    chosen = points[:: max(1, len(ids) // FANOUT)][:FANOUT]
    d = distances(points, chosen)
    near = d.argmin(axis=1)
    groups = [np.flatnonzero(near == g) for g in range(len(chosen))]
    if max(map(len, groups)) == len(ids):  # all alike: pages of equal points, cut by number
        groups = np.array_split(np.arange(len(ids)), -(-len(ids) // PAGE))
        chosen = np.repeat(chosen[:1], len(groups), axis=0)
        d = np.repeat(d[:, :1], len(groups), axis=1)
    full = [g for g in range(len(groups)) if len(groups[g])]
    children = [build(points[groups[g]], x[groups[g]], ids[groups[g]], chosen[g]) for g in full]
    radii = np.array([d[groups[g], g].max() for g in full])
    return Page(chosen[full], distances(chosen[full], parent[None])[:, 0], radii, children)


class Tree:
    """An M-tree over integer rows, searched best first."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float):
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        points = lifted(x, top)
        self.top, self.origin = top, points.mean(axis=0)
        self.root = build(points, x.astype(np.float64) if top < EXACT_FLOAT else x, ids, self.origin)

    def search(self, query_id: int, q: np.ndarray, k: int, limit: float) -> list[tuple[int, int]]:
        """The k best (score, id) among rows within distance ``limit`` whose id differs from the query's."""
        point = np.append(q.astype(np.float64), 0.0)
        norm = float(point @ point)
        exact = q.astype(np.float64) if self.top < EXACT_FLOAT else q
        margin = 1e-7 * (norm + self.top) ** 0.5 + 1e-6
        best: list[tuple[int, int]] = []  # heap of (score, -id): the worst first
        bound, count = limit + margin, 0
        queue = [(0.0, 0, float(np.linalg.norm(point - self.origin)), self.root)]
        while queue:
            least, _, to_node, page = heapq.heappop(queue)
            if least > bound:
                break
            gap = np.abs(to_node - page.to_parent)  # a lower bound of the distances, from stored distances alone
            if page.children is not None:
                rows = np.flatnonzero(gap - page.radii <= bound)
                away = page.points[rows] - point
                d = np.sqrt(np.einsum("ij,ij->i", away, away))
                low = np.maximum(0.0, d - page.radii[rows])
                for at in np.flatnonzero(low <= bound).tolist():
                    count += 1
                    heapq.heappush(queue, (float(low[at]), count, float(d[at]), page.children[rows[at]]))
                continue
            near = gap <= bound
            few = 2 * int(near.sum()) < len(near)
            scores = page.x[near] @ exact if few else page.x @ exact
            ids = page.ids[near] if few else page.ids
            if len(best) == k:
                better = np.flatnonzero(scores >= best[0][0])
                scores, ids = scores[better], ids[better]
            elif len(scores) > 4 * (k + 1):  # the page's own k best, ties included; the query's id may be many rows
                others = np.flatnonzero(ids != query_id)
                scores, ids = scores[others], ids[others]
                if len(scores) > k:
                    worst = np.partition(scores, len(scores) - k)[len(scores) - k]
                    better = np.flatnonzero(scores >= worst)
                    scores, ids = scores[better], ids[better]
            for at in np.lexsort((ids, -scores)).tolist():
                entry = (int(scores[at]), -int(ids[at]))
                if -entry[1] == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                else:
                    break
            if len(best) == k:
                bound = min(bound, max(0.0, norm + self.top - 2.0 * best[0][0]) ** 0.5 + margin)
        return [(s, -i) for s, i in best]


_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _visit(dim: int, top: float, k: int):
    """One block of queries through one tree."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if vectors.num_rows and queries.num_rows:
            tree = Tree(vectors["id"].to_numpy(), matrix(vectors["v"], dim), top)
            for i, q, limit in zip(queries["id"].to_pylist(), matrix(queries["v"], dim), queries["bound"].to_pylist()):
                found += [(i, v, s) for s, v in tree.search(i, q, k, limit)]
        columns = list(zip(*found)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=_HITS)

    return run


def _assign(pivots: np.ndarray, dim: int, top: float):
    """The nearest pivot of every row, and the distance to it."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                d = distances(lifted(matrix(batch.column("v"), dim), top), pivots)
                near = d.argmin(axis=1)
                yield pa.record_batch([batch.column("id"), batch.column("v"), pa.array(near.astype(np.int32)),
                                       pa.array(d[np.arange(len(near)), near])], names=["id", "v", "region", "d"])

    return run


def _route(pivots: np.ndarray, radii: np.ndarray, trees: np.ndarray, dim: int, top: float):
    """Send every query to the trees of the regions that may hold something within its bound."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = matrix(batch.column("v"), dim).astype(np.float64)
            d = distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
            margin = 1e-7 * np.sqrt(np.einsum("ij,ij->i", q, q) + top) + 1e-6
            bound = batch.column("bound").to_numpy(zero_copy_only=False)
            row, region = np.nonzero(d - radii[None] <= (bound + margin)[:, None])
            row, region = np.repeat(row, trees[region]), np.repeat(region, trees[region])
            if len(row):
                new = np.append(True, (np.diff(row) != 0) | (np.diff(region) != 0))
                first = np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
                piece = np.arange(len(row)) - first
                yield pa.record_batch([
                    pa.array(region.astype(np.int32)), pa.array(piece.astype(np.int32)), *(batch.column(c).take(pa.array(row))
                                                                                        for c in ("id", "v", "bound"))],
                    names=["region", "piece", "id", "v", "bound"])

    return run


def _best(hits: DataFrame, k: int, by: str = "query_id") -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` its k best rows of ``vectors`` by inner
    product of floor(scale * x), ties to the smaller id. Both frames have the id and vector columns."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score long"
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    base = stored(integer_vectors(vectors, id_col, vector_col, scale), "vectors")
    asked = stored(integer_vectors(queries, id_col, vector_col, scale).distinct(), "queries")
    n, top, dim = base.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("v"))).first()
    n_asked, asked_dim = asked.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n or not n_asked:
        return spark.createDataFrame([], result)
    dim = max(dim, asked_dim)
    alike = Window.partitionBy("v").orderBy("id")
    copies_of = base.groupBy("id", "v").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    rows = copies_of.withColumn("nth", F.row_number().over(alike)).where(F.col("nth") <= k + 1).select(
        F.explode(F.array_repeat("id", F.least("copies", F.lit(k)))).alias("id"), "v")
    sample = min(MAX_REGIONS, -(-n // ROWS_EACH))
    picked = base.select("v").orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()  # bounded by MAX_REGIONS rows
    pivots = np.unique(lifted(matrix(picked["v"], dim), top), axis=0)
    assigned = stored(rows.mapInArrow(_assign(pivots, dim, top), "id long, v array<long>, region int, d double"), "regions")
    stats = assigned.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r")).collect()  # a row a pivot
    radii, trees = np.full(len(pivots), -np.inf), np.zeros(len(pivots), dtype=np.int64)
    for s in stats:
        radii[s["region"]], trees[s["region"]] = s["r"] * (1 + 1e-9) + 1e-6, -(-s["n"] // ROWS_EACH)
    pieces = F.element_at(F.array(*(F.lit(int(t)) for t in trees)), F.col("region") + 1)
    placed = assigned.withColumn("piece", F.pmod(F.xxhash64("id"), F.greatest(pieces, F.lit(1))).cast("int"))

    blocks = max(1, -(-n_asked // QUERIES_EACH))

    def visit(targets: DataFrame) -> DataFrame:
        """Search targets (region, piece, id, v, bound) in the trees they name, block by block."""
        targets = targets.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
        copies = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return (copies.select("region", "piece", "block", "id", "v").groupBy("region", "piece", "block")
                .cogroup(targets.groupBy("region", "piece", "block"))
                .applyInArrow(_visit(dim, top, k), "query_id long, vec_id long, score long"))

    everywhere = F.lit(float("inf"))
    home = (asked.mapInArrow(_assign(pivots, dim, top), "id long, v array<long>, region int, d double")
            .select("region", F.pmod(F.xxhash64("id"), F.greatest(pieces, F.lit(1))).cast("int").alias("piece"), "id", "v",
                    everywhere.alias("bound")))
    at_home = stored(_best(visit(home), k), "home-hits")
    bounds = (at_home.where(F.col("rank") == k)
              .select(F.col("query_id").alias("id"), F.col("score").alias("kth")))
    bounded = asked.join(bounds, "id", "left").select(
        "id", "v", F.coalesce(F.sqrt(F.greatest(F.lit(0.0), norm + F.lit(float(top)) - 2.0 * F.col("kth"))),
                              everywhere).alias("bound"))
    routed = bounded.mapInArrow(_route(pivots, radii, trees, dim, top),
                                "region int, piece int, id long, v array<long>, bound double")
    return _best(visit(routed), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
