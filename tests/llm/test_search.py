"""Exact top-k search against brute force."""
import math

import numpy as np

from lakestrata.llm import metric_search as M


def brute(vectors, queries, k):
    def whole(v):
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            return None
        return [math.floor(256 * float(np.float32(c))) for c in v]

    rows = [(i, whole(v)) for i, v in vectors if i is not None and whole(v) is not None]
    out = set()
    for q, v in {(i, tuple(whole(v))) for i, v in queries if i is not None and whole(v) is not None}:
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in rows if i != q)
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def run(spark, vectors, queries, k=5):
    schema = "vec_id long, embedding array<float>, label int, v string, region int"
    frame = lambda rows: spark.createDataFrame([(i, v, 1, "v", 2) for i, v in rows], schema)
    return [tuple(r) for r in M.top_k(frame(vectors), frame(queries), k).select("query_id", "rank", "vec_id", "score").collect()]


def test_edges_and_ties(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [0.5, 0.25]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 0.0]),
               (8, [-0.5, -1.0]), (9, [0.1]), (10, []), (None, [1.0, 1.0]), (11, [2.0, 1.0]), (12, [0.5, 0.25])]
    queries = [v for v in vectors if v[0] in (1, 8, 10, 4, None)]
    got = run(spark, vectors, queries)
    assert set(got) == brute(vectors, queries, 5) and len(got) == len(set(got))


def test_random_with_copies(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_EACH", 50)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[100:240] = x[7]  # more than a third of the rows are one vector
    vectors = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]
    queries = [v for v in vectors if v[0] % 20 == 0]
    assert set(run(spark, vectors, queries)) == brute(vectors, queries, 5)


def test_repeated_ids(spark):
    shared = [(i, [0.5, 0.25]) for i in (0, 0, 1, 1, 2, 2, 3)]
    vectors = shared + [(0, [0.5, 0.25])] * 9 + [(4, [0.25, 0.25]), (4, [0.25, 0.5]), (5, [0.125, 0.0])]
    queries = [(i, v) for i, v in vectors if i in (0, 3, 5)]
    assert sorted(run(spark, shared, shared[:1])) == sorted(brute(shared, shared[:1], 5))
    assert sorted(run(spark, vectors, queries)) == sorted(brute(vectors, queries, 5))


def test_own_rows_do_not_fill_a_page():
    x = np.concatenate([np.full((30, 2), 9), np.arange(60).reshape(30, 2) % 7]).astype(np.int64)
    ids = np.concatenate([np.zeros(30), np.arange(1, 31)]).astype(np.int64)
    s = x @ x[0]
    best = sorted((-int(v), int(i)) for v, i in zip(s, ids) if i)[:5]
    found = M.Tree(ids, x, float((x * x).sum(axis=1).max())).search(0, x[0], 5, math.inf)
    assert sorted((-a, b) for a, b in found) == best


def test_few_and_none(spark):
    assert set(run(spark, [(1, [1.0]), (2, [2.0])], [(1, [1.0])])) == {(1, 1, 2, 131072)}
    assert run(spark, [(1, [1.0])], [(1, [1.0])]) == [] and run(spark, [], []) == []


def test_tree_prunes_and_is_exact():
    rng = np.random.default_rng(1)
    centers = rng.integers(-300, 300, size=(40, 16))
    x = (centers[rng.integers(0, 40, 6000)] + rng.integers(-8, 8, size=(6000, 16))).astype(np.int64)
    ids = rng.permutation(6000).astype(np.int64)
    tree = M.Tree(ids, x, float((x * x).sum(axis=1).max()))
    for at in range(0, 6000, 400):
        s = x @ x[at]
        best = sorted((-int(v), int(i)) for v, i in zip(s, ids) if i != ids[at])[:5]
        assert sorted((-a, b) for a, b in tree.search(int(ids[at]), x[at], 5, math.inf)) == best


def test_vectors_without_components(spark):
    rows = [(i, [], 1) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in M.top_k(frame, frame.where("vec_id < 2"), k=2).collect()}
    assert got == {(0, 1, 1, 0), (0, 2, 2, 0), (1, 1, 0, 0), (1, 2, 2, 0)}
