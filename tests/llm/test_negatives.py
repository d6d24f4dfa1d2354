"""Hard negatives against brute force, and the walk's certificate against all scores."""
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakestrata.llm import hard_negatives as N
from lakestrata.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id string, score int, region int, copies int"


def brute(rows, anchor, positives=5, negatives=3):
    ok = [(i, l, [math.floor(256 * float(np.float32(c))) for c in x]) for i, x, l in rows
          if i is not None and l is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for i, l, x in {(i, l, tuple(x)) for i, l, x in ok if anchor(i)}:
        scored = sorted((-dot(x, y), j, m) for j, m, y in ok)
        for p, j in [(-s, j) for s, j, m in scored if m == l and j != i][:positives]:
            near = [(-s, n) for s, n, m in scored if m != l and 50 * p <= -100 * s <= 95 * p][:negatives]
            out += [(i, j, r + 1, n, p, s) for r, (s, n) in enumerate(near)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, l, "v", "w", 1, 2, 3) for i, x, l in rows], SCHEMA)


def found(spark, rows, **k):
    out = N.hard_negatives(frame(spark, rows), F.col("id") % 5 == 0, **k)
    return sorted(tuple(r) for r in out.collect())


def cloud(seed, n, dim, labels):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim))
    label = rng.integers(0, labels, n)
    x = centre[label] * 0.4 + rng.normal(size=(n, dim)) * 0.5 * rng.uniform(0.3, 1.5, (n, 1))
    return [(i, [float(c) for c in x[i]], int(label[i])) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_brute_force_over_many_shards(spark, monkeypatch, seed):
    for name, value in (("ROWS_EACH", 40), ("ANCHORS_A_CLUSTER", 7), ("ANCHORS_EACH", 10), ("BATCH", 4)):
        monkeypatch.setattr(N, name, value)
    rows = cloud(seed, 300, 6, 4)
    want = brute(rows, lambda i: i % 5 == 0)
    assert found(spark, rows) == want and len(want) > 300


def test_edges(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.25, 0.5]) for _ in range(3)], i % 3) for i in range(60)]  # many ties and equal vectors
    rows += [(100 + i, [0.5, 0.5, 0.25], i % 2) for i in range(40)]  # one vector that a third of the rows share
    rows += [(None, [0.5, 0.5, 0.5], 1), (205, None, 1), (210, [0.5, None, 0.1], 1), (215, [float("nan"), 0.1, 0.1], 1),
             (220, [0.5, 0.5, 0.5], None), (225, [float("inf"), 0.0, 0.0], 2), (230, [], 0), (235, [0.5], 1), (240, [0.0] * 3, 2),
             (245, [-0.5, -0.5, -0.5], 77), (7, [0.5, 0.5, 0.5], 1), (7, [0.5, 0.5, 0.5], 1), (300, [0.5, 0.25, 0.5], 0), (300, [0.5, 0.25, 0.5], 0)]
    assert found(spark, rows) == brute(rows, lambda i: i % 5 == 0)
    assert found(spark, []) == [] and found(spark, [(1, [1.0], 1)]) == [] and found(spark, [(0, [], 1), (5, [], 1), (6, [], 2)]) == [
        (0, 5, 1, 6, 0, 0), (5, 0, 1, 6, 0, 0)]


def test_a_walk_ends_before_the_list_does(monkeypatch):
    rng = np.random.default_rng(5)
    centre = np.eye(1, 16)[0]
    x = np.rint(256 * (np.where(rng.random((20_000, 1)) < 0.02, centre, 0) + rng.normal(size=(20_000, 16)) * 0.1)).astype(np.int64)
    u = np.rint(256 * (centre + rng.normal(size=(30, 16)) * 0.01)).astype(np.int64)
    ids, labels, own = np.arange(len(x)), np.zeros(len(x), int), -np.arange(30) - 1
    asks = (np.arange(30), np.full(30, N.LARGE), np.full(30, -N.LARGE))
    touched = [0]
    real = np.nonzero
    monkeypatch.setattr(N.np, "nonzero", lambda m: (touched.__setitem__(0, touched[0] + m.size), real(m))[1])
    (q, row, score), = N.walk(x, ids, labels, N.centres_of(u, 1)[0], u, own, np.zeros(30, int), asks, True, 5)
    monkeypatch.undo()
    want = -np.sort(-(u @ x.T), axis=1)[:, :5]
    assert (score.reshape(30, 5) == want).all() and touched[0] < 0.2 * 30 * len(x)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet/*.parquet'" if __import__("os").path.isdir(
        f"{SF_SMALL}/embeddings.parquet") else f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    got = queries.op11_hard_negatives(spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE['op11_hard_negatives']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
