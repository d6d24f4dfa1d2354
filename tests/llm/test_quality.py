"""Line quality: statistics against plain Python, the field against all label sequences, held-out accuracy, edges."""
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from lakestrata.llm import line_quality as Q
from lakestrata.llm import queries
from llm_tables import DOC_SCHEMA, doc, edge_docs, no_docs  # noqa: F401


def plain_stats(line: bytes):
    kinds = [Q._KIND[b] for b in line]
    n = [sum(k == j for k in kinds) for j in range(6)]
    words = re.findall(rb"[^\x09-\x0d\x20]+", line)
    share = lambda a, b: 0 if not a else 1 + min(10, math.floor(a / max(b, 1) * 10))
    size = lambda a: min(Q.BINS - 1, math.ceil(math.log2(a + 1)))
    letters = n[Q.UPPER] + n[Q.LOWER]
    w = len(words)
    kind = lambda b: int(Q._KIND[b])
    return [size(len(line)), size(w), share(letters, len(line)), share(n[Q.UPPER], letters), share(n[Q.DIGIT], len(line)),
            share(n[Q.SPACE], len(line)), share(n[Q.STOP], w), share(n[Q.SIGN], w), min(Q.BINS - 1, sum(map(len, words)) // max(1, w)),
            share(w - len(set(words)), w), share(sum(a == b for a, b in zip(words, words[1:])), w), share(sum(len(x) <= 3 for x in words), w),
            share(sum(kind(x[-1]) == Q.STOP for x in words), w), share(sum(kind(x[-1]) == Q.SIGN for x in words), w),
            1 + kind(words[-1][-1]) if w else 0, 1 + kind(words[0][0]) if w else 0]


def test_statistics_equal_plain_python(monkeypatch):
    rng = random.Random(2)
    pool = ["the", "THE", "a", "Être,", "x1", "|", "***", "日本", "end.", "", "\t", "42", "ab?", "the the"]
    texts = ["\n".join(" ".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 6))) for _ in range(200)]
    texts += ["", "\n", "\n\n", " ", "word", "a\n\nb", "same\nother\nsame"]
    monkeypatch.setattr(Q, "CHUNK", 300)
    bins, sizes, counts = Q.text_stats([t.encode() for t in texts])
    lines = [(x, x in t.encode().split(b"\n")[:i]) for t in texts for i, x in enumerate(t.encode().split(b"\n"))]
    assert counts.tolist() == [t.count("\n") + 1 for t in texts] and sizes.tolist() == [len(x) for x, _ in lines]
    for row, (x, before) in zip(bins.tolist(), lines):
        assert row == plain_stats(x) + [before], x


def test_long_lines_are_cut_whole(monkeypatch):
    monkeypatch.setattr(Q, "LONG_LINE", 50)
    data = b"word " * 100 + b"\n" + b"x" * 170 + b"\nend"
    pieces = Q.cut_lines(data)
    assert b"".join(pieces) == data.replace(b"\n", b"") and max(map(len, pieces)) <= 50 and pieces[-1] == b"end"


def random_case(seed, texts=6, most=5):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, most + 1, texts)
    bins = rng.integers(0, Q.BINS, (counts.sum(), Q.STATS)).astype(np.uint8)
    field = Q.Field(rng.normal(size=Q.FEATURES) * 0.3, rng.normal(size=(2, 2)))
    return rng, counts, bins, field


def test_marginals_equal_all_label_sequences():
    rng, counts, bins, field = random_case(1)
    active = Q.features(bins, counts)
    p, pairs, whole = field.marginals(active, counts)
    begin = 0
    for i, n in enumerate(counts):
        good = field.weights[active[begin: begin + n]].sum(axis=1)
        weight = {y: math.exp(sum(g for g, l in zip(good, y) if l) + sum(field.moves[a, b] for a, b in zip(y, y[1:])))
                  for y in itertools.product((0, 1), repeat=int(n))}
        z = sum(weight.values())
        assert math.isclose(math.log(z), whole[i], rel_tol=1e-9)
        for t in range(n):
            assert math.isclose(sum(w for y, w in weight.items() if y[t]) / z, p[begin + t], rel_tol=1e-9)
        for a, b in itertools.product((0, 1), repeat=2):
            want = sum(w * sum(x == (a, b) for x in zip(y, y[1:])) for y, w in weight.items()) / z
            assert math.isclose(want, pairs[i, a, b], rel_tol=1e-9, abs_tol=1e-12)
        begin += n
    sizes = rng.integers(0, 9, counts.sum())
    sizes[: counts[0]] = 0  # a text without bytes
    of = np.repeat(np.arange(len(counts)), counts)
    want = [np.average(p[of == i], weights=sizes[of == i] if sizes[of == i].sum() else None) for i in range(len(counts))]
    assert np.allclose(field.scores(bins, sizes, counts), want)


def test_gradients_equal_differences():
    rng, counts, bins, field = random_case(3)
    active, label, weight = Q.features(bins, counts), rng.integers(0, 2, len(counts)), rng.random(len(counts))
    value, dw, dm = Q.objective(field, active, counts, label, weight)
    step = 1e-6
    for j in [*np.flatnonzero(dw)[:20], 0]:
        moved = field.weights.copy()
        moved[j] += step
        assert abs((Q.objective(Q.Field(moved, field.moves), active, counts, label, weight)[0] - value) / step - dw[j]) < 1e-4
    for a, b in itertools.product((0, 1), repeat=2):
        moved = field.moves.copy()
        moved[a, b] += step
        assert abs((Q.objective(Q.Field(field.weights, moved), active, counts, label, weight)[0] - value) / step - dm[a, b]) < 1e-4


def test_held_out_accuracy(spark):
    got = queries.op12_line_quality(spark, SF_MID)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = got.join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    test = [r for r in rows if r.held_out and r.quality is not None]
    assert len(test) > 50 and {r.quality for r in test} == {0, 1}
    assert sum(r.predicted == r.quality for r in test) / len(test) > 0.97
    bad, good = ([r.score for r in test if r.quality == q] for q in (0, 1))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.99


def test_scores_ignore_all_but_the_text(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = Q.fit_quality(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    other = docs.select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    a, b = ({r.doc_id % 1_000_000: r.score for r in Q.score_quality(d, model).collect()} for d in (docs, other.repartition(3)))
    assert a.keys() == b.keys() and all(math.isclose(a[i], b[i], rel_tol=1e-12) for i in a)


def test_edges(spark, edge_docs, no_docs):  # noqa: F811
    labels = spark.createDataFrame([(6, 1, 9), (7, 1, 9), (4, 0, 9), (5, 0, 9), (5, 0, 9), (77, 1, 9), (None, 1, 9), (3, None, 9), (9, 5, 9)],
                                   "doc_id long, quality int, text int")
    got = Q.quality(edge_docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in edge_docs.collect())
    assert all(0 <= r.score <= 1 for r in got)
    score = {}
    for r in got:
        score.setdefault(r.doc_id, set()).add(r.score)
    assert len(score[7]) == 1 and score[0] == score[1]  # repeated rows alike; null as empty
    assert not [r for r in got if r.doc_id is None][0].held_out
    assert Q.quality(no_docs, labels).count() == 0
    for some, want in ((labels.where("quality = 1"), 1.0), (labels.where("false"), 0.5)):
        assert {r.score for r in Q.quality(edge_docs, some).collect()} == {want}


@pytest.mark.parametrize("seed", range(3))
def test_neighbours_matter(seed):
    rng = np.random.default_rng(seed)
    texts = [("\n".join(["plain words here and there."] * int(rng.integers(2, 5))) if y else
              "\n".join(["plain words here and there.", "%%% ### $$$", "plain words here and there."])).encode() for y in (0, 1) * 40]
    bins, sizes, counts = Q.text_stats(texts)
    field = Q.fit(bins, counts, np.array((0, 1) * 40), np.ones(80))
    score = field.scores(bins, sizes, counts)
    assert score[::2].max() < 0.3 and score[1::2].min() > 0.7  # the same good line, told by what stands beside it
