"""Collocations against brute force, over small blocks, small groups and deep cuts, and against SQL."""
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from conftest import SF_MID
from lakestrata.llm import phrases as P
from lakestrata.llm import queries
from llm_tables import DOC_SCHEMA, doc, edge_docs, no_docs  # noqa: F401


def brute(rows, least, longest, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, g in f.items():
        c = {p: a for p, a in g.items() if len(p) > 1 and a >= least}
        inside = {q: 0 for q in c}
        for p, a in c.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        mine = []
        for p, a in c.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (g[p[:k]] * g[p[k:]]), k) for k in range(1, len(p)))
            mine.append((-score, -a, " ".join(p).encode(), g[p[:k]], g[p[k:]]))
        out += [(lang, i + 1, s[2].decode(), -s[1], s[3], s[4], n[lang], -s[0]) for i, s in enumerate(sorted(mine)[:top])]
    return sorted(out)


def found(docs, **k):
    return sorted(tuple(r) for r in P.collocations(docs, **k).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_docs(spark, seed, n=120, parts=3):
    rng = random.Random(seed)
    pool = ["the", "The", "of", "a", "é", "x.y", "日本", "\x1f", "new", "york", "city", "hall", "wood"] + [f"w{i}" for i in range(25)]
    hot = "of the new york city hall"
    texts = [rng.choice([" ", "  ", "\t", ". ", "\n", " "]).join(
        rng.choice([rng.choice(pool), rng.choice(pool[:6]), hot]) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    rows = [doc(i, t, rng.choice(["en", "fr", None, "und"])) for i, t in enumerate(texts)] + [doc(0, "a b c d e f " * 300, "en"), doc(0, None), doc(1, "")]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(parts), [(r[2], r[1]) for r in rows]


@pytest.mark.parametrize("seed, block, budget, bits", [(1, 1 << 20, 1 << 20, 1 << 23), (2, 200, 40, 1 << 13), (3, 90, 6, 1 << 13), (4, 3000, 300, 1 << 14)])
def test_equal_brute_force(spark, monkeypatch, seed, block, budget, bits):
    for name, value in (("BLOCK", block), ("STRETCH", block // 3), ("BUDGET", budget), ("FILTER_BITS", bits)):
        monkeypatch.setattr(P, name, value)
    docs, rows = random_docs(spark, seed)
    least, longest, top = {1: (3, 5, 10_000), 2: (3, 5, 10_000), 3: (8, 5, 7), 4: (5, 3, 2000)}[seed]
    assert found(docs, least=least, longest=longest, top=top) == brute(rows, least, longest, top)


def test_edges(spark, edge_docs, no_docs):  # noqa: F811
    rows = [(r.lang, r.text) for r in edge_docs.collect()]
    assert found(edge_docs, least=2) == brute(rows, 2, 5, 2000)
    assert found(no_docs, least=2) == [] and found(edge_docs.where("text = ''"), least=1) == []


def test_scores_beyond_64_bits(spark):
    rows = [("en", 10 ** 10, 3 * 10 ** 10, 7 * 10 ** 10)]
    a, n = 10 ** 15, 9 * 10 ** 17
    got = spark.createDataFrame([(a, n, 2 * 10 ** 15 + 1, 3 * 10 ** 15)], "a long, n long, l long, r long")
    whole = lambda c: got[c].cast("decimal(19,0)")
    got = got.select((whole("a") * 1000 * whole("n")).alias("above"), (whole("l") * whole("r")).alias("below")).selectExpr("above div below").first()[0]
    assert got == 1000 * a * n // ((2 * 10 ** 15 + 1) * 3 * 10 ** 15) and rows


def test_query_equals_sql(spark):
    con = duckdb.connect()
    path = f"{SF_MID}/documents.parquet"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    got = queries.op13_collocations(spark, SF_MID)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE['op13_collocations']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 50
