"""Repeated windows, repeated byte strings and SimHash groups against brute force."""
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from llm_tables import edge_docs, no_docs  # noqa: F401
from lakestrata.llm import simhash_dedup as H
from lakestrata.llm import substring_dedup as A
from lakestrata.llm import suffix_dedup as B


def bag(df):
    return Counter(map(tuple, df.collect()))


def kept_words(rows, size):
    seen = Counter()
    for _, t in rows:
        w = (t or "").encode().split()
        seen.update(tuple(w[j: j + size]) for j in range(len(w) - size + 1))
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for j in range(len(w) - size + 1):
            if seen[tuple(w[j: j + size])] > 1:
                gone.update(range(j, j + size))
        yield i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()


def kept_bytes(rows, size):
    first = {}
    low = lambda i: -(1 << 63) if i is None else i
    data = [(low(i), (t or "").encode()) for i, t in rows]
    for i, b in data:
        for j in range(len(b) - size + 1):
            w = b[j: j + size]
            first[w] = min(first.get(w, (i, j)), (i, j))
    for (i, _), (n, b) in zip(rows, data):
        gone = bytearray(len(b))
        for j in range(len(b) - size + 1):
            if first[b[j: j + size]] < (n, j):
                gone[j: j + size] = b"\1" * size
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        yield i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)


def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("hot", [2, A.HOT])
def test_repeated_windows(spark, edge_docs, hot):
    got = A.remove_repeated_windows(edge_docs, 6, hot).select("doc_id", "n_words", "n_removed", "kept")
    assert bag(got) == Counter(kept_words(plain(edge_docs), 6))


@pytest.mark.parametrize("hot", [2, B.HOT])
def test_repeated_strings(spark, edge_docs, hot):
    rows = [r for r in plain(edge_docs)]
    got = B.remove_repeated_strings(edge_docs, 40, hot)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect())
    assert got == Counter(kept_bytes(rows, 40))


def test_registered_queries_over_a_whole_table(spark):
    import hashlib

    from lakestrata.llm.queries import QUERIES

    rows = plain(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert bag(QUERIES["op2_substring_dedup"](spark, SF_SMALL)) == Counter(
        (i, n, r, sha(k.encode())) for i, n, r, k in kept_words(rows, 35))
    assert bag(QUERIES["op4_suffix_dedup"](spark, SF_SMALL)) == Counter(
        (i, n, r, s, sha(k)) for i, n, r, s, k in kept_bytes(rows, 100))
    fps = {i: H.fingerprint(t) for i, t in rows}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash_dedup"](spark, SF_SMALL).collect()}
    assert got == {i: (f"{fps[i]:016x}", c) for i, c in groups(fps).items()}


def test_empty_tables(spark, no_docs):
    assert A.remove_repeated_windows(no_docs).count() == 0 and B.remove_repeated_strings(no_docs).count() == 0
    assert H.near_duplicates(no_docs).count() == 0 and H.keep_first(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.text("ab", min_size=0, max_size=60)), max_size=8), st.sampled_from([2, 5, 1000]))
def test_index_of_levels_equals_brute_force(texts, hot):
    """The levels of one shard, fed batch by batch in any order."""
    size, rows = 24, [(k, t) for k, (_, t) in enumerate(texts)]
    index, lost, dealt = B.Index(size, hot), set(), []
    for i, t in reversed(rows):
        part, first, gram, anchor, strings = B.super_strings([t.encode()], size)
        if not strings:
            continue
        ids, th = np.full(len(strings), i), np.zeros(len(strings), np.int64)
        heads, later = B.first_places(strings, ids, first, th)
        for x in later:
            lost |= {(i, int(first[x]) + j) for j in range(len(strings[x]) - size + 1)}
        meta = np.stack([anchor, ids, first, th], axis=1)[heads]
        out, more = index.insert(gram[heads], [strings[x] for x in heads.tolist()], meta)
        for a, _, s, n in out:
            lost |= {(int(a), int(s) + j) for j in range(n)}
        dealt += more
    seen = {}
    for s, (_, a, f, _) in sorted(dealt, key=lambda d: d[1][1:3]):  # what the second step does
        for j in range(len(s) - size + 1):
            place = (a, f + j)
            held = seen.setdefault(s[j: j + size], place)
            lost |= {max(held, place)} if held != place else set()
            seen[s[j: j + size]] = min(held, place)
    first, want = {}, set()
    for i, t in rows:
        for j in range(len(t) - size + 1):
            if first.setdefault(t[j: j + size], (i, j)) != (i, j):
                want.add((i, j))
    assert lost == want


def groups(fps):
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_keys_meet_within_three_bits(f, flips):
    g = f
    for b in flips:
        g ^= 1 << b
    filed, whose_filed, look, whose = H.keys(np.array([f, g], dtype=np.uint64))
    assert set(filed[whose_filed == 0]) & set(look[whose == 1]) and set(filed[whose_filed == 1]) & set(look[whose == 0])


def test_fingerprint_by_definition():
    from xxhash import xxh64_intdigest

    for text in ("", "One", "one TWO", "a b c d e f g", "É é a A b B " * 9):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        h = [xxh64_intdigest(s, 42) for s in shingles]
        assert H.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("hot", [4, H.HOT_PAIRS])
def test_links_connect_like_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(H, "HOT_PAIRS", hot)
    monkeypatch.setattr(H, "BLOCK", 8)
    rng = np.random.default_rng(5)
    fps = {}
    for c in range(12):
        center = int(rng.integers(0, 2**63))
        for _ in range(40 if c == 0 else 6):  # one dense group, whose members differ from a center in up to 4 bits
            f = center
            for b in rng.integers(0, 64, size=int(rng.integers(0, 5))):
                f ^= 1 << int(b)
            fps[len(fps)] = f
    first = {}
    for i, f in fps.items():
        first.setdefault(f, i)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    nodes = spark.createDataFrame([(i, signed(f)) for f, i in first.items()], "id long, fp long")
    from lakestrata.llm.components import components

    found = {r.node: r.component for r in components(H.fingerprint_links(nodes)).collect()}
    want = groups({i: f for f, i in first.items()})
    assert {i: found.get(i, i) for i in want} == want


def test_groups_of_edge_documents(spark, edge_docs):
    rows = plain(edge_docs)
    got = Counter((r.doc_id, r.fp, r.component_id) for r in H.near_duplicates(edge_docs).collect())
    low = lambda i: -1 if i is None else i  # noqa: E731  a null id counts as the smallest
    want = groups({low(i): H.fingerprint(t or "") for i, t in rows})
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    public = lambda i: None if i == -1 else i
    assert got == Counter((i, signed(H.fingerprint(t or "")), public(want[low(i)])) for i, t in rows)


def test_one_document_of_each_group_stays(spark, edge_docs):
    kept = H.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    want = groups({i: H.fingerprint(t or "") for i, t in plain(edge_docs) if i is not None})
    grouped_with_null = {i for i in want if (H.fingerprint(dict(plain(edge_docs))[i] or "") ^ H.fingerprint(dict(plain(edge_docs))[None])).bit_count() <= 3}
    firsts = {i for i, c in want.items() if i == c} - {c for i, c in want.items() if i in grouped_with_null}
    assert sorted(x for x in ids if x is not None) == sorted(firsts) and ids.count(None) == 1


def test_rows_that_share_an_id_are_told_apart(spark):
    far = ["a quiet harbour town where fishing boats return at dusk", "quarterly revenue of the steel mill rose by nine percent",
           "the proof uses induction over the depth of every tree"]
    assert min((H.fingerprint(x) ^ H.fingerprint(y)).bit_count() for x in far for y in far if x != y) > 3
    rows = [(3, far[0]), (7, far[0]), (7, far[1]), (7, far[2]), (7, far[2]), (9, far[1])]
    kept = H.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == sorted([(3, far[0]), (7, far[1]), (7, far[2])])
