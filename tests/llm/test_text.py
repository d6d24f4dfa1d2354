"""Language ID, token counts, piece encoding, decontamination, PII and secrets against brute force."""
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from lakestrata.llm import decontaminate as C
from lakestrata.llm import language_id as L
from lakestrata.llm import piece_dropout as P
from lakestrata.llm import secrets_scan as X
from lakestrata.llm import surrogates as U
from lakestrata.llm import token_counts as T
from llm_tables import DOC_SCHEMA, doc, edge_docs, no_docs  # noqa: F401

MODEL = "piece_bpe_32k.model"


def library():
    return sentencepiece.SentencePieceProcessor(model_file=T.tokenizer_path(MODEL))


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# ------------------------------------------------------------------ language ID
def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = L.fit_text(docs.where("doc_id % 2 = 0"))
    got = L.document_languages(docs.where("doc_id % 2 = 1"), model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.language == got.lang).mean() > 0.98 and got.accepted.mean() > 0.98
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    declared = pages.select("page_id", F.regexp_extract("html", 'lang="(..)"', 1).alias("declared"))
    got = L.page_languages(pages, model).join(declared, "page_id").toPandas()
    assert (got.language == got.declared).mean() > 0.95


def test_language_evidence_decides_where_text_cannot(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = L.fit_text(docs)
    text = {lang: [r.text for r in docs.where(f"lang = '{lang}' and n_chars > 300").limit(40).collect()] for lang in ("de", "es")}
    rows = [(i, t, "a.example.org", None) for i, t in enumerate(text["de"] + text["es"][:5])]
    rows += [(100 + i, t, "b.example.net", f"<html lang='{'de' if i % 2 else 'es'}'>") for i, t in enumerate(
        x for pair in zip(text["es"], text["de"]) for x in pair)]
    rows += [(900, "x1", "a.example.org", None), (901, "x1", "c.example.org", None), (902, "x1", None, "<html lang=es>"),
             (903, "x1", None, "<html lang=de>"), (904, "x1", None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, host string, html string")
    got = L.identify(frame, model, F.col("text"), ["doc_id"], declared=L.declared_language(F.col("html")), host=F.col("host"))
    got = {r.doc_id: r.language for r in got.collect()}
    assert (got[900], got[901]) == ("de", "de")  # the host's prior, and its domain's
    assert (got[902], got[903]) == ("es", "de") and 904 in got  # declared markup


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 3)
    docs = lambda n: spark.createDataFrame([(i, f"text number {i}", f"l{i}") for i in range(n)], "doc_id long, text string, lang string")
    assert L.fit_text(docs(3)).languages == ["l0", "l1", "l2"]
    with pytest.raises(ValueError):
        L.fit_text(docs(4))


def brute_languages(rows, model):
    """(language, posterior, accepted) of (text, declared, suffix, host) rows by the formulas, one row after the other."""
    k, dist = len(model.languages), []
    for text, *_ in rows:
        data = np.frombuffer((text or "").encode().lower(), np.uint8)
        grams = L._trigrams(data) if len(data) > 2 else np.zeros(0, int)
        score = [L.TEMPER * sum(float(model.table[j][g]) for g in grams) for j in range(k)]
        raised = [math.exp(s - max(score)) for s in score]
        ok = [all(b == 32 or 97 <= b <= 122 or b >= 128 for b in data[i: i + 3]) for i in range(len(grams))]
        known = sum(o and bool(model.known[g]) for o, g in zip(ok, grams))
        dist.append((score, [round(r / sum(raised) * L.SHARE) / L.SHARE for r in raised], sum(ok), known))
    total = [sum(d[1][j] for d in dist) for j in range(k)]
    overall = [(t + 1) / (sum(total) + k) for t in total]
    domain = lambda h: ".".join(h.split(".")[-2:]) if h and "." in h else None
    out = []
    for r, (text, declared, suffix, host) in enumerate(rows):
        score, own, wordy, known = dist[r]

        def seen(value, of):
            return [sum(dist[i][1][j] for i, x in enumerate(rows) if i != r and of(x) == value) for j in range(k)]

        prior = overall
        for value, of in ((domain(host), lambda x: domain(x[3])), (host, lambda x: x[3])):
            if value is not None:
                n = seen(value, of)
                prior = [(n[j] + L.HOST_WEIGHT * prior[j]) / (sum(n) + L.HOST_WEIGHT) for j in range(k)]
        score = [s + math.log(p) for s, p in zip(score, prior)]
        for value, of in ((declared, lambda x: x[1]), (suffix, lambda x: x[2])):
            if value is not None:
                n = seen(value, of)
                score = [s + math.log((n[j] + 0.5) / (total[j] + 1)) for j, s in enumerate(score)]
        raised = [math.exp(s - max(score)) for s in score]
        top = max(raised) / sum(raised)
        foreign = wordy >= L.MIN_LETTERS and known < L.MIN_KNOWN * wordy
        letters = any(unicodedata.category(c)[0] == "L" for c in text or "")
        out.append((model.languages[raised.index(max(raised))], top, letters and top >= L.MIN_POSTERIOR and not foreign))
    return out


def test_languages_equal_the_formulas_row_by_row(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model, rng = L.fit_text(docs), random.Random(4)
    texts = [t[:60] for _, t in texts_of(docs)][:120] + [None, "", "12 34", "\u65e5\u672c" * 20, "zq xj vk " * 9]
    pick = lambda *v: rng.choice([None, *v])
    rows = [(t, pick("en", "fr", "de"), pick("com", "fr", "com/fr"), pick("a.site.fr", "b.site.fr", "x.com", "plain")) for t in texts]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, d string, s string, h string")
    got = L.identify(frame, model, F.col("text"), ["doc_id"], F.col("d"), F.col("s"), F.col("h")).orderBy("doc_id").collect()
    want = brute_languages(rows, model)
    assert [(r.language, r.accepted) for r in got] == [(w[0], w[2]) for w in want]
    assert max(abs(r.posterior - w[1]) for r, w in zip(got, want)) < 1e-6


def test_language_plans_do_not_grow_with_the_languages(spark):
    def plan(k):
        names = [f"l{i:02d}" for i in range(k)]
        model = L.TextModel(names, np.zeros((k, L.BINS), np.float32), np.ones(L.BINS, bool))
        out = L.document_languages(spark.createDataFrame([doc(1, "some text")], DOC_SCHEMA), model)
        assert out.first().language == "l00"
        return len(out._jdf.queryExecution().optimizedPlan().toString())

    assert abs(plan(4) - plan(64)) < 200


def test_language_sample_covers_rows_without_id_and_counts_copies_once(spark):
    rows = [doc(None, f"wort{i} und haus{i}", "de") for i in range(40)] + [doc(1, "the one text", "en")] * 3000
    model = L.fit_text(spark.createDataFrame(rows, DOC_SCHEMA))
    assert model.languages == ["de", "en"]
    gram = L._trigrams(np.frombuffer(b"ort", np.uint8))[0]
    assert model.table[0][gram] > model.table[1][gram]


def test_language_edges(spark, edge_docs, no_docs):
    got = {(r.doc_id, r.text_hash): r.accepted for r in L.document_languages(edge_docs).collect()}
    assert len(got) == len({t for t in texts_of(edge_docs)})
    kept = L.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns
    assert not {0, 1, 2} & {r.doc_id for r in kept.select("doc_id").collect()}  # nothing to read in these
    assert L.keep_identified(no_docs).count() == 0
    model = L.fit_text(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rng = random.Random(1)
    junk = " ".join("".join(rng.choice("qxzvkwjy0123") for _ in range(9)) for _ in range(80))
    assert not L.document_languages(spark.createDataFrame([doc(1, junk)], DOC_SCHEMA), model).first().accepted


# ------------------------------------------------------------------ token counts
def test_token_counts_equal_the_library(spark, edge_docs, no_docs):
    model = library()
    want = Counter((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in texts_of(edge_docs))
    assert Counter(map(tuple, T.token_counts(edge_docs, MODEL).collect())) == want
    assert T.token_counts(no_docs, MODEL).count() == 0
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(T.tokenizer_path("byte_bpe_50k.json"))
    small = edge_docs.where("length(text) < 5000")
    want = Counter((i, len(x.encode()), len(t.encode(x, add_special_tokens=False).ids)) for i, x in texts_of(small))
    assert Counter(map(tuple, T.token_counts(small, "byte_bpe_50k.json").collect())) == want


def test_cut_texts_add_up():
    model, rng = library(), random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice(["ab", " ", "  ", "▁", "é", "\n", "word", "<s>", "日"]) for _ in range(300))
        parts = T.safe_parts(text, 20)
        assert " ".join(parts) == text and sum(len(model.encode(p)) for p in parts) == len(model.encode(text))


def test_token_counts_query(spark):
    from lakestrata.llm.queries import QUERIES

    model = library()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op6_token_counts"](spark, SF_SMALL).collect()}
    for i, t in texts_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        n = len(model.encode(t))
        assert got[i] == (len(t.encode()), n, n > 4096)


# ------------------------------------------------------------------ piece encoding
def test_pieces_without_dropout_equal_the_library_and_decode(spark, edge_docs, no_docs):
    model = library()
    for dropout in (0.0, 0.3):
        rows = P.encode(edge_docs, MODEL, 5, dropout).collect()
        assert len(rows) == edge_docs.count() and all(r.lossless for r in rows)
        if dropout == 0.0:
            texts = {i: t or "" for i, t in texts_of(edge_docs)}
            assert all(r.tokens == model.encode(texts[r.doc_id]) for r in rows if "▁" not in texts[r.doc_id])
    back = P.decode(P.encode(edge_docs, MODEL, 5, 0.3), MODEL)
    assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t in texts_of(edge_docs))
    assert P.encode(no_docs, MODEL, 5).count() == 0


def test_dropout_is_seeded_and_varies(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 40")
    tokens = lambda d, seed: {r.doc_id: r.tokens for r in P.encode(d, MODEL, seed, 0.2).collect()}
    one = tokens(docs, 1)
    assert one == tokens(docs.repartition(7), 1) and one != tokens(docs, 2)
    same = P.encode_texts(P.load(MODEL), np.array([1, 2]), pa.array(["transportation internationally " * 5] * 2), 3, 0.2).to_pylist()
    assert same[0] != same[1]


def test_rounds_equal_the_heap(monkeypatch):
    model, rng = P.load(MODEL), random.Random(4)
    units = ["".join(rng.choice("abcdetinorsé日\n ") for _ in range(rng.randint(0, 30))).replace(" ", "") for _ in range(400)]
    variants = np.arange(len(units)) % P.VARIANTS
    a, n = P.encode_units(model, units, variants, 8, 0.25)
    monkeypatch.setattr(P, "LONG_UNIT", 0)
    b, m = P.encode_units(model, units, variants, 8, 0.25)
    assert (a == b).all() and (n == m).all()


def test_every_occurrence_draws_for_itself():
    model, n = P.load(MODEL), 20_000
    tokens = P.encode_texts(model, np.array([1, 2]), pa.array([" ".join(["internationally"] * n)] * 2), 3, 0.1)
    text, word = library().encode("internationally"), "internationally"
    rows = [r for doc in tokens.to_pylist() for r in by_word(model, doc)]
    assert len(rows) == 2 * n and all(P.decode_tokens(model, r) == word for r in rows)
    assert len(set(map(tuple, rows))) > 100  # eight fixed draws give at most eight
    rng, runs = random.Random(9), 4000
    share, want = sum(r == text for r in rows) / len(rows), sum(drawn(model, word, rng, 0.1) == text for _ in range(runs)) / runs
    assert abs(share - want) < 5 * (want * (1 - want) / runs) ** 0.5


def drawn(model, word, rng, dropout):
    """Symbols of a word where each candidate is dropped for good by an independent draw."""
    s, drop = [(i, x) for i, x in enumerate(model.symbols(" " + word).tolist())], {}
    while True:
        pairs = [(model.merges[a << 32 | b], at, (i, a, b)) for at, ((i, a), (_, b)) in enumerate(zip(s, s[1:])) if a << 32 | b in model.merges]
        for _, _, c in pairs:
            if c not in drop:
                drop[c] = rng.random() < dropout
        left = [(m[0], at, m[1]) for m, at, c in pairs if not drop[c]]
        if not left:
            return [x for _, x in s]
        _, at, piece = min(left)
        s[at: at + 2] = [(s[at][0], piece)]


def test_occurrences_equal_the_heap():
    model, rng, seed = P.load(MODEL), random.Random(6), 12
    pool = ["".join(rng.choice("abcdetinorsé日\n") for _ in range(rng.randint(0, 30))) for _ in range(50)] + ["transportation"] * 20
    units = [rng.choice(pool) for _ in range(3000)]
    keys = np.array([rng.getrandbits(62) for _ in units])
    which = np.array([pool.index(u) for u in units])
    flat, counts = P.encode_units(model, pool, keys, seed, 0.3, which)
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    for u, k, tokens in zip(units, keys.tolist(), got):
        kept = P.merge_heap(model, model.symbols(" " + u), k, seed, 0.3)
        assert tokens == P.to_tokens(model, np.array(kept), np.array([len(kept)]))[0].tolist()


def by_word(model, tokens):
    """Tokens of a text cut before each that begins with a space."""
    out = []
    for t in tokens:
        if model.token_bytes[t][:1] == b" ":
            out.append([])
        out[-1].append(t)
    return out


# ------------------------------------------------------------------ decontamination
def brute_items(docs, items):
    cut = lambda t: [w for w in re.split(C.SEPARATORS, (t or "").lower()) if w]
    shingles = lambda w: Counter(tuple(w[j: j + 5]) for j in range(len(w) - 4))
    found = set()
    for i, t in docs:
        w = cut(t)
        have = shingles(w)
        for k, x in items:
            q = cut(x)
            want = shingles(q)
            if want and have & want:
                best = max(sum((shingles(w[s: s + len(q)]) & want).values()) / sum((shingles(w[s: s + len(q)]) | want).values())
                           for s in range(max(1, len(w) - len(q) + 1)))
                if best >= 0.8:
                    found.add((i, k))
    return found


def test_contaminated_documents(spark, edge_docs, no_docs):
    item = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak near our river bank today"
    words = item.split()
    items = [(1, item), (2, "too short item"), (3, None), (4, ""), (1, item), (5, " ".join(words[:9])),
             (6, "again and again and again and again and again and again")]
    rows = [doc(i, t) for i, t in [
        (20, f"before it {item.upper()}!! after it"), (21, " ".join(words[1:]) + " end"), (22, " ".join(words[5:18])), (23, item[:60]),
        (24, "far " * 50 + item.replace("owls", "cats") + " far" * 50), (25, item), (25, item), (None, item),
        (26, "again and again and again and again and again"), (27, " ".join(words[:12] + ["extra"] + words[12:]))]]
    docs = edge_docs.union(spark.createDataFrame(rows, DOC_SCHEMA))
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in C.find_items(docs, frame).collect()}
    want = brute_items(texts_of(docs), items)
    assert got == want and {(20, 1), (21, 1), (25, 1), (None, 1)} <= got and (22, 1) not in got
    clean = C.drop_contaminated(docs, frame)
    assert clean.columns == docs.columns
    gone = {i for i, _ in want}
    assert Counter(r.doc_id for r in clean.collect()) - Counter({None: 1}) == Counter(i for i, _ in texts_of(docs) if i not in gone)
    assert C.find_items(no_docs, frame).count() == 0 and C.find_items(docs, frame.where("false")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_every_window_counts(spark, seed):
    """Items rearranged, shifted, repeated, thinned and cut, between other words: the same pairs as over all windows."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 4000)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([30, 50, 80])))) for k in range(6)]
    items.append((6, " ".join(["again", "and"] * 12 + [word() for _ in range(20)])))
    docs = []
    for i in range(60):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 2)):
            how, at = rng.randint(0, 6), rng.randrange(1, len(w))
            w = {0: w[at:] + w[:at], 1: w[: len(w) // 2][::1] + w[len(w) // 2:], 2: w[len(w) // 2:] + w[: len(w) // 2], 3: w[: at] + [word()] + w[at:],
                 4: w[: at] + w[at + 1:], 5: w[at // 10:], 6: w + w[:at]}[how]
        docs.append((i, " ".join([word() for _ in range(rng.choice([0, 3, 90]))] + w + [word() for _ in range(rng.choice([0, 3, 90]))])))
    frame = spark.createDataFrame([doc(i, t) for i, t in docs], DOC_SCHEMA)
    got = {(r.doc_id, r.item_id) for r in C.find_items(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute_items(docs, items)
    assert got == want and len(want) > 25


def test_swapped_halves_are_found_inside_a_text(spark):
    w = [f"x{i}" for i in range(80)]
    around = " ".join(f"y{i}" for i in range(200))
    docs = [doc(1, " ".join(w[40:] + w[:40])), doc(2, f"{around} {' '.join(w[40:] + w[:40])} {around}")]
    got = C.find_items(spark.createDataFrame(docs, DOC_SCHEMA), spark.createDataFrame([(9, " ".join(w))], "item_id long, text string"))
    assert sorted((r.doc_id, r.start, round(r.similarity, 2)) for r in got.collect()) == [(1, 0, 0.9), (2, 200, 0.9)]


def test_windows_with_repeated_shingles(spark):
    items, docs = [], []
    for n in range(30):  # the document lacks six shingles of the item and holds its last one seven times: 48 of 60
        words = [f"w{n}x{j}" for j in range(53)]
        items.append((n, " ".join(words + [f"again{n}"] * 5)))
        docs.append((n, " ".join(words[6:] + [f"again{n}"] * 11)))
    found = C.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.similarity) for r in found.collect()} == {(n, n, 0.8) for n in range(30)}


def test_decontamination_query_equals_brute_force(spark):
    from lakestrata.llm.queries import QUERIES

    docs = texts_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert {(r.doc_id, r.item_id) for r in QUERIES["op8_decontamination"](spark, SF_SMALL).collect()} == brute_items(docs, items)


# ------------------------------------------------------------------ PII
def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_surrogates_keep_type_format_and_identity(spark, edge_docs, no_docs):
    rows = [doc(i, t) for i, t in [
        (30, "Mail Ann.Lee@Mail.example.com or ann.lee@mail.example.com now"), (31, "card 4111 1111 1111 1111, or 4111111111111111."),
        (32, "card 4785380592391138!!"), (33, "call +1 (279) 555-0216 172.16.254.1 or 10.1.2.3"), (34, "SSN 078-05-1120; DE89 3704 0044 0532 0130 00"),
        (35, "Mrs. Anna Smith met Mr. John Smith and Herr Smith."), (36, "г-жа Анна Петрова"), (37, "ids 12 345 and 1.2.3 stay, 3.84.50.105a too"),
        (38, " ".join(f"{c}@a.example.com" for c in "abcdefghijklmnopqrstuvwxyz")), (None, "from ann.lee@mail.example.com")]]
    docs = edge_docs.union(spark.createDataFrame(rows, DOC_SCHEMA))
    out = U.replace_entities(docs, "key")
    assert out.columns == docs.columns and out.count() == docs.count()
    rest = lambda d: Counter(map(tuple, d.where("doc_id < 30").select(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in d.columns]).collect()))
    assert rest(out) == rest(docs)  # nothing to replace there
    new = dict(texts_of(out.where("doc_id >= 30 or doc_id is null and text like 'from%'")))
    old = {i: t for i, t in texts_of(docs)}
    a, b = re.findall(r"\S+@\S+", new[30])
    assert a == b.lower() or a.lower() == b and b != "ann.lee@mail.example.com"
    assert new[None] == f"from {b}"  # the same person in another document
    spaced, solid = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}), or (\d{16})\.", new[31]).groups()
    assert spaced.replace(" ", "") == solid != "4111111111111111" and luhn(solid) and solid[0] == "4"
    assert not luhn("4785380592391138") and not luhn(re.fullmatch(r"card (\d{16})!!", new[32])[1])
    assert re.fullmatch(r"call \+1 \(\d{3}\) 555-\d{4} 172?\S* or 10\.\d+\.\d+\.\d+", new[33].replace(new[33].split()[4], "172", 1))
    ssn, iban = re.fullmatch(r"SSN (9\d\d-\d\d-\d{4}); (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d)", new[34]).groups()
    chars = iban.replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in chars[4:] + chars[:4])) % 97 == 1
    anna, last, john, last2, last3 = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr\. (\w+) (\w+) and Herr (\w+)\.", new[35]).groups()
    assert last == last2 == last3 != "Smith" and anna.endswith("na") and john.endswith("n") and anna != "Anna"
    assert re.fullmatch(r"г-жа [А-Я][а-я]+ [А-Я][а-я]+", new[36]) and new[36] != old[36]
    assert new[37] == old[37]
    letters = re.findall(r"(\S+)@", new[38])
    assert len(set(letters)) == 26 and not {f"{x}@a.example.com" for x in "abcdefghijklmnopqrstuvwxyz"} & set(new[38].split())
    assert dict(texts_of(U.replace_entities(docs, "key").where("doc_id = 32"))) == {32: new[32]}
    assert dict(texts_of(U.replace_entities(docs, "other").where("doc_id = 32"))) != {32: new[32]}
    assert U.replace_entities(no_docs, "key").count() == 0


def test_pii_query_replaces_all_and_nothing_else(spark):
    from lakestrata.llm.queries import QUERIES

    rx = re.compile(r"[^\s@]+@[\w.-]+\w|(?<!\w)\d{16}(?!\w)|\+1 \(\d{3}\) 555-\d{4}|(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w])")
    new, of = dict(texts_of(QUERIES["op9_pii_surrogates"](spark, SF_MID))), defaultdict(set)
    for i, t in texts_of(spark.read.parquet(f"{SF_MID}/documents.parquet")):
        assert rx.sub("X", t) == rx.sub("X", new[i])
        for a, b in zip(rx.findall(t), rx.findall(new[i])):
            of[a].add(b)
    assert len(of) > 40 and all(len(v) == 1 for v in of.values())
    given = {b for v in of.values() for b in v}
    assert len(given) == len(of) and not given & set(of)


def test_dense_spaces_and_more_formats(spark):
    n = 40_000
    at = F.col("id")
    dense = spark.range(n).select(at.alias("doc_id"), F.concat(
        F.lit("at 192.168."), (at / 254 + 1).cast("int"), F.lit("."), (at % 254 + 1).cast("int"), F.lit(" now")).alias("text"))
    out = texts_of(U.replace_entities(dense, "key"))
    old, new = {t for _, t in texts_of(dense)}, {t for _, t in out}
    assert len(old) == len(out) == len(new) == n and not old & new
    assert all(re.fullmatch(r"at (192\.168|10\.\d+)\.\d+\.\d+ now", t) for t in new)

    rows = ["call +33 6 12 34 56 78, 06 12 34 56 78 or 030 1234567", "+34 612 34 56 78; 172.20.1.1",
            "from 2001:0db8:85a3:0000:0000:8a2e:0370:7334 to fe80::1 or FE80::1AB", "ann@one.example.com bob@one.example.com ann@two.example.org",
            "Dr. Anna Smith and Mrs Smith", "12:30, 2024:10, a::b, std::x and Face::add and +1 are no entities", "xMr Smith +33612345678"]
    got = [t for _, t in sorted(texts_of(U.replace_entities(spark.createDataFrame([doc(i, t) for i, t in enumerate(rows)], DOC_SCHEMA), "key")))]
    forms = [r"call \+33 \d \d\d \d\d \d\d \d\d, 0\d \d\d \d\d \d\d \d\d or 0\d\d \d{7}", r"\+34 \d{3} \d\d \d\d \d\d; 172\.(1[6-9]|2\d|3[01])\.\d+\.\d+",
             r"from 2001:db8(:[0-9a-f]{4}){6} to 2001:db8(:[0-9a-f]{4}){6} or 2001:DB8(:[0-9A-F]{4}){6}",
             r"(?P<a>\w+)@(?P<h>\w+\.\w+)\.com (?P<b>\w+)@(?P=h)\.com \w+@(?!(?P=h))\w+\.\w+\.org", r"Dr\. \w+l (\w+r) and Mrs \1"]
    for a, b, form in zip(rows, got, forms):
        assert a != b and re.fullmatch(form, b), (a, b)
    assert got[5] == rows[5] and re.fullmatch(r"xMr Smith \+\d{11}", got[6]) and got[6] != rows[6]


def test_surrogate_hosts_differ(spark):
    """Hosts of one letter have 16 shapes: later ones grow longer, and no two share a surrogate."""
    rows = [doc(i, f"a@{c}.com") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    new = [t for _, t in texts_of(U.replace_entities(spark.createDataFrame(rows, DOC_SCHEMA), "key"))]
    hosts = {t.split("@")[1] for t in new}
    assert len(hosts) == 26 and not hosts & {f"{c}.com" for c in "abcdefghijklmnopqrstuvwxyz"}


# ------------------------------------------------------------------ secrets
def brute_spans(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [("assign", *m.span())] * (len(m[2]) >= 6)
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], X.KINDS.index(s[0])))


def checked(body):
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = X.BASE62[d] + digits
    return digits


def test_scan_equals_brute_force():
    rng = random.Random(6)
    pieces = ["password", "PassWd", "token", "toKen", "ſecret", "api_key", "APIKEY", "AKIA", "akia", "ABC123XYZ", "=", ":", " ", "'", '"', "é", "日",
              "deadbeef", "0123456789abcdef", "İ", "xyz.", "\n", "toke", "secretpassword="]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert [(X.KINDS[k], s, e) for s, k, e in X.scan(text) if k < 3] == brute_spans(text)


def test_checksums_and_edges(spark, edge_docs, no_docs):
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good, bad = f"ghp_{body}{checked(body)}", f"npm_{body}zzzzzz"
    assert [X.KINDS[k] for _, k, _ in X.scan(f"é {good} and {bad}")] == ["checked_token"]
    rows = X.find_secrets(edge_docs.union(spark.createDataFrame([doc(50, f"é {good}")], DOC_SCHEMA))).collect()
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in rows}[50] == [("checked_token", 2, 42)]
    assert len(rows) == edge_docs.count() + 1 and X.find_secrets(no_docs).count() == 0


def test_secret_query(spark):
    import hashlib

    from lakestrata.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op10_secret_scan"](spark, SF_MID).collect()}
    for i, t in texts_of(spark.read.parquet(f"{SF_MID}/documents.parquet")):
        spans = brute_spans(t)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert got[i].spans == joined and got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == x for k, _, _ in spans) for x in X.KINDS[:3])
