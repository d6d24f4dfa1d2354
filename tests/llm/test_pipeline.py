"""The pipeline against its stages done by brute force, and on awkward and empty tables."""
from collections import Counter

import corpus_pipeline
from conftest import SF_SMALL
from lakestrata.llm import language_id as L
from lakestrata.llm import piece_dropout as P
from lakestrata.llm import simhash_dedup as H
from lakestrata.llm.surrogates import replace_entities
from lakestrata.llm.queries import SURROGATE_KEY
from llm_tables import edge_docs, no_docs  # noqa: F401
from test_dedup import groups
from test_text import brute_items, texts_of


def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    accepted = {r.doc_id for r in L.document_languages(docs).collect() if r.accepted}
    rows = [(i, t) for i, t in texts_of(docs) if i in accepted]
    assert len(rows) > 0.97 * docs.count()
    firsts = {i for i, c in groups({i: H.fingerprint(t) for i, t in rows}).items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {i for i, _ in brute_items([r for r in rows if r[0] in firsts], items)}
    assert leaked and len(firsts) < len(rows)
    keep = sorted(firsts - leaked)
    clean = dict(texts_of(replace_entities(docs.where(docs.doc_id.isin(keep)), SURROGATE_KEY)))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert sorted(got) == keep
    model = P.load("piece_bpe_32k.model")
    assert all(r.lossless and r.n_tokens == len(r.tokens) and P.decode_tokens(model, r.tokens) == clean[i] for i, r in got.items())


def test_stages_keep_columns_on_awkward_tables(spark, edge_docs, no_docs):  # noqa: F811
    for docs in (edge_docs, no_docs):
        ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns, name
            left = Counter(r.doc_id for r in out.select("doc_id").collect())
            assert not left - ids, name
            if name in ("decontamination", "pii"):
                assert left == ids, name
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
        assert Counter(r.doc_id for r in last.collect()) == ids


def test_query_is_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
