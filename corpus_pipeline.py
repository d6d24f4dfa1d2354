"""Corpus pipeline: language ID, near-duplicates, benchmark decontamination, PII, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``; the last returns doc_id, tokens, n_tokens and lossless. ``run`` applies them to ``documents``.

Rows with nulls, empty texts or repeated ids are handled as the operators' docstrings say; an empty table passes
through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm._common import ship, stored
from lakestrata.llm.decontaminate import drop_contaminated
from lakestrata.llm.language_id import keep_identified
from lakestrata.llm.piece_dropout import encode
from lakestrata.llm.queries import DROPOUT_SEED, SURROGATE_KEY
from lakestrata.llm.simhash_dedup import keep_first
from lakestrata.llm.surrogates import replace_entities


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an accepted language go."""
    ship(spark)
    return keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (SimHash of 3-word shingles, 3 bits)."""
    ship(spark)
    return keep_first(docs, k=3, bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by surrogates; ``n_chars`` follows the text."""
    clean = replace_entities(docs, key=SURROGATE_KEY)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with seeded merge-dropout, and whether they decode to the text."""
    ship(spark)
    out = encode(docs, "piece_bpe_32k.model", seed=DROPOUT_SEED, dropout=0.1)
    return out.select("doc_id", "tokens", F.size("tokens").cast("long").alias("n_tokens"), "lossless")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", replace_pii),
    ("token_ids", encode_pieces),
]

ORACLE_SQL = None  # a model, a perfect code and a tokenizer are not SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
