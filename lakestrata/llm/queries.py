"""The registered queries of the operators. Each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm._common import ship
from lakestrata.llm.decontaminate import find_items
from lakestrata.llm.hard_negatives import hard_negatives
from lakestrata.llm.language_id import document_languages, fit_text, page_languages
from lakestrata.llm.line_quality import quality
from lakestrata.llm.metric_search import top_k
from lakestrata.llm.phrases import collocations
from lakestrata.llm.piece_dropout import encode
from lakestrata.llm.secrets_scan import find_secrets
from lakestrata.llm.simhash_dedup import near_duplicates
from lakestrata.llm.substring_dedup import remove_repeated_windows
from lakestrata.llm.suffix_dedup import remove_repeated_strings
from lakestrata.llm.surrogates import replace_entities
from lakestrata.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DROPOUT_SEED = 20250607
SURROGATE_KEY = "surrogates-1"  # a deployment passes its own secret key


def query(f):
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ORACLE["op1_topk_search"] = """WITH v AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
  scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored QUALIFY rank <= 5"""


@query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


ORACLE["op2_substring_dedup"] = r"""WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w),
  again AS (SELECT doc_id, i FROM starts QUALIFY count(*) OVER (PARTITION BY list_slice(ws, i, i + 34)) > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p, TRUE AS hit FROM again),
  words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
  left_over AS (SELECT doc_id, count(hit) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (hit IS NULL) AS kept
    FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
  FROM w LEFT JOIN left_over USING (doc_id)"""


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(read(spark, sf_dir, "documents"), size=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_languages(read(spark, sf_dir, "documents")).drop("text_hash")


@query
def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on web pages, where markup and addresses are at hand."""
    return page_languages(read(spark, sf_dir, "pages"), fit_text(read(spark, sf_dir, "documents")))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_strings(read(spark, sf_dir, "documents"), size=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(read(spark, sf_dir, "documents"), "piece_bpe_32k.model")
    return out.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op7_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(read(spark, sf_dir, "documents"), "piece_bpe_32k.model", seed=DROPOUT_SEED, dropout=0.1)
    return out.select("doc_id", "tokens", F.size("tokens").cast("long").alias("n_tokens"), "lossless")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_hash")


@query
def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, key=SURROGATE_KEY)


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = find_secrets(read(spark, sf_dir, "documents"))
    label = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.concat_ws(",", F.transform(base, label)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", label)).alias("spans"), count("checked_token").alias("n_checked"))


ORACLE["op11_hard_negatives"] = """WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
  scored AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS alike, c.vec_id, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
  positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", changed.alias("label"))
    return hard_negatives(vectors, F.col("id") % 50 == 0, positives=5, negatives=3, low=50, high=95, scale=256)


@query
def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.7)


ORACLE["op13_collocations"] = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
  n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
  starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
  grams AS (SELECT lang, list_slice(ws, i, i + len - 1) AS ws FROM starts, (SELECT unnest(range(1, 6)) AS len) WHERE i + len - 1 <= len(ws)),
  f AS MATERIALIZED (SELECT lang, array_to_string(ws, ' ') AS phrase, count(*) AS f FROM grams GROUP BY lang, ws HAVING count(*) >= 100),
  c AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE contains(phrase, ' ')),
  spots AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS i FROM c),
  part AS (SELECT lang, array_to_string(list_slice(ws, i, i + len - 1), ' ') AS phrase, a AS most
    FROM spots, (SELECT unnest(range(2, 5)) AS len) WHERE len < len(ws) AND i + len - 1 <= len(ws)),
  gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN part p ON c.lang = p.lang AND c.phrase = p.phrase AND 100 * p.most >= 100 * c.a),
  cuts AS (SELECT lang, phrase, a, k, array_to_string(list_slice(ws, 1, k), ' ') AS head, array_to_string(list_slice(ws, k + 1, len(ws)), ' ') AS tail
    FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM c) ANTI JOIN gone USING (lang, phrase)),
  scored AS (SELECT lang, cuts.phrase, a, k, x.f AS l, y.f AS r, n, CAST((1000 * a::HUGEINT * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts JOIN f x USING (lang) JOIN f y USING (lang) JOIN n USING (lang) WHERE x.phrase = head AND y.phrase = tail
    QUALIFY row_number() OVER (PARTITION BY lang, cuts.phrase ORDER BY score, k) = 1)
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM scored QUALIFY rank <= 2000"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"), least=100, longest=5, top=2000)
