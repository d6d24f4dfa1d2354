"""Language identification by Bayesian evidence fusion.

The posterior of a row's language is the product of
* the likelihood of its text: hashed byte trigrams (A-Z lower-cased), tempered because trigrams are not
  independent;
* the likelihood of the language its markup declares (``<html lang=...>``), and of its address suffix;
* a prior for its host, smoothed towards the host's domain, which is smoothed towards the whole table.

The text model is fitted on a bounded sample: at most ``SAMPLE_PER_LANGUAGE`` labelled rows of each language,
chosen by hashed ids (documented bound; whole texts). Everything else covers all rows: a first pass gives
each row its text posterior, and grouped sums of those posteriors (soft counts, combined before the shuffle) give the
tables for declared languages, suffixes, hosts and domains. A row's own share is taken out of its host's
counts, so a row is never evidence for itself.

A row is rejected if it holds no letters, if no language reaches ``MIN_POSTERIOR``, or if its text is in none of the
languages: of its trigrams of letters and spaces (``MIN_LETTERS`` or more) less than ``MIN_KNOWN`` occur in the sample
at all. Digits and signs have no say in that.

Defined results: null and empty texts are rejected, with the language that markup, suffix and host make likeliest; no
markup, suffix or host adds no evidence; a null id is kept as null; repeated rows each get a row; an empty table
gives an empty result; without any labelled row an error is raised unless the table is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm._common import by_bytes, stored

SAMPLE_PER_LANGUAGE = 500
MAX_LANGUAGES = 64
BINS = 1 << 16
TEMPER = 0.2  # weight of a trigram's log-likelihood
HOST_WEIGHT = 10.0  # pseudo-counts that the wider level lends to the narrower
MIN_POSTERIOR = 0.4
MIN_KNOWN = 0.4
MIN_LETTERS = 20
CHUNK = 1 << 19
SHARE = 1 << 20  # one row, as an integer


def _trigrams(data: np.ndarray) -> np.ndarray:
    """The bin of every byte trigram."""
    a = data.astype(np.int64)
    x = a[:-2] * 0x10001 + a[1:-1] * 0x8F1BBD + a[2:] * 0x2545F491
    return (x ^ (x >> 15)) & (BINS - 1)


def _chunks(batch: pa.RecordBatch):
    """(rows, lengths, lower-cased bytes joined) of row ranges of bounded size."""
    texts = batch.column("text")
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for b, e in by_bytes(sizes, CHUNK):
        parts = [(t.as_py() or "").encode().lower() for t in texts[b:e]]
        yield b, e, np.fromiter(map(len, parts), np.int64, e - b), np.frombuffer(b"".join(parts), np.uint8)


def _inside(lengths: np.ndarray, total: int) -> np.ndarray:
    """Which trigram positions lie within one text."""
    ok = np.ones(max(0, total - 2), dtype=bool)
    ends = np.cumsum(lengths)[:-1]
    for back in (1, 2):
        at = ends - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


class TextModel:
    """Log-probabilities of trigram bins under every language, and which bins occur in the sample."""

    def __init__(self, languages: list[str], table: np.ndarray, known: np.ndarray):
        self.languages, self.table, self.known = languages, table, known


def _sample_counts(languages: list[str]):
    """Trigram counts of labelled rows, by batch and language."""

    def run(batches):
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), dtype=object)
            for b, e, lengths, data in _chunks(batch):
                if len(data) < 3:
                    continue
                ok = _inside(lengths, len(data))
                grams = _trigrams(data)
                row = np.repeat(np.arange(b, e), lengths)[: len(grams)]
                for language in set(labels[b:e]):
                    of = np.isin(row, np.flatnonzero(labels == language)) & ok
                    bins = np.bincount(grams[of], minlength=BINS)
                    at = np.flatnonzero(bins)
                    yield pa.record_batch([pa.array([language] * len(at), pa.string()), pa.array(at), pa.array(bins[at])],
                                          names=["label", "bin", "n"])

    return run


def fit_text(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id") -> TextModel:
    """The text model of a bounded sample of labelled rows; more than ``MAX_LANGUAGES`` labels are an error. What reaches
    the driver is one row a language with at most 65,536 counts. Rows are sampled by a hash of id and text, so rows without
    an id and different rows of one id count like all others, and repeated rows count once."""
    labelled = docs.where(F.col(label_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().limit(MAX_LANGUAGES + 1).collect()}
    languages = sorted(sizes)
    if len(languages) > MAX_LANGUAGES:  # none is left out silently: its documents would get another language
        raise ValueError(f"more than {MAX_LANGUAGES} labels to fit")
    if not languages:
        raise ValueError("no labelled rows to fit on")
    # rows are first thinned by their own hash to about twice the sample, so the ranking sees a bounded number of rows
    rows_of = F.create_map(*(F.lit(x) for l in languages for x in (l, sizes[l])))
    thin = labelled.select("h", "label").where(F.pmod("h", rows_of[F.col("label")]) < 2 * SAMPLE_PER_LANGUAGE)
    w = Window.partitionBy("label").orderBy("h")
    chosen = thin.distinct().withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= SAMPLE_PER_LANGUAGE)
    sample = labelled.join(F.broadcast(chosen.select("h", "label")), ["h", "label"], "left_semi")  # at most 500 * 64 hashes
    sample = sample.dropDuplicates(["h", "label"]).select("text", "label")
    by_bin = sample.mapInArrow(_sample_counts(languages), "label string, bin long, n long").groupBy("label", "bin").agg(
        F.sum("n").alias("n"))
    counts = by_bin.groupBy("label").agg(F.collect_list("bin").alias("bins"), F.collect_list("n").alias("ns")).toArrow()
    grams = np.zeros((len(languages), BINS))
    for label, bins, ns in zip(counts["label"].to_pylist(), counts["bins"], counts["ns"]):
        grams[languages.index(label), bins.values.to_numpy()] = ns.values.to_numpy()
    total = grams.sum(axis=0)
    backed = (total + 0.5) / (total.sum() + 0.5 * BINS)  # unseen trigrams fall back to those of all languages
    log = np.log((grams + 200.0 * backed) / (grams.sum(axis=1, keepdims=True) + 200.0))
    return TextModel(languages, log.astype(np.float32), total > 0)


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _score(model: TextModel, text_columns: list[str]):
    """By row: tempered log-likelihoods of the languages, the row's share in each of them (its text posterior, in units
    of 1 / SHARE, so that sums of shares are exact), trigrams of letters and spaces, and how many of those are known."""
    wordy = np.zeros(256, dtype=bool)
    wordy[[32, *range(97, 123), *range(128, 256)]] = True

    def run(batches):
        for batch in batches:
            for b, e, lengths, data in _chunks(batch):
                n = e - b
                sums, known, letters = np.zeros((n, len(model.languages))), np.zeros(n), np.zeros(n)
                if len(data) >= 3:
                    ok = _inside(lengths, len(data))
                    grams = _trigrams(data)
                    ends = np.cumsum(lengths)
                    cut = np.minimum(np.stack([ends - lengths, ends]), len(grams))

                    def per_text(values):
                        total = np.append(0.0, np.cumsum(np.where(ok, values, 0.0), dtype=np.float64))
                        return total[cut[1]] - total[cut[0]]

                    for k in range(len(model.languages)):
                        sums[:, k] = per_text(model.table[k][grams])
                    w = wordy[data]
                    w = w[:-2] & w[1:-1] & w[2:]
                    known, letters = per_text(w & model.known[grams]), per_text(w)
                part = batch.slice(b, n)
                columns = [part.column(c) for c in text_columns]
                sums *= TEMPER
                share = np.rint(softmax(sums) * SHARE).astype(np.int64)
                yield pa.record_batch([*columns, pa.array(sums.tolist(), pa.list_(pa.float64())),
                                       pa.array(share.tolist(), pa.list_(pa.int64())), pa.array(known), pa.array(letters)],
                                      names=[*text_columns, "score", "share", "known", "wordy"])

    return run


def declared_language(html: Column) -> Column:
    """The primary language subtag that the markup declares, or null."""
    found = F.regexp_extract(html, r"(?i)<html[^>]{0,400}?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    return F.when(found != "", F.lower(found))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]+)", 1)
    return F.when(found != "", F.lower(found))


def address_suffix(url: Column) -> Column:
    """The last label of the host, with a two-letter first path part if there is one (``com/fr``)."""
    top = F.regexp_extract(host_of(url), r"([a-z]+)$", 1)
    path = F.regexp_extract(url, r"//[^/]+/([a-z]{2})(?:[/?#.]|$)", 1)
    return F.when(host_of(url).isNotNull(), F.concat_ws("/", top, F.when(path != "", path)))


def domain_of(host: Column) -> Column:
    """The last two labels of a host; a name without dots has no domain of its own."""
    found = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    return F.when(found != "", found)


LEVELS = ("declared", "suffix", "host", "domain")


def _level_counts(first: DataFrame) -> DataFrame:
    """(level, value, n): the summed shares of every value of every level, one array entry a language."""
    values = F.array(*(F.struct(F.lit(l).alias("level"), F.col(l).alias("value")) for l in LEVELS))
    seen = first.select(F.explode(values).alias("v"), "share").where("v.value IS NOT NULL")
    sums = (seen.select("v.level", "v.value", F.posexplode("share").alias("at", "n"))
            .groupBy("level", "value", "at").agg(F.sum("n").alias("n")))
    packed = sums.groupBy("level", "value").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("n"))
    return packed.select("level", "value", F.col("n.n").alias("n"))  # as many entries as languages


def _filled(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A list column as a matrix, zeros for nulls; and which rows are not null."""
    there = column.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), k))
    out[there] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
    return out, there


def _fuse(languages: list[str], total: np.ndarray, keep: list[str]):
    """Posterior of every row from its text, what it declares, its address suffix and the prior of its host."""
    k = len(languages)
    overall = (total + 1.0) / (total.sum() + k)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            score, _ = _filled(batch.column("score"), k)
            own, _ = _filled(batch.column("share"), k)
            others, there = {}, {}
            for level in LEVELS:  # counts without the row's own share
                n, there[level] = _filled(batch.column(f"n_{level}"), k)
                others[level] = np.maximum(0.0, n - own) / SHARE

            def smoothed(level: str, wider: np.ndarray) -> np.ndarray:
                n = others[level]
                return np.where(there[level][:, None], (n + HOST_WEIGHT * wider) / (n.sum(axis=1, keepdims=True) + HOST_WEIGHT), wider)

            score = score + np.log(smoothed("host", smoothed("domain", np.broadcast_to(overall, score.shape))))
            for level in ("declared", "suffix"):  # log P(value | language); nothing where the value is missing
                score = score + np.where(there[level][:, None], np.log((others[level] + 0.5) / (total + 1.0)), 0.0)
            posterior = softmax(score)
            best = posterior.argmax(axis=1)
            top = posterior[np.arange(len(best)), best]
            wordy, known = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("wordy", "known"))
            letters = pc.fill_null(batch.column("letters"), False).to_numpy(zero_copy_only=False)
            foreign = (wordy >= MIN_LETTERS) & (known < MIN_KNOWN * wordy)
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(np.array(languages, dtype=object)[best], pa.string()),
                                   pa.array(top), pa.array(letters & (top >= MIN_POSTERIOR) & ~foreign)],
                                  names=[*keep, "language", "posterior", "accepted"])

    return run


def identify(rows: DataFrame, model: TextModel, text: Column, keep: list[str], declared: Column | None = None,
             suffix: Column | None = None, host: Column | None = None) -> DataFrame:
    """``keep`` columns, ``language``, ``posterior`` and ``accepted`` of every row. Evidence travels as one array column a
    source, so plans and generated code are the same for any number of languages."""
    none = F.lit(None).cast("string")
    named = rows.select(*(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)), text.alias("text"),
                        (declared if declared is not None else none).alias("declared"),
                        (suffix if suffix is not None else none).alias("suffix"),
                        (host if host is not None else none).alias("host"),
                        text.rlike(r"\p{L}").alias("letters"))
    carried = [f for f in named.schema if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    scored = named.mapInArrow(_score(model, [f.name for f in carried]),
                              f"{schema}, score array<double>, share array<long>, known double, wordy double")
    first = stored(scored.withColumn("domain", domain_of(F.col("host"))), "language-evidence")
    sums = first.select(F.posexplode("share").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(len(model.languages))  # one row a language
    for r in sums:
        total[r["at"]] = r["n"] / SHARE
    counts = stored(_level_counts(first), "language-counts")
    out = first
    apart = F.concat(F.lit("\0"), F.hex(F.xxhash64("score", "known", "wordy")))  # rows without a value are spread, not matched
    for level in LEVELS:
        of = counts.where(F.col("level") == level).select(F.col("value").alias("_value"), F.col("n").alias(f"n_{level}"))
        out = out.withColumn("_value", F.coalesce(level, apart)).join(of, "_value", "left").drop("_value")
    kept = [f for f in carried if f.name.startswith("keep_")]
    fused = out.mapInArrow(_fuse(model.languages, total, [f.name for f in kept]), ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["language string, posterior double, accepted boolean"]))
    return fused.select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)), "language", "posterior", "accepted")


def document_languages(docs: DataFrame, model: TextModel | None = None) -> DataFrame:
    """``doc_id``, ``text_hash``, ``language``, ``posterior``, ``accepted`` for a table of documents: declared markup
    where a text is a web page, the address suffix where ``source`` is an address, and ``source`` as host."""
    source = F.col("source").cast("string")
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    if model is None:
        try:
            model = fit_text(docs)
        except ValueError:
            if not docs.isEmpty():
                raise
            return hashed.select("doc_id", "text_hash", F.lit("").alias("language"), F.lit(0.0).alias("posterior"),
                                 F.lit(False).alias("accepted"))
    return identify(hashed, model, F.col("text"), ["doc_id", "text_hash"], declared=declared_language(F.col("text")),
                    suffix=address_suffix(source), host=F.coalesce(host_of(source), source))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns unchanged) whose language is accepted."""
    gone = stored(document_languages(docs).where("not accepted").select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "rejected")
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & F.xxhash64("text").eqNullSafe(F.col("gone_hash"))
    return docs.join(gone, same, "left_anti")


def page_languages(pages: DataFrame, model: TextModel) -> DataFrame:
    """``page_id``, ``language``, ``posterior``, ``accepted`` for web pages: visible text, markup and address."""
    visible = F.regexp_replace("html", r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    url = F.col("url")
    return identify(pages, model, visible, ["page_id"], declared=declared_language(F.col("html")),
                    suffix=address_suffix(url), host=host_of(url))
