"""Document quality from a linear-chain conditional random field over lines.

**Lines.** A text is cut at line feeds. A line of more than ``LONG_LINE`` bytes counts as several, cut after a space. Each
line has seventeen small statistics (shares of character kinds, word lengths, repeated words, whether the line occurred
before, ...), put into bins. Its features are its own bins and those of the line before and after.

**Field.** P(labels | lines) is proportional to exp(sum over lines of w[features] for good ones + sum over neighbours of
a[label, next label]). Every line of a labelled document carries the document's label, so the transitions learn how much a
line says about its neighbours. Fitting maximises the likelihood, with a penalty on w, by full-batch Adam steps.

**Score.** Forward and backward sums give every line's marginal P(good); the score is their mean weighted by line length.

**On Spark.** The fit uses at most ``SAMPLE_PER_CLASS`` labelled documents of each class below ``FIT_BYTES`` (documented bound,
chosen by hashed ids, classes weighted back to their shares); what reaches the driver are their bins, about twenty
bytes a line. Scoring is one pass over the whole texts without a shuffle.

Defined results: null and empty texts are one empty line; a null id is kept as null and is not held out; repeated rows each
get a row; labels that are null or not 0 or 1, and labels of documents that are not there, take no part; without
labelled documents of both classes every score is the share of class 1 among those there are (0.5 if none); an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm._common import by_bytes

SAMPLE_PER_CLASS = 2000
FIT_BYTES = 1 << 16
STEPS = 150
RATE = 0.1
PENALTY = 1e-4  # of the mean squared weight, for each document
LONG_LINE = 1 << 18
CHUNK = 1 << 20
BINS = 12
STATS = 17
NOWHERE = BINS  # the bin of a neighbour that is not there
FEATURES = 3 * STATS * (BINS + 1)

UPPER, LOWER, DIGIT, SPACE, STOP, SIGN = range(6)
_KIND = np.full(256, SIGN, np.uint8)
_KIND[list(range(65, 91))] = UPPER
_KIND[[*range(97, 123), *range(128, 256)]] = LOWER  # all other scripts count as letters
_KIND[list(range(48, 58))] = DIGIT
_KIND[[9, 10, 11, 12, 13, 32]] = SPACE
_KIND[[ord(c) for c in ".,;:!?"]] = STOP


def cut_lines(data: bytes) -> list[bytes]:
    """The lines of a text; long ones in pieces of at most ``LONG_LINE`` bytes, cut after a space where there is one."""
    out = []
    for line in data.split(b"\n"):
        while len(line) > LONG_LINE:
            at = line.rfind(b" ", 0, LONG_LINE) + 1 or LONG_LINE
            out.append(line[:at])
            line = line[at:]
        out.append(line)
    return out


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """0 for none, else 1 to 11 by share."""
    x = part / np.maximum(whole, 1)
    return np.where(part > 0, 1 + np.minimum(10, np.floor(x * 10)), 0).astype(np.uint8)


def _size(n: np.ndarray) -> np.ndarray:
    return np.minimum(BINS - 1, np.ceil(np.log2(n + 1))).astype(np.uint8)


def _sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[end] - total[begin]


def line_stats(lines: list[bytes]) -> np.ndarray:
    """The bins of all statistics but the last (whether the line occurred before), one row a line."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    end = np.cumsum(sizes)
    begin = end - sizes
    kind = _KIND[data]
    count = [_sums(kind == k, begin, end) for k in range(6)]
    letters, n_upper = count[UPPER] + count[LOWER], count[UPPER]

    inside = kind != SPACE
    edge = np.zeros(len(data) + 1, bool)  # where lines meet: no word goes on there
    edge[begin], edge[-1] = True, True
    first = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    last = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)))
    length = last - first + 1
    w_begin, w_end = np.searchsorted(first, begin), np.searchsorted(first, end)
    n_words = w_end - w_begin
    line = np.repeat(np.arange(len(lines)), n_words)
    starts_at = np.concatenate([np.zeros(1, np.int64), first])  # of the word that a byte is in or after
    place = np.arange(len(data)) - np.repeat(starts_at, np.diff(np.append(np.append(0, first), len(data))))
    with np.errstate(over="ignore"):
        mixed = (data.astype(np.uint64) + 1) * (2 * place.astype(np.uint64) + 1) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(inside, mixed, np.uint64(0)))])
        word = total[last + 1] - total[first] if len(first) else np.empty(0, np.uint64)
    order = np.lexsort((word, line))
    new = np.ones(len(word), bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=len(lines))
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])

    def words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(line[flags], minlength=len(lines))

    tail = kind[last] if len(last) else kind[:0]
    head = kind[first] if len(first) else kind[:0]
    mean = np.bincount(line, weights=length, minlength=len(lines)) / np.maximum(1, n_words)
    ends = np.zeros(len(lines), np.uint8)
    full = n_words > 0
    ends[full] = 1 + tail[w_end[full] - 1]
    starts = np.zeros(len(lines), np.uint8)
    starts[full] = 1 + head[w_begin[full]]
    return np.stack([
        _size(sizes), _size(n_words), _share(letters, sizes), _share(n_upper, letters), _share(count[DIGIT], sizes),
        _share(count[SPACE], sizes), _share(count[STOP], n_words), _share(count[SIGN], n_words),
        np.minimum(BINS - 1, np.floor(mean)).astype(np.uint8), _share(n_words - distinct, n_words), _share(words(again), n_words),
        _share(words(length <= 3), n_words), _share(words(tail == STOP), n_words), _share(words(tail == SIGN), n_words), ends, starts,
    ], axis=1)


def text_stats(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins of every line, bytes of every line, lines of every text)."""
    lines, counts, seen_before = [], [], []
    for data in texts:
        own, seen = cut_lines(data), set()
        for x in own:
            key = hash(x)  # only whether it occurred before in this text
            seen_before.append(key in seen)
            seen.add(key)
        lines += own
        counts.append(len(own))
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    parts = [line_stats(lines[b:e]) for b, e in by_bytes(sizes.tolist(), CHUNK)]
    bins = np.concatenate(parts) if parts else np.empty((0, STATS - 1), np.uint8)
    return np.hstack([bins, np.array(seen_before, np.uint8)[:, None]]), sizes, np.array(counts, np.int64)


def features(bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The active features of every line: its own bins and those of its neighbours in the text."""
    ends = np.cumsum(counts)
    before, after = np.full_like(bins, NOWHERE), np.full_like(bins, NOWHERE)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[ends - counts], after[ends - 1] = NOWHERE, NOWHERE
    at = np.arange(STATS) * (BINS + 1)
    wide = STATS * (BINS + 1)
    return np.hstack([bins + at, before + (at + wide), after + (at + 2 * wide)]).astype(np.int32)


class Field:
    """Weights of the features (towards good) and of the four transitions [from, to]."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros(FEATURES) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def marginals(self, active: np.ndarray, counts: np.ndarray):
        """P(good) of every line, P(pair of labels) summed over the neighbours of every text, log of the normaliser.

        Texts run side by side, longest first, one position of all texts a step; everything is in logarithms."""
        good = self.weights[active].sum(axis=1)
        begin = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        first, steps = begin[order], int(counts.max(initial=0))
        alive = np.searchsorted(-counts[order], -np.arange(steps), side="left")  # texts with more than t lines
        score = np.stack([np.zeros_like(good), good], axis=1)
        forward, backward = np.zeros((len(good), 2)), np.zeros((len(good), 2))
        for t in range(steps):
            at = first[:alive[t]] + t
            forward[at] = score[at]
            if t:
                step = forward[at - 1][:, :, None] + self.moves[None]
                forward[at] += np.logaddexp(step[:, 0], step[:, 1])
        for t in range(steps - 2, -1, -1):
            at = first[:alive[t + 1]] + t
            step = self.moves[None] + (score[at + 1] + backward[at + 1])[:, None, :]
            backward[at] = np.logaddexp(step[:, :, 0], step[:, :, 1])
        end = begin + counts - 1
        whole = np.logaddexp(forward[end, 0], forward[end, 1])
        of = np.repeat(np.arange(len(counts)), counts)
        p = np.exp(forward[:, 1] + backward[:, 1] - whole[of])
        inner = np.ones(len(good), bool)
        inner[end] = False
        at = np.flatnonzero(inner)
        pair = np.exp(forward[at][:, :, None] + self.moves[None] + (score[at + 1] + backward[at + 1])[:, None, :] - whole[of[at], None, None])
        pairs = np.zeros((len(counts), 2, 2))
        np.add.at(pairs, of[at], pair)
        return p, pairs, whole

    def scores(self, bins: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted means of the marginals; a text without bytes has equal weights."""
        if not len(counts):
            return np.empty(0)
        p, _, _ = self.marginals(features(bins, counts), counts)
        begin = np.cumsum(counts) - counts
        weight = sizes.astype(np.float64) + np.repeat(np.add.reduceat(sizes, begin) == 0, counts)
        return np.clip(np.add.reduceat(p * weight, begin) / np.add.reduceat(weight, begin), 0.0, 1.0)


def objective(field: Field, active: np.ndarray, counts: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """The penalised log-likelihood of the documents' labels on all their lines, a document, and its gradients."""
    p, pairs, whole = field.marginals(active, counts)
    of = np.repeat(np.arange(len(counts)), counts)
    good = field.weights[active].sum(axis=1)
    each = weight / weight.sum()
    same = np.zeros((len(counts), 2, 2))
    same[np.arange(len(counts)), label, label] = counts - 1
    path = np.bincount(of, weights=good * label[of], minlength=len(counts)) + (same * field.moves).sum(axis=(1, 2))
    value = float((each * (path - whole)).sum()) - PENALTY * float((field.weights ** 2).sum())
    left = np.repeat((label[of] - p) * each[of], active.shape[1])
    d_weights = np.bincount(active.ravel(), weights=left, minlength=FEATURES) - 2 * PENALTY * field.weights
    d_moves = ((same - pairs) * each[:, None, None]).sum(axis=0)
    return value, d_weights, d_moves


def fit(bins: np.ndarray, counts: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Field:
    """Full-batch Adam steps on the likelihood."""
    active, field = features(bins, counts), Field()
    x = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, STEPS + 1):
        _, dw, dm = objective(field, active, counts, label, weight)
        g = np.concatenate([dw, dm.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = RATE * min(1.0, 2.0 * (1 - t / (STEPS + 1)))
        x = x + rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        field = Field(x[:FEATURES], x[FEATURES:].reshape(2, 2))
    return field


def _utf8(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in pc.cast(column, pa.binary()).to_pylist()]


def _bins_of(batches):
    for batch in batches:
        stats = [text_stats([t])[0] for t in _utf8(batch.column("text"))]
        yield pa.record_batch([batch.column("label"), pa.array([s.tobytes() for s in stats], pa.binary())], names=["label", "bins"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Field | float:
    """The field of a bounded sample of labelled documents, or the share of good ones if there is only one class."""
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
    size = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}  # two rows at most
    if not size:
        return 0.5
    rows_of = F.when(F.col("label") == 0, F.lit(size.get(0, 1))).otherwise(F.lit(size.get(1, 1)))
    thin = marked.where(F.pmod(F.xxhash64("id"), rows_of) < 2 * SAMPLE_PER_CLASS)  # so the ranking sees a bounded number
    w = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    chosen = thin.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= SAMPLE_PER_CLASS).select("id", "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.coalesce(F.octet_length("text"), F.lit(0)) <= FIT_BYTES)
    sample = texts.join(F.broadcast(chosen), "id").select("text", "label").dropDuplicates()  # at most 2 * 2000 ids, copies once
    got = sample.mapInArrow(_bins_of, "label int, bins binary").toArrow()
    label = got["label"].to_numpy()
    if len(set(label.tolist())) < 2:
        return float(label.mean()) if len(label) else 0.5
    parts = [np.frombuffer(b, np.uint8).reshape(-1, STATS) for b in got["bins"].to_pylist()]
    order = sorted(range(len(parts)), key=lambda i: (label[i], parts[i].tobytes()))  # the same sums whatever the order of arrival
    parts, label = [parts[i] for i in order], label[order]
    weight = np.where(label == 1, size[1] / (label == 1).sum(), size[0] / (label == 0).sum())
    return fit(np.concatenate(parts), np.array([len(p) for p in parts]), label, weight)


def held_out(id_col: str, parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id's text is ``part`` modulo ``parts``."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def _score(field: Field | float, carried: list[str]):
    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for b, e in by_bytes(sizes, CHUNK):
                part = batch.slice(b, e - b)
                score = field.scores(*text_stats(_utf8(part.column("text")))) if isinstance(field, Field) else np.full(e - b, field)
                yield pa.record_batch([*(part.column(c) for c in carried), pa.array(score)], names=[*carried, "score"])

    return run


def score_quality(docs: DataFrame, model: Field | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ``held_out``, ``score``): the score of every whole text, from its lines alone."""
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, score double"
    return rows.mapInArrow(_score(model, ["id", "held_out"]), schema).withColumnRenamed("id", id_col)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted): fitted on the labels that are not held out, and applied to every document."""
    model = fit_quality(docs, labels.where(~held_out("doc_id")))
    return score_quality(docs, model).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
