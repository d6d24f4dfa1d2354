"""Phrase collocations by vertically partitioned, depth-truncated suffix trees (ERA-style).

**Counting.** Every word of a piece starts a suffix, truncated after ``depth`` words or at the end of its piece. The number of
suffixes that begin with a phrase is the phrase's frequency, so a phrase's count is the total of the leaves below its node.

**Vertical partitioning.** The suffix tree is cut at word prefixes. A first pass counts words. Prefixes of more than
``BUDGET`` suffixes are extended by a word, and counted again, until all fit (as many passes as the longest such prefix has
words). The prefixes are dealt by hash into groups of about the budget (words that are not frequent, about half, are left
out, see below), and each group's subtrees are built on their own:
its suffixes are sorted, so a node is a run of equal prefixes. Nodes above a cut are the extended prefixes; they are
counted exactly by the passes that extended them. What the driver holds are the extended prefixes, at most
``depth`` * words / ``BUDGET``.

**Less to send.** A phrase is frequent only if its words are, so suffixes end before words that are not: a bitmap of fixed
size (``FILTER_BITS``), built from the frequent words, tells them; it errs only towards keeping. Equal suffixes of a
block of text travel once, with their number; a block's suffixes of one group travel as one compressed row.

**Cuts.** A candidate cut after k words has the score floor(1000 a n / (l r)); counts of both parts come by joins, the
arithmetic is done with decimals of 38 digits. A candidate inside a longer one of equal frequency is dropped; it suffices to
look at the candidates with one word more, because those between have the same frequency too.

Defined results: null texts count as empty; null languages are ``und``; repeated rows count each; words of any length and texts
without any separator are whole (long texts are worked on in stretches that overlap by ``depth`` - 1 words); languages
without words, and empty tables, give no rows.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm._common import mix64, partitions_for, stored

BLOCK = 16 << 20  # bytes of text whose suffixes are packed together
STRETCH = 4 << 20  # bytes of text that are words at a time
HELD_WORDS = 400_000  # different words that a task holds before it hands their counts on
BUDGET = 1 << 22  # suffixes a group is built from
FILTER_BITS = 1 << 23
BLOCK_BITS = 1 << 13
#: Characters that end a piece, and characters that end a word.
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b" \t"
END = b"."
_TABLE = bytes.maketrans(PIECE_ENDS + b"\t", END * len(PIECE_ENDS) + b" ")


def _stretches(data: bytes) -> Iterator[bytes]:
    """A long text in stretches of about ``STRETCH`` bytes, cut after a character that ends a word."""
    begin = 0
    while len(data) - begin > STRETCH:
        ends = [at for c in PIECE_ENDS + WORD_ENDS if (at := data.find(bytes([c]), begin + STRETCH)) >= 0]
        if not ends:
            break
        yield data[begin: min(ends) + 1]
        begin = min(ends) + 1
    yield data[begin:]


def _tokens(data: bytes) -> list[bytes]:
    """The words, with ``END`` where a piece ends (a word never is ``END``, which ends pieces)."""
    return data.lower().translate(_TABLE).replace(END, b" . ").split()


def stretches(batches) -> Iterator[tuple[str, list[bytes], bool]]:
    """(language, tokens, whether the text goes on in the next one): short texts of a language together, long ones in
    stretches."""
    waiting: dict[str, list[bytes]] = defaultdict(list)
    size: Counter = Counter()
    for batch in batches:
        for lang, data in zip(batch.column("lang").to_pylist(), pc.cast(batch.column("text"), pa.binary()).to_pylist()):
            data = data or b""
            if len(data) > STRETCH:
                parts = list(_stretches(data))
                for i, part in enumerate(parts):
                    yield lang, _tokens(part), i + 1 < len(parts)
                continue
            waiting[lang].append(data)
            size[lang] += len(data)
            if size[lang] >= STRETCH:
                size[lang] = 0
                yield lang, _tokens(END.join(waiting.pop(lang))), False
        if sum(size.values()) >= 4 * STRETCH:  # many languages: none waits for long
            for lang in list(waiting):
                yield lang, _tokens(END.join(waiting.pop(lang))), False
            size.clear()
    for lang, texts in waiting.items():
        yield lang, _tokens(END.join(texts)), False


def overlapped(batches, depth: int) -> Iterator[tuple[str, list[bytes], int]]:
    """(language, tokens, from how many of them on no suffix starts): stretches of one text overlap by ``depth`` - 1 tokens,
    so every suffix is whole in one of them."""
    held: list[bytes] = []
    for lang, tokens, more in stretches(batches):
        tokens = held + tokens
        keep = min(depth - 1, len(tokens)) if more else 0
        yield lang, tokens, len(tokens) - keep
        held = tokens[len(tokens) - keep:] if keep else []


def numbered(batches, depth: int) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, words by number, the words of about ``BLOCK`` bytes of text as numbers): 0 is the end of a piece. Where a
    block ends inside a text, the next begins with its last ``depth`` - 1 words, and -1 stands behind those that start no
    suffix in the block before."""
    ids: dict[str, dict[bytes, int]] = {}
    flat: dict[str, list[np.ndarray]] = defaultdict(list)
    size: Counter = Counter()
    held: list[bytes] = []
    for lang, tokens, more in stretches(batches):
        own = ids.get(lang)
        if own is None:
            own = ids[lang] = defaultdict(itertools.count().__next__)
            own[END]
        if held:  # the text that this goes on with was flushed
            flat[lang].append(np.fromiter(map(own.__getitem__, held), np.int64, len(held)))
            held = []
        flat[lang].append(np.fromiter(map(own.__getitem__, tokens), np.int64, len(tokens)))
        if not more:
            flat[lang].append(np.zeros(1, np.int64))
        size[lang] += sum(map(len, tokens)) + len(tokens)
        if size[lang] >= BLOCK:
            if more:
                whole = np.concatenate(flat[lang])
                names = list(own)
                held = [names[i] for i in whole[max(0, len(whole) - depth + 1):]]
            yield lang, list(own), np.concatenate([*flat.pop(lang), np.full(1, -1 if more else 0)])
            del ids[lang], size[lang]
        elif sum(size.values()) >= 4 * BLOCK and not more:  # many languages
            for other in list(flat):
                yield other, list(ids.pop(other)), np.concatenate(flat.pop(other))
            size.clear()
    for lang, parts in flat.items():
        yield lang, list(ids[lang]), np.concatenate(parts)


def _strings(words) -> pa.Array:
    return pa.array(list(words), pa.binary()).cast(pa.string())


_COUNTS = "lang string, phrase string, n long"


def _counted(lang: str, n: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array([lang] * len(n), pa.string()), _strings(n), pa.array(n.values(), pa.int64())],
                           names=["lang", "phrase", "n"])


def _count_words(batches):
    held: dict[str, Counter] = defaultdict(Counter)
    for lang, tokens, _ in stretches(batches):
        held[lang].update(tokens)
        if sum(map(len, held.values())) > HELD_WORDS:
            for other in list(held):
                n = held.pop(other)
                n.pop(END, None)
                yield _counted(other, n)
    for lang, n in held.items():
        n.pop(END, None)
        yield _counted(lang, n)


def _count_extended(hot: dict[str, set[tuple[bytes, ...]]], words: int):
    """Counts of the prefixes of ``words`` words that extend the prefixes ``hot`` of one word less."""

    def run(batches):
        for lang, tokens, new in overlapped(batches, words):
            known = hot.get(lang)
            if not known:
                continue
            first = {p[0] for p in known}
            tokens = tokens + [END] * (words - 1)
            at = [i for i in range(new) if tokens[i] in first]
            grams = (tuple(tokens[i: i + words]) for i in at)
            n = Counter(g for g in grams if g[:-1] in known and g[-1] != END)
            if n:
                yield _counted(lang, Counter({b" ".join(g): c for g, c in n.items()}))

    return run


def _hash(word: bytes, lang: str) -> int:
    """XXH64 of the word, seeded by that of the language: xxhash64(lang, word) in Spark."""
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode(), 42))


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """Which hashes of (lang, phrase) occur, as ``FILTER_BITS`` bits; the driver gets no more than these."""

    def pack(rows: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK_BITS, bool)
        bits[rows["at"].to_numpy() % BLOCK_BITS] = True
        return pa.table({"block": rows["block"].slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    at = frequent.select(F.xxhash64("lang", "phrase").bitwiseAND(FILTER_BITS - 1).alias("at")).distinct()
    parts = (at.withColumn("block", F.expr(f"at div {BLOCK_BITS}")).groupBy("block").applyInArrow(pack, "block long, bits binary").toArrow())
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for block, bits in zip(parts["block"].to_pylist(), parts["bits"].to_pylist()):
        out[block * BLOCK_BITS // 8: (block + 1) * BLOCK_BITS // 8] = np.frombuffer(bits, np.uint8)
    return out


def _sorted_rows(m: np.ndarray, words: int) -> np.ndarray:
    """The order of rows of ids below ``words``, as few keys as fit."""
    bits = max(1, int(words).bit_length())
    each = 64 // bits
    keys = []
    for at in range(0, m.shape[1], each):
        key = np.zeros(len(m), np.uint64)
        for c in range(at, min(at + each, m.shape[1])):
            key = (key << np.uint64(bits)) | m[:, c].astype(np.uint64)
        keys.append(key)
    return np.lexsort(keys[::-1])


def _runs(m: np.ndarray) -> np.ndarray:
    """Of sorted rows, in how many leading columns each agrees with the one before (0 for the first)."""
    agree = np.zeros(len(m), np.int8)
    if len(m) > 1:
        agree[1:] = np.logical_and.accumulate(m[1:] == m[:-1], axis=1).sum(axis=1)
    return agree


_PACK = pa.schema([("g", pa.int64()), ("lang", pa.string()), ("rows", pa.int64()), ("words", pa.binary()), ("ids", pa.binary()),
                   ("n", pa.binary()), ("cut", pa.binary())])
PACK = "g long, lang string, rows long, words binary, ids binary, n binary, cut binary"


def _narrow(values: np.ndarray) -> bytes:
    """Numbers in as few bytes each as hold them."""
    top = int(values.max(initial=0))
    return np.ascontiguousarray(values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)).tobytes()


def _widened(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(data) // count])


def _pack_suffixes(bitmap: np.ndarray, hot: list[dict[str, set[tuple[bytes, ...]]]], groups: int, depth: int):
    """The different suffixes of every block, by group. ``hot[k]`` are the extended prefixes of k + 1 words."""

    def run(batches):
        zstd = zstandard.ZstdCompressor()
        for lang, words, flat in numbered(batches, depth):
            ids = {w: i for i, w in enumerate(words)}
            goes_on = flat[-1] < 0
            flat = np.maximum(flat, 0)
            new = len(flat) - (depth if goes_on else 0)  # the others start their suffix in the next block
            h = np.fromiter((_hash(w, lang) for w in words), np.uint64, len(words))
            at = (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            often = (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            often[0] = False
            flat = np.concatenate([np.where(often[flat], flat, 0), np.zeros(depth, np.int64)])
            new = max(new, 0)
            live = np.flatnonzero((flat[:new] > 0) & (flat[1: new + 1] > 0))  # one word alone is counted already
            m = np.stack([flat[live + k] for k in range(depth)], axis=1).astype(np.int32)
            for k in range(2, depth):
                m[:, k] *= m[:, k - 1] > 0
            m = m[_sorted_rows(m, len(words))]
            starts = np.flatnonzero(_runs(m) < depth) if len(m) else np.empty(0, np.int64)
            n = np.diff(np.append(starts, len(m)))
            m = m[starts]
            # the cut: the shortest prefix that is not extended
            cut, prefix = np.ones(len(m), np.uint8), h[m[:, 0]]
            deeper = np.ones(len(m), bool)
            for k, known in enumerate(hot):
                local = [[ids[w] for w in p] for p in known.get(lang, ()) if all(w in ids for w in p)]
                if not local:
                    break
                rows = np.flatnonzero(deeper)
                code, mine = m[rows, 0].astype(np.int64), np.array([p[0] for p in local], np.int64)
                for c in range(1, k + 1):  # codes of prefixes, dense again after every word
                    both = np.concatenate([code * len(words) + m[rows, c], mine * len(words) + np.array([p[c] for p in local])])
                    both = np.unique(both, return_inverse=True)[1]
                    code, mine = both[: len(rows)], both[len(rows):]
                hit = rows[np.isin(code, mine)]
                deeper = np.zeros(len(m), bool)
                deeper[hit] = True
                if k + 1 < depth:
                    cut[hit] += 1
                    prefix[hit] = mix64(prefix[hit]) + h[m[hit, k + 1]]
            whole = m[np.arange(len(m)), cut - 1] > 0  # shorter ones count only for extended prefixes, which are known
            m, n, cut, prefix = m[whole], n[whole], cut[whole], prefix[whole]
            g = (mix64(prefix) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(g, kind="stable")
            edges = np.flatnonzero(np.append(True, g[order][1:] != g[order][:-1])) if len(order) else []
            for b, e in zip(edges, np.append(edges[1:], len(order)) if len(order) else []):
                part = order[b:e]
                used = np.zeros(len(words), bool)
                used[m[part]] = True
                used[0] = True
                number = np.cumsum(used) - 1
                data = (b" ".join(words[i] for i in np.flatnonzero(used)[1:]), _narrow(number[m[part]].T), _narrow(n[part]), _narrow(cut[part]))
                packed = (int(g[part[0]]), lang, len(part), *map(zstd.compress, data))
                yield pa.record_batch([pa.array([v], f.type) for v, f in zip(packed, _PACK)], schema=_PACK)

    return run


def _subtrees(depth: int, least: int):
    """The nodes of a group's subtrees with ``least`` suffixes or more, from two words on."""

    def run(packs: pa.Table) -> pa.Table:
        unzstd = zstandard.ZstdDecompressor()
        by_lang = defaultdict(list)
        for row in range(packs.num_rows):
            by_lang[packs["lang"][row].as_py()].append(row)
        langs, phrases, totals = [], [], []
        for lang, rows in by_lang.items():
            ids: dict[bytes, int] = defaultdict(itertools.count(1).__next__)
            parts, numbers, cuts = [], [], []
            for row in rows:
                size = packs["rows"][row].as_py()
                own, rows_ids, n, cut = (unzstd.decompress(packs[c][row].as_py()) for c in ("words", "ids", "n", "cut"))
                number = np.array([0, *(ids[w] for w in own.split(b" "))], np.int32)
                parts.append(number[_widened(rows_ids, size * depth).reshape(depth, size).T])
                numbers.append(_widened(n, size))
                cuts.append(_widened(cut, size))
            m, n, cut = np.concatenate(parts), np.concatenate(numbers).astype(np.int64), np.concatenate(cuts)
            del parts, numbers, cuts
            order = _sorted_rows(m, len(ids) + 1)
            m, n, cut = m[order], n[order], cut[order]
            agree, words = _runs(m), list(ids)
            for d in range(2, depth + 1):
                first = np.flatnonzero(agree < d)
                total = np.add.reduceat(n, first)
                node = (total >= least) & (m[first, d - 1] > 0) & (cut[first] <= d)
                for i, t in zip(first[node], total[node].tolist()):
                    langs.append(lang)
                    phrases.append(b" ".join(words[w - 1] for w in m[i, :d]))
                    totals.append(t)
        return pa.table([pa.array(langs, pa.string()), _strings(phrases), pa.array(totals, pa.int64())], names=["lang", "phrase", "n"])

    return run


def phrase_counts(docs: DataFrame, least: int, depth: int = 5, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, n) of all phrases of 1 to ``depth`` words that occur ``least`` times or more in pieces of their
    language, (lang, n) of all words)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    summed = lambda counts: counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    words = stored(summed(texts.mapInArrow(_count_words, _COUNTS)), "words")
    per_lang = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found, hot = [words.where(F.col("n") >= least)], []
    counted = words
    while len(hot) < depth - 1:
        over = counted.where(F.col("n") > BUDGET).collect()  # at most total / BUDGET rows
        if not over:
            break
        hot.append(defaultdict(set))
        for r in over:
            hot[-1][r["lang"]].add(tuple(r["phrase"].encode().split(b" ")))
        counted = stored(summed(texts.mapInArrow(_count_extended(dict(hot[-1]), len(hot) + 1), _COUNTS)), "prefixes")
        found.append(counted.where(F.col("n") > BUDGET))  # where the tree is cut further down; the others are nodes of subtrees
    groups = max(1, -(-total // BUDGET))
    bitmap = _bitmap(found[0])
    packs = texts.mapInArrow(_pack_suffixes(bitmap, [dict(h) for h in hot], groups, depth), PACK)
    packs = packs.repartition(max(groups, partitions_for(docs, 64 << 20)) if groups < 100_000 else 100_000, "g")
    nodes = packs.groupBy("g").applyInArrow(_subtrees(depth, least), _COUNTS)
    upper = [f.where(F.col("n") >= least) for f in found[1: len(hot)]]
    out = found[0]
    for f in [*upper, nodes]:
        out = out.union(f.select("lang", "phrase", "n"))
    return stored(out, "phrases"), stored(per_lang, "words-a-language")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``longest`` words of every language."""
    counts, per_lang = phrase_counts(docs, least, longest, text_col, lang_col)
    split = F.split("phrase", " ")
    candidates = counts.withColumn("words", split).where(F.size("words") > 1).withColumnRenamed("n", "a")
    # inside a longer candidate of the same frequency
    part = lambda at: F.array_join(F.slice("words", at, F.size("words") - 1), " ")
    longer = candidates.where(F.size("words") > 2)
    inner = (longer.select("lang", F.explode(F.array(part(1), part(2))).alias("phrase"), "a").groupBy("lang", "phrase")
             .agg(F.max("a").alias("most")))
    left = candidates.join(inner, ["lang", "phrase"], "left").where(F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("most")
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("tail"))
    of = lambda name, alias: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(alias))
    cuts = cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"]).join(per_lang, "lang")
    whole = lambda c: c.cast("decimal(19,0)")
    cuts = cuts.withColumn("above", whole(F.lit(1000) * F.col("a")) * whole(F.col("n"))).withColumn("below", whole(F.col("l")) * whole(F.col("r")))
    best = cuts.withColumn("score", F.expr("above div below")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c")).select("lang", "phrase", "c.*")
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
