"""SentencePiece (merge type) encoding with seeded merge-dropout, and decoding.

A text is cut into units: runs of spaces with the characters up to the next space (no piece of the vocabulary has
a word mark after another character, so no token crosses units; this is checked when the model is loaded). In a
unit, characters are merged as the agenda says: always the candidate pair whose piece has the best score,
the leftmost of equals. A candidate is skipped for good if a hash keyed by ``seed`` of (variant, place, left
symbol, right symbol) falls below ``dropout``; so the same seed gives the same tokens on every run and
executor. The variant of a unit is a hash keyed by the seed, the document's id and the unit's number, so every
occurrence of a word draws for itself; ``dropout`` 0 gives the library's tokens.

The occurrences in a chunk are encoded all together: those of one unit share the work for as long as they drop
the same candidates, and every round merges the best candidate of each such group. Units longer than ``LONG_UNIT``
characters go through a heap instead, which takes n log n steps, once for each occurrence.

Characters outside the vocabulary, and a literal word mark in the text, become byte pieces, so decoding gives the
very text back. Defined results: a null or empty text has no tokens and decodes to the empty text; repeated rows
each get a row; an empty table gives an empty result; very long texts are encoded whole.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lakestrata.llm._common import by_bytes, id_and_text, mix64, public_id
from lakestrata.llm.token_counts import MARK, tokenizer_path

VARIANTS = 1 << 62  # range of the hash that is an occurrence's variant
LONG_UNIT = 48
TOGETHER = 1 << 16  # occurrences merged together, to bound memory
CHUNK = 1 << 21
_M64 = (1 << 64) - 1
_NONE = np.int32(2 ** 31 - 1)
_IRREGULAR = re.compile(r"^ |  | $")
_UNIT = re.compile(r" +[^ ]*")


class PieceModel:
    """Tables of a merge-type model: symbols of characters, merges of symbol pairs, bytes of tokens."""

    def __init__(self, name: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces cross word boundaries; units would not be independent")
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i in range(size):
            if sp.is_byte(i):
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        symbol = {pieces[i]: i for i in plain}
        for c in sorted({c for i in plain for c in pieces[i]}):  # characters known only inside longer pieces
            symbol.setdefault(c, len(pieces) + len(symbol))
        self.char = {ord(c): s for c, s in symbol.items() if len(c) == 1}
        self.mark = symbol[MARK]
        self.size = size
        order = sorted((-sp.get_score(i), i) for i in plain)
        rank = {i: r for r, (_, i) in enumerate(order)}
        score = {i: sp.get_score(i) for i in plain}
        dense = {}  # equal scores share a rank, so that the leftmost wins
        for _, i in order:
            dense[i] = rank[i] if not dense or score[i] != score[last] else dense[last]
            last = i
        merges = {}
        for i in plain:
            p = pieces[i]
            for cut in range(1, len(p)):
                a, b = symbol.get(p[:cut]), symbol.get(p[cut:])
                if a is not None and b is not None:
                    merges[a << 32 | b] = (dense[i], i)
        self.pair_keys = np.array(sorted(merges), dtype=np.int64)
        self.pair_rank = np.array([merges[k][0] for k in self.pair_keys.tolist()], dtype=np.int32)
        self.pair_piece = np.array([merges[k][1] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.merges = merges
        bits = 18  # a table of hashed pair keys, probed linearly
        self.mask = (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        for at, k in enumerate(self.pair_keys.tolist()):
            h = (k * 0x9E3779B97F4A7C15 & _M64) >> (64 - bits)
            while self.slots[h] >= 0:
                h = (h + 1) & self.mask
            self.slots[h] = at
        self.token_bytes = [p.replace(MARK, " ").encode() for p in pieces]
        for b, i in enumerate(self.byte_ids.tolist()):
            self.token_bytes[i] = bytes([b])
        self.low_chars = np.full(1 << 16, -1, dtype=np.int64)
        for c, s in self.char.items():
            if c < 1 << 16:
                self.low_chars[c] = s
        self.low_chars[ord(MARK)] = -1  # a mark in the text is no space
        self.low_chars[32] = self.mark

    def find_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each symbol pair among the merges, or -1."""
        key = left << 32 | (right & 0xFFFFFFFF)
        with np.errstate(over="ignore"):
            h = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)
        out = self.slots[h]
        todo = np.flatnonzero((out >= 0) & (self.pair_keys[out] != key))  # a probe that met another key
        out[todo] = -1
        h[todo] = (h[todo] + 1) & self.mask
        while len(todo):
            slot = self.slots[h[todo]]
            todo, slot = todo[slot >= 0], slot[slot >= 0]
            hit = self.pair_keys[slot] == key[todo]
            out[todo[hit]] = slot[hit]
            todo = todo[~hit]
            h[todo] = (h[todo] + 1) & self.mask
        return out

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of characters; one outside the vocabulary is -1 - its code point."""
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        out = np.where(points < 1 << 16, self.low_chars[np.minimum(points, 65535)], -1)
        for at in np.flatnonzero(points >= 1 << 16).tolist():
            out[at] = self.char.get(int(points[at]), -1)
        return np.where(out < 0, -1 - points, out)


@lru_cache(maxsize=2)
def load(name: str) -> PieceModel:
    return PieceModel(name)


def candidate_hash(seed: int, place, left, right) -> np.ndarray:
    """The candidate's part of what decides whether it is dropped. Arrays or numbers; keyed by the seed."""
    with np.errstate(over="ignore"):
        pair = np.asarray(left).astype(np.uint64) << np.uint64(32) | np.asarray(right).astype(np.uint64)
        at = np.asarray(place).astype(np.uint64)
        return mix64((pair * np.uint64(0xD1342543DE82EF95)) ^ (at * np.uint64(0xAF251AF3B0F025B5)) ^ np.uint64(seed & _M64))


def skipped(candidate: np.ndarray, variant, dropout: float):
    """Is the candidate dropped in the occurrences with these variants?"""
    if dropout <= 0:
        return np.zeros(np.shape(candidate), dtype=bool)
    with np.errstate(over="ignore"):
        x = mix64(candidate + np.asarray(variant).astype(np.uint64))
    return x < np.uint64(min(_M64, int(dropout * 2.0 ** 64)))


def merge_rounds(model: PieceModel, symbols: np.ndarray, lengths: np.ndarray, which: np.ndarray, variants: np.ndarray,
                 seed: int, dropout: float):
    """Merge all occurrences together; occurrence i is of unit ``which[i]``. Returns the symbols left in each form, how
    many each form has, and the form of each occurrence.

    A row stands for all occurrences of a unit whose candidates had the same fate so far; rows with the same number of
    symbols are a table. A round asks every occurrence whether it drops the best candidate of its row. Those that do
    stay in the table, in a row without that candidate; the others go on in a row one symbol shorter, which joins
    the units of that length. Rows without a candidate are forms.
    """
    form = np.zeros(len(which), dtype=np.int64)
    if not len(which):
        return symbols[:0], form[:0], form
    begin = np.cumsum(lengths) - lengths
    width_of = lengths[which]
    by_width = np.argsort(width_of.astype(np.int16), kind="stable")
    edges = np.searchsorted(width_of[by_width], np.arange(int(lengths.max()) + 2))

    def candidates(left, right):
        """Ranks of symbol pairs; ``_NONE`` where they do not merge."""
        pair = model.find_pairs(left.astype(np.int64), right.astype(np.int64))
        return np.where(pair >= 0, model.pair_rank[pair], _NONE)

    done, forms = [], 0
    occ, at = np.zeros(0, np.int64), np.zeros(0, np.int64)  # occurrences in the table, and the row of each
    table, place, rank = np.zeros((0, 0), np.int32), np.zeros((0, 0), np.int8), np.zeros((0, 0), np.int32)
    slot = np.zeros(len(lengths), dtype=np.int64)
    for width in range(int(lengths.max()), 0, -1):
        new = np.flatnonzero(lengths == width)
        if len(new):
            fresh = symbols[begin[new][:, None] + np.arange(width)].astype(np.int32)
            ranks = np.full(fresh.shape, _NONE)
            ranks[:, :-1] = candidates(fresh[:, :-1].ravel(), fresh[:, 1:].ravel()).reshape(len(new), width - 1)
            spots = np.broadcast_to(np.arange(width, dtype=np.int8), fresh.shape)
            slot[new] = len(table) + np.arange(len(new))
            more = by_width[edges[width]: edges[width + 1]]
            occ, at = np.concatenate([occ, more]), np.concatenate([at, slot[which[more]]])
            if len(table):
                table, place, rank = (np.concatenate(x) for x in ((table, fresh), (place, spots), (rank, ranks)))
            else:
                table, place, rank = fresh, spots, ranks
        shorter, moved = [], 0
        while len(table):
            row, best = np.arange(len(table)), rank.argmin(axis=1)
            active = rank[row, best] < _NONE
            if not active.all():
                go_on = active[at]
                form[occ[~go_on]] = (forms + np.cumsum(~active) - 1)[at[~go_on]]
                done.append(table[~active])
                forms += len(done[-1])
                occ, at = occ[go_on], (np.cumsum(active) - 1)[at[go_on]]
                table, place, rank, best = table[active], place[active], rank[active], best[active]
                row = np.arange(len(table))
                if not len(table):
                    break
            skip = skipped(candidate_hash(seed, place[row, best], table[row, best], table[row, best + 1])[at],
                           variants[occ], dropout)
            merging, waiting = np.zeros(len(table), dtype=bool), np.zeros(len(table), dtype=bool)
            merging[at[~skip]] = True
            waiting[at[skip]] = True
            shorter.append((occ[~skip], (moved + np.cumsum(merging) - 1)[at[~skip]],
                            *_merged(model, candidates, table[merging], place[merging], rank[merging], best[merging])))
            moved += len(shorter[-1][2])
            occ, at = occ[skip], (np.cumsum(waiting) - 1)[at[skip]]
            rank[row, best] = _NONE  # dropped for good where they wait
            table, place, rank = table[waiting], place[waiting], rank[waiting]
        if shorter:
            occ, at, table, place, rank = (np.concatenate(x) for x in zip(*shorter))
    counts = np.concatenate([np.full(len(rows), rows.shape[1], dtype=np.int64) for rows in done])
    return np.concatenate([rows.ravel() for rows in done]).astype(np.int64), counts, form


def _merged(model: PieceModel, candidates, table: np.ndarray, place: np.ndarray, rank: np.ndarray, best: np.ndarray):
    """The rows (symbols, places, ranks) with the candidate at ``best`` merged."""
    row, width = np.arange(len(table)), table.shape[1]
    left, right = table[row, best].astype(np.int64), table[row, best + 1].astype(np.int64)
    merged = model.pair_piece[model.find_pairs(left, right)]
    stay = np.ones(table.shape, dtype=bool)
    stay[row, best + 1] = False
    shape = (len(table), width - 1)
    table, place, rank = table[stay].reshape(shape), place[stay].reshape(shape), rank[stay].reshape(shape)
    table[row, best] = merged
    for r, at in ((row[best < width - 2], best[best < width - 2]), (row[best > 0], best[best > 0] - 1)):
        rank[r, at] = candidates(table[r, at], table[r, at + 1])
    rank[row[best == width - 2], width - 2] = _NONE
    return table, place, rank


def merge_heap(model: PieceModel, symbols: np.ndarray, variant: int, seed: int, dropout: float) -> list[int]:
    """The same for one long unit, with an agenda kept as a heap."""
    s = symbols.tolist()
    n = len(s)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    agenda: list[tuple[int, int, int, int, int]] = []

    def offer(positions):
        """Put the pairs that begin at these positions on the agenda, unless they are dropped."""
        pairs = [(i, s[i], s[after[i]]) for i in positions if after[i] < n and s[i] >= 0 and s[after[i]] >= 0]
        pairs = [(i, a, b, m) for i, a, b in pairs if (m := model.merges.get(a << 32 | b))]
        if pairs and dropout > 0:
            i, a, b, _ = zip(*pairs)
            pairs = [p for p, skip in zip(pairs, skipped(candidate_hash(seed, i, a, b), variant, dropout)) if not skip]
        for i, a, b, (rank, piece) in pairs:
            heapq.heappush(agenda, (rank, i, a, b, piece))

    offer(range(n - 1))
    while agenda:
        _, i, a, b, piece = heapq.heappop(agenda)
        if not alive[i] or s[i] != a or after[i] >= n or s[after[i]] != b:
            continue
        j = after[i]
        s[i], alive[j], after[i] = piece, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer([x for x in (before[i], i) if x >= 0])
    return [s[i] for i in range(n) if alive[i]]


def to_tokens(model: PieceModel, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols to token ids: those outside the vocabulary become the pieces of their bytes."""
    odd = np.flatnonzero((symbols < 0) | (symbols >= model.size))
    if not len(odd):
        return symbols.astype(np.int32), counts
    inner = {s: c for c, s in model.char.items() if s >= model.size}
    extra = {at: [int(model.byte_ids[b]) for b in chr(inner[s] if s >= 0 else -1 - s).encode()]
             for at, s in zip(odd.tolist(), symbols[odd].tolist())}
    width = np.ones(len(symbols), dtype=np.int64)
    width[odd] = [len(extra[at]) for at in odd.tolist()]
    out = np.repeat(symbols, width)
    begin = np.cumsum(width) - width
    for at in odd.tolist():
        out[begin[at]: begin[at] + width[at]] = extra[at]
    owner = np.repeat(np.arange(len(counts)), counts)
    return out.astype(np.int32), np.bincount(owner, weights=width, minlength=len(counts)).astype(np.int64)


def encode_units(model: PieceModel, units: list[str], variants: np.ndarray, seed: int, dropout: float,
                 which: np.ndarray | None = None):
    """Token ids of occurrences of units (each stands for one space and its text), joined, and how many each has.
    Occurrence i is of unit ``which[i]`` (without ``which``, of unit i) and has the variant ``variants[i]``."""
    which = np.arange(len(units)) if which is None else which
    text = " " + " ".join(units) if units else ""
    lengths = np.fromiter(map(len, units), np.int64, len(units)) + 1
    symbols = model.symbols(text)
    begin = np.cumsum(lengths) - lengths
    long = lengths[which] > LONG_UNIT
    form = np.zeros(len(which), dtype=np.int64)
    parts, sizes, forms = [], [], 0
    short = np.flatnonzero(~long)
    short = short[np.argsort(which[short], kind="stable")]  # the occurrences of a unit together
    for b in range(0, len(short), TOGETHER):
        part = short[b: b + TOGETHER]
        used, at = np.unique(which[part], return_inverse=True)
        flat = np.repeat(begin[used] - (np.cumsum(lengths[used]) - lengths[used]), lengths[used])
        kept, counts, of = merge_rounds(model, symbols[flat + np.arange(len(flat))], lengths[used], at, variants[part], seed, dropout)
        form[part] = forms + of
        parts.append(kept)
        sizes.append(counts)
        forms += len(counts)
    for o in np.flatnonzero(long).tolist():
        u = which[o]
        kept = merge_heap(model, symbols[begin[u]: begin[u] + lengths[u]], int(variants[o]), seed, dropout)
        form[o] = forms
        parts.append(np.array(kept, dtype=np.int64))
        sizes.append([len(kept)])
        forms += 1
    if not forms:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    tokens, counts = to_tokens(model, np.concatenate(parts), np.concatenate(sizes))
    first, width = (np.cumsum(counts) - counts)[form], counts[form]
    ends = np.cumsum(width)
    return tokens[np.repeat(first - (ends - width), width) + np.arange(int(ends[-1]))], width


def split_units(texts: pa.Array) -> pa.ListArray:
    """The units of every text, each without its first space. An empty text has none."""
    lists = pc.split_pattern(texts, " ")
    odd = {}
    for at, t in enumerate(texts.to_pylist()):
        if not t:
            odd[at] = []
        elif _IRREGULAR.search(t):
            odd[at] = [u[1:] for u in _UNIT.findall(" " + t)]
    if not odd:
        return lists
    return pa.array([odd[i] if i in odd else x for i, x in enumerate(lists.to_pylist())], pa.list_(pa.string()))


def encode_texts(model: PieceModel, ids: np.ndarray, texts: pa.Array, seed: int, dropout: float) -> pa.ListArray:
    """Token ids of every text of a chunk."""
    lists = split_units(texts)
    per_text = pc.list_value_length(lists).to_numpy().astype(np.int64)
    words = lists.flatten()
    if not len(words):
        return pa.array([[]] * len(texts), pa.list_(pa.int32()))
    number = np.arange(len(words)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    with np.errstate(over="ignore"):
        draw = mix64(mix64(np.repeat(ids, per_text).astype(np.uint64) ^ np.uint64(seed & _M64)) + number.astype(np.uint64))
    variant = (draw % np.uint64(VARIANTS)).astype(np.int64)
    coded = words.dictionary_encode()
    flat, width = encode_units(model, coded.dictionary.to_pylist(), variant, seed, dropout, coded.indices.to_numpy().astype(np.int64))
    edges = np.append(0, np.cumsum(width))[np.append(0, np.cumsum(per_text))]
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat))


def decode_tokens(model: PieceModel, tokens) -> str:
    """The text of a list of token ids."""
    return b"".join(map(model.token_bytes.__getitem__, tokens))[1:].decode()


def encode(docs: DataFrame, model: str, seed: int, dropout: float = 0.1, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id_col``, ``tokens`` (array of int) and ``lossless`` (do the tokens decode to the text?) of every row."""

    def run(batches):
        m = load(model)
        for batch in batches:
            texts = batch.column("text")
            for b, e in by_bytes(pc.binary_length(texts).to_pylist(), CHUNK):
                part = texts[b:e]
                lists = encode_texts(m, batch.column("id")[b:e].to_numpy(), part, seed, dropout)
                same = [decode_tokens(m, x) == t for x, t in zip(_rows(lists), part.to_pylist())]
                yield pa.record_batch([batch.column("id")[b:e], lists, pa.array(same)], names=["id", "tokens", "lossless"])

    out = id_and_text(docs, id_col, text_col).mapInArrow(run, "id long, tokens array<int>, lossless boolean")
    return out.select(public_id().alias(id_col), "tokens", "lossless")


def _rows(lists: pa.ListArray):
    flat, edges = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    for a, b in zip(edges, edges[1:]):
        yield flat[a - edges[0]: b - edges[0]].tolist()


def decode(tokens: DataFrame, model: str, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """``id_col`` and ``text``: the decoded token lists (null or empty lists give the empty text)."""

    def run(batches):
        m = load(model)
        for batch in batches:
            texts = [decode_tokens(m, x or ()) for x in batch.column("tokens").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    base = tokens.selectExpr(f"cast(`{id_col}` as long) as id", f"`{tokens_col}` as tokens")
    return base.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
