"""Secret scan: Aho-Corasick keyword prefilter, anchored patterns only at hits, then checksums.

Every kind has literal keywords that each of its matches must start with. One automaton finds all of them
in one pass over the text (lower-cased in A-Z only, so positions stay the same). A kind's pattern is then
tried only *at* those positions, left to right, skipping hits inside the previous match; this gives exactly
the leftmost non-overlapping matches of the pattern. Hexadecimal runs have no literal, so their keyword is a
run of the class letter in a copy of the text where every hexadecimal character is folded to one letter.
Long runs can only start there.

Kinds with an embedded checksum (fixed values below) are reported only if the checksum holds: the last six
characters encode the CRC-32 of the characters before them in base 62.

Defined results: null or empty texts have no spans; repeated rows each get their row; positions count code
points, the end is exclusive; spans are ordered by start, then by kind as listed in ``KINDS``.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from lakestrata.llm._common import id_and_text, public_id

# Kinds in report order, their patterns and keywords, and published token prefixes.
KINDS = ("assign", "access", "hex", "checked_token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_KEYWORD = "akia"
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

_FOLD = bytes(ord("h") if chr(c) in "0123456789abcdef" else ord(" ") for c in range(128)) + bytes([32]) * 128
_RUN = b"h" * MIN_HEX


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, words in ((0, ASSIGN_KEYWORDS), (1, (ACCESS_KEYWORD,)), (3, CHECKED_PREFIXES)):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def checksum_holds(body: str, check: str) -> bool:
    """Do the six base-62 digits equal the CRC-32 of the body?"""
    value = 0
    for c in check:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body.encode())


def _hex_spans(data: bytes, text: str) -> list[tuple[int, int]]:
    """Maximal runs of at least MIN_HEX hexadecimal characters."""
    folded = data.translate(_FOLD)
    at, spans = folded.find(_RUN), []
    while at >= 0:
        end = at + MIN_HEX
        while end < len(folded) and folded[end] == 104:
            end += 1
        shift = 0 if len(data) == len(text) else at - len(data[:at].decode())
        spans.append((at - shift, end - shift))
        at = folded.find(_RUN, end)
    return spans


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every span, in order."""
    if not text:
        return []
    data = text.encode()
    lowered = data.lower().decode()  # bytes.lower changes A-Z only
    spans = [(s, 2, e) for s, e in _hex_spans(data, text)]
    free = [0, 0, 0, 0]  # where the next match of a kind may start
    for last, (kind, length) in _automaton().iter(lowered):
        start = last - length + 1
        if start < free[kind]:
            continue
        m = (ASSIGN, ACCESS, HEX, CHECKED)[kind].match(text, start)
        if m is None:
            continue
        free[kind] = m.end()
        if kind == 0:
            good = len(m[2]) >= MIN_ASSIGN
        elif kind == 1:
            good = m.end() - m.start() >= MIN_ACCESS
        else:
            good = checksum_holds(m[1], m[2])
        if good:
            spans.append((m.start(), kind, m.end()))
    spans.sort()
    return spans


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans``, an array of (kind, start, end), for every row."""

    def run(batches):
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t.as_py())]
                     for t in batch.column("text")]
            yield pa.record_batch([batch.column("id"), pa.array(found, pa.list_(_SPAN))], names=["id", "spans"])

    out = id_and_text(docs, id_col, text_col).mapInArrow(
        run, "id long, spans array<struct<kind: string, start: int, end: int>>")
    return out.select(public_id().alias(id_col), "spans")
