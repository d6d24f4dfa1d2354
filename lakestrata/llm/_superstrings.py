"""Minimiser partitioning of windows: runs of consecutive windows that share a minimiser travel as one string.

A window is ``size`` consecutive units (words or bytes). Its minimiser is its unit run of length ``gram`` with
the smallest hash, the leftmost of equals, so equal windows have equal minimisers at equal places. Hashes
only choose the bucket; whether windows are equal is decided on the strings themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from lakestrata.llm._common import mix64

POSITION_BITS = 24
CHUNK_BYTES = 1 << 18  # bytes hashed together (their arrays fit the cache); positions must fit POSITION_BITS
PACK_BYTES = 1 << 22  # bytes of text whose strings are collapsed and packed together
_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE, dtype=np.uint64)
        down = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def run_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [begin, end) of one chunk."""
    size = 2 * CHUNK_BYTES + 2
    up, down = _powers(size if len(data) < size else 1 << len(data).bit_length())
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix64((total[end] - total[begin]) * down[begin])


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries, by doubling."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(grams: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, minimiser and its position, for each run of valid windows with one
    minimiser.

    ``grams``: a hash for each position; ``valid``: which windows (of ``width`` gram positions) count."""
    shift = np.uint64(POSITION_BITS)
    low = sliding_minimum((grams >> shift << shift) | np.arange(len(grams), dtype=np.uint64), width)
    at = np.flatnonzero(valid[: len(low)])
    if not len(at):
        return at, at, np.zeros(0, dtype=np.uint64), at
    m = low[at]
    new = np.empty(len(at), dtype=bool)
    new[0] = True
    new[1:] = (np.diff(at) != 1) | (m[1:] != m[:-1])
    first = np.flatnonzero(new)
    place = (m[first] & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    return at[first], np.diff(np.append(first, len(at))), m[first] >> shift, place


def shard_of(minimiser: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(minimiser + np.uint64(1)) % np.uint64(shards)).astype(np.int64)


def grouped(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, rows) for each shard present."""
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.diff(shard[order])) + 1
    for rows in np.split(order, cut):
        if len(rows):
            yield int(shard[rows[0]]), rows


def pack(strings: list[bytes], *arrays: np.ndarray) -> bytes:
    """One compressed value of some strings and integer arrays (as 64-bit)."""
    import zstandard

    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    columns = [lengths, *(np.ascontiguousarray(a, dtype=np.int64) for a in arrays)]
    head = np.array([len(columns), *map(len, columns)], dtype=np.int64).tobytes()
    # columns go byte plane by byte plane: the high bytes are nearly constant and compress away
    planes = [c.view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *planes, *strings]))


def unpack(data: bytes) -> tuple[list[bytes], list[np.ndarray]]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, offset=8)
    at, columns = 8 * (n + 1), []
    for size in sizes.tolist():
        plane = np.frombuffer(raw, np.uint8, 8 * size, offset=at).reshape(8, size)
        columns.append(np.ascontiguousarray(plane.T).view(np.int64).reshape(-1))
        at += 8 * size
    strings = []
    for length in columns[0].tolist():
        strings.append(raw[at: at + length])
        at += length
    return strings, columns[1:]


def distinct(strings: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different strings and, for each string, the index of its equal."""
    index: dict[bytes, int] = {}
    which = np.fromiter((index.setdefault(s, len(index)) for s in strings), dtype=np.int64, count=len(strings))
    return list(index), which
