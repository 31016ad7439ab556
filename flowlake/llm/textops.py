"""Words and word shingles of whole texts, hashed column-wise inside tasks.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased, nothing else is changed.
All functions work on a few hundred kilobytes of text at a time, so that a task's memory is bounded by
its Arrow batch and its longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer single text is handled alone.
CHUNK_BYTES = 1 << 18

_RNG = np.random.Generator(np.random.PCG64(20_241))
BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER_CODES = BYTE_CODES.copy()
_LOWER_CODES[65:91] = BYTE_CODES[97:123]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, kept as far as they were needed."""

    def __init__(self):
        self.up = np.ones(0, dtype=np.uint64)
        self.down = np.ones(0, dtype=np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, 2 * CHUNK_BYTES)
            up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ np.uint64(salt)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def raw_texts(column: pa.Array) -> list[memoryview]:
    """The UTF-8 bytes of every text without copying; null is empty."""
    pa.default_memory_pool().release_unused()  # of the batch before
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return []
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[a:b] for a, b in zip(at, at[1:], strict=False)]


def pieces(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes, at least one row each."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span, from running sums: the same bytes give the same hash anywhere."""
    if len(buf) > 4 * CHUNK_BYTES and len(starts) > 1:  # a long text: by portions, so that memory stays small
        cut = np.searchsorted(starts, np.arange(0, len(buf), 2 * CHUNK_BYTES))
        cut = np.unique(np.append(cut, len(starts))).tolist()
        parts = [(a, b, int(starts[a])) for a, b in zip([0, *cut], cut, strict=False) if a < b]
        return np.concatenate(
            [span_hashes(buf[at : ends[b - 1]], starts[a:b] - at, ends[a:b] - at, codes) for a, b, at in parts]
        ) if len(parts) > 1 else _span_hashes(buf[starts[0] : ends[-1]], starts - starts[0], ends - starts[0], codes)
    return _span_hashes(buf, starts, ends, codes)


def _span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    up, down = _POWERS.upto(len(buf) + 1)
    total = np.empty(len(buf) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(codes[buf] * up[: len(buf)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts], 0x51)


class Words:
    """The words of a few texts: hash, byte span in ``buf``, and how many each text has."""

    def __init__(self, texts: list, lower: bool = True):
        joined = b" ".join([*texts, b""])
        self.buf = np.frombuffer(joined, dtype=np.uint8)
        solid = ~_IS_SPACE[self.buf]
        edge = np.diff(solid.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        self.hashes = span_hashes(self.buf, self.starts, self.ends, _LOWER_CODES if lower else BYTE_CODES)
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_ends = np.cumsum(size)
        cut = np.searchsorted(self.starts, self.text_ends)
        self.counts = np.diff(cut, prepend=0)
        self.first = cut - self.counts  # index of each text's first word

    def text_of(self, start: int, end: int) -> bytes:
        """The word at a byte span, A-Z lower-cased."""
        return self.buf[start:end].tobytes().lower()



def grams(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words that stay inside a text, and how many each text has.

    A text with fewer words gives one run of all it has; a text without words gives none.
    """
    n = len(hashes)
    text_of = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    total = mixed(hashes, 0x7F)
    for j in range(1, width):
        later = mixed(hashes[j:], 0x7F + j)
        same = text_of[j:] == text_of[: n - j] if j <= n else text_of[:0] == 0
        total[: max(n - j, 0)] += np.where(same, later, np.uint64(0))
    runs = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    return mixed(total[within < runs[text_of]], width), runs


def shingle_sets(texts: list, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles."""
    for a, b in pieces(texts):
        words = Words(texts[a:b])
        hashes, runs = grams(words.hashes, words.counts, width)
        at = 0
        for n in runs.tolist():
            yield np.unique(hashes[at : at + n])
            at += n


def set_digest(hashes: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit halves that identify a set of hashes."""
    return tuple(int(mixed(hashes, salt).sum(dtype=np.uint64).astype(np.int64)) for salt in (0x1234567, 0x89ABCDEF))


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's long, bit by bit."""
    return h.view(np.int64)


def long_lists(parts: list[np.ndarray]) -> pa.Array:
    """An Arrow column of lists of longs."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64, copy=False)))
