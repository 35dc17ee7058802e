"""Vectorised word splitting and hashing over Arrow string buffers.

All kernels work on whole texts at byte level: the word patterns used here separate on ASCII bytes
only, so UTF-8 sequences are never cut. Temporary arrays are bounded by ``BLOCK`` bytes of text (or
one word), not by the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

BLOCK = 1 << 18                       # bytes of text hashed at a time
LONG = 64                             # longer words go to a library hash
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MULT = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = _powers(_BASE, BLOCK + 1)
_INV = _powers(_BASE_INV, BLOCK + 1)


def byte_class(separators) -> np.ndarray:
    """Lookup table: True for bytes that belong to a word."""
    out = np.ones(256, dtype=bool)
    out[list(separators)] = False
    return out


SPACE_WORDS = byte_class([0x20, *range(0x09, 0x0E)])                       # [^\x20\x09-\x0D]+
ALNUM_WORDS = byte_class([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32                                                      # A-Z only


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    arr = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if arr.null_count:
        arr = arr.fill_null("")
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on and serve later stages."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(batches, column: int, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows holding about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offsets = string_buffers(batch.column(column))
        i = 0
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), n)
            yield batch.slice(i, j - i)
            i = j
        release_memory()


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Byte spans of all words and, per text, the index of its first word (length = texts + 1)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True                                  # a word never runs into the next text
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_values(seed: int) -> np.ndarray:
    """Byte values of a kernel of its own: a seed drawn for a job cannot be foreseen by its texts."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _BYTE) -> np.ndarray:
    """64-bit hash of the bytes of each span (spans ascending, none empty).

    Short spans are hashed by a polynomial modulo 2^64. From about a thousand bytes on, such polynomials have colliding
    texts whatever their base, so spans of more than ``LONG`` bytes go to a library hash, seeded by ``values``.
    """
    n = len(starts)
    out = np.empty(n, dtype=np.uint64)
    i = 0
    while i < n:
        lo = starts[i]
        j = max(int(np.searchsorted(ends, lo + BLOCK, side="right")), i + 1)
        hi = ends[j - 1]
        size = int(hi - lo)
        pw, iv = (_POW, _INV) if size <= BLOCK else (_powers(_BASE, size + 1), _powers(_BASE_INV, size + 1))
        acc = np.empty(size + 1, dtype=np.uint64)
        acc[0] = 0
        np.cumsum(values[data[lo:hi]] * pw[:size], out=acc[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (acc[e] - acc[s]) * iv[s]
        i = j
    out = mix(out ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for w in np.flatnonzero(ends - starts > LONG).tolist():
        out[w] = xxh3_64_intdigest(data[starts[w]:ends[w]].tobytes(), int(values[0]))
    return out


def window_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes; entry i is the run starting at i."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        acc += words[j:j + n] * _MULT[(j + 37 * seed) % 256]
    return mix(acc + np.uint64(seed))


def rows_of(first: np.ndarray) -> np.ndarray:
    """Text index of each word from the per-text first-word index."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def window_starts(first: np.ndarray, k: int) -> np.ndarray:
    """True at each word that starts a whole window of ``k`` words inside its text."""
    n = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return left >= k


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed binary value."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(np.array([ord(a.dtype.kind), a.dtype.itemsize, len(a)], np.int64).tobytes())
    raw = b"".join(parts + [np.ascontiguousarray(a).tobytes() for a in arrays])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(value: bytes) -> list[np.ndarray]:
    size = int.from_bytes(value[:8], "little")
    raw = pa.decompress(value[8:], decompressed_size=size, codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(n, 3)
    out, at = [], 8 + 24 * n
    for kind, width, length in head.tolist():
        out.append(np.frombuffer(raw, np.dtype(f"{chr(kind)}{width}"), length, at))
        at += width * length
    return out


def gaps(values: np.ndarray) -> np.ndarray:
    """Ascending integers as small differences (compress well)."""
    d = np.diff(values.astype(np.int64), prepend=0).astype(np.int64)
    return d.astype(np.uint16) if len(d) == 0 or (d.min() >= 0 and d.max() < 1 << 16) else d


def ungaps(values: np.ndarray) -> np.ndarray:
    return np.cumsum(values, dtype=np.int64)
