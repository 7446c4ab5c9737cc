"""Numpy helpers over Arrow string columns: words, hashes, shards.

Texts stay as the UTF-8 bytes of the Arrow buffer. Words are maximal runs of
bytes outside 0x20 and 0x09-0x0D, so no Python string is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20

_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.RandomState(20240611).randint(0, 1 << 62, 256).astype(U64) * U64(4) + U64(1)
_P = U64(0x9E3779B97F4A7C15)
_P_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)


def _release() -> None:
    """Gives memory that earlier batches and tasks of this Python worker freed back to the system."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def chunks(batch: pa.RecordBatch, column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with at most max_bytes of text each (a longer text stands alone)."""
    n = batch.num_rows
    if not n:
        return
    _release()
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < n:
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + max_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64, len(arr) + 1, arr.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def words(buf: np.ndarray, off: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words per row) of every word; row boundaries end a word.

    inside: 256 flags of the bytes that words are made of (default: all but white space).
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    ink = ~_WS[buf] if inside is None else inside[buf]
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = ink[:-1]
    start = np.flatnonzero(ink & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = ink[1:]
    end = np.flatnonzero(ink & (~after | first[1:])) + 1
    return start, end, np.diff(np.searchsorted(start, off))


def word_array(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.LargeBinaryArray:
    """The byte spans as an Arrow array, for exact look-ups and dictionaries."""
    length = end - start
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=off[1:])
    data = np.ascontiguousarray(buf[flat(start, length)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(data)])


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(32))
    x *= _M1
    x ^= x >> U64(29)
    x *= _M2
    x ^= x >> U64(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, kept by the Python worker for usual lengths."""
    kept = process_cache("powers")
    if len(kept.get("up", ())) >= n:
        return kept["up"][:n], kept["down"][:n]
    size = -(-n // CHUNK_BYTES) * CHUNK_BYTES
    up, down = np.full(size, _P, U64), np.full(size, _P_INV, U64)
    up[0] = down[0] = 1
    np.cumprod(up, out=up)
    np.cumprod(down, out=down)
    if size <= 4 * CHUNK_BYTES:
        kept["up"], kept["down"] = up, down
    return up[:n], down[:n]


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one prefix sum over the buffer."""
    n = len(buf)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.multiply(_BYTE[buf], up[:n], out=total[1:])
    np.cumsum(total, out=total)
    h = (total[end] - total[start]) * down[start]
    return mix(h + (end - start).astype(U64) * _M2)


def ngram_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (length len(h) - n + 1, by doubling)."""
    if len(h) < n:
        return np.zeros(0, U64)
    out, have = None, 0
    power, span, rest = h, 1, n
    while rest:
        if rest & 1:
            if out is None:
                out, have = power, span
            else:
                m = min(len(out), len(power) - have)
                out, have = mix(out[:m] * _P + power[have : have + m]), have + span
        rest >>= 1
        if rest:
            power, span = mix(power[:-span] * _P + power[span:] + U64(span)), span * 2
    return out[: len(h) - n + 1]


def rows_of(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def window_starts(counts: np.ndarray, n: int) -> np.ndarray:
    """Word positions at which a run of n words of one row starts."""
    row = rows_of(counts)
    if len(row) < n:
        return np.zeros(0, np.int64)
    return np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])


def covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Mask of the positions inside any window of n that begins at one of starts."""
    mark = np.zeros(length + 1, np.int32)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + n, -1)
    return np.cumsum(mark[:length]) > 0


def flat(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i]+length[i]-1 for every i, joined."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(length) - length
    return np.repeat(start - begin, length) + np.arange(total)


def process_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    import sys
    import types

    module = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    return module.__dict__.setdefault(name, {})


def forget() -> None:
    """Empties the caches of this Python worker; who needs one fills it again."""
    import sys

    module = sys.modules.get("_llm_worker_cache")
    for cache in vars(module).values() if module else ():
        if isinstance(cache, dict):
            cache.clear()
    _release()
