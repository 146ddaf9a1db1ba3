"""Vectorised text helpers for Arrow batches: byte buffers, words, hashes.

Words are maximal runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``; as all
separators are ASCII, cutting UTF-8 bytes gives the same words as cutting code
points.  Null texts count as empty.  Hashes are 64-bit and depend on nothing
but the bytes, so they agree between executors and retries.
"""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one numpy step works on; a longer document is a step of its own.
CHUNK_BYTES = 1 << 19

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
#: Bytes from which a span is hashed by itself, and bytes of a window of window_hash.
LONG, WINDOW = 128, 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's bounds; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give free memory back to the system: a worker goes on to other stages, and would hold its highest use."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, upto - at)
            at = upto
    release()


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, zeros behind the end."""
    own = np.zeros(len(data) + 8, np.uint8)
    own[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", own, strides=(1,))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes wherever they stand.

    Eight bytes at a time go through the finaliser, so that no structure of the text survives;
    spans of LONG bytes and more are hashed by BLAKE2.  Other seeds give independent hashes.
    """
    size = (end - start).astype(np.int64)
    out = mix(size.astype(np.uint64) * _FACTOR + np.uint64(seed))
    live = np.flatnonzero((size > 0) & (size < LONG))
    eights, at, left = _eights(data), start[live], size[live]
    while len(live):
        part = eights[at]
        short = left < 8
        part[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        out[live] = mix(out[live] * _BASE ^ part)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    long = np.flatnonzero(size >= LONG)
    if len(long):
        view, key = memoryview(np.ascontiguousarray(data)), seed.to_bytes(8, "little")
        out[long] = [int.from_bytes(hashlib.blake2b(view[s:e], digest_size=8, salt=key).digest(), "little") for s, e in zip(start[long].tolist(), end[long].tolist(), strict=True)]
    return out


def window_hash(data: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the WINDOW bytes from each place on, by doubling: every step mixes, none only adds."""
    out, size = _eights(data)[: max(0, len(data) - 7)] ^ np.uint64(seed), 8
    while True:
        out = (out ^ (out >> np.uint64(29))) * _FACTOR
        if size == WINDOW:
            out ^= out >> np.uint64(32)
            out *= _BASE
            return out ^ (out >> np.uint64(29))
        out = (out[: max(0, len(out) - size)] * _BASE) ^ out[size:]
        size *= 2


def windows_span(windows: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of WINDOW bytes or more, from the windows that cover them."""
    out = mix((end - start).astype(np.uint64) * _FACTOR)
    at, live = start.astype(np.int64), np.arange(len(start))
    while len(live):
        out[live] = mix(out[live] * _BASE ^ windows[np.minimum(at[live], end[live] - WINDOW)])
        at[live] += WINDOW
        live = live[at[live] < end[live]]
    return out


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_sep: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and row of every word, in order."""
    inside = ~is_sep[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def gram_hash(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of n words that stay inside a row, and the index of each one's first word."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(rows[: len(rows) - n + 1] == rows[n - 1 :])
    return gram_hash_at(words, first, n), first


def gram_hash_at(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of n words from these places on."""
    total = np.zeros(len(first), np.uint64)
    for k in range(n):
        total = total * _BASE + words[first + k]
    return mix(total)


def code_points(data: np.ndarray) -> np.ndarray:
    """True where a byte begins a code point."""
    return (data & 0xC0) != 0x80


def rows_sum(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of mask over each row's bytes."""
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
