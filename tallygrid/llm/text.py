"""Words and hashes of whole Arrow text columns, computed on the UTF-8 bytes without per-word Python.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab,
form feed and carriage return; a null text has no words.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

# Bytes of text that are worked on at once; a single longer text is taken whole.
SLICE_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """n fixed 64-bit numbers for a seed."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003 + 1)) * _M1)


_kept: list = []


def kept(key: tuple, build):
    """What `build` returned for this key in an earlier task of the worker. One object is kept, so that models of several operators do not add up."""
    if not _kept or _kept[0] != key:
        _kept.clear()
        _kept.extend([key, build()])
    return _kept[1]


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on for the tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = SLICE_BYTES, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The rows again, in slices of about max_bytes of text, so that arrays per byte stay small.

    A task that does not `keep` what an earlier operator left in the worker frees it.
    """
    if not keep and _kept:
        _kept.clear()
        release()
    try:
        for batch in batches:
            for at, to in ranges(batch.column(column), max_bytes):
                yield batch.slice(at, to - at)
    finally:
        release()


def ranges(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """First and last row (exclusive) of slices of about max_bytes."""
    ends, at = np.cumsum(lengths(texts)), 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield at, to
        at = to


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = SLICE_BYTES, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The rows again, small batches put together to about max_bytes of text and large ones sliced."""
    waiting, held = [], 0
    for batch in slices(batches, column, max_bytes, keep):
        size = int(lengths(batch.column(column)).sum())
        if waiting and held + size > max_bytes:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting, held = [], 0
        waiting.append(batch)
        held += size
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text."""
    return np.diff(utf8(texts)[1])


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its n + 1 offsets; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    _, where, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; no word crosses a row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~SPACE[data]
    before, after = np.empty_like(solid), np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    after[-1], after[:-1] = False, solid[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    size = (ends - starts).astype(np.int64)
    out = (size.astype(np.uint64) + np.uint64(seed)) * _M1
    at, left, live = starts.copy(), size.copy(), None
    while len(at):
        piece = eights[at] & _MASK[np.minimum(left, 8)]
        if live is None:
            out = mix(out ^ piece)
        else:
            out[live] = mix((out[live] * _M1) ^ piece)
        more = left > 8
        live = np.flatnonzero(more) if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def row_starts(rows: np.ndarray) -> np.ndarray:
    """Where each run of equal row numbers begins."""
    if not len(rows):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(rows[1:] != rows[:-1]) + 1])


def grams(hashes: np.ndarray, rows: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each position on, and the positions where n words of one row follow."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = seeded(seed + 17, n) | np.uint64(1)
    many = len(hashes) - n + 1
    total = np.zeros(many, np.uint64)
    for j in range(n):
        total += hashes[j : j + many] * keys[j]
    at = np.flatnonzero(rows[:many] == rows[n - 1 :])
    return mix(total[at]), at


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return hashes.view(np.int64)
