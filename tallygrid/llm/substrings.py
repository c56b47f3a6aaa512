"""Substring dedup by level-wise doubling of repeated word windows.

The ladder of lengths ends at the asked window and each length is at most twice the
one before (7, 13 by default). A window can only repeat in another document if the
shorter windows inside it do, so each level looks at the windows that passed the
level below, and stops when none is left.

At the first level every full window is represented by one window of the short
length inside it, the one with the smallest hash: equal full windows choose the same
one, and neighbouring windows share it, so about a quarter of the positions is
posted instead of all. Which hashes repeat is told to the next level by a bitmap of
bounded size; what passes it falsely costs rows, not results.

The last level finds the first document of every window that is left, repeated or
not, and tells each document the windows that it is the first for. The others that
are left occur in an earlier document. So no window travels with its place.

Windows are told apart by a 64-bit hash of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm import bitmap
from tallygrid.llm.frames import small_batches
from tallygrid.llm.text import grams, signed, chunks, utf8, word_hashes, words
from tallygrid.session import materialize

WINDOW, FIRST = 13, 7
# Orders after every other id.
NO_ID = (1 << 63) - 1


def ladder(window: int, first: int) -> list[int]:
    """Lengths from `first` to the window, none more than twice the one before."""
    out = [window]
    while out[0] > first:
        out.insert(0, max(first, -(-out[0] // 2)))
    return out


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(NO_ID).to_numpy()


def _chosen(short: np.ndarray, starts: np.ndarray, full: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each full window, the smallest hash of a short window inside it and where that starts (the first of equals)."""
    best, at = short[starts].copy(), starts.copy()
    for j in range(1, full - length + 1):
        h = short[starts + j]
        less = h < best
        best[less] = h[less]
        at[less] = starts[less] + j
    return best, at


class Windows:
    """The full windows of a batch of texts that pass the lower levels, with the hash to post at one level."""

    def __init__(self, texts: pa.Array, steps: list[int]) -> None:
        data, offsets = utf8(texts)
        self.starts, self.ends, self.rows = words(data, offsets)
        self.hashes = word_hashes(data, self.starts, self.ends)
        self.steps, self.full = steps, steps[-1]
        many = len(self.hashes) - self.full + 1
        self.at = np.flatnonzero(self.rows[:many] == self.rows[self.full - 1 :]) if many > 0 else np.zeros(0, np.int64)

    def level(self, k: int, passed: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows left at level k and the hashes of their representatives."""
        at, inner = self.at, None
        for step in range(k + 1):
            length = self.steps[step]
            if length == self.full:
                return at, self._hash(length)[at] if len(at) else np.zeros(0, np.uint64)
            if not len(at):
                return at, np.zeros(0, np.uint64)
            short = self._hash(length)
            if inner is None:
                best, inner = _chosen(short, at, self.full, length)
            else:  # grow around the representative, inside the full window
                inner = np.minimum(inner, at + self.full - length)
                best = short[inner]
            if step == k:
                return at, best
            keep = bitmap.has(passed[step], best)
            at, inner = at[keep], inner[keep]
        raise AssertionError("no such level")

    def _hash(self, length: int) -> np.ndarray:
        """Hash of the window that starts at each word; positions near a row's end hold what crosses it and are not used."""
        out = np.zeros(len(self.hashes), np.uint64)
        h, at = grams(self.hashes, self.rows, length, seed=length)
        out[at] = h
        return out


def _post(steps: list[int], k: int, shared):
    """Each hash of level k with the smallest and largest id that has it, folded per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = Windows(batch.column("text"), steps)
            at, h = found.level(k, [s.value for s in shared])
            if not len(at):
                continue
            ids = _ids(batch)[found.rows[at]]
            order = np.lexsort((ids, h))
            h, ids = h[order], ids[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            last = np.concatenate([first[1:], [len(h)]]) - 1
            yield pa.RecordBatch.from_arrays([pa.array(signed(h[first])), pa.array(ids[first]), pa.array(ids[last])], ["h", "low", "high"])

    return run


def _marks(texts: pa.Array) -> np.ndarray:
    """A hash of each whole text, which tells rows that repeat a doc_id apart."""
    data, offsets = utf8(texts)
    return signed(word_hashes(data, offsets[:-1], offsets[1:], seed=3))


def _firsts(steps: list[int], shared):
    """Each full window left at the last level with the smallest id of the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _post(steps, len(steps) - 1, shared)(batches):
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("low")], ["h", "id"])

    return run


def repeated(docs: DataFrame, window: int = WINDOW, first: int = FIRST) -> tuple[list[int], list] | None:
    """The ladder and the bitmaps of its lower levels; None if nothing repeats."""
    small_batches(docs)
    spark = docs.sparkSession
    source = docs.select("doc_id", "text")
    steps, shared = ladder(window, first), []
    for k in range(len(steps) - 1):
        posted = source.mapInArrow(_post(steps, k, list(shared)), "h long, low long, high long")
        again = materialize(posted.groupBy("h").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("h"), f"repeated-{steps[k]}")
        n = again.count()
        if not n:
            return None
        shared.append(spark.sparkContext.broadcast(bitmap.build(again, "h", bitmap.bits_for(n))))
    return steps, shared


def _cut(steps: list[int], shared):
    full = steps[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = Windows(batch.column("text"), steps)
            free = np.ones(len(found.hashes), bool)
            if shared is not None:
                at, h = found.level(len(steps) - 1, [s.value for s in shared])
                gone = at[~_own(found.rows[at], h, batch.column("firsts"))]
                edge = np.zeros(len(free) + 1, np.int32)
                np.add.at(edge, gone, 1)
                np.add.at(edge, gone + full, -1)
                free = np.cumsum(edge[:-1]) == 0
            n_words = np.bincount(found.rows, minlength=batch.num_rows)
            n_removed = np.bincount(found.rows[~free], minlength=batch.num_rows)
            texts, offsets = _joined(utf8(batch.column("text"))[0], found, free, batch.num_rows)
            kept = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(offsets), pa.py_buffer(texts)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n_removed.astype(np.int64)), kept], ["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def _own(rows: np.ndarray, h: np.ndarray, firsts: pa.Array) -> np.ndarray:
    """Whether each window is among those that its own document is the first for."""
    lists = firsts.fill_null([]) if firsts.null_count else firsts
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(firsts)), np.diff(lists.offsets.to_numpy()))
    out = np.zeros(len(h), bool)
    if not len(values) or not len(h):
        return out
    # Both sides as (row, hash) in one order.
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    begin, end = np.searchsorted(owner, np.arange(len(firsts))), np.searchsorted(owner, np.arange(len(firsts)), "right")
    ask = signed(h)
    edges = np.concatenate([[0], np.flatnonzero(rows[1:] != rows[:-1]) + 1, [len(rows)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = values[begin[rows[a]] : end[rows[a]]]
        if len(own):
            spot = np.minimum(np.searchsorted(own, ask[a:b]), len(own) - 1)
            out[a:b] = own[spot] == ask[a:b]
    return out


def _joined(data: np.ndarray, found: Windows, free: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The free words of each row joined by one blank: bytes and offsets."""
    starts, ends, rows = found.starts[free], found.ends[free], found.rows[free]
    size = ends - starts + 1  # each word with a blank after it
    after = np.cumsum(size)
    out = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
    solid = np.ones(len(out), bool)
    solid[after - 1] = False
    shift = np.repeat(starts - (after - size), size)
    out[solid] = data[(np.arange(len(out)) + shift)[solid]]
    # The blank after a row's last word goes.
    last = np.flatnonzero(np.concatenate([rows[1:] != rows[:-1], [True]])) if len(rows) else np.zeros(0, np.int64)
    keep = np.ones(len(out), bool)
    keep[after[last] - 1] = False
    many = np.zeros(n_rows, np.int64)
    many[rows[last]] = np.diff(np.concatenate([[0], after[last]])) - 1
    return out[keep], np.concatenate([[0], np.cumsum(many)]).astype(np.int64)


def remove_repeats(docs: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (the kept words joined by a blank).

    A word goes if a window of `window` words that covers it also starts in a
    document with a smaller doc_id; windows are those of the input. Repeats inside
    one document stay. Null and empty texts have no words and texts shorter than a
    window lose none. Rows that repeat a doc_id never count as each other's
    original. A null doc_id orders last. Other columns are ignored; no documents
    give no rows. Runs jobs; the levels' repeated hashes are written tables.
    """
    found = repeated(docs, window, first)
    source = docs.select("doc_id", "text")
    if found is None:
        return source.mapInArrow(_cut([window], None), _CUT)
    steps, shared = found
    origin = source.mapInArrow(_firsts(steps, shared), "h long, id long").groupBy("h").agg(F.min("id").alias("id"))
    firsts = origin.groupBy("id").agg(F.collect_list("h").alias("firsts"))  # bounded by one document's words
    texts = source.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    return texts.join(firsts, "id", "left").select("doc_id", "text", "firsts").mapInArrow(_cut(steps, shared), _CUT)


_CUT = "doc_id long, n_words long, n_removed long, kept_text string"


def kept_digests(cut: DataFrame) -> DataFrame:
    """The rows of remove_repeats with kept_sha256 (hex) in place of the text."""
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
