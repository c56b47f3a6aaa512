"""Pack token ids of documents into rows of one length, best fit decreasing.

Documents are dealt to groups of bounded size by a hash; each group is packed on its
own, so that a group costs at most one row that could have been fuller. Pieces go
from long to short into the row with the least room that still holds them, found by
a segment tree over the room left. A document longer than a row fills whole rows
first, and its rest is packed like any other piece; nothing is cut off.

A packed row has its ids (little-endian 16- or 32-bit, padded to the row's length),
the cumulative lengths of its segments, and the places where positions start anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.bpe import codec, read_ranks
from tallygrid.llm.frames import small_batches
from tallygrid.llm.substrings import _marks
from tallygrid.llm.text import chunks

ROW_TOKENS = 8192
# Tokens of a group, which a task holds in memory.
GROUP_TOKENS = 16 << 20

# The byte vocabulary: padding, end of text, unknown, then the 256 bytes.
PAD, EOS, FIRST_BYTE = 0, 1, 3


def byte_ids(text: str) -> np.ndarray:
    """A text's UTF-8 bytes as ids, then the end."""
    raw = np.frombuffer(text.encode(), np.uint8)
    out = np.empty(len(raw) + 1, np.uint16)
    out[:-1] = raw
    out[:-1] += FIRST_BYTE
    out[-1] = EOS
    return out


def text_of(ids: np.ndarray) -> str:
    """The text of byte ids; padding and ends are skipped."""
    ids = ids[ids >= FIRST_BYTE] - FIRST_BYTE
    return ids.astype(np.uint8).tobytes().decode()


class TokenIds:
    """A text's BPE ids as unsigned 32-bit integers, then the end; the end and the padding follow the vocabulary.

    The vocabulary file is read by the worker that encodes first.
    """

    def __init__(self, path: str, pattern: str) -> None:
        self.path, self.pattern = path, pattern
        self.eos = max(read_ranks(path).values()) + 1
        self.pad = self.eos + 1

    def __call__(self, text: str) -> np.ndarray:
        return self.batch(pa.array([text], pa.string()))[0]

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of several texts, of which null counts as empty."""
        ids = codec(self.path, self.pattern).encode_all(texts)
        return [np.append(np.frombuffer(i, "<u4"), np.uint32(self.eos)) for i in ids]

    def bytes_of(self, ids: np.ndarray) -> bytes:
        """The text's bytes; padding and ends are skipped."""
        return codec(self.path, self.pattern).decode_bytes(ids[ids < self.eos].tolist())


class Room:
    """Rows by the room they have left, in a segment tree of counts."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def add(self, row: int, room: int) -> None:
        if room:
            self.rows.setdefault(room, []).append(row)
            self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """A row with the least room of at least `length`, and that room; None if there is none."""
        at = length + self.size
        if not self.count[at]:
            # Up to the first right sibling that has rows, then down its left-most path.
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        self._change(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The row of each piece; lengths have to come in decreasing order and fit a row."""
    room, out, n_rows = Room(capacity), [], 0
    for length in lengths:
        found = room.take(length)
        if found is None:
            found = n_rows, capacity
            n_rows += 1
        out.append(found[0])
        room.add(found[0], found[1] - length)
    return out


_NAMES = ["pack_id", "n_tokens", "n_segments", "ids", "cu_seqlens", "position_resets", "doc_ids", "marks", "pieces"]
_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
_SCHEMA = "pack_id long, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, marks array<long>, pieces array<int>"


def _pack(encode: Callable[[str], np.ndarray], capacity: int, pad: int):
    def rows(group: int, pieces: list[tuple]) -> Iterator[tuple]:
        """pieces: (length, doc_id, mark, number, ids)."""
        pieces.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2], p[3]))
        content: dict[int, list[tuple]] = {}
        for piece, row in zip(pieces, best_fit_decreasing([p[0] for p in pieces], capacity)):
            content.setdefault(row, []).append(piece)
        for row, own in content.items():
            edges = np.concatenate([[0], np.cumsum([p[0] for p in own])]).tolist()
            ids = np.full(capacity, pad, own[0][4].dtype)
            for a, p in zip(edges, own):
                ids[a : a + p[0]] = p[4]
            packed = ids.astype(ids.dtype.newbyteorder("<")).tobytes()
            yield group << 32 | row, edges[-1], len(own), packed, edges, edges[:-1], [p[1] for p in own], [p[2] for p in own], [p[3] for p in own]

    def each(texts: pa.Array) -> list[np.ndarray]:
        return [encode(text or "") for text in texts.to_pylist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pieces, encode_all = TaskContext.get().partitionId(), [], getattr(encode, "batch", each)
        for batch in chunks(batches, keep=True):
            texts = batch.column("text")
            for doc_id, mark, ids in zip(batch.column("doc_id").to_pylist(), _marks(texts).tolist(), encode_all(texts)):
                pieces += [(len(ids[a : a + capacity]), doc_id, mark, a // capacity, ids[a : a + capacity]) for a in range(0, len(ids), capacity)]
        out = []
        for row in rows(group, pieces):
            out.append(row)
            if len(out) == 128:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], _NAMES)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], _NAMES)

    return run


def pack(docs: DataFrame, row_tokens: int = ROW_TOKENS, group_tokens: int = GROUP_TOKENS, encode: Callable[[str], np.ndarray] = byte_ids, pad: int = PAD) -> DataFrame:
    """One row per packed row: pack_id, n_tokens, n_segments, ids, cu_seqlens, position_resets, doc_ids, marks, pieces.

    segment k of a row is ids[cu_seqlens[k] : cu_seqlens[k + 1]], piece pieces[k] of
    document doc_ids[k]; marks tell rows that repeat a doc_id with another text apart.
    Null and empty texts are their end alone, so every document is in some row. Equal
    lengths are packed by doc_id, null last. `encode` gives a text's ids as numpy
    integers and must give at least one; where it has a method `batch`, that is asked for the ids
    of several texts (an Arrow array, null for empty). Rows are padded with `pad`. No documents
    give no rows. Runs one job to learn the size of the texts.
    """
    small_batches(docs)
    n_bytes = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n_groups = max(1, -(-int(n_bytes) // group_tokens))
    dealt = docs.select("doc_id", "text").repartition(n_groups, F.xxhash64("doc_id", "text"))
    return dealt.mapInArrow(_pack(encode, row_tokens, pad), _SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet: the ids of a file are a matrix of rows of one length."""
    packed.write.mode("overwrite").parquet(path)


def byte_text(ids: np.ndarray) -> bytes:
    """The bytes of byte ids; padding and ends are skipped."""
    return (ids[ids >= FIRST_BYTE] - FIRST_BYTE).astype(np.uint8).tobytes()


def unpack(packed: DataFrame, dtype: str = "<u2", decode: Callable[[np.ndarray], bytes] = byte_text) -> DataFrame:
    """(doc_id, mark, text) again, by default from byte ids: pieces are put together in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, numbers, pieces = [], [], [], []
            for raw, edges, doc_ids, own, order in zip(*(batch.column(c).to_pylist() for c in ("ids", "cu_seqlens", "doc_ids", "marks", "pieces"))):
                row = np.frombuffer(raw, dtype)
                ids += doc_ids
                marks += own
                numbers += order
                pieces += [decode(row[a:b]) for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(numbers, pa.int32()), pa.array(pieces, pa.binary())], ["doc_id", "mark", "piece", "bytes"])

    parts = packed.mapInArrow(run, "doc_id long, mark long, piece int, bytes binary")
    listed = parts.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set(F.struct("piece", "bytes"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["bytes"]))
    return listed.select("doc_id", "mark", joined.cast("string").alias("text"))
