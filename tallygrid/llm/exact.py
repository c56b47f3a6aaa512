"""Exact dedup by Grace hashing: equal content meets in one bucket and is compared byte by byte.

Every task first folds its own copies, so that a text held by a third of all rows
travels once per task. The folded records are dealt to buckets by a digest: their
number follows from the measured bytes, so that a bucket fills half a table, and
Spark's sort brings each bucket's records together, on disk if need be. A bucket fills
an open-addressing table up to a bound on its bytes; contents that find no room are
written to spill files in the shared folder, are measured and dealt anew with another
hash, and the next level works on them alone, until nothing spills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrid.llm.frames import fresh, small_batches
from tallygrid.llm.text import SPACE_BYTES, slices
from tallygrid.session import materialize

# Bytes of content that a bucket's table holds before the rest goes to the next level.
TABLE_BYTES = 64 << 20
# Bytes of content that a task folds before it passes its records on.
FOLD_BYTES = 16 << 20
# What an entry of a table takes besides its content.
ENTRY_BYTES = 200

RECORD = "digest binary, content binary, points long, id long, n_rows long"
GROUP = "digest binary, content binary, points long, id long, n_rows long, spilled boolean, clash boolean"


class Table:
    """Open addressing with linear probing over complete contents."""

    def __init__(self) -> None:
        self.slots = np.full(64, -1, np.int64)
        self.keys: list[bytes] = []
        self.contents: list[bytes] = []
        self.best: list[tuple[int, int]] = []  # (-code points, id): the smallest stays
        self.n_rows: list[int] = []
        self.clash: list[bool] = []
        self.n_bytes = 0

    def find(self, key: bytes, content: bytes) -> tuple[int, int, list[int]]:
        """The entry of a content (or -1), the free slot, and entries with this digest and another content."""
        mask = len(self.slots) - 1
        at = int.from_bytes(key[:8].ljust(8, b"\0"), "little") * 0x9E3779B97F4A7C15 >> 20 & mask
        others = []
        while (entry := int(self.slots[at])) >= 0:
            if self.keys[entry] == key:
                if self.contents[entry] == content:
                    return entry, at, others
                others.append(entry)
            at = at + 1 & mask
        return -1, at, others

    def put(self, slot: int, key: bytes, content: bytes, best: tuple[int, int], n_rows: int, clash: bool) -> None:
        self.slots[slot] = len(self.keys)
        self.keys.append(key)
        self.contents.append(content)
        self.best.append(best)
        self.n_rows.append(n_rows)
        self.clash.append(clash)
        self.n_bytes += len(content) + ENTRY_BYTES
        if 2 * len(self.keys) > len(self.slots):
            keys, contents = self.keys, self.contents
            self.slots = np.full(4 * len(self.slots), -1, np.int64)
            for entry in range(len(keys)):
                _, free, _ = self.find(keys[entry], contents[entry])
                self.slots[free] = entry

    def add(self, entry: int, best: tuple[int, int], n_rows: int) -> None:
        self.best[entry] = min(self.best[entry], best)
        self.n_rows[entry] += n_rows


# A missing doc_id orders after every other.
NO_ID = (1 << 63) - 1


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(None, SPACE_BYTES)


def _emit(rows: list[tuple], names: list[str], kinds: list[pa.DataType], per_batch: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), per_batch):
        columns = zip(*rows[at : at + per_batch])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _fold(key_bytes: int, fold_bytes: int):
    names, kinds = ["digest", "content", "points", "id", "n_rows"], [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def out(table: Table) -> Iterator[pa.RecordBatch]:
        rows = [(k, c, -b[0], b[1], n) for k, c, b, n in zip(table.keys, table.contents, table.best, table.n_rows)]
        return _emit(rows, names, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                content = normalised(text)
                key = hashlib.sha256(content).digest()[:key_bytes]
                best = (-len(text or ""), NO_ID if doc_id is None else doc_id)
                entry, slot, _ = table.find(key, content)
                if entry >= 0:
                    table.add(entry, best, 1)
                else:
                    table.put(slot, key, content, best, 1, False)
            if table.n_bytes > fold_bytes:
                yield from out(table)
                table = Table()
        yield from out(table)

    return run


def _resolve(table_bytes: int):
    names = ["digest", "content", "points", "id", "n_rows", "spilled", "clash"]
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]

    def out(table: Table) -> Iterator[pa.RecordBatch]:
        rows = [(k, c if x else None, -b[0], b[1], n, False, x) for k, c, b, n, x in zip(table.keys, table.contents, table.best, table.n_rows, table.clash)]
        return _emit(rows, names, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, own = Table(), None
        for batch in slices(batches, "content"):
            spill = []
            for key, content, points, doc_id, n_rows, clash, bucket in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if bucket != own:
                    yield from out(table)
                    table, own = Table(), bucket
                entry, slot, others = table.find(key, content)
                for other in others:
                    table.clash[other] = clash = True
                if entry >= 0:
                    table.add(entry, (-points, doc_id), n_rows)
                    table.clash[entry] |= clash
                elif table.n_bytes < table_bytes:
                    table.put(slot, key, content, (-points, doc_id), n_rows, clash)
                else:
                    spill.append((key, content, points, doc_id, n_rows, True, clash))
            yield from _emit(spill, names, kinds)
        yield from out(table)

    return run


def _partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle before adaptive execution merges the small ones."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or spark.conf.get("spark.sql.shuffle.partitions"))


def _bytes(df: DataFrame, column: str) -> int:
    """Bytes that a column's values take in tables, copies included."""
    return df.agg(F.sum(F.coalesce(F.octet_length(column), F.lit(0)) + ENTRY_BYTES)).first()[0] or 0


def groups(docs: DataFrame, table_bytes: int = TABLE_BYTES, fold_bytes: int = FOLD_BYTES, key_bytes: int = 32) -> DataFrame:
    """One row per different normalised content: digest, id of the row that stays, rows.

    `clash` marks contents that share a digest with another one; those rows carry the content.
    """
    records = docs.select("doc_id", "text").mapInArrow(_fold(key_bytes, fold_bytes), RECORD).withColumn("clash", F.lit(False))
    done, level, n_bytes = None, 0, _bytes(docs, "text")
    parts = _partitions(docs.sparkSession)
    while True:
        buckets = max(parts, -(-2 * n_bytes // table_bytes))
        dealt = records.withColumn("bucket", F.pmod(F.xxhash64("digest", F.lit(level)), F.lit(buckets)))
        dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
        written = materialize(dealt.mapInArrow(_resolve(table_bytes), GROUP), f"grace-{level}")
        resolved = written.filter("NOT spilled").drop("spilled")
        done = resolved if done is None else done.unionByName(resolved)
        spilled = written.filter("spilled")
        n_bytes = _bytes(spilled, "content")
        if not n_bytes:
            return done
        records, level = spilled.select("digest", "content", "points", "id", "n_rows", "clash"), level + 1


def _digests(key_bytes: int, with_content: bool = False):
    """Each row's id and digests, and its normalised content when asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            contents = [normalised(t) for t in batch.column("text").to_pylist()]
            digests = [hashlib.sha256(c).digest() for c in contents]
            columns = {"doc_id": batch.column("doc_id"), "digest": pa.array([d[:key_bytes] for d in digests], pa.binary()), "text_sha256": pa.array([d.hex() for d in digests], pa.string())}
            if with_content:
                columns["content"] = pa.array(contents, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def exact_duplicates(docs: DataFrame, table_bytes: int = TABLE_BYTES, fold_bytes: int = FOLD_BYTES, key_bytes: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without ASCII white space; null counts
    as empty, and all empty texts are one group. Of a group the row with the most
    code points in its original text stays, then the smallest doc_id. Rows that
    repeat a doc_id each get a row, and all of those with the keeping id say
    `kept`. A null doc_id orders last; where it stays, keep_id is null. Other
    columns of `docs` are ignored. No documents give no rows.
    `key_bytes` shortens the digest by which contents are dealt (tests).
    Runs jobs: a scan adds up the bytes of the texts, and every level of the
    partitioning is a written table.
    """
    small_batches(docs)
    found = groups(docs, table_bytes, fold_bytes, key_bytes)
    source = docs.select("doc_id", "text")
    plain = source.mapInArrow(_digests(key_bytes), "doc_id long, digest binary, text_sha256 string")
    joined = plain.join(found.filter("NOT clash").drop("content"), "digest")
    clashing = found.filter("clash")
    if not clashing.isEmpty():
        texts = source.mapInArrow(_digests(key_bytes, with_content=True), "doc_id long, digest binary, text_sha256 string, content binary")
        joined = joined.unionByName(texts.join(clashing, ["digest", "content"]).drop("content"))
    keep = F.when(F.col("id") != NO_ID, F.col("id"))
    return joined.select("doc_id", keep.alias("keep_id"), F.col("n_rows").alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")


def _with_digest(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests = [hashlib.sha256(normalised(t)).hexdigest() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], [*batch.schema.names, name])

    return run


def drop_exact_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, all columns, whatever they are called.

    Of rows that repeat the keeping doc_id with an equal text, the longest original
    stays, then the first by its text.
    """
    key, sha, place = fresh(docs, "keep", "sha", "place")
    stays = exact_duplicates(docs, **options).filter("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(f"{sha}_keep")).distinct()
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{sha}` string"])
    marked = docs.mapInArrow(_with_digest(sha), fields)
    kept = marked.join(stays, marked["doc_id"].eqNullSafe(stays[key]) & (marked[sha] == stays[f"{sha}_keep"]), "left_semi")
    order = Window.partitionBy("doc_id", sha).orderBy(F.length("text").desc_nulls_last(), "text")  # rows of one document
    return kept.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).select(*docs.columns)
