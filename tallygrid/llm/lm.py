"""Language-model scores of whole documents: a gated recurrent network trained on the corpus itself.

Spark counts every training word. The most frequent words are network ids; all
others are one id, and which of them it is follows their counts. The network is
trained in rounds: each round takes its share of the training documents, every task
trains a copy on the documents of its partition by truncated backpropagation, and
Spark averages the copies by the tokens they saw. Model size, and what the driver
and the executors hold of it, is fixed by the parameters below; counts of words
beyond the bounded table are joined.

Words are told apart by a 64-bit hash of their lower-cased bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.frames import small_batches
from tallygrid.llm.gru import END, OTHER, Network, Trainer, log_probs
from tallygrid.llm.substrings import _ids, _marks
from tallygrid.llm.text import LOWER, chunks, mix, signed, utf8, word_hashes, words
from tallygrid.session import materialize

HEAD, CLASSES, HIDDEN, ROUNDS = 1022, 32, 12, 2
# Words whose counts are sent to every task; the counts of the others are joined.
TABLE = 1 << 18
# Text that is hashed, or scored, side by side, and tokens that are trained on so: with more, fewer steps run for a few long documents alone.
CHUNK_BYTES, SCORE_BYTES, TRAIN_TOKENS = 6 << 20, 12 << 20, 4 << 20
# Parameters of one row when networks are averaged.
BLOCK = 8192
LN10 = float(np.log(10))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, rows = words(data, offsets)
    return rows, word_hashes(data, starts, ends)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, max_bytes=CHUNK_BYTES):
        h, n = np.unique(_tokens(batch.column("text"))[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(n.astype(np.int64))], ["h", "n"])


class Table:
    """Open addressing from word hashes to positions, probed for many words at once."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        size = 1 << max(4, int(4 * len(hashes)).bit_length())
        self.slots, self.mask = np.full(size, -1, np.int64), np.uint64(size - 1)
        left, at = np.arange(len(hashes)), mix(hashes)
        while len(left):
            spot = (at & self.mask).astype(np.int64)
            free = self.slots[spot] < 0
            self.slots[spot[free]] = left[free]  # of several for one slot, the last stays
            put = self.slots[spot] == left
            left, at = left[~put], at[~put] + np.uint64(1)

    def find(self, words_: np.ndarray) -> np.ndarray:
        """The position of each word, or -1."""
        out = np.full(len(words_), -1, np.int64)
        if not len(self.hashes):
            return out
        left, at = np.arange(len(words_)), mix(words_)
        while len(left):
            entry = self.slots[(at & self.mask).astype(np.int64)]
            hit = (entry >= 0) & (self.hashes[entry] == words_[left])
            out[left[hit]] = entry[hit]
            more = (entry >= 0) & ~hit
            left, at = left[more], at[more] + np.uint64(1)
        return out


class Corpus:
    """What training gathers: totals, the bounded table of frequent words, and the network."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, n_docs: int, n_tokens: int, n_types: int, head: int, classes: int, hidden: int) -> None:
        self.hashes, self.counts = hashes, counts
        self.n_docs, self.n_tokens, self.n_types = n_docs, n_tokens, n_types
        self.head = min(head, len(hashes))
        own = counts[: self.head]
        self.other = n_tokens - n_docs - int(own.sum())
        self.other_types = n_types - (n_docs > 0) - self.head
        self.vocabulary = np.concatenate([[n_docs, self.other], own]).astype(float)
        self.classes, self.hidden = classes, hidden
        self.flat: np.ndarray | None = None

    def network(self) -> Network:
        return Network(self.vocabulary, self.classes, self.hidden, self.flat)

    def targets(self, entry: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Network ids of each row's words and its end, and tokens per row."""
        many = np.bincount(rows, minlength=n_rows) + 1
        ids = np.full(len(rows) + n_rows, END, np.int32)
        known = (entry >= 0) & (entry < self.head)
        ids[np.arange(len(rows)) + rows] = np.where(known, entry + 2, OTHER)
        return ids, many


def _train(shared, squares: np.ndarray | None):
    names = ["block", "part", "weight", "flat", "squares"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus: Corpus = shared.value
        trainer, table, seen = Trainer(corpus.network(), squares), Table(corpus.hashes), 0
        first, waiting, held = 0, [], 0

        def learn() -> None:
            trainer.train(*(np.concatenate(x) for x in zip(*waiting)))
            waiting.clear()

        for batch in chunks(batches, max_bytes=CHUNK_BYTES):
            rows, h = _tokens(batch.column("text"))
            waiting.append(corpus.targets(table.find(h), rows, batch.num_rows))
            first = first or int(_marks(batch.column("text"))[0]) & 63
            seen, held = seen + len(waiting[-1][0]), held + len(waiting[-1][0])
            if held >= TRAIN_TOKENS:
                learn()
                held = 0
        if waiting:
            learn()
        if seen:
            at = range(0, len(trainer.net.flat), BLOCK)
            flat = [trainer.net.flat[i : i + BLOCK].astype("<f4").tobytes() for i in at]
            square = [trainer.squares[i : i + BLOCK].astype("<f4").tobytes() for i in at]
            n = len(flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, first, np.int32)), pa.array(np.full(n, float(seen))), pa.array(flat, pa.binary()), pa.array(square, pa.binary())], names
            )

    return run


_NETWORK = "block int, part int, weight double, flat binary, squares binary"


def _average(key: tuple, rows: pa.Table) -> pa.Table:
    """The mean of some copies of one block, weighted by the tokens each has seen."""
    weight, total = rows.column("weight").to_numpy(), None
    for w, a, b in zip(weight, rows.column("flat").to_pylist(), rows.column("squares").to_pylist()):
        both = np.stack([np.frombuffer(a, "<f4"), np.frombuffer(b, "<f4")]).astype(float) * w
        total = both if total is None else total + both
    flat, square = (total / weight.sum()).astype("<f4")
    first = rows.slice(0, 1)
    columns = {"weight": pa.array([float(weight.sum())]), "flat": pa.array([flat.tobytes()], pa.binary()), "squares": pa.array([square.tobytes()], pa.binary())}
    return pa.table({c: columns.get(c, first.column(c)) for c in rows.column_names})


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, at most `most` of them and all down to some count, most frequent first.

    The count is one of an eighth of a power of two, so that a few hundred sums
    tell it and no task has to sort the words of all.
    """
    grade = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.groupBy(grade.alias("g")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.col("g").desc()).collect()
    least, held = None, 0
    for g, c in steps:
        if held + c > most:
            break
        least, held = g, held + c
    rows = counts.filter(grade >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    h, n = rows.column("h").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.lexsort((h, -n))
    return h[order], n[order]


def fit(training: DataFrame, head: int = HEAD, classes: int = CLASSES, hidden: int = HIDDEN, rounds: int = ROUNDS, table: int = TABLE) -> tuple[Corpus, DataFrame]:
    """Learn from the texts of all rows: what tasks need of the corpus, and the counts (h, n) of all words.

    Every training document is counted and is trained on in exactly one round. Two
    levels of averaging keep each group of copies small. Without rows the corpus is
    empty and every base score is 0.
    """
    small_batches(training)
    spark = training.sparkSession
    source = training.select("doc_id", "text")
    counts = materialize(source.mapInArrow(_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")
    n_docs = source.count()
    n_words, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hashes, own = _frequent(counts, table)
    corpus = Corpus(hashes, own, n_docs, n_words + n_docs, n_types + (n_docs > 0), head, classes, hidden)
    squares = None
    for turn in range(rounds if n_docs else 0):
        shared = spark.sparkContext.broadcast(corpus)
        part = source.filter(F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text"), F.lit(rounds)) == turn)
        copies = part.mapInArrow(_train(shared, squares), _NETWORK)
        few = copies.groupBy("block", "part").applyInArrow(_average, _NETWORK)
        blocks = few.groupBy("block").applyInArrow(_average, _NETWORK).orderBy("block").collect()  # the size of one network
        if blocks:
            corpus = Corpus(corpus.hashes, corpus.counts, n_docs, corpus.n_tokens, corpus.n_types, head, classes, hidden)
            corpus.flat = np.frombuffer(b"".join(b.flat for b in blocks), "<f4")
            squares = np.frombuffer(b"".join(b.squares for b in blocks), "<f4")
    return corpus, counts


def _score(shared):
    names = ["doc_id", "id", "mark", "n_tokens", "n_known", "n_rare", "sum_log", "sum_log_other", "n_other", "log_model", "rare_h", "rare_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus: Corpus = shared.value
        net, table = corpus.network(), Table(corpus.hashes)
        log_count = np.log10(corpus.counts + 0.1) if len(corpus.counts) else np.zeros(1)
        for batch in chunks(batches, max_bytes=SCORE_BYTES):
            n = batch.num_rows
            rows, h = _tokens(batch.column("text"))
            entry = table.find(h)
            ids, many = corpus.targets(entry, rows, n)
            found = entry >= 0
            logs = np.where(found, log_count[entry], 0.0)
            beyond = entry >= corpus.head
            add = lambda x, w=None: np.bincount(x, weights=w, minlength=n)
            whole = [add(rows[found]), add(rows[~found])]
            sums = [add(rows, logs), add(rows[beyond], logs[beyond])]
            n_other = add(rows[~found | beyond])
            rare = _rare(rows[~found], h[~found], n)
            del rows, h, entry, found, beyond, logs
            log_p = np.add.reduceat(log_probs(net, ids, many), np.cumsum(many) - many)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_ids(batch)), pa.array(_marks(batch.column("text"))), pa.array(many.astype(np.int64))]
                + [pa.array(x.astype(np.int64)) for x in whole]
                + [pa.array(x.astype(float)) for x in sums]
                + [pa.array(n_other.astype(np.int64)), pa.array(log_p), *rare],
                names,
            )

    return run


def _rare(rows: np.ndarray, h: np.ndarray, n: int) -> list[pa.Array]:
    """Words beyond the table: different hashes and their times, a list for each row."""
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([first, [len(h)]]))
    offsets = pa.array(np.searchsorted(rows[first], np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(signed(h[first]))), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))]


def score(docs: DataFrame, corpus: Corpus, counts: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    base_score sums log10((c + 0.1) / (N + 0.1 (V + 1))) over the words and the end;
    score is the network's log10 probability of the whole text, in which a word
    outside its vocabulary costs the probability of `other` times its smoothed share
    of the counts there. Null and empty texts are their end alone. Repeated rows are
    scored each; a null doc_id is kept. No documents give no rows. Runs a job: scores
    and rare words of each document are a written table, which is read for both.
    """
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(corpus)
    source = docs.select("doc_id", "text")
    each = source.mapInArrow(
        _score(shared),
        "doc_id long, id long, mark long, n_tokens long, n_known long, n_rare long, sum_log double, sum_log_other double, n_other long, log_model double, rare_h array<long>, rare_n array<int>",
    )
    each = materialize(each, "scored")
    rare = each.select("id", "mark", F.inline(F.arrays_zip("rare_h", "rare_n"))).select(F.col("rare_h").alias("h"), "id", "mark", F.col("rare_n").alias("times"))
    met = rare.join(counts, "h", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    of_rare = met.groupBy("id", "mark").agg(
        F.sum("times").alias("times"), F.sum(F.col("times") * F.log10(F.col("c") + 0.1)).alias("logs"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known")
    )
    both = each.join(of_rare, ["id", "mark"], "left")
    # Rows that repeat an id and a text have added up their rare words: take one row's part.
    part = F.when(F.coalesce("times", F.lit(0)) > 0, F.col("n_rare") / F.col("times")).otherwise(0.0)
    rare_logs, rare_known = F.coalesce("logs", F.lit(0.0)) * part, F.coalesce("known", F.lit(0)) * part
    end_known = 1 if corpus.n_docs else 0
    end_log = float(np.log10(corpus.n_docs + 0.1))
    base_all = float(np.log10(corpus.n_tokens + 0.1 * (corpus.n_types + 1)))
    other_all = float(np.log10(corpus.other + 0.1 * (corpus.other_types + 1)))
    return both.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.round(rare_known).cast("long") + end_known).alias("n_known"),
        F.lit(corpus.n_tokens).cast("long").alias("train_tokens"),
        (F.col("sum_log") + rare_logs + end_log - F.col("n_tokens") * base_all).alias("base_score"),
        (F.col("log_model") / LN10 + F.col("sum_log_other") + rare_logs - F.col("n_other") * other_all).alias("score"),
    )


def score_documents(docs: DataFrame, is_training: Column, **options) -> DataFrame:
    """Learn from the documents of a condition and score all: see `score`."""
    corpus, counts = fit(docs.filter(is_training), **options)
    return score(docs, corpus, counts)
