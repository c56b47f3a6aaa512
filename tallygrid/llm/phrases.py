"""Phrase collocations, from counts of n-grams by Rabin-Karp fingerprints.

A text is cut at punctuation into pieces and these into words. Words are lower-cased
and hashed; a prefix polynomial over the word values modulo 2^64 gives the fingerprint
of every n-gram from two of its entries, as the base is odd and has an inverse. So all
n-grams of a chunk are hashed by a few numpy operations.

Counting goes level by level. A phrase that occurs often enough has frequent parts, so
level n posts the n-grams whose two (n-1)-grams passed, told by a bitmap of bounded
size (what it lets through falsely costs rows, not results). Each task folds its
fingerprints per chunk, and the shuffle adds up the counts and keeps a pointer, the
smallest document that holds the fingerprint.

The pointers alone are then turned into text, so that only frequent phrases become
strings, once each. A last pass holds every place with a frequent fingerprint against
the phrase: a second fingerprint, with another word hash and base, has to be that of the
materialised text. Fingerprints with a place that differs are collisions, and for
these the texts at all their places are compared and counted as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm import bitmap
from tallygrid.llm.frames import small_batches
from tallygrid.llm.text import LOWER, chunks, mix, signed, utf8, word_hashes
from tallygrid.session import materialize

LONGEST, LEAST, FIRST = 5, 100, 2000
UNKNOWN = "und"
# Orders after every other id; such a doc_id reads as null in a pointer.
NO_ID = (1 << 63) - 1

BLANK, BREAK = np.zeros(256, bool), np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True

# Base of the polynomial and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
CHECK_BASE = 0xD6E8FEB86659FD93
CHECK_INVERSE = pow(CHECK_BASE, -1, 1 << 64)

# Bytes of text that are hashed at once.
CHUNK_BYTES = 6 << 20


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


class Polynomial:
    """Prefix sums of word values times powers of the base: the hash of any run of words from two entries."""

    def __init__(self, values: np.ndarray, base: int, inverse: int) -> None:
        n = len(values)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _powers(base, n), out=self.prefix[1:])
        self.back = _powers(inverse, n)

    def of(self, at: np.ndarray, n: int) -> np.ndarray:
        return (self.prefix[at + n] - self.prefix[at]) * self.back[at]


class Grams:
    """Words of a chunk of rows and the fingerprints of their n-grams; fewer than 64 bits make them collide, for tests."""

    def __init__(self, texts: pa.Array, langs: pa.Array, bits: int = 64) -> None:
        data, offsets = utf8(texts)
        self.data = LOWER[data]
        self.starts, self.ends, self.rows, self.pieces = _words(self.data, offsets)
        self.names, lang = _coded(langs)
        self.word_lang = lang[self.rows]
        salt = np.array([hash_text(name) for name in self.names], np.uint64)
        self.salt = salt[self.word_lang] if len(self.rows) else np.zeros(0, np.uint64)
        self.polynomial = Polynomial(mix(word_hashes(self.data, self.starts, self.ends)), BASE, INVERSE)
        self.mask = np.uint64((1 << bits) - 1)

    def at(self, n: int) -> np.ndarray:
        """First words of all n-grams within pieces."""
        many = len(self.starts) - n + 1
        if many <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.pieces[:many] == self.pieces[n - 1 :])

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the n-grams that start at these words, different for each lang and length."""
        return mix(mix(self.polynomial.of(at, n) ^ (self.salt[at] + np.uint64(n))) & self.mask)

    def second(self) -> Polynomial:
        """The polynomial of the second fingerprint."""
        return Polynomial(mix(word_hashes(self.data, self.starts, self.ends, seed=77) + np.uint64(1)), CHECK_BASE, CHECK_INVERSE)

    def passing(self, n: int, passed: list[np.ndarray]) -> np.ndarray:
        """First words of the n-grams whose two (n-1)-grams are in the bitmap of that level."""
        at = self.at(n)
        for place in (0, 1):
            if n > 1 and len(at):
                at = at[bitmap.has(passed[n - 2], self.prints(at + place, n - 1))]
        return at


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and piece of every word; rows and breaks begin new pieces."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    cut = BREAK[data]
    solid = ~(cut | BLANK[data])
    before, after = np.empty_like(solid), np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    after[-1], after[:-1] = False, solid[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows, rows + np.cumsum(cut, dtype=np.int32)[starts]  # both only grow, so the sum stays only if both do


def hash_text(name: str) -> int:
    raw = np.frombuffer(name.encode() or b"\0", np.uint8)
    return int(word_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)]), seed=11)[0])


def _coded(langs: pa.Array) -> tuple[list[str], np.ndarray]:
    """Names of the langs and a code for each row; null is `und`."""
    coded = langs.cast(pa.string()).fill_null(UNKNOWN).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def _by_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of rows in the order of their ids, so that a first occurrence in a chunk is that of the smallest id."""
    for batch in chunks(batches, max_bytes=CHUNK_BYTES):
        order = np.argsort(batch.column("doc_id").fill_null(NO_ID).to_numpy(), kind="stable")
        yield batch.take(pa.array(order))


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(NO_ID).to_numpy()


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two."""
    return mix(a ^ mix(b.view(np.uint64) + np.uint64(0x632BE59BD9B4E019)))


_COUNTED = "fp long, n long, doc long, lang string"
_NAMES = ["fp", "n", "doc", "lang"]


def _count(n: int, bits: int, shared):
    """Fingerprints of level n with count and smallest document, folded per chunk; level 1 also counts all words of each lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = [s.value for s in shared]
        for batch in _by_id(batches):
            found = Grams(batch.column("text"), batch.column("lang"), bits)
            at = found.passing(n, passed)
            if len(at):
                prints, first, many = np.unique(found.prints(at, n), return_index=True, return_counts=True)
                docs = _ids(batch)[found.rows[at[first]]]
                yield pa.RecordBatch.from_arrays([pa.array(signed(prints)), pa.array(many), pa.array(docs), pa.nulls(len(many), pa.string())], _NAMES)
            if n == 1 and len(found.names):
                many = np.bincount(found.word_lang, minlength=len(found.names))
                zero = pa.array(np.zeros(len(many), np.int64))
                yield pa.RecordBatch.from_arrays([zero, pa.array(many), zero, pa.array(found.names, pa.string())], _NAMES)

    return run


def _pairs_of(column: str):
    """The hash of fp and another column of a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = _pair(batch.column("fp").to_numpy().view(np.uint64), batch.column(column).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(signed(pair))], ["h"])

    return run


_TEXTS = "fp long, doc long, word long, lang string, size int, phrase string, check long"


def _materialised(bits: int, shared, pointers):
    """The phrases at the pointers: the first place in its document of every frequent fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed, wanted = [s.value for s in shared], pointers.value
        for batch in _by_id(batches):
            found = Grams(batch.column("text"), batch.column("lang"), bits)
            ids, second, names = _ids(batch), None, pa.array(found.names, pa.string())
            begin = np.searchsorted(found.rows, np.arange(batch.num_rows))
            for n in range(1, len(passed) + 1):
                at = found.at(n)
                prints = found.prints(at, n)
                keep = bitmap.has(passed[n - 1], prints)
                at, prints = at[keep], prints[keep]
                pair = _pair(prints, ids[found.rows[at]])
                keep = bitmap.has(wanted, pair)
                _, first = np.unique(pair[keep], return_index=True)
                at, prints = at[keep][first], prints[keep][first]
                if not len(at):
                    continue
                second = second or found.second()
                rows = found.rows[at]
                columns = [signed(prints), ids[rows], at - begin[rows]]
                size = pa.array(np.full(len(at), n, np.int32))
                texts = pa.array(_texts(found, at, n), pa.string())
                lang = names.take(pa.array(found.word_lang[at]))
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), lang, size, texts, pa.array(signed(second.of(at, n)))], _TEXTS.replace(",", "").split()[::2])

    return run


def _differing(bits: int, shared, pairs):
    """Fingerprints of places that passed as frequent but whose second fingerprint is not that of the phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed, known = [s.value for s in shared], pairs.value
        for batch in _by_id(batches):
            found = Grams(batch.column("text"), batch.column("lang"), bits)
            second = found.second()
            for n in range(1, len(passed) + 1):
                at = found.passing(n, passed)
                prints = found.prints(at, n)
                keep = bitmap.has(passed[n - 1], prints)
                at, prints = at[keep], prints[keep]
                strange = ~bitmap.has(known, _pair(prints, signed(second.of(at, n))))
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.unique(prints[strange])))], ["fp"])

    return run


def _compared(bits: int, longest: int, collided):
    """All phrases whose fingerprint collides, as texts, with count and first place, folded per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_id(batches):
            found = Grams(batch.column("text"), batch.column("lang"), bits)
            ids, counts, places = _ids(batch), {}, {}
            begin = np.searchsorted(found.rows, np.arange(batch.num_rows))
            for n in range(1, longest + 1):
                at = found.at(n)
                prints = found.prints(at, n)
                keep = bitmap.has(collided.value, prints)
                at, rows = at[keep], found.rows[at[keep]]
                for fp, lang, text, doc, word in zip(signed(prints[keep]).tolist(), found.word_lang[at].tolist(), _texts(found, at, n), ids[rows].tolist(), (at - begin[rows]).tolist()):
                    key = fp, lang, n, text
                    counts[key] = counts.get(key, 0) + 1
                    places.setdefault(key, (doc, word))
            if counts:
                fp, lang, size, text = zip(*counts)
                doc, word = zip(*places.values())
                columns = [pa.array(fp, pa.int64()), pa.array([found.names[k] for k in lang], pa.string()), pa.array(size, pa.int32()), pa.array(text, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64()), pa.array(doc, pa.int64()), pa.array(word, pa.int64())], ["fp", "lang", "size", "phrase", "n", "doc", "word"])

    return run


def _texts(found: Grams, at: np.ndarray, n: int) -> list[str]:
    """The words of each n-gram joined by one blank."""
    raw, starts, ends = found.data.tobytes(), found.starts, found.ends
    if n == 1:
        return [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
    single = np.ones(len(at), bool)  # one blank between all words, as written
    for j in range(n - 1):
        gap = ends[at + j]
        single &= (starts[at + j + 1] == gap + 1) & (found.data[gap] == 0x20)
    out = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at + n - 1].tolist())]
    for k in np.flatnonzero(~single).tolist():
        spot = at[k]
        out[k] = b" ".join(raw[a:b] for a, b in zip(starts[spot : spot + n].tolist(), ends[spot : spot + n].tolist())).decode()
    return out


def _shared_bitmap(hashes: DataFrame, column: str):
    return hashes.sparkSession.sparkContext.broadcast(bitmap.build(hashes, column, bitmap.bits_for(hashes.count())))


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f, first_doc, first_word) of the phrases of 1 to `longest` words that occur at least
    `least` times in a lang, and (lang, n): all its words.

    Whole texts; A-Z are lower-cased; null and empty texts have no words; a null lang is
    `und`. All rows count, also those that repeat a doc_id. first_doc is the smallest
    doc_id that holds the phrase (null: after all others) and first_word a place in it,
    the first one unless rows repeat that id; no documents give no rows. Runs jobs; each
    level's frequent fingerprints and the phrases are written tables.
    """
    small_batches(docs)
    source = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    shared, levels, words = [], [], None
    for n in range(1, longest + 1):
        posted = source.mapInArrow(_count(n, bits, list(shared)), _COUNTED)
        summed = posted.groupBy("fp", "lang").agg(F.sum("n").alias("a"), F.min("doc").alias("doc"))
        table = materialize(summed.filter((F.col("a") >= least) | F.col("lang").isNotNull()), f"prints-{n}")
        if n == 1:
            words = table.filter("lang IS NOT NULL").select("lang", F.col("a").alias("n"))
        kept = table.filter("lang IS NULL").select("fp", "a", "doc")
        if kept.isEmpty():
            break
        levels.append(kept)
        shared.append(_shared_bitmap(kept, "fp"))
    counted = reduce(DataFrame.unionByName, levels) if levels else table.limit(0).select("fp", "a", "doc")
    # The text of each pointer, once.
    pointers = _shared_bitmap(counted.mapInArrow(_pairs_of("doc"), "h long"), "h")
    texts = source.mapInArrow(_materialised(bits, shared, pointers), _TEXTS).join(counted, ["fp", "doc"])
    first = texts.groupBy("fp", "doc", "a").agg(F.min(F.struct("word", "lang", "size", "phrase", "check")).alias("at"))
    phrases = materialize(first.select("fp", "doc", "a", "at.*"), "phrases")
    # Fingerprints with another text somewhere; what only passed a bitmap falsely is none of the counted.
    pairs = _shared_bitmap(phrases.mapInArrow(_pairs_of("check"), "h long"), "h")
    strange = source.mapInArrow(_differing(bits, shared, pairs), "fp long").distinct()
    collided = materialize(strange.join(counted.select("fp"), "fp", "left_semi"), "collided")
    columns = ["lang", "size", "phrase", F.col("a").alias("f"), F.nullif("doc", F.lit(NO_ID)).alias("first_doc"), F.col("word").alias("first_word")]
    out = phrases.select("fp", *columns)
    if not collided.isEmpty():
        compared = source.mapInArrow(_compared(bits, longest, _shared_bitmap(collided, "fp")), "fp long, lang string, size int, phrase string, n long, doc long, word long")
        exact = compared.join(collided, "fp", "left_semi").groupBy("fp", "lang", "size", "phrase").agg(F.sum("n").alias("a"), F.min(F.struct("doc", "word")).alias("at"))
        exact = materialize(exact.filter(F.col("a") >= least).select("fp", "lang", "size", "phrase", "a", "at.*"), "compared")
        out = out.join(collided, "fp", "left_anti").unionByName(exact.select("fp", *columns))
    for one in (*shared, pointers, pairs):
        one.unpersist()
    return out.drop("fp"), words


def _part(first: Column, many: Column) -> Column:
    return F.array_join(F.slice("words", first, many), " ")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, bits: int = 64) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score, first_doc, first_word) of the phrases that stay: the score is that of the lowest cut.

    A phrase of 2 words or more with count a is cut after each of its words; a cut has
    score floor(1000 * a * n / (l * r)) from the counts of its two parts. A phrase goes
    if a longer one that contains it is as frequent. Arithmetic is that of whole
    decimals, exact for counts up to 10^16. Inputs as in `frequent_phrases`.
    """
    phrases, words = frequent_phrases(docs, longest, least, bits)
    candidates = phrases.filter("size > 1").withColumn("words", F.split("phrase", " "))
    counts = phrases.select("lang", "phrase", "f")
    cuts = candidates.select("lang", "phrase", "size", F.col("f").alias("a"), "first_doc", "first_word", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right")).drop("words")
    for side, name in (("left", "l"), ("right", "r")):
        part = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(part, ["lang", side]).drop(side)
    whole = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "l", "r", "n")}
    score = F.call_function("div", whole["a"] * whole["n"] * F.lit(1000).cast("decimal(4,0)"), whole["l"] * whole["r"])
    scored = cuts.join(words, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "size", "a", "n", "first_doc", "first_word").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Every shorter phrase inside a candidate with the same count.
    spans = [(at, many) for many in range(2, longest) for at in range(1, longest - many + 2)]
    inner = F.filter(F.array(*[F.when((F.col("size") > many) & (F.col("size") >= at + many - 1), _part(F.lit(at), F.lit(many))) for at, many in spans]), lambda p: p.isNotNull())
    covered = candidates.select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("a")).distinct() if spans else None
    kept = best.join(covered, ["lang", "phrase", "a"], "left_anti") if covered is not None else best
    return kept.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score", "first_doc", "first_word")


def first_of_each_lang(scored: DataFrame, first: int = FIRST) -> DataFrame:
    """Each lang's first rows with their rank, by score, then count, both descending, then the phrase in byte order.

    The limit per lang is taken in every task before the shuffle.
    """
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first).withColumn("rank", F.col("rank").cast("long"))
