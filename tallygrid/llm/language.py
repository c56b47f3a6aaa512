"""Language identification of whole texts, word by word.

Words are runs of letters; their UTF-8 bytes tell the script. A script narrows the
languages to those that were seen with it. Every remaining language scores the word
by its byte trigrams, and a Viterbi pass over the words of a text, with a penalty for
each switch, labels spans. The text's language is the label of most of its letters.

Training counts trigrams of all labelled texts in Spark; the model that reaches the
driver has 65,536 numbers per language, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.frames import small_batches
from tallygrid.llm.text import LOWER, chunks, ranges, utf8

UNKNOWN = "und"
BUCKETS = 1 << 16
# Log-odds that a switch of language has to make up for, and the most that one word can say against a language.
SWITCH, WORD_LIMIT = 8.0, 12.0
# Bytes of text whose trigrams are looked up at once: a row of numbers for each byte.
SCORE_BYTES = 1 << 20
# A language is a candidate for a script that at least this share of its words is written in.
SCRIPT_SHARE = 0.001

# Scripts by the first byte of a UTF-8 character (0: no letter or a continuation byte).
LATIN, GREEK, CYRILLIC, ARMENIAN, HEBREW, ARABIC, OTHER, KANA, HAN, HANGUL = range(1, 11)
N_SCRIPTS = 11
_LEAD = np.zeros(256, np.uint8)
_LEAD[ord("a") : ord("z") + 1] = LATIN
_LEAD[0xC3:0xCB] = LATIN
_LEAD[0xCD:0xD0] = GREEK
_LEAD[0xD0:0xD5] = CYRILLIC
_LEAD[0xD5:0xD7] = ARMENIAN
_LEAD[0xD7] = HEBREW
_LEAD[0xD8:0xDC] = ARABIC
_LEAD[0xDC:0xE2] = OTHER
_LEAD[0xE3] = KANA
_LEAD[0xE4:0xEA] = HAN
_LEAD[0xEA:0xEE] = HANGUL


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of Latin, Greek and Cyrillic capitals, every character keeping its length."""
    data = LOWER[data]
    if len(data) and data.max() >= 0xC3:
        lead = np.empty_like(data)
        lead[0], lead[1:] = 0, data[:-1]
        data = data.copy()
        data[(lead == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
        data[((lead == 0xCE) & (data >= 0x91) & (data <= 0x9F)) | ((lead == 0xD0) & (data >= 0x90) & (data <= 0x9F))] += 0x20
        for first, low, high in ((0xCE, 0xA0, 0xA9), (0xD0, 0xA0, 0xAF)):
            wrap = np.flatnonzero((lead == first) & (data >= low) & (data <= high))
            data[wrap] -= 0x20
            data[wrap - 1] += 1
    return data


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and script of each run of letters, and the trigram bucket at each byte (of lower-cased bytes)."""
    scripts = _LEAD[data]
    signs = np.flatnonzero((data == 0xC3)[:-1] & ((data[1:] == 0x97) | (data[1:] == 0xB7)))  # the signs of multiplication and division
    scripts[signs] = 0
    # A byte belongs to a word if it starts a letter or continues a character that does.
    solid = scripts > 0
    inner = (data & 0xC0) == 0x80
    if inner.any():
        at = np.arange(len(data), dtype=np.int32)
        lead_at = np.maximum.accumulate(np.where(inner, 0, at))
        solid |= inner & (scripts[lead_at] > 0)
    byte = np.where(solid, data, 0x20).astype(np.uint32)
    before, after = np.full(len(data), 0x20, np.uint32), np.full(len(data), 0x20, np.uint32)
    before[1:], after[:-1] = byte[:-1], byte[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before[edges] = 0x20
    after[edges - 1] = 0x20
    buckets = (before * np.uint32(0x9E3779B1) + byte * np.uint32(0x85EBCA6B) + after * np.uint32(0xC2B2AE35)) >> np.uint32(16)
    starts = np.flatnonzero(solid & (before == 0x20))
    ends = np.flatnonzero(solid & (after == 0x20)) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    script = np.maximum.reduceat(scripts, starts) if len(starts) else np.zeros(0, np.uint8)
    return starts, ends, rows, script, buckets


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in chunks(batches, max_bytes=SCORE_BYTES):
        data, offsets = utf8(batch.column("text"))
        if not len(data):
            continue
        starts, ends, rows, script, buckets = letter_words(lowered(data), offsets)
        if not len(starts):
            continue
        inside = _inside(len(data), starts, ends)
        langs, code = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
        of_byte = np.repeat(code, np.diff(offsets))
        for k, lang in enumerate(langs.tolist()):
            own = total.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
            own[:BUCKETS] += np.bincount(buckets[inside & (of_byte == k)], minlength=BUCKETS)
            own[BUCKETS:] += np.bincount(script[code[rows] == k], minlength=N_SCRIPTS)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "slot", "n"])


def _inside(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a word."""
    edges = np.zeros(n + 1, np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8) > 0


class Model:
    """Log probabilities of trigrams by language, and the languages of each script."""

    def __init__(self, counts: list[tuple[str, int, int]]) -> None:
        self.langs = sorted({lang for lang, _, _ in counts})
        index = {lang: k for k, lang in enumerate(self.langs)}
        n = np.zeros((BUCKETS + N_SCRIPTS, len(self.langs)))
        for lang, slot, c in counts:
            n[slot, index[lang]] = c
        grams, scripts = n[:BUCKETS], n[BUCKETS:]
        self.log_p = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32)
        self.candidates = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
        self.candidates &= scripts > 0
        self.most_letters = int(np.argmax(grams.sum(axis=0))) if self.langs else -1


def fit(labelled: DataFrame) -> Model:
    """Count the texts of all rows of (text, lang); rows with a null in either are left out.

    The counts are summed per task and then in Spark; at most 65,547 rows per
    language reach the driver. Without labelled rows the model knows no language.
    """
    small_batches(labelled)
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(_count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    return Model([tuple(r) for r in counts.collect()])


def viterbi(scores: np.ndarray, firsts: np.ndarray, many: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word; texts are runs of `many` words from `firsts` on and are stepped side by side."""
    labels = np.zeros(len(scores), np.int16)
    stay = np.zeros(scores.shape, bool)
    came = np.zeros(len(scores), np.int16)
    order = np.argsort(-many, kind="stable")
    firsts, many = firsts[order], many[order]
    steps = int(many[0]) if len(many) else 0
    live_at = np.searchsorted(-many, -np.arange(steps), "left")  # texts with more than t words
    best = scores[firsts].copy()
    lanes = np.arange(len(firsts))
    for t in range(1, steps):
        n = live_at[t]
        at = firsts[:n] + t
        prev = best[:n]
        top = prev.argmax(axis=1)
        enter = prev[lanes[:n], top][:, None] - switch
        stay[at] = prev >= enter
        came[at] = top
        best[:n] = np.maximum(prev, enter) + scores[at]
    if steps:
        label = best.argmax(axis=1).astype(np.int16)
        for t in range(steps - 1, -1, -1):
            n = live_at[t]
            at = firsts[:n] + t
            labels[at] = label[:n]
            if t:
                label[:n] = np.where(stay[at, label[:n]], label[:n], came[at])
    return labels


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _word_scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end and row of each word, its score by language, and whether a candidate language scored it."""
    starts, ends, rows, script, buckets = letter_words(lowered(data), offsets)
    if not len(starts):
        return starts, ends, rows, np.zeros((0, len(model.langs)), np.float32), np.zeros(0, bool)
    per_byte = model.log_p[buckets]
    per_byte[~_inside(len(data), starts, ends)] = 0  # what lies between words is summed with the word before
    scores = np.add.reduceat(per_byte, starts, axis=0)
    allowed = model.candidates[script]
    known = allowed.any(axis=1)
    scores = np.where(allowed, scores, -np.inf)
    scores[~known] = 0
    scores -= scores.max(axis=1, keepdims=True)
    return starts, ends, rows, np.maximum(scores, -WORD_LIMIT).astype(np.float32), known


def label_words(model: Model, texts: pa.Array, switch: float) -> tuple[np.ndarray, ...]:
    """Start, end, row and label of each word, whether a candidate language scored it, and the texts' offsets and bytes."""
    data, offsets = utf8(texts)
    none = np.zeros(0, np.int64)
    parts = []
    for a, b in ranges(texts, SCORE_BYTES) if model.langs else ():
        base = offsets[a]
        starts, ends, rows, scores, known = _word_scores(model, data[base : offsets[b]], offsets[a : b + 1] - base)
        parts.append((starts + base, ends + base, rows + a, scores, known))
    starts, ends, rows, scores, known = (np.concatenate(x) for x in zip(*parts)) if parts else (none, none, none, none, none.astype(bool))
    if not len(starts):
        return none, none, none, none, none.astype(bool), offsets, data
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    many = np.diff(np.concatenate([first, [len(rows)]]))
    return starts, ends, rows, viterbi(scores, first, many, switch), known, offsets, data


def _predict(shared, switch: float, columns: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in chunks(batches):
            n, k = batch.num_rows, max(1, len(model.langs))
            starts, ends, rows, labels, known, offsets, _ = label_words(model, batch.column("text"), switch)
            mass = np.bincount(rows[known] * k + labels[known], weights=(ends - starts)[known], minlength=n * k).reshape(n, k)
            total, top = mass.sum(axis=1), mass.argmax(axis=1)
            share = np.divide(mass.max(axis=1), total, out=np.zeros(n), where=total > 0)
            pred, score = [], []
            texts = batch.column("text")
            for i in range(n):
                if total[i] > 0:
                    pred.append(model.langs[top[i]])
                    score.append(float(share[i]))
                else:  # no word of a known script: without letters it has no language
                    letter = bool(model.langs) and _has_letter(texts[i].as_py())
                    pred.append(model.langs[model.most_letters] if letter else UNKNOWN)
                    score.append(0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(pred, pa.string()), pa.array(score)], [*columns, *names])

    return run


def predict(docs: DataFrame, model: Model, switch: float = SWITCH, columns: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The chosen columns (doc_id) of every row with lang_pred and score; only the text is looked at.

    score is the share of the letters in words of known scripts that carries the
    winning label; equal shares go to the first language by name. A text that is
    null or has no letter is `und` with score 0. A text with letters but only in
    scripts that no language was trained with gets the language with most training
    text and score 0. Repeated rows stay; no documents give no rows.
    """
    small_batches(docs)
    columns = columns or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*dict.fromkeys([*columns, "text"]))
    fields = ", ".join([f"`{c}` {source.schema[c].dataType.simpleString()}" for c in columns] + [f"`{names[0]}` string", f"`{names[1]}` double"])
    return source.mapInArrow(_predict(shared, switch, columns, list(names)), fields)


def spans(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """(doc_id, start, end, lang) of each maximal run of words with one label, in code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = shared.value
        for batch in chunks(batches):
            starts, ends, rows, labels, _, offsets, data = label_words(own, batch.column("text"), switch)
            if not len(starts):
                continue
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (labels[1:] != labels[:-1])]))
            last = np.concatenate([first[1:], [len(rows)]]) - 1
            base = points[offsets[rows[first]]]
            ids = batch.column("doc_id").take(pa.array(rows[first]))
            langs = pa.array([own.langs[x] for x in labels[first]], pa.string())
            yield pa.RecordBatch.from_arrays([ids, pa.array(points[starts[first]] - base), pa.array(points[ends[last]] - base), langs], ["doc_id", "start", "end", "lang"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, start long, end long, lang string")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the id's crc32 falls into a fold; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
