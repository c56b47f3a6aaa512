"""Benchmark decontamination on templates, so that re-parameterised questions are found too.

Words lose surrounding punctuation and case. Numbers, names (capitalised inside a
sentence) and units (after a number) become typed slots. A capitalised word that opens
a sentence may be a name or not, so a window with capitals stands under both templates.
Windows of template words are joined by hash between documents and benchmark; a bitmap of fixed size over the
benchmark's windows keeps other windows of the documents from being shuffled. The
slot values of matching windows then have to map one to one: a question asked
again with other numbers does, chance matches do not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm import bitmap
from tallygrid.llm.language import lowered
from tallygrid.llm.frames import small_batches
from tallygrid.llm.text import SLICE_BYTES, grams, mix, signed, slices, utf8, word_hashes, words
from tallygrid.session import materialize

# Template words of a window; an item counts as leaked when this share of its windows, or this many words in a row, are found.
WINDOW, SHARE, RUN = 8, 0.5, 13
FILTER_BITS = 24

# Words that count as units when they follow a number.
UNITS = (
    "% percent mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t ton tons lb lbs oz ml l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years k c f degrees "
    "dollar dollars cent cents euro euros pound pounds usd eur gbp mph kph kb mb gb tb hz khz mhz ghz w kw mw v a j cal kcal"
).split()

_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?:;|"]] = True
_NUM, _NAME, _UNIT = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93))


def _unit_hashes() -> np.ndarray:
    data = " ".join(UNITS).encode()
    raw = np.frombuffer(data, np.uint8)
    starts, ends, _ = words(raw, np.array([0, len(raw)]))
    return np.sort(word_hashes(raw, starts, ends))


def templates(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, template hash, value hash, whether it is a slot and whether it might be a name that opens a sentence,
    of every word that is not all punctuation."""
    data, offsets = utf8(texts)
    starts, ends, rows = words(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool), none.astype(bool)
    last_byte = data[ends - 1]
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A, dtype=np.int32)])
    opening = np.ones(len(starts), bool)
    opening[1:] = (rows[1:] != rows[:-1]) | _ENDS[last_byte[:-1]] | (breaks[starts[1:]] > breaks[ends[:-1]])
    starts, ends = starts.copy(), ends.copy()
    for at, step in ((starts, 1), (ends, -1)):
        live = np.arange(len(starts))
        while len(live):
            live = live[starts[live] < ends[live]]
            live = live[_PUNCT[data[at[live] - (step < 0)]]]
            at[live] += step
    kept = starts < ends
    starts, ends, rows, opening = starts[kept], ends[kept], rows[kept], opening[kept]
    low = lowered(data)
    value = word_hashes(low, starts, ends)
    first, second = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
    upper = ((first >= 0x41) & (first <= 0x5A)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    small = np.concatenate([[0], np.cumsum((data >= 0x61) & (data <= 0x7A), dtype=np.int32)])
    number = _DIGIT[first]
    upper &= small[ends] > small[starts]
    name = upper & ~opening
    unit = np.zeros(len(starts), bool)
    after = number[:-1] & (rows[1:] == rows[:-1]) & ~number[1:]
    known = _unit_hashes()
    near = np.flatnonzero(after) + 1
    spot = np.minimum(np.searchsorted(known, value[near]), len(known) - 1)
    unit[near] = known[spot] == value[near]
    name &= ~unit
    out = value.copy()
    out[number], out[name], out[unit] = _NUM, _NAME, _UNIT
    return rows, out, value, number | name | unit, upper & opening & ~unit


Windows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def windows(parsed: tuple[np.ndarray, ...], n_texts: int, size: int, openings: bool = False) -> Windows:
    """Row, position and hash of every window; then the words' values, slot marks and the windows' first words.

    `openings` makes names of the words that may be some, and gives only windows with a name.
    A window without fixed words, or with fewer than a quarter of its size, is too general: its values count too.
    """
    rows, template, value, slot, may = parsed
    seed = size
    if openings:
        template, slot, seed = np.where(may, _NAME, template), slot | may, size + 200
    h, at = grams(template, rows, size, seed=seed)
    if openings and len(at):
        many = np.concatenate([[0], np.cumsum(template == _NAME)])
        own = many[at + size] > many[at]
        h, at = h[own], at[own]
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), value, slot, at
    fixed = np.concatenate([[0], np.cumsum(~slot)])
    general = np.flatnonzero(fixed[at + size] - fixed[at] < max(1, size // 4))
    if len(general):
        exact, at_exact = grams(value, rows, size, seed=size + 100)
        h[general] = mix(exact[np.searchsorted(at_exact, at[general])] ^ h[general])
    begin = np.searchsorted(rows, np.arange(n_texts))
    return rows[at], at - begin[rows[at]], h, value, slot, at


def _window_rows(ids: pa.Array, names: list[str], found, size: int, pick: np.ndarray) -> pa.RecordBatch:
    row, pos, h, value, slot, at = found
    row, pos, h, at = row[pick], pos[pick], h[pick], at[pick]
    packed = [value[a : a + size][slot[a : a + size]].tobytes() for a in at.tolist()]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(row)), pa.array(np.full(len(at), size, np.int32)), pa.array(pos.astype(np.int64)), pa.array(signed(h)), pa.array(packed, pa.binary())], names
    )


def _benchmark(window: int):
    """Windows of each item, under both templates; an item with fewer words is one window of its own length, openings as they are."""
    names = ["item_id", "size", "pos", "hash", "slots", "n_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, *_ = templates(batch.column("text"))
            many = np.bincount(rows, minlength=batch.num_rows)
            for size in range(1, window + 1):
                own = np.flatnonzero(many == size) if size < window else np.flatnonzero(many >= window)
                if len(own):
                    part = batch.take(pa.array(own))
                    parsed = templates(part.column("text"))
                    for openings in (False, True) if size == window else (False,):
                        found = windows(parsed, len(own), size, openings)
                        out = _window_rows(part.column("item_id"), names[:5], found, size, np.arange(len(found[0])))
                        yield pa.RecordBatch.from_arrays([*out.columns, pa.array((many[own] - size + 1)[found[0]].astype(np.int64))], names)

    return run


def _candidates(shared, sizes: list[int], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE_BYTES // 2):
            parsed = templates(batch.column("text"))
            for size in sizes:
                for openings in (False, True) if size == window else (False,):
                    found = windows(parsed, batch.num_rows, size, openings)
                    pick = np.flatnonzero(bitmap.has(shared.value, found[2]))
                    if len(pick):
                        yield _window_rows(batch.column("doc_id"), ["doc_id", "size", "pos", "hash", "slots"], found, size, pick)

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slot values of each matching window side by side, as (item value, document value)."""
    for batch in batches:
        both = []
        for a, b in zip(batch.column("slots").to_pylist(), batch.column("item_slots").to_pylist()):
            x, y = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
            both.append([{"i": int(p), "d": int(q)} for p, q in zip(y, x)] if len(x) == len(y) else [])
        kept = [batch.column(c) for c in ("doc_id", "item_id", "pos", "item_pos")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(both, pa.list_(pa.struct([("i", pa.int64()), ("d", pa.int64())])))], ["doc_id", "item_id", "pos", "item_pos", "pairs"])


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE, run: int = RUN, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, n_found, n_windows, share_found, longest_run.

    An item is found when at least `share` of its template windows, or windows that
    make `run` words in a row, occur in the document with consistent slot values.
    Of several values for one slot the most frequent counts (then the smallest);
    windows that contradict it do not. Items with fewer words than a window have to
    occur whole. Null and empty texts and items without words match nothing. Rows
    that repeat a doc_id or item_id are one document or item; a null doc_id is one
    document of its own, items without an id are left out. Empty tables give no rows.
    Runs jobs: the benchmark's windows and the matches are written tables.
    """
    small_batches(docs)
    spark = docs.sparkSession
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    known = materialize(items.mapInArrow(_benchmark(window), f"item_id {kind}, size int, pos long, hash long, slots binary, n_windows long"), "windows")
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())  # at most `window` of them
    shared = spark.sparkContext.broadcast(bitmap.build(known, "hash", filter_bits))
    near = docs.select("doc_id", "text").mapInArrow(_candidates(shared, sizes, window), "doc_id long, size int, pos long, hash long, slots binary")
    side = known.select("hash", "size", "item_id", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    met = near.join(side, ["hash", "size"]).select("doc_id", "item_id", "pos", "item_pos", "slots", "item_slots")
    met = materialize(met.mapInArrow(_pairs, f"doc_id long, item_id {kind}, pos long, item_pos long, pairs array<struct<i: long, d: long>>"), "met")

    # The values that a document gives to an item's slots: each way the most frequent partner, then the smallest.
    votes = met.select("doc_id", "item_id", F.explode("pairs").alias("p")).groupBy("doc_id", "item_id", "p.i", "p.d").agg(F.count(F.lit(1)).alias("n"))
    to_doc = votes.groupBy("doc_id", "item_id", "i").agg(F.max(F.struct("n", (-F.col("d").cast("decimal(20,0)")).alias("o"), "d")).alias("best")).select("doc_id", "item_id", "i", F.col("best.d").alias("d"))
    to_item = votes.groupBy("doc_id", "item_id", "d").agg(F.max(F.struct("n", (-F.col("i").cast("decimal(20,0)")).alias("o"), "i")).alias("best")).select("doc_id", "item_id", F.col("best.i").alias("i"), "d")
    agreed = _join_safe(to_doc, to_item, ["doc_id", "item_id", "i", "d"]).groupBy("doc_id", "item_id").agg(F.collect_set(F.struct("i", "d")).alias("agreed"))
    checked = _join_safe(met.withColumn("open", F.size("pairs") > 0), agreed, ["doc_id", "item_id"], "left")
    fits = ~F.col("open") | F.forall("pairs", lambda p: F.array_contains(F.col("agreed"), p))
    good = checked.filter(fits)

    totals = known.groupBy("item_id").agg(F.max("n_windows").alias("n_windows"), F.max("size").alias("size"))
    found = good.groupBy("doc_id", "item_id").agg(F.countDistinct("item_pos").alias("n_found"))
    diagonal = good.groupBy("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(F.countDistinct("item_pos").alias("n"))
    longest = diagonal.groupBy("doc_id", "item_id").agg(F.max("n").alias("in_line"))
    out = _join_safe(found, longest, ["doc_id", "item_id"]).join(totals, "item_id")
    out = out.select("doc_id", "item_id", "n_found", "n_windows", (F.col("n_found") / F.col("n_windows")).alias("share_found"), (F.col("in_line") + F.col("size") - 1).alias("longest_run"))
    return out.filter((F.col("share_found") >= share) | (F.col("longest_run") >= run))


def _join_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which a null doc_id equals a null doc_id."""
    other = right.select(*(F.col(k).alias(f"r_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = [left[k].eqNullSafe(other[f"r_{k}"]) for k in keys]
    return left.join(other, on, how).drop(*(f"r_{k}" for k in keys))
