"""Personal data: formats that speak for themselves, and identifiers that their context gives away.

Base matches of four formats are seeds. The words around an identifier are lexical
patterns. Spark holds the graph of patterns and instances and scores it in turns: a
pattern is as good as the share of its different instances that are believed to be
of a kind, an instance as good as its patterns together. Patterns with enough
support and confidence then mark identifiers that no format knows, such as a phone
number without its country code after "call me at".
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.frames import small_batches
from tallygrid.llm.substrings import _ids, _marks
from tallygrid.llm.text import slices
from tallygrid.session import materialize

KINDS = ("email", "ip", "card", "phone")
# Believed instances a pattern needs, and the confidence that patterns and instances need; turns of scoring.
SUPPORT, CONFIDENCE, TURNS = 3, 0.8, 3
# Digits that make a word worth asking about, and that neighbouring groups have together at most (those of the longest card).
LEAST_DIGITS, MOST_DIGITS = 3, 19

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs: a failed try is not repeated inside the same run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# One of several groups of digits, and a word that says "at" without being an address of the base format.
_GROUP = re.compile(r"[+(]{0,2}[0-9][0-9().-]*")
_AT = re.compile(r"[^@]@[^@]|[(\[{<](?:at|AT|At)[)\]}>]")
_EDGE = ".,;:!?\"'()[]{}<>|#%&$*=-"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that long runs cost one look."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            free = end.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all matches of the four formats, by kind and start; code points."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not _ANY_DIGIT.search(text):
        return out
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def _digits(text: str) -> int:
    return sum("0" <= c <= "9" for c in text)


def _shaped(text: str, found: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans that may identify somebody: words with digits or an at sign; groups of digits with a blank between are one span.

    A row of groups ends at punctuation that a number does not have. One with more than
    MOST_DIGITS digits is a table rather than a number: its words stand alone.
    """

    def row_of(group: list[tuple[int, int]]) -> list[tuple[int, int]]:
        a, b = group[0][0], group[-1][1]
        return [(a, b)] if len(group) > 1 and _digits(text[a:b]) <= MOST_DIGITS else group

    group: list[tuple[int, int]] = []
    for a, b in found:
        inner = text[a:b].strip(_EDGE)
        start = a + text[a:b].index(inner)
        end = start + len(inner)
        # Brackets belong to a group of digits: `(020) 7946 0018`.
        first = a if _GROUP.fullmatch(text, a, end) else start
        last = end + (text[end:b].startswith(")") and "(" in text[first:end])
        plain = bool(inner) and bool(_GROUP.fullmatch(text, first, last))
        if group and not (plain and first == a and a == group[-1][1] + 1 and text[a - 1] == " "):
            yield from row_of(group)
            group = []
        if plain:
            group.append((first, last))
            if last < b:
                yield from row_of(group)
                group = []
        elif inner and (_ANY_DIGIT.search(inner) or _AT.search(inner)):
            yield start, end
    if group:
        yield from row_of(group)


def occurrences(text: str) -> Iterator[tuple[int, int, int, str, list[str]]]:
    """(kind or -1, start, end, instance, patterns) of base matches and of other spans of their shapes."""
    base = base_spans(text)
    if not base and not _ANY_DIGIT.search(text) and not _AT.search(text):
        return
    found = [m.span() for m in _WORD.finditer(text)]
    starts, ends = [a for a, _ in found], [b for _, b in found]
    taken = sorted((a, b) for _, a, b in base)
    spans = [(k, a, b) for k, a, b in base]
    for a, b in _shaped(text, found):
        if _digits(text[a:b]) >= LEAST_DIGITS or _AT.search(text, a, b):
            at = bisect_right(taken, (a, 1 << 62))
            if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or taken[at][0] >= b):
                spans.append((-1, a, b))

    def word(i: int) -> str:
        return text[starts[i] : ends[i]].strip(_EDGE).lower() if 0 <= i < len(found) else "^"

    for kind, a, b in spans:
        left, right = bisect_right(ends, a) - 1, bisect_left(starts, b)
        yield kind, a, b, text[a:b].lower(), [f"{word(left - 1)} {word(left)} _", f"{word(left)} _ {word(right)}", f"_ {word(right)} {word(right + 1)}"]


def _occurrence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "mark", "kind", "start", "end", "instance", "patterns"]
    for batch in slices(batches):
        rows = []
        for i, m, text in zip(_ids(batch).tolist(), _marks(batch.column("text")).tolist(), batch.column("text").to_pylist()):
            rows += [(i, m, *x) for x in occurrences(text or "")]
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def believed(seen: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, turns: int = TURNS) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (pattern, kind, conf) and instances without a format (instance, kind, belief) after the turns.

    A seed believes in its kind with 1. A pattern's confidence for a kind is the sum
    of its different instances' beliefs in the kind over the number of its different
    instances, if at least `support` of them are believed; an instance's belief is
    1 - product of (1 - confidence) over its accepted patterns. Every step joins and
    aggregates distinct pairs in Spark; ties go to the first kind.
    """
    edges = materialize(seen.select("instance", "kind", F.explode("patterns").alias("pattern")).distinct(), "edges")
    seeds = edges.filter("kind >= 0").groupBy("instance").agg(F.min("kind").alias("kind")).withColumn("belief", F.lit(1.0))
    links = edges.select("pattern", "instance").distinct()
    total = links.groupBy("pattern").agg(F.count(F.lit(1)).alias("all"))
    beliefs = seeds
    for _ in range(turns):
        by_kind = links.join(beliefs, "instance").groupBy("pattern", "kind").agg(F.sum("belief").alias("mass"), F.count(F.lit(1)).alias("n"))
        scored = by_kind.join(total, "pattern").filter(F.col("n") >= support).select("pattern", "kind", (F.col("mass") / F.col("all")).alias("conf"))
        accepted = materialize(scored.filter(F.col("conf") >= confidence), "patterns")
        told = links.join(accepted, "pattern").join(seeds.select("instance"), "instance", "left_anti")
        sums = told.groupBy("instance", "kind").agg((F.lit(1.0) - F.exp(F.sum(F.log(F.greatest(F.lit(1.0) - F.col("conf"), F.lit(1e-6)))))).alias("belief"))
        best = sums.groupBy("instance").agg(F.max(F.struct("belief", (-F.col("kind")).alias("k"))).alias("b")).select("instance", (-F.col("b.k")).alias("kind"), F.col("b.belief").alias("belief"))
        found = materialize(best.filter(F.col("belief") >= confidence), "instances")
        beliefs = seeds.unionByName(found)
    return accepted, found


def _base_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    for batch in slices(batches):
        spans = [base_spans(t or "") for t in batch.column("text").to_pylist()]
        listed = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in spans], pa.list_(span))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_ids(batch)), pa.array(_marks(batch.column("text"))), listed], ["doc_id", "id", "mark", "base"])


def find_personal_data(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, turns: int = TURNS) -> DataFrame:
    """One row per document: doc_id, base and added, both arrays of (kind, start, end) by kind and start.

    base holds the matches of the formats, in code points; added holds identifiers
    that accepted patterns surround and that no base match covers. Null and empty
    texts have none. Rows that repeat a document have the same spans each; a null
    doc_id is kept. No documents give no rows. Runs jobs: occurrences and the turns
    of scoring are written tables.
    """
    small_batches(docs)
    source = docs.select("doc_id", "text")
    seen = source.mapInArrow(_occurrence_rows, "id long, mark long, kind int, start int, end int, instance string, patterns array<string>")
    seen = materialize(seen, "occurrences")
    patterns, instances = believed(seen, support, confidence, turns)
    open_ = seen.filter("kind < 0").select("id", "mark", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    hits = open_.join(instances.select("instance", "kind"), "instance").join(patterns.select("pattern", "kind"), ["pattern", "kind"])
    added = hits.groupBy("id", "mark").agg(F.sort_array(F.collect_set(F.struct(F.col("kind").cast("int").alias("kind"), "start", "end"))).alias("added"))
    base = source.mapInArrow(_base_rows, "doc_id long, id long, mark long, base array<struct<kind: int, start: int, end: int>>")
    none = F.expr("cast(array() as array<struct<kind: int, start: int, end: int>>)")
    return base.join(added, ["id", "mark"], "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def _text(spans) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def span_digests(found: DataFrame) -> DataFrame:
    """Counts of the base matches by kind, their digest, and all spans as text."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    every = F.sort_array(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), _text(every).alias("spans"))
