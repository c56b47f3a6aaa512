"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies with byte fallback.

A text becomes symbols, one for each character, with blanks written as U+2581 and one
put in front. An agenda of adjacent pairs, ordered by the score of the piece that the
pair would make and then by place, says which pair is merged next; a merge puts its two
new neighbour pairs on the agenda, and pairs that are gone by then are passed over.

Two characters that stand side by side in no piece are never merged, so a text may be
cut there and its segments encoded one by one and remembered: at line feeds, and
before a blank. In every Arrow batch, the segments that were encoded anew are also
given to the sentencepiece library; a difference is an error.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallygrid.llm.frames import small_batches
from tallygrid.llm.text import kept, slices

# Segments a worker remembers (per generation of two, and those of one batch).
SEGMENTS = 250_000
# Segments of up to so many characters are merged together, so many at once.
SHORT, TOGETHER = 32, 16_384
NEVER = 1 << 60
BLANK = "▁"
SEGMENT = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")

# Bits of an agenda entry that hold the place in the segment.
PLACE_BITS = 40
PLACE = (1 << PLACE_BITS) - 1

# One replacement character for each byte that fits no character.
codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class Vocabulary:
    """Pieces, scores and bytes of a model file; only merge-type models without normalisation rules are taken."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as f:
            raw = f.read()
        model = sentencepiece_model_pb2.ModelProto.FromString(raw)
        rules, kind = model.normalizer_spec, type(model.pieces[0])
        plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        trainer = model.trainer_spec
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix or not plain:
            raise ValueError(f"{path} is no merge-type vocabulary with byte fallback and plain text")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError(f"{path} has user-defined or unused pieces")
        self.library = SentencePieceProcessor(model_proto=raw)
        normal = [p for p in model.pieces if p.type == kind.NORMAL]
        place = {score: k << PLACE_BITS for k, score in enumerate(sorted({p.score for p in normal}, reverse=True))}
        self.rank = {p.piece: place[p.score] for p in normal}  # equal scores have equal ranks
        number = {p.piece: b"%d" % i for i, p in enumerate(model.pieces)}
        self.number = {p: number[p] for p in self.rank}
        self.byte = [number[f"<0x{b:02X}>"] for b in range(256)]
        # What an id stands for, by its decimal digits; special ids are looked at one by one.
        self.surface = {number[p]: p.replace(BLANK, " ").encode() for p in self.rank} | {n: bytes([b]) for b, n in enumerate(self.byte)}
        self.unknown = {number[p.piece]: trainer.unk_surface for p in model.pieces if p.type == kind.UNKNOWN}
        # Pieces that begin with a blank: the first of a text holds the one put in front.
        self.opening = {number[p] for p in self.rank if p.startswith(BLANK)}
        # All characters that stand side by side in some piece.
        self.joined = {p[k : k + 2] for p in self.rank for k in range(len(p) - 1)}

        self._pairs(normal)

    def _pairs(self, normal: list) -> None:
        """Numbers of the symbols, and every pair of symbols that makes a piece, sorted by the pair."""
        self.symbols = list(self.rank) + sorted({c for p in self.rank for c in p} - self.rank.keys())
        number = {s: k for k, s in enumerate(self.symbols)}
        self.code = np.full(0x110000, -1, np.int64)
        for s, k in number.items():
            if len(s) == 1:
                self.code[ord(s)] = k
        pairs = [(number[p[:k]] * len(number) + number[p[k:]], self.rank[p] >> PLACE_BITS, number[p]) for p in self.rank for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        table = np.array(sorted(pairs) or [(-1, 0, 0)], np.int64)
        self.pair, self.pair_rank, self.pair_symbol = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()
        # The ids of a symbol as decimals; a symbol that is no piece goes by bytes.
        self.digits = [self.number.get(s) or b",".join(self.byte[b] for b in s.encode()) for s in self.symbols]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of what two symbols make; NEVER where that is no piece."""
        ask = np.where((left < 0) | (right < 0), -2, left * len(self.symbols) + right)
        at = np.minimum(np.searchsorted(self.pair, ask), len(self.pair) - 1)
        return np.where(self.pair[at] == ask, self.pair_rank[at], NEVER), self.pair_symbol[at]

    def merged_together(self, segments: list[str]) -> list[bytes]:
        """The ids of many short segments whose characters all occur in pieces, as decimals joined by commas.

        Each segment has its agenda in a row, the ranks of its adjacent pairs; in every
        round each row merges its first pair of least rank and has two entries anew.
        """
        size = np.array([len(s) for s in segments])
        flat = self.code[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        row, width = np.repeat(np.arange(len(size)), size), int(size.max())
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        symbols = np.full((len(size), width + 1), -1, np.int64)
        symbols[row, place] = flat
        ranks = self._look_up(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())[0].reshape(len(size), width)
        rows, out = np.arange(len(size)), symbols.copy()
        columns = np.arange(width + 1)
        while len(rows):
            k = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            go = ranks[each, k] < NEVER
            if not go.all():
                out[rows[~go]] = -1
                out[rows[~go], : symbols.shape[1]] = symbols[~go]
                rows, symbols, ranks, k = rows[go], symbols[go], ranks[go], k[go]
                each = np.arange(len(rows))
                if not len(rows):
                    break
            made = self._look_up(symbols[each, k], symbols[each, k + 1])[1]
            # Everything behind the pair moves up by one place.
            width = symbols.shape[1] - 1
            shift = columns[:width] + (columns[:width] > k[:, None])
            symbols = np.take_along_axis(symbols, shift, axis=1)
            symbols[each, k] = made
            ranks = np.take_along_axis(ranks, shift[:, : width - 1], axis=1) if width > 1 else ranks[:, :0]
            if width == 1:
                ranks = np.full((len(rows), 1), NEVER)
                continue
            follows = k < width - 1
            ranks[each[follows], k[follows]] = self._look_up(made[follows], symbols[each[follows], k[follows] + 1])[0]
            leads = k > 0
            ranks[each[leads], k[leads] - 1] = self._look_up(symbols[each[leads], k[leads] - 1], made[leads])[0]
        alive = out >= 0
        ends = np.cumsum(alive.sum(axis=1)).tolist()
        texts = list(map(self.digits.__getitem__, out[alive].tolist()))
        return [b",".join(texts[a:b]) for a, b in zip([0, *ends], ends)]

    def ids_of(self, segments: list[str]) -> list[bytes]:
        """The ids of each segment: the short ones of similar length together, any other by itself."""
        out: list[bytes] = [b""] * len(segments)
        groups: dict[int, list[int]] = {}
        for k, s in enumerate(segments):
            if 0 < len(s) <= SHORT:
                groups.setdefault(len(s) + 3 >> 2, []).append(k)
            elif s:
                out[k] = self.ids(s)
        for some in groups.values():
            codes = self.code[np.frombuffer("".join([segments[k] for k in some]).encode("utf-32-le"), np.uint32)]
            if (codes < 0).any():
                strange = [k for k in some if (self.code[np.frombuffer(segments[k].encode("utf-32-le"), np.uint32)] < 0).any()]
                for k in strange:
                    out[k] = self.ids(segments[k])
                some = sorted(set(some) - set(strange))
            for at in range(0, len(some), TOGETHER):
                few = some[at : at + TOGETHER]
                for k, ids in zip(few, self.merged_together([segments[k] for k in few])):
                    out[k] = ids
        return out

    def apart(self, before: str, after: str) -> bool:
        """Whether a text may be cut between two characters."""
        return before + after not in self.joined

    def merged(self, segment: str) -> list[str]:
        """The pieces of a segment, by the agenda of adjacent pairs.

        An entry is one number, the place of the score among all scores and the place
        in the text; `live` has the entry that counts at each place.
        """
        symbols, n, rank = list(segment), len(segment), self.rank.get
        live, agenda = [-1] * n, []
        for k, pair in enumerate(map(add, symbols, symbols[1:])):
            if (r := rank(pair)) is not None:
                live[k] = entry = r | k
                agenda.append(entry)
        if not agenda:
            return symbols
        heapify(agenda)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            entry = heappop(agenda)
            k = entry & PLACE
            if live[k] != entry:
                continue  # one of the two has been merged since
            right = after[k]
            symbols[k] = pair = symbols[k] + symbols[right]
            symbols[right], live[right], live[k] = "", -1, -1
            after[k] = end = after[right]
            if end < n:
                before[end] = k
                if (r := rank(pair + symbols[end])) is not None:
                    live[k] = entry = r | k
                    heappush(agenda, entry)
            left = before[k]
            if left >= 0:
                live[left] = -1
                if (r := rank(symbols[left] + pair)) is not None:
                    live[left] = entry = r | left
                    heappush(agenda, entry)
        return [s for s in symbols if s]

    def ids(self, segment: str) -> bytes:
        """The ids of a segment as decimals joined by commas; characters outside the vocabulary go by bytes."""
        out = []
        for piece in self.merged(segment) if len(segment) > 1 else segment:
            known = self.number.get(piece)
            if known is not None:
                out.append(known)
            else:
                out.extend(self.byte[b] for b in piece.encode())
        return b",".join(out)

    def decode(self, ids: Iterable[bytes]) -> str:
        """The text of ids given as decimals, as the library's decode: bytes that make no character become U+FFFD one by one."""
        ids = list(ids)
        try:
            text = b"".join(map(self.surface.__getitem__, ids)).decode()
        except (KeyError, UnicodeDecodeError):
            text = self._decode_with_care(ids)
        first = next((i for i in ids if i in self.surface or i in self.unknown), None)
        return text[1:] if first in self.opening else text

    def _decode_with_care(self, ids: list[bytes]) -> str:
        """Runs of byte ids by themselves, as any other id ends a character."""
        singles, out, run = set(self.byte), [], []
        for i in ids:
            if i in singles:
                run.append(self.surface[i])
                continue
            out.append(b"".join(run).decode("utf8", "each_byte"))
            run = []
            out.append(self.surface[i].decode() if i in self.surface else self.unknown.get(i, ""))
        return "".join(out) + b"".join(run).decode("utf8", "each_byte")


class Memory:
    """Ids of segments in two generations: what a batch needs moves to the newer one, the rest is forgotten."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.now: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def unknown(self, segments: set[str]) -> list[str]:
        """Those that neither generation has; the others are in the newer one afterwards."""
        absent = [s for s in segments if s not in self.now]
        if self.now and len(self.now) + len(absent) > self.size:
            self.older, self.now = self.now, {}
            absent = list(segments)
        out = []
        for s in absent:
            ids = self.older.get(s)
            if ids is None:
                out.append(s)
            else:
                self.now[s] = ids
        return out


class Encoder:
    """Batches of texts to ids, with a bounded memory of segments and a list of those not yet checked."""

    def __init__(self, path: str, max_segments: int = SEGMENTS) -> None:
        self.vocabulary = v = Vocabulary(path)
        # Words after a blank or at the start of a text, words at the start of a later line, and other segments.
        self.spaced, self.bare, self.other = Memory(max_segments), Memory(max_segments // 4), Memory(max_segments // 4)
        self.unchecked: list[tuple[str, bytes]] = []
        characters = set("".join(v.joined))
        self.by_words = not any(p[0] != BLANK and p[1] == BLANK for p in v.joined) and "\n" not in characters
        self.marks = {m: v.ids(m) for m in ".,;:!?"}
        self.newline = v.ids("\n")

    def _learn(self, known: Memory, words: set[str], before: str) -> None:
        """Bring words into the newer generation; a mark that no piece joins to its word is encoded alone."""
        ends, stems = [], set()
        for word in known.unknown(words):
            mark = self.marks.get(word[-1:])
            if not (mark and len(word) > 1 and self.vocabulary.apart(word[-2], word[-1])):
                mark, stem = b"", word
            else:
                stem = word[:-1]
            ends.append((word, stem, mark))
            if stem not in known.now:
                stems.add(stem)
        new = [s for s in stems if s not in known.older]
        made = self.vocabulary.ids_of([before + s for s in new])
        self.unchecked += zip([before + s for s in new], made)
        ids = dict(zip(new, made)) | {s: known.older[s] for s in stems if s in known.older}
        for word, stem, mark in ends:
            own = ids[stem] if stem in ids else known.now[stem]
            known.now[stem] = own
            if mark:
                known.now[word] = own + b"," + mark

    def _cut(self, text: str) -> list[tuple[Memory | None, list[str]]]:
        """A text as runs of segments of one memory, in order; no memory is a line feed."""
        if not text:
            return []
        if BLANK in text or not self.by_words:
            return [(self.other, self._segments(text, True))]
        out: list = []
        for k, line in enumerate(text.split("\n")):
            words = line.split(" ")
            head = words.pop(0) if k else None
            if k:
                out.append((None, []))
            if "" in words[:-1]:  # several blanks in a row
                out.append((self.other, self._segments(line, not k)))
                continue
            if head:
                out.append((self.bare, [head]))
            if words:
                out.append((self.spaced, words))
        return out

    def _segments(self, text: str, first: bool) -> list[str]:
        """Each run of blanks with what follows it; a vocabulary that joins across blanks takes the text whole."""
        text = (BLANK if first else "") + text.replace(" ", BLANK)
        return SEGMENT.findall(text) if self.by_words else [text]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text as decimals joined by commas."""
        cut = [self._cut(t) for t in texts]
        for known, before in ((self.spaced, BLANK), (self.bare, ""), (self.other, "")):
            words: set[str] = set()
            for runs in cut:
                for own, some in runs:
                    if own is known:
                        words.update(some)
            self._learn(known, words, before)
        out, newline = [], self.newline
        for runs in cut:
            ids: list[bytes] = []
            for own, some in runs:
                if own is None:
                    ids.append(newline)
                else:
                    ids += map(own.now.__getitem__, some)
            out.append(b",".join(ids))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def check(self) -> None:
        """Compare what was encoded since the last check with the library; a difference is an error.

        The library puts a blank in front, so a segment that begins with one is given
        without it, and any other is given behind a line feed, whose ids are dropped.
        """
        if not self.unchecked:
            return
        texts = [s[1:].replace(BLANK, " ") if s.startswith(BLANK) else "\n" + s for s, _ in self.unchecked]
        front = self.vocabulary.ids(BLANK) + b"," + self.newline + b","
        for (segment, ids), got in zip(self.unchecked, self.vocabulary.library.encode(texts, num_threads=1)):
            own = ids if segment.startswith(BLANK) else front + ids
            if segment == BLANK:  # an empty text has no ids in the library
                continue
            if b",".join(b"%d" % i for i in got) != own:
                raise ValueError(f"{segment[:80]!r}: {own[:80]} against {got[:20]} of the library")
        self.unchecked.clear()


def encoder(path: str) -> Encoder:
    """The worker's encoder for a model, kept while tasks ask for it."""
    return kept(("encoder", path), lambda: Encoder(path))


def _encode(path: str, columns: list[str], wanted: dict[str, str]):
    kinds = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        decode = own.vocabulary.decode
        for batch in slices(batches, keep=True):
            made: dict[str, list] = {k: [] for k in wanted}
            for ids in own.encode_all([text or "" for text in batch.column("text").to_pylist()]):
                if "ids" in made:
                    made["ids"].append(np.array(ids.split(b","), np.int32) if ids else np.zeros(0, np.int32))
                made["n_tokens"].append(ids.count(b",") + 1 if ids else 0)
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                if "decoded_sha256" in made:
                    made["decoded_sha256"].append(hashlib.sha256((decode(ids.split(b",")) if ids else "").encode()).hexdigest())
            own.check()
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(v, kinds[k]) for k, v in made.items()], columns + list(wanted))

    return run


def encode_pieces(docs: DataFrame, path: str, with_ids: bool = False, digests: bool = True, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each row's `keep` columns, n_tokens, and as asked: ids (array<int>), ids_sha256 (of decimals joined by commas), decoded_sha256.

    Whole texts; null counts as empty and has no ids. One pass, no shuffle; rows that
    repeat stay, other columns are ignored, and no documents give no rows. The model
    file is read by the executors, so `path` has to exist there.
    """
    small_batches(docs)
    kinds = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    names = [*(["ids"] if with_ids else []), "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else [])]
    source = docs.select(*dict.fromkeys((*keep, "text")))
    fields = ", ".join([f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep] + [f"{n} {kinds[n]}" for n in names])
    return source.mapInArrow(_encode(path, list(keep), {n: n for n in names}), fields)


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids (array<int>); null and no ids give an empty text, ids outside the vocabulary are an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path).vocabulary
        size = vocabulary.library.get_piece_size()
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                if any(i is None or not 0 <= i < size for i in ids or []):
                    raise ValueError("an id is outside the vocabulary")
                texts.append(vocabulary.decode([b"%d" % i for i in ids or []]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    small_batches(encoded)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
