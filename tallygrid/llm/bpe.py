"""Byte-level BPE as a lazily determinised finite-state transducer, and its inverse.

The transducer reads bytes and writes token ids. While it reads it follows every
token boundary that may still turn out to be right: a thread is a place in the
vocabulary's prefix tree, the last token before it, and the tokens not yet written.
A boundary is right when its last two tokens stay apart if merged alone, so each
prefix has one last token. What all threads agree on is written; the lookahead is
bounded by the longest token. Sets of threads are states, numbered when first met,
and a step is then one dictionary lookup. When the bounded table of states is full,
unknown steps are simulated on the threads themselves.

Where many texts are at hand, their different words can be encoded together: the merge
rules are then applied to all short ones at once, one merge of every word at a time.

Decoding looks the ids up and is a stream: a state machine over UTF-8 classes keeps an
incomplete character for the next chunk of ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import accumulate
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallygrid.llm.frames import small_batches
from tallygrid.llm.text import kept, slices

# Entries a worker keeps of words that it has already encoded (per generation), and of transducer states.
PIECES, STATES = 150_000, 40_000
# Words whose merges are made together, and the longest such word in bytes; longer ones are left to the transducer.
BULK_WORDS, BULK_BYTES = 16_384, 32
# Ids that are decoded at once.
CHUNK_IDS = 65_536
# Above every rank.
NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with one base64 token and its id per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """The merge rules themselves, used on single tokens only to build the transducer."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self._traces: dict[bytes, tuple[list, list, bool]] = {}

    def merge(self, piece: bytes, trace: list | None = None) -> list[bytes]:
        """Join the adjacent pair of lowest rank, leftmost first, until none has a rank."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min([(self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1)])
            if rank == NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if trace is not None:
                trace.append((rank, parts[0], parts[-1]))
        return parts

    def _trace(self, token: bytes) -> tuple[list, bool]:
        """The ranks of the token's own merges in order, with its first and last part after each; whether one part is left."""
        if (known := self._traces.get(token)) is None:
            steps = [(-1, token[:1], token[-1:])]
            whole = len(self.merge(token, steps)) == 1
            known = self._traces[token] = ([*steps, (NEVER, b"", b"")], whole)
        return known

    def is_whole(self, token: bytes) -> bool:
        """Whether the merges of the token's bytes end in the token."""
        return self._trace(token)[1]

    def stay_apart(self, left: bytes, right: bytes) -> bool:
        """Whether two whole tokens, merged together, end as these two.

        The merges inside either side go on in the order of their ranks; the two
        grow together if the pair at the seam ever comes first. Of equal ranks the
        leftmost merge comes first.
        """
        (a, whole_a), (b, whole_b) = self._trace(left), self._trace(right)
        if not (whole_a and whole_b):
            return False
        i = j = 0
        while True:
            next_a, next_b = a[i + 1][0], b[j + 1][0]
            seam = self.ranks.get(a[i][2] + b[j][1], NEVER)
            if seam < next_a and seam <= next_b and seam != NEVER:
                return False
            if next_a == next_b == NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1


class Pairs:
    """The merge rules as a sorted table of pairs of ids, applied to many words at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        rules = {}
        for t, i in ranks.items():
            for cut in range(1, len(t)):
                left, right = ranks.get(t[:cut]), ranks.get(t[cut:])
                if left is not None and right is not None:
                    rules[left << 32 | right] = i
        keys = np.array(sorted(rules), np.int64)
        self.merged = np.array([*map(rules.__getitem__, keys.tolist()), NEVER], np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        # A hash table of places in `keys`: of pairs with one slot the last is there, others are searched for.
        self.slot = np.full(1 << 20, len(keys), np.int32)
        self.slot[self._hash(keys)] = np.arange(len(keys))
        self.none = max(ranks.values()) + 1  # the id beyond either end of a piece, which merges with nothing
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.bytes = self.rank(self.byte.repeat(256), np.tile(self.byte, 256))  # of pairs of bytes
        # Whether the merges lead to every token that may be met here; a piece that is a token has to become it.
        short = [t for t in ranks if len(t) <= BULK_BYTES]
        data, size = np.frombuffer(b"".join(short), np.uint8), np.fromiter(map(len, short), np.int64, len(short))
        self.proper = self.byte.min() >= 0 and all(
            (n == 1).all() and (ids == [ranks[short[k]] for k in some]).all()
            for some in np.array_split(np.argsort(size), 16)
            if len(some)
            for ids, n in [self.encode(*self._cells(data, np.cumsum(size) - size, size, some))]
        )

    @staticmethod
    def _cells(data: np.ndarray, start: np.ndarray, size: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of some pieces as a matrix, the cells inside, and no cell where a piece ends early."""
        at = np.arange(size[some].max())
        inside = at < size[some, None]
        cells = np.zeros(inside.shape, np.uint8)
        cells[inside] = data[(start[some, None] + at)[inside]]
        return cells, inside, np.empty(0, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges to, which is its rank, or NEVER."""
        asked = left << 32 | right
        at = self.slot[self._hash(asked)]
        out, other = self.merged[at], np.flatnonzero(self.keys[at] != asked)
        out[other] = NEVER
        other = other[at[other] < len(self.keys) - 1]
        at = self.keys.searchsorted(asked[other])
        out[other] = np.where(self.keys[at] == asked[other], self.merged[at], NEVER)
        return out

    @staticmethod
    def _hash(pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).view(np.int64)

    def encode(self, cells: np.ndarray, inside: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of bytes one after another, and their number in each row.

        In every row the adjacent pair of lowest rank is joined, leftmost first, until none has
        a rank. `last` are cells (by number) after which a new piece begins: nothing is joined over these.
        """
        n, wide = cells.shape
        end = n * wide
        # Parts in the cell of their first byte, and the cells of their neighbours; the last cell is beyond the ends.
        ids = np.append(np.where(inside, self.byte[cells], self.none).ravel(), self.none)
        after, before = np.arange(1, end + 2), np.arange(-1, end)
        ends = np.concatenate([np.arange(n) * wide + inside.sum(axis=1) - 1, last])
        after[ends] = before[np.arange(n) * wide] = before[last + 1] = after[end] = before[end] = end
        rank = np.full(end + 1, NEVER)
        rank[: end - 1] = self.bytes[(cells.ravel()[:-1].astype(np.int64) << 8) | cells.ravel()[1:]]
        rank[:-1][~inside.ravel()] = NEVER
        rank[ends] = NEVER
        gone = np.zeros(end + 1, bool)
        table, live = rank[:-1].reshape(n, wide), np.arange(n)
        while len(live):
            at = table[live].argmin(axis=1) + live * wide
            new = rank[at]
            more = new < NEVER
            live, at, new = live[more], at[more], new[more]
            right, left = after[at], before[at]
            then = after[right]
            ids[at], after[at], before[then] = new, then, at
            gone[right], rank[right] = True, NEVER
            rank[at] = self.rank(new, ids[then])
            rank[left] = self.rank(ids[left], new)
            rank[end] = NEVER
        parts = inside & ~gone[:-1].reshape(n, wide)
        return ids[:-1].reshape(n, wide)[parts], parts.sum(axis=1)


class Transducer:
    """Encode one piece of text after another; states and steps are built when first needed."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = STATES) -> None:
        self.ranks, self.rules, self.max_states = ranks, Merges(ranks), max_states
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]  # the id that ends at a node of the prefix tree
        self.bytes_of = {i: t for t, i in ranks.items()}
        for t, i in ranks.items():
            node = 0
            for b in t:
                node = self.children[node].setdefault(b, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token.append(-1)
            self.token[node] = i
        self.apart: dict[tuple[int, int], bool] = {}
        # A state is a tuple of threads (node, last id or -1, pending ids); the start has one.
        start = ((0, -1, ()),)
        self.states: list[tuple] = [start]
        self.number = {start: 0}
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def _follows(self, last: int, t: int) -> bool:
        """Whether t may follow last: merged alone, the two stay as they are."""
        if last < 0:
            return self.rules.is_whole(self.bytes_of[t])
        if (known := self.apart.get((last, t))) is None:
            if len(self.apart) >= 4 * self.max_states:
                self.apart.clear()
            known = self.apart[last, t] = self.rules.stay_apart(self.bytes_of[last], self.bytes_of[t])
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state and what is written on the way; -1 where the rules leave no boundary.

        At most one thread can end a token here, as a text has one encoding; the longest is asked first.
        """
        live, boundary = [], None
        for node, last, pending in self.states[state]:
            at = self.children[node].get(byte)
            if at is None:
                continue
            if self.children[at]:
                live.append((at, last, pending))
            t = self.token[at]
            if boundary is None and t >= 0 and self._follows(last, t):
                boundary = (0, t, (*pending, t))
        if boundary is None:
            return -1, ()
        live.append(boundary)
        common = 0
        shortest = min(len(p) for _, _, p in live)
        while common < shortest and len({p[common] for _, _, p in live}) == 1:
            common += 1
        out = boundary[2][:common]
        key = tuple((n, l, p[common:]) for n, l, p in live)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        return to, out

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece; a piece that is a token itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, steps = 0, self.steps
        for k, b in enumerate(piece):
            step = steps[state].get(b)
            if step is None:
                if len(self.states) >= self.max_states:
                    rest = self._simulate(self.states[state], piece, k)
                    return out + rest if rest is not None else [self.ranks[t] for t in self.rules.merge(piece)]
                step = self._step(state, b)
                if step[0] < 0:  # ranks that are no proper merge order
                    return [self.ranks[t] for t in self.rules.merge(piece)]
                steps[state][b] = step
            state, written = step
            if written:
                out.extend(written)
        if piece:
            out.extend(self.states[state][-1][2])
        return out

    def _simulate(self, threads: tuple, piece: bytes, at: int) -> list[int] | None:
        """The rest of a piece thread by thread, once the table of states is full; None where no boundary is left.

        Tokens not yet written are chains that threads share, so a step copies nothing.
        """
        children, token, apart = self.children, self.token, self.apart
        live = [(node, last, (None, pending)) for node, last, pending in threads]
        for b in piece[at:]:
            then, boundary = [], None
            for node, last, chain in live:
                node = children[node].get(b)
                if node is None:
                    continue
                if children[node]:
                    then.append((node, last, chain))
                if boundary is None and (t := token[node]) >= 0:
                    ok = apart.get((last, t))
                    if ok is None:
                        ok = self._follows(last, t)
                    if ok:
                        boundary = (0, t, (chain, (t,)))
            if boundary is None:
                return None
            then.append(boundary)
            live = then
        chain, parts = live[-1][2], []
        while chain is not None:
            parts.append(chain[1])
            chain = chain[0]
        return [t for part in reversed(parts) for t in part]


class Utf8Stream:
    """Bytes in chunks to text: an incomplete character waits for the next chunk.

    The state is the number of bytes still wanted and the range allowed for the
    next one; a byte that does not fit makes U+FFFD and is read again from the start.
    """

    def __init__(self) -> None:
        self.waiting = b""
        self.want, self.low, self.high = 0, 0x80, 0xBF

    def feed(self, chunk: bytes) -> str:
        """The characters that are whole now. What is whole and valid is decoded at once, and only the rest byte by byte."""
        data = self.waiting + chunk
        cut = len(data)
        for back in range(1, min(3, cut) + 1):
            b = data[-back]
            if b >= 0xC0:  # a first byte that wants more than what is there
                if back < (2 if b < 0xE0 else 3 if b < 0xF0 else 4):
                    cut -= back
                break
            if b < 0x80:
                break
        try:
            text = data[:cut].decode()
        except UnicodeDecodeError:
            return self._step(chunk)
        self.__init__()
        return text + self._step(data[cut:]) if cut < len(data) else text

    def _step(self, chunk: bytes) -> str:
        out, at, done = [], 0, 0
        data = self.waiting + chunk
        at = len(self.waiting)
        while at < len(data):
            b = data[at]
            if self.want:
                if self.low <= b <= self.high:
                    self.want, self.low, self.high = self.want - 1, 0x80, 0xBF
                    at += 1
                    if not self.want:
                        out.append(data[done:at].decode())
                        done = at
                else:
                    out.append("�")
                    self.want, self.low, self.high = 0, 0x80, 0xBF
                    done = at
                continue
            if b < 0x80:
                end = at + 1
                while end < len(data) and data[end] < 0x80:
                    end += 1
                out.append(data[at:end].decode("ascii"))
                at = done = end
                continue
            if 0xC2 <= b <= 0xDF:
                self.want = 1
            elif 0xE0 <= b <= 0xEF:
                self.want, self.low, self.high = 2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
            elif 0xF0 <= b <= 0xF4:
                self.want, self.low, self.high = 3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
            else:
                out.append("�")
                done = at + 1
            at += 1
        self.waiting = data[done:] if self.want else b""
        return "".join(out)

    def end(self) -> str:
        """What is left: an incomplete character becomes U+FFFD."""
        left = "�" if self.want else ""
        self.__init__()
        return left


class Recent:
    """A bounded memory in two generations: what is asked for again moves on, the rest is forgotten."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.now: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def put(self, word: str, ids: bytes) -> None:
        if len(self.now) >= self.size:
            self.older = dict(self.now)
            self.now.clear()  # the same dictionary: lookups that hold it go on
        self.now[word] = ids


class Codec:
    """Pattern, transducer and decoding table of one vocabulary."""

    def __init__(self, path: str, pattern: str, max_pieces: int = PIECES) -> None:
        import regex

        ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.transducer = Transducer(ranks)
        self.tokens = self.transducer.bytes_of
        # Ids of words at the start of a line and of words after a blank, and those of the generation before.
        self.bare, self.spaced = Recent(max_pieces // 4), Recent(max_pieces)
        self.newline = self._pieces("\n")
        self.marks = {mark: self._pieces(mark) for mark in ".,;:!?"}
        self.pairs: Pairs | None = None

    def _pieces(self, text: str) -> bytes:
        """Each match of the pattern through the transducer."""
        encode = self.transducer.encode
        ids = [i for piece in self.split(text) for i in encode(piece.encode())]
        return pack(f"<{len(ids)}I", *ids)

    def _missing(self, known: Recent, words: list[str], found: list, before: str) -> bool:
        """Fill the gaps of `found`; False if a word has white space at an edge, where the pattern looks further.

        A run of letters is one match of the pattern, and a mark after it another one.
        """
        encode, marks = self.transducer.encode, self.marks
        for k, ids in enumerate(found):
            if ids is None:
                word = words[k]
                ids = known.older.get(word)
                if ids is None:
                    if not word or word[0].isspace() or word[-1].isspace():
                        return False
                    mark = marks.get(word[-1])
                    stem = word[:-1] if mark else word
                    if not stem.isalpha():
                        ids = self._pieces(before + word)
                    else:
                        ids = (known.now.get(stem) or known.older.get(stem)) if mark else None
                        if ids is None:
                            whole = encode((before + stem).encode())
                            ids = pack(f"<{len(whole)}I", *whole)
                            if mark:
                                known.put(stem, ids)
                        if mark:
                            ids += mark
                known.put(word, ids)
                found[k] = ids
        return True

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """`encode_bytes` of every text (null: empty), each different word of theirs once.

        Texts are split at blanks and before line feeds, which stay in front of their word, and
        the words are numbered by Arrow. A text with other white space goes through the pattern whole.
        """
        if not len(texts):
            return []
        if self.pairs is None:
            self.pairs = Pairs(self.transducer.ranks)
        if not self.pairs.proper:
            return [self.encode_bytes(t or "") for t in texts.to_pylist()]
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        first, feed = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
        split = pc.split_pattern(pc.binary_join_element_wise(first, pc.replace_substring(texts, "\n", " \n"), feed), " ")
        edges = split.offsets.to_numpy()
        words = split.values.dictionary_encode()
        ids, odd = self._words(words.dictionary)
        number = words.indices
        made = ids.take(number)
        at = np.frombuffer(made.buffers()[1], np.int64, len(made) + 1)[edges].tolist()
        raw = memoryview(made.buffers()[2] or b"")
        out = [bytes(raw[a + len(self.newline) : b]) for a, b in zip(at, at[1:])]
        if odd.any():
            before = np.concatenate([[0], np.cumsum(odd[number.to_numpy()])])[edges]
            for k in np.flatnonzero(before[1:] > before[:-1]).tolist():
                out[k] = self._pieces(texts[k].as_py())
        return out

    def _words(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The ids of different words, the line feed before a word included, and which words have white space at an edge.

        A run of letters is one match of the pattern, and a mark after it another one.
        """
        start = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
        size, start = np.diff(start), start[:-1]
        data = np.frombuffer(words.buffers()[2] or b"\0", np.uint8)
        feed = (size > 0) & (data[np.minimum(start, len(data) - 1)] == 10)
        blank = (~feed).astype(np.int64)  # the blank before a word that does not start a line
        plain = pc.match_substring_regex(words, "^\n?\\pL+[.,;:!?]?$").to_numpy(zero_copy_only=False)
        marked = plain & (data[np.maximum(start + size - 1, 0)] < 64)
        size = size + blank
        cuts: dict[int, list[int]] = {}  # of other words, the places where pieces end
        odd, own = np.zeros(len(words), bool), {}
        for k in np.flatnonzero(~plain | (size > BULK_BYTES)).tolist():
            key = words[k].as_py()
            word = key[1:] if feed[k] else key
            if not word or word[0].isspace() or word[-1].isspace():
                odd[k] = True
                continue
            pieces = [p.encode() for p in self.split(word if feed[k] else " " + word)]
            if size[k] > BULK_BYTES:
                ids = [i for p in pieces for i in self.transducer.encode(p)]
                own[k] = (self.newline if feed[k] else b"") + pack(f"<{len(ids)}I", *ids)
            else:
                cuts[k] = [*accumulate(map(len, pieces[:-1]), initial=int(feed[k]) - 1)][1:]
        short = np.flatnonzero((size <= BULK_BYTES) & ~odd)
        short = short[np.argsort(size[short], kind="stable")]
        parts, count = [], np.zeros(len(words), np.int64)
        for k in range(0, len(short), BULK_WORDS):
            some = short[k : k + BULK_WORDS]
            at = np.arange(size[some[-1]])
            inside = at < size[some, None]
            cells = data[np.minimum(np.maximum((start[some] - blank[some])[:, None] + at, 0), len(data) - 1)]
            cells[blank[some] > 0, 0] = 32
            row = np.arange(len(some)) * len(at)
            last = [row[feed[some]], (row + size[some] - 2)[marked[some]]]
            last.append(np.array([row[j] + c for j, w in enumerate(some.tolist()) if w in cuts for c in cuts[w]], np.int64))
            ids, count[some] = self.pairs.encode(cells, inside, np.concatenate(last))
            parts.append(ids.astype("<u4"))
        for k, ids in own.items():
            parts.append(np.frombuffer(ids, "<u4"))
            count[k] = len(parts[-1])
        order = np.concatenate([short, np.fromiter(own, np.int64, len(own)), np.flatnonzero(odd)])
        ends = np.concatenate([[0], 4 * np.cumsum(count[order])])
        laid = np.empty(len(words), np.int64)
        laid[order] = np.arange(len(words))
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(parts) if parts else b"")])
        return ids.take(pa.array(laid)), odd

    def encode_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers.

        A single blank between words belongs to the word after it and a single line
        feed is a piece of its own, so words are encoded one by one and remembered.
        A text with other white space next to these goes through the pattern whole.
        """
        if not text:
            return b""
        bare, spaced = self.bare, self.spaced
        out, firsts = [], []
        for line in text.split("\n"):
            words = line.split(" ")
            firsts.append(words[0])
            del words[0]
            found = list(map(spaced.now.get, words))
            if None in found and not self._missing(spaced, words, found, " "):
                return self._pieces(text)
            out.append(b"".join(found))
        found = list(map(bare.now.get, firsts))
        if None in found and not self._missing(bare, firsts, found, ""):
            return self._pieces(text)
        return self.newline.join([a + b for a, b in zip(found, out)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_stream(self, chunks: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text as the ids come in; a character split over chunks appears with its last byte."""
        stream = Utf8Stream()
        for ids in chunks:
            yield stream.feed(self.decode_bytes(ids))
        yield stream.end()


def codec(path: str, pattern: str, max_pieces: int = PIECES) -> Codec:
    """The worker's codec for a vocabulary and size of its memory, kept while tasks ask for it."""
    key = path, pattern, max_pieces
    return kept(("codec", *key), lambda: Codec(*key))


def _encode(path: str, pattern: str, columns: list[str], names: dict[str, str], max_pieces: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern, max_pieces)
        for batch in slices(batches, keep=True):
            made: dict[str, list] = {k: [] for k in names}
            for text in batch.column("text").to_pylist():
                ids = own.encode_bytes(text or "")
                if "ids" in made:
                    made["ids"].append(ids)
                made["n_tokens"].append(len(ids) // 4)
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                if "decoded_sha256" in made:
                    each = np.frombuffer(ids, "<u4").tolist()
                    back = "".join(own.decode_stream(each[i : i + CHUNK_IDS] for i in range(0, len(each), CHUNK_IDS)))
                    made["decoded_sha256"].append(hashlib.sha256(back.encode()).hexdigest())
            kinds = {"ids": pa.binary(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(v, kinds[k]) for k, v in made.items()], columns + list(names.values()))

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False, digests: bool = True, keep: tuple[str, ...] = ("doc_id",), max_pieces: int = PIECES) -> DataFrame:
    """Each row's `keep` columns, n_tokens, and as asked: ids (binary, little-endian 32-bit), ids_sha256, decoded_sha256.

    Whole texts; null counts as empty and has no ids. One pass, no shuffle; rows that
    repeat stay, and no documents give no rows. The vocabulary file is read by the
    executors, so `path` has to exist there. A worker remembers the ids of up to
    `max_pieces` words (twice, of two generations): more of them cost memory and save time.
    """
    small_batches(docs)
    kinds = {"ids": "binary", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    wanted = {"ids": "ids"} if with_ids else {}
    wanted |= {"n_tokens": "n_tokens"} | ({"ids_sha256": "ids_sha256", "decoded_sha256": "decoded_sha256"} if digests else {})
    source = docs.select(*dict.fromkeys((*keep, "text")))
    fields = ", ".join([f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep] + [f"{n} {kinds[n]}" for n in wanted])
    return source.mapInArrow(_encode(path, pattern, list(keep), wanted, max_pieces), fields)


def decode_documents(encoded: DataFrame, path: str, pattern: str, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """doc_id and text of rows with doc_id and ids, decoded chunk by chunk; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches, "ids", keep=True):
            texts = []
            for ids in batch.column("ids").to_pylist():
                each = np.frombuffer(ids or b"", "<u4").tolist()
                texts.append("".join(own.decode_stream(each[i : i + chunk_ids] for i in range(0, len(each), chunk_ids))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
