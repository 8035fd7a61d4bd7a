"""SentencePiece encoding and decoding by a max-plus scan.

An encoding is the best path through the lattice of a text's pieces. For unigram models a step adds the piece's log
probability. For BPE models it adds 0 if the piece may follow the one before it, which is so if merging the two
together gives just those two again, and minus infinity if not: the one path that is left is what merging the whole
text gives, since the first merge across a border would also happen with only the two neighbours there.

Giant documents are cut into chunks. A chunk gives the max-plus matrix of its boundary states (which piece covers the
border). Matrices are combined associatively, FAN neighbours at a time, in a tree of steps over all documents at once;
on the way back down each step finds the states between the neighbours of the one above, so a task holds FAN matrices
whatever the length of a document; each chunk is then traced back by itself.
Where no piece can lie across a place (before a white space sign after another character), all states are one, so
the words between such places are solved once and remembered by a 64-bit hash, and short documents are a single chunk
with one state.
"""

from __future__ import annotations

import re
import sys
import uuid
from array import array
from collections import defaultdict
from functools import cache, reduce

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, python_ready, span_hashes, spans, table

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
CHUNK, GIANT = 16_384, 32_768
CACHED, FITS, LONGEST_CACHED = 100_000, 400_000, 48
SLOTS, FILLED, POOL, TOGETHER = 1 << 20, 650_000, 4_000_000, 1 << 20
FAN, CHAR = 16, 1 << 20
NO = -np.inf
CLOSING = {*".,;:!?"}
FREE = (0, 0)


class Model:
    def __init__(self, source: str | bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(source if isinstance(source, bytes) else open(source, "rb").read())
        norm = m.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that keep texts as they are can be used here")
        if not m.trainer_spec.byte_fallback:
            raise ValueError("only models with byte fallback give back every text")
        self.bpe = m.trainer_spec.model_type == 2
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.names = [p.piece for p in m.pieces]
        self.ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (1, 4)}
        self.scores = {p.piece: p.score for p in m.pieces if p.type in (1, 4)}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == 6}
        self.longest = max(map(len, self.ids))
        self.unknown = min(self.scores.values()) - 10
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece has white space inside")
        self.fits: dict[tuple[str, str], bool] = {}
        self.steps, self.halves = {*self.ids}, {}
        if self.bpe:
            self.note_merges()
        #: By the first characters, four at most, what can begin so, longest first: its length, and its number if the
        #: characters are all of it.
        self.begun: dict[str, list[tuple[int, int | None]]] = {}
        self.numbers = {t: self.ids[t] for t in self.steps}
        for t in sorted(self.steps, key=len):
            start, size = t[:4], len(t)
            if start not in self.begun:
                shorter = [(k, self.numbers[t[:k]]) for k in range(min(size, 4), 1, -1) if t[:k] in self.numbers]
                self.begun[start] = [*shorter, (1, self.number(t[0]))]
            if size > 4 and self.begun[start][0][0] != size:
                self.begun[start].insert(0, (size, None))
        #: By a piece's number, whether that of another may follow.
        self.after: dict[int, dict[int, bool]] = defaultdict(dict)
        self.known = 0
        #: A line's end that is in no piece stands alone, so words can be cut there.
        self.line_end = self.coded(["\n"]) if not any("\n" in t for t in self.ids) else None
        self.words = Solved(self)
        self.table = Table()
        #: What each identifier is in a decoded text; bytes beyond ASCII stand as surrogates until all are there.
        self.shown = [n.replace(SPACE, " ") for n in self.names]
        for b, i in self.bytes.items():
            self.shown[i] = chr(b) if b < 0x80 else chr(0xDC00 + b)
        for i, p in enumerate(m.pieces):
            if p.type == 3:
                self.shown[i] = ""
            elif p.type == 2:
                self.shown[i] = m.trainer_spec.unk_surface or " ⁇ "

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """Merges of a short text, until `stop` parts are left: the highest score first, then the leftmost."""
        parts, scores = list(text), self.scores
        while True:
            if len(parts) <= stop:
                return parts
            best = max(((s, -i) for i in range(len(parts) - 1) if (s := scores.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def note_merges(self) -> None:
        """Pieces that merging gives, their order of merging, and the two halves of the last merge of each."""
        order = sorted((t for t in self.ids if len(t) > 1), key=lambda t: -self.scores[t])
        self.order = {t: 0 for t in self.ids if len(t) == 1} | {t: k for k, t in enumerate(order, 1)}
        for t in order:
            halves = self.merge(t, 2)
            if len(halves) == 2 and "".join(halves) in self.ids:
                self.halves[t] = tuple(halves)
            if self.merge(t) != [t]:
                self.steps.discard(t)

    def is_piece(self, t: str) -> bool:
        """Whether `t` can be a step: it is in the vocabulary and merging gives it, or it is a single character."""
        return len(t) == 1 or t in self.steps

    def follows(self, a: str, b: str) -> bool:
        if not self.bpe or not a:
            return True
        if (ok := self.fits.get((a, b))) is None:
            if len(self.fits) >= FITS:
                self.fits.clear()
            ok = self.fits[a, b] = self.merge(a + b) == [a, b] if SPACE * 2 in a + b else self.stays_apart(a, b)
        return ok

    def stays_apart(self, a: str, b: str) -> bool:
        """No merge crosses the border: undo the merges of both sides, the latest first, and see if the parts that
        then touch would have merged before. Single characters come first; an equal merge further left goes first."""
        order, limit = self.order, 1 << 60
        while True:
            if (c := order.get(a + b)) is not None and c < limit:
                return False
            left, right = (order[a] if len(a) > 1 else 0), (order[b] if len(b) > 1 else 0)
            if left > right:
                limit, a = left, self.halves[a][1]
            elif right:
                limit, b = right + 1, self.halves[b][0]
            else:
                return True

    def gain(self, t: str) -> float:
        return 0.0 if self.bpe else self.scores.get(t, self.unknown)

    def states(self, text: str, at: int) -> list[tuple[int, int]]:
        """Boundary states at `at`: characters of the covering piece before and behind it; FREE if no piece can cross."""
        if at in (0, len(text)) or (text[at] == SPACE and text[at - 1] != SPACE):
            return [FREE]
        n, top = len(text), self.longest
        return [(a, b) for a in range(1, min(at, top) + 1) for b in range(min(top - a, n - at) + 1) if self.is_piece(text[at - a : at + b])]

    def walk(self, text: str, start: int, end: int, entry: dict[tuple[int, str], np.ndarray], back: dict | None = None) -> dict:
        """Best sums of paths over `text[start:end]`, without free places inside. entry: (place, last piece) -> a sum
        for each way in. Gives (place, last piece) -> sums for pieces that reach or cross `end`; back: gets each step's origin."""
        at: dict[int, dict[str, np.ndarray]] = {}
        for (place, last), sums in entry.items():
            at.setdefault(place, {})[last] = sums
        out: dict[tuple[int, str], np.ndarray] = {}
        n = len(text)
        for place in range(start, n + 1):
            here = at.pop(place, None)
            if here is None:
                continue
            if place >= end:
                for last, sums in here.items():
                    out[place, last] = sums
                continue
            for size in range(1, min(self.longest, n - place) + 1):
                t = text[place : place + size]
                if not self.is_piece(t):
                    continue
                best = None
                for last, sums in here.items():
                    if self.follows(last, t):
                        if best is None:
                            best, origin = sums, last
                        else:
                            if back is not None and sums[0] > best[0]:
                                origin = last
                            best = np.maximum(best, sums)
                if best is not None:
                    best = best + self.gain(t)
                    key = t if self.bpe else ""
                    there = at.setdefault(place + size, {})
                    if key not in there or (back is not None and best[0] > there[key][0]):
                        if back is not None:
                            back[place + size, key] = (t, place, origin)
                        there[key] = best
                    elif back is None:
                        there[key] = np.maximum(there[key], best)
        return out

    def free_places(self, text: str, start: int, end: int) -> tuple[int, int] | None:
        """The first and last place in `text[start:end]` (its ends included) that no piece crosses."""
        ends = [0] if start == 0 else []
        found = ends + [m.start() + 1 for m in re.finditer(f"[^{SPACE}](?={SPACE})", text[max(start - 1, 0) : end + 1])]
        shift = max(start - 1, 0)
        found = [p if p == 0 and start == 0 else p + shift for p in found]
        if end == len(text):
            found.append(end)
        found = [p for p in found if start <= p <= end]
        return (found[0], found[-1]) if found else None

    def matrix(self, text: str, start: int, end: int) -> np.ndarray:
        """Max-plus matrix from the boundary states at `start` to those at `end`; `text` has `longest` characters around both."""
        ways, exits = self.states(text, start), self.states(text, end)
        n = len(ways)
        entry = {(start + b, text[start - a : start + b] if self.bpe else ""): np.full(n, NO) for a, b in ways}
        for i, (a, b) in enumerate(ways):
            entry[start + b, text[start - a : start + b] if self.bpe else ""][i] = 0
        out = np.full((n, len(exits)), NO)
        free = self.free_places(text, start, end)
        if free:
            first, last = free
            if first > start or ways != [FREE]:
                entry = self.walk(text, start, first, entry)
            sums = np.max(list(entry.values()), axis=0) if entry else np.full(n, NO)
            if not self.bpe:
                sums = sums + sum(self.total(w) for w in WORD.findall(text[first:last]))
            if last == end:
                out[:, 0] = sums
                return out
            start, entry = last, {(last, ""): sums}
        spare: dict = {}
        reached = self.walk(text, start, end, entry, None)
        for j, (a, b) in enumerate(exits):
            t = text[end - a : end + b]
            if self.bpe:
                if (sums := reached.get((end + b, t))) is not None:
                    out[:, j] = sums
            else:
                spare[j] = (a, b)
        if not self.bpe:  # the exit also says where its piece began: the path to there, and that piece
            for j, (a, b) in spare.items():
                if end - a == start:
                    sums = entry.get((start, ""))
                else:
                    sums = self.walk(text, start, end - a, entry).get((end - a, "")) if end - a > start else None
                if sums is not None:
                    out[:, j] = sums + self.gain(text[end - a : end + b])
        return out

    def total(self, word: str) -> float:
        ids, n = np.frombuffer(self.words[word], np.int32), 0.0
        for i in ids:
            n += self.scores.get(self.names[i], 0.0)
        return n

    def trace(self, text: str, start: int, end: int, way: tuple[int, int], exit_: tuple[int, int]) -> bytes:
        """Identifiers of the pieces that begin in `text[start:end]`, coming in by `way` and leaving by `exit_`."""
        place, last = start + way[1], text[start - way[0] : start + way[1]] if self.bpe else ""
        free = self.free_places(text, place, end) if place <= end else None
        done = b""
        if free:
            first, then = free
            done = self.path(text, place, last, first, (first, None))
            done += b"".join(map(self.words.__getitem__, WORD.findall(text[first:then])))
            if then == end:
                return done
            place, last = then, ""
        target = (end + exit_[1], text[end - exit_[0] : end + exit_[1]])
        return done + self.path(text, place, last, end, target)

    def path(self, text: str, place: int, last: str, end: int, target: tuple[int, str | None]) -> bytes:
        if place == target[0]:
            return b""
        back: dict = {}
        goal, piece = target
        if self.bpe or piece is None:
            reached = self.walk(text, place, end, {(place, last): np.zeros(1)}, back)
            key = max((k for k in reached if k[0] == goal and (piece is None or k[1] == piece)), key=lambda k: reached[k][0])
            tail: list[str] = []
        else:
            begin = goal - len(piece)
            tail = [piece]
            if begin == place:
                return self.coded(tail)
            self.walk(text, place, begin, {(place, last): np.zeros(1)}, back)
            key = (begin, "")
        while key[0] != place:
            t, at, origin = back[key]
            tail.append(t)
            key = (at, origin)
        return self.coded(tail[::-1])

    def coded(self, parts: list[str]) -> bytes:
        out: list[int] = []
        for t in parts:
            if (i := self.ids.get(t)) is not None:
                out.append(i)
            else:
                out.extend(self.bytes[b] for b in t.encode())
        return array("i", out).tobytes()

    def solve(self, word: str) -> bytes:
        """A text by itself, as one chunk with one state at either end."""
        if not self.bpe:
            return self.path(word, 0, "", len(word), (len(word), None)) if word else b""
        # All finite sums are 0 and at most one piece can end at a place, so the best path is the only one there is: the
        # longest pieces are tried first, and a place from which no path goes on is not entered again.
        n, numbers, begun, after = len(word), self.numbers, self.begun, self.after
        place, last, k, ways, row = 0, -1, 0, begun.get(word[:4]) or self.ways(word, 0), {}
        back, dead, found = [], set(), []
        while place < n:
            for k in range(k, len(ways)):
                size, i = ways[k]
                end = place + size
                if end > n or end in dead or (i is None and (i := numbers.get(word[place:end])) is None):
                    continue
                if last < 0 or self.stands(last, i) if (ok := row.get(i)) is None else ok:
                    back.append((place, last, k + 1, ways, row))
                    found.append(i)
                    place, last, k, ways, row = end, i, 0, begun.get(word[end : end + 4]) or self.ways(word, end), after[i]
                    break
            else:
                dead.add(place)
                found.pop()
                place, last, k, ways, row = back.pop()
        if max(found, default=0) < CHAR:
            return array("i", found).tobytes()
        return self.coded(list(map(self.shape, found)))

    def number(self, c: str) -> int:
        """Of a single character, in the vocabulary or not."""
        return self.ids.get(c, CHAR + ord(c))

    def shape(self, i: int) -> str:
        return chr(i - CHAR) if i >= CHAR else self.names[i]

    def ways(self, word: str, at: int) -> list[tuple[int, int | None]]:
        """As `begun`, from fewer characters."""
        return next((found for k in (3, 2) if (found := self.begun.get(word[at : at + k]))), None) or [(1, self.number(word[at]))] if at < len(word) else []

    def stands(self, last: int, i: int) -> bool:
        """follows(), remembered by numbers."""
        if self.known >= FITS:
            self.after.clear()
            self.known = 0
        a, b = self.shape(last), self.shape(i)
        ok = self.after[last][i] = self.merge(a + b) == [a, b] if SPACE * 2 in a + b else self.stays_apart(a, b)
        self.known += 1
        return ok

    def encode(self, text: str | None) -> bytes:
        """Identifiers as 32-bit numbers."""
        return self.encode_all([text])[0].tobytes()

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all texts, one after another, and how many each has."""
        flat, sizes, at = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while at < len(texts):
            to, held, together = at, 0, []
            while to < len(texts) and held < TOGETHER:
                text = (texts[to] or "").replace(SPACE, " ").encode()  # both are that sign from here on
                together.append(b" " + text if text and self.prefix else text)
                held += len(text)
                to += 1
            found = self.encode_bytes(together)
            flat.append(found[0])
            sizes.append(found[1])
            at = to
        return np.concatenate(flat), np.concatenate(sizes)

    def encode_bytes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Texts, each with its prefix as a space, are cut at spaces after other characters and before line ends, which no piece
        crosses; the words are looked up by 64-bit hash, and new ones solved."""
        data = b"".join([*texts, bytes(8)])
        buffer = np.frombuffer(data, np.uint8)[:-8]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        begins = buffer == 32
        begins[1:] &= buffer[:-1] != 32
        if self.line_end:
            begins |= buffer == 10
        begins[np.concatenate([[0], ends])[:-1][np.diff(ends, prepend=0) > 0]] = True
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, len(buffer)))
        hashes = span_hashes(data, starts, lengths)
        slots = self.table.find(hashes)
        new, first = np.unique(hashes[slots < 0], return_index=True)
        if len(new):
            if self.table.full(len(new)):
                self.table.clear()
                new, first = np.unique(hashes, return_index=True)
                where = first
            else:
                where = np.flatnonzero(slots < 0)[first]
            spoken = [data[a : a + n].decode().replace(" ", SPACE) for a, n in zip(starts[where].tolist(), lengths[where].tolist(), strict=True)]
            self.table.add(new, [self.words[w] for w in spoken])
            slots = self.table.find(hashes)
        sizes = self.table.sizes[slots]
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, np.concatenate([[0], ends]))]
        return self.table.pool[spans(self.table.places[slots], sizes)], np.diff(upto)

    def marked(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE)

    def decode(self, ids) -> str:
        text = "".join(map(self.shown.__getitem__, ids))
        if not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class Table:
    """Encodings by the hash of a word, in arrays: some 50 bytes each. Emptied when full."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys, self.places, self.sizes = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.pool, self.used, self.count = np.zeros(1 << 16, np.int32), 0, 0

    def full(self, more: int) -> bool:
        return self.count + more > FILLED or self.used > POOL

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each, or -1."""
        out, rows = np.full(len(hashes), -1), np.arange(len(hashes))
        at = (hashes % np.uint64(SLOTS)).astype(np.int64)
        while len(rows):
            keys = self.keys[at]
            hit = keys == hashes[rows]
            out[rows[hit]] = at[hit]
            on = ~hit & (keys != 0)
            rows, at = rows[on], (at[on] + 1) % SLOTS
        return out

    def add(self, hashes: np.ndarray, found: list[bytes]) -> None:
        """Different hashes that are not there yet. (A hash of 0 or of another word would be wrong; at 64 bits neither is met.)"""
        flat = np.frombuffer(b"".join(found), np.int32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(self.pool), len(flat)), np.int32)])
        self.pool[self.used : self.used + len(flat)] = flat
        places = np.cumsum(sizes) - sizes + self.used
        self.used, self.count = self.used + len(flat), self.count + len(found)
        rows, at = np.arange(len(hashes)), (hashes % np.uint64(SLOTS)).astype(np.int64)
        while len(rows):
            free = np.flatnonzero(self.keys[at] == 0)
            slots, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[slots], self.places[slots], self.sizes[slots] = hashes[rows[put]], places[rows[put]], sizes[rows[put]]
            rest = np.ones(len(rows), bool)
            rest[put] = False
            rows, at = rows[rest], (at[rest] + 1) % SLOTS


class Solved(dict):
    """Encodings by word. When full, the older half of what was needed last is kept aside; long words never stay."""

    def __init__(self, model: Model):
        self.model, self.old = model, {}

    def __missing__(self, word: str) -> bytes:
        if (ids := self.old.get(word)) is None:
            ids = self.joined(word) or self.model.solve(word)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED // 2:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def joined(self, word: str) -> bytes | None:
        """Of the parts of a word with line ends, or that a sign closes: the encodings of parts are that of the whole if
        the pieces that meet may follow each other."""
        m = self.model
        if m.line_end and "\n" in word:
            first, *rest = word.split("\n")
            return (self[first] if first else b"") + b"".join(m.line_end + (self[part] if part else b"") for part in rest)
        if m.bpe and word[-1:] in CLOSING and len(word) > 1:
            ids = self[word[:-1]]
            last = m.names[int.from_bytes(ids[-4:], sys.byteorder)]
            if last in m.ids and word[-1] in m.ids and m.follows(last, word[-1]):
                return ids + m.coded([word[-1]])
        return None


@cache
def model(source: str) -> Model:
    return Model(source)


def as_lists(blobs: list[bytes]) -> pa.Array:
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), np.int32)))


def decoded_texts(m: Model, flat: np.ndarray, sizes: list[int]) -> pa.Array:
    """Row by row: few numbers are Python objects at a time."""
    texts, at = [], 0
    for n in sizes:
        texts.append(m.decode(flat[at : at + n].tolist()))
        at += n
    return pa.array(texts, pa.string())


def encode_udf(path: str, decoded: bool):
    """Identifiers and, if asked for, the texts that they decode to: one worker does both."""

    @F.arrow_udf(T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]))
    def encoded(texts: pa.Array) -> pa.Array:
        m = model(path)
        flat, sizes = m.encode_all(texts.to_pylist())
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
        back = decoded_texts(m, flat, sizes.tolist()) if decoded else pa.nulls(len(sizes), pa.string())
        return pa.StructArray.from_arrays([ids, back], ["ids", "decoded"])

    return encoded


def decode_udf(path: str):
    @F.arrow_udf(T.StringType())
    def decoded(ids: pa.Array) -> pa.Array:
        return decoded_texts(model(path), ids.flatten().to_numpy(), ids.value_lengths().fill_null(0).to_pylist())

    return decoded


def cut_giants(path: str, chunk: int):
    """Rows of giant texts -> their chunks, with a number of the row and the characters that pieces across the borders need."""

    def cut(batches):
        m = model(path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                uid, text = uuid.uuid4().hex, m.marked(text)
                marks = [*range(0, len(text), chunk), len(text)]
                for k, (a, b) in enumerate(zip(marks, marks[1:], strict=False)):
                    lo = max(0, a - m.longest)
                    row = [uid], [doc_id], [k], [a - lo], [b - lo], [text[lo : b + m.longest]], [len(marks) - 2]
                    yield pa.record_batch([pa.array(v, t) for v, t in zip(row, (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32()), strict=True)], names=CUT.split(" ")[::2])

    return cut


CUT = "uid string doc_id long k int start int end int part string last int"


def matrix_udf(path: str):
    @F.arrow_udf(T.StructType([T.StructField("rows", T.IntegerType()), T.StructField("sums", T.BinaryType())]))
    def matrices(parts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        m = model(path)
        found = [m.matrix(p, a, b) for p, a, b in zip(parts.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array([len(x) for x in found], pa.int32()), pa.array([x.tobytes() for x in found], pa.binary())], ["rows", "sums"])

    return matrices


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; associative."""
    return np.max(a[:, :, None] + b[None, :, :], axis=1)


def combined(group: pd.DataFrame) -> pd.DataFrame:
    """The matrices of neighbours -> that of all of them together."""
    group = group.sort_values("k")
    whole = reduce(combine, (np.frombuffer(s).reshape(r, -1) for r, s in zip(group["rows"], group["sums"], strict=True)))
    return pd.DataFrame({"uid": group["uid"][:1], "k": group["k"][:1] // FAN, "rows": len(whole), "sums": [whole.tobytes()]})


def states_between(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """The matrices of neighbours and the states at both ends of all of them together -> the states at either end of each
    on the best path."""
    group = group.sort_values("k")
    mats = [np.frombuffer(s).reshape(r, -1) for r, s in zip(group["rows"], group["sums"], strict=True)]
    upto, way = [np.where(np.arange(len(mats[0])) == above["way"].iloc[0], 0, NO)[None]], [0] * len(mats) + [int(above["exit"].iloc[0])]
    for m in mats:
        upto.append(combine(upto[-1], m))
    for k in range(len(mats) - 1, -1, -1):
        way[k] = int(np.argmax(upto[k][0] + mats[k][:, way[k + 1]]))
    return pd.DataFrame({"uid": group["uid"], "k": group["k"], "way": way[:-1], "exit": way[1:]})


def border_states(work: Workspace, sums: DataFrame) -> DataFrame:
    """`sums(uid, k, rows, sums)`: all chunks' matrices -> `uid, k, way, exit`: the states at either end of each chunk on the
    best path, by a tree of steps up and down."""
    levels = [work.write(sums, "matrices0")]
    most = levels[0].agg(F.max("k")).first()[0] or 0
    node = (F.col("k") / FAN).cast("int").alias("node")
    while most:
        up = levels[-1].withColumn("node", node).groupBy("uid", "node").applyInPandas(lambda pdf: combined(pdf), "uid string, k int, rows int, sums binary")
        levels.append(work.write(up, f"matrices{len(levels)}"))
        most //= FAN
    states = levels[-1].select("uid", "k", F.lit(0).alias("way"), F.lit(0).alias("exit"))
    for level, parts in reversed([*enumerate(levels[:-1])]):
        down = parts.withColumn("node", node).groupBy("uid", "node").cogroup(states.withColumnRenamed("k", "node").groupBy("uid", "node"))
        states = work.write(down.applyInPandas(lambda a, b: states_between(a, b), "uid string, k int, way int, exit int"), f"states{level}")
    return states


def trace_udf(path: str):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def traced(parts: pa.Array, starts: pa.Array, ends: pa.Array, ways: pa.Array, exits: pa.Array) -> pa.Array:
        m, out = model(path), []
        for p, a, b, i, j in zip(*(x.to_pylist() for x in (parts, starts, ends, ways, exits)), strict=True):
            out.append(m.trace(p, a, b, m.states(p, a)[i], m.states(p, b)[j]))
        return as_lists(out)

    return traced


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, giant: int = GIANT, decoded: bool = False) -> DataFrame:
    """`doc_id, ids`, one row per row of `docs`; the same identifiers as the library gives, without begin and end. With
    `decoded` also that column, as decode() adds it.

    The model file must lie at `path` on every machine. Null and empty texts give no identifiers. Ids may be null or
    repeated; other columns are not read. An empty table gives an empty result. Texts of over `giant` code points are
    cut into chunks of `chunk`, so that no task holds more than some of a giant document's work; only their chunks
    are shuffled.
    """
    spark = docs.sparkSession
    python_ready(spark)
    work = Workspace(spark, "pieces")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    wanted = ["ids", "decoded"] if decoded else ["ids"]
    short = rows.filter(F.char_length("text") <= giant).select("doc_id", encode_udf(path, decoded)("text").alias("x")).select("doc_id", *[f"x.{c}" for c in wanted])
    names = CUT.split(" ")
    schema = ", ".join(f"{a} {b}" for a, b in zip(names[::2], names[1::2], strict=True))
    parts = work.write(rows.filter(F.char_length("text") > giant).mapInArrow(cut_giants(path, chunk), schema), "chunks")
    sums = parts.select("uid", "k", matrix_udf(path)("part", "start", "end").alias("m")).select("uid", "k", "m.*")
    borders = border_states(work, sums)
    traced = parts.join(borders, ["uid", "k"]).select("uid", "doc_id", "k", trace_udf(path)("part", "start", "end", "way", "exit").alias("ids"))
    long = traced.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("all"))
    long = long.select("doc_id", F.flatten("all.ids").alias("ids"))
    return short.unionAll(decode(long, path) if decoded else long)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds `decoded` to rows with `ids`: the text that they stand for; null and no identifiers give the empty text."""
    python_ready(encoded.sparkSession)
    return encoded.withColumn("decoded", decode_udf(path)("ids"))


def op3_sentencepiece(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    both = encode(table(spark, sf_dir, "documents"), path, decoded=True)
    digest = F.sha2(F.col("decoded").cast("binary"), 256)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", digest.alias("decoded_sha256"))
