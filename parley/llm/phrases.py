"""Substring dedup with repeated-phrase automata.

A window is WINDOW consecutive words. Documents are packed into blocks of about BLOCK bytes of text, in the order in
which they are read, so rows that repeat are spread like others; four passes run over the blocks:

1. Candidates. Each window is named by the least hash among its SHINGLE-word shingles. Equal windows have equal names,
   and neighbours mostly share theirs, so a block sends a few names a hundred words. Names that occur once anywhere
   belong to no repeated window.
2. Confirmation. Windows with a repeated name send their own 96-bit hash; those that occur again anywhere are confirmed.
   Of the blocks that hold one, the first of each GROUP blocks is its owner and is told which of them the others are.
3. Passages. An owner cuts out the words of the confirmed windows that it owns, runs of them together, and deals each
   such passage to the blocks that hold any of its windows.
4. Automata. The passages dealt to a block are its shard: an Aho-Corasick automaton is compiled from phrases of PHRASE words,
   taken so close that any window holds a whole one. All documents of the block are streamed through it. A hit is compared
   with its passages word by word, as far to either side as a window goes; where at least a window agrees, its words are
   removed. A document's other blocks have nothing that it could hold, so it needs no other shard.

What is dealt out grows with the repeated text of each block, not with blocks times passages. Hashes travel as sorted
arrays, one for a block and a range of hashes, with one entry for a hash that a block holds any number of times: a passage
that a third of all rows share is no larger than others.
"""

from __future__ import annotations

import hashlib
import math
from itertools import compress
from operator import eq

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, span_hashes, spans, table

WINDOW, SHINGLE, PHRASE = 35, 12, 8
#: Of the places at which phrases are taken from a passage, one is in any window; a window has so many words beside it.
SIDE, STRIDE = WINDOW - PHRASE, WINDOW - PHRASE + 1
BLOCK, CHUNK, BUCKET = 8 << 20, 1 << 20, 4_000_000
GROUP, PIECE, DEALT = 4096, 256, 256
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
NONE = np.zeros(0, np.int64)


def words_of(text: bytes | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+`, which are what bytes.split() gives."""
    return (text or b"").split()


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and how many words each text has."""
    data = b" ".join([b"", *texts, b" " * 9])
    buffer = np.frombuffer(data, np.uint8)
    white = WHITE[buffer]
    starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    sizes = np.flatnonzero(~white[:-1] & white[1:]) + 1 - starts
    out = span_hashes(data, starts, sizes)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], ends + 1]))) if texts else NONE
    return out, counts


def rolled(hashes: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """A hash of each `size` hashes in a row, by doubling: sum of h[i+j] * m^j modulo 2^64, then mixed."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    done, out, power, base, k = 0, None, hashes, multiplier, 1
    while k <= size:
        if size & k:
            part = power[done : len(hashes) - size + 1 + done]
            out = part.copy() if out is None else out + part * np.uint64(pow(multiplier, done, 1 << 64))
            done += k
        if 2 * k <= size:
            power = power[:-k] + power[k:] * np.uint64(base)
            base = base * base % (1 << 64)
        k *= 2
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def sliding(f, values: np.ndarray, size: int) -> np.ndarray:
    """np.minimum or np.maximum over each `size` values in a row."""
    out, k = values, 1
    while 2 * k <= size:
        out = f(out[:-k], out[k:])
        k *= 2
    return f(out[: len(values) - size + 1], out[size - k :]) if k < size else out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted; runs of one value, which are usual here, are passed over first."""
    return np.unique(values[np.concatenate([[True], values[1:] != values[:-1]])]) if len(values) else values


class Block:
    """The documents of a block, one after another; `starts` and `ends` are their words' places."""

    def __init__(self, payloads: pa.ChunkedArray):
        tables = [pa.ipc.open_stream(p.as_py()).read_all() for p in payloads]
        docs = pa.concat_tables(tables) if tables else pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.binary())})
        self.ids, self.texts = docs.column("doc_id").to_pylist(), [t or b"" for t in docs.column("text").to_pylist()]
        parts, sizes, at = [], [], 0
        while at < len(self.texts):
            to, held = at, 0
            while to < len(self.texts) and (to == at or held < CHUNK):
                held += len(self.texts[to])
                to += 1
            found = hashed(self.texts[at:to])
            parts.append(found[0])
            sizes.append(found[1])
            at = to
        sizes = np.concatenate([*sizes, NONE])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.hashes = np.concatenate([*parts, np.zeros(0, np.uint64)])

    def windows(self) -> np.ndarray:
        """Which places begin a window that lies in one document."""
        step = np.zeros(len(self.hashes) + 1, np.int32)
        long = self.ends - self.starts >= WINDOW
        np.add.at(step, self.starts[long], 1)
        np.add.at(step, self.ends[long] - WINDOW + 1, -1)
        return np.cumsum(step)[: max(0, len(self.hashes) - WINDOW + 1)] > 0

    def shingles(self) -> np.ndarray:
        return rolled(self.hashes, SHINGLE, MULTIPLIERS[0])

    def names(self, shingles: np.ndarray) -> np.ndarray:
        size = WINDOW - SHINGLE + 1
        return sliding(np.minimum, shingles, size) if len(shingles) >= size else np.zeros(0, np.uint64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Names of the block's windows, and whether a shingle of that hash stands in two places of it."""
        shingles = self.shingles()
        values = distinct(self.names(shingles)[self.windows()])
        at = np.searchsorted(values, shingles[member(shingles, values)])
        return values, np.bincount(at, minlength=len(values)) > 1


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), dtype)


PARTS = "bucket int, block int, hashes binary, more binary, twice binary"


def in_buckets(block: int, values: np.ndarray, more: np.ndarray, twice: np.ndarray, buckets: int) -> pa.Table:
    """Rows of PARTS: the values by range of hashes; `more` are 32 further bits of each."""
    to = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to, values, more, twice = to[order], values[order], more[order], twice[order]
    cuts = [*np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])).tolist(), len(to)] if len(to) else [0]
    rows = [(int(to[a]), block, values[a:b].tobytes(), more[a:b].tobytes(), twice[a:b].tobytes()) for a, b in zip(cuts, cuts[1:], strict=False)]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "block", "hashes", "more", "twice"])


class Met:
    """All entries of a range of hashes, sorted; entries of one value are a run."""

    def __init__(self, parts: pa.Table):
        sizes = [len(x.as_py()) // 8 for x in parts.column("hashes")]
        values, more, twice = joined(parts.column("hashes"), np.uint64), joined(parts.column("more"), np.uint32), joined(parts.column("twice"), bool)
        blocks = np.repeat(parts.column("block").to_numpy(), sizes)
        order = np.lexsort((blocks, more, values))
        self.values, self.blocks = values[order], blocks[order]
        more, twice = more[order], twice[order]
        self.begins = np.ones(len(order), bool)
        self.begins[1:] = (self.values[1:] != self.values[:-1]) | (more[1:] != more[:-1])
        firsts = np.flatnonzero(self.begins)
        #: Whether the value of each entry occurs at least twice in all.
        again = (np.diff(np.append(firsts, len(order))) > 1) | (np.logical_or.reduceat(twice, firsts) if len(firsts) else np.zeros(0, bool))
        self.again = again[np.cumsum(self.begins) - 1]


def by_block(blocks: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    """(block, its part of each column..); the columns are of one length."""
    order = np.argsort(blocks, kind="stable")
    blocks, columns = blocks[order], [c[order] for c in columns]
    cuts = [*np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])).tolist(), len(blocks)] if len(blocks) else [0]
    return [(int(blocks[a]), *(c[a:b] for c in columns)) for a, b in zip(cuts, cuts[1:], strict=False)]


def repeated(parts: pa.Table) -> pa.Table:
    """All of a range's rows -> for each block its values that occur at least twice in all."""
    met = Met(parts)
    rows = by_block(met.blocks[met.again], met.values[met.again])
    return pa.table([pa.array([b for b, _ in rows], pa.int32()), pa.array([v.tobytes() for _, v in rows], pa.binary())], names=["block", "found"])


OWNED = "block int, found binary, sizes binary, holders binary"


def owners(parts: pa.Table) -> pa.Table:
    """All of a range's rows -> for each owner its values that occur at least twice in all, and the blocks of its group
    that hold each, itself first."""
    met = Met(parts)
    at = np.flatnonzero(met.again)
    blocks, group = met.blocks[at], met.blocks[at] // GROUP
    first = met.begins[at]
    first[1:] |= group[1:] != group[:-1]
    firsts = np.flatnonzero(first)
    sizes = np.diff(np.append(firsts, len(at)))
    rows = []
    for owner, values, n, begin in by_block(blocks[firsts], met.values[at][firsts], sizes, firsts):
        held = blocks[spans(begin, n)]
        rows.append((owner, values.tobytes(), n.astype(np.int32).tobytes(), held.astype(np.int32).tobytes()))
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "found", "sizes", "holders"])


def pack(blocks: int, chunk: int = CHUNK):
    """Partitions of `part, doc_id, text` -> rows `block, payload`: compressed tables of documents of about `chunk` bytes that
    follow each other, dealt to the blocks in turn."""
    def run(batches):
        options, k = pa.ipc.IpcWriteOptions(compression="zstd"), 0
        for batch in batches:
            docs = pa.Table.from_batches([batch])
            if not docs.num_rows:
                continue
            sizes = np.cumsum(pc.fill_null(pc.binary_length(docs.column("text")), 0).to_numpy(), dtype=np.int64)
            part, at = docs.column("part")[0].as_py(), 0
            while at < docs.num_rows:
                before = sizes[at - 1] if at else 0
                to = min(docs.num_rows, max(at + 1, int(np.searchsorted(sizes, before + chunk))), at + 50_000)
                sink = pa.BufferOutputStream()
                rows = docs.slice(at, to - at).select(["doc_id", "text"]).combine_chunks()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                    writer.write_table(rows)
                block = (part * 0x9E3779B1 + k) % (1 << 32) % blocks
                yield pa.record_batch([pa.array([block], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "payload"])
                k, at = k + 1, to

    return run


def candidates_of(buckets: int):
    def send(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        values, twice = Block(docs.column("payload")).anchors()
        return in_buckets(key[0].as_py(), values, np.zeros(len(values), np.uint32), twice, buckets)

    return send


def windows_of(buckets: int):
    def send(key: tuple[pa.Scalar, ...], docs: pa.Table, names: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.uint64)
        if not docs.num_rows or not names.num_rows:
            return in_buckets(0, empty, empty.astype(np.uint32), empty.astype(bool), buckets)
        block = Block(docs.column("payload"))
        likely = np.flatnonzero(block.windows() & member(block.names(block.shingles()), np.sort(joined(names.column("found"), np.uint64))))
        first, second = (rolled(block.hashes, WINDOW, m)[likely] for m in MULTIPLIERS)
        values, at, n = np.unique(first, return_index=True, return_counts=True)
        return in_buckets(docs.column("block")[0].as_py(), values, (second[at] >> np.uint64(32)).astype(np.uint32), n > 1, buckets)

    return send


DEALT_PASSAGES = "words binary, holders array<int>"


def passages(docs: pa.Table, owned: pa.Table) -> pa.Table:
    """A block's documents and what it owns -> its passages, each of words between single spaces, of at most PIECE windows,
    with the blocks that hold some window of it, at most DEALT in a row."""
    texts, holders = [], []
    if docs.num_rows and owned.num_rows:
        block = Block(docs.column("payload"))
        values, sizes, held = (joined(owned.column(c), t) for c, t in (("found", np.uint64), ("sizes", np.int32), ("holders", np.int32)))
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(values, kind="stable")
        values, sizes, begin = values[order], sizes[order], begin[order]
        windows = rolled(block.hashes, WINDOW, MULTIPLIERS[0])
        places = np.flatnonzero(block.windows() & member(windows, values))
        of, first = np.unique(windows[places], return_index=True)
        at = np.searchsorted(values, of)
        order = np.argsort(places[first], kind="stable")
        places, at = places[first][order], at[order]  # where each window owned first stands in the block
        doc = np.searchsorted(block.ends, places, side="right")
        new = np.ones(len(places), bool)
        new[1:] = (places[1:] != places[:-1] + 1) | (doc[1:] != doc[:-1])
        run = np.flatnonzero(new)[np.cumsum(new) - 1]
        new |= (np.arange(len(places)) - run) % PIECE == 0
        piece = np.cumsum(new) - 1
        # the holders of all windows of each piece
        n, many = sizes[at].astype(np.int64), held[spans(begin[at].astype(np.int64), sizes[at].astype(np.int64))].astype(np.int64)
        both = np.unique(np.repeat(piece, n) << 32 | many)
        cuts = np.searchsorted(both >> 32, np.arange(len(both) and int(both[-1] >> 32) + 2))
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(places)) - 1
        words, now = [], -1
        for k, (a, b) in enumerate(zip(firsts.tolist(), lasts.tolist(), strict=True)):
            if doc[a] != now:
                now = int(doc[a])
                words, start = words_of(block.texts[now]), int(block.starts[now])
            text = b" ".join(words[int(places[a]) - start : int(places[b]) - start + WINDOW])
            blocks = (both[cuts[k] : cuts[k + 1]] & 0xFFFFFFFF).astype(np.int32)
            for c in range(0, len(blocks), DEALT):
                texts.append(text)
                holders.append(blocks[c : c + DEALT])
    return pa.table([pa.array(texts, pa.binary()), pa.array(holders, pa.list_(pa.int32()))], names=["words", "holders"])


#: What stands between documents and between passages where their words are laid out; no word, and not the same.
GAP_DOCS, GAP_PASSAGES = np.uint64(1), np.uint64(2)
#: A word is SYMBOLS characters of BITS bits to the automaton, whose states look through their ways on one by one.
SYMBOLS, BITS = 3, 5


def laid_out(hashes: np.ndarray, starts: np.ndarray, gap: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The hashes with a gap after each text and SIDE of them at both ends, and where each text then starts."""
    n = len(starts)
    sizes = np.diff(np.append(starts, len(hashes)))
    out = np.full(len(hashes) + n + 2 * SIDE, gap)
    to = starts + SIDE + np.arange(n)
    out[spans(to, sizes)] = hashes
    return out, to


def symbols(hashes: np.ndarray, gap: np.uint64) -> str:
    """What the automaton reads of words. Words may be the same to it; hits are compared in full."""
    codes = np.empty((len(hashes), SYMBOLS), np.uint8)
    for k in range(SYMBOLS):
        codes[:, k] = hashes >> np.uint64(20 + BITS * k) & np.uint64((1 << BITS) - 1)
    codes[hashes == gap] = 1 << BITS
    return codes.tobytes().decode("latin-1")


class Shard:
    """The passages dealt to a block and the automaton of their phrases."""

    def __init__(self, texts: list[bytes]):
        self.words = [words_of(t) for t in texts]
        hashes, sizes = hashed(texts)
        self.hashes, self.starts = laid_out(hashes, np.cumsum(sizes) - sizes, GAP_PASSAGES)
        text, number, self.places = symbols(self.hashes, GAP_PASSAGES), {}, []
        for start, n in zip(self.starts.tolist(), sizes.tolist(), strict=True):
            for at in range(start, start + n - PHRASE + 1, STRIDE):
                phrase = text[SYMBOLS * at : SYMBOLS * (at + PHRASE)]
                k = number.setdefault(phrase, len(number))
                if k == len(self.places):
                    self.places.append([])
                self.places[k].append(at)
        self.automaton = ahocorasick.Automaton()
        for phrase, k in number.items():
            self.automaton.add_word(phrase, k)
        self.automaton.make_automaton()

    def hits(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases stand in a laid-out text, each with every place it has in the passages."""
        if not len(self.automaton):
            return NONE, NONE
        found = np.fromiter((x for pair in self.automaton.iter(text) for x in pair), np.int64).reshape(-1, 2)
        found = found[(found[:, 0] + 1) % SYMBOLS == 0]
        sizes = np.fromiter(map(len, self.places), np.int64, len(self.places))
        flat = np.fromiter((x for p in self.places for x in p), np.int64)
        n, begin = sizes[found[:, 1]], (np.cumsum(sizes) - sizes)[found[:, 1]]
        return np.repeat((found[:, 0] + 1) // SYMBOLS - PHRASE, n), flat[spans(begin, n)]


def same_words(doc: list[bytes], at: int, passage: list[bytes], place: int, low: int, high: int) -> tuple[int, int]:
    """Of a hit at `at` and `place` that agrees by hashes from -low to +high words, how far the words themselves agree."""
    if doc[at - low : at + high] == passage[place - low : place + high]:
        return low, high
    agree = list(map(eq, doc[at - low : at + high], passage[place - low : place + high]))
    if not all(agree[low : low + PHRASE]):
        return 0, 0
    while not all(agree[:low]):
        low, agree = low - 1, agree[1:]
    return low, next((k - low for k in range(low, len(agree)) if not agree[k]), high)


def covered_words(block: Block, texts: list[bytes], step: int = 1 << 14) -> np.ndarray:
    """Which words of a block lie in a window that some passage holds."""
    cover = np.zeros(len(block.hashes) + 1, np.int64)
    if not texts or not len(block.hashes):
        return cover[:-1] > 0
    shard = Shard(texts)
    hashes, starts = laid_out(block.hashes, block.starts, GAP_DOCS)
    at, place = shard.hits(symbols(hashes, GAP_DOCS))
    words, now = [], -1
    for k in range(0, len(at), step):
        a, p = at[k : k + step], place[k : k + step]
        around = np.arange(-SIDE, PHRASE + SIDE)
        agree = hashes[a[:, None] + around] == shard.hashes[p[:, None] + around]
        low = np.logical_and.accumulate(agree[:, SIDE - 1 :: -1], axis=1).sum(axis=1)
        high = np.logical_and.accumulate(agree[:, SIDE:], axis=1).sum(axis=1)
        good = np.flatnonzero((high >= PHRASE) & (low + high >= WINDOW))
        a, p, low, high = a[good], p[good], low[good], high[good]
        doc, passage = np.searchsorted(starts, a, side="right") - 1, np.searchsorted(shard.starts, p, side="right") - 1
        for d, x, q, y, m, n in zip(doc.tolist(), (a - starts[doc]).tolist(), passage.tolist(), (p - shard.starts[passage]).tolist(), low.tolist(), high.tolist(), strict=True):
            if d != now:
                words, now = words_of(block.texts[d]), d
            m, n = same_words(words, x, shard.words[q], y, m, n)
            if m + n >= WINDOW:
                start = int(block.starts[d]) + x
                cover[start - m] += 1
                cover[start + n] -= 1
    return np.cumsum(cover)[:-1] > 0


RESULT = "doc_id long, n_words long, n_removed long, kept binary"


def removed(digest_only: bool):
    def send(key: tuple[pa.Scalar, ...], docs: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows:
            block = Block(docs.column("payload"))
            covered = covered_words(block, found.column("words").to_pylist())
            for doc_id, text, a, b in zip(block.ids, block.texts, block.starts.tolist(), block.ends.tolist(), strict=True):
                gone, words = covered[a:b], words_of(text)
                kept = b" ".join(compress(words, (~gone).tolist()) if gone.any() else words)
                rows.append((doc_id, b - a, int(gone.sum()), hashlib.sha256(kept).hexdigest().encode() if digest_only else kept))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept"])

    return send


def dedup_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_only: bool = False, block: int = BLOCK) -> DataFrame:
    """`doc_id, n_words, n_removed, kept`, one row per row of `docs`; `kept` is the UTF-8 of the words left, between
    single spaces, or with `digest_only` the hexadecimal digits of its SHA-256.

    Windows are judged on the input. Null and empty texts have no words. Ids may be null or repeated: a repeated row
    is a document like any other, so its windows occur again. Other columns are not read. An empty table gives an empty
    result. The memory of a task is some times `block`, or one document if that is larger. `docs` must give the same rows
    in the same partitions when it is read again after the loss of an executor, as tables and files do.
    """
    spark = docs.sparkSession
    python_ready(spark)
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    blocks = max(1, math.ceil(size / block), math.ceil(n / 50_000))
    # about 6 bytes a word: most words may begin a window that has to be confirmed, and one in 8 names windows
    ranges = [max(1, math.ceil(size / 6 / n / BUCKET)) for n in (8, 1)]
    packed = rows.mapInArrow(pack(blocks, min(CHUNK, block)), "block int, payload binary")
    packed = packed.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "block")
    names = packed.groupBy("block").applyInArrow(candidates_of(ranges[0]), PARTS)
    names = names.groupBy("bucket").applyInArrow(repeated, "block int, found binary")
    windows = packed.groupBy("block").cogroup(names.groupBy("block")).applyInArrow(windows_of(ranges[1]), PARTS)
    owned = windows.groupBy("bucket").applyInArrow(owners, OWNED)
    found = packed.groupBy("block").cogroup(owned.groupBy("block")).applyInArrow(passages, DEALT_PASSAGES)
    found = found.select(F.explode("holders").alias("block"), "words")
    return packed.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(removed(digest_only), RESULT)


def op4_substring_dedup(spark, sf_dir):
    found = dedup_phrases(table(spark, sf_dir, "documents"), digest_only=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_sha256"))
