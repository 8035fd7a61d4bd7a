"""Token counts of a byte-level BPE vocabulary, by merging only: no identifiers are made.

A text is cut at the vocabulary's added tokens, then by its pre-tokenizer's pattern. A piece starts as one symbol a
byte in a linked list; a heap gives the lowest-rank adjacent pair, again and again; a piece counts its symbols less its
merges. That is O(n log n) even for a piece of many megabytes. Counts of short pieces, and of what lies between two
spaces, are remembered, at most CACHED of each in a worker.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import cache
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from .common import python_ready, table

CACHED, LONGEST_CACHED = 1_000_000, 64
LIMIT = 1024
CLOSING = {*".,;:!?"}


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next of U+0100..."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


@cache
def odd_points() -> str:
    """A class of the code points that `regex` calls letters or numbers, and the tokenizers library, with older tables, doesn't."""
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    points = "".join(chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    new = [(c, first) for first, kind in (("a", "L"), ("1", "N")) for c in regex.findall(rf"\p{{{kind}}}", points) if unicodedata.category(c) == "Cn"]
    return "".join(c for c, first in new if len(cut(first + c)) > 1)


class Counter:
    """Counts for one vocabulary file in the `tokenizers` JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or spec["normalizer"] or before["add_prefix_space"]:
            raise ValueError(f"{path}: only byte-level BPE without normalizer and prefix space is counted here")
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: left << 17 | right -> rank << 17 | merged
        self.merges = {ids[a] << 17 | ids[b]: rank << 17 | ids[a + b] for rank, (a, b) in enumerate(pairs)}
        self.bytes = [ids[s] for s in byte_symbols()]
        self.added = [x["content"] for x in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        odd = odd_points()
        self.odd = frozenset(odd)
        strict = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{odd}])")
        for k in "LN":
            strict = strict.replace(rf" ?\p{{{k}}}+", rf" ?(?:(?![{odd}])\p{{{k}}})+")
        self.strict = regex.compile(strict) if odd else self.pattern
        self.pieces = Remembered(lambda piece: self.merged(piece.encode()), CACHED)
        self.words = Remembered(self.spaced, CACHED)

    def merged(self, piece: bytes) -> int:
        """Symbols left of one piece after all merges. Heap entries: rank, merged symbol and place in one integer."""
        get, n = self.merges.get, len(piece)
        symbol = [*map(self.bytes.__getitem__, piece), 0]  # a 0 behind the end; merged-away symbols are -1
        after, before = [*range(1, n + 1)], [*range(-1, n)]
        heap = [found << 32 | i for i in range(n - 1) if (found := get(symbol[i] << 17 | symbol[i + 1]))]
        heapify(heap)
        left = n
        while heap:
            entry = heappop(heap)
            i, found = entry & 0xFFFFFFFF, entry >> 32
            if symbol[i] < 0 or (j := after[i]) == n or get(symbol[i] << 17 | symbol[j]) != found:
                continue  # one of the two has been merged meanwhile
            symbol[i] = new = found & 0x1FFFF
            symbol[j] = -1
            left -= 1
            k = after[i] = after[j]
            before[k] = i
            if k < n and (found := get(new << 17 | symbol[k])):
                heappush(heap, found << 32 | i)
            if (h := before[i]) >= 0 and (found := get(symbol[h] << 17 | new)):
                heappush(heap, found << 32 | h)
        return left

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        n, at = 0, 0
        if self.cut and any(a in text for a in self.added):
            for m in self.cut.finditer(text):
                n, at = n + 1 + self.plain(text[at : m.start()]), m.end()
            text = text[at:]
        return n + self.plain(text)

    def plain(self, text: str) -> int:
        # a space between two others always starts a piece, so what lies between spaces can be counted by itself
        if "  " in text:
            return self.cut_and_merge(text)
        first, *rest = text.split(" ")
        return self.cut_and_merge(first) + sum(map(self.words.__getitem__, rest))

    def spaced(self, word: str) -> int:
        """Tokens of a space and what follows it up to the next."""
        if word.isalpha():  # one piece
            return self.pieces[" " + word]
        if word[-1:] in CLOSING and word[:-1].isalpha():
            return self.pieces[" " + word[:-1]] + 1
        return self.cut_and_merge(" " + word)

    def cut_and_merge(self, text: str) -> int:
        pattern = self.pattern if text.isascii() or self.odd.isdisjoint(text) else self.strict
        return sum(map(self.pieces.__getitem__, pattern.findall(text)))


class Remembered(dict):
    """Counts by string. When full, the older half of what was needed last is kept aside; long strings never stay."""

    def __init__(self, count, most: int):
        self.count, self.half, self.old = count, most // 2, {}

    def __missing__(self, key: str) -> int:
        if (n := self.old.get(key)) is None:
            n = self.count(key)
        if len(key) <= LONGEST_CACHED:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[key] = n
        return n


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_udf(path: str):
    @F.arrow_udf(T.LongType())
    def counts(texts: pa.Array) -> pa.Array:
        c = counter(path)
        return pa.array([c.count(x) for x in texts.to_pylist()], pa.int64())

    return counts


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit`, one row per row of `docs`.

    The vocabulary file must lie at `path` on every machine. Null counts as the empty text: no bytes, no tokens. An
    id may be null or repeated; other columns are not read. An empty table gives an empty result. There is no shuffle.
    """
    python_ready(docs.sparkSession)
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = text.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), count_udf(path)("text").alias("n_tokens"))
    return n.withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
