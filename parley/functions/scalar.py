"""Column functions: tokens, sentences, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def word_count(c) -> Column:
    """Runs of white space count once; blank and null texts have no words."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+"))).cast("long")


def last_words(c, n: int) -> Column:
    parts = F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+")
    return F.when(F.size(parts) > n, F.array_join(F.slice(parts, -n, n), " ")).otherwise(F.coalesce(c, F.lit("")))


def tokens(c) -> Column:
    """Lower-cased runs of letters, digits and underscores, in any script."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def token_ratio(c) -> Column:
    t = tokens(c)
    return F.when(F.size(t) == 0, 0.0).otherwise(F.size(F.array_distinct(t)) / F.size(t))


def sentences(c) -> Column:
    """Cut after . ? or ! and white space; no blank ones."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?<=[.?!])\s+"), lambda s: F.trim(s) != "")


def sentence_count(c) -> Column:
    return F.size(sentences(c)).cast("long")


def punctuation_share(c) -> Column:
    """Share of sentences that end in . ? or !."""
    s = sentences(c)
    ended = F.size(F.filter(s, lambda x: F.trim(x).rlike(r"[.?!]$")))
    return F.when(F.size(s) == 0, 0.0).otherwise(ended / F.size(s))


def rich(c, stop_words) -> Column:
    """At least one token that is no stop word."""
    return F.size(F.array_except(tokens(c), F.array(*map(F.lit, stop_words)))) >= 1


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Null if either has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def counts_cosine(ta: Column, tb: Column) -> Column:
    """Cosine of the counts of two arrays of tokens, 0 if one is empty. They should be columns: what stands in a lambda is
    evaluated for each token."""

    def length(t):
        return F.aggregate(F.array_distinct(t), F.lit(0.0), lambda s, w: s + F.pow(F.size(F.filter(t, lambda x: x == w)).cast("double"), F.lit(2.0)))

    shared = F.aggregate(F.array_intersect(ta, tb), F.lit(0.0), lambda s, w: s + F.size(F.filter(ta, lambda x: x == w)) * F.size(F.filter(tb, lambda x: x == w)))
    return F.when((F.size(ta) == 0) | (F.size(tb) == 0), 0.0).otherwise(shared / F.sqrt(length(ta) * length(tb)))


def token_cosine(a, b) -> Column:
    """Cosine of token counts: a stand-in for sentence embeddings, which are not available here. 0 if a text is empty."""
    return counts_cosine(tokens(a), tokens(b))


def clock(seconds) -> Column:
    """HH:MM:SS."""
    s = F.floor(F.coalesce(seconds, F.lit(0.0)))
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), (s % 60).cast("long"))
