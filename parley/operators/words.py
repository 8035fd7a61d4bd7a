"""Operators on word rows: `file_id, seg_idx, pos, gpos, text, start, end, score, speaker`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import last_words, word_count

ORDERED = "array_sort(collect_list(struct(gpos, text)))"


def normalise(raw: DataFrame) -> DataFrame:
    """Raw rows with any of `text, word, token, start, end, score, confidence, speaker` -> word rows. The text is the first that
    isn't empty; times that aren't numbers are null; a missing score is the confidence; a missing speaker is unknown."""
    have = {c for c in raw.columns}
    null = F.lit(None).cast("string")
    col = lambda c: F.col(c).cast("string") if c in have else null
    text = F.coalesce(F.nullif(col("text"), F.lit("")), F.nullif(col("word"), F.lit("")), col("token"))
    keep = [c for c in ("file_id", "seg_idx", "pos", "gpos") if c in have]
    return raw.select(
        *keep,
        F.trim(text).alias("text"),
        col("start").try_cast("double").alias("start"),
        col("end").try_cast("double").alias("end"),
        F.coalesce(col("score").try_cast("double"), col("confidence").try_cast("double")).alias("score"),
        F.coalesce(col("speaker"), F.lit("unknown")).alias("speaker"),
    ).filter("text IS NOT NULL")


def segment_texts(words: DataFrame) -> DataFrame:
    """`file_id, seg_idx, text, n_words`: the words of a segment in order."""
    joined = words.groupBy("file_id", "seg_idx").agg(F.expr(f"trim(array_join(transform({ORDERED}, x -> x.text), ' '))").alias("text"))
    return joined.withColumn("n_words", word_count("text"))


def keep_last(texts: DataFrame, n: int) -> DataFrame:
    cut = texts.withColumn("text", last_words("text", n))
    return cut.withColumn("n_words", word_count("text"))


def shift(words: DataFrame, chunks: DataFrame) -> DataFrame:
    """Adds the offset of each chunk, `file_id, chunk, offset`, to words of that chunk; a null time counts as 0."""
    both = words.join(chunks, ["file_id", "chunk"])
    return both.withColumns({c: F.coalesce(c, F.lit(0.0)) + F.col("offset") for c in ("start", "end")}).drop("offset")


def sorted_segments(segments: DataFrame, *order: str) -> DataFrame:
    """Segments of a file numbered anew, `seg_idx` from 0, by start (a null one is 0), then as they were: by `order`."""
    w = W.partitionBy("file_id").orderBy(F.coalesce("start", F.lit(0.0)), *order)
    return segments.withColumn("seg_idx", F.row_number().over(w).cast("long") - 1)


def target_words(words: DataFrame, target: str) -> DataFrame:
    """`file_id, target_words`: how many words of a file are the target's, after any relabelling."""
    return words.groupBy("file_id").agg(F.count_if(F.coalesce(F.col("speaker") == target, F.lit(False))).alias("target_words"))


def one_segment(words: DataFrame) -> DataFrame:
    """A file's words as one segment without speaker."""
    return words.groupBy("file_id").agg(F.lit(None).cast("string").alias("speaker"), F.min_by("start", "gpos").alias("start"), F.max_by("end", "gpos").alias("end"), F.count("*").alias("n_words"))


def without_fillers(words: DataFrame, fillers) -> DataFrame:
    low = F.lower(F.trim("text"))
    return words.filter((low != "") & ~low.isin(*fillers))


def filler_count(words: DataFrame, fillers, target: str) -> DataFrame:
    hit = (F.col("speaker") != target) & F.lower(F.trim("text")).isin(*fillers)
    return words.groupBy("file_id").agg(F.count_if(hit).alias("n_fillers"))


def clean_token():
    return F.when(F.col("overlapped"), F.concat(F.lit("<overlap>"), "text", F.lit("</overlap>"))).otherwise(F.col("text"))
