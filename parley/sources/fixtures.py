"""Word, interval and vector tables derived from the driver's tables (conversations, events, embeddings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`file_id, seg_idx, pos, gpos, text, start, end, score, speaker`: a row for each white-space token of a conversation.

    A segment ends with a turn or after a token that ends in . ? or !. Times are made of whole milliseconds."""
    turns = table(spark, sf_dir, "conversations").filter("trim(text) <> ''")
    tokens = turns.select("conv_id", "turn", "role", F.posexplode(F.split(F.trim("text"), r"\s+")).alias("p", "text"))
    by_file = W.partitionBy("conv_id").orderBy("turn", "p")
    so_far = by_file.rowsBetween(W.unboundedPreceding, W.currentRow)
    begins = (F.col("p") == 0) | F.lag("text").over(by_file).rlike(r"[.?!]$")
    t = tokens.withColumns({"gpos": F.row_number().over(by_file).cast("long") - 1, "begins": begins.cast("long")})
    t = t.withColumn("seg_idx", F.sum("begins").over(so_far) - 1)
    gap = F.col("begins") * ((F.col("conv_id") * 7 + F.col("seg_idx") * 13) % 5) * 700
    t = t.withColumns({"ms": F.col("gpos") * 400 + F.sum(gap).over(so_far), "pos": F.col("gpos") - F.min("gpos").over(W.partitionBy("conv_id", "seg_idx"))})
    score = ((F.col("conv_id") * 31 + F.col("seg_idx") * 17 + F.col("pos") * 7) % 61 + 40) / 100
    return t.select(F.col("conv_id").alias("file_id"), "seg_idx", "pos", "gpos", "text", (F.col("ms") / 1000).alias("start"), ((F.col("ms") + 300) / 1000).alias("end"), score.alias("score"), F.col("role").alias("speaker"))


def diar(word_rows: DataFrame) -> DataFrame:
    """`file_id, start, end, speaker, ord`: one widened interval a segment, so that neighbours overlap."""
    s = word_rows.groupBy("file_id", "seg_idx").agg(F.min("start").alias("s"), F.max("end").alias("e"), F.first("speaker").alias("speaker"))
    return s.select("file_id", (F.col("s") - (F.col("seg_idx") * 5 % 4) * 0.25).alias("start"), (F.col("e") + (F.col("seg_idx") * 3 % 4) * 0.25).alias("end"), "speaker", F.col("seg_idx").alias("ord"))


def vad(intervals: DataFrame) -> DataFrame:
    return intervals.filter("ord % 2 = 0").select("file_id", "start", "end")


def words_multi(word_rows: DataFrame) -> DataFrame:
    """Several users take turns: reaches the cap on turns."""
    return word_rows.withColumn("speaker", F.expr("if(speaker = 'user', concat('user_', cast(seg_idx % 3 as string)), speaker)"))


def words_noisy(word_rows: DataFrame) -> DataFrame:
    """Every fifth word or so has the wrong speaker: gives votes something to mend."""
    flipped = "if(speaker = 'assistant', 'user', 'assistant')"
    return word_rows.withColumn("speaker", F.expr(f"if((gpos * 7 + file_id) % 5 = 0, {flipped}, speaker)"))
