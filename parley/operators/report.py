"""Summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clock
from .gates import bucket


def overlap_summary(meta: DataFrame, clean: DataFrame, words: DataFrame) -> DataFrame:
    """One row: pairs before and after, words, overlapped ones (`words(overlapped)`), their rate, and the share of pairs lost, 0 without any."""
    w = words.agg(F.count("*").alias("total_words"), F.count_if("overlapped").alias("overlapped_words"))
    both = meta.agg(F.count("*").alias("meta_pairs")).join(clean.agg(F.count("*").alias("clean_pairs"))).join(w)
    return both.withColumns(
        {"overlap_rate": F.coalesce(F.try_divide("overlapped_words", "total_words"), F.lit(0.0)), "clean_drop_rate": F.coalesce(1 - F.try_divide("clean_pairs", "meta_pairs"), F.lit(0.0))}
    )


def quality_buckets(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(bucket(F.col("quality_score")).alias("bucket")).agg(F.count("*").alias("n"))


def final_report(pairs: DataFrame, files: DataFrame, keys=("file_id",)) -> DataFrame:
    """Per file of `files(file_id, duration)`: pairs, seconds of the target and their share, confidence, empty inputs and their share."""
    keys = list(keys)
    empty = F.trim(F.coalesce("input", F.lit(""))) == ""
    p = pairs.groupBy(*keys).agg(F.count("*").alias("n_pairs"), F.sum(F.coalesce(F.col("tend") - F.col("tstart"), F.lit(0.0))).alias("target_seconds"), F.avg("avg_score").alias("avg_conf"), F.count_if(empty).alias("empty_inputs"))
    r = files.join(p, keys, "left").na.fill(0, ["n_pairs", "empty_inputs"]).na.fill(0.0, ["target_seconds"])
    return r.withColumns(
        {
            "target_share": F.coalesce(F.try_divide(F.col("target_seconds") * 100, "duration"), F.lit(0.0)),
            "empty_share": F.coalesce(F.try_divide(F.col("empty_inputs") * 100, "n_pairs"), F.lit(0.0)),
            "target_time": clock(F.col("target_seconds")),
        }
    )


def batch_report(run_log: DataFrame) -> DataFrame:
    """`file_id, seconds` (-1 if it failed) -> minutes, seconds and status of each."""
    bad = F.col("seconds") < 0
    return run_log.select("file_id", F.when(bad, "FAILED").otherwise("OK").alias("status"), F.when(~bad, F.floor(F.col("seconds") / 60)).alias("minutes"), F.when(~bad, F.col("seconds") % 60).alias("rest"))
