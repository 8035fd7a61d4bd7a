"""Filters and routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PairConfig


def exact(c):
    """Nine places: what a sum of floats in another order may change doesn't decide at a threshold."""
    return F.round(c, 9)


def cutoffs(words: DataFrame, keys: list[str], cfg: PairConfig, strategy: str = "percentile", value: str = "score") -> DataFrame:
    """`cutoff` for each key: the percentile (or median) of scores, at least the floor; the floor without scores."""
    mid = F.percentile(value, F.lit(cfg.conf_percentile)) if strategy == "percentile" else F.median(value)
    return words.groupBy(*keys).agg(F.greatest(F.lit(cfg.conf_floor), F.coalesce(mid, F.lit(cfg.conf_floor))).alias("cutoff"))


def confident(words: DataFrame, cfg: PairConfig, strategy: str = "percentile") -> DataFrame:
    """Words without score, or with one of at least the speaker's cutoff less the grace."""
    keys = ["file_id", "speaker"]
    both = words.join(cutoffs(words, keys, cfg, strategy), keys)
    return both.filter(F.col("score").isNull() | (exact(F.col("score")) >= exact(F.col("cutoff") - cfg.conf_grace))).drop("cutoff")


def dominance(words: DataFrame, target: str) -> DataFrame:
    """`file_id, total, target_words, n_speakers, target_ratio`; words without speaker don't count."""
    named = words.filter("speaker IS NOT NULL AND speaker <> ''").groupBy("file_id", "speaker").agg(F.count("*").alias("n"))
    d = named.groupBy("file_id").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("speaker") == target, F.col("n")).otherwise(0)).alias("target_words"), F.count("*").alias("n_speakers"))
    return d.withColumn("target_ratio", F.try_divide("target_words", "total"))


def route(words: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    """Adds `mode` to dominance(): qna for one speaker, whoever it is, or a target with nearly all words."""
    single = (F.col("n_speakers") == 1) | (F.col("target_ratio") > cfg.single_ratio)
    return dominance(words, target).withColumn("mode", F.when(single, "qna").otherwise("conversational"))


def prefilter(replies: DataFrame, cfg: PairConfig, length: str = "output_len", conf: str = "avg_score") -> DataFrame:
    long = F.col(length) >= cfg.min_words
    return replies.filter(long | ((F.col(length) >= 1) & (exact(F.coalesce(conf, F.lit(0.0))) >= cfg.prefilter_conf)))


def drop_reason(cfg: PairConfig):
    """length, confidence, quality: the first test that a pair fails, or null."""
    n, avg, q = F.col("output_len"), exact(F.col("avg_score")), exact(F.col("quality_score"))
    short = ~((n >= cfg.min_words) | ((n >= 1) & (F.coalesce(avg, F.lit(0.0)) >= cfg.short_reply_min_conf)))
    unsure = F.lit(False) if not cfg.min_conf else avg.isNotNull() & (avg < cfg.min_conf)
    return F.when(short, "length").when(unsure, "confidence").when(q.isNull() | (q < cfg.min_quality), "quality")


def postfilter(pairs: DataFrame, cfg: PairConfig) -> DataFrame:
    return pairs.withColumn("drop_reason", drop_reason(cfg)).filter("drop_reason IS NULL").drop("drop_reason")


def postfilter_counts(pairs: DataFrame, cfg: PairConfig, keys=()) -> DataFrame:
    c = pairs.withColumn("drop_reason", drop_reason(cfg)).groupBy(*keys)
    dropped = [F.count_if(F.coalesce(F.col("drop_reason") == r, F.lit(False))).alias(f"dropped_by_{r}") for r in ("length", "confidence", "quality")]
    return c.agg(F.count("*").alias("initial"), F.count_if(F.col("drop_reason").isNull()).alias("kept"), *dropped)


def flag(pairs: DataFrame, cfg: PairConfig) -> DataFrame:
    """Pairs with `reasons`; advisory, nothing is removed. Needs `overlap_rate`."""
    n_in, n_out, avg = F.col("input_len"), F.col("output_len"), exact(F.col("avg_score"))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("overlap_rate") >= cfg.flag_overlap, "high_overlap"),
            F.when(avg.isNull() | (avg < cfg.flag_low_conf), "low_confidence"),
            F.when((n_out > 0) & (n_in / F.greatest(n_out, F.lit(1)) > cfg.flag_ratio), "input_output_ratio"),
        )
    )
    return pairs.withColumn("reasons", reasons).filter(F.size("reasons") > 0)


def flagged_ids(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("file_id").agg(F.sort_array(F.collect_set("seg_idx")).alias("flagged_ids"))


def bucket(q):
    return F.when(exact(q) >= 0.7, "clean").when(exact(q) >= 0.4, "borderline").otherwise("flagged")


def sweep(pairs: DataFrame, configs: DataFrame) -> DataFrame:
    """Kept pairs for each row of `configs(cfg, min_words, min_conf, min_quality)`, a small table that is broadcast."""
    both = pairs.join(F.broadcast(configs))
    ok = ((F.col("output_len") >= F.col("min_words")) | ((F.col("output_len") >= 1) & (exact(F.coalesce("avg_score", F.lit(0.0))) >= 0.85))) & (
        F.col("avg_score").isNull() | (exact(F.col("avg_score")) >= F.col("min_conf"))
    )
    ok = ok & F.coalesce(exact(F.col("quality_score")) >= F.col("min_quality"), F.lit(False))
    return both.groupBy("cfg").agg(F.count("*").alias("pairs"), F.count_if(ok).alias("kept"))


def first_in_file(pairs: DataFrame):
    """The file's first kept pair, if it has no context."""
    w = W.partitionBy("file_id").orderBy("seg_idx")
    return pairs.withColumn("is_first_utterance", (F.row_number().over(w) == 1) & (F.col("input_len") == 0))
