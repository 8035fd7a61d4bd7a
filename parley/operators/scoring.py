"""Quality of pairs. The similarity is a provider's column: token-count cosine by default, as no sentence model is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PairConfig, Weights
from ..functions.scalar import counts_cosine, punctuation_share, sentence_count, token_cosine, token_ratio, tokens

METRICS = ("avg_conf", "overlap_rate", "input_len", "output_len", "ratio", "ratio_score", "punc_score", "diversity_score", "semantic_similarity")


def clamp(c):
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def score(pairs: DataFrame, weights: Weights = Weights(), similarity=token_cosine, words: str | None = "words") -> DataFrame:
    """Adds `quality_score` and `quality_metrics`. Without words, as in the second pass, confidence is avg_score."""
    n_in, n_out = F.col("input_len"), F.col("output_len")
    has = words and words in pairs.columns
    mean = F.expr(f"aggregate(filter({words}, w -> w.score IS NOT NULL), struct(0.0D AS s, 0 AS n), (a, w) -> struct(a.s + w.score AS s, a.n + 1 AS n), a -> a.s / nullif(a.n, 0))") if has else F.lit(None).cast("double")
    others = F.expr(f"size(array_distinct(transform(filter({words}, w -> w.speaker <> output_speaker), w -> w.speaker)))") if has else F.lit(0)
    rate = F.col("overlap_rate") if "overlap_rate" in pairs.columns else F.lit(0.0)
    p = pairs.withColumns({"m_conf": F.coalesce(mean, F.col("avg_score"), F.lit(0.0)), "m_rate": rate, "m_ratio": F.coalesce(F.try_divide(n_in, n_out), F.lit(0.0))})
    sim = similarity("input", "output")
    if similarity is token_cosine:  # tokens are columns first, made once
        p = p.withColumns({"m_in": tokens("input"), "m_out": tokens("output")})
        sim = counts_cosine(F.col("m_in"), F.col("m_out"))
    p = p.withColumns({"m_rs": 1 / (1 + F.col("m_ratio")), "m_punc": punctuation_share("output"), "m_div": F.least(F.lit(1.0), others / 2.0), "m_sim": sim})
    w = weights
    parts = [
        (w.avg_conf, F.col("m_conf")), (w.overlap, 1 - F.col("m_rate")), (w.ratio, F.col("m_rs")), (w.similarity, F.col("m_sim")), (w.punc, F.col("m_punc")), (w.diversity, F.col("m_div")),
        (w.input_len, F.least(n_in / 50.0, F.lit(1.0))), (w.output_len, 1 / (1 + F.exp(-(n_out - 5.0)))),
    ]
    total = sum(x for x, _ in parts)
    q = clamp(sum((F.lit(x) * c for x, c in parts), F.lit(0.0)) / total) if total else F.lit(0.0)
    metrics = F.struct(F.col("m_conf").alias("avg_conf"), F.col("m_rate").alias("overlap_rate"), n_in.alias("input_len"), n_out.alias("output_len"), F.col("m_ratio").alias("ratio"), F.col("m_rs").alias("ratio_score"), F.col("m_punc").alias("punc_score"), F.col("m_div").alias("diversity_score"), F.col("m_sim").alias("semantic_similarity"))
    return p.withColumns({"quality_score": q, "quality_metrics": metrics}).drop("m_conf", "m_rate", "m_ratio", "m_rs", "m_punc", "m_div", "m_sim", "m_in", "m_out")


def legacy_score(pairs: DataFrame, words: DataFrame, target: str) -> DataFrame:
    """`file_id, seg_idx, confidence, ratio, complete, score`: the target's words that stand anywhere in the output, as substrings."""
    w = words.filter(F.col("speaker") == target).groupBy("file_id", F.col("text").alias("t"))
    w = w.agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("total"), F.count("*").alias("n"))  # a file's distinct words only meet its pairs
    hit = pairs.select("file_id", "seg_idx", "output").join(w, "file_id").filter(F.col("output").contains(F.col("t")))
    conf = hit.groupBy("file_id", "seg_idx").agg((F.sum("total") / F.sum("n")).alias("confidence"))
    p = pairs.select("file_id", "seg_idx", "input_len", "output_len", "output").join(conf, ["file_id", "seg_idx"], "left")
    some = F.col("confidence").isNotNull()
    ratio = F.when(some, F.least(F.coalesce(F.try_divide("input_len", "output_len"), F.lit(0.0)), F.lit(4.0))).otherwise(0.0)
    done = F.when(some & F.trim("output").rlike(r"[.?!]$"), 1.0).otherwise(0.0)
    p = p.select("file_id", "seg_idx", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), ratio.alias("ratio"), done.alias("complete"))
    return p.withColumn("score", 0.5 * F.col("confidence") + 0.3 * F.col("ratio") + 0.2 * F.col("complete"))


def result_columns(pairs: DataFrame, pair_format: str) -> DataFrame:
    """Counts of sentences and token ratios of both sides, and the format; `source_filename` and the target's share are the flow's."""
    return pairs.withColumns(
        {"pair_format": F.lit(pair_format), "input_sentence_count": sentence_count("input"), "output_sentence_count": sentence_count("output"), "input_ttr": token_ratio("input"), "output_ttr": token_ratio("output")}
    )


def placeholders(pairs: DataFrame, qna: bool = False) -> DataFrame:
    """A sign for a blank input; its length stays."""
    blank = F.trim(F.coalesce("input", F.lit(""))) == ""
    first = F.coalesce(F.col("is_first_utterance"), F.lit(False)) if "is_first_utterance" in pairs.columns else F.lit(False)
    sign = F.lit("[MISSING QUESTION]") if qna else F.when(first, "[NO PROMPT]").otherwise("[CONTEXT CONTINUES]")
    return pairs.withColumn("input", F.when(blank, sign).otherwise(F.col("input")))
