"""Interval joins between words and speaker or speech intervals of the same file.

Both sides are dealt into bins of time, so a long file is many join keys, and a pair is made only in the bin in which
its overlap begins: once, by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BIN = 10.0


def bins(start, end, width: float):
    first = F.floor(F.col(start) / width)
    return F.explode(F.sequence(first, F.greatest(first, F.floor(F.col(end) / width))))


def overlapping(words: DataFrame, intervals: DataFrame, width: float = BIN) -> DataFrame:
    """Words with `s, e` and intervals `ds, de, ..`: each pair that strictly overlaps, once. Intervals of no or negative length overlap nothing."""
    a = words.withColumn("bin", bins("s", "e", width))
    b = intervals.filter("de > ds").withColumn("bin", bins("ds", "de", width))
    cond = (F.col("s") < F.col("de")) & (F.col("ds") < F.col("e")) & (F.col("bin") == F.floor(F.greatest("s", "ds") / width))
    return a.join(b, ["file_id", "bin"]).filter(cond).drop("bin")


def renamed(intervals: DataFrame, *more: str) -> DataFrame:
    return intervals.select("file_id", F.col("start").alias("ds"), F.col("end").alias("de"), *more)


def attach_speakers(words: DataFrame, diar: DataFrame, width: float = BIN) -> DataFrame:
    """Each word's speaker is that of the interval with the largest overlap, the first of equals, or unknown. A null start is 0, a null end the start."""
    w = words.withColumns({"s": F.coalesce("start", F.lit(0.0)), "e": F.coalesce("end", "start", F.lit(0.0))})
    d = renamed(diar, F.col("speaker").alias("found"), "ord")
    size = F.least("e", "de") - F.greatest("s", "ds")
    pick = overlapping(w.select("file_id", "gpos", "s", "e"), d, width).groupBy("file_id", "gpos").agg(F.max(F.struct(size.alias("size"), (-F.col("ord")).alias("o"), "found")).alias("m"))
    both = words.drop("speaker").join(pick, ["file_id", "gpos"], "left")
    return both.withColumn("speaker", F.coalesce("m.found", F.lit("unknown"))).drop("m")


def attach_counts(words: DataFrame) -> DataFrame:
    return words.groupBy("file_id", "speaker").agg(F.count("*").alias("n_words"))


def in_speech(words: DataFrame, vad: DataFrame, width: float = BIN) -> DataFrame:
    """Words that strictly overlap a speech interval; words without times are dropped."""
    w = words.filter("start IS NOT NULL AND end IS NOT NULL AND end >= start").withColumns({"s": F.col("start"), "e": F.col("end")})
    a, b = w.withColumn("bin", bins("s", "e", width)), renamed(vad).filter("de >= ds").withColumn("bin", bins("ds", "de", width))
    hit = a.join(b, ["file_id", "bin"]).filter("s < de AND ds < e").select("file_id", "gpos").distinct()
    return words.join(hit, ["file_id", "gpos"], "left_semi")


def overlap_fraction(words: DataFrame, diar: DataFrame, target: str, width: float = BIN) -> DataFrame:
    """Adds `overlap_frac`: overlaps with intervals of others than the target over the word's length; 0 without times or length."""
    timed = words.filter("end > start").select("file_id", "gpos", F.col("start").alias("s"), F.col("end").alias("e"))
    size = F.least("e", "de") - F.greatest("s", "ds")
    sums = overlapping(timed, renamed(diar.filter(F.col("speaker") != target)), width)
    sums = sums.groupBy("file_id", "gpos").agg((F.sum(size) / F.first(F.col("e") - F.col("s"))).alias("overlap_frac"))
    return words.join(sums, ["file_id", "gpos"], "left").withColumn("overlap_frac", F.coalesce("overlap_frac", F.lit(0.0)))


def competing_score(words: DataFrame, group: str = "seg_idx", width: float = BIN) -> DataFrame:
    """Adds `max_comp`: the best score among words of other speakers in the same group that overlap in time, else 0."""
    timed = words.filter("end > start")
    a = timed.select("file_id", group, "gpos", F.col("speaker").alias("me"), F.col("start").alias("s"), F.col("end").alias("e"))
    b = timed.select("file_id", F.col(group).alias("g2"), F.col("speaker").alias("you"), "score", F.col("start").alias("ds"), F.col("end").alias("de"))
    best = overlapping(a, b, width).filter((F.col(group) == F.col("g2")) & (F.col("me") != F.col("you"))).groupBy("file_id", "gpos").agg(F.max("score").alias("max_comp"))
    return words.join(best, ["file_id", "gpos"], "left").withColumn("max_comp", F.coalesce("max_comp", F.lit(0.0)))


def overlapped(words: DataFrame, frac: float = 0.8, margin: float = 0.05, dominance: str = "strict"):
    """Adds `overlapped`. Strict: covered by others and clearly below a competing word; "diarization": covered by others."""
    covered = F.col("overlap_frac") > frac
    weak = F.coalesce(F.col("score"), F.lit(0.0)) + margin < F.col("max_comp")
    return words.withColumn("overlapped", covered if dominance == "diarization" else covered & weak)


def neighbour_votes(words: DataFrame, target: str, window: float = 1.0) -> DataFrame:
    """Adds `votes` of words that begin within `window` seconds, itself included, and `target_votes`; a null start is 0."""
    w = words.withColumn("at", F.coalesce("start", F.lit(0.0)))
    frame = f"over (partition by file_id order by at range between {window}D preceding and {window}D following)"
    return w.selectExpr(*words.columns, f"count(*) {frame} as votes", f"count_if(speaker = '{target}') {frame} as target_votes")


def energy_vad(frames: DataFrame, mult: float = 0.3, frame_seconds: float = 0.03) -> DataFrame:
    """`file_id, idx, energy` -> `file_id, start, end`: runs of frames above mean + mult * population deviation."""
    stats = frames.groupBy("file_id").agg((F.avg("energy") + mult * F.stddev_pop("energy")).alias("limit"))
    loud = frames.join(stats, "file_id").filter("energy > limit")
    loud = loud.withColumn("run", F.col("idx") - F.row_number().over(W.partitionBy("file_id").orderBy("idx")))
    return loud.groupBy("file_id", "run").agg((F.min("idx") * frame_seconds).alias("start"), ((F.max("idx") + 1) * frame_seconds).alias("end")).drop("run")
