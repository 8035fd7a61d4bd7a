"""Replies of the target speaker with the turns before them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PairConfig
from ..functions.scalar import last_words, word_count
from .gates import first_in_file, prefilter

def by_file():
    return W.partitionBy("file_id").orderBy("gpos")


def runs(words: DataFrame) -> DataFrame:
    """Adds `run`: a number that grows where the speaker changes, in file order."""
    changed = (~F.col("speaker").eqNullSafe(F.lag("speaker").over(by_file()))) | (F.row_number().over(by_file()) == 1)
    return words.withColumn("changed", changed.cast("int")).withColumn("run", F.sum("changed").over(by_file().rowsBetween(W.unboundedPreceding, W.currentRow))).drop("changed")


def speaker_runs(words: DataFrame) -> DataFrame:
    """`file_id, run, speaker, n_words, start, end`."""
    return runs(words).groupBy("file_id", "run").agg(F.first("speaker").alias("speaker"), F.count("*").alias("n_words"), F.min_by("start", "gpos").alias("start"), F.max_by("end", "gpos").alias("end"))


def contexts(words: DataFrame, target: str) -> DataFrame:
    """Adds `has_target` of the segment and `ctx_id`, the number of segments with the target before it: words of
    segments without the target are the context of the next segment with it that has the same number."""
    segs = words.groupBy("file_id", "seg_idx").agg(F.max(F.col("speaker") == target).alias("has_target"))
    before = W.partitionBy("file_id").orderBy("seg_idx").rowsBetween(W.unboundedPreceding, -1)
    segs = segs.withColumn("ctx_id", F.coalesce(F.sum(F.col("has_target").cast("int")).over(before), F.lit(0)))
    return words.join(segs, ["file_id", "seg_idx"])


def context_turns(words: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    """`file_id, ctx_id, input, input_len, num_context_turns`: the last turns `speaker: "words"`, then their last words."""
    ctx = contexts(words, target).filter(~F.col("has_target"))
    w = W.partitionBy("file_id", "ctx_id").orderBy("gpos")
    changed = (~F.col("speaker").eqNullSafe(F.lag("speaker").over(w))) | (F.row_number().over(w) == 1)
    ctx = ctx.withColumn("c", changed.cast("int")).withColumn("turn", F.sum("c").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    said = F.expr("array_join(transform(array_sort(collect_list(struct(gpos, text))), x -> x.text), ' ')")
    turn = ctx.groupBy("file_id", "ctx_id", "turn").agg(F.first("speaker").alias("speaker"), said.alias("said"))
    turn = turn.withColumn("said", F.concat(F.coalesce("speaker", F.lit("None")), F.lit(': "'), "said", F.lit('"')))
    turn = turn.withColumn("back", F.row_number().over(W.partitionBy("file_id", "ctx_id").orderBy(F.desc("turn")))).filter(F.col("back") <= cfg.max_context)
    text = F.expr("array_join(transform(array_sort(collect_list(struct(turn, said))), x -> x.said), ' ')")
    out = turn.groupBy("file_id", "ctx_id").agg(text.alias("input"), F.count("*").alias("num_context_turns"))
    out = out.withColumn("input", last_words("input", cfg.max_input_words))
    return out.select("file_id", "ctx_id", "input", word_count("input").alias("input_len"), "num_context_turns")


def replies(words: DataFrame, target: str) -> DataFrame:
    """`file_id, seg_idx, ctx_id, output, output_len, output_speaker, avg_score, tstart, tend, words`, one row for a segment with the target."""
    said = contexts(words, target).filter("has_target").filter(F.col("speaker") == target)
    item = F.struct("gpos", "text", "speaker", "start", "end", "score")
    r = said.groupBy("file_id", "seg_idx").agg(F.first("ctx_id").alias("ctx_id"), F.array_sort(F.collect_list(item)).alias("words"), F.avg("score").alias("avg_score"), F.min("start").alias("tstart"), F.max("end").alias("tend"))
    r = r.withColumn("output", F.trim(F.array_join(F.transform("words", lambda w: w["text"]), " ")))
    return r.select("file_id", "seg_idx", "ctx_id", "output", word_count("output").alias("output_len"), F.lit(target).alias("output_speaker"), "avg_score", "tstart", "tend", "words")


def build_pairs(words: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    """The kept replies with their contexts."""
    kept = prefilter(replies(words, target), cfg)
    pairs = kept.join(context_turns(words, target, cfg), ["file_id", "ctx_id"], "left").drop("ctx_id")
    pairs = pairs.withColumns({"input": F.coalesce("input", F.lit("")), "input_len": F.coalesce("input_len", F.lit(0)), "num_context_turns": F.coalesce("num_context_turns", F.lit(0))})
    return first_in_file(pairs)


def legacy_pairs(words: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    """The older builder: target runs grow an output until another speaker's run or a long gap ends it; the runs of
    others before it, without fillers, are the input. One row a pair: `file_id, pair, input, input_len, output, output_len, tstart, tend`."""
    r = runs(words)
    w = W.partitionBy("file_id").orderBy("run")
    each = r.groupBy("file_id", "run").agg(F.first("speaker").alias("speaker"), F.min_by("start", "gpos").alias("s"), F.max_by("end", "gpos").alias("e"))
    mine, lag = F.col("speaker") == target, F.lag(F.col("speaker") == target).over(w)
    gap = F.col("s") - F.lag("e").over(w) > cfg.merge_gap
    flush = F.coalesce((lag & ~mine) | (lag & mine & gap), F.lit(False))
    each = each.withColumn("pair", F.sum(flush.cast("int")).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    tagged = r.join(each.select("file_id", "run", "pair"), ["file_id", "run"]).withColumn("mine", F.col("speaker") == target)
    tagged = tagged.filter(F.col("mine") | ~F.lower(F.trim("text")).isin(*cfg.fillers))
    text = lambda cond: F.expr(f"array_join(transform(array_sort(collect_list(if({cond}, struct(gpos, text), null))), x -> x.text), ' ')")
    out = tagged.groupBy("file_id", "pair").agg(text("not mine").alias("input"), text("mine").alias("output"), F.min(F.when(F.col("mine"), F.col("start"))).alias("tstart"), F.max(F.when(F.col("mine"), F.col("end"))).alias("tend"))
    out = out.filter("output <> ''").withColumn("input", last_words("input", cfg.max_input_words))
    return out.select("file_id", "pair", "input", word_count("input").alias("input_len"), "output", word_count("output").alias("output_len"), "tstart", "tend")
