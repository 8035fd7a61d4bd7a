"""One query for each operator, over tables derived from the driver's (see sources/fixtures.py)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PairConfig
from ..functions import scalar as fn
from ..operators import gates, intervals, merge, qna, relabel, report, scoring, turns, voice
from ..operators import words as wo
from ..sources import fixtures as fx
from ..sources.stages import Stages
from . import flow

TARGET, CFG = "assistant", PairConfig()
SMALL_WORDS = ("the", "of", "and")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t in ("int", "decimal(20,0)") else F.col(c) for c, t in df.dtypes])


def on_words(make, source=lambda w: w):
    return lambda spark, d: rounded(make(source(fx.words(spark, d))))


def on_pairs(make):
    return lambda spark, d: rounded(make(turns.build_pairs(fx.words(spark, d), TARGET, CFG)))


def scored(spark, d) -> DataFrame:
    p = scoring.score(flow.merged_pairs(fx.words(spark, d), TARGET, CFG))
    return p.withColumn("avg_score", F.col("quality_metrics.avg_conf"))


def on_scored(make):
    return lambda spark, d: rounded(make(scored(spark, d)))


def on_documents(name: str, column):
    return lambda spark, d: rounded(fx.table(spark, d, "documents").select("doc_id", column(F.col("text")).alias(name)))


def word_normalise(spark, d):
    w = fx.words(spark, d)
    raw = w.select(
        "file_id",
        "gpos",
        F.lit("").alias("text"),
        F.when(F.col("gpos") % 5 != 0, F.col("text")).alias("word"),
        F.col("text").alias("token"),
        F.when(F.col("gpos") % 7 == 0, "n/a").otherwise(F.col("start").cast("string")).alias("start"),
        F.when(F.col("gpos") % 3 != 0, F.col("score")).alias("score"),
        F.col("score").alias("confidence"),
        F.when(F.col("gpos") % 11 != 0, F.col("speaker")).alias("speaker"),
    )
    return rounded(wo.normalise(raw).drop("end"))


def with_diar(make):
    def run(spark, d):
        w = fx.words(spark, d)
        return rounded(make(w, fx.diar(w)))

    return run


def config_sweep(pairs: DataFrame) -> DataFrame:
    rows = [("code", CFG), ("readme", PairConfig.readme()), ("tuned", PairConfig.tuned()), ("strict", CFG.with_(min_words=12, min_conf=0.7, min_quality=0.65))]
    configs = pairs.sparkSession.createDataFrame([(n, c.min_words, c.min_conf, c.min_quality) for n, c in rows], "cfg string, min_words int, min_conf double, min_quality double")
    return gates.sweep(pairs, configs)


FLAGS = CFG.with_(flag_overlap=0.2, flag_low_conf=0.65, flag_ratio=1.0, dominance="diarization")


def flagged(spark, d) -> DataFrame:
    """Pairs flagged with overlaps by intervals, so that each reason occurs."""
    w = fx.words(spark, d)
    meta = flow.with_overlap(flow.merged_pairs(w, TARGET, CFG), fx.diar(w), TARGET, FLAGS)
    return gates.flag(scoring.score(meta).withColumn("avg_score", F.col("quality_metrics.avg_conf")), FLAGS)


def auto_flag(spark, d) -> DataFrame:
    return rounded(flagged(spark, d).select("file_id", "seg_idx", F.round("overlap_rate", 9).alias("overlap_rate"), F.array_join("reasons", ",").alias("reasons")))


def flagged_ids(spark, d) -> DataFrame:
    return gates.flagged_ids(flagged(spark, d)).select("file_id", F.array_join(F.transform("flagged_ids", lambda x: x.cast("string")), ",").alias("flagged_ids"))


def chunk_shift(words: DataFrame) -> DataFrame:
    w = words.select("file_id", (F.col("seg_idx") % 4).alias("chunk"), "gpos", F.when(F.col("gpos") % 9 != 0, F.col("start")).alias("start"), "end")
    return wo.shift(w, w.select("file_id", "chunk", (F.col("chunk") * 30.5).alias("offset")).distinct()).drop("chunk")


def segments_sorted(words: DataFrame) -> DataFrame:
    segs = words.select("file_id", F.col("seg_idx").alias("was")).distinct()
    segs = segs.withColumn("start", F.when(F.col("was") % 7 != 0, (F.col("was") * 37 % 11).cast("double")))
    return wo.sorted_segments(segs, "was")


def mixed_replies(words: DataFrame) -> DataFrame:
    """Pairs of which the words are those of several speakers: groups of four segments."""
    w = words.withColumn("seg_idx", F.floor(F.col("seg_idx") / 4).cast("long"))
    item = F.struct("gpos", "text", "speaker", "start", "end", "score")
    p = w.groupBy("file_id", "seg_idx").agg(F.array_sort(F.collect_list(item)).alias("words"))
    text = F.array_join(F.transform("words", lambda x: x["text"]), " ")
    return p.select("file_id", "seg_idx", "words", F.lit("").alias("input"), F.lit(0).cast("long").alias("input_len"), text.alias("output"), F.size("words").cast("long").alias("output_len"), F.lit(TARGET).alias("output_speaker"), F.lit(None).cast("double").alias("avg_score"))


def batch_report(words: DataFrame) -> DataFrame:
    return report.batch_report(words.select("file_id").distinct().withColumn("seconds", F.when(F.col("file_id") % 5 == 0, -1.0).otherwise(F.col("file_id") * 7.5)))


def prepared_words(spark, d) -> DataFrame:
    """Noisy words after the gates and the cascade."""
    w = fx.words(spark, d)
    return flow.prepared(fx.words_noisy(w), TARGET, CFG, fx.vad(fx.diar(w)))


def overlap_summary(spark, d):
    w = fx.words(spark, d)
    p = scored(spark, d)
    each = p.select("file_id", F.explode("words").alias("w")).select("file_id", "w.*")
    marked = intervals.overlapped(intervals.overlap_fraction(each, fx.diar(w), TARGET).withColumn("max_comp", F.lit(0.0)), CFG.overlap_frac, CFG.dominance_margin, "diarization")
    return rounded(report.overlap_summary(p, gates.postfilter(p, CFG), marked))


def final_report(spark, d):
    w = fx.words(spark, d)
    files = w.groupBy("file_id").agg(F.max("end").alias("duration"))
    return rounded(report.final_report(scored(spark, d), files).drop("target_time"))


def events_merged(spark, d):
    e = merge.merge_events(fx.table(spark, d, "events"), 6)
    return rounded(e.select("user_id", "grp", "n", merge.micros("first_ts").alias("first_us"), merge.micros("last_ts").alias("last_us"), "total"))


def by_event_type(strategy: str):
    return lambda spark, d: rounded(gates.cutoffs(fx.table(spark, d, "events"), ["event_type"], CFG, strategy, "value"))


def reference(spark, d) -> DataFrame:
    return voice.reference_centroid(fx.table(spark, d, "embeddings").filter("vec_id = 0"))


def speaker_centroid(spark, d):
    c = voice.centroids(fx.table(spark, d, "embeddings"), ["label"])
    return rounded(c.select(F.col("label").cast("long").alias("label"), F.posexplode("embedding").alias("d", "x")))


def identify_target(spark, d):
    c = voice.centroids(fx.table(spark, d, "embeddings"), ["label"])
    return rounded(voice.rank_speakers(c, reference(spark, d), order="label").select("label", "similarity", "rank"))


def cosine_topk(spark, d):
    return rounded(voice.top_similar(fx.table(spark, d, "embeddings"), reference(spark, d), 10, "vec_id").select("vec_id", "similarity"))


def energy_vad(spark, d):
    idx = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return rounded(intervals.energy_vad(fx.table(spark, d, "events").select(F.col("user_id").alias("file_id"), idx.alias("idx"), F.col("value").alias("energy"))))


def legacy_score(spark, d):
    w = fx.words(spark, d)
    return rounded(scoring.legacy_score(turns.build_pairs(w, TARGET, CFG), w, TARGET))


def conversation_flow(spark, d):
    """Everything, from words and intervals to result rows."""
    w = Stages(spark).write(fx.words(spark, d), "words")
    dia = fx.diar(w)
    out = flow.run(w, dia, TARGET, CFG, fx.vad(dia), stages=Stages(spark))
    return rounded(out.select("file_id", "seg_idx", "input", "input_len", "output", "output_len", "avg_score", "tstart", "tend", "quality_score", "pair_format", "target_speaker_word_ratio", "input_sentence_count", "output_sentence_count", "input_ttr", "output_ttr"))


QUERIES = {
    "conversation_flow": conversation_flow,
    "word_normalise": word_normalise,
    "join_words": on_words(wo.segment_texts),
    "word_count": on_documents("n_words", fn.word_count),
    "keep_last_words": on_words(lambda w: wo.keep_last(wo.segment_texts(w), 5)),
    "filler_removal": on_words(lambda w: wo.without_fillers(w, SMALL_WORDS).select("file_id", "gpos", "text")),
    "filler_count": on_words(lambda w: wo.filler_count(w, SMALL_WORDS, TARGET)),
    "single_segment": on_words(lambda w: wo.one_segment(w).drop("speaker")),
    "attach_speaker_max_overlap": with_diar(lambda w, d: intervals.attach_speakers(w, d).select("file_id", "gpos", "speaker")),
    "attach_counts": on_words(intervals.attach_counts),
    "vad_semi_filter": with_diar(lambda w, d: intervals.in_speech(w, fx.vad(d)).select("file_id", "gpos")),
    "nontarget_overlap_fraction": with_diar(lambda w, d: intervals.overlap_fraction(w, d, TARGET).select("file_id", "gpos", "overlap_frac")),
    "competing_word_max": on_words(lambda w: intervals.competing_score(w.withColumn("end", F.col("start") + 0.9)).select("file_id", "gpos", "max_comp"), fx.words_noisy),
    "neighbour_votes": on_words(lambda w: intervals.neighbour_votes(w, TARGET).select("file_id", "gpos", "votes", "target_votes"), fx.words_noisy),
    "relabel_single_pass": on_words(lambda w: relabel.relabel_once(w, TARGET, CFG).select("file_id", "gpos", "speaker", "relabelled"), fx.words_noisy),
    "relabel_cascade": on_words(lambda w: relabel.relabel(w, TARGET, CFG).select("file_id", "gpos", "speaker", "relabelled"), fx.words_noisy),
    "adaptive_cutoff_p30": by_event_type("percentile"),
    "adaptive_cutoff_median": by_event_type("median"),
    "adaptive_cutoff_words": on_words(lambda w: gates.cutoffs(w, ["file_id", "speaker"], CFG)),
    "adaptive_filter": on_words(lambda w: gates.confident(w, CFG).select("file_id", "gpos", "score")),
    "speaker_dominance": on_words(lambda w: gates.dominance(w, TARGET)),
    "route_mode": on_words(lambda w: gates.route(w, TARGET, CFG).select("file_id", "mode")),
    "speaker_runs": on_words(turns.speaker_runs, fx.words_noisy),
    "context_attach": on_words(lambda w: turns.contexts(w, TARGET).select("file_id", "seg_idx", "has_target", "ctx_id").distinct()),
    "context_turns": on_words(lambda w: turns.context_turns(w, TARGET, CFG), fx.words_multi),
    "reply_prefilter": on_words(lambda w: gates.prefilter(turns.replies(w, TARGET), CFG).select("file_id", "seg_idx", "output", "output_len", "avg_score")),
    "conversation_pairs": on_pairs(lambda p: p.select("file_id", "seg_idx", "input", "input_len", "output", "output_len", "num_context_turns", "is_first_utterance")),
    "merge_close_replies": on_pairs(lambda p: merge.merge_replies(p, CFG.merge_gap).select("file_id", "seg_idx", "input", "output", "output_len", "tstart", "tend", "n_merged")),
    "merge_avg_fold": on_pairs(lambda p: merge.merge_replies(p, CFG.merge_gap).select("file_id", "seg_idx", "avg_score")),
    "event_gap_merge": events_merged,
    "sentence_split": on_words(lambda w: qna.sentences(w, CFG)),
    "qna_pairs": on_words(lambda w: qna.build_qna(w, TARGET, CFG).drop("seg_ord", "words", "output_speaker")),
    "token_ratio": on_documents("ttr", fn.token_ratio),
    "sentence_count": on_documents("n_sentences", fn.sentence_count),
    "punctuation_share": on_documents("share", fn.punctuation_share),
    "rich_text": on_documents("rich", lambda c: fn.rich(c, ("the", "of", "and", "a", "to", "in"))),
    "quality_score": on_scored(lambda p: p.select("file_id", "seg_idx", "quality_score", *[F.col(f"quality_metrics.{m}").alias(m) for m in ("avg_conf", "ratio", "punc_score", "semantic_similarity")])),
    "quality_bucket": on_scored(report.quality_buckets),
    "postfilter_counts": on_scored(lambda p: gates.postfilter_counts(p, CFG)),
    "postfilter": on_scored(lambda p: gates.postfilter(p, CFG).select("file_id", "seg_idx", "quality_score")),
    "auto_flag": auto_flag,
    "flagged_ids": flagged_ids,
    "chunk_shift": on_words(chunk_shift),
    "segments_sorted": on_words(segments_sorted),
    "min_duration": with_diar(lambda w, d: voice.long_enough(d).select("file_id", "ord")),
    "batch_report": on_words(batch_report),
    "prepared_words": lambda spark, d: rounded(prepared_words(spark, d).select("file_id", "gpos", "speaker")),
    "target_words_after_relabel": lambda spark, d: rounded(wo.target_words(prepared_words(spark, d), TARGET)),
    "pair_diversity": lambda spark, d: rounded(scoring.score(mixed_replies(fx.words_multi(fx.words(spark, d)))).select("file_id", "seg_idx", F.col("quality_metrics.diversity_score").alias("diversity_score"), F.col("quality_metrics.avg_conf").alias("avg_conf"))),
    "config_sweep": on_scored(config_sweep),
    "overlap_summary": overlap_summary,
    "final_report": final_report,
    "placeholders": on_pairs(lambda p: scoring.placeholders(p).select("file_id", "seg_idx", "input", "input_len")),
    "speaker_centroid": speaker_centroid,
    "identify_target": identify_target,
    "cosine_topk": cosine_topk,
    "energy_vad": energy_vad,
    "legacy_score_pair": legacy_score,
    "legacy_build_pairs": on_words(lambda w: turns.legacy_pairs(w, TARGET, CFG.with_(fillers=SMALL_WORDS))),
}
