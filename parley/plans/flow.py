"""The whole flow over word and interval tables. Files are rows like any other: all of them go through one plan. With
`stages` what several steps read is written once and read back; without, all is one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PairConfig
from ..functions.scalar import token_cosine
from ..operators import gates, intervals, merge, qna, relabel, scoring, turns
from ..operators.words import clean_token
from ..sources.stages import Stages

MEAN_SCORE = "aggregate(filter(words, w -> w.score IS NOT NULL), struct(0.0D AS s, 0 AS n), (a, w) -> struct(a.s + w.score AS s, a.n + 1 AS n), a -> a.s / nullif(a.n, 0))"


def kept(stages: Stages | None, df: DataFrame, name: str) -> DataFrame:
    return stages.write(df, name) if stages else df


def prepared(words: DataFrame, target: str, cfg: PairConfig, vad: DataFrame | None = None, similarity=None) -> DataFrame:
    """Words with short ones relabelled. Confidence and speech gates choose who votes and changes; with `use_filtered_words`
    they also choose what stays. `similarity` is the voice model's, as of relabel()."""
    gated = gates.confident(words, cfg)
    if vad is not None:
        gated = intervals.in_speech(gated, vad)
    changed = relabel.relabel(gated.select(words.columns), target, cfg, similarity)
    if cfg.use_filtered_words:
        return changed.drop("relabelled")
    mine = changed.filter("relabelled").select("file_id", "gpos", F.lit(target).alias("now"))
    both = words.join(mine, ["file_id", "gpos"], "left")
    return both.withColumn("speaker", F.coalesce("now", "speaker")).select(words.columns)


def merged_pairs(words: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    return merge.merge_replies(turns.build_pairs(words, target, cfg), cfg.merge_gap)


def marked_words(pairs: DataFrame, diar: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    """The words of replies with `overlapped`. Replies hold the target's words only, so nothing competes with them and the
    strict rule marks none, whatever the intervals; dominance "diarization" does."""
    each = pairs.select("file_id", "seg_idx", F.posexplode("words").alias("at", "w")).select("file_id", "seg_idx", "at", "w.*")
    if cfg.dominance == "strict":
        return each.withColumns({"overlap_frac": F.lit(None).cast("double"), "overlapped": F.lit(False)})
    marked = intervals.overlap_fraction(each, diar, target).withColumn("max_comp", F.lit(0.0))
    return intervals.overlapped(marked, cfg.overlap_frac, cfg.dominance_margin, cfg.dominance).drop("max_comp")


def with_overlap(pairs: DataFrame, diar: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    """Adds `overlap_rate`, and signs the output's overlapped words."""
    if cfg.dominance == "strict":
        return pairs.withColumn("overlap_rate", F.lit(0.0))
    text = marked_words(pairs, diar, target, cfg).withColumn("token", clean_token()).groupBy("file_id", "seg_idx").agg(
        F.avg(F.col("overlapped").cast("int")).alias("overlap_rate"), F.expr("array_join(transform(array_sort(collect_list(struct(at, token))), x -> x.token), ' ')").alias("tagged")
    )
    out = pairs.join(text, ["file_id", "seg_idx"], "left")
    return out.withColumns({"output": F.coalesce("tagged", "output"), "overlap_rate": F.coalesce("overlap_rate", F.lit(0.0))}).drop("tagged")


@dataclass(frozen=True)
class Conversations:
    """`raw`: replies with contexts; `merged`: those close in time as one; `meta`: scored, with metrics and words; `clean`:
    what every reply becomes, with confidence from its words; `rows`: what the gates keep, scored again."""

    raw: DataFrame
    merged: DataFrame
    meta: DataFrame
    clean: DataFrame
    rows: DataFrame


def conversations(words: DataFrame, diar: DataFrame, target: str, cfg: PairConfig, similarity=token_cosine, stages: Stages | None = None) -> Conversations:
    """Merged, scored, filtered and scored again (from avg_score then, and without a second gate)."""
    raw = turns.build_pairs(words, target, cfg)
    merged = kept(stages, merge.merge_replies(raw, cfg.merge_gap), "merged")
    meta = scoring.score(with_overlap(merged, diar, target, cfg), cfg.weights, similarity)
    clean = meta.withColumn("avg_score", F.expr(MEAN_SCORE))
    good = gates.postfilter(clean, cfg).withColumn("alike", F.col("quality_metrics.semantic_similarity"))
    if not cfg.carry_meta:
        good = good.drop("words", "num_context_turns", "is_first_utterance", "quality_metrics", "overlap_rate", "n_merged")
    again = scoring.score(good, cfg.weights, lambda a, b: F.col("alike"), None).drop("alike")  # the texts are the same
    return Conversations(raw, merged, meta, clean, scoring.result_columns(scoring.placeholders(again), "conversational"))


def questions(words: DataFrame, target: str, cfg: PairConfig, similarity=token_cosine) -> DataFrame:
    pairs = gates.postfilter(scoring.score(qna.build_qna(words, target, cfg), cfg.weights, similarity), cfg)
    pairs = pairs.withColumn("num_context_turns", F.lit(1).cast("long"))
    return scoring.result_columns(scoring.placeholders(pairs, qna=True), "qna")


@dataclass(frozen=True)
class Flow:
    words: DataFrame
    chat: Conversations
    rows: DataFrame


def flow(words: DataFrame, diar: DataFrame, target: str, cfg: PairConfig = PairConfig(), vad: DataFrame | None = None, similarity=token_cosine, voice=None, stages: Stages | None = None) -> Flow:
    """All steps for all files, by the route of each; `words` are the conversations' after relabelling."""
    words = kept(stages, words, "words")
    routes = gates.route(words, target, cfg).select("file_id", "mode", F.col("target_ratio").alias("target_speaker_word_ratio"))
    routes = kept(stages, routes, "routes")
    chat = words.join(routes.filter("mode = 'conversational'"), "file_id", "left_semi")
    solo = words.join(routes.filter("mode = 'qna'"), "file_id", "left_semi")
    chat = kept(stages, prepared(chat, target, cfg, vad, voice), "prepared")
    c = conversations(chat, diar, target, cfg, similarity, stages)
    a = c.rows.withColumn("seg_idx", F.col("seg_idx").cast("string"))
    both = a.unionByName(questions(solo, target, cfg, similarity).drop("seg_ord"), allowMissingColumns=True)
    both = both.join(routes.drop("mode"), "file_id").withColumn("source_filename", F.col("file_id").cast("string"))
    return Flow(chat, c, both)


def run(words: DataFrame, diar: DataFrame, target: str, cfg: PairConfig = PairConfig(), vad: DataFrame | None = None, similarity=token_cosine, stages: Stages | None = None) -> DataFrame:
    """Result rows of all files."""
    return flow(words, diar, target, cfg, vad, similarity, stages=stages).rows
