"""The batch: a folder of audio files in, results and reports out. All files go through one plan; a file that fails at any
model, or in which the target is not heard, is marked in the run log and has no results."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PairConfig
from ..functions.scalar import token_cosine
from ..operators import gates, intervals, report, voice
from ..operators.words import target_words
from ..sources import readers
from ..sources.stages import Stages, delete, input_fingerprint
from . import flow, providers

LOG = logging.getLogger("parley")
#: The target's name in the flow, whatever a file calls them; no model gives it.
TARGET = "\u0001target"


def speech_of(files: DataFrame, models: providers.Models, cfg: PairConfig) -> DataFrame:
    """`file_id, start, end`: by the model, and by energy in files where that hears nothing or where there is none."""
    energy = intervals.energy_vad(readers.wav_frames(files, cfg.frame_seconds), cfg.vad_mult, cfg.frame_seconds)
    if models.vad is None:
        return energy
    heard = providers.intervals(files, models.vad, "speech activity").select("file_id", "start", "end")
    return heard.unionByName(energy.join(heard.select("file_id").distinct(), "file_id", "left_anti"))


def targets_of(files: DataFrame, diar: DataFrame, samples: DataFrame, models: providers.Models, cfg: PairConfig) -> DataFrame:
    """`file_id, speaker, embedding, similarity`: the speaker of each file who sounds like the samples."""
    parts = readers.cut(files, voice.long_enough(diar, cfg.min_emb_duration).select("file_id", "start", "end", "speaker"))
    speakers = voice.centroids(providers.embed(parts, models.voice), ["file_id", "speaker"])
    reference = voice.reference_centroid(providers.embed(samples.withColumn("speaker", F.lit("sample")), models.voice))
    return voice.identify(speakers, reference, cfg.identify_threshold)


def renamed(table: DataFrame, targets: DataFrame) -> DataFrame:
    """Files with a target only, in which that speaker is TARGET."""
    found = targets.select("file_id", F.col("speaker").alias("mine"))
    return table.join(found, "file_id").withColumn("speaker", F.when(F.col("speaker") == F.col("mine"), TARGET).otherwise(F.col("speaker"))).drop("mine")


def run_batch(spark: SparkSession, audio: str, samples: str, out: str, models: providers.Models, cfg: PairConfig = PairConfig(), cache: str | None = None, keep_debug: bool = False) -> DataFrame:
    """Writes `results`, `meta`, `clean`, `merged`, `flagged`, `metrics`, `overlap_summary`, `postfilter_summary`, `report` and
    `run_log` below `out`, and gives the run log: `file_id, seconds`, -1 for a file that failed. Files run together, so the
    seconds of the run are divided by their durations.

    With `cache` tables are kept there and found again by the same configuration and files. Without `keep_debug` merged and
    clean pairs are deleted at the end, and the words with their speakers are not written.
    """
    began = time.time()
    files = readers.audio_files(spark, audio)
    if files.isEmpty():
        LOG.warning("no audio files in %s", audio)
        return spark.createDataFrame([], "file_id string, seconds double")
    stages = Stages(spark, cache, f"{cfg.fingerprint()}-{input_fingerprint(spark, audio, samples)}") if cache else Stages(spark)
    files = stages.write(readers.decoded(files), "files")
    speech = stages.write(speech_of(files, models, cfg), "speech")
    segments = stages.write(providers.transcribe(providers.chunks(files, speech), models.speech), "segments")
    words = providers.aligned(files, segments, models.align)
    diar = stages.write(providers.intervals(files, models.diarize, "diarization").filter("speaker IS NOT NULL"), "diarization")
    words = stages.write(intervals.attach_speakers(words, diar), "assigned")
    targets = stages.write(targets_of(files, diar, readers.decoded(readers.voice_samples(spark, samples)), models, cfg), "targets")

    mine, others = renamed(words, targets), renamed(diar, targets)
    done = flow.flow(mine, others, TARGET, cfg, speech, models.sentences or token_cosine, stages=Stages(spark))
    name = files.select("file_id", "base_name").join(targets.select("file_id", F.col("speaker").alias("mine")), "file_id")
    rows = done.rows.drop("source_filename").join(name, "file_id").withColumnsRenamed({"base_name": "source_filename"})
    rows = rows.withColumn("output_speaker", F.col("mine")).drop("mine")
    readers.write_results(rows, out)
    meta = done.chat.meta.join(name.select("file_id", "mine"), "file_id").withColumn("output_speaker", F.col("mine")).drop("mine")
    clean = done.chat.clean.join(name.select("file_id", "mine"), "file_id").withColumn("output_speaker", F.col("mine")).drop("mine")
    readers.write_merged(done.chat.merged.join(name.select("file_id", "mine"), "file_id").withColumn("output_speaker", F.col("mine")), out)
    readers.write_meta(meta, out)
    readers.write_clean(clean, out)
    readers.write_metrics_csv(meta, out)
    flagged = gates.flag(meta, cfg)
    readers.write_flagged(flagged.select("file_id", "seg_idx", "input", "input_len", "output", "output_len", "overlap_rate", "avg_score", "reasons"), out)
    readers.write_summary(report.overlap_summary(meta, clean, flow.marked_words(done.chat.merged, others, TARGET, cfg)), out, "overlap_summary")
    readers.write_summary(gates.postfilter_counts(clean, cfg, ["file_id"]), out, "postfilter_summary")
    whole = report.final_report(done.rows, files.select("file_id", "duration")).join(target_words(done.words, TARGET), "file_id", "left")
    readers.write_summary(whole.join(gates.flagged_ids(flagged), "file_id", "left"), out, "report")
    if keep_debug:
        words.write.mode("overwrite").json(f"{out}/debug/attached")
    else:
        for pairs in ("merged", "clean"):
            delete(spark, f"{out}/{pairs}")

    heard = targets.select("file_id", F.lit(True).alias("ok")).join(words.select("file_id").distinct(), "file_id", "left_semi")
    total = files.agg(F.sum("duration")).first()[0] or 0.0
    share = F.col("duration") * F.lit((time.time() - began) / total if total else 0.0)
    log = files.select("file_id", "duration").join(heard, "file_id", "left").select("file_id", F.when(F.col("ok"), share).otherwise(-1.0).alias("seconds"))
    path = f"{out}/run_log"
    log.coalesce(1).write.mode("overwrite").json(path)
    log = spark.read.schema("file_id string, seconds double").json(path)
    for r in report.batch_report(log).filter("status = 'FAILED'").select("file_id").limit(20).collect():
        LOG.error("failed: %s", r["file_id"])
    return log
