"""Readers and writers of transcripts, speaker intervals, audio and results, with fixed schemas."""

from __future__ import annotations

import io
import json
import wave

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "word string, text string, token string, start string, end string, score double, confidence double, speaker string"
TRANSCRIPT = f"segments array<struct<start:double,end:double,text:string,speaker:string,words:array<struct<{WORD.replace(' ', ':').replace(',:', ',')}>>>>, language string"
INTERVAL = "struct<segment:struct<start:double,end:double>,label:string,speaker:string>"
DIARIZATION = f"uri string, content array<{INTERVAL}>, segments array<{INTERVAL}>"
AUDIO, SAMPLES = r"\.(wav|mp3|m4a)$", r"\.(wav|mp3|flac|m4a|ogg)$"


def base_name(path):
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def audio_files(spark: SparkSession, path: str, suffix: str = AUDIO) -> DataFrame:
    """`file_id` (the path), `base_name`, `content`. No such file: an empty table, and the caller warns."""
    files = spark.read.format("binaryFile").load(path).filter(F.lower("path").rlike(suffix))
    return files.select(F.col("path").alias("file_id"), base_name(F.col("path")).alias("base_name"), "content")


def voice_samples(spark: SparkSession, path: str) -> DataFrame:
    """As audio_files(); an empty folder is an error."""
    found = audio_files(spark, path, SAMPLES)
    if found.isEmpty():
        raise FileNotFoundError(f"no voice samples in {path}")
    return found


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Word rows of cached transcripts: text is the first of text, word and token that isn't empty; times that can't be read are null."""
    raw = spark.read.schema(TRANSCRIPT).json(path, multiLine=True).withColumn("file_id", F.input_file_name())
    segs = raw.select("file_id", "language", F.posexplode("segments").alias("seg_idx", "seg"))
    ws = segs.select("file_id", "language", F.col("seg_idx").cast("long"), F.posexplode("seg.words").alias("pos", "w"))
    return ws.select(
        "file_id",
        "language",
        "seg_idx",
        F.col("pos").cast("long").alias("pos"),
        F.trim(F.coalesce(F.nullif("w.text", F.lit("")), F.nullif("w.word", F.lit("")), "w.token")).alias("text"),
        F.col("w.start").try_cast("double").alias("start"),
        F.col("w.end").try_cast("double").alias("end"),
        F.coalesce("w.score", "w.confidence").alias("score"),
        F.coalesce("w.speaker", F.lit("unknown")).alias("speaker"),
    ).filter("text IS NOT NULL")


def diarization(spark: SparkSession, path: str) -> DataFrame:
    """Speaker intervals of JSON files: of `content`, of `segments` where that has none, or of a list; `label` or `speaker`.
    `ord` is the order of start, then of the file. Entries without a time or name are left out, as are files that can't be read."""
    raw = spark.read.text(path, wholetext=True).withColumn("file_id", F.input_file_name())
    raw = raw.select("file_id", F.when(~F.ltrim("value").startswith("["), F.from_json("value", DIARIZATION)).alias("d"), F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{INTERVAL}>")).alias("l"))
    ok = "x -> x.segment.start IS NOT NULL AND x.segment.end IS NOT NULL AND coalesce(x.label, x.speaker) IS NOT NULL"
    first, then = (F.expr(f"filter(coalesce({c}, array()), {ok})") for c in ("d.content", "coalesce(d.segments, l)"))
    found = F.when(F.size(first) > 0, first).otherwise(then)
    rows = raw.select("file_id", F.array_sort(F.transform(found, lambda x, i: F.struct(x["segment"]["start"].alias("start"), i.alias("i"), x["segment"]["end"].alias("end"), F.coalesce(x["label"], x["speaker"]).alias("speaker")))).alias("xs"))
    rows = rows.select("file_id", F.posexplode("xs").alias("ord", "x"))
    return rows.select("file_id", "x.start", "x.end", "x.speaker", F.col("ord").cast("long").alias("ord"))


def diarization_anywhere(spark: SparkSession, path: str) -> DataFrame:
    """Intervals wherever objects with `segment` and `label` or `speaker` stand in a JSON document of any shape."""

    def hunt(x):
        if isinstance(x, dict):
            seg, label = x.get("segment"), x.get("label") or x.get("speaker")
            if isinstance(seg, dict) and label is not None:
                yield seg.get("start"), seg.get("end"), label
            for v in x.values():
                yield from hunt(v)
        elif isinstance(x, list):
            for v in x:
                yield from hunt(v)

    def number(x):
        try:
            return float(x)
        except (TypeError, ValueError):
            return None

    def parse(frames):
        for pdf in frames:
            for f, text in zip(pdf["path"], pdf["value"], strict=True):
                try:
                    found = [(number(a), number(b), str(s)) for a, b, s in hunt(json.loads(text))]
                except ValueError:
                    continue
                found = sorted((x for x in found if None not in x), key=lambda x: x[0])
                yield pd.DataFrame([(f, *x, k) for k, x in enumerate(found)], columns=["file_id", "start", "end", "speaker", "ord"])

    raw = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    return raw.mapInPandas(parse, "file_id string, start double, end double, speaker string, ord long")


def samples_of(content: bytes):
    """Samples of a WAV content from -1 to 1, its channels averaged, and their rate. ValueError if it is no PCM."""
    import numpy as np

    try:
        with wave.open(io.BytesIO(content)) as w:
            width, channels, rate, raw = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    except (wave.Error, EOFError) as e:
        raise ValueError(str(e)) from e
    if width == 3:
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8)[: len(wide) * 3].reshape(-1, 3)
        pcm = wide.reshape(-1).view("<i4") / 2.0**31
    else:
        pcm = np.frombuffer(raw, {1: "u1", 2: "<i2", 4: "<i4"}[width])
        pcm = (pcm - 128.0) / 128.0 if width == 1 else pcm / 2.0 ** (8 * width - 1)
    return pcm[: len(pcm) // channels * channels].reshape(-1, channels).mean(axis=1), rate


def wav_of(samples, rate: int) -> bytes:
    """A 16-bit WAV content of one channel."""
    import numpy as np

    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.round(np.asarray(samples) * 32768), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def decoded(files: DataFrame, rate: int = 16_000, decoder=samples_of) -> DataFrame:
    """`file_id, base_name, content, duration`: contents as 16-bit mono WAV of that rate, seconds in whole milliseconds.
    `decoder(content)` gives samples and their rate; the one at hand knows WAV, others can be given. What it can't read
    has a null content and a duration of 0."""
    import numpy as np

    def run(frames):
        for pdf in frames:
            for f, name, content in zip(pdf["file_id"], pdf["base_name"], pdf["content"], strict=True):
                try:
                    samples, was = decoder(content)
                    n = round(len(samples) * rate / was)
                    if was != rate:
                        samples = np.interp(np.arange(n) * (was / rate), np.arange(len(samples)), samples) if n else samples[:0]
                    row = (f, name, wav_of(samples, rate), int(n * 1000 / rate) / 1000)
                except (ValueError, KeyError, ZeroDivisionError):
                    row = (f, name, None, 0.0)
                yield pd.DataFrame([row], columns=["file_id", "base_name", "content", "duration"])

    return files.select("file_id", "base_name", "content").mapInPandas(run, "file_id string, base_name string, content binary, duration double")


def cut(files: DataFrame, intervals: DataFrame) -> DataFrame:
    """`file_id, chunk, offset, end, content` and what else the intervals have: WAV contents of `files(file_id, content)` by
    `intervals(file_id, start, end, ..)`, numbered from 0 in order of start. Files without an interval give none."""
    more = [c for c in intervals.columns if c not in ("file_id", "start", "end")]
    kinds = dict(intervals.dtypes)
    spans = intervals.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", *more))).alias("spans"))

    def run(frames):
        for pdf in frames:
            for f, content, spans in zip(pdf["file_id"], pdf["content"], pdf["spans"], strict=True):
                samples, rate = samples_of(content)
                for k, s in enumerate(spans):
                    part = samples[max(0, int(s["start"] * rate)) : max(0, int(s["end"] * rate))]
                    yield pd.DataFrame([(f, k, s["start"], s["end"], *(s[c] for c in more), wav_of(part, rate))], columns=["file_id", "chunk", "offset", "end", *more, "content"])

    schema = "file_id string, chunk long, offset double, end double, " + "".join(f"{c} {kinds[c]}, " for c in more) + "content binary"
    return files.filter("content IS NOT NULL").select("file_id", "content").join(spans, "file_id").mapInPandas(run, schema)


def wav_frames(files: DataFrame, frame_seconds: float = 0.03) -> DataFrame:
    """`file_id, idx, energy`: root mean square of each whole frame of WAV contents, channels averaged."""
    import numpy as np

    def read(frames):
        for pdf in frames:
            for f, content in zip(pdf["file_id"], pdf["content"], strict=True):
                try:
                    samples, rate = samples_of(content)
                except (ValueError, KeyError):
                    continue
                size = int(rate * frame_seconds)
                n = len(samples) // size if size else 0
                energy = np.sqrt((samples[: n * size].reshape(n, size) ** 2).mean(axis=1)) if n else []
                yield pd.DataFrame({"file_id": f, "idx": range(n), "energy": np.asarray(energy, float)})

    return files.filter("content IS NOT NULL").select("file_id", "content").mapInPandas(read, "file_id string, idx long, energy double")


def pairs_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_results(pairs: DataFrame, out: str) -> None:
    pairs.write.mode("overwrite").partitionBy("source_filename").json(f"{out}/results")


def write_merged(pairs: DataFrame, out: str) -> None:
    pairs.select("input", "output", "output_speaker").write.mode("overwrite").json(f"{out}/merged")


def write_meta(pairs: DataFrame, out: str) -> None:
    pairs.write.mode("overwrite").json(f"{out}/meta")


def write_clean(pairs: DataFrame, out: str) -> None:
    keep = ["seg_idx", "input", "input_len", "output", "output_len", "output_speaker", "avg_score", "tstart", "tend", "quality_score"]
    pairs.select(*keep).write.mode("overwrite").json(f"{out}/clean")


def write_metrics_csv(pairs: DataFrame, out: str) -> None:
    pairs.select("seg_idx", "quality_score", "quality_metrics.*").write.mode("overwrite").csv(f"{out}/metrics", header=True)


def write_flagged(flagged: DataFrame, out: str) -> None:
    flagged.write.mode("overwrite").json(f"{out}/flagged")


def write_summary(summary: DataFrame, out: str, name: str = "summary") -> None:
    summary.coalesce(1).write.mode("overwrite").json(f"{out}/{name}")
