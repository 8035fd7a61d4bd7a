"""What speech, voice and sentence models give, as functions that the flow calls. None is at hand here: callers give theirs,
or tables of their results are read. A model works on one content at a time in a Python task; what it can't do is left out."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.words import normalise, shift, sorted_segments
from ..sources.readers import cut

LOG = logging.getLogger("parley")
SEGMENTS = "file_id string, chunk long, seg long, start double, end double, text string, language string"
RAW_WORDS = "file_id string, seg_idx long, pos long, word string, text string, token string, start string, end string, score double, confidence double, speaker string"


class ProviderMissing(RuntimeError):
    pass


def missing(name: str):
    def call(*_):
        raise ProviderMissing(f"no {name} model was given")

    return call


@dataclass(frozen=True)
class Models:
    """speech(content) -> {"language", "segments": [{"start", "end", "text"}]}; align(content, segments) -> the same segments
    with "words"; diarize(content) -> [(start, end, speaker)]; vad(content) -> [(start, end)] or None for energy; voice(content)
    -> vector or None; sentences: similarity of two columns or None for token counts."""

    speech: Callable = missing("speech")
    align: Callable = missing("alignment")
    diarize: Callable = missing("diarization")
    voice: Callable = missing("voice")
    vad: Callable | None = None
    sentences: Callable | None = None


def attempt(what: str, f: Callable, *args):
    """The model's answer, or None if it fails; the log says so."""
    try:
        return f(*args)
    except ProviderMissing:
        raise
    except Exception as e:  # noqa: BLE001 - models raise anything
        LOG.warning("%s failed: %s", what, e)
        return None


def chunks(files: DataFrame, speech: DataFrame) -> DataFrame:
    """`file_id, chunk, offset, content`: the speech of each file, or all of a file without any."""
    parts = cut(files, speech.select("file_id", "start", "end")).select("file_id", "chunk", "offset", "content")
    whole = files.filter("content IS NOT NULL").join(speech.select("file_id").distinct(), "file_id", "left_anti")
    return parts.unionByName(whole.select("file_id", F.lit(0).cast("long").alias("chunk"), F.lit(0.0).alias("offset"), "content"))


def transcribe(parts: DataFrame, model: Callable = missing("speech")) -> DataFrame:
    """chunks() -> `file_id, seg_idx, start, end, text, language`: segments with times from the start of the file, a null time
    of a chunk counting as 0, in order of start; chunks that fail give none. The language is the first chunk's, or en."""

    def run(frames):
        for pdf in frames:
            for f, k, content in zip(pdf["file_id"], pdf["chunk"], pdf["content"], strict=True):
                found = attempt("transcription", model, content)
                rows = [(f, k, -1, None, None, None, found.get("language"))] if found else []
                rows += [(f, k, i, s.get("start"), s.get("end"), s.get("text"), None) for i, s in enumerate((found or {}).get("segments") or [])]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in SEGMENTS.split(", ")])

    found = parts.select("file_id", "chunk", "content").mapInPandas(run, SEGMENTS)
    # a row without a segment says which language a chunk is in
    language = found.filter("seg < 0").groupBy("file_id").agg(F.coalesce(F.min_by("language", F.when(F.col("language").isNotNull(), F.col("chunk"))), F.lit("en")).alias("language"))
    shifted = shift(found.filter("seg >= 0").drop("language"), parts.select("file_id", "chunk", "offset"))
    return sorted_segments(shifted, "chunk", "seg").join(language, "file_id").select("file_id", "seg_idx", "start", "end", "text", "language")


def aligned(files: DataFrame, segments: DataFrame, model: Callable = missing("alignment")) -> DataFrame:
    """Segments -> word rows `file_id, seg_idx, pos, gpos, text, start, end, score, speaker`. Files that fail give none."""
    said = segments.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("seg_idx", "start", "end", "text"))).alias("segments"))
    names = [c.split()[0] for c in RAW_WORDS.split(", ")]

    def run(frames):
        for pdf in frames:
            for f, content, segs in zip(pdf["file_id"], pdf["content"], pdf["segments"], strict=True):
                found = attempt("alignment", model, content, [{k: s[k] for k in ("start", "end", "text")} for s in segs]) or []
                rows = [(f, i, j, *(w.get(c) if c in ("score", "confidence") else None if w.get(c) is None else str(w[c]) for c in names[3:])) for i, s in enumerate(found) for j, w in enumerate(s.get("words") or [])]
                yield pd.DataFrame(rows, columns=names)

    raw = files.select("file_id", "content").join(said, "file_id").mapInPandas(run, RAW_WORDS)
    words = normalise(raw).filter("text <> ''")
    each = words.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("seg_idx", "pos", "text", "start", "end", "score", "speaker"))).alias("w"))
    each = each.select("file_id", F.posexplode("w").alias("gpos", "w"))
    return each.select("file_id", "w.seg_idx", "w.pos", F.col("gpos").cast("long").alias("gpos"), "w.text", "w.start", "w.end", "w.score", "w.speaker")


def intervals(files: DataFrame, model: Callable, what: str) -> DataFrame:
    """`file_id, start, end, speaker, ord` of what a model hears in each content; the speaker is null where it gives none."""

    def run(frames):
        for pdf in frames:
            for f, content in zip(pdf["file_id"], pdf["content"], strict=True):
                found = sorted(((float(x[0]), float(x[1]), x[2] if len(x) > 2 else None) for x in attempt(what, model, content) or []), key=lambda x: x[0])
                yield pd.DataFrame([(f, *x, k) for k, x in enumerate(found)], columns=["file_id", "start", "end", "speaker", "ord"])

    return files.filter("content IS NOT NULL").select("file_id", "content").mapInPandas(run, "file_id string, start double, end double, speaker string, ord long")


def embed(parts: DataFrame, model: Callable = missing("voice"), keys: tuple[str, ...] = ("file_id", "speaker")) -> DataFrame:
    """Rows with `content` -> the keys and `embedding`; contents that give no vector have no row."""
    schema = ", ".join(f"{k} string" for k in keys) + ", embedding array<double>"

    def run(frames):
        for pdf in frames:
            rows = [(*(pdf[k].iloc[i] for k in keys), found) for i, content in enumerate(pdf["content"]) if (found := attempt("embedding", model, content)) is not None]
            yield pd.DataFrame([(*r[:-1], [float(x) for x in r[-1]]) for r in rows], columns=[*keys, "embedding"])

    return parts.select(*keys, "content").mapInPandas(run, schema)
