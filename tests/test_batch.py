"""The batch from a folder of audio to its sinks, with stub models, and its parts."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.config import PairConfig
from parley.operators import relabel, voice
from parley.operators import words as wo
from parley.plans import batch, providers
from parley.sources import readers
from parley.sources.stages import Stages, input_fingerprint

RATE = 16_000


def tones(*parts, rate=RATE):
    """Square waves (seconds, amplitude)."""
    return np.concatenate([np.where(np.arange(int(s * rate)) % 2, a, -a) for s, a in parts])


def stub_models():
    """Who speaks is told by loudness; the texts are fixed."""

    def regions(content):
        from parley.sources.readers import samples_of

        x, rate = samples_of(content)
        level = np.round(np.abs(x[: len(x) // 160 * 160]).reshape(-1, 160).mean(axis=1), 1)
        cuts = [0, *(np.flatnonzero(np.diff(level)) + 1).tolist(), len(level)]
        return [(a * 160 / rate, b * 160 / rate, float(level[a])) for a, b in zip(cuts, cuts[1:], strict=False) if b > a and level[a] > 0.05]

    def speech(content):
        found = regions(content)
        if not found:
            raise RuntimeError("nothing is said")
        said = {0.2: "tell me about the weather today", 0.6: "well it is warm and rather sunny outside today."}
        return {"language": "de", "segments": [{"start": a, "end": b, "text": said[v]} for a, b, v in found]}

    def align(content, segments):
        out = []
        for s in segments:
            words = s["text"].split()
            step = (s["end"] - s["start"]) / len(words)
            out.append({"words": [{"word": w, "start": s["start"] + k * step, "end": s["start"] + (k + 0.9) * step, "score": 0.9} for k, w in enumerate(words)]})
        return out

    def diarize(content):
        return [(a, b, f"S{v}") for a, b, v in regions(content)]

    def sound(content):
        from parley.sources.readers import samples_of

        x = np.abs(samples_of(content)[0]).mean() if content else 0
        return [x, 0.4]

    return providers.Models(speech=speech, align=align, diarize=diarize, vad=lambda c: [(a, b) for a, b, _ in regions(c)], voice=sound)


@pytest.fixture
def folders(tmp_path):
    audio, samples = tmp_path / "audio", tmp_path / "samples"
    audio.mkdir(), samples.mkdir()
    talk = tones((1.5, 0.2), (0.5, 0.0), (2.0, 0.6), (3.0, 0.0), (1.5, 0.2), (0.5, 0.0), (2.0, 0.6))
    (audio / "talk.wav").write_bytes(readers.wav_of(talk, RATE))
    (audio / "alone.WAV").write_bytes(readers.wav_of(tones((2.0, 0.2)), RATE))
    (audio / "broken.mp3").write_bytes(b"no audio")
    (audio / "notes.txt").write_text("not audio")
    (samples / "me.wav").write_bytes(readers.wav_of(tones((1.0, 0.6)), RATE))
    return str(audio), str(samples), str(tmp_path / "out")


def test_batch_writes_all_sinks(spark, folders):
    audio, samples, out = folders
    cfg = PairConfig(identify_threshold=0.98, min_quality=0.4)
    log = {r["file_id"].rsplit("/", 1)[-1]: r["seconds"] for r in batch.run_batch(spark, audio, samples, out, stub_models(), cfg, keep_debug=True).collect()}
    assert set(log) == {"talk.wav", "alone.WAV", "broken.mp3"} and log["talk.wav"] > 0 and log["alone.WAV"] == log["broken.mp3"] == -1
    rows = spark.read.json(f"{out}/results").orderBy("tstart").collect()
    assert [(r["source_filename"], r["input"], r["output"], r["output_speaker"], r["pair_format"]) for r in rows] == [("talk", 'S0.2: "tell me about the weather today"', "well it is warm and rather sunny outside today.", "S0.6", "conversational")] * 2
    assert rows[0]["tstart"] == pytest.approx(2.0) and rows[1]["tstart"] == pytest.approx(9.0)
    assert spark.read.json(f"{out}/meta").count() == spark.read.json(f"{out}/clean").count() == spark.read.json(f"{out}/merged").count() == 2
    assert {"words", "quality_metrics", "overlap_rate"} <= set(spark.read.json(f"{out}/meta").columns)
    assert set(spark.read.json(f"{out}/merged").columns) == {"input", "output", "output_speaker"}
    metrics = spark.read.csv(f"{out}/metrics", header=True)
    assert metrics.columns[:3] == ["seg_idx", "quality_score", "avg_conf"] and len(metrics.columns) == 11 and metrics.count() == 2
    assert spark.read.json(f"{out}/overlap_summary").first()["meta_pairs"] == 2 and spark.read.json(f"{out}/postfilter_summary").first()["kept"] == 2
    report = {r["file_id"].rsplit("/", 1)[-1]: r for r in spark.read.json(f"{out}/report").collect()}
    assert report["talk.wav"]["n_pairs"] == 2 and report["talk.wav"]["target_words"] == 18 and report["talk.wav"]["duration"] == 11.0 and report["broken.mp3"]["n_pairs"] == 0
    attached = spark.read.json(f"{out}/debug/attached")
    assert {r["speaker"] for r in attached.select("speaker").distinct().collect()} == {"S0.2", "S0.6"}


def test_batch_cache_and_cleaning(spark, folders, tmp_path):
    audio, samples, out = folders
    cfg, cache = PairConfig(identify_threshold=0.98, min_quality=0.4, flag_ratio=0.1), str(tmp_path / "cache")
    first = batch.run_batch(spark, audio, samples, out, stub_models(), cfg, cache=cache)
    assert not (tmp_path / "out/merged").exists() and not (tmp_path / "out/clean").exists() and not (tmp_path / "out/debug").exists()
    assert {tuple(r["reasons"]) for r in spark.read.json(f"{out}/flagged").collect()} == {("input_output_ratio",)}
    assert first.count() == 3
    again = batch.run_batch(spark, audio, samples, out, providers.Models(voice=stub_models().voice), cfg, cache=cache)  # no other model is asked
    assert spark.read.json(f"{out}/results").count() == 2 and again.count() == 3


def test_no_audio_is_an_empty_log(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/readme.txt").write_text("")
    assert batch.run_batch(spark, str(tmp_path / "x"), "", "", stub_models()).count() == 0


def test_stages_by_configuration_and_input(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a").write_text("1")
    mark = input_fingerprint(spark, str(tmp_path / "in"))
    (tmp_path / "in/b").write_text("2")
    assert input_fingerprint(spark, str(tmp_path / "in")) != mark
    one = Stages(spark, str(tmp_path / "kept"), mark)
    assert one.write(spark.range(3), "n").count() == 3
    assert Stages(spark, str(tmp_path / "kept"), mark).write(spark.range(9), "n").count() == 3
    assert Stages(spark, str(tmp_path / "kept"), "other").write(spark.range(9), "n").count() == 9
    with pytest.raises(ValueError):
        Stages(spark, str(tmp_path / "kept"))


def test_decoding_averages_channels_and_resamples(spark, tmp_path):
    import io
    import wave

    def stereo(width, rate):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(2), w.setsampwidth(width), w.setframerate(rate)
            one = {1: [192, 128], 2: [16384, 0], 3: [1 << 22, 0], 4: [1 << 30, 0]}[width]
            w.writeframes(b"".join(v.to_bytes(width, "little") for v in one) * 800)
        return out.getvalue()

    rows = [(f"f{w}", "f", stereo(w, 8000)) for w in (1, 2, 3, 4)] + [("bad", "bad", b"?")]
    got = {r["file_id"]: r for r in readers.decoded(spark.createDataFrame(rows, "file_id string, base_name string, content binary")).collect()}
    assert got["bad"]["content"] is None and got["bad"]["duration"] == 0
    for w in (1, 2, 3, 4):
        samples, rate = readers.samples_of(bytes(got[f"f{w}"]["content"]))
        assert rate == 16_000 and len(samples) == 1600 and np.allclose(samples, 0.25, atol=1e-3) and got[f"f{w}"]["duration"] == 0.1
    frames = readers.wav_frames(spark.createDataFrame(rows[1:2], "file_id string, base_name string, content binary"), 0.05).collect()
    assert [(r["idx"], r["energy"]) for r in frames] == [(0, 0.25), (1, 0.25)]


def test_diarization_is_in_order_of_start_in_any_shape(spark, tmp_path):
    entry = lambda a, b, **who: {"segment": {"start": a, "end": b}, **who}
    (tmp_path / "a.json").write_text(json.dumps({"content": [entry(5, 6, label="x"), entry(1, 2, speaker="y"), entry(1, 3, label="z"), {"label": "none"}]}))
    (tmp_path / "b.json").write_text(json.dumps([entry(2, 3, label="q"), entry(0, 1, speaker="p")]))
    (tmp_path / "c.json").write_text("{broken")
    got = [(r["file_id"][-6], r["ord"], r["start"], r["speaker"]) for r in readers.diarization(spark, str(tmp_path)).orderBy("file_id", "ord").collect()]
    assert got == [("a", 0, 1.0, "y"), ("a", 1, 1.0, "z"), ("a", 2, 5.0, "x"), ("b", 0, 0.0, "p"), ("b", 1, 2.0, "q")]


def test_transcription_stitches_chunks(spark):
    files = spark.createDataFrame([("f", readers.wav_of(tones((4.0, 0.2)), RATE)), ("g", readers.wav_of(tones((1.0, 0.6)), RATE))], "file_id string, content binary")
    spans = spark.createDataFrame([("f", 2.0, 3.0), ("f", 0.0, 1.5), ("f", 3.5, 4.0)], "file_id string, start double, end double")
    parts = providers.chunks(files, spans)
    assert [(r["file_id"], r["chunk"], r["offset"]) for r in parts.orderBy("file_id", "chunk").collect()] == [("f", 0, 0.0), ("f", 1, 2.0), ("f", 2, 3.5), ("g", 0, 0.0)]

    def model(content):
        n = len(content)
        if n < 20_000:
            raise RuntimeError("too short")
        return {"language": None if n < 40_000 else "fr", "segments": [{"start": None, "end": 0.5, "text": str(n)}, {"start": 0.2, "end": 0.4, "text": "b"}]}

    got = [(r["file_id"], r["seg_idx"], r["start"], r["end"], r["language"]) for r in providers.transcribe(parts, model).orderBy("file_id", "seg_idx").collect()]
    assert got == [("f", 0, 0.0, 0.5, "fr"), ("f", 1, 0.2, 0.4, "fr"), ("f", 2, 2.0, 2.5, "fr"), ("f", 3, 2.2, 2.4, "fr"), ("g", 0, 0.0, 0.5, "en"), ("g", 1, 0.2, 0.4, "en")]
    with pytest.raises(Exception, match="no speech model"):
        providers.transcribe(parts).collect()


def test_spans_heard_again(spark):
    assert relabel.reid_span(1.0, 1.2) == pytest.approx((0.95, 1.25)) and relabel.reid_span(0.0, None) == pytest.approx((0.0, 0.05))
    assert relabel.reid_span(5.0, 1.0) == pytest.approx((4.95, 4.96))
    rows = [(1, 0, 0, i, "ab", i * 0.2, i * 0.2 + 0.1, 0.9, "u" if i % 4 == 3 else "t") for i in range(40)]
    words = spark.createDataFrame(rows, "file_id long, seg_idx long, pos long, gpos long, text string, start double, end double, score double, speaker string")

    def heard(file_id, start, end):
        if start > 4:
            raise RuntimeError("no audio")
        return 0.7 if start < 2 else 0.5

    got = {r["gpos"] for r in relabel.relabel(words, "t", PairConfig(), heard).filter("relabelled").collect()}
    assert got == {3, 7}


def test_pieces_do_not_change_the_cascade(spark):
    rng = np.random.default_rng(2)
    starts = np.cumsum(rng.choice([0.2, 0.5, 1.0, 1.1, 3.0], 300))
    rows = [(i // 150, 0, 0, i, "ab" if rng.random() < 0.5 else "longer", float(starts[i]), float(starts[i]) + 0.1, 0.9, "tu"[int(rng.random() < 0.4)]) for i in range(300)]
    words = spark.createDataFrame(rows, "file_id long, seg_idx long, pos long, gpos long, text string, start double, end double, score double, speaker string")
    got = {r["gpos"]: r["speaker"] for r in relabel.relabel(words, "t", PairConfig()).collect()}
    who = [r[8] for r in rows]
    for i, r in enumerate(rows):
        if who[i] != "t" and len(r[4]) <= 3:
            near = [j for j, q in enumerate(rows) if q[0] == r[0] and abs(q[5] - r[5]) <= 1.0]
            if sum(who[j] == "t" for j in near) * 2 > len(near):
                who[i] = "t"
    assert got == dict(enumerate(who)) and relabel.with_pieces(words, 1.0).select("file_id", "piece").distinct().count() > 10


def test_small_operators(spark):
    segs = spark.createDataFrame([("f", 0, 3.0), ("f", 1, None), ("f", 2, 0.0), ("f", 3, 3.0)], "file_id string, was long, start double")
    assert [r["was"] for r in wo.sorted_segments(segs, "was").orderBy("seg_idx").collect()] == [1, 2, 0, 3]
    diar = spark.createDataFrame([("f", 0.0, 1.0), ("f", 0.0, 0.9), ("f", None, 1.0)], "file_id string, start double, end double")
    assert voice.long_enough(diar, 1.0).count() == 1
    marked = spark.createDataFrame([("a", True), ("b", False)], "text string, overlapped boolean")
    assert [r[0] for r in marked.select(wo.clean_token()).collect()] == ["<overlap>a</overlap>", "b"]
    pairs = spark.createDataFrame([("x", "y", "z")], "input string, output string, output_speaker string")
    assert pairs.select(F.lit(1)).count() == 1


def test_stream_merges_events_close_in_time(spark, tmp_path):
    from parley.streaming.merge import merge_stream

    rows = [("2024-01-01 00:00:00", 1, 1.0), ("2024-01-01 05:00:00", 1, 2.0), ("2024-01-01 12:00:00", 1, 4.0), ("2024-01-01 01:00:00", 2, 8.0), ("2024-01-09 00:00:00", 3, 0.0)]
    spark.createDataFrame(rows, "ts string, user_id long, value double").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "value").coalesce(1).write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema("ts timestamp, user_id long, value double").parquet(str(tmp_path / "in"))
    query = merge_stream(events).writeStream.format("memory").queryName("merged_events").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r["user_id"], r["n"], r["total"]) for r in spark.table("merged_events").collect())
    assert got == [(1, 1, 4.0), (1, 2, 3.0), (2, 1, 8.0)]
