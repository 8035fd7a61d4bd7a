"""Hand-made rows for ties, thresholds, nulls and order."""

import json
import random
import wave

import pytest
from pyspark.sql import functions as F

from parley.config import PairConfig
from parley.operators import gates, intervals, merge, qna, relabel, scoring, turns, voice
from parley.operators import words as wo
from parley.sources import readers

CFG = PairConfig()
WORD = "file_id long, seg_idx long, pos long, gpos long, text string, start double, end double, score double, speaker string"


def words(spark, rows):
    return spark.createDataFrame([(1, seg, 0, i, text, s, e, score, who) for i, (seg, text, s, e, score, who) in enumerate(rows)], WORD)


def test_first_of_equal_overlaps_wins_and_no_overlap_is_unknown(spark):
    w = words(spark, [(0, "a", 1.0, 2.0, 0.9, "x"), (0, "b", 9.0, 9.5, 0.9, "x"), (0, "c", None, None, 0.9, "x")])
    d = spark.createDataFrame([(1, 0.5, 1.5, "first", 0), (1, 1.5, 2.5, "second", 1)], "file_id long, start double, end double, speaker string, ord long")
    got = {r["text"]: r["speaker"] for r in intervals.attach_speakers(w, d).collect()}
    assert got == {"a": "first", "b": "unknown", "c": "unknown"}


def test_intervals_across_bins_count_once(spark):
    w = words(spark, [(0, "a", 5.0, 35.0, 0.9, "t")])
    d = spark.createDataFrame([(1, 0.0, 40.0, "o", 0), (1, 10.0, 20.0, "o", 1)], "file_id long, start double, end double, speaker string, ord long")
    assert intervals.overlap_fraction(w, d, "t").first()["overlap_frac"] == pytest.approx(40 / 30)


def test_touching_is_no_speech_overlap(spark):
    w = words(spark, [(0, "a", 1.0, 2.0, 0.9, "t"), (0, "b", 1.9, 2.2, 0.9, "t"), (0, "c", None, 2.2, 0.9, "t")])
    v = spark.createDataFrame([(1, 2.0, 3.0)], "file_id long, start double, end double")
    assert [r["text"] for r in intervals.in_speech(w, v).collect()] == ["b"]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "file_id long, output_len long, avg_score double, quality_score double, input_len long, overlap_rate double, seg_idx long")


def test_thresholds_keep_equality(spark):
    p = pairs(spark, [(1, 7, 0.5, 0.6, 0, 0.0, 0), (1, 1, 0.85, 0.6, 0, 0.0, 1), (1, 6, 0.84, 0.9, 0, 0.0, 2), (1, 7, 0.49, 0.9, 0, 0.0, 3), (1, 7, None, 0.59, 0, 0.0, 4), (1, 7, None, None, 0, 0.0, 5)])
    c = gates.postfilter_counts(p, CFG).first().asDict()
    assert c == {"initial": 6, "kept": 2, "dropped_by_length": 1, "dropped_by_confidence": 1, "dropped_by_quality": 2}


def test_flags(spark):
    p = pairs(spark, [(1, 1, 0.3, 1.0, 10, 0.8, 0), (1, 1, None, 1.0, 11, 0.0, 1), (1, 0, 0.9, 1.0, 99, 0.0, 2)])
    got = {r["seg_idx"]: r["reasons"] for r in gates.flag(p, CFG).collect()}
    assert got == {0: ["high_overlap"], 1: ["low_confidence", "input_output_ratio"]}


def test_replies_close_in_time_merge_at_the_gap_itself(spark):
    rows = []
    for k, (s, e) in enumerate([(0.0, 1.0), (2.5, 3.0), (4.6, 5.0)]):
        rows += [(2 * k, "u", s, s, 0.9, "user")] + [(2 * k + 1, f"w{i}", s, e, 0.8, "t") for i in range(7)]
    p = turns.build_pairs(words(spark, rows), "t", CFG)
    m = sorted(merge.merge_replies(p, 1.5).collect(), key=lambda r: r["seg_idx"])
    assert [(r["seg_idx"], r["n_merged"], r["output_len"]) for r in m] == [(1, 2, 14), (5, 1, 7)]
    assert m[0]["input"] == 'user: "u"' and m[0]["tend"] == 3.0


def test_average_folds_to_the_later_replies(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.8],), ([0.2, None, 0.8],), ([None, 0.4],)], "a array<double>")
    assert [r[0] for r in df.select(merge.fold_average(F.col("a"))).collect()] == [pytest.approx(0.55), pytest.approx(0.5), None]


def test_context_is_cut_to_ten_turns_and_fifty_words(spark):
    rows = [(i, f"w{i}", float(i), i + 0.5, 0.9, f"s{i % 2}") for i in range(12)]
    rows += [(12, f"r{i}", 20.0, 21.0, 0.9, "t") for i in range(7)]
    rows += [(13, " ".join(["x"] * 1), 22.0, 23.0, 0.9, "u") for _ in range(60)] + [(14, f"q{i}", 24.0, 25.0, 0.9, "t") for i in range(7)]
    p = sorted(turns.build_pairs(words(spark, rows), "t", CFG).collect(), key=lambda r: r["seg_idx"])
    assert p[0]["num_context_turns"] == 10 and p[0]["input"].startswith('s0: "w2"')
    assert p[1]["input_len"] == 50


def test_questions(spark):
    rows = [(0, t, float(i), i + 0.5, 0.9, "t") for i, t in enumerate("Hello. What is it? It is. Good. why Really. Nothing?".split())]
    got = sorted((r["seg_idx"], r["input"], r["output"]) for r in qna.build_qna(words(spark, rows), "t", CFG).collect())
    assert got == [("qna-0", "What is it?", "It is. Good.")]


def test_route_of_a_single_other_speaker(spark):
    w = words(spark, [(0, "a", 0.0, 1.0, 0.9, "other")])
    assert gates.route(w, "t", CFG).first()["mode"] == "qna"


def cascade(rows, window=1.0):
    """A plain model, word by word."""
    who = [r[5] for r in rows]
    for i, r in enumerate(rows):
        if who[i] != "t" and len(r[1]) <= 3:
            near = [j for j, q in enumerate(rows) if abs((q[2] or 0.0) - (r[2] or 0.0)) <= window]
            if sum(who[j] == "t" for j in near) > len(near) / 2:
                who[i] = "t"
    return who


def test_cascade_equals_the_plain_model(spark):
    rng = random.Random(5)
    for _ in range(4):
        rows = [(0, rng.choice(["a", "bb", "longer"]), None if rng.random() < 0.05 else round(rng.random() * 20, 1), 30.0, 0.9, rng.choice("tu")) for _ in range(80)]
        got = relabel.relabel(words(spark, rows), "t", CFG).orderBy("gpos").collect()
        assert [r["speaker"] for r in got] == cascade(rows)


def test_score_of_an_empty_input(spark):
    df = spark.createDataFrame([(1, 0, "", 0, "a b c d e f g.", 7, "t", 0.5)], "file_id long, seg_idx long, input string, input_len long, output string, output_len long, output_speaker string, avg_score double")
    assert scoring.score(df, words=None).first()["quality_score"] == pytest.approx(0.645, abs=2e-3)


def test_identify_needs_the_threshold(spark):
    s = spark.createDataFrame([(1, "a", [1.0, 0.0]), (1, "b", [0.0, 1.0])], "file_id long, speaker string, embedding array<double>")
    ref = spark.createDataFrame([([1.0, 1.0],)], "reference array<double>")
    assert voice.identify(s, ref, 0.70).first()["speaker"] == "a"
    assert voice.identify(s, ref, 0.71).count() == 0


def test_energy_vad_frames(spark):
    f = spark.createDataFrame([(1, i, e) for i, e in enumerate([0.0, 0.0, 9.0, 9.0, 0.0, 9.0])], "file_id long, idx long, energy double")
    got = sorted((round(r["start"], 3), round(r["end"], 3)) for r in intervals.energy_vad(f).collect())
    assert got == [(0.06, 0.12), (0.15, 0.18)]


def test_normaliser_takes_the_first_text(spark):
    raw = spark.createDataFrame([("", "w", "t", "x", None, "0.5", None), (None, None, None, "1", "2", None, "s")], "text string, word string, token string, start string, end string, confidence string, speaker string")
    assert [tuple(r) for r in wo.normalise(raw).collect()] == [("w", None, None, 0.5, "unknown")]


def test_readers(spark, tmp_path):
    (tmp_path / "t").mkdir(), (tmp_path / "d").mkdir(), (tmp_path / "a").mkdir()
    doc = {"language": "en", "segments": [{"start": 0, "end": 1, "text": "x", "words": [{"word": "hi ", "start": 0.1, "end": "bad", "confidence": 0.5}, {"token": "yo", "speaker": "A"}]}]}
    (tmp_path / "t/x.json").write_text(json.dumps(doc, indent=2))
    got = [(r["text"], r["start"], r["end"], r["score"], r["speaker"]) for r in readers.transcripts(spark, str(tmp_path / "t")).orderBy("pos").collect()]
    assert got == [("hi", 0.1, None, 0.5, "unknown"), ("yo", None, None, None, "A")]
    (tmp_path / "d/y.json").write_text(json.dumps({"segments": [{"segment": {"start": 1, "end": 2}, "speaker": "B"}, {"segment": {"start": 1}}]}))
    assert [(r["start"], r["end"], r["speaker"]) for r in readers.diarization(spark, str(tmp_path / "d")).collect()] == [(1.0, 2.0, "B")]
    (tmp_path / "d/z.json").write_text(json.dumps({"deep": [{"x": {"segment": {"start": "3", "end": 4}, "label": "C"}}]}))
    assert {(r["start"], r["speaker"]) for r in readers.diarization_anywhere(spark, str(tmp_path / "d")).collect()} == {(1.0, "B"), (3.0, "C")}
    with wave.open(str(tmp_path / "a/s.WAV"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(1000), w.writeframes((b"\x00\x40" * 30) + (b"\x00\x00" * 35))
    frames = readers.wav_frames(readers.audio_files(spark, str(tmp_path / "a"))).orderBy("idx").collect()
    assert [(r["idx"], r["energy"]) for r in frames] == [(0, 0.5), (1, 0.0)]
    with pytest.raises(FileNotFoundError):
        readers.voice_samples(spark, str(tmp_path / "t"))
