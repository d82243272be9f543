"""Audio, image and video stages over made recordings and stand-in models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.functions import audio
from sievework.operators import media as M
from sievework.operators import segments as S


def test_numbers_written():
    cases = {
        "two hundred and five": "205",
        "Twenty-one men, one two three": "21 men, 1 2 3",
        "one million two thousand nineteen": "1002019",
        "a hundred": "a 100",
        "two thousand million": "2000000000",
        "forty forty": "40 40",
        "zero": "0",
        "someone won": "someone won",
        "": "",
    }
    assert {t: M.numbers_written(t) for t in cases} == cases


def test_converted_and_cut(spark):
    rate = 8000
    tone = 0.5 * np.sin(2 * np.pi * 440 * np.arange(rate * 2) / rate)
    both = M.wav_bytes(np.stack([tone, -tone], 1), rate)
    df = spark.createDataFrame([(1, both, [{"start": 0.5, "end": 1.0}, {"start": 1.5, "end": 9.0}]), (2, b"no wav", None), (3, None, None)], "id int, content binary, segments array<struct<start:double,end:double>>")
    got = {r.id: r.c for r in df.select("id", M.converted(F.col("content"), 4000, mono=False).alias("c")).collect()}
    x, new = audio.read_wav(bytes(got[1]))
    assert new == 4000 and x.shape == (8000, 2) and got[2] is None and got[3] is None
    parts = M.extract_segments(df.where("id = 1")).collect()
    assert [r.segment_id for r in parts] == [0, 1] and parts[0].segment.end == 1.0
    x, _ = audio.read_wav(bytes(parts[0].audio))
    assert np.allclose(x[:, 0], tone[4000:8000], atol=1e-4) and len(audio.read_wav(bytes(parts[1].audio))[0]) == 4000


def test_speech_spans(spark):
    rate = 1000
    loud, still = np.ones(rate) * 0.5, np.zeros(rate)
    x = np.concatenate([still, loud, loud, loud, still[:300], loud, still, still, loud[:200], still])
    df = spark.createDataFrame([(M.wav_bytes(x, rate),), (M.wav_bytes(x[:0], rate),)], "c binary")
    rows = [[(round(s.start, 2), round(s.end, 2)) for s in r.s] for r in df.select(M.speech_spans(F.col("c"), frame=0.1, pad=0.2).alias("s")).collect()]
    assert rows == [[(0.8, 5.5)], []]
    halves = df.limit(1).select(M.speech_spans(F.col("c"), frame=0.1, pad=0.0, longest=3.0).alias("s")).first().s
    assert [(round(s.start, 2), round(s.end, 2)) for s in halves] == [(1.0, 3.15), (3.15, 5.3)]


def test_speakers_and_events(spark):
    talk = [("a", 0, 2), ("b", 1.5, 3), ("a", 3.2, 5), ("a", 5.5, 7), ("a", 9, 9.5)]
    df = spark.createDataFrame([(1, [{"speaker": s, "start": float(a), "end": float(b)} for s, a, b in talk])], "id int, segments array<struct<start:double,end:double,speaker:string>>")
    got = {r.speaker: [(s.start, s.end) for s in r.spans] for r in M.separate_speakers(df).collect()}
    assert got == {"a": [(3.2, 7.0)], "b": []}
    frames = spark.createDataFrame([([[0.5, 0.5, 0.9], [0.0, 1.0, 0.2]],)], "f array<array<double>>")
    for mode, want in {"noisy_or": [0.75, 1.0], "max": [0.5, 1.0], "mean": [0.5, 0.5]}.items():
        assert frames.select(M.joint_probabilities(F.col("f"), [0, 1], mode).alias("p")).first().p == pytest.approx(want)
    heard = S.detect_events(frames.select(M.joint_probabilities(F.col("f"), [0, 1]).alias("p")), "p", 10.0, threshold=0.7, shortest=0.1).first().events
    assert [(e.start, e.end) for e in heard] == [(0.0, 0.2)]


def test_scenes_and_windows(spark):
    df = spark.createDataFrame([([0.0] * 30 + [0.9] + [0.0] * 4,), ([0.0] * 8,), ([],)], "s array<double>")
    spans = lambda **o: [[(x.start, x.end) for x in r.c] for r in df.select(M.scene_clips(F.col("s"), 1.0, **o).alias("c")).collect()]
    assert spans() == [[(0.5, 10.5), (10.5, 20.5), (20.5, 29.5), (31.5, 34.5)], [(0.5, 7.5)], []]
    assert spans(mode="truncate", crop=0.0) == [[(0.0, 10.0), (31.0, 35.0)], [(0.0, 8.0)], []]
    assert spans(whole_without_cuts=False)[1] == []
    with pytest.raises(ValueError):
        M.frame_times(F.lit(0), F.lit(1), "never")
    none = spark.range(1).select(M.caption_windows(F.lit(0), F.lit(0)).alias("w"), M.frame_times(F.lit(1), F.lit(1)).alias("t")).first()
    assert none.w == [] and none.t is None
