"""Interleaved rows, segments, model adapters, translation."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from sievework.operators import interleaved as I
from sievework.operators import models as M
from sievework.operators import segments as S
from sievework.operators import translation as T
from sievework.sources.readers import align_interleaved


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", w, h) + b"\0" * 8


def test_interleaved(spark):
    rows = [("s", -1, "metadata", "{}", None), ("s", 0, "text", "a b", None), ("s", 1, "image", None, png(10, 8)), ("s", 2, "image", None, png(10, 1)), ("s", 3, "text", "c", None), ("t", -1, "metadata", "{}", None), ("t", 0, "image", None, b"junk"), ("u", 5, "metadata", "{}", None)]
    df = align_interleaved(spark.createDataFrame(rows, "sample_id string, position int, modality string, text_content string, binary_content binary"))
    got = I.aspect_ratio(df).select("sample_id", "position", "modality").collect()
    assert sorted(tuple(r) for r in got) == [("s", -1, "metadata"), ("s", 0, "text"), ("s", 1, "image"), ("s", 2, "text")]
    assert {r.sample_id for r in I.image_to_text_ratio(df, 0.5, 0.9).collect()} == {"s"}
    assert I.keep_rows(df.limit(0), F.lit(True)).count() == 0
    fetched = I.materialise(df.withColumn("source_ref", F.when(F.col("sample_id") == "t", '{"path": "p", "byte_offset": 1, "byte_size": 2}')).withColumn("binary_content", F.lit(None).cast("binary")), lambda p, m, o, n: b"x" * n)
    assert [bytes(r.binary_content) for r in fetched.where("sample_id = 't' AND modality = 'image'").collect()] == [b"xx"]
    assert I.laplacian_variance([[1, 1], [1, 1]]) == 0


def seg(a, b, **more):
    return {"start": float(a), "end": float(b), **more}


def test_segments():
    cuts = S.snippets([seg(0, 5, text="a"), seg(6, 10, text="b"), seg(50, 60, text="c"), seg(61, 61.2, text=""), seg(700, 1400, text="d")], 100, 0.5, 30)
    assert [(c["start"], c["end"], len(c["segments"])) for c in cuts] == [(0, 10, 2), (50, 61.2, 2)]
    assert S.word_error_rate("a b c d", "a x c") == 50.0 and S.edits([], [1, 2]) == 2
    assert S.repeated_ngram("a b a b a b".split(), 2, 2) and not S.repeated_ngram("a b a b".split(), 2, 2)
    assert S.events([0, 0.9, 0.9, 0.4, 0.9, 0], 10, 0.5, 0.1, low=0.3) == [{"start": 0.1, "end": 0.5, "confidence": pytest.approx(0.775)}]
    m = S.module_segments([seg(i, i + 0.9, word="w." if i == 5 else "w") for i in range(12)], 5, 20, 2)
    assert [(x["start"], x["end"]) for x in m] == [(0, 5.9), (6, 11.9)]


def plain_windows(segments, target, tolerance, bandwidth, speakers):
    """Windows by their definition, one segment after the other."""
    low, high, out = target * (1 - tolerance), target * (1 + tolerance), []
    for k, head in enumerate(segments):
        chosen = []
        for s in segments[k:]:
            limit = head["start"] + high
            heard = {c["speaker"] for c in [*chosen, s] if c["speaker"]}
            if s["metrics"]["bandwidth"] < bandwidth or s["start"] >= limit or len(heard) > speakers[1] or "no-speaker" in heard:
                break
            if s["end"] > limit:
                words = [w for w in s["words"] if w["end"] <= limit]
                chosen.append(s | {"end": words[-1]["end"] if words else s["start"], "text": " ".join(w["word"] for w in words)})
                break
            chosen.append(s)
        heard = {c["speaker"] for c in chosen if c["speaker"]}
        if len(chosen) > 1 and low <= chosen[-1]["end"] - head["start"] <= high and speakers[0] <= len(heard) <= speakers[1]:
            out.append([(c["start"], c["end"], c["text"]) for c in chosen])
    return out


def test_windows(spark):
    rng, kind = random.Random(5), "array<struct<start:double,end:double,text:string,speaker:string,metrics:struct<bandwidth:int>,words:array<struct<start:double,end:double,word:string>>>>"
    rows = []
    for name in range(12):
        at, segments = 0.0, []
        for _ in range(40):
            end = at + rng.uniform(1, 30)
            words = [seg(at + (end - at) * i / 5, at + (end - at) * (i + 1) / 5, word=f"w{i}") for i in range(5)]
            speaker = rng.choice(["a", "b", "c", None, "", "no-speaker" if name % 4 == 0 else "d"])
            segments.append(seg(at, end, text="t", speaker=speaker, metrics={"bandwidth": rng.choice([9000] * 12 + [100])}, words=words))
            at = end + rng.uniform(-0.5, 2)
        rows.append((name, 16000, segments))
    df = spark.createDataFrame([*rows, (100, 8000, rows[0][2]), (101, 16000, None), (102, 16000, [])], f"id int, audio_sample_rate int, segments {kind}")
    built = {r.id: r.windows for r in S.build_windows(df, speakers=(2, 3)).collect()}
    for name, _, segments in rows:
        assert [[(s.start, s.end, s.text) for s in w.segments] for w in built[name]] == plain_windows(segments, 120.0, 0.1, 8000, (2, 3))
    assert any(built[n] for n in range(12)) and built[100] == [] and built[101] is None and built[102] == []
    head = [seg(40 * i, 40 * i + 38, speaker="ab"[i % 2], metrics={"bandwidth": 9000}, text="x", words=[]) for i in range(4)]
    [w, _] = S.build_windows(spark.createDataFrame([(1, 16000, head)], df.schema)).first().windows
    assert len(w.segments) == 4 and w.speaker_durations[:2] == [76.0, 38.0]


def test_windows_that_overlap(spark):
    kind = "id int, windows array<struct<segments:array<struct<start:double,end:double>>>>"
    cases = {
        0: ([(0, 100), (50, 170), (300, 400)], [(50, 170), (300, 400)]),
        1: ([(0, 110), (100, 225), (220, 340)], [(220, 340)]),  # each is dropped by a better one after it
        2: ([(0, 120), (110, 225), (220, 345)], [(0, 120), (220, 345)]),  # what is gone drops none
        3: ([(0, 120), (0, 120)], [(0, 120)]),
        4: ([], []),
    }
    df = spark.createDataFrame([(k, [{"segments": [seg(a, b)]} for a, b in spans]) for k, (spans, _) in cases.items()] + [(9, None)], kind)
    got = {r.id: r.windows and [(w.segments[0].start, w.segments[0].end) for w in r.windows] for r in S.filter_windows(df).collect()}
    assert got == {k: want for k, (_, want) in cases.items()} | {9: None}
    half = S.filter_windows(df.where("id = 0"), share=0.6).first().windows
    assert len(half) == 3


def test_alignment(spark):
    words = [seg(0, 1, word="a"), seg(1, 3.5, word="b"), seg(5, 6, word="gap"), seg(8, 9, word="c"), seg(8.5, 8.5, word="z")]
    kind = "id int, alignment array<struct<start:double,end:double,word:string>>, segments array<struct<start:double,end:double,speaker:string>>"
    df = spark.createDataFrame([(1, words, [seg(7, 10, speaker="q"), seg(0, 2, speaker="p"), seg(2, 4, speaker="q")]), (2, None, [seg(0, 1, speaker="p")]), (3, words, None), (4, [], [])], kind)
    rows = {r.id: r.segments for r in S.merge_alignment(df).collect()}
    assert [(s.start, s.speaker, s.text, len(s.words)) for s in rows[1]] == [(0, "p", "a", 1), (2, "q", "b", 1), (7, "q", "c z", 2)]
    assert [(s.text, s.words) for s in rows[2]] == [("", [])] and rows[3] is None and rows[4] == []


def test_segment_frames(spark):
    df = spark.createDataFrame([(1, [seg(0, 10, text="a"), seg(1, 2, text="b"), seg(20, 30, text="c")]), (2, None), (3, [])], "id int, segments array<struct<start:double,end:double,text:string>>")
    assert {r.id: r.segments and len(r.segments) for r in S.drop_overlaps(df).collect()} == {1: 1, 2: None, 3: []}
    many = spark.createDataFrame([(1, [seg(0, 10), seg(9.8, 12), seg(2, 3), seg(20, 21), seg(20, 21), seg(30, 31)])], "id int, segments array<struct<start:double,end:double>>")
    assert [(s.start, s.end) for s in S.drop_overlaps(many).first().segments] == [(9.8, 12), (30, 31)]
    assert [tuple(r) for r in S.overlap_pairs(df, "id").collect()] == [(1, 0, 1)]
    assert [(r.id, r.snippet.start) for r in S.plan_snippets(S.drop_overlaps(df)).collect()] == [(1, 20.0)]
    talk = spark.createDataFrame([("a a a a a", 5.0, "en"), ("x" * 30, 5.0, "de"), ("Thank-you.", 5.0, "en"), ("", 1.0, "en"), ("fine words here", 0.1, "en"), (None, 1.0, None)], "pred_text string, duration double, language string")
    assert [r.hallucination for r in S.hallucination_reasons(talk, ["Thank you!"]).collect()] == [["repeated_ngrams"], [], ["phrase_match"], [], ["high_char_rate"], []]
    pairs = spark.createDataFrame([("a b", "a c"), (None, "x"), ("", "")], "r string, h string")
    assert [r[0] for r in pairs.select(S.error_rates("r", "h")).collect()] == [50.0, None, 0.0]
    assert [r.h for r in S.guard_disfluency(pairs, "r", "h", most=40).collect()] == ["a b", "x", ""]
    long = spark.createDataFrame([(100.0, [seg(0, 40, word="a"), seg(50, 90, word="b")])], "d double, w array<struct<start:double,end:double,word:string>>")
    assert [tuple(x) for x in long.select(S.split_long(F.col("d"), F.col("w"), 60, 1).alias("x")).first().x] == [(0.0, 45.0), (45.0, 100.0)]


def _lengths():
    import numpy as np

    return lambda texts: np.array([[len(t), 3.0] for t in texts])


def test_models(spark):
    df = spark.createDataFrame([(1, "abcdef"), (2, "a"), (3, None)], "id int, text string")
    c = M.Classifier(_lengths, ("long", "short"), score_field="p")
    assert {r.id: r.preds for r in c(df).collect()} == {1: "long", 2: "short", 3: "short"}
    assert M.Classifier(_lengths, ("long", "short"), filter_by=("long",))(df).count() == 1
    safe = spark.createDataFrame([("safe",), ("unsafe\nO3",), ("unsafe o13, o1",), ("hm",), (None,)], "r string").select(M.safety_label(F.col("r")))
    assert [r[0] for r in safe.collect()] == ["safe", "O3", "O13", "unknown", "unknown"]
    kinds = spark.createDataFrame([("intro\n- a\n  b\n- c",), ("- x",)], "t string").select(M.knowledge_list(F.col("t")))
    assert [r[0] for r in kinds.collect()] == ["a\nb\nc", "x"]
    qa = spark.createDataFrame([(1, "T", "Question: a?\nAnswer: b\nQuestion: c?\nAnswer: d"), (2, "U", "nothing")], "id int, text string, qa string")
    got = M.question_answers(qa, "qa", "id").collect()
    assert len(got) == 1 and got[0].qa.startswith("T\n\nQuestion:")
    assert M.embed(df, M.hashed_vector(8)).where(F.size("embeddings") == 8).count() == 3


def test_translation(spark):
    upper = lambda: lambda lines: [x.upper() for x in lines]
    df = spark.createDataFrame([(1, 'hello\n<tag>\n{"a": 1}\n{not json}\n\n123'), (2, None)], "id int, text string")
    got = {r.id: r.translated_text for r in T.translate(df, upper, "id").collect()}
    assert got == {1: 'HELLO\n<tag>\n{"a": 1}\n{NOT JSON}\n\n123', 2: ""}
    talk = spark.createDataFrame([(1, [("u", "hi"), ("a", "yo")])], "id int, messages array<struct<role:string,content:string>>")
    assert [m.content for m in T.translate_field(talk, upper, "id").first().messages] == ["HI", "YO"]
    done = df.withColumn("translated_text", F.when(F.col("id") == 1, "kept"))
    assert {r.id: r.translated_text for r in T.translate(done, upper, "id", skip_existing=True).collect()} == {1: "kept", 2: ""}
    assert T.chrf("abc", "abc") == 100 and T.bleu("a b c d", "a b c d") == pytest.approx(100) and T.ter("a", "a") == 0
    pairs = spark.createDataFrame([("a b c d", "a b c d"), ("x", "a b")], "text string, backtranslated_text string")
    assert [r.is_quality_metric_passed for r in T.quality_metrics(pairs, {"bleu": 50, "ter": 10}).collect()] == [True, False]
    judged = spark.createDataFrame([(3.0,), (1.0,), (None,)], "faith_avg double")
    assert T.faith_threshold(judged).count() == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_of_long_segments(spark):
    """Long, nested and equal segments, words across several: by definition, without a join of exploded times."""
    rng, rows = random.Random(7), []
    for name in range(20):
        words = [seg(a, a + rng.choice([0, 1, 40, 700]), word=f"w{k}") for k, a in enumerate(rng.uniform(0, 5000) for _ in range(60))]
        spans = [seg(a, a + rng.choice([0, 30, 600, 3600]), speaker="s") for a in (rng.randrange(0, 5000, 50) for _ in range(25))]
        rows.append((name, words, [*spans, spans[0], seg(0, 1e7, speaker="all")]))
    df = spark.createDataFrame(rows, "id int, alignment array<struct<start:double,end:double,word:string>>, segments array<struct<start:double,end:double,speaker:string>>")
    merged = S.merge_alignment(df)
    assert "Join" not in plan_of(merged) and "Exchange" not in plan_of(merged)
    got = {r.id: r.segments for r in merged.collect()}
    for name, words, spans in rows:
        mine = [[] for _ in spans]
        for w in words:
            met = []
            for j, s in enumerate(spans):
                shared = min(w["end"], s["end"]) - max(w["start"], s["start"])
                if shared > 0 or (w["start"] >= s["start"] and w["end"] <= s["end"]):
                    met.append((-shared, s["start"], j))
            mine[min(met)[2]].append(w)
        want = [" ".join(w["word"] for w in sorted(mine[j], key=lambda w: w["start"])) for j in sorted(range(len(spans)), key=lambda j: (spans[j]["start"], j))]
        assert [s.text for s in got[name]] == want and sum(len(s.words) for s in got[name]) == len(words)


def test_overlaps_by_definition(spark):
    rng, rows = random.Random(3), []
    for name in range(30):
        rows.append((name, [seg(a, a + rng.choice([0, 0.3, 5, 90, 900])) for a in (round(rng.uniform(0, 3000), 1) for _ in range(20))]))
    df = spark.createDataFrame(rows, "id int, segments array<struct<start:double,end:double>>")
    dropped = S.drop_overlaps(df)
    assert "Join" not in plan_of(dropped)
    got, pairs = {r.id: r.segments for r in dropped.collect()}, {tuple(r) for r in S.overlap_pairs(df).collect()}
    for name, spans in rows:
        bad = {k for i, a, b in pairs if i == name for k in (a, b)}
        assert bad and [(s.start, s.end) for s in got[name]] == [(s["start"], s["end"]) for k, s in enumerate(spans) if k not in bad]


def test_a_fold_holds_slices(spark):
    """A worker has the plain values of a slice of a batch, not of all its rows."""
    blocks = S.fold(lambda _: __import__("sys").getallocatedblocks(), "long")
    rows = spark.range(4000).coalesce(1).select(F.transform(F.sequence(F.lit(0), F.lit(299)), lambda k: k + F.rand(1)).alias("x"))
    one, most = rows.limit(1).select(blocks("x")).first()[0], rows.select(blocks("x").alias("n")).agg(F.max("n"), F.count("n")).first()
    assert most[1] == 4000 and most[0] - one < 400_000


def test_windows_are_made_without_a_join(spark):
    segments = [seg(5 * i, 5 * i + 4.5, speaker="ab"[i % 2], text=f"t{i}", metrics={"bandwidth": 100 if i == 12 else 9000}) for i in range(20)]
    df = spark.createDataFrame([(1, 16000, segments), (2, 8000, segments), (3, None, segments), (4, 16000, None)], "id int, audio_sample_rate int, segments array<struct<start:double,end:double,speaker:string,text:string,metrics:struct<bandwidth:int>>>")
    built = S.build_windows(df, target=32.0, tolerance=0.1, truncate=False)
    assert "Join" not in plan_of(built) and "Exchange" not in plan_of(built)
    got = {r.id: r.windows for r in built.collect()}
    assert [(w.segments[0].text, len(w.segments)) for w in got[1]] == [*[(f"t{k}", 7) for k in range(6)], ("t6", 6), ("t13", 7), ("t14", 6)]
    assert got[1][0].speaker_durations == [18.0, 13.5, 0.0, 0.0, 0.0] and got[2] == [] == got[3] and got[4] is None
