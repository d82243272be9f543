"""Audio, image and video stages. Decoders and models are adapters: factories of functions of a batch of bytes. What is
done with their results (spans, cuts, joins, limits) is here.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import audio
from sievework.operators.models import infer
from sievework.operators.segments import bind, fold

WORDS = "array<struct<word:string,start:double,end:double>>"
TRANSCRIPT = f"struct<text:string,language:string,alignment:{WORDS}>"


def wav_bytes(x: np.ndarray, rate: int) -> bytes:
    """A 16-bit WAV file of samples from -1 to 1 (frames, or frames x channels)."""
    out, x = io.BytesIO(), x if x.ndim == 2 else x[:, None]
    with wave.open(out, "wb") as w:
        w.setnchannels(x.shape[1])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.round(x * 32768), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def converted(content: Column, rate: int | None = None, mono: bool = True) -> Column:
    """A WAV file's bytes in another sampling rate, in one channel unless ``mono`` is false; null where unreadable."""

    def run(raw: bytes) -> bytes | None:
        try:
            x, own = audio.read_wav(raw)
        except (wave.Error, EOFError, ValueError):
            return None
        x = audio.mono(x)[:, None] if mono else x
        if rate and rate != own:
            x = np.stack([audio.resample(c, own, rate) for c in x.T], 1)
        return wav_bytes(x, rate or own)

    return fold(run, "binary")(content)


def cut(content: Column, spans: Column) -> Column:
    """The WAV files of the spans (``start`` and ``end`` in seconds) of a WAV file, in their order."""

    def run(raw: bytes, spans: list[dict] | None) -> list[bytes]:
        with wave.open(io.BytesIO(raw)) as w:
            rate, width = w.getframerate(), w.getsampwidth() * w.getnchannels()
            frames, about = w.readframes(w.getnframes()), w.getparams()
        out = []
        for s in spans or []:
            a, b = (max(0, round(t * rate)) * width for t in (s["start"], s["end"]))
            part = io.BytesIO()
            with wave.open(part, "wb") as w:
                w.setparams(about)
                w.writeframes(frames[a:b])
            out.append(part.getvalue())
        return out

    return fold(run, "array<binary>")(content, spans)


def extract_segments(df: DataFrame, content: str = "content", segments: str = "segments", out: str = "audio") -> DataFrame:
    """A row for each segment of a recording, with its place, its span and its own WAV file; the recording's bytes go."""
    parts = F.arrays_zip(F.col(segments).alias("segment"), cut(F.col(content), F.col(segments)).alias(out))
    rows = df.withColumn("_parts", parts).select(*[c for c in df.columns if c not in (content, segments)], F.posexplode("_parts").alias("segment_id", "_part"))
    return rows.withColumns({"segment": F.col("_part.segment"), out: F.col(f"_part.{out}")}).drop("_part")


def speech_spans(content: Column, threshold_db: float = -40.0, frame: float = 0.03, widest_pause: float = 0.5, shortest: float = 2.0, longest: float = 60.0, pad: float = 0.3) -> Column:
    """Spans of a WAV file that are louder than ``threshold_db`` below full scale: pauses under ``widest_pause`` are
    bridged, spans padded, those under ``shortest`` dropped and those over ``longest`` divided evenly. A model's speech
    probabilities take the same way through :func:`sievework.operators.segments.detect_events`."""

    def run(raw: bytes) -> list[dict]:
        x, rate = audio.read_wav(raw)
        x, hop = audio.mono(x), max(1, round(frame * rate))
        n = -(-len(x) // hop)
        power = np.add.reduceat(x * x, np.arange(0, len(x), hop)) / np.diff(np.append(np.arange(0, len(x), hop), len(x))) if n else np.zeros(0)
        loud = np.concatenate([[False], power > 10 ** (threshold_db / 10), [False]])
        edges = np.flatnonzero(loud[1:] != loud[:-1]) * hop / rate
        spans: list[list[float]] = []
        for a, b in edges.reshape(-1, 2).tolist():
            if spans and a - spans[-1][1] < widest_pause:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        out = []
        for a, b in spans:
            a, b = max(0.0, a - pad), min(len(x) / rate, b + pad)
            if b - a >= shortest:
                k = max(1, int(np.ceil((b - a) / longest)))
                out += [{"start": a + (b - a) * i / k, "end": a + (b - a) * (i + 1) / k} for i in range(k)]
        return out

    return fold(run, "array<struct<start:double,end:double>>")(content)


def transcribe(df: DataFrame, factory: Callable[[], Callable[[list[bytes]], list[dict]]], content: str = "content", out: str = "transcript", batch: int = 32) -> DataFrame:
    """A recogniser's ``{text, language, alignment}`` of each recording. Recordings of near lengths share a batch."""
    return df.withColumn(out, infer(factory, TRANSCRIPT, batch)(F.col(content)))


def transcribe_in_parts(df: DataFrame, factory: Callable[[], Callable[[list[bytes]], list[dict]]], id_field: str, content: str = "content", longest: float = 3600.0, batch: int = 32) -> DataFrame:
    """Long recordings cut into parts of at most ``longest`` seconds, the parts recognised, and their texts and words
    joined with times in the whole recording: ``(id, text, alignment)``."""
    from sievework.operators.segments import wav_duration

    length = wav_duration(F.col(content))
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_length") / longest) - 1, F.lit(0)).cast("int")), lambda k: F.struct((k * longest).alias("start"), F.least((k + 1) * F.lit(longest), F.col("_length")).alias("end")))
    rows = df.select(F.col(id_field).alias("_id"), F.col(content).alias("content"), length.alias("_length")).where("_length >= 0").withColumn("segments", parts)
    heard = transcribe(extract_segments(rows), factory, "audio", "heard", batch)
    start = F.col("segment.start")
    moved = F.transform("heard.alignment", lambda w: w.withField("start", w["start"] + start).withField("end", w["end"] + start))
    joined = heard.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("segment_id", F.col("heard.text").alias("text"), moved.alias("words")))).alias("parts"))
    text = F.array_join(F.filter(F.transform("parts", lambda p: p["text"]), lambda t: t != ""), " ")
    return joined.select(F.col("_id").alias(id_field), text.alias("text"), F.flatten(F.transform("parts", lambda p: F.coalesce(p["words"], F.array().cast(WORDS)))).alias("alignment"))


def diarise(df: DataFrame, factory: Callable[[], Callable[[list[bytes]], list[list[dict]]]], content: str = "content", out: str = "segments") -> DataFrame:
    """A diariser's segments ``{start, end, speaker}`` of each recording, by start."""
    found = infer(factory, "array<struct<start:double,end:double,speaker:string>>")(F.col(content))
    return df.withColumn(out, F.array_sort(found))


def separate_speakers(df: DataFrame, segments: str = "segments", longest_gap: float = 1.0, shortest: float = 1.0) -> DataFrame:
    """A row for each speaker of a recording with the spans that speaker has alone: neighbours within ``longest_gap`` are
    joined, what another speaks over and what is under ``shortest`` goes."""
    names = F.array_sort(F.array_distinct(F.transform(segments, lambda s: s["speaker"])))
    rows = df.withColumn("speaker", F.explode(names))

    def run(found: list[dict], speaker: str) -> list[dict]:
        others = [s for s in found if s["speaker"] != speaker]
        out: list[dict] = []
        for s in sorted((s for s in found if s["speaker"] == speaker), key=lambda s: s["start"]):
            if any(o["start"] < s["end"] and s["start"] < o["end"] for o in others):
                continue
            if out and s["start"] - out[-1]["end"] <= longest_gap and not any(o["start"] < s["start"] and out[-1]["end"] < o["end"] for o in others):
                out[-1]["end"] = s["end"]
            else:
                out.append({"start": s["start"], "end": s["end"]})
        return [s for s in out if s["end"] - s["start"] >= shortest]

    return rows.withColumn("spans", fold(run, "array<struct<start:double,end:double>>")(segments, "speaker"))


def joint_probabilities(frames: Column, classes: list[int], mode: str = "noisy_or") -> Column:
    """One probability a frame out of those of several classes (arrays of floats): that any of them is heard if they
    were independent (noisy_or), the largest (max) or the mean."""
    picked = lambda f: F.transform(F.array(*map(F.lit, classes)), lambda k: F.element_at(f, k + 1).cast("double"))
    ways = {
        "noisy_or": lambda p: 1 - F.aggregate(p, F.lit(1.0), lambda s, x: s * (1 - x)),
        "max": F.array_max,
        "mean": lambda p: F.aggregate(p, F.lit(0.0), lambda s, x: s + x) / len(classes),
    }
    if mode not in ways:
        raise ValueError(f"mode {mode!r} is none of {sorted(ways)}")
    return F.transform(frames, lambda f: bind(picked(f), ways[mode]))


def scene_clips(scores: Column, fps: Column | float, threshold: float = 0.4, shortest: float = 2.0, longest: float | None = 10.0, mode: str = "stride", crop: float = 0.5, whole_without_cuts: bool = True) -> Column:
    """Clips between the cuts of a video, from a cut score for each frame: a scene ends where a run of scores over
    ``threshold`` begins and the next begins after it. ``crop`` seconds go at each end of a scene; one over ``longest``
    is cut short (truncate) or into neighbours (stride), and what is under ``shortest`` dropped. A video without a cut
    is one scene, or none if ``whole_without_cuts`` is false."""
    if mode not in ("stride", "truncate"):
        raise ValueError(f"mode {mode!r} is neither stride nor truncate")

    def run(scores: list[float], rate: float) -> list[dict]:
        over = np.concatenate([[True], np.asarray(scores, float) > threshold, [True]])
        edges = np.flatnonzero(over[1:] != over[:-1])
        scenes = edges.reshape(-1, 2) / rate
        if not over[1:-1].any() and not whole_without_cuts:
            return []
        out = []
        for a, b in scenes.tolist():
            a, b = a + crop, b - crop
            if longest and b - a > longest:
                ends = [b] if mode == "stride" else [a + longest]
                starts = np.arange(a, ends[0], longest).tolist()
                out += [(s, min(s + longest, ends[0])) for s in starts]
            else:
                out.append((a, b))
        return [{"start": a, "end": b} for a, b in out if b - a >= shortest]

    return fold(run, "array<struct<start:double,end:double>>")(scores, F.lit(fps).cast("double") if isinstance(fps, int | float) else fps)


def frame_times(start: Column, end: Column, policy: str = "sequence", fps: float = 2.0) -> Column:
    """Times of the frames that a clip is looked at: first, middle, last, or a sequence at ``fps``."""
    start, end = start.cast("double"), end.cast("double")
    ways = {
        "first": lambda: F.array(start),
        "middle": lambda: F.array((start + end) / 2),
        "last": lambda: F.array(end),
        "sequence": lambda: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil((end - start) * fps) - 1, F.lit(0)).cast("int")), lambda k: start + k / F.lit(float(fps))),
    }
    if policy not in ways:
        raise ValueError(f"policy {policy!r} is none of {sorted(ways)}")
    return F.when(end > start, ways[policy]())


def extract_frames(df: DataFrame, decode: Callable[[bytes, list[float]], list[bytes]], times: str = "times", content: str = "content", out: str = "frames") -> DataFrame:
    """Encoded frames of a video at its times, by a decoder."""
    return df.withColumn(out, fold(lambda raw, at: decode(raw, at or []), "array<binary>")(content, times))


def embed_media(df: DataFrame, factory: Callable[[], Callable[[list[bytes]], list]], content: str = "content", out: str = "embeddings", batch: int = 64) -> DataFrame:
    """A model's vectors of images, clips or frames, of length 1."""
    got = df.withColumn(out, infer(factory, "array<float>", batch, sort_by_length=False)(F.col(content)))
    norm = F.sqrt(F.aggregate(out, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return got.withColumn(out, bind(norm, lambda n: F.transform(out, lambda x: (x / F.greatest(n, F.lit(1e-12))).cast("float"))))


def score_media(df: DataFrame, factory: Callable[[], Callable[[list[bytes]], list]], out: str, content: str = "content", kind: str = "double", batch: int = 64) -> DataFrame:
    """A model's score of each item (aesthetics, safety, speech quality); limits are :func:`models.score_limits`."""
    return df.withColumn(out, infer(factory, kind, batch, sort_by_length=False)(F.col(content)))


def motion_scores(vectors: Column, height: Column, width: Column, patch: int = 256) -> Column:
    """Mean motion of a clip and that of its stillest patch, as shares of the frame's height, from the motion vectors
    ``{y, x, dy, dx}`` of its decoded frames (an array of each frame's). Frames without vectors don't move."""

    def run(frames: list[list[dict] | None], h: int, w: int) -> dict:
        rows, cols = -(-h // patch), -(-w // patch)
        total, n = np.zeros((rows, cols)), np.zeros((rows, cols))
        for frame in frames:
            for v in frame or []:
                at = min(rows - 1, int(v["y"]) // patch), min(cols - 1, int(v["x"]) // patch)
                total[at] += np.hypot(v["dy"], v["dx"]) / h
                n[at] += 1
        mean = total / np.maximum(n, 1)
        return {"mean": float(total.sum() / max(1, n.sum())), "stillest": float(mean.min())}

    return fold(run, "struct<mean:double,stillest:double>")(vectors, height, width)


def moving(df: DataFrame, scores: str = "motion", least_mean: float = 0.00098, least_patch: float = 0.000001) -> DataFrame:
    """Clips that move enough, as a whole and in every patch."""
    return df.where((F.col(f"{scores}.mean") >= least_mean) & (F.col(f"{scores}.stillest") >= least_patch))


def caption_windows(start: Column, end: Column, fps: float = 2.0, frames: int = 256, remainder: int = 128) -> Column:
    """Spans of ``frames`` sampled frames of a clip; a last one of fewer than ``remainder`` joins the one before it."""
    n = F.floor((end - start) * fps).cast("int")
    many = F.greatest(F.lit(1), F.floor((n + (frames - remainder)) / frames).cast("int"))
    last = lambda k: (k + 1) == many
    spans = F.transform(F.sequence(F.lit(0), many - 1), lambda k: F.struct((start + k * (frames / fps)).cast("double").alias("start"), F.when(last(k), end).otherwise(start + (k + 1) * (frames / fps)).cast("double").alias("end")))
    return F.when(n > 0, spans).otherwise(F.array().cast("array<struct<start:double,end:double>>"))


def caption(df: DataFrame, factory: Callable[[], Callable[[list[bytes]], list[str]]], content: str = "content", out: str = "caption", batch: int = 16) -> DataFrame:
    """A model's caption of each window of frames; :func:`models.prompt_column` rewrites captions."""
    return df.withColumn(out, infer(factory, "string", batch, sort_by_length=False)(F.col(content)))


def previews(df: DataFrame, encode: Callable[[list[bytes]], bytes], frames: str = "frames", out: str = "preview") -> DataFrame:
    """One small moving picture of a window's frames, by an encoder; null without frames."""
    return df.withColumn(out, fold(lambda f: encode(f) if f else None, "binary")(frames))


# Number words: fixed values.
UNITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
SCALES = {"thousand": 1000, "million": 1_000_000, "billion": 1_000_000_000}


def numbers_written(text: str) -> str:
    """English number words as digits: "two hundred and five" is "205", "twenty-one" is "21". Words that follow one
    another but form no number stay apart ("one two" is "1 2")."""
    import re

    small = {w: i for i, w in enumerate(UNITS)} | {w: 10 * (i + 2) for i, w in enumerate(TENS)}
    names = "|".join([*small, "hundred", *SCALES])
    token = re.compile(rf"\b(?:{names})\b(?:(?:-|\s+(?:and\s+)?)(?:{names})\b)*", re.I)

    def value(words: list[str]) -> list[int]:
        out, whole, part, last = [], 0, None, None  # last: what the part may still take, below
        for w in words:
            if w in small:
                v = small[w]
                if part is not None and not (last is not None and 0 < v < last):
                    out.append(whole + part)
                    whole, part = 0, None
                part = (part or 0) + v
                last = 10 if v >= 20 else None
            elif w == "hundred":
                part, last = (1 if part is None else part) * 100, 100
            elif part == 0 and whole:
                whole *= SCALES[w]
            else:
                whole, part, last = whole + (1 if part is None else part) * SCALES[w], 0, 1000
        return [*out, whole + (part or 0)]

    def digits(m: re.Match) -> str:
        words = [w for w in re.split(r"[\s-]+", m[0].lower()) if w != "and"]
        return " ".join(map(str, value(words)))

    return token.sub(digits, text)


def inverse_normalised(text: Column, normaliser: Callable[[str], str] = numbers_written) -> Column:
    """Spoken forms as written ones, by a function of a text."""
    return fold(normaliser, "string")(text)


def convert_characters(text: Column, table: dict[str, str]) -> Column:
    """Characters replaced one for one by a table, such as that from traditional to simplified characters."""
    if bad := [k for k, v in table.items() if len(k) != 1 or len(v) != 1]:
        raise ValueError(f"not one character for one: {bad[:5]}")
    return F.translate(text, "".join(table), "".join(table.values()))
