"""Toxicity by a convolutional text classifier, trained in numpy.

A word has two rows of a hashed table; of each component its embedding has the one nearer to zero, so that a word that
shares only one of its rows with another doesn't look like it. Filters
of widths 1, 2 and 3 run over the words, each keeps its largest response in the whole text, and a logistic layer reads
those. One dimension of the table starts from the smoothed log-odds of a bucket among toxic texts; all of it is
trained. Scores are shifted so that the threshold best on calibration rows stands at 0.7; each language with enough
calibration rows also has a threshold of its own, which ``toxic`` uses. Only words enter a score.

Learnt from every labelled row that isn't held out, of any length: three quarters train and one quarter sets the
thresholds. The rows' hashed words lie in files of the shared folder, by shards; each pass over them trains all shards
at a time and takes the mean, so neither the driver nor a task holds more as rows grow in number. Every whole text is
scored.

Edge cases: null text is empty and scores like a text without words. Labelled rows whose id or label is null are not
used; an id with several labels has the largest, one with several texts the smallest of them. Without a row of each
class the model knows nothing and scores 0. Rows are scored each, repeated or not. Only ``doc_id``, ``text`` and
``lang`` (null where there is none) are read; :func:`score` replaces columns named ``score`` and ``toxic``, and
:func:`reject_toxic` keeps all columns and their values.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.llm._encoder import Numbered
from sievework.llm._runtime import materialise, open_fs, scratch, small_batches, tidy

WIDTHS, FILTERS, DIM, BUCKETS = (1, 2, 3), 8, 8, 1 << 18
TAPS = sum(WIDTHS) * FILTERS
#: Words that are read at a time.
BLOCK = 1 << 16
#: Rows of DIM values that hold all of a model's.
ROWS = BUCKETS + -(-(DIM * TAPS + 2 * len(WIDTHS) * FILTERS + 1) // DIM)
REJECT = 0.7
#: Labelled rows of a shard, and the number of shards at which shards grow instead.
SHARD, MOST_SHARDS = 8000, 64
#: Parts of 1 in which shards give changes of values.
UNIT = float(1 << 32)
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def buckets(word: str) -> tuple[int, int]:
    h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h % BUCKETS, (h >> 32) % BUCKETS


def embeddings(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Rows of words by their two buckets: of each component the one nearer to zero."""
    a, b = table[hashes[:, 0]], table[hashes[:, 1]]
    return np.where(np.abs(a) <= np.abs(b), a, b)


@dataclass
class Model:
    table: np.ndarray  # BUCKETS x DIM
    taps: np.ndarray  # DIM x TAPS: for each width, for each place in it, FILTERS columns
    bias: np.ndarray  # a filter of each width
    weight: np.ndarray
    shift: float = 0.0
    known: bool = True
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, taps: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter in each text, and its place. ``taps``: rows of all words, two blank ones
        after each text (so that a window never reaches the next). Texts of more than BLOCK words go on in another one
        that has the words after BLOCK again: windows that start there are left to it."""
        ends = np.cumsum(sizes + 2)
        starts = ends - sizes - 2
        best, places, col = [], [], 0
        for width in WIDTHS:
            conv = taps[: len(taps) - width + 1, col : col + FILTERS].copy()
            for k in range(1, width):
                conv += taps[k : len(taps) - width + 1 + k, col + k * FILTERS : col + (k + 1) * FILTERS]
            conv = np.concatenate([conv, np.full((width - 1, FILTERS), -np.inf, conv.dtype)])
            conv[ends - 1] = -np.inf  # starts in a blank row; an empty text keeps its first blank row
            full = sizes > 0
            conv[ends[full] - 2] = -np.inf
            conv[ends[~full] - 2] = 0
            for k in range(WIDTHS[-1] - 1):
                conv[starts[sizes > BLOCK + k] + BLOCK + k] = -np.inf
            best.append(np.maximum.reduceat(conv, starts))
            places.append(conv)
            col += width * FILTERS
        return np.concatenate(best, 1), places

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias[:-1], 0) @ self.weight + self.bias[-1] + self.shift


class Scorer:
    """Scores texts; keeps the filter responses of the words met, at most ``most`` of them."""

    def __init__(self, model: Model, most: int = 60_000):
        self.model, self.most = model, most
        self._clear()

    def _clear(self) -> None:
        self.at, self.taps, self.n = Numbered(), np.zeros((1024, TAPS), np.float32), 1
        self.at[""] = 0  # the blank word

    def _learn(self) -> None:
        if new := self.at.new:
            self.at.new = []
            h = np.array([buckets(w) for w in new])
            got = embeddings(self.model.table, h) @ self.model.taps
            if self.n + len(new) > len(self.taps):
                self.taps = np.concatenate([self.taps[: self.n], np.zeros((self.n + len(new), TAPS), np.float32)])
            self.taps[self.n : self.n + len(new)] = got
            self.n += len(new)

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """Texts are read in blocks of 65,536 words, which overlap by a window, so memory doesn't grow with a text."""
        if self.n > self.most:
            self._clear()
        pools, of, block = [], [], BLOCK
        held: list[np.ndarray] = []
        sizes: list[int] = []

        def flush() -> None:
            if sizes:
                self._learn()
                pools.append(self.model.pooled(self.taps[np.concatenate(held)], np.array(sizes))[0])
                held.clear()
                sizes.clear()

        blank = np.zeros(2, np.int64)
        for i, text in enumerate(texts):
            found = words(text)
            for at in range(0, max(1, len(found)), block):
                part = found[at : at + block + WIDTHS[-1] - 1]
                held += [np.fromiter(map(self.at.__getitem__, part), np.int64, len(part)), blank]
                sizes.append(len(part))
                of.append(i)
                if sum(sizes) > block:
                    flush()
        flush()
        if not pools:
            return np.zeros(0)
        best = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        np.maximum.at(best, np.array(of), np.concatenate(pools))
        return self.model.logit(best)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def best_threshold(z: np.ndarray, y: np.ndarray, stands_for: np.ndarray) -> float:
    """Logit with the best F1, in the middle of the gap below it; a row stands for so many of its class."""
    order = np.argsort(-z, kind="stable")
    z, y, stands_for = z[order], y[order], stands_for[order]
    hits = np.cumsum(y * stands_for)
    f1 = 2 * hits / (np.cumsum(stands_for) + hits[-1])
    f1[:-1][z[:-1] == z[1:]] = -1
    k = int(f1.argmax())
    return float((z[k] + z[k + 1]) / 2 if k + 1 < len(z) else z[k] - 1)


def model_of(values: np.ndarray) -> Model:
    """The model whose arrays are views of ``values``: the table's rows, then those that hold all the others."""
    rest, n = values[BUCKETS:].reshape(-1), len(WIDTHS) * FILTERS
    taps, bias, weight = np.split(rest[: DIM * TAPS + 2 * n + 1], [DIM * TAPS, DIM * TAPS + n + 1])
    return Model(values[:BUCKETS], taps.reshape(DIM, TAPS), bias, weight)


def responses(model: Model, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter in each text, and the word at which its window starts (-1: in none). ``hashes``:
    buckets of all words and a blank row last. Texts are read in blocks that overlap by a window."""
    ends = np.cumsum(sizes)
    best = np.full((len(sizes), len(WIDTHS) * FILTERS), -np.inf, np.float32)
    places = np.full(best.shape, -1)
    group: list[tuple[int, int, int]] = []
    held = 0

    def flush() -> None:
        ids = np.concatenate([np.append(np.arange(a, b), (-1, -1)) for _, a, b in group])
        x = embeddings(model.table, hashes[ids]) * (ids >= 0)[:, None]
        convs = model.pooled(x @ model.taps, np.array([b - a for _, a, b in group]))[1]
        at = 0
        for text, a, b in group:
            top = at + max(1, b - a)
            k = np.concatenate([c[at:top].argmax(0) for c in convs]) + at
            z = np.concatenate([c[at:top].max(0) for c in convs])
            more = z > best[text]
            best[text, more], places[text, more] = z[more], ids[k[more]]
            at += b - a + 2
        group.clear()

    for text, (first, end) in enumerate(zip(ends - sizes, ends, strict=True)):
        for a in range(first, max(end, first + 1), BLOCK):
            group.append((text, a, min(a + BLOCK + WIDTHS[-1] - 1, end)))
            held += group[-1][2] - a
            if held > BLOCK:
                flush()
                held = 0
    if group:
        flush()
    return best, places


def _words_of(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words of texts, a blank row after all, and how many words each has."""
    blank = np.zeros(2, np.int32).tobytes()
    return np.frombuffer(b"".join([*rows, blank]), np.int32).reshape(-1, 2), np.array([len(r) // 8 for r in rows])


def _lots(rows: Iterator[tuple[int, bytes]], rng: np.random.Generator) -> Iterator[list[tuple[int, bytes]]]:
    """All rows in lots of some 64, in an order drawn among those of 4 million words at a time."""
    held, n = [], 0

    def deal() -> Iterator[list[tuple[int, bytes]]]:
        order = rng.permutation(len(held))
        for lot in np.array_split(order, max(1, len(order) // 64)):
            yield [held[i] for i in lot]

    for row in rows:
        held.append(row)
        n += len(row[1]) // 8 + 64
        if n > 4_000_000:
            yield from deal()
            held, n = [], 0
    if held:
        yield from deal()


def descend(state: np.ndarray, rows: Iterator[tuple[int, bytes]], toxic_share: float, rng: np.random.Generator, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """One pass of AdaGrad over rows of (label, buckets of words). ``state``: values, and sums of squared gradients.
    Returns the state after it and the number of lots that changed each row of it."""
    state = state.copy()
    model, speed = model_of(state[0]), model_of(state[1])
    lots_at = np.zeros(state.shape[1], np.int64)
    for lot in _lots(rows, rng):
        hashes, sizes = _words_of([r for _, r in lot])
        y = np.array([t for t, _ in lot], np.float32)
        cost = np.where(y == 1, 0.5 / toxic_share, 0.5 / (1 - toxic_share))
        pooled, places = responses(model, hashes, sizes)
        ends = np.cumsum(sizes)[:, None]
        act = np.maximum(pooled + model.bias[:-1], 0)
        gz = ((sigmoid(act @ model.weight + model.bias[-1]) - y) * cost / len(lot)).astype(np.float32)
        ga = gz[:, None] * model.weight[None] * (act > 0)
        grad = {"bias": np.append(ga.sum(0), gz.sum()), "weight": gz @ act, "taps": np.zeros_like(model.taps)}
        touched, pulls, col = [], [], 0
        for k, width in enumerate(WIDTHS):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            for j in range(width):
                real = (places[:, own] >= 0) & (places[:, own] + j < ends)
                h = hashes[np.where(real, places[:, own] + j, -1)]
                x = embeddings(model.table, h.reshape(-1, 2)).reshape(*real.shape, DIM) * real[:, :, None]
                taps = slice(col, col + FILTERS)
                grad["taps"][:, taps] = np.einsum("bf,bfd->df", ga[:, own], x)
                touched.append(h[real])
                pulls.append((ga[:, own][:, :, None] * model.taps[:, taps].T[None])[real])
                col += FILTERS
        for name, g in grad.items():
            getattr(speed, name)[...] += g * g
            getattr(model, name)[...] -= rate * g / np.sqrt(getattr(speed, name))
        where, pulls = np.concatenate(touched), np.concatenate(pulls)
        rows_at, back = np.unique(where, return_inverse=True)
        g = np.zeros((len(rows_at), DIM), np.float32)
        for s in (0, 1):  # both rows of a word are pulled
            np.add.at(g, back.reshape(where.shape)[:, s], pulls)
        speed.table[rows_at] += g * g
        model.table[rows_at] -= rate * g / np.sqrt(speed.table[rows_at])
        lots_at[rows_at] += 1
        lots_at[BUCKETS:] += 1
    return state, lots_at


class Learner:
    """Learns from a table of rows (toxic, apart, lang, words), which stays in files of the shared folder.

    The files make shards of some ``SHARD`` rows. In each of ``epochs`` rounds every shard goes on from the same state,
    and the new state is the mean of theirs, each row of it over the shards that changed it, by the number of their lots
    that did. What shards give is summed in whole numbers, so that no order of addition changes it. The driver has sums
    by bucket and by step of the scores only, at any number of rows.
    """

    def __init__(self, learnt: DataFrame, seed: int = 7, epochs: int = 6, rate: float = 0.05):
        self.spark, self.seed, self.epochs, self.rate = learnt.sparkSession, seed, epochs, rate
        self.count = {(a, t): 0 for a in (False, True) for t in (0, 1)}
        files: dict[str, int] = {}
        for r in learnt.groupBy(F.col("_metadata.file_path").alias("file"), "apart", "toxic").count().collect():
            files[r.file] = files.get(r.file, 0) + r["count"]
            self.count[r.apart, r.toxic] += r["count"]
        self.shards: list[list[str]] = []
        held = SHARD
        for name, n in sorted(files.items()):
            if held >= SHARD * 3 // 4:
                self.shards.append([])
                held = 0
            self.shards[-1].append(name)
            held += n

    def _each(self, run, schema: str) -> DataFrame:
        """Rows of the batches that ``run(shard, rows)`` yields, a task for each shard. ``rows(apart)`` reads it."""
        shards = self.shards

        def read(shard: int, apart: bool) -> Iterator[pa.RecordBatch]:
            for uri in shards[shard]:
                fs, at = open_fs(uri)
                with fs.open_input_file(at) as f:
                    for batch in pq.ParquetFile(f, buffer_size=1 << 20).iter_batches(128, columns=["toxic", "apart", "lang", "words"]):
                        yield batch.filter(pc.equal(batch.column(1), apart))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard in batch.column(0).to_pylist():
                    yield from run(shard, lambda apart, shard=shard: read(shard, apart))

        return self.spark.range(0, len(shards), 1, len(shards)).mapInArrow(tidy(task), schema)

    def _sums(self, run, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums by row number of the whole numbers that ``run(shard, rows)`` returns with them."""
        names = [f"c{i}" for i in range(width)]

        def batches(shard, rows):
            at, found = run(shard, rows)
            for a in range(0, len(at), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 10_000]) for x in (at, *found.T)], names=["row", *names])

        each = self._each(batches, ", ".join(f"{n} long" for n in ["row", *names]))
        got = each.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        return got.column(0).to_numpy(), np.stack([got.column(n).to_numpy() for n in names], 1)

    def start(self) -> np.ndarray:
        """The state before the first round: log-odds of buckets in the first dimension, small draws in the others."""

        def run(shard, rows):
            seen = np.zeros((BUCKETS, 2), np.int64)
            for batch in rows(False):
                for toxic, raw in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    seen[np.unique(np.frombuffer(raw, np.int32)), toxic] += 1
            at = np.flatnonzero(seen.sum(1))
            return at, seen[at]

        at, found = self._sums(run, 2)
        seen = np.zeros((2, BUCKETS))
        seen[:, at] = found.T
        rng = np.random.default_rng(self.seed)
        state = np.zeros((2, ROWS, DIM), np.float32)
        state[1] = 1e-6
        model = model_of(state[0])
        model.taps[...] = rng.normal(0, 0.1, model.taps.shape)
        share = self.count[False, 1] / max(self.count[False, 0], 1)
        model.table[:, 0] = np.log((seen[1] + 5) / (seen[0] * share + 5)) / 2
        model.table[:, 1:] = rng.normal(0, 0.02, (BUCKETS, DIM - 1)) * (seen.sum(0) > 0)[:, None]
        model.taps[0] = np.abs(model.taps[0]) + 0.5
        model.taps[0, FILTERS // 2 :: FILTERS] *= -1
        model.weight[:] = rng.normal(0, 0.1, len(model.weight)) + 0.1
        return state

    def round(self, state: np.ndarray, epoch: int) -> np.ndarray:
        sent = self.spark.sparkContext.broadcast(state)  # 17 MB at any corpus size
        toxic_share = self.count[False, 1] / (self.count[False, 0] + self.count[False, 1])
        seed, rate = self.seed, self.rate

        def run(shard, rows):
            pairs = (p for b in rows(False) for p in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True))
            after, lots = descend(sent.value, pairs, toxic_share, np.random.default_rng([seed, epoch, shard]), rate)
            at = np.flatnonzero(lots)
            moved = (after[:, at].astype(np.float64) - sent.value[:, at]) * lots[at, None]
            return at, np.column_stack([lots[at], *np.rint(moved * UNIT).astype(np.int64)])

        at, found = self._sums(run, 1 + 2 * DIM)
        mean = found[:, 1:] / (found[:, :1] * UNIT)
        state = state.copy()
        state[0, at] += mean[:, :DIM].astype(np.float32)
        state[1, at] += mean[:, DIM:].astype(np.float32)
        sent.destroy()
        return state

    def calibrate(self, model: Model, stands_for: tuple[float, float]) -> None:
        """Set the shift, and thresholds of the languages with 20 or more rows of each class, by all rows that are kept
        apart, counted by steps of 1/1024 of the logit; thresholds lie between steps."""
        sent = self.spark.sparkContext.broadcast(model)

        def run(shard, rows):
            for batch in rows(True):
                if len(batch):
                    hashes, sizes = _words_of(batch.column(3).to_pylist())
                    z = sent.value.logit(responses(sent.value, hashes, sizes)[0])
                    step = np.floor(np.clip(z, -60, 60).astype(np.float64) * 1024).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(step), batch.column(0)], names=["lang", "step", "toxic"])

        def best(got: pa.Table) -> float:
            z, y = (got.column(0).to_numpy() + 0.5) / 1024, got.column(1).to_numpy()
            return best_threshold(z, y, got.column(2).to_numpy() * np.where(y == 1, stands_for[1], stands_for[0]))

        def of_language(key, got: pa.Table) -> pa.Table:
            return pa.table({"lang": [key[0].as_py()], "threshold": [best(got.select(["step", "toxic", "n"]))]})

        of_language.__annotations__ = {"key": tuple[pa.Scalar, ...], "got": pa.Table, "return": pa.Table}
        by = ["lang", "step", "toxic"]
        cells = materialise(self._each(run, "lang string, step long, toxic int").groupBy(*by).agg(F.count("*").alias("n")), "steps")
        cut = best(cells.groupBy("step", "toxic").agg(F.sum("n").alias("n")).toArrow())
        model.shift = float(np.log(REJECT / (1 - REJECT))) - cut
        least = F.least(F.sum(F.col("n") * F.col("toxic")), F.sum(F.col("n") * (1 - F.col("toxic"))))
        large = cells.where("lang <> ''").groupBy("lang").agg(least.alias("least")).where("least >= 20").select("lang")
        found = cells.join(large, "lang").groupBy("lang").applyInArrow(of_language, "lang string, threshold double").collect()
        model.thresholds = {r.lang: float(sigmoid(np.array(r.threshold + model.shift))) for r in sorted(found)}
        sent.destroy()

    def fit(self, stands_for: tuple[float, float] = (1.0, 1.0)) -> Model:
        """Train on the rows that aren't kept apart; set the shift and the languages' thresholds on those that are."""
        if not (self.count[False, 0] and self.count[False, 1]):
            return Model(*(np.array(x) for x in _arrays(model_of(np.zeros((ROWS, DIM), np.float32)))), known=False)
        state = self.start()
        for epoch in range(self.epochs):
            state = self.round(state, epoch)
        model = Model(*(np.array(x) for x in _arrays(model_of(state[0]))))
        if self.count[True, 0] and self.count[True, 1]:
            self.calibrate(model, stands_for)
        return model


def _arrays(model: Model) -> tuple[np.ndarray, ...]:
    return model.table, model.taps, model.bias, model.weight


def held_out(column: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def hashed(rows: DataFrame) -> DataFrame:
    """(toxic, apart, lang, words) of ``rows(doc_id, text, lang, toxic)``: the two buckets of each word as 32-bit integers.
    A row is kept apart for calibration by a hash of its id."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known = Numbered(), np.zeros((0, 2), np.int32)
        for batch in batches:
            for a in range(0, len(batch), 64):
                ids, texts, langs, toxic = batch.slice(a, 64).columns
                found = [np.fromiter(map(at.__getitem__, words(t.as_py())), np.int64, -1) for t in texts]
                if at.new:
                    known = np.concatenate([known, np.array([buckets(w) for w in at.new], np.int32)])
                    at.new = []
                apart = [zlib.crc32(f"calibration {i}".encode()) % 4 == 0 for i in ids.to_pylist()]
                raw = pa.array([known[f].tobytes() for f in found], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, toxic, pa.array(apart, pa.bool_()), langs, raw], names=["doc_id", "toxic", "apart", "lang", "words"])
                if len(at) > 200_000:
                    at, known = Numbered(), known[:0]

    return rows.select("doc_id", "text", "lang", "toxic").mapInArrow(tidy(run), "doc_id long, toxic int, apart boolean, lang string, words binary")


def train(docs: DataFrame, labels: DataFrame, max_rows: int | None = None, max_chars: int | None = None, max_total: int | None = None) -> Model:
    """A model of ``labels(doc_id, toxic)``, learnt from all rows that are not held out, each text whole.

    Documents are read once, and each pass of the training reads their words' buckets from files. ``max_rows`` (half of
    each class where there are enough), ``max_chars`` of a text and ``max_total`` of all texts bound it where they are
    given; rows are then taken in the order of a hash of their ids.
    """
    spark = docs.sparkSession
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    labels = labels.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    there = dict(labels.groupBy("toxic").count().collect())
    if max_rows is not None:
        take = lambda label, n: labels.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect()
        positive = take(1, max_rows // 2)
        labels = spark.createDataFrame([(r.doc_id, r.toxic) for r in positive + take(0, max_rows - len(positive))], "doc_id long, toxic int")
    text = F.coalesce(F.col("text"), F.lit(""))
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(text.alias("text"), _lang(docs).alias("lang")).alias("row")).where(~held_out())
    if max_chars is not None:
        wanted = wanted.where(F.length("row.text") <= max_chars)
    one = wanted.groupBy("doc_id").agg(F.min("row").alias("row")).join(labels, "doc_id")  # repeats go before rows move
    if max_total is not None:
        upto = F.sum(F.length("row.text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
        one = one.withColumn("upto", upto).where(F.col("upto") <= max_total)
    with scratch(spark):
        shards = min(MOST_SHARDS, max(1, round(sum(there.values()) / SHARD)))
        rows = hashed(one.select("doc_id", "row.text", "row.lang", "toxic")).repartition(shards, "doc_id").sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
        learner = Learner(materialise(rows.drop("doc_id"), "learnt"))
        got = {t: learner.count[False, t] + learner.count[True, t] for t in (0, 1)}
        return learner.fit(tuple(there.get(t, 0) / max(1, got[t]) for t in (0, 1)) if max_rows is not None else (1.0, 1.0))


def _lang(docs: DataFrame) -> Column:
    return F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def probability(spark: SparkSession, model: Model, text: Column) -> Column:
    """Score of a text; only texts go to the Python workers, only scores come back."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # 8 MB at any corpus size

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(sent.value)
        for batch in batches:
            z = [scorer.logits([x.as_py() for x in batch.slice(at, 64)]) for at in range(0, len(batch), 64)]
            yield pa.array(sigmoid(np.concatenate(z)).astype(np.float64) if z else np.zeros(0))

    run = tidy(run)
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(text) if model.known else F.lit(0.0)


def limit(model: Model, lang: Column) -> Column:
    """The threshold of a row's language, 0.7 where it has none."""
    out = F.lit(REJECT)
    for name, t in model.thresholds.items():
        out = F.when(lang == name, F.lit(t)).otherwise(out)
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``toxic`` (0 or 1, by the threshold of the row's language)."""
    out = docs.withColumn("score", probability(docs.sparkSession, model, F.col("text")))
    return out.withColumn("toxic", (F.col("score") >= limit(model, _lang(docs))).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that are toxic by their language's threshold; columns and values as they were."""
    model = train(docs, labels, **options)
    return docs.where(probability(docs.sparkSession, model, F.col("text")) < limit(model, _lang(docs)))
