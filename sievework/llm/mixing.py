"""Mixing sources to target weights by Sainte-Laguë apportionment.

A source's words are laid out as equal blocks: its documents are dealt to shards by a hash of their ids and texts, and in
each shard stand one after the other in the order of a seeded hash. All targets together give a number of blocks, which
go to sources by highest quotients (target / 1, 3, 5, ...), and each source's quota goes to its shards in the same way,
by their sizes. A shard of n blocks with a quota of q takes every block q // n times, and once more the first q % n
blocks of a seeded order. Documents are cut where a chosen block begins or ends.

Edge cases: null and empty texts have size 0 and take nothing. The null source comes last. Repeated rows count each.
Without words every target is 0. Columns other than id, text and source are ignored by :func:`mix`, and kept as they
are, whatever their names, by :func:`take`.
"""

from __future__ import annotations

import heapq
import random
import re
import zlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import cycle
from math import gcd

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm._runtime import materialise, null_safe_key, small_batches, tidy

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a shard, and the most shards of a source: bounds what the driver gets to sources * MOST_SHARDS rows.
SHARD, MOST_SHARDS = 1 << 20, 1024
#: A block has at most so many words; fewer where the smallest source would have less than 512 blocks.
BLOCK, BLOCKS = 1024, 512
#: Rows up to which a table of sources or of shards (some 100 bytes each) is broadcast.
MOST_SENT = 100_000


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, hash)``, the last of the text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), _words(text_col).alias("size"), _hash(text_col).alias("hash"))


def _words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(text_col: str) -> Column:
    return F.xxhash64(text_col)


def targets(sources: dict, weights: list[int], share: Fraction, repeat: int = 2) -> dict:
    """Target of each source: ``share`` of all sizes by weight, none above ``repeat`` times its source's size; what
    others can't take is shared again by weight among the rest."""
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = dict(zip(order, cycle(weights)))
    left, open_, out = share * sum(sources.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > repeat * sources[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            out[s] = Fraction(repeat * sources[s])
            open_.remove(s)
        left -= sum(out[s] for s in full)
    return out


def sainte_lague(weights: list[Fraction], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients weight / (2k + 1), ties to the earlier; none above ``most``.

    Starts from the seats that a divisor found by bisection gives all at once, and hands out or takes back the few
    others one by one, so that the cost doesn't grow with the number of seats.
    """
    seats = min(seats, sum(m for w, m in zip(weights, most, strict=True) if w > 0))
    if seats <= 0:
        return [0] * len(weights)
    at = lambda d: [min(m, int(w / d + Fraction(1, 2))) if w else 0 for w, m in zip(weights, most, strict=True)]
    low, high = Fraction(0), 2 * max(weights) + 1  # as a divisor, high gives no seat
    low = Fraction(min(w for w in weights if w > 0), 2 * max(most) + 2)
    for _ in range(80):
        mid = (low + high) / 2
        mid = Fraction(mid.numerator * (1 << 80) // mid.denominator + 1, 1 << 80)
        if sum(at(mid)) <= seats:
            high = mid
        else:
            low = mid
        if sum(at(high)) == seats:
            break
    got = at(high)
    queue = [(-w / (2 * g + 1), i) for i, (w, g, m) in enumerate(zip(weights, got, most, strict=True)) if w and g < m]
    heapq.heapify(queue)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(queue)
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(queue, (-weights[i] / (2 * got[i] + 1), i))
    return got


def permutation(n: int, seed: int) -> tuple[int, int]:
    """(a, b) for which block -> (a * block + b) mod n puts n blocks in a seeded order."""
    rng = random.Random(seed)
    a = rng.randrange(1, min(n, 1 << 20) + 1)
    while gcd(a, n) > 1:
        a = a % min(n, 1 << 20) + 1
    return a, rng.randrange(n)


def mix(docs: DataFrame, weights: list[int] = (3, 1, 2), share: Fraction = Fraction(3, 2), repeat: int = 2, seed: int = 11, **columns) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, extra, taken)``: a document is taken ``copies`` times whole,
    and once more for the words of each ``extra`` span (from, to)."""
    spark = docs.sparkSession
    sized = materialise(sizes(docs, **columns).withColumn("key", null_safe_key("source")), "sizes")
    sources = {r.source: r.size for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}  # a row a source, each with a weight
    target = targets(sources, list(weights), share, repeat)
    positive = [n for n in sources.values() if n]
    block = max(1, min(BLOCK, min(positive, default=1) // BLOCKS))
    keys = {s: "n" if s is None else f"v{s}" for s in sources}
    about = spark.createDataFrame([(keys[s], n, float(target[s]), max(1, min(MOST_SHARDS, n // SHARD))) for s, n in sources.items()], "key string, source_size long, target double, shards int")
    if len(sources) <= MOST_SENT:
        about = F.broadcast(about)
    place = F.xxhash64(F.lit(seed + 1), "doc_id", "hash")
    dealt = sized.join(about, "key").withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "hash")).withColumn("shard", F.pmod(place, F.col("shards")).cast("int"))
    shards = sorted(dealt.groupBy("key", "shard").agg(F.sum("size").alias("size")).collect(), key=lambda r: (r.key, r.shard))
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    n_blocks = {(r.key, r.shard): -(-r["size"] // block) for r in shards}
    of: dict[str, list] = {}
    for r in shards:
        of.setdefault(r.key, []).append(r)
    most = [repeat * sum(n_blocks[keys[s], r.shard] for r in of[keys[s]]) for s in order]
    quotas = sainte_lague([target[s] for s in order], round(sum(target.values()) / block), most)
    plan = []
    for s, quota in zip(order, quotas, strict=True):
        rows = of[keys[s]]
        each = sainte_lague([Fraction(r["size"]) for r in rows], quota, [repeat * n_blocks[keys[s], r.shard] for r in rows])
        for r, q in zip(rows, each, strict=True):
            n = max(1, n_blocks[keys[s], r.shard])
            plan.append((keys[s], r.shard, n, q // n, q % n, *permutation(n, zlib.crc32(f"{seed} {keys[s]} {r.shard}".encode()))))
    planned = spark.createDataFrame(plan, "key string, shard int, blocks long, rounds long, more long, a long, b long")
    if len(plan) <= MOST_SENT:
        planned = F.broadcast(planned)
    until = F.sum("size").over(Window.partitionBy("key", "shard").orderBy("order", "doc_id", "hash", "size").rowsBetween(Window.unboundedPreceding, 0))
    laid = dealt.withColumn("end", until).withColumn("begin", F.col("end") - F.col("size")).join(planned, ["key", "shard"])
    # runs of chosen blocks among those that a document has words in
    chosen = lambda k: F.pmod(k * F.col("a") + F.col("b"), F.col("blocks")) < F.col("more")
    first, last = F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block)
    met = F.filter(F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>")), chosen)
    starts, ends = F.filter("met", lambda k: (k == first) | ~chosen(k - 1)), F.filter("met", lambda k: (k == last) | ~chosen(k + 1))
    inside = lambda k: F.least(F.greatest(k * block, F.col("begin")), F.col("end")) - F.col("begin")
    extra = F.zip_with(starts, ends, lambda x, y: F.struct(inside(x).alias("from"), inside(y + 1).alias("to")))
    out = laid.withColumn("met", met).withColumn("extra", extra)
    zero = F.lit(0).cast("long")
    taken = F.col("rounds") * F.col("size") + F.aggregate("extra", zero, lambda t, s: t + s["to"] - s["from"])
    return out.select("doc_id", "source", "size", "hash", "source_size", "target", F.col("rounds").cast("int").alias("copies"), "extra", taken.alias("taken"))


_WORDS = re.compile(WORD)


def cut(text: str, a: int, b: int) -> str:
    """The part of a text from its word a to before its word b, with the white space between."""
    begin, end = 0, len(text)
    for k, m in enumerate(_WORDS.finditer(text)):
        if k == a:
            begin = m.start()
        if k == b - 1:
            return text[begin : m.end()]
    return text[begin:end]


def _cut(text: Column, span: Column) -> Column:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            yield pa.array([None if t is None else cut(t, s["from"], s["to"]) for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    run = tidy(run)
    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(text, span)


def take(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, columns and their values as they were: a row for each whole copy, and one for each extra
    span, with ``text`` cut to it (and ``n_chars``, where there is one, set to its length). Documents taken 0 times go;
    those without words, of which the mix can't take any, go too."""
    small_batches(docs.sparkSession)
    on = ["id", "source", "size", "hash"]
    plan = mix(docs, **options).where("taken > 0").select(F.col("doc_id").alias("id"), "source", "size", "hash", "copies", "extra")
    plan = materialise(plan.withColumn("nth", F.row_number().over(Window.partitionBy(*on).orderBy("copies", F.size("extra"), "extra"))), "mix")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("id"), "source", _words("text").alias("size"), _hash("text").alias("hash"))
    if plan.where("nth > 1").isEmpty():
        plan = plan.drop("nth")
    else:  # rows alike in all of these are matched by number
        rows, on = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*on).orderBy("size"))), [*on, "nth"]
    met = rows.alias("d").join(plan.alias("p"), [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in on])
    whole = F.transform(F.sequence(F.lit(1), F.col("copies")), lambda _: F.struct(F.lit(0).cast("long").alias("from"), F.col("d.size").alias("to")))
    spans = F.concat(F.when(F.col("copies") > 0, whole).otherwise(F.array().cast("array<struct<from:bigint,to:bigint>>")), "extra")
    met = met.select("doc", F.col("d.size").alias("size"), F.explode(spans).alias("span"))
    part = (F.col("span.from") > 0) | (F.col("span.to") < F.col("size"))
    met = met.withColumn("part", part).withColumn("new", _cut(F.when(F.col("part"), F.col("doc.text")), F.col("span")))
    put = {"text": F.when(F.col("part"), F.col("new")).otherwise(F.col("doc.text"))}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(F.col("part"), F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return met.select(*[put.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
