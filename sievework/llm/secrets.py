"""Secret scans: fixed formats, and character Markov models of random strings against ordinary identifiers.

Everything here is DataFrame expressions. A candidate is a run of 20 or more characters of base64 or identifiers, with a
letter and a digit; it is a secret where the log-likelihood of its character pairs under the model of random strings
exceeds that under the model of ordinary identifiers by ``least`` nats. Both models count character pairs in labelled
samples, with add-one smoothing. Positions are in code points, ends exclusive.

Edge cases: null text is empty and has no spans. Overlapping secrets of several kinds are all reported; Markov spans are
looked for in what the fixed formats leave of a text. Time grows in proportion to a text and its matches. Repeated rows are scanned each. Other columns are kept by :func:`scan` unless
they are named like one that it adds, and by :func:`redact` all.
"""

from __future__ import annotations

import random
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The formats, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
_SPAN = "struct<start:int,rank:int,end:int,kind:string>"
SPAN = f"array<{_SPAN}>"
#: Log-likelihood ratio, in nats, from which a candidate counts as random: odds of ten thousand to one.
LEAST = 9.2


#: Elements of an array that one step of a running fold takes, and characters of a piece of a long text.
STEP, PIECE = 128, 2048


def running(items: Column, begin: Column, kind: str, step) -> Column:
    """The array that a fold over ``items`` appends to: ``step(at, item)`` gives the next running value and an array of
    what it adds. Items are taken by blocks of STEP, whose parts are joined once at the end: appending to one array for
    each item would copy it as often."""
    empty = F.array().cast(f"array<{kind}>")

    def one(s: Column, x: Column) -> Column:
        at, new = step(s["at"], x)
        return F.struct(at.alias("at"), F.concat(s["out"], new).alias("out"))

    def block(s: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(s["at"].alias("at"), empty.alias("out")), one)
        return bind(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(s["out"], F.array(x["out"])).alias("out")))

    def whole(items: Column) -> Column:
        last = F.floor((F.size(items) - 1) / STEP).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * STEP + 1, F.lit(STEP)))
        state = F.struct(begin.alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.when(F.size(items) > 0, F.aggregate(blocks, state, block, lambda s: F.flatten(s["out"]))).otherwise(empty)

    return bind(items, whole)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def spans(text: Column, pattern: str, kind: str, rank: int, group: int = 0, least: int = 0, also=None) -> Column:
    """Spans of a pattern's leftmost non-overlapping matches, without those whose ``group`` has under ``least`` characters
    or for which ``also`` (match -> Column) doesn't hold. A text is split at the matches; positions are running sums."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    walk = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), groups.alias("part"))

    def step(at: Column, z: Column) -> tuple[Column, Column]:
        begin = at + F.length(z["gap"])
        end = begin + F.coalesce(F.length(z["hit"]), F.lit(0))
        ok = z["hit"].isNotNull() & (F.length(z["part"]) >= least)
        if also is not None:
            ok &= also(z["hit"])
        one = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))).cast(SPAN)
        return end, F.when(F.coalesce(ok, F.lit(False)), one).otherwise(F.array().cast(SPAN))

    return F.when(text.rlike(pattern), running(walk, F.lit(0), _SPAN, step)).otherwise(F.array().cast(SPAN))


def blanked(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """A text with blanks in place of the matches that :func:`spans` reports: places stay what they are."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    walk = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), groups.alias("part"))
    hit = lambda z: F.when(F.length(z["part"]) >= least, F.repeat(F.lit(" "), F.length(z["hit"]))).otherwise(F.coalesce(z["hit"], F.lit("")))
    return F.array_join(F.transform(walk, lambda z: F.concat(z["gap"], hit(z))), "")


def base_spans(text: Column) -> Column:
    """Spans of the fixed formats by start, then kind as listed."""
    return F.array_sort(F.concat(spans(text, ASSIGN, "assign", 0, 2, 8), spans(text, ACCESS, "access", 1), spans(text, HEX, "hex", 2)))


# Words that names in source code are made of: a sample of ours.
NAMES = (
    "abort access add after allow apply assert auto batch begin block bool box break byte call cast cell char child clear client code color commit compare concat confirm const control count current date decode delete detail digest disable domain down edge element encode end error except expect extend fail fetch fill final flag flush font for frame from get graph guard hash height hidden hook icon image include init input instance item job kind language layout length limit link load lock loop make margin mask max memory message middle model mount namespace next normal null offset open order other package pair parent part path pause phase pixel plugin pool post prepare primary priority profile property proxy publish query quick range raw record reference register remote repeat report reset resolve rest resume reverse role route rule save scan score script second select serial service setup shape shift side size slice space stack state status storage stream submit sum sync tab target template theme time token top track transform trim type unit unlock url valid vector view walk watch window word write zone"
).split()


def labelled_samples(n: int = 4000, seed: int = 5) -> list[tuple[str, int]]:
    """(sample, 1 if random): strings of keys' alphabets from a seeded generator; names in source code, paths, dates,
    numbers and account numbers made by rule from NAMES. The same on every machine."""
    rng = random.Random(seed)
    alphabets = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_", "0123456789abcdef", string.ascii_uppercase + string.digits]
    out = [("".join(rng.choice(a) for _ in range(rng.randint(20, 48))), 1) for a in alphabets for _ in range(n // len(alphabets))]
    for _ in range(n):
        few = [rng.choice(NAMES) for _ in range(rng.randint(2, 5))]
        number = str(rng.randint(0, 10 ** rng.randint(1, 6)))
        date = f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        digits = "".join(rng.choice(string.digits) for _ in range(rng.randint(12, 24)))
        kind = rng.randrange(7)
        out.append((["_".join(few), "/".join(few) + number, "".join(x.title() for x in few) + number, f"{few[0]}-{date}-{few[1]}", digits, rng.choice(["DE", "FR", "ES", "GB"]) + digits, "_".join(few).upper()][kind], 0))
    return out


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of ASCII characters a, b at 128 a + b, from ``samples(text, random)``."""
    codes = F.transform(F.split("text", ""), F.ascii)
    pairs = samples.where("text IS NOT NULL AND random IN (0, 1)").select("random", F.explode(F.zip_with(codes, F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: a * 128 + b)).alias("pair")).where("pair IS NOT NULL AND pair < 16384 AND pair % 128 > 0")
    counts = {(r.random, r.pair): r["count"] for r in pairs.groupBy("random", "pair").count().collect()}  # 2 * 128 * 128 rows at most
    import math

    alphabet = [ord(c) for c in string.ascii_letters + string.digits + "+/_=-"]
    total = {(k, a): sum(counts.get((k, a * 128 + b), 0) for b in alphabet) + len(alphabet) for k in (0, 1) for a in alphabet}
    table = [0.0] * (128 * 128)
    for a in alphabet:
        for b in alphabet:
            p = [(counts.get((k, a * 128 + b), 0) + 1) / total[k, a] for k in (0, 1)]
            table[a * 128 + b] = round(math.log(p[1] / p[0]), 4)
    return table


def likelihood_ratio(token: Column, table: list[float]) -> Column:
    """Sum of the table over a token's character pairs. The table is a folded literal: no join, no map lookup."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    codes = F.transform(F.split(token, ""), F.ascii)
    pairs = F.zip_with(codes, F.slice(F.transform(F.split(token, ""), F.ascii), F.lit(2), F.length(token)), lambda a, b: F.coalesce(a * 128 + b, F.lit(0)))
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.coalesce(F.try_element_at(ratios, p + 1), F.lit(0.0)))


def default_table(spark: SparkSession) -> list[float]:
    return train(spark.createDataFrame(labelled_samples(), "text string, random int"))


def scan(docs: DataFrame, table: list[float] | None = None, least: float = LEAST, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` (spans of the fixed formats) and ``found`` (all spans), each by start, then kind."""
    table = default_table(docs.sparkSession) if table is None else table
    text = F.coalesce(F.col(text_col), F.lit(""))
    mixed = lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]") & (likelihood_ratio(t, table) >= least)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("base", "found", "_markov", "_rest")])
    docs = docs.withColumn("base", base_spans(text)).withColumn("_rest", text)
    for format_ in ((HEX,), (ACCESS,), (ASSIGN, 2, 8)):
        docs = docs.withColumn("_rest", F.when(F.size("base") > 0, blanked(F.col("_rest"), *format_)).otherwise(F.col("_rest")))
    docs = docs.withColumn("_markov", spans(F.col("_rest"), CANDIDATE, "markov", 3, also=mixed))
    return docs.withColumn("found", F.array_sort(F.concat("base", "_markov"))).drop("_markov", "_rest")


def written(found: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark`` and ``n_chars``, where there is one, set anew for the
    rows changed; columns as they were. Overlapping spans are one."""
    found = scan(docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("text")), **options).select("doc", "found")
    text, gap = F.col("doc.text"), "array<struct<a:int,b:int>>"

    # what lies between the spans: (a, b) before each span that begins after all before it have ended, then the rest
    def step(at: Column, x: Column) -> tuple[Column, Column]:
        between = F.array(F.struct(at.alias("a"), x["start"].alias("b"))).cast(gap)
        return F.greatest(at, x["end"]), F.when(x["start"] >= at, between).otherwise(F.array().cast(gap))

    rest = F.array(F.struct(F.array_max(F.transform("found", lambda s: s["end"])).alias("a"), F.length(text).alias("b"))).cast(gap)
    rows = found.withColumn("gaps", F.when(F.size("found") > 0, F.concat(running(F.col("found"), F.lit(0), "struct<a:int,b:int>", step), rest)))
    # a place in a text is a place in one of its pieces, so a gap is found without a walk from the text's start
    rows = rows.withColumn("pieces", F.when(F.col("gaps").isNotNull(), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))

    def cut(g: Column) -> Column:
        first, last = F.floor(g["a"] / PIECE).cast("int"), F.floor((g["b"] - 1) / PIECE).cast("int")
        piece = lambda k: F.element_at("pieces", k + 1)
        within = F.substring(piece(first), g["a"] - first * PIECE + 1, g["b"] - g["a"])
        middle = F.array_join(F.slice("pieces", first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        across = F.concat(F.substring(piece(first), g["a"] - first * PIECE + 1, F.lit(PIECE)), middle, F.substring(piece(last), F.lit(1), g["b"] - last * PIECE))
        return F.when(g["b"] <= g["a"], "").when(first == last, within).otherwise(across)

    rows = rows.withColumn("clean", F.array_join(F.transform("gaps", cut), mark))
    put = {"text": F.coalesce("clean", text)}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(F.col("clean").isNotNull(), F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return rows.select(*[put.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
