"""SimHash and vector near-duplicates, and exact top-k, against brute force; edge cases of each."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sievework.llm import embed_dedup, shingle_join, simhash, topk


def roots(ids, linked):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def plain_fingerprint(text, k):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def documents():
    rng = random.Random(3)
    vocabulary = ["w%d" % i for i in range(300)] + ["É", "ß", "İ", " x"]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(80, 300))) for _ in range(12)]
    texts = [None, "", "  \t\n", "One", "one", "one two", "ONE\x0btwo", "a b c d " * 5000]
    for t in base:
        texts += [t, t.upper() if t.isascii() else t, t + " end", t.replace("w1 ", "w2 ", 1)]
    return list(enumerate(texts))


@pytest.mark.parametrize("radius", [0, 3, 8])
def test_simhash_equals_brute_force(spark, radius):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    got = {r.doc_id: r for r in simhash.near_duplicates(df, 3, radius).collect()}
    prints = {i: plain_fingerprint(t, 3) for i, t in rows}
    assert {i: r.fp % 2**64 for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == roots(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= radius)


def test_simhash_cuts_full_buckets(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = {}
    for i in range(300):
        x = centres[i % 3]
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        prints[i] = x
    signed = [(i, x - (1 << 64) if x >> 63 else x) for i, x in prints.items()]
    classes = spark.createDataFrame(signed, "node long, fp long")
    want = roots(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    for block in (4096, 5):
        edges = simhash.links(classes, 3, block).collect()
        assert roots(list(prints), lambda a, b, e={(r.a, r.b) for r in edges} | {(r.b, r.a) for r in edges}: (a, b) in e) == want
        assert len(edges) < 12 * len(prints)


def test_simhash_plan_keeps_the_pigeonhole_sum():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (1000, 64)).astype(float)
    bits[:, 5] = bits[:, 9]
    both = bits.T @ bits
    for n in (1000, 10**6, 10**10):
        for radius in (3, 10):
            parts = simhash.plan(n, both, radius)
            assert parts and sorted(b for p, _ in parts for b in p) == sorted({b for p, _ in parts for b in p})
            # parts without a threshold count -1 each
            least = [(sum(t for _, t in parts) - (m - len(parts)), radius - m + 1) for m in range(1, radius + 2)]
            assert any(a == b for a, b in least)
    assert any({5, 9} <= set(p) for p in simhash.group_bits(both, 1000, 4))


def test_simhash_ids_that_repeat_or_lack(spark):
    rows = [(1, "a b c d e f g h"), (1, "x y z u v w"), (2, "x y z u v w"), (None, "a b c d e f g h"), (7, "a b c d e f g h"), (7, "a b c d e f g h")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(df, 3, 3).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1), (7, 1), (7, 1)]
    assert simhash.near_duplicates(df.limit(0), 3, 3).count() == 0


def test_keep_one_finds_similar_documents(spark):
    rng = random.Random(9)
    vocabulary = ["w%d" % i for i in range(3000)]
    rows = []
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(400)]
        rows.append((10 * i, " ".join(words)))
        for k in range(3):  # each a few words away: similarity over 0.8
            other = list(words)
            for _ in range(4):
                other[rng.randrange(400)] = "new"
            rows.append((10 * i + k + 1, " ".join(other)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in shingle_join.keep_one(df).collect()}
    assert {10 * i for i in range(40)} <= kept and len(kept) <= 44


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = [[float(x) for x in base[i % 40] + rng.normal(size=16) * 0.1 * (i // 40)] for i in range(200)]
    return rows + [rows[3], rows[3], [2 * x for x in rows[3]], None, [], [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] * 16, [1.0, 0.0], [1.0, 0.01], [1e-200] * 16, [1e300] * 16]


def plain_cosine(a, b):
    if len(a) != len(b):
        return -1
    a, b = (np.array(x) / np.abs(x).max() for x in (a, b))
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


@pytest.mark.parametrize("sizes", [None, (7, 11)])
def test_vectors_equal_brute_force(spark, monkeypatch, sizes):
    if sizes:
        monkeypatch.setattr(embed_dedup, "INDEX_BLOCK", sizes[0])
        monkeypatch.setattr(embed_dedup, "PROBE_BLOCK", sizes[1])
        monkeypatch.setattr(embed_dedup, "CELL", 20)
    rows = list(enumerate(vectors()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit(0)).withColumn("ok", F.lit("clash"))
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df, margin=np.sqrt(1 - 0.81)).collect()}
    fine = [i for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    value = dict(rows)
    linked = lambda a, b: plain_cosine(value[a], value[b]) >= 0.9
    want = {i: i for i, _ in rows} | roots(fine, linked)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_links for i, r in got.items()} == {i: sum(j != i and linked(i, j) for j in fine) if i in fine else 0 for i, _ in rows}
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


@pytest.mark.parametrize(("dim", "rank"), [(64, 64), (16, 16), (64, 6)])
def test_vectors_recall_of_the_default_margin(spark, dim, rank):
    """Pairs planted at cosines of 0.90 to 0.94 among vectors of full and of low rank, with a hundred cells."""
    rng = np.random.default_rng(dim + rank)
    n, pairs = 10_000, 2_000
    x = rng.normal(size=(n, rank)) @ rng.normal(size=(rank, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.normal(size=(pairs, rank)) @ rng.normal(size=(rank, dim))
    aside -= (aside * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    c = rng.uniform(0.9, 0.94, (pairs, 1))
    x = np.concatenate([x, c * x[:pairs] + np.sqrt(1 - c * c) * aside])
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    got = {r.vec_id: r.n_links for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(x[i : i + 1000] @ x.T >= 0.9).sum(1) for i in range(0, len(x), 1000)]) - 1
    assert want.sum() > pairs  # so that there is something to find
    assert sum(got.values()) >= 0.9 * want.sum() and all(got[i] <= w for i, w in enumerate(want))


def test_vectors_ids_that_repeat_or_lack(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (4, [1.0, 0.001])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embed_dedup.near_duplicates(df).collect())
    assert got == [(0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (4, 2, 1, False)]
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4096, 16])
def test_topk_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rows = [(i, v) for i, v in enumerate(vectors()) if i != 211]
    rows += [(i + 1000, [0.5] * 16) for i in range(60)] + [(None, [1.0] * 16), (2000, [1e300] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    fine = {i: [int(np.floor(256 * x)) if abs(x) < 1e15 else int(256 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    want = []
    for q in (i for i in fine if i % 50 == 0):
        scores = sorted((-clip(sum(a * b for a, b in zip(fine[q], v, strict=True))), i) for i, v in fine.items() if i != q and len(v) == len(fine[q]))
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == sorted(want)


def test_topk_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [-0.001]), (2, [1.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()) == [(0, 1, 2, 65536), (0, 2, 1, -256)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_of_repeated_ids(spark):
    rows = [(50, [2.0]), (50, [1.0]), (1, [1.0]), (2, [0.5]), (3, [0.25]), (4, [0.125]), (None, [9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({n: F.lit("clash") for n in ("row", "x", "dim", "pivot", "dist", "bound", "rank", "query")})
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    whole = {i: int(256 * v[0]) for i, v in rows if i}
    one = lambda q, others: [(50, k + 1, i, q * v) for k, (i, v) in enumerate(sorted(others, key=lambda o: (-o[1], o[0]))[:5])]
    rest = [(i, v) for i, v in whole.items() if i != 50]
    assert got == sorted(one(512, [(50, 256), *rest]) + one(256, [(50, 512), *rest]))
