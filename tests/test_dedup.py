"""Exact, fuzzy and semantic deduplication and the graph step."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import dedup as D
from sievework.plans import graph
from sievework.plans.graph import connected_components


def test_exact(spark):
    df = spark.createDataFrame([(1, "  HELLO\tWORLD "), (2, "hello world"), (5, None), (4, "x"), (-1, "x"), (6, None)], "id long, text string")
    assert [r.id for r in D.exact_duplicates(df).collect()] == [4]
    assert sorted(r.id for r in D.exact_duplicates(df, normalise=True).collect()) == [2, 4]
    assert D.remove_ids(df, D.exact_duplicates(df)).count() == 5
    assert D.remove_ids(df, df.limit(0).select("id")).count() == 6


@pytest.mark.parametrize(("seed", "small"), [(0, 0), (1, 0), (0, 500_000), (1, 500_000)])
def test_components(spark, monkeypatch, seed, small):
    monkeypatch.setattr(graph, "SMALL", small)
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)]
    rng.shuffle(edges)
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent if find(n) != n}


def test_fuzzy(spark):
    rng = random.Random(1)
    base = " ".join(rng.choice("lorem dolor amet tempor magna aliqua veniam quis nostrud ullamco".split()) for _ in range(400))
    docs = [(1, base), (2, base.replace("magna", "magma", 1)), (300, base + " end"), (4, "short"), (-1, "short"), (7, "quite unlike the others in every way"), (8, None)]
    df = spark.createDataFrame(docs, "id long, text string")
    assert sorted(r.id for r in D.fuzzy_duplicates(df).collect()) == [2, 4, 300]
    buckets = D.lsh_buckets(D.minhash(df))
    chained = D.components(D.bucket_edges(buckets))
    assert sorted(r.id for r in D.group_duplicates(chained).collect()) == [2, 4, 300]
    assert D.fuzzy_duplicates(df.limit(0)).count() == 0
    one = D.minhash(df.where("id = 1"), num_hashes=4, use_64bit=True).first()[D.SIGNATURE]
    assert len(one) == 4 and all(0 <= x < 2**61 for x in one)


def test_pairwise(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(64, 16))
    vectors[5] = vectors[2]
    rows = [(i, [float(x) for x in v], i % 2, 0.0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, centroid int, cosine_dist_to_cent double")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for block in (5, 2048):
        got = {r.id: r for r in D.pairwise(df, "easy", block=block).collect()}
        for i in range(64):
            before = [j for j in range(i % 2, i, 2)]
            if not before:
                assert (got[i].max_id, got[i].cosine_sim_score) == (i, 0.0)
            else:
                best = max(before, key=lambda j: unit[i] @ unit[j])
                assert got[i].max_id == best and got[i].cosine_sim_score == pytest.approx(unit[i] @ unit[best])
    with pytest.raises(ValueError):
        D.pairwise(df, "neither")


def test_clusters(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4) * 0.01 + np.eye(4)[i % 3]]) for i in range(60)]
    got = D.cluster(spark.createDataFrame(rows, "id long, embeddings array<double>"), 3, max_iter=10)
    groups = got.groupBy("centroid").agg(F.countDistinct(F.col("id") % 3).alias("k")).collect()
    assert len(groups) == 3 and all(r.k == 1 for r in groups)


def test_id_ranges(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("a", 3), ("b", 4), ("b", 5)], "file string, n int")
    ranges = D.id_ranges(rows, "file", ["n"], start=10)
    got = {r.n: r[D.ID] for r in D.add_range_ids(rows, ranges, "file", ["n"]).collect()}
    assert sorted(got.values()) == [10, 11, 12, 13, 14] and {got[2], got[3]} == {10, 11}
    more = rows.unionByName(spark.createDataFrame([("A", 6), ("A", 7)], "file string, n int"))
    again = D.add_range_ids(more, D.id_ranges(more, "file", ["n"], known=ranges), "file", ["n"]).collect()
    assert {r.n: r[D.ID] for r in again if r.n < 6} == got and {r[D.ID] for r in again if r.n > 5} == {15, 16}
    assert D.id_ranges(rows.limit(0), "file", ["n"]).count() == 0


def test_minhash_estimates_similarity(spark):
    import random

    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    texts = [base, base[:2400] + "".join(rng.choice("xyz") for _ in range(600)), base[1500:], "x"]
    rows = D.minhash(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), char_ngrams=10, num_hashes=1000).orderBy(D.ID).collect()
    grams = [{t[i : i + 10] for i in range(max(1, len(t) - 9))} for t in texts]
    for i in range(4):
        for j in range(4):
            same = sum(x == y for x, y in zip(rows[i][D.SIGNATURE], rows[j][D.SIGNATURE], strict=True)) / 1000
            assert abs(same - len(grams[i] & grams[j]) / len(grams[i] | grams[j])) < 0.06
    assert all(0 <= x < 1 << 32 for x in rows[0][D.SIGNATURE])
