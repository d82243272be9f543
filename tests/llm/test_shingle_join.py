"""Similar texts against brute force over exact shingle sets."""

import random
from fractions import Fraction

import pytest
from test_near_duplicates import roots

import corpus_pipeline
from sievework.llm import shingle_join


def similarity(a, b, k=5):
    def shingles(t):
        words = (t or "").lower().split()
        return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x or y else 1.0


def mutated(rng, words, edits):
    other = list(words)
    for i in rng.sample(range(len(words)), edits):
        other[i] = "n%d" % rng.randrange(10**6)
    return " ".join(other)


def texts():
    """Groups whose similarities lie about the threshold, short texts, and texts of a shared template."""
    rng = random.Random(4)
    out = [None, "", "one", "one two", "One", "a b c d e f", "a b c d e f g"]
    for n in (12, 40, 100, 300):
        for _ in range(4):
            words = ["w%d" % rng.randrange(2000) for _ in range(n)]
            out += [" ".join(words)] + [mutated(rng, words, max(1, round(n * share))) for share in (0.005, 0.01, 0.02, 0.025, 0.03, 0.04) for _ in range(2)]
    template = ["t%d" % i for i in range(60)]
    out += [" ".join(template + ["u%d" % (100 * i + j) for j in range(12)]) for i in range(20)]
    return out


@pytest.mark.parametrize("block", [4096, 5])
def test_all_similar_pairs_are_joined_and_no_others(spark, block):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    share = Fraction(4, 5)
    _, classes = shingle_join.text_classes(df, 5, share)
    ids = {r.node: r.doc_id for r in classes.collect()}
    value = dict(rows)
    edges = {(ids[r.a], ids[r.b]) for r in shingle_join.links(df, classes, 5, share, block).collect()}
    linked = lambda a, b: similarity(value[a], value[b]) >= 0.8
    assert all(linked(a, b) for a, b in edges)
    assert roots(sorted(ids.values()), lambda a, b: (a, b) in edges or (b, a) in edges) == roots(sorted(ids.values()), linked)


def test_keep_one_joins_every_pair_of_the_threshold(spark):
    rows = list(enumerate(texts()))
    value = dict(rows)
    want = roots(list(value), lambda a, b: similarity(value[a], value[b]) >= 0.8)
    kept = {r.doc_id for r in shingle_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {i for i, r in want.items() if i == r}


def test_each_group_of_texts_keeps_a_row_where_ids_repeat(spark):
    a, b = "a b c d e f g h", "x y z u v w"
    rows = [(1, a), (1, b), (2, b), (None, a), (7, a), (7, a), (8, "p q r s t u"), (8, "p q r s t u")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, "")
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, a), (1, a), (1, b), (8, "p q r s t u")]


def test_keep_one_leaves_texts_below_the_threshold(spark):
    rng, out = random.Random(11), []
    for i in range(40):
        words = ["v%d" % rng.randrange(5000) for _ in range(100)]
        other = list(words)
        for k in (20, 50, 80):  # 81 of 111 shingles shared: 0.73
            other[k] = "z%d" % (100 * i + k)
        out += [" ".join(words), " ".join(other)]
    df = spark.createDataFrame(list(enumerate(out)), "doc_id long, text string")
    assert shingle_join.keep_one(df).count() == 80
