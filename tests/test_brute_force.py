"""Registered queries that SQL can't express, over whole tables, against plain Python."""

import math

import pytest

from sievework.operators import python_filters as P
from sievework.operators import segments as S
from sievework.plans import catalog

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_duplicates_by_true_similarity(spark, texts):
    gone = {r.id for r in catalog.QUERIES["fuzzy_duplicates"](spark, DIR).collect()}
    grams = {i: {t[k : k + 24] for k in range(max(1, len(t) - 23))} for i, t in texts.items()}
    like = lambda a, b: len(grams[a] & grams[b]) / len(grams[a] | grams[b])
    near = {i: [j for j in texts if j != i and like(i, j) >= 0.5] for i in texts}
    assert gone and all(near[i] for i in gone)
    assert all(max(i, j) in gone for i in texts for j in near[i] if like(i, j) >= 0.95)


def test_word_error_rates(spark):
    turns = sorted((r.conv_id, r.turn, r.text) for r in spark.read.parquet(f"{DIR}/conversations.parquet").collect())
    after = {(a[0], a[1]): b[2] for a, b in zip(turns, turns[1:], strict=False) if a[0] == b[0]}
    rows = catalog.QUERIES["word_error_rates"](spark, DIR).collect()
    assert len(rows) == len(turns)
    for r in rows:
        mine = next(t for c, n, t in turns if (c, n) == (r.conv_id, r.turn)).split()
        other = after.get((r.conv_id, r.turn))
        assert r.wer == (None if other is None else pytest.approx(100 * distance(mine, other.split()) / max(1, len(mine)), abs=1e-3))


def test_snippets_cover_their_segments(spark):
    rows = catalog.QUERIES["snippet_plan"](spark, DIR).collect()
    kept = catalog.QUERIES["segments_without_overlaps"](spark, DIR).count()
    assert rows and all(0.5 <= r.end - r.start <= 3600 for r in rows) and sum(r.n for r in rows) <= kept
    by_user = {}
    for r in rows:
        by_user.setdefault(r.user_id, []).append((r.start, r.end))
    for spans in by_user.values():
        spans.sort()
        assert all(b[0] >= a[1] for a, b in zip(spans, spans[1:], strict=False))


def duplicate_share(text, n):
    words = text.split()
    if len(words) < n:
        return 1.0
    seen, covered = set(), [False] * len(words)
    for i in range(len(words) - n + 1):
        gram = tuple(words[i : i + n])
        if gram in seen:
            covered[i : i + n] = [True] * n
        seen.add(gram)
    return covered


@pytest.mark.parametrize("n", [2, 3, 4])
def test_top_ngrams(spark, texts, n):
    for r in catalog.QUERIES[f"filter_repeating_top_{n}grams"](spark, DIR).collect():
        words = texts[r.doc_id].split()
        grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        if grams:
            most = max(grams.count(g) for g in set(grams))
            top = next(g for g in grams if grams.count(g) == most)
            assert math.isclose(r.score, 1 - len(texts[r.doc_id].replace(top, "")) / len(texts[r.doc_id]), abs_tol=1e-12)
        assert r.kept == (r.score <= 0.2)


@pytest.mark.parametrize("n", [5, 10])
def test_duplicate_ngrams(spark, texts, n):
    for r in catalog.QUERIES[f"filter_repeating_duplicate_{n}grams"](spark, DIR).collect():
        covered = duplicate_share(texts[r.doc_id], n)
        if covered == 1.0 or not any(covered):
            assert r.score == (1.0 if covered == 1.0 else 0.0)
        else:
            assert 0 < r.score == P.duplicate_ngram_share(texts[r.doc_id], n)


def test_other_filters_score_each_text(spark, texts):
    for name in ("python_comments", "general_comments", "html_boilerplate", "token_count"):
        rows = catalog.QUERIES[f"filter_{name}"](spark, DIR).collect()
        assert {r.doc_id for r in rows} == set(texts)
    assert {r.doc_id: r.score for r in rows} == {i: len(t.split()) for i, t in texts.items()}


def test_texts_repacked_and_split(spark, texts):
    turns = spark.read.parquet(f"{DIR}/conversations.parquet").collect()
    rows = catalog.QUERIES["join_documents_max_length"](spark, DIR).collect()
    for conv in {t.conv_id for t in turns}:
        whole = "\n".join(t.text for t in sorted((t for t in turns if t.conv_id == conv), key=lambda t: t.turn))
        assert "\n".join(r.text for r in sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.turn)) == whole
    rows = catalog.QUERIES["split_by_tokens"](spark, DIR).collect()
    for i, text in texts.items():
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.chunk_id)
        assert "\n".join(r.text for r in mine) == text and all(r.n_tokens <= 200 or "\n" not in r.text for r in mine)


def test_clusters_are_nearest_centres(spark):
    import numpy as np

    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").collect()}
    rows = catalog.QUERIES["semantic_clusters"](spark, DIR).collect()
    assert {r.id for r in rows} == set(vectors)
    unit = {i: v / np.linalg.norm(v) for i, v in vectors.items()}
    centres = {c: np.mean([unit[r.id] for r in rows if r.centroid == c], 0) for c in {r.centroid for r in rows}}
    near = sum(min(centres, key=lambda c: np.linalg.norm(unit[r.id] - centres[c])) == r.centroid for r in rows)
    assert near >= 0.9 * len(rows) and S.edits([1], [1]) == 0
