"""License scans by diagonal voting over rolling word k-gram hashes.

Every rolling k-gram hash of every text is joined with the templates' k-grams. A match of text word i with template word
j votes for the diagonal i - j; votes of one diagonal make a run, neighbouring diagonals (a word more or less) merge
into one span, and spans are verified against the text's own words. A phrase, which has to stand word for word, is a
template whose diagonal needs every vote.

Edge cases: null text is empty. Null ids and repeated rows are scanned each. Texts without words have no labels and
score 0. An empty table gives an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm._encoder import Numbered
from sievework.llm._runtime import materialise, small_batches, tidy

#: Phrases that have to stand word for word, and their labels: fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Well-known notices of public licenses, and labels of their own.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-notice", "this work is licensed under the gnu general public license version"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-notice", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
]
K = 2
#: A span of a template counts where so many of its words stand on its diagonals; of them in a row, so many at least.
COVER, ROW = 0.8, 4
#: Bytes of spans, some 32 each, up to which they are broadcast to the texts that they stand in.
BROADCAST_BYTES = 8 << 20


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case, in UTF-8: a byte is part of a word if it is a digit, a letter or not ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


#: Digits, lower-cased letters and bytes beyond ASCII as they are, blanks for the others: the bytes of the class
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F].
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


class Hasher:
    """64-bit hashes of rolling k-grams: each word's own hash, combined by position."""

    def __init__(self, k: int, most: int = 150_000):
        self.k, self.most = k, most
        self._clear()

    def _clear(self) -> None:
        self.at, self.hash = Numbered(), np.zeros(0, np.uint64)

    def grams(self, found: list[bytes]) -> np.ndarray:
        import xxhash

        if len(self.at) > self.most:
            self._clear()
        which = np.fromiter(map(self.at.__getitem__, found), np.int64, len(found))
        if new := self.at.new:
            self.at.new = []
            self.hash = np.concatenate([self.hash, np.fromiter((xxhash.xxh64_intdigest(w) for w in new), np.uint64, len(new))])
        h, n = self.hash[which], len(found) - self.k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        out = np.zeros(n, np.uint64)
        for j in range(self.k):
            out = (out ^ h[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.view(np.int64)


def templates(k: int, phrases: dict[str, str], notices: list[tuple[str, str]]) -> tuple[list[tuple[str, list[bytes], bool]], list[tuple[int, int, int]]]:
    """(label, words, word for word) of each template, and (hash, template, position) of each k-gram."""
    listed = [(label, words(p), True) for p, label in phrases.items()] + [(label, words(t), False) for label, t in notices]
    hasher = Hasher(k)
    return listed, [(int(h), t, j) for t, (_, w, _) in enumerate(listed) for j, h in enumerate(hasher.grams(w).tolist())]


def gram_rows(docs: DataFrame, k: int) -> DataFrame:
    """``(doc_id, th, grams)``: th is the text's hash."""
    kept: dict[str, Hasher] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = kept.setdefault("h", Hasher(k))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [words(t.as_py()) for t in part.column(2)]
                grams = [hasher.grams(w) for w in found]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, grams)]).astype(np.int32)), pa.array(np.concatenate(grams)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["doc_id", "th", "grams"])

    return docs.select("doc_id", "th", "text").mapInArrow(tidy(run), "doc_id long, th long, grams array<long>")


def candidates(grams: DataFrame, table: list[tuple[int, int, int]], listed: list[tuple[str, list[bytes], bool]], k: int) -> DataFrame:
    """``(doc_id, th, template, first, last)``: spans by votes. Phrases need all their votes on one diagonal; of a
    notice's diagonals, neighbours within a tenth of its words merge."""
    spark = grams.sparkSession
    index = F.broadcast(spark.createDataFrame(table, "gram long, template int, j int"))  # a few hundred rows at any corpus size
    hits = grams.select("doc_id", "th", F.posexplode("grams").alias("i", "gram")).join(index, "gram")
    size = F.broadcast(spark.createDataFrame([(t, len(w), exact) for t, (_, w, exact) in enumerate(listed)], "template int, m int, exact boolean"))
    # rows that are wholly alike have the same hits: each counts once
    votes = hits.groupBy("doc_id", "th", "template", (F.col("i") - F.col("j")).alias("diagonal")).agg(F.countDistinct("j").alias("votes"), F.min("j").alias("low"), F.max("j").alias("high"))
    votes = materialise(votes, "votes").join(size, "template")
    exact = votes.where(f"exact AND votes = m - {k} + 1").select("doc_id", "th", "template", F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("m") - 1).alias("last"))
    slack = F.greatest(F.lit(1), (F.col("m") / 10).cast("int"))
    merged = votes.where("NOT exact").withColumn("lane", F.explode(F.array(F.floor(F.col("diagonal") / (2 * slack)), F.floor((F.col("diagonal") + slack) / (2 * slack)) + F.lit(1 << 40))))
    spans = merged.groupBy("doc_id", "th", "template", "lane", "m").agg(F.sum("votes").alias("votes"), F.min(F.col("diagonal") + F.col("low")).alias("first"), F.max(F.col("diagonal") + F.col("high")).alias("last"))
    spans = spans.where((F.col("votes") >= F.col("m") * (2 * COVER - 1)) & (F.col("votes") >= F.least(F.lit(ROW), F.col("m") - k + 1)))
    near = spans.select("doc_id", "th", "template", F.col("first").cast("int").alias("first"), (F.col("last") + k - 1).cast("int").alias("last")).distinct()
    return exact.select("doc_id", "th", "template", F.col("first").cast("int"), F.col("last").cast("int")).unionByName(near)


def matched(template: list[bytes], found: list[bytes]) -> int:
    """Longest common subsequence of words: two texts of a template's size."""
    row = np.zeros(len(found) + 1, np.int64)
    for w in template:
        same = np.array([w == f for f in found])
        step = np.where(same, row[:-1] + 1, row[1:])
        row = np.concatenate([[0], np.maximum.accumulate(step)])
    return int(row[-1])


def verify(docs: DataFrame, spans: DataFrame, listed: list[tuple[str, list[bytes], bool]]) -> DataFrame:
    """Every row of ``docs(doc_id, th, text)`` with its words counted and its spans held against them."""
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                w = words(text.as_py())
                places, base, labels, best = set(), set(), set(), 0.0
                for s in found or []:
                    label, template, exact = listed[s["template"]]
                    a = max(0, s["first"])
                    if exact:
                        if w[a : a + len(template)] == template:
                            places.add((a, s["template"]))
                            base.add(label)
                            best = 1.0
                    else:
                        share = matched(template, w[a : min(s["last"] + 1, a + 2 * len(template))]) / len(template)
                        if share >= COVER:
                            labels.add(label)
                            best = max(best, share)
                at = sorted(p for p, _ in places)
                rows.append((doc_id, len(w), len(places), at[0] if at else None, at[-1] if at else None, ",".join(sorted(base)), ",".join(sorted(base | labels)), best))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [()] * 8, kinds, strict=True)], names=names)

    of = materialise(spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("template", "first", "last")).alias("found")), "spans")
    # few texts have spans: they go to the texts where their size allows it, else both are shuffled
    size = of.agg(F.sum(F.lit(64) + F.size("found") * 32)).first()[0] or 0
    right = F.broadcast(of) if size <= BROADCAST_BYTES else of
    met = docs.alias("d").join(right.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.th") == F.col("s.th")), "left")
    return met.select("d.doc_id", "d.text", "s.found").mapInArrow(tidy(run), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: list[tuple[str, str]] = TEMPLATES, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for each row."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    listed, table = templates(k, phrases, notices)
    if any(len(w) < k for _, w, _ in listed):
        raise ValueError(f"a template has under {k} words")
    spans = materialise(candidates(gram_rows(docs, k), table, listed, k), "candidates")
    return verify(docs, spans, listed)
