"""Modifiers and row-shape operators."""

import pytest
from pyspark.sql import functions as F

from sievework.operators import modifiers as M
from sievework.operators import shape


def apply(spark, step, texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(step(F.col("text"))).collect()]


def test_modifiers(spark):
    assert apply(spark, M.remove_boilerplate(), ["privacy policy\n\na\n\nb", "a\n\nprivacy policy\n\nb", "x Lorem Ipsum", "terms of use", None, ""]) == ["a\n\nb", "a\n\nprivacy policy\n\nb", "", "terms of use", None, ""]
    assert apply(spark, M.remove_boilerplate(False), ["privacy policy\n\na", "a"]) == ["", "a"]
    assert apply(spark, M.remove_lines(["b"]), ["a\nb\nc", "b", None]) == ["a\nc", "", None]
    assert apply(spark, M.remove_markdown, ["**a** *b* _c_ [d](e)", "**a\nb**"]) == ["a b c e", "a\nb"]
    assert apply(spark, M.normalise_newlines, ["a\n\n\n\nb\r\n\r\n\r\nc"]) == ["a\n\nb\r\n\r\nc"]
    assert apply(spark, M.remove_quotation, ['"a"', '""', '"a"\nb"', '"a\nb"', None]) == ["a", '""', '"a"\nb"', "a\nb", None]
    assert apply(spark, M.slice_text("b", "d"), ["abcde", "xyz"]) == ["bcd", ""]
    assert apply(spark, M.slice_text("b", "d", False, False), ["abcde"]) == ["c"]
    assert apply(spark, M.slice_text(-3, -1), ["abcde", "a", None]) == ["cd", "", None]
    assert apply(spark, M.remove_urls, ["a HTTP://x.y b www.z c"]) == ["a  b  c"]
    assert apply(spark, M.label_line("__label__hq"), ["a\n__label__b"]) == ["__label__hq a  b"]
    assert apply(spark, M.reformat_unicode(), ["voilÃ  &amp; e\u0301"])[0].endswith("& é")


def test_split_and_join(spark):
    df = spark.createDataFrame([(1, "a|b|c", 7), (2, "", 8), (3, None, 9)], "id int, text string, segment_id int")
    parts = shape.split_documents(df, "|")
    assert sorted(tuple(r) for r in parts.collect()) == [(1, "a", 0), (1, "b", 1), (1, "c", 2), (2, "", 0)]
    joined = shape.join_documents(parts, "|")
    assert sorted(tuple(r) for r in joined.collect()) == [(1, "a|b|c"), (2, "")]
    assert shape.split_documents(spark.createDataFrame([("a.b",)], "text string"), ".").count() == 2


def test_join_with_a_length(spark):
    rows = [(1, i, "abc", 3) for i in range(5)] + [(2, 0, "long" * 5, 20), (None, 0, "x", 1)]
    df = spark.createDataFrame(rows, "id int, segment_id int, text string, length int")
    got = shape.join_documents(df, "-", drop_segment_id_field=False, max_length=8, length_field="length")
    assert sorted((r.id, r.segment_id, r.text, r.length) for r in got.collect()) == [(1, 0, "abc-abc", 7), (1, 1, "abc-abc", 7), (1, 2, "abc", 3), (2, 0, "long" * 5, 20)]
    with pytest.raises(ValueError):
        shape.join_documents(df, max_length=8)


def test_add_id(spark):
    df = spark.range(100).repartition(7).withColumnRenamed("id", "n")
    got = shape.add_id(df, "id", "doc", order_by=["n"]).collect()
    assert all(r.id == f"doc_{r.n}" for r in got)
    assert shape.add_id(df, "id").select("id").distinct().count() == 100
    with pytest.raises(ValueError):
        shape.add_id(df, "n")


def test_chunks(spark):
    df = spark.createDataFrame([("u", "a b\n\nc d\n\ne f g h i", 1), ("v", "", 2)], "url string, text string, n_tokens int")
    count = lambda texts: [len(t.split()) for t in texts]
    got = shape.split_by_tokens(df, count, 4).collect()
    assert [(r.url, r.text, r.chunk_id, r.n_tokens) for r in got] == [("u", "a b\n\nc d", 0, 4), ("u", "e f g h i", 1, 5), ("v", "", 0, 0)]
    chunks = spark.createDataFrame([("u", 1, "B", "b", 2), ("u", 0, "A", "a", 1), ("u", 0, "Z", "z", 9), ("u", 2, "none", "n", 1), ("w", 0, None, "q", 1)], "url string, chunk_id int, cleaned_text string, text string, n int")
    merged = shape.merge_chunks(chunks, ["url"], no_content=["none"], sum_columns=["n"]).collect()
    assert [(r.url, r.cleaned_text, r.text, r.n) for r in merged] == [("u", "A\nB", "a\nb", 3)]
    assert apply(spark, lambda t: shape.center_crop(t, 3), ["abcdefg", "ab"]) == ["cde", "ab"]


def test_ids_in_order_have_no_gaps(spark):
    """Ranges come from a sample: they have to be made once."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 200_000, 1, 16).select(F.xxhash64("id").alias("n"))
        got = shape.add_id(df, "id", order_by=["n"]).orderBy("n").select("id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.id for r in got] == list(range(200_000))
