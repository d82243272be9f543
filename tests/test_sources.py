"""Readers, writers and extractors."""

import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from sievework.sources import extract as X
from sievework.sources import readers as R
from sievework.sources import writers as W
from sievework.streaming.incremental import process_new_files


def test_partitions():
    files = [("a", 5), ("b", 1), ("c", 3), ("d", 9)]
    assert R.partition_files(files, 2) == [["a", "b"], ["c", "d"]]
    assert R.partition_files(files, blocksize=6) == [["b", "c"], ["a"], ["d"]]
    assert R.partition_files(files, limit=1) == [["a"]]
    with pytest.raises(ValueError):
        R.partition_files(files, 2, 5)


def test_jsonl_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "é\n\"x\"", None), (2, None, 3)], "id long, text string, n int")
    for mode in ("ignore", "overwrite"):
        W.write_jsonl(df, f"file://{tmp_path}/j", ["id", "text"], mode)
    back = R.read_jsonl(spark, f"file://{tmp_path}/j", ["text", "id", "missing"])
    assert sorted(tuple(r) for r in back.select("id", "text").collect()) == [(1, 'é\n"x"'), (2, None)]
    W.write_parquet(df, f"file://{tmp_path}/p")
    W.write_parquet(df, f"file://{tmp_path}/p")
    assert R.read_parquet(spark, f"file://{tmp_path}/p", ["id"]).count() == 4
    assert len(R.list_files(spark, f"file://{tmp_path}/p", [".parquet"])) >= 2
    with pytest.raises(ValueError):
        R.read_parquet(spark, f"file://{tmp_path}/p", ["none"])
    W.write_parquet(df.limit(0), f"file://{tmp_path}/empty")
    with pytest.raises(ValueError):
        R.read_parquet(spark, f"file://{tmp_path}/empty", allow_empty=False)
    with pytest.raises(ValueError):
        W.write_parquet(df, f"file://{tmp_path}/p", mode="other")


def test_token_pairs(spark, tmp_path):
    df = spark.createDataFrame([("a bb",), ("",), (None,)], "text string").coalesce(1)
    encode = lambda texts: [[len(w) for w in t.split()] for t in texts]
    for vocabulary in (100, 100_000):
        [(name, n)] = W.write_token_pairs(df, f"file://{tmp_path}/{vocabulary}", encode, vocabulary, end_id=9)
        at = tmp_path / str(vocabulary)
        docs = W.read_token_pair((at / f"{name}.bin").read_bytes(), (at / f"{name}.idx").read_bytes())
        assert n == 3 and [d.tolist() for d in docs] == [[1, 2, 9], [9], [9]]


def test_webdataset(spark, tmp_path):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as tar:
        for name, data in (("s1.json", json.dumps({"texts": ["hi", None], "images": [None, "s1.png"], "k": 1}).encode()), ("s1.png", b"PNG"), ("s2.json", b'{"texts": "only"}')):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tar").write_bytes(raw.getvalue())
    (tmp_path / "in" / "bad.tar").write_bytes(b"not a tar" * 100)
    rows = R.read_webdataset(spark, f"file://{tmp_path}/in", materialise=True)
    got = sorted((r.sample_id, r.position, r.modality, r.text_content, bytes(r.binary_content or b"")) for r in rows.collect())
    assert got == [("s1", -1, "metadata", '{"k": 1}', b""), ("s1", 0, "text", "hi", b""), ("s1", 1, "image", None, b"PNG"), ("s2", -1, "metadata", "{}", b""), ("s2", 0, "text", "only", b"")]
    W.write_webdataset(rows, f"file://{tmp_path}/out", 2)
    again = R.read_webdataset(spark, f"file://{tmp_path}/out", materialise=True)
    assert sorted((r.sample_id, r.position, r.modality, r.text_content, bytes(r.binary_content or b"")) for r in again.collect()) == got
    bad = rows.withColumn("materialize_error", F.when(F.col("modality") == "image", "gone"))
    assert W.settle_errors(bad, "drop_sample").select("sample_id").distinct().count() == 1
    assert W.settle_errors(bad, "drop_row").count() == 4
    with pytest.raises(ValueError):
        W.settle_errors(bad, "error")


def test_warc_and_html():
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n<p>body</p>"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://x\r\nContent-Length: " + str(len(http)).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"
    other = record.replace(b"response", b"request ")
    for raw in (record + other + record, gzip.compress(record) + gzip.compress(other) + gzip.compress(record)):
        got = list(X.iterate_warc("a/f.warc", raw))
        assert [(r["url"], r["warc_id"], r["source_id"], r["content"]) for r in got] == [("http://x", "1", "f.warc", b"<p>body</p>")] * 2
    good = "This is the kind of text that one would keep, as it has so many of the words that are in all of our texts. " * 3
    page = f"<html><head><title>T</title><style>x</style></head><body><ul><li><a href=x>Home</a></li></ul><h1>News of the day</h1><p>{good}</p><div>© 2020</div></body></html>"
    assert X.main_text(page) == f"News of the day\n\n{good.strip()}"
    assert X.title(page) == "T"
    assert X.main_text("") is None and X.dense_text("<p>xx yy</p>") is None


def test_markup():
    assert X.wiki_text("'''A''' is {{t|{{u}}}} [[b|c]] and [[File:x.png|y [[z]]]].<ref>r</ref>\n== H ==\n{| t |}text [http://u l]") == "A is  c and .\n\nH\n\ntext l"
    tex = "\\newcommand{\\me}{Us}\n\\section{One}\n\\me did % no\n100\\% \n% all\n\\appendix x"
    assert X.tex_text([tex]) == "\\section{One}\nUs did \n100\\%"
    assert X.tex_text(["none"]) is None
    assert X.notebook_text('{"cells": [{"source": ["a", "b"]}, {"source": "c"}]}') == "ab\n\nc"
    assert X.weekly_snapshots("2020-52", "2021-01") == ["2020-52", "2020-53", "2021-01"]
    assert X.monthly_snapshots("2020-11", "2021-01") == ["2020-11", "2020-12", "2021-01"]


def test_incremental(spark, tmp_path):
    spark.range(3).write.parquet(f"file://{tmp_path}/in/1")
    run = lambda: process_new_files(spark, f"file://{tmp_path}/in/*", "id long", lambda d: d.where("id > 0"), f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    assert run() == 1
    spark.range(10, 12).write.parquet(f"file://{tmp_path}/in/2")
    assert run() == 1 and run() == 0
    assert sorted(r.id for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == [1, 2, 10, 11]


def test_language_is_guessed_from_the_whole_page():
    assert X.guess_language("the house and the garden of the king " * 700 + "der Hund und die Katze sind nicht in dem Haus " * 3000) == "de"


def test_token_pairs_are_read_in_batches(spark, tmp_path):
    path = f"file://{tmp_path}/pairs"
    df = spark.createDataFrame([(" ".join(str(k % 7 + j) for j in range(k % 50)),) for k in range(300)], "text string").repartition(3)
    W.write_token_pairs(df, path, lambda texts: [list(map(int, t.split())) for t in texts], 1 << 20)
    want = sorted([k % 7 + j for j in range(k % 50)] for k in range(300))
    for most in (1, 64, 1 << 20):
        assert sorted(r.ids for r in W.read_token_pairs(spark, path, most).collect()) == want
