"""Pages, pipelines, waveforms, nested paths, URL lists."""

import io
import json
import wave
import zipfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.functions import audio, paths
from sievework.plans.pipeline import Pipeline, from_yaml, step
from sievework.sources import extract, pages

PAGE = "<x_0.1><y_0.1>Title<x_0.9><y_0.2><class_Title><x_0.1><y_0.7>Body <b>text</b><x_0.9><y_0.9><class_Text><x_0.1><y_0.3><x_0.9><y_0.4><class_Picture><x_0.1><y_0.41>Fig<x_0.9><y_0.42><class_Caption>"


def test_pages(spark):
    assert [e["class"] for e in pages.page_elements(PAGE)] == ["Title", "Text", "Picture", "Caption"]
    assert [e["class"] for e in pages.place_pictures(pages.page_elements(PAGE))] == ["Title", "Picture", "Caption", "Text"]
    assert pages.page_elements("plain <i>text</i>") == [{"class": "Text", "text": "plain text", "box": None}]
    df = spark.createDataFrame([("a", [PAGE, ""]), ("b", None)], "sample_id string, pages array<string>")
    rows = pages.page_rows(df, reorder=True).collect()
    assert [(r.sample_id, r.position, r.modality) for r in rows] == [("a", -1, "metadata"), ("a", 0, "text"), ("a", 1, "image"), ("a", 2, "text"), ("a", 3, "text"), ("b", -1, "metadata")]
    assert pages.zip_member("1234567.pdf", "/d") == ("/d/1000-1999/1234.zip", "1234567.pdf")
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("x.pdf", b"PDF")
    assert pages.pdf_from_zip(raw.getvalue(), "x.pdf") == b"PDF" and pages.pdf_from_zip(raw.getvalue(), "y.pdf") is None
    assert pages.pdf_from_line('{"content": "UERG"}') == b"PDF" and pages.pdf_from_line("x") is None


def test_pipeline(spark, tmp_path):
    @step(needs=("n",))
    def keep_over(df, least=0):
        return df.where(F.col("n") > least)

    df = spark.createDataFrame([(1, "a b c"), (5, "d")], "n int, text string")
    p = Pipeline("p").then(keep_over(least=2)).then(lambda d, name: d.withColumn(name, F.lit(1)), "one")
    assert [tuple(r) for r in p.run(df).collect()] == [(5, "d", 1)] and "keep_over (needs n)" in p.describe()
    with pytest.raises(ValueError):
        p.run(df.drop("n"))
    df.write.json(f"file://{tmp_path}/in")
    text = f"""
read: {{call: sievework.sources.readers.read_jsonl, paths: "file://{tmp_path}/in"}}
steps:
  - call: sievework.operators.harness.score_filter
    rules: {{call: sievework.operators.filters.word_count, min_words: 2}}
    score_field: words
write: {{call: sievework.sources.writers.write_parquet, path: "file://{tmp_path}/out"}}
"""
    from_yaml(spark, text)()
    assert [r.words for r in spark.read.parquet(f"file://{tmp_path}/out").collect()] == [3]
    with pytest.raises(ValueError):
        from_yaml(spark, "read: {call: os.system, command: ls}")()


def test_waveforms():
    rate = 16_000
    tone = np.sin(2 * np.pi * 3000 * np.arange(rate) / rate)
    assert abs(audio.bandwidth(tone, rate) - 3000) < 700 and audio.bandwidth(np.zeros(100), rate) == 0 and audio.bandwidth(tone[:0], rate) == 0
    half = audio.resample(tone, rate, 8000)
    assert len(half) == 8000 and np.allclose(half, tone[::2], atol=1e-6)
    raw = io.BytesIO()
    with wave.open(raw, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.stack([tone, -tone], 1) * 30_000).astype("<i2").tobytes())
    x, r = audio.read_wav(raw.getvalue())
    assert x.shape == (rate, 2) and r == rate and np.abs(audio.mono(x)).max() < 1e-4


def test_paths():
    record = {"m": [{"c": "a"}, {"c": 1}, {"c": "b"}], "t": ["x", "y"], "s": "z"}
    assert (paths.extract(record, "m.*.c"), paths.extract(record, "t.*"), paths.extract(record, "s"), paths.extract(record, "q.*")) == (["a", "b"], ["x", "y"], ["z"], [])
    new = paths.replace(record, "m.*.c", ["A"])
    assert new["m"][0]["c"] == "A" and new["m"][2]["c"] == "b" and record["m"][0]["c"] == "a"
    assert paths.parse(json.dumps([1])) == [1] and paths.parse("x") is None and paths.parse("3") is None


def test_url_lists():
    status = {"jobs": {"articlesmultistreamdump": {"status": "done", "files": {"b.xml.bz2": {}, "a.xml.bz2": {}, "a-index.txt.bz2": {}}}}}
    assert extract.wiki_dump_urls("en", "20240101", status, "http://d") == ["http://d/enwiki/20240101/a.xml.bz2", "http://d/enwiki/20240101/b.xml.bz2"]
    assert extract.tar_names("2020 1 2 b.tar\n2020 1 2 a.tar\nx y") == ["a.tar", "b.tar"]
    assert extract.fresh_downloads(["http://x/a", "http://x/b"], ["a"]) == ["http://x/b"]


def test_wav_tree_and_lance(spark, tmp_path):
    from importlib.util import find_spec

    from sievework.sources.lance import read_lance
    from sievework.sources.readers import read_wav_tree

    (tmp_path / "a").mkdir()
    with wave.open(str(tmp_path / "a" / "x.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(100)
        w.writeframes(b"\0\0" * 50)
    (tmp_path / "a" / "bad.wav").write_bytes(b"no")
    assert sorted(r.duration for r in read_wav_tree(spark, f"file://{tmp_path}").collect()) == [-1.0, 0.5]
    if not find_spec("lance"):
        with pytest.raises(ImportError):
            read_lance(spark, "x", "a int")


def test_shared_folder(spark, tmp_path):
    from sievework.plans import tables

    assert {tables.qualified(spark, p) for p in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/")} == {f"file://{tmp_path}"}
    assert tables.shared_dir(spark) == tables.shared_dir(spark)
    df = tables.materialise(spark.range(3), "t")
    files = df.inputFiles()
    assert df.count() == 3 and files
    tables.forget(df)
    assert not Path(files[0].removeprefix("file://")).exists()
