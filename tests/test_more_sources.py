"""Text as shown, crawl lists, footers."""

from pyspark.sql import functions as F

from sievework.plans.tables import reach
from sievework.sources import extract, readers


def test_visible_text():
    page = "<html><head><style>x</style><title>t</title></head><body>a<br>b <i>c</i><div hidden>d</div><script>1 < 2</script><ul><li>e<li></ul>&lt;f&gt;</body>"
    assert extract.visible_text(page) == "a\nb c\nd\n* e\n<f>"
    assert extract.visible_text("") == "" and extract.visible_text("<p>unclosed") == "unclosed"


def test_crawl_lists():
    every = extract.crawl_path_lists("2020-52", "2021-02")
    assert [u.split("/")[4] for u in every] == ["CC-MAIN-2020-52", "CC-MAIN-2020-53", "CC-MAIN-2021-01", "CC-MAIN-2021-02"]
    assert extract.crawl_path_lists("2020-52", "2021-02", known=["CC-MAIN-2021-02"]) == every[-1:]


def test_manifest_of_many_pdfs(spark, tmp_path):
    """All rows, in tasks by the number of cores and not by that of PDFs alone."""
    path = str(tmp_path / "pdfs")
    spark.range(3000).selectExpr("id AS k", "array(concat('a', id), concat('b', id)) AS cc_pdf_file_names").write.json(path)
    rows = readers.read_pdf_manifest(spark, path)
    assert rows.rdd.getNumPartitions() == 32 * spark.sparkContext.defaultParallelism
    assert {r.file_name for r in rows.collect()} == {f"{c}{k}" for c in "ab" for k in range(3000)} and rows.count() == 6000
    assert readers.read_pdf_manifest(spark, path, limit=25).rdd.getNumPartitions() == 3


def rows_of_batch(texts):
    return texts.map(lambda _: len(texts))


def test_batches_of_workers_are_bounded(spark):
    """Rows of 100 KB: a worker of a registered query is sent some 4 MB at a time, not 64."""
    import pandas as pd

    reach(spark)
    rows_of_batch.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    rows = spark.range(0, 400, 1, 1).select(F.concat(F.repeat(F.lit("x"), 100_000), "id").alias("t"))
    most, n = rows.select(F.pandas_udf(rows_of_batch, "long")("t").alias("n")).agg(F.max("n"), F.count("n")).first()
    assert most <= 50 and n == 400
