"""Queries of readers and writers, row shape, interleaved rows, segments, model adapters and translation, with SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.operators import dedup, filters, harness, interleaved, media, models, segments, shape, translation
from sievework.plans.filter_queries import WORDS
from sievework.plans.pipeline import Pipeline
from sievework.plans.tables import fresh_path, table
from sievework.sources import extract, readers, writers

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name, with its SQL."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


# readers and writers


@query("SELECT o_orderkey, o_totalprice, o_orderstatus = 'F' AS skip FROM orders WHERE o_orderstatus <> 'F'")
def manifest_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "manifest")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("skip"))
    writers.write_manifest(rows, path, skip_field="skip")
    return readers.read_manifest(spark, path).select("o_orderkey", "o_totalprice", "skip")


@query("SELECT p_partkey, p_size FROM part WHERE p_size > 20")
def valid_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "valid")
    writers.write_valid_samples(table(spark, sf_dir, "part").select("p_partkey", "p_size", (F.col("p_size") > 20).alias("is_valid")), path)
    return readers.read_jsonl(spark, path, ["p_partkey", "p_size"], schema="p_partkey long, p_size int, is_valid boolean")


@query("SELECT n_nationkey::VARCHAR AS key, n_name AS name FROM nation")
def tsv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tsv")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.option("sep", "\t").csv(path)
    return readers.read_tsv(spark, path, ["key", "name"])


_TURNS = "SELECT conv_id::VARCHAR AS sample_id, turn::INTEGER AS position, text AS text_content FROM conversations"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return readers.align_interleaved(turns.select(F.col("conv_id").cast("string").alias("sample_id"), F.col("turn").cast("int").alias("position"), F.lit("text").alias("modality"), F.col("text").alias("text_content")))


@query(f"SELECT sample_id, position, md5(text_content) AS md5 FROM ({_TURNS})")
def interleaved_parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "interleaved")
    writers.write_interleaved_parquet(_texts(spark, sf_dir), path)
    return readers.read_interleaved_parquet(spark, path, ["sample_id", "position", "text_content"]).select("sample_id", "position", F.md5("text_content").alias("md5"))


_BROKEN = "t AS (SELECT sample_id, position, text_content, length(text_content) % 7 = 0 AS bad FROM (" + _TURNS + "))"


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).withColumn("materialize_error", F.when(F.length("text_content") % 7 == 0, "gone"))


@query(f"WITH {_BROKEN} SELECT sample_id, position FROM t WHERE NOT bad")
def unreadable_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.settle_errors(_broken(spark, sf_dir), "drop_row").select("sample_id", "position")


@query(f"WITH {_BROKEN} SELECT sample_id, position FROM t WHERE sample_id NOT IN (SELECT sample_id FROM t WHERE bad)")
def unreadable_samples_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.settle_errors(_broken(spark, sf_dir), "drop_sample").select("sample_id", "position")


@query("SELECT p_partkey::VARCHAR AS image_id, md5(p_name) AS md5 FROM part")
def image_tars(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "images")
    writers.write_images(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("image_id"), F.encode("p_name", "UTF-8").alias("image_data"), "p_size"), path, per_tar=100)
    return readers.read_images(spark, f"{path}/*.tar").select("image_id", F.md5("image_data").alias("md5"))


@query("SELECT 'clip' || s_suppkey || '.mp4' AS name, octet_length(encode(s_name))::BIGINT AS length FROM supplier")
def clip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "clips")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("clip"), "s_suppkey").alias("clip_id"), F.encode("s_name", "UTF-8").alias("content"), "s_acctbal")
    writers.write_clips(rows, path)
    return readers.read_videos(spark, f"{path}/clips").select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def _json_lines(path: str, content: bytes):
    for line in content.decode().splitlines():
        yield json.loads(line)


def _long_orders(record: dict) -> dict | None:
    return {"key": record["o_orderkey"], "status": record["o_orderstatus"].lower()} if record["o_orderkey"] % 3 else None


@query("SELECT o_orderkey AS key, lower(o_orderstatus) AS status FROM orders WHERE o_orderkey % 3 <> 0")
def iterated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "records")
    writers.write_jsonl(table(spark, sf_dir, "orders"), path, ["o_orderkey", "o_orderstatus"])
    return readers.read_records(spark, path, _json_lines, "key long, status string", _long_orders, file_name_column=None)


@query("SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 5")
def rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.limit_per_file(table(spark, sf_dir, "events").select("event_type", "event_id"), 5, "event_type", "event_id")


@query("SELECT n_name AS file, ((row_number() OVER (ORDER BY n_name) - 1) // 4)::INTEGER AS part FROM nation")
def file_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = sorted((r.n_name, r.n_nationkey) for r in table(spark, sf_dir, "nation").collect())  # 25 rows
    groups = readers.partition_files(files, files_per_partition=4)
    return spark.createDataFrame([(f, i) for i, g in enumerate(groups) for f in g], "file string, part int")


@query("SELECT p_partkey, '/audio/' || p_name AS audio_filepath FROM part")
def audio_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("a/b/"), "p_name").alias("audio_filepath"))
    return readers.resolve_audio_path(rows, "/audio/")


@query("SELECT 'f' || unnest([o_orderkey, o_orderkey + 1]) AS file_name, o_custkey FROM orders WHERE o_orderkey % 5 = 0")
def pdf_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "pdfs")
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 5 = 0")
    name = lambda n: F.concat(F.lit("f"), (F.col("o_orderkey") + n).cast("string"))
    writers.write_jsonl(rows.select("o_custkey", F.array(name(0), name(1)).alias("cc_pdf_file_names")), path)
    return readers.read_pdf_manifest(spark, path).select("file_name", "o_custkey")


@query("SELECT 'http://d/enwiki/20240101/p' || n_nationkey || '.xml.bz2' AS url FROM nation")
def dump_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"p{r.n_nationkey}.xml.bz2" for r in table(spark, sf_dir, "nation").collect()]  # 25 rows
    status = {"jobs": {"articlesmultistreamdump": {"status": "done", "files": {n: {} for n in [*names, "p-index.txt.bz2"]}}}}
    return spark.createDataFrame([(u,) for u in extract.wiki_dump_urls("en", "20240101", status, "http://d")], "url string")


@query(f"SELECT doc_id, len({WORDS})::BIGINT AS n, md5(array_to_string(list_transform({WORDS}, lambda w: length(w)), ',')) AS md5 FROM documents")
def token_pair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files and their indexes read back: a word's id is its length, the first id of a text its own."""
    path = fresh_path(spark, "token_pair_ids")
    docs = table(spark, sf_dir, "documents")
    numbered = docs.select(F.concat("doc_id", F.lit("\n"), "text").alias("text"))
    encode = lambda texts: [[int(t.partition("\n")[0]), *map(len, t.partition("\n")[2].split())] for t in texts]
    writers.write_token_pairs(numbered, path, encode, 1 << 20)
    back = writers.read_token_pairs(spark, path)
    rest = F.slice("ids", F.lit(2), F.size("ids") - 1)
    return back.select(F.col("ids")[0].alias("doc_id"), F.size(rest).cast("long").alias("n"), F.md5(F.array_join(rest.cast("array<string>"), ",")).alias("md5"))


@query("SELECT p_partkey::VARCHAR AS image_id, p_name || '.png' AS image_path, md5(p_type) AS md5, p_size FROM part")
def image_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "image_dataset")
    image = F.struct(F.encode("p_type", "UTF-8").alias("bytes"), F.concat("p_name", F.lit(".png")).alias("path"))
    writers.write_parquet(table(spark, sf_dir, "part").select("p_partkey", "p_size", image.alias("image")), path)
    return readers.read_image_dataset(spark, path, id_field="p_partkey").select("image_id", "image_path", F.md5("image_data").alias("md5"), "p_size")


@query("SELECT count(*)::BIGINT AS rows FROM orders")
def rows_by_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "footers")
    writers.write_parquet(table(spark, sf_dir, "orders").select("o_orderkey"), path)
    return readers.parquet_info(spark, path).agg(F.sum("rows").alias("rows"))


@query("SELECT n_name AS title, n_nationkey::BIGINT AS id, 'https://de.wikipedia.org/wiki/' || replace(n_name, ' ', '_') AS url, 'About ' || n_name || '.' AS text FROM nation WHERE n_regionkey <> 0")
def wiki_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "wiki")
    page = F.concat(F.lit("<page><title>"), "n_name", F.lit("</title><ns>"), F.when(F.col("n_regionkey") == 0, "1").otherwise("0"), F.lit("</ns><id>"), "n_nationkey", F.lit("</id><revision><text bytes=\"9\">About [["), "n_name", F.lit("|"), "n_name", F.lit("]].{{note}}</text></revision></page>"))
    dump = F.concat(F.lit("<mediawiki>"), F.array_join(F.collect_list(page), "\n"), F.lit("</mediawiki>"))
    table(spark, sf_dir, "nation").agg(dump.alias("value")).write.text(path)  # 25 pages
    dump = extract.read_wiki_dump(spark, path, "de")
    return dump.withColumn("text", segments.fold(extract.wiki_text, "string")("text"))


@query("SELECT p_partkey, p_name || chr(10) || '* ' || p_type || chr(10) || '* a & b' AS text FROM part")
def text_as_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(F.lit("<html><head><title>no</title></head><body><h1> "), "p_name", F.lit("</h1><script>x</script><ul><li>"), "p_type", F.lit("<li>a &amp;\n b</ul></body></html>"))
    return table(spark, sf_dir, "part").select("p_partkey", extract.shown_text(html).alias("text"))


@query("SELECT 'https://data.commoncrawl.org/crawl-data/CC-MAIN-2021-' || lpad((4 + 6 * n_nationkey)::VARCHAR, 2, '0') || '/warc.paths.gz' AS url FROM nation WHERE 4 + 6 * n_nationkey <= 46")
def crawl_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = [f"CC-MAIN-2021-{4 + 6 * r.n_nationkey:02d}" for r in table(spark, sf_dir, "nation").collect()]  # 25 rows
    return extract.urls_frame(spark, extract.crawl_path_lists("2021-01", "2021-50", known=known))


@query("SELECT CASE WHEN n_nationkey % 5 = 0 THEN 'ValueError: bad' END AS error, count(*)::BIGINT AS n FROM nation GROUP BY 1")
def failures_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each nation, every fifth of which can't be read."""
    path = fresh_path(spark, "failing")
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("value"), F.col("n_nationkey").alias("k")).write.partitionBy("k").text(path)

    def read(at: str, content: bytes):
        if int(content) % 5 == 0:
            raise ValueError("bad")
        yield {"value": content.decode().strip()}

    got = readers.read_records(spark, f"{path}/*", read, "value string", file_name_column=None, error_column="error")
    return got.groupBy("error").agg(F.count("*").alias("n"))


# pipelines, row shape, duplicates


@query(f"SELECT doc_id, upper(lang) AS lang FROM documents WHERE len({WORDS}) BETWEEN 50 AND 100000")
def pipeline_of_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = Pipeline("words").then(harness.score_filter, filters.word_count(), score_field="n").then(harness.modify, F.upper, "lang")
    return steps.run(table(spark, sf_dir, "documents")).select("doc_id", "lang")


@query("SELECT doc_id, (row_number() OVER (ORDER BY n_chars, doc_id) - 1)::BIGINT AS place FROM documents")
def sorted_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars").repartition(1).sortWithinPartitions("doc_id")
    return shape.sort_by_length(docs, "n_chars").select("doc_id", F.monotonically_increasing_id().alias("place"))


@query("SELECT user_id, count(*)::BIGINT AS rows, 1::BIGINT AS partitions FROM events GROUP BY user_id")
def shuffled_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shape.shuffle_on(table(spark, sf_dir, "events").select("user_id"), ["user_id"], 7)
    return dealt.select("user_id", F.spark_partition_id().alias("p")).groupBy("user_id").agg(F.count("*").alias("rows"), F.countDistinct("p").alias("partitions"))


@query('SELECT user_id, event_id AS "left", "right" FROM (SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS "right" FROM events) WHERE "right" IS NOT NULL')
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.consecutive_pairs(table(spark, sf_dir, "events"), "user_id", "event_id", "event_id")


@query("SELECT DISTINCT id_x, id_y FROM (SELECT o_orderkey AS id_x, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS id_y FROM orders) WHERE id_y IS NOT NULL")
def bucket_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias(dedup.BUCKET), F.col("o_orderkey").alias(dedup.ID))
    return dedup.bucket_edges(keys.groupBy(dedup.BUCKET).agg(F.sort_array(F.collect_set(dedup.ID)).alias(dedup.ID)))


@query("SELECT DISTINCT o_orderkey AS a, b FROM (SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS b FROM orders) WHERE o_orderkey <> b")
def bucket_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.star_edges(table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias(dedup.BUCKET), F.col("o_orderkey").alias(dedup.ID)))


@query("SELECT o_orderkey AS id FROM (SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS b FROM orders) WHERE o_orderkey <> b")
def group_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.group_duplicates(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(dedup.ID), F.col("o_custkey").alias(dedup.GROUP)))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def ids_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.remove_ids(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 0"), "doc_id", "doc_id").select("doc_id", "n_chars")


@query("SELECT event_type, count(*)::BIGINT AS n, (sum(count(*)) OVER (ORDER BY event_type) - count(*))::BIGINT AS low, (sum(count(*)) OVER (ORDER BY event_type) - 1)::BIGINT AS high FROM events GROUP BY event_type")
def ids_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a file's rows are one range, files in order of their names."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    given = dedup.add_range_ids(events, dedup.id_ranges(events, "event_type", ["event_id"]), "event_type", ["event_id"], "id")
    return given.groupBy("event_type").agg(F.countDistinct("id").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))


# interleaved rows


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as PNG headers, their size as width and 20 as height, two to a sample."""
    width = F.unhex(F.lpad(F.hex("p_size"), 8, "0"))
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), width, F.unhex(F.lit("00000014")), F.unhex(F.lit("0000000000000000")))
    rows = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 2).cast("string").alias("sample_id"), (F.col("p_partkey") % 2).cast("int").alias("position"), F.lit("image").alias("modality"), png.alias("binary_content"), "p_partkey", "p_size", "p_retailprice")
    return readers.align_interleaved(rows)


@query("SELECT p_partkey FROM part WHERE p_size / 20 BETWEEN 1 AND 2")
def images_by_aspect_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved.aspect_ratio(_images(spark, sf_dir)).select("p_partkey")


def _columns_of_size(raw: bytes):
    """Stand-in decoder: grey columns, every p_size-th of which is bright."""
    import numpy as np

    x = np.zeros((8, 60))
    x[:, :: raw[19]] = 255
    return x


@query("SELECT p_partkey FROM part WHERE p_size BETWEEN 2 AND 20")
def images_by_sharpness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved.blur(_images(spark, sf_dir).where("p_size BETWEEN 1 AND 20"), _columns_of_size, 1000.0).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_size < 25")
def images_without_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved.qr_code(_images(spark, sf_dir), lambda raw: raw[19] / 100, 0.25).select("p_partkey")


@query("""WITH e AS (SELECT vec_id, vec_id // 4 AS s, vec_id % 4 AS p, embedding::DOUBLE[] AS e FROM embeddings),
b AS (SELECT i.vec_id, max(list_dot_product(i.e, t.e)) AS best FROM e i JOIN e t USING (s) WHERE i.p >= 2 AND t.p < 2 GROUP BY i.vec_id)
SELECT vec_id FROM e WHERE p < 2 OR vec_id IN (SELECT vec_id FROM b WHERE best >= 0.1)""")
def images_like_their_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = (F.col("vec_id") % 4).cast("int")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 4).cast("string").alias("sample_id"), place.alias("position"), F.when(place < 2, "text").otherwise("image").alias("modality"), "embedding")
    return interleaved.image_text_similarity(rows, "embedding", "embedding", 0.1).select("vec_id")


@query("SELECT p_partkey, md5(repeat('x', p_size)) AS md5 FROM part")
def images_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.to_json(F.struct(F.lit("p").alias("path"), F.lit(0).alias("byte_offset"), F.col("p_size").alias("byte_size")))
    rows = _images(spark, sf_dir).withColumn("source_ref", ref).withColumn("binary_content", F.lit(None).cast("binary"))
    return interleaved.materialise(rows, lambda path, member, offset, size: b"x" * size).select("p_partkey", F.md5("binary_content").alias("md5"))


# audio and video rows


@query("""WITH s AS (SELECT user_id, event_id, (floor(epoch(ts))::BIGINT % 86400)::DOUBLE AS a, (floor(epoch(ts))::BIGINT % 86400 + event_id % 600 + 1)::DOUBLE AS b FROM events),
h AS (SELECT user_id, event_id, unnest(generate_series(0, 23)) AS h, a, b FROM s),
o AS (SELECT user_id, event_id, h, least(b, 3600.0 * (h + 1)) - greatest(a, 3600.0 * h) AS o FROM h)
SELECT user_id, h::INTEGER AS hour, count(*)::BIGINT AS n FROM (SELECT * FROM o WHERE o > 0 QUALIFY row_number() OVER (PARTITION BY user_id, event_id ORDER BY o DESC, h) = 1) GROUP BY ALL""")
def words_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as words, the hours of the day as segments: each word is in the hour that has most of it."""
    at = F.unix_seconds(F.col("ts").cast("timestamp")) % 86400
    word = F.struct(at.cast("double").alias("start"), (at + F.pmod(F.col("event_id"), F.lit(600)) + 1).cast("double").alias("end"), F.col("event_type").alias("word"))
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.struct((h * 3600.0).alias("start"), (h * 3600.0 + 3600.0).alias("end"), h.alias("hour")))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(word).alias("alignment")).withColumn("segments", hours)
    out = segments.merge_alignment(rows, id_field="user_id").select("user_id", F.explode("segments").alias("s"))
    return out.select("user_id", "s.hour", F.size("s.words").cast("long").alias("n")).where("n > 0")


@query("SELECT o_custkey, string_agg(o_orderstatus, ' ' ORDER BY o_orderkey) AS text, sum(o_totalprice + (o_orderkey % 100) * 10.0)::DECIMAL(30, 2)::DOUBLE AS total FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey")
def split_recordings_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.struct(F.col("o_totalprice").alias("start"), F.col("o_totalprice").alias("end"), F.col("o_orderstatus").alias("word"))
    part = F.struct("o_orderkey", F.col("o_orderstatus").alias("text"), F.array(word).alias("alignment"))
    rows = table(spark, sf_dir, "orders").where("o_custkey IS NOT NULL").groupBy("o_custkey").agg(F.array_sort(F.collect_list(part)).alias("split_metadata"))
    rows = rows.withColumn("split_offsets", F.transform("split_metadata", lambda s: (s["o_orderkey"] % 100) * F.lit(10.0)))
    joined = segments.join_splits(rows)
    total = F.aggregate("alignment", F.lit(0).cast("decimal(30,2)"), lambda t, w: (t + w["start"].cast("decimal(20,2)")).cast("decimal(30,2)"))
    return joined.select("o_custkey", "text", total.cast("double").alias("total"))


@query("SELECT p_partkey, CASE WHEN p_size < 30 THEN 'a' ELSE 'b' END AS original_file, (CASE WHEN p_size < 30 THEN p_size + 5 ELSE p_size - 30 END * 1000)::BIGINT AS original_start_ms, (CASE WHEN p_size < 30 THEN least(p_size + 3, 30) + 5 ELSE p_size + 3 - 30 END * 1000)::BIGINT AS original_end_ms FROM part")
def mapped_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in a joined recording of 30 s of one file, from 5 s on, and 100 s of another."""
    parts = [(0.0, 30.0, "a", 5.0), (30.0, 100.0, "b", 0.0)]
    mapping = F.array(*[F.struct(F.lit(o).alias("offset"), F.lit(d).alias("duration"), F.lit(f).alias("source_file"), F.lit(s).alias("source_start")) for o, d, f, s in parts])
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("start"), (F.col("p_size") + 3).cast("double").alias("end"), mapping.alias("mapping"))
    return segments.map_timestamps(rows, "start", "end", "mapping").select("p_partkey", "original_file", "original_start_ms", "original_end_ms")


@query("SELECT l_orderkey, (sum(l_quantity + 0.5) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity ROWS UNBOUNDED PRECEDING) - l_quantity - 0.5)::DOUBLE AS at FROM lineitem")
def offsets_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("l"))
    return lines.select("l_orderkey", F.explode(segments.concatenation_offsets(F.transform("l", lambda x: x["l_quantity"]))).alias("at"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_brand WHEN p_size % 2 <> 0 THEN p_type END AS best_prediction, CASE WHEN p_size % 3 <> 0 THEN 'p_brand' WHEN p_size % 2 <> 0 THEN 'p_type' END AS best_prediction_source FROM part")
def best_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("p_brand"), F.when(F.col("p_size") % 2 != 0, F.col("p_type")).otherwise(" ").alias("p_type"))
    return segments.best_prediction(rows, "p_brand", "p_type").select("p_partkey", "best_prediction", "best_prediction_source")


@query("SELECT conv_id, turn, md5(trim(regexp_replace(regexp_replace(text, '([0-9])[0-9]+', '\\1#', 'g'), '[ \\t\\n\\r]+', ' ', 'g'))) AS md5 FROM conversations")
def substituted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(segments.substitute([("([0-9])[0-9]+", "$1#")])(F.col("text"))).alias("md5"))


@query("""WITH r AS (SELECT p_partkey, p_brand, p_type, round(100.0 * levenshtein(p_type, p_brand) / greatest(length(p_brand), 1), 4)::DOUBLE AS w FROM part)
SELECT p_partkey, w AS disfluency_wer, CASE WHEN w > 150 THEN p_brand ELSE p_type END AS p_type FROM r""")
def disfluency_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", F.lit("zh").alias("lang"))
    return segments.guard_disfluency(rows, "p_brand", "p_type", most=150.0, language="lang").select("p_partkey", "disfluency_wer", "p_type")


@query(f"""WITH w AS (SELECT conv_id, turn, {WORDS} AS w FROM conversations),
g AS (SELECT conv_id, turn, unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w),
b AS (SELECT DISTINCT conv_id, turn FROM (SELECT conv_id, turn, g, count(*) AS n FROM g GROUP BY ALL) WHERE n > 1)
SELECT conv_id, turn FROM w WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM b)""")
def repetitions_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.drop_repetitions(table(spark, sf_dir, "conversations"), "text", n=2, most=1).select("conv_id", "turn")


@query("SELECT o_custkey, count(*)::BIGINT AS rows, sum(o_orderkey)::BIGINT AS o_orderkey FROM orders GROUP BY o_custkey")
def totals_by_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.totals(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey"])


@query("SELECT user_id, count(*)::BIGINT AS n FROM events WHERE event_type <> 'click' GROUP BY user_id")
def segments_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_type") != "click", F.col("event_type")).otherwise("  ")
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(F.struct(text.alias("text"))).alias("segments"))
    return rows.select("user_id", F.size(segments.without_empty(F.col("segments"))).cast("long").alias("n")).where("n > 0")


def _talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' events, five seconds each, as segments of a long recording."""
    word = F.struct("event_id", F.col("event_type").alias("speaker"), F.col("event_type").alias("text"), F.struct(F.when(F.col("event_id") % 20 == 0, 4000).otherwise(9000).alias("bandwidth")).alias("metrics"))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(word)).alias("w"))
    timed = F.transform("w", lambda x, i: x.withField("start", i * 5.0).withField("end", i * 5.0 + 4.5))
    return rows.select("user_id", F.lit(16000).alias("audio_sample_rate"), timed.alias("segments"))


_WINDOWS = """WITH s AS (SELECT user_id, event_id, event_type AS sp, event_id % 20 <> 0 AS wide, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
m AS (SELECT h.user_id, h.i AS head, m.i, m.sp FROM s h JOIN s m ON h.user_id = m.user_id AND m.i BETWEEN h.i AND h.i + 6
      WHERE NOT EXISTS (SELECT 1 FROM s n WHERE n.user_id = h.user_id AND n.i BETWEEN h.i AND m.i AND NOT n.wide)),
f AS (SELECT m.*, row_number() OVER (PARTITION BY user_id, head, sp ORDER BY i) = 1 AS fresh FROM m),
c AS (SELECT f.*, sum(fresh::INTEGER) OVER (PARTITION BY user_id, head ORDER BY i) AS heard FROM f),
w AS (SELECT user_id, head, count(*) AS n, max(heard) AS heard FROM c WHERE heard <= 3 GROUP BY user_id, head)
SELECT user_id, (head * 5.0)::DOUBLE AS start, n::INTEGER AS n FROM w WHERE n BETWEEN 6 AND 7 AND heard >= 2"""


@query(_WINDOWS)
def windows_of_talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of some 30 seconds, that is six or seven segments, of two or three speakers."""
    built = segments.build_windows(_talks(spark, sf_dir), target=32.0, tolerance=0.1, speakers=(2, 3), truncate=False, id_field="user_id")
    return built.select("user_id", F.explode("windows").alias("w")).select("user_id", F.col("w.segments")[0]["start"].alias("start"), F.size("w.segments").alias("n"))


@query(None)
def windows_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order decides which of overlapping windows stay; tests hold it to cases."""
    built = segments.build_windows(_talks(spark, sf_dir), target=32.0, tolerance=0.1, speakers=(2, 3), truncate=False, id_field="user_id")
    kept = segments.filter_windows(built, share=0.5, target=32.0)
    return kept.select("user_id", F.explode("windows").alias("w")).select("user_id", F.col("w.segments")[0]["start"].alias("start"), F.size("w.segments").alias("n"))


@query("SELECT p_partkey, 'has ' || p_size || ' parts' AS text FROM part")
def spoken_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, tens = (F.array(*map(F.lit, names)) for names in (media.UNITS, media.TENS))
    size = F.col("p_size").cast("int")
    ten = F.element_at(tens, F.greatest(F.floor(size / 10).cast("int") - 1, F.lit(1)))
    spelt = F.when(size < 20, F.element_at(units, size + 1)).when(size % 10 == 0, ten).otherwise(F.concat(ten, F.lit("-"), F.element_at(units, size % 10 + 1)))
    return table(spark, sf_dir, "part").select("p_partkey", media.inverse_normalised(F.concat(F.lit("has "), spelt, F.lit(" parts"))).alias("text"))


@query("SELECT p_partkey, translate(p_type, 'AEI', 'aei') AS text FROM part")
def characters_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", media.convert_characters(F.col("p_type"), {"A": "a", "E": "e", "I": "i"}).alias("text"))


def _samples(raw: bytes):
    from sievework.functions.audio import read_wav

    return read_wav(raw)


def _recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as WAV files of p_size seconds at 100 Hz, whose every second is as loud as its number."""

    def wav(seconds: int) -> bytes:
        import numpy as np

        return media.wav_bytes(np.repeat(np.arange(1, seconds + 1), 100) / 1024, 100)

    return table(spark, sf_dir, "part").select("p_partkey", "p_size", segments.fold(wav, "binary")("p_size").alias("content"))


@query("SELECT p_partkey, p_size::DOUBLE AS duration FROM part")
def durations_of_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recorded(spark, sf_dir).select("p_partkey", segments.wav_duration(F.col("content")).alias("duration"))


@query("SELECT p_partkey, i::INTEGER AS segment_id, least(5, p_size - 5 * i)::DOUBLE AS duration, (5 * i + 1)::INTEGER AS loudness FROM part, range(0, 20) r(i) WHERE 5 * i < p_size")
def segments_cut_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform(F.sequence(F.lit(0), F.ceil(F.col("p_size") / 5).cast("int") - 1), lambda k: F.struct((k * 5.0).alias("start"), F.least(k * 5.0 + 5.0, F.col("p_size").cast("double")).alias("end")))
    rows = media.extract_segments(_recorded(spark, sf_dir).withColumn("segments", spans))
    first = segments.fold(lambda raw: round(float(_samples(raw)[0][0, 0]) * 1024), "int")
    return rows.select("p_partkey", "segment_id", segments.wav_duration(F.col("audio")).alias("duration"), first("audio").alias("loudness"))


def _hears():
    """A stand-in recogniser: a word for each second, its loudness as text."""
    import numpy as np

    def run(recordings: list[bytes]) -> list[dict]:
        out = []
        for raw in recordings:
            x, rate = _samples(raw)
            heard = [str(int(v)) for v in np.round(x[::rate, 0] * 1024)]
            out.append({"text": " ".join(heard), "language": "en", "alignment": [{"word": w, "start": float(i), "end": i + 1.0} for i, w in enumerate(heard)]})
        return out

    return run


@query("SELECT p_partkey, array_to_string(range(1, p_size + 1), ' ') AS text, p_size::INTEGER AS words, (p_size - 1)::DOUBLE AS last FROM part")
def transcripts_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut into parts of 7 s, recognised and joined."""
    joined = media.transcribe_in_parts(_recorded(spark, sf_dir), _hears, "p_partkey", longest=7.0)
    return joined.select("p_partkey", "text", F.size("alignment").alias("words"), F.element_at("alignment", -1)["start"].alias("last"))


def _takes_turns():
    return lambda recordings: [[{"start": float(10 * k), "end": 10.0 * k + 9, "speaker": "ab"[k % 2]} for k in range(3)] for _ in recordings]


@query("SELECT p_partkey, s AS speaker, CASE s WHEN 'a' THEN 2 ELSE 1 END AS spans FROM part, (VALUES ('a'), ('b')) t(s)")
def speakers_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.diarise(_recorded(spark, sf_dir), _takes_turns)
    return media.separate_speakers(found).select("p_partkey", "speaker", F.size("spans").alias("spans"))


@query("SELECT p_partkey, p_size >= 6 AS speech FROM part")
def speech_in_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second is louder than the one before; from the fourth on it is over the threshold."""
    spans = media.speech_spans(F.col("content"), threshold_db=-50.5, frame=1.0, shortest=3.0, pad=0.0)
    return _recorded(spark, sf_dir).select("p_partkey", (F.size(spans) > 0).alias("speech"))


@query("SELECT vec_id, round(1 - (1 - abs(embedding[1])::DOUBLE) * (1 - abs(embedding[3])::DOUBLE), 6)::DOUBLE AS p FROM embeddings WHERE abs(embedding[1]) <= 1")
def joint_event_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = F.array(F.transform("embedding", F.abs))
    rows = table(spark, sf_dir, "embeddings").where("abs(embedding[0]) <= 1")
    return rows.select("vec_id", F.round(media.joint_probabilities(frames, [0, 2])[0], 6).alias("p"))


@query("""SELECT p_partkey, (0.5 + i * 10.0)::DOUBLE AS start, least(p_size - 0.5, 10.5 + i * 10.0)::DOUBLE AS "end"
FROM part, range(0, 10) r(i) WHERE (p_size - 1 > 10 OR i = 0) AND 0.5 + i * 10.0 < p_size - 0.5 AND least(p_size - 0.5, 10.5 + i * 10.0) - (0.5 + i * 10.0) >= 2
UNION ALL SELECT p_partkey, (p_size + 1.5)::DOUBLE, (p_size + 5.5)::DOUBLE FROM part""")
def clips_between_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos of one frame a second: p_size quiet ones, a cut, and five more."""
    scores = F.concat(F.array_repeat(F.lit(0.1), F.col("p_size").cast("int")), F.array(F.lit(0.9)), F.array_repeat(F.lit(0.1), 5))
    spans = media.scene_clips(scores, 1.0)
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(spans).alias("s")).select("p_partkey", "s.start", "s.end")


@query('SELECT p_partkey, (i / 2.0)::DOUBLE AS time, (p_size / 2.0)::DOUBLE AS middle FROM part, range(0, 200) r(i) WHERE i < p_size * 2')
def times_of_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = F.lit(0), F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(media.frame_times(start, end)).alias("time"), media.frame_times(start, end, "middle")[0].alias("middle"))


@query('SELECT p_partkey, (4 * i)::DOUBLE AS start, CASE WHEN i + 1 = greatest(1, (p_size * 2 + 4) // 8) THEN p_size ELSE 4 * i + 4 END::DOUBLE AS "end" FROM part, range(0, 50) r(i) WHERE p_size > 0 AND i < greatest(1, (p_size * 2 + 4) // 8)')
def windows_for_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = media.caption_windows(F.lit(0), F.col("p_size"), fps=2.0, frames=8, remainder=4)
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(spans).alias("s")).select("p_partkey", "s.start", "s.end")


@query("SELECT p_partkey, md5('f0,f1,f2') AS preview, 'ends at ' || p_size AS caption FROM part")
def captions_and_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in decoder, captioner and encoder."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.encode(F.col("p_size").cast("string"), "UTF-8").alias("content"), F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0)).alias("times"))
    framed = media.extract_frames(rows, lambda raw, times: [f"f{t:.0f}".encode() for t in times])
    told = media.caption(framed, lambda: lambda items: [f"ends at {x.decode()}" for x in items])
    return media.previews(told, lambda frames: b",".join(map(bytes, frames))).select("p_partkey", F.md5("preview").alias("preview"), "caption")


@query("SELECT p_partkey, round(p_size / sqrt(p_size * p_size + 9.0), 4)::DOUBLE AS x, p_size / 7.0 AS score FROM part WHERE p_size / 7.0 >= 3")
def media_vectors_and_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.encode(F.col("p_size").cast("string"), "UTF-8").alias("content"))
    seen = media.embed_media(rows, lambda: lambda items: [[float(x), 3.0] for x in items])
    scored = media.score_media(seen, lambda: lambda items: [int(x) / 7.0 for x in items], "score")
    return models.score_limits(scored, {"score": (3.0, None)}).select("p_partkey", F.round(F.col("embeddings")[0].cast("double"), 4).alias("x"), "score")


@query("SELECT p_partkey, round(p_size / 300.0, 6)::DOUBLE AS mean FROM part WHERE p_size / 300.0 >= 0.05")
def clips_that_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two patches, each with one vector a frame of p_size pixels, of 300 lines."""
    vector = lambda x: F.struct(F.lit(0.0).alias("y"), F.lit(x).alias("x"), F.col("p_size").cast("double").alias("dy"), F.lit(0.0).alias("dx"))
    frames = F.array_repeat(F.array(vector(0.0), vector(300.0)), 3)
    rows = table(spark, sf_dir, "part").select("p_partkey", media.motion_scores(frames, F.lit(300), F.lit(512), 512 // 2).alias("motion"))
    return media.moving(rows, least_mean=0.05, least_patch=0.0).select("p_partkey", F.round("motion.mean", 6).alias("mean"))


# model adapters


@query("SELECT doc_id, least(5.0, length(text) / 2000.0)::DOUBLE AS \"fineweb-edu-score-float\", round_even(least(5.0, length(text) / 2000.0), 0)::INTEGER AS \"fineweb-edu-score-int\", CASE WHEN length(text) / 2000.0 >= 2.5 THEN 'high_quality' ELSE 'low_quality' END AS \"fineweb-edu-score-label\" FROM documents")
def educational_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda: lambda texts: [len(t) / 2000.0 for t in texts]
    return models.educational_score(table(spark, sf_dir, "documents").select("doc_id", "text"), made).drop("text")


@query("SELECT p_partkey, round(0.35 * p_size + 0.25 * (p_size % 7) + 0.15 * (p_size % 5) + 0.15 * (p_size % 3) + 0.05 * (p_size % 2) + 0.05, 5)::DOUBLE AS prompt_complexity_score FROM part")
def prompt_complexities(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("double")
    given = {"creativity_scope": size, "reasoning": size % 7, "constraint_ct": size % 5, "domain_knowledge": size % 3, "contextual_knowledge": size % 2, "number_of_few_shots": F.lit(1.0)}
    return models.prompt_complexity(table(spark, sf_dir, "part").select("p_partkey", *[v.alias(k) for k, v in given.items()])).select("p_partkey", "prompt_complexity_score")


@query("SELECT p_partkey, CASE WHEN p_size % 15 = 0 THEN 'safe' WHEN p_size % 15 <= 13 THEN 'O' || (p_size % 15) ELSE 'unknown' END AS label FROM part")
def safety_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_size") % 15
    answer = F.when(kind == 0, " Safe").otherwise(F.concat(F.lit("unsafe\nO"), kind.cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", models.safety_label(answer).alias("label"))


@query("SELECT doc_id, md5('[' || substring(text, 1, 100) || ']') AS md5 FROM documents")
def safety_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(models.safety_prompt("[{text}]", max_chars=100)).alias("md5"))


@query("SELECT event_id, value >= 50 AS poisoned FROM events")
def poisoned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", models.poisoned(F.col("value"), 50.0).alias("poisoned"))


@query("SELECT doc_id, round(length(text) / sqrt(length(text)::DOUBLE * length(text) + 1e6), 3)::DOUBLE AS x, round(1000 / sqrt(length(text)::DOUBLE * length(text) + 1e6), 3)::DOUBLE AS y FROM documents")
def embeddings_of_length_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda: lambda texts: [[float(len(t)), 1000.0] for t in texts]
    got = models.embed(table(spark, sf_dir, "documents").select("doc_id", "text"), made)
    return got.select("doc_id", *[F.round(F.col("embeddings")[i].cast("double"), 3).alias(c) for i, c in enumerate("xy")])


@query("SELECT vec_id, round((embedding[1]::DOUBLE + embedding[5]::DOUBLE) / 2, 5)::DOUBLE AS first FROM embeddings")
def pooled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.array(*[F.slice("embedding", 4 * i + 1, 4) for i in range(3)])
    pooled = models.mean_pool(tokens, F.array(F.lit(1), F.lit(1), F.lit(0)))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(pooled[0], 5).alias("first"))


@query("SELECT doc_id, 'Arts_and_Entertainment' AS domain_pred FROM documents WHERE least(length(text), 2000) < 1000")
def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda: lambda texts: [[len(t), 999.5, *[0.0] * 24] for t in texts]
    classifier = models.Classifier(made, filter_by=("Arts_and_Entertainment",), **models.DOMAIN)
    return classifier(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "domain_pred")


@query("SELECT doc_id FROM documents WHERE length(text) / 5000.0 >= 0.3 AND lang = 'en'")
def language_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda: lambda texts: [(len(t) / 5000.0, t[:2]) for t in texts]
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    # a stand-in model that reads the language from before the text
    marked = docs.withColumn("marked", F.concat("lang", F.substring("text", 3, 1 << 30)))
    return harness.score_filter(marked.where("length(text) > 2"), models.language(made, 0.3, "en"), "marked").select("doc_id")


@query("SELECT conv_id, turn, md5('Say: ' || replace(text, 'e', '3')) AS md5 FROM conversations")
def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda: lambda prompts: [p.replace("e", "3") for p in prompts]
    return models.prompt_column(table(spark, sf_dir, "conversations"), "Say: {document}", made).select("conv_id", "turn", F.md5("generated").alias("md5"))


@query("SELECT p_partkey, p_brand || chr(10) || 'x ' || p_type AS list FROM part")
def knowledge_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Facts:\n- "), "p_brand", F.lit("\n- x "), "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", models.knowledge_list(text).alias("list"))


# translation


@query("SELECT p_partkey, p_size::DOUBLE AS faith_avg FROM part WHERE p_size >= 10 OR p_size % 2 = 0")
def faithful(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("faith_avg"), (F.col("p_size") % 2 == 0).alias("faith_parse_failed"))
    return translation.faith_threshold(rows, least=10).select("p_partkey", "faith_avg")


@query("SELECT p_partkey, (p_size % 5 + 1)::DOUBLE AS faith_avg FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size % 3 = 0")
def faith_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = (F.col("p_size") % 5 + 1).cast("int")
    answer = F.to_json(F.struct(*[F.when((F.col("p_size") % 3 != 0) | (F.lit(i) > 0), mark).alias(k) for i, k in enumerate(translation.FAITH)]))
    return table(spark, sf_dir, "part").select("p_partkey", translation.faith_scores(answer).alias("faith_avg"))


@query("SELECT p_partkey, '{\"faith_scores\": {\"Fluency\": ' || p_size || '}}' AS translation_metadata FROM part")
def scores_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return translation.merge_scores(table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("Fluency")), ["Fluency"]).select("p_partkey", "translation_metadata")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_brand END AS text, '{\"target_lang\":\"de\",\"translation\":{' || CASE WHEN p_size % 2 = 0 THEN '\"content\":\"' || p_type || '\"' ELSE '' END || '}}' AS translation_metadata FROM part")
def translations_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("text"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("translated_text"))
    return translation.format_output(rows, "de", "both")


@query("SELECT conv_id * 1000 + turn AS id, CASE WHEN turn % 2 = 0 THEN 'kept' ELSE md5(array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN regexp_matches(x, '\\p{L}') THEN replace(x, 'e', '3') ELSE x END), chr(10))) END AS text FROM conversations")
def translations_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text", F.when(F.col("turn") % 2 == 0, "kept").alias("translated_text"))
    made = lambda: lambda lines: [s.replace("e", "3") for s in lines]
    done = translation.translate(turns, made, "id", skip_existing=True)
    return done.select("id", F.when(F.col("translated_text") == "kept", "kept").otherwise(F.md5("translated_text")).alias("text"))


@query("SELECT p_partkey, p_brand = p_type OR p_size % 2 = 0 AS passed FROM part")
def translations_like_their_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("text"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.col("p_brand")).alias("backtranslated_text"))
    return translation.quality_metrics(rows, {"chrf": 99.0, "ter": 1.0}, passed="passed").select("p_partkey", "passed")
