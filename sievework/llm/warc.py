"""WARC files compressed with a Zstandard dictionary (.warc.zst).

A dictionary is built from a sample of the records to be archived, put at the head of every file in a skippable frame,
and each record is a frame of its own that can be read alone. Of records with equal payloads, one is a response and the
others are revisits that refer to it and carry no payload.

Frame at the head: magic 0x184D2A5D and length, little-endian, then the dictionary, as the .warc.zst format has it. Own
headers beside the standard's: X-Page-Id (absent: null), X-Payload-Length, and X-Refers-To-Page of a revisit.

Edge cases: null html is an empty payload; a null url leaves its header out. Null ids count as smaller than others;
rows that share the largest id of their payload are all responses. Columns other than id, url and html are ignored. An
empty table gives no file.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm._runtime import fresh_path, join_about, materialise, open_fs, small_batches, tidy

DICTIONARY_MAGIC = 0x184D2A5D
#: The dictionary's size, and its sample: so many records of at most so many bytes.
DICTIONARY, SAMPLE, SAMPLE_BYTES = 64 << 10, 1000, 32 << 10
#: A file is closed beyond so many compressed bytes.
FILE_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; ``refers_to`` is the response's id where ``revisit``."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers and payload of a record's bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record is cut")
    if "sha1:" + base32(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
        raise ValueError("a record's block has another digest")
    return fields | {"payload": block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None}


def build_dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; the samples themselves, cut to ``size``, where they are too few or too alike to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 16 else b"".join(samples)[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def read_records(stream) -> Iterator[dict]:
    """Records of a file, one frame at a time; a few of them are in memory at once."""
    import zstandard

    head = stream.read(8)
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the head")
    dictionary = zstandard.ZstdCompressionDict(stream.read(size))
    reader, chunk = zstandard.ZstdDecompressor(dict_data=dictionary), b""
    while chunk := chunk or stream.read(1 << 16):
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(chunk))
            if frame.eof:
                chunk = frame.unused_data
                break
            if not (chunk := stream.read(1 << 16)):
                raise ValueError("a frame is cut")
        yield parse(b"".join(parts))


def _payload():
    return F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")


def write(pages: DataFrame, path: str | None = None, minimum: int = 0, dictionary_size: int = DICTIONARY, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive ``pages(page_id, url, html)``; records with equal payloads of at least ``minimum`` bytes become revisits of
    that with the largest id. Returns the manifest ``(file, n_records, bytes)``.

    Only digests are grouped. Those that more than one row has are joined with the pages, so that html moves at most
    once. A repeated attempt writes the same bytes under the same name.
    """
    spark = pages.sparkSession
    small_batches(spark)
    path = path or fresh_path(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").withColumn("digest", F.sha1(_payload()))
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= minimum
    shared = materialise(rows.where(large).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1"), "shared")
    usual = rows.where(F.octet_length(F.coalesce("html", F.lit(""))).between(1, SAMPLE_BYTES))
    # twice the sample by a share of the hashes: tasks send few rows each, however many tasks there are
    part = F.pmod(F.xxhash64(F.lit(1), "digest"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * SAMPLE / max(1, usual.count())))
    sample = usual.where(part).orderBy(F.xxhash64("digest"), "page_id").limit(SAMPLE).collect()
    records = [record(r.page_id, r.url, r.html.encode("utf-8", "surrogatepass"), None, False) for r in sample]
    dictionary = spark.sparkContext.broadcast(build_dictionary(records, dictionary_size))  # at most dictionary_size bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        fs, top = open_fs(path)
        fs.create_dir(top, recursive=True)
        task = TaskContext.get()
        part, attempt, roll = task.partitionId(), task.taskAttemptId(), 0
        trained = zstandard.ZstdCompressionDict(dictionary.value)
        pack = zstandard.ZstdCompressor(level=3, dict_data=trained)
        out, n, size = None, 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            fs.move(f"{top}/{name}.{attempt}", f"{top}/{name}")
            return pa.RecordBatch.from_pydict({"file": [f"{path}/{name}"], "n_records": [n], "bytes": [size]})

        for batch in batches:
            for page_id, url, html, response, twin in zip(*(batch.column(i) for i in range(5)), strict=True):
                if out is None:
                    name = f"part-{part:06d}-{roll:05d}.warc.zst"
                    out = fs.open_output_stream(f"{top}/{name}.{attempt}", compression=None)
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary.value)) + dictionary.value)
                    n, size = 0, 8 + len(dictionary.value)
                page, to = page_id.as_py(), response.as_py()
                frame = pack.compress(record(page, url.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass"), to, bool(twin.as_py()) and to is not None and page != to))
                out.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= file_bytes:
                    yield close()
                    out, roll = None, roll + 1
        if out is not None:
            yield close()

    met = join_about(rows.withColumn("key", F.when(large, F.col("digest"))), shared.select(F.col("digest").alias("key"), "response"), "key", counts=shared.select(F.col("digest").alias("key"), F.col("n").alias("count")))
    met = met.select("page_id", "url", "html", "response", F.col("response").isNotNull().alias("twin"))
    return materialise(met.mapInArrow(tidy(run), "file string, n_records long, bytes long"), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of each record, read back from the files. A
    response's size and digest are those of its payload as read; a revisit's are those that its headers have."""
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        whole = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, at = open_fs(uri)
                rows = []
                with fs.open_input_stream(at, compression=None) as stream:
                    for r in read_records(stream):
                        number = lambda key, r=r: int(r[key]) if key in r else None
                        digest = r["WARC-Payload-Digest"].removeprefix("sha1:")
                        if (payload := r["payload"]) is not None and base32(hashlib.sha1(payload).digest()) != digest:
                            raise ValueError(f"{uri}: a payload has another digest")
                        rows.append((number("X-Page-Id"), number("X-Payload-Length") if payload is None else len(payload), digest, r["WARC-Type"], number("X-Refers-To-Page")))
                        if len(rows) == 5000:
                            yield whole(rows)
                            rows = []
                if rows:
                    yield whole(rows)

    files = manifest.select("file").repartition(max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism)))
    return files.mapInArrow(tidy(run), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
