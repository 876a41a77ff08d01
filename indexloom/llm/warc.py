"""WARC archives with revisit records in place of repeated payloads."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import Scratch, scratch_path

#: Shorter payloads are always stored: a revisit record would not be smaller.
MIN_PAYLOAD = 100
#: Repeated digests that are broadcast; about 100 bytes each.
FEW_DIGESTS = 1 << 17
#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string"


def resolve_revisits(spark: SparkSession, pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, payload_bytes, payload_digest, record_type and refers_to.

    Of payloads with equal SHA-256 and at least ``min_payload`` bytes, the smallest page_id is the response and the
    others revisit it. A null html is the empty payload. Rows that repeat the smallest page_id are responses too; a
    null page_id is a revisit if another row has the payload under an id, else a response. Only (digest, page_id)
    headers are aggregated; digests that occur once leave there. At most FEW_DIGESTS repeated ones are broadcast. Beyond
    that records whose digest surely occurs once pass where they are read, and only the others go through an equi-join
    on the digest, whose large partitions adaptive execution splits.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    heads = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload.cast("binary"), 256).alias("payload_digest"))
    first = heads.where(F.col("payload_bytes") >= min_payload).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = Scratch(spark, "warc").table(first, "first")
    n = first.count()
    if n <= FEW_DIGESTS:
        joined = heads.join(F.broadcast(first), "payload_digest", "left")
    else:
        hit = common.may_be_in(spark, common.bloom_bits(first, F.xxhash64("payload_digest"), common.filter_size(n)), F.xxhash64("payload_digest"))
        once = heads.where(~hit).withColumn("first_id", F.lit(None).cast("long"))
        joined = once.unionByName(heads.where(hit).join(first, "payload_digest", "left"))
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _record(date: str) -> Column:
    """The text of one record without its closing blank line."""
    revisit = F.col("record_type") == "revisit"
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))  # noqa: E731  nothing for a null
    head = F.concat(F.lit(HTTP_HEAD), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        F.lit(f"WARC-Date: {date}\r\n"),
        line("WARC-Target-URI", F.regexp_replace("url", r"\p{Cntrl}", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(resolved: DataFrame, path: str, records_per_file: int, date: str | None = None) -> None:
    """Gzip WARC files under ``path``, through Spark's text writer, so on any file system that Spark writes to.

    Each record ends with the blank line that the writer puts after a value. A lost task is written again as a whole.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    resolved.select(_record(date).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed archive, by Content-Length alone."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        start = end + 4
        at = start + int(headers["Content-Length"])
        yield headers, raw[start:at]
        if raw[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record isn't closed at byte {at}")
        at += 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``; of a response the payload is hashed again and must have its digest."""

    def number(urn: str | None) -> int | None:
        text = urn[len("<urn:page:") : -1] if urn else "none"
        return None if text == "none" else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.string())])
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for h, block in parse_records(gzip.decompress(batch.column(0)[i].as_buffer())):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest, kind = h["WARC-Payload-Digest"].removeprefix("sha256:"), h["WARC-Type"]
                    size = int(http.rpartition(b": ")[2])
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                        raise ValueError(f"payload of {h['WARC-Record-ID']} differs from its digest")
                    rows.append((number(h["WARC-Record-ID"]), size, digest, kind, number(h.get("WARC-Refers-To")), h.get("WARC-Target-URI"), payload.decode() if kind == "response" else None))
                    held += len(block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, SCHEMA)


def archive_pages(spark: SparkSession, pages: DataFrame, path: str | None = None, file_bytes: int = 32 << 20) -> DataFrame:
    """Writes ``pages`` as deduplicated archives and returns the records read back.

    Files hold about ``file_bytes`` of payload each by the mean payload size, so that one is parsed in bounded memory.
    """
    path = path or scratch_path(spark, "warc")
    mean = pages.select(F.avg(F.octet_length(F.coalesce(F.col("html"), F.lit(""))))).first()[0] or 0
    write_archives(resolve_revisits(spark, pages), path, max(1, int(file_bytes / (mean + 512))))
    return read_archives(spark, path)
