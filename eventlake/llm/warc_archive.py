"""Content-addressed web archive.

``archive`` splits WARC records into two stores: ``payloads`` (every distinct
payload once, keyed by its SHA-256) and ``headers`` (the exact header bytes of
every record, with the digest of its payload). ``reconstruct`` joins them
back and verifies digest and length of every payload it returns.
``export_warc`` / ``read_warc`` write and read ordinary ``.warc`` files.

Defined results: a null payload is empty; a null url gives a record without a
target; a null page_id sorts below every other and is written as ``null``;
repeated rows are records of their own, numbered by copy (of equal rows that
are the largest of their payload one is the response, the others revisit it);
extra columns are ignored; empty tables give empty stores.

Scale: payloads are shuffled once, reduced per task first, so a page with a
third of all copies moves once per task. Headers meet payloads in a join on
the digest, whose hot keys adaptive execution splits; nothing is collected.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import table
from eventlake.session import staging_root

#: Payloads shorter than this are never replaced by a revisit record.
MIN_REVISIT_BYTES = 1000
#: Pages carry no fetch time; a fixed one keeps runs repeatable.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"


def _id(page: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), copy.cast("string"), F.lit(">"))


def page_records(pages: DataFrame) -> DataFrame:
    """(record_id, header, digest, n_bytes): the header bytes of a WARC record
    per row of (page_id, url, html); the payload stays with ``page_payloads``."""
    rows = _hashed(pages).groupBy("page_id", "url", "digest", "sha1", "n_bytes").agg(F.count(F.lit(1)).alias("copies"))
    winner = F.max(F.struct("page_id", "url"))
    first = rows.filter(F.col("n_bytes") >= MIN_REVISIT_BYTES).groupBy("digest").agg(winner.alias("top"))
    # winners exist for the large payloads only; small ones keep a null
    joined = rows.join(first, "digest", "left").withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    is_top = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url")) & (F.col("copy") == 0)
    revisit = F.col("top").isNotNull() & ~is_top
    url = F.regexp_replace(F.col("url"), r"[\r\n]", " ")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), _id(F.col("page_id"), F.col("copy"))),
        F.concat(F.lit("WARC-Date: "), F.lit(DATE)),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _id(F.col("top.page_id"), F.lit(0)))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
    ]
    header = F.concat(F.concat_ws("\r\n", *lines), F.lit(RECORD_END)).cast("binary")
    return joined.select(_id(F.col("page_id"), F.col("copy")).alias("record_id"), header.alias("header"), "digest", "n_bytes")


def _hashed(pages: DataFrame) -> DataFrame:
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"))
    return rows.withColumns(
        {"digest": F.sha2("payload", 256), "sha1": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")}
    )


def distinct_payloads(rows: DataFrame) -> DataFrame:
    """(digest, payload): every payload once, reduced per task before the shuffle."""
    return rows.groupBy("digest").agg(F.any_value("payload").alias("payload"))


def archive(spark: SparkSession, headers: DataFrame, payloads: DataFrame, path: str) -> None:
    """Write the two stores below ``path``."""
    headers.write.parquet(f"{path}/headers")
    distinct_payloads(payloads).write.option("compression", "zstd").parquet(f"{path}/payloads")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """(digest, payload) of the store; bytes that do not give their digest are
    an error."""
    payloads = spark.read.parquet(f"{path}/payloads")
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))).cast("binary")
    return payloads.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(damaged).alias("payload"))


def with_payload(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """Headers joined with what ``payloads`` holds by digest; a record whose
    payload is missing or has another length (``stored_bytes``) is an error."""
    wrong = F.raise_error(F.concat(F.lit("no such payload "), F.col("digest"))).cast("long")
    joined = headers.join(payloads, "digest", "left")
    return joined.withColumn("n_bytes", F.when(F.col("n_bytes") == F.col("stored_bytes"), F.col("n_bytes")).otherwise(wrong))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, header, payload): the original records."""
    payloads = stored(spark, path).withColumn("stored_bytes", F.octet_length("payload").cast("long"))
    return with_payload(spark.read.parquet(f"{path}/headers"), payloads).filter("n_bytes >= 0").select("record_id", "header", "payload")


def export_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records as ``.warc`` text: header, block (none for a revisit), end mark."""
    revisit = F.col("header").cast("string").contains("\r\nWARC-Type: revisit\r\n")
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    rows = records.select(F.concat(F.col("header"), body).cast("string").alias("value"))
    rows.write.option("lineSep", RECORD_END).option("compression", compression).text(path)


def _split(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at) + 4
        head = data[at:cut]
        size = next(int(x.split(b":", 1)[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        yield head, data[cut : cut + size]
        at = cut + size + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header, block) of every record of the ``.warc`` files below ``path``.

    A file is one row of the binary source, so files are limited to 2 GB; the
    usual size of an archive file is half of that.
    """

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield pd.DataFrame(list(_split(bytes(content))), columns=["header", "block"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInPandas(records, "header binary, block binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, then rebuild every record and read its fields from it."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    path = f"{staging_root(spark)}/llm-warc-{uuid.uuid4().hex}"
    archive(spark, page_records(pages), _hashed(pages).select("digest", "payload"), path)
    head = F.col("header").cast("string")
    back = reconstruct(spark, path)

    def field(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(head, pattern, 1), F.lit(""))

    def page(name: str) -> Column:
        return field(rf"\r\n{name}: <urn:page:(-?\d+):\d+>\r\n").cast("long")

    return back.select(
        page("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        field(r"\r\nWARC-Type: (\w+)\r\n").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(encode(html), ''::BLOB) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS n, sha1(b) AS s, max(page_id) OVER (PARTITION BY b) AS top FROM p)
SELECT page_id, n AS payload_bytes, s AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM d
"""
