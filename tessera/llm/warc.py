"""WARC records in a content-addressed archive.

Method.  An archive is two tables.  ``payloads`` has the bytes of each distinct
payload of ``least`` bytes or more once, under its SHA-256.  ``records`` has a row for
each record: its exact header bytes (the WARC header, and for HTTP records the HTTP
header), the payload's digest and length, and the payload itself only if it is
shorter (a reference would cost more).  Original records come back by a join on the
digest.

Verified.  Payloads are grouped by SHA-256; the rows of a group must agree in length
and in a second, unrelated 64-bit hash, else the job fails.  When a WARC file is read,
each record's SHA-256 is computed again and compared with its header.

Spreading the work.  Digests are computed where the pages are; only light rows (no
payload) are joined to find which record of a payload is the response and which are
revisits.  Payloads are shuffled once, copies merged before that; the table of
payloads is bucketed by digest, so that the join that rebuilds records moves headers
only.  A payload has one record that needs its bytes, so no digest is a hot key there.
WARC files are written by Spark's text writer: a record is a row, and the line
separator is the blank line pair that ends a WARC record.  Files are kept to about
``FILE_BYTES``, and each is read as a stream of records by one task.

Records of pages.  Of pages with equal payloads of ``least`` bytes or more that with the
largest page id is the ``response``, the others are ``revisit`` records that refer to
it; shorter payloads are all responses.

Nulls and the like: a null html is an empty payload; a null page id or url leaves its
field out, and such an id is the smallest; a url with blanks or control characters is
stored percent-encoded (and marked so).  Of rows that repeat the largest id with the
same payload any one is the response, the others refer to the same id.  An empty table
gives an archive without rows.  Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .scratch import arrow_map, written

#: Payloads from this size on are stored once.
LEAST = 1000
FILE_BYTES = 64 << 20
OUT_BYTES = 16 << 20
_CRLF = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


@dataclass
class Archive:
    """``records``: key, type, head (binary), sha256, n_bytes, inline (binary, or
    null: the payload is in ``payloads``) and refers_to (the record of the payload's
    bytes, for revisits).  ``payloads``: sha256, payload."""

    spark: SparkSession
    records: DataFrame
    payloads: DataFrame
    name: str

    def close(self) -> None:
        """Take the table of payloads out of the catalogue; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _bucketed(payloads: DataFrame) -> str:
    """The name of the table of payloads, bucketed by digest into as many buckets as a shuffle has partitions."""
    spark = payloads.sparkSession
    name = f"tessera_payloads_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    (payloads.write.bucketBy(buckets, "sha256").sortBy("sha256").option("compression", "zstd")
     .option("path", scratch_path(spark, "warc-payloads")).saveAsTable(name))
    return name


def _stored(rows: DataFrame) -> str:
    """The name of a table with each distinct payload of rows (sha256, payload, check) once."""
    groups = rows.groupBy("sha256").agg(F.first("payload").alias("payload"), F.min("check").alias("low"), F.max("check").alias("high"))
    same = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(F.raise_error(F.lit("payloads of one digest differ")).cast("binary"))
    return _bucketed(groups.select("sha256", same.alias("payload")))


def _check(payload: Column) -> Column:
    return F.struct(F.octet_length(payload).alias("n"), F.xxhash64(payload).alias("h"))


def archive_pages(pages: DataFrame, least: int = LEAST, date: str = "2024-01-01T00:00:00Z") -> Archive:
    """A record for each row (page_id, url, html); ``date`` is that of the records."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    size = F.octet_length("payload").cast("long")
    light = written(given.select(F.monotonically_increasing_id().alias("key"), "page_id", "url", size.alias("n_bytes"), F.sha2("payload", 256).alias("sha256"),
                                 F.when(size < least, F.col("payload")).alias("inline")), "warc-light")
    payloads = _stored(given.where(size >= least).select(F.sha2("payload", 256).alias("sha256"), "payload", _check(F.col("payload")).alias("check")))
    urn = _urn(F.col("key").cast("string"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("sha256"))
    light = light.withColumn("urn", urn)
    first = (light.where(F.col("inline").isNull()).groupBy("sha256").agg(F.max(F.struct("page_id", "key", "urn")).alias("own"))
             .select("sha256", F.col("own.key").alias("own_key"), F.col("own.urn").alias("own_urn")))
    typed = (light.join(first, "sha256", "left")
             .withColumn("refers_to", F.when(F.col("own_key") != F.col("key"), F.col("own_urn")))
             .withColumn("type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")))
    odd = F.col("url").rlike("[\\x00-\\x20\\x7f]")
    revisit = F.col("type") == "revisit"
    http = F.when(revisit, F.lit("HTTP/1.1 200 OK\r\n\r\n")).otherwise(F.concat(F.lit(_HTTP), F.col("n_bytes").cast("string"), F.lit(_CRLF * 2)))
    body = F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", F.col("type")), _field("WARC-Record-ID", F.col("urn")), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.when(odd, F.url_encode("url")).otherwise(F.col("url"))), _field("Target-URI-Encoded", F.when(odd, F.lit("yes"))),
        _field("Page-ID", F.col("page_id").cast("string")), _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("sha256"))),
        _field("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("WARC-Refers-To", F.col("refers_to")), _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", (F.octet_length(http) + body).cast("string")), F.lit(_CRLF), http)
    records = written(typed.select("key", "type", head.cast("binary").alias("head"), "sha256", "n_bytes", "inline", "refers_to"), "warc-records")
    return Archive(spark, records, spark.table(payloads), payloads)


def archive_records(records: DataFrame, least: int = LEAST) -> Archive:
    """An archive of records as ``read_warc`` gives them: exact heads, payloads once."""
    kept = written(records.select(F.monotonically_increasing_id().alias("key"), "type", "head", "sha256", "n_bytes",
                                  F.when(F.col("n_bytes") < least, F.col("payload")).alias("inline"), "refers_to"), "warc-records")
    big = records.where(F.col("n_bytes") >= least).select("sha256", "payload", _check(F.col("payload")).alias("check"))
    payloads = _stored(big)
    return Archive(records.sparkSession, kept, records.sparkSession.table(payloads), payloads)


def reconstruct(archive: Archive) -> DataFrame:
    """(key, record): the original bytes of each record, without the blank lines that end it."""
    parts = archive.records
    plain = parts.where(F.col("inline").isNotNull() | (F.col("type") == "revisit"))
    stored = parts.where(F.col("inline").isNull() & (F.col("type") != "revisit"))
    none = F.lit(b"")
    return (plain.select("key", F.concat("head", F.when(F.col("type") == "revisit", none).otherwise(F.col("inline"))).alias("record"))
            .union(stored.join(archive.payloads, "sha256").select("key", F.concat("head", "payload").alias("record"))))


def export_warc(archive: Archive, path: str | None = None) -> str:
    """WARC files of the archive's records; the folder they are in."""
    path = path or scratch_path(archive.spark, "warc-files")
    rows = reconstruct(archive)
    n, size = archive.records.select(F.count("*"), F.sum(F.when(F.col("type") != "revisit", F.col("n_bytes")).otherwise(0) + F.octet_length("head"))).first()
    per_file = max(1, FILE_BYTES * n // size) if n else 1
    (rows.select(F.col("record").cast("string").alias("value")).write.option("lineSep", _CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))
    return path


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(header fields, head bytes, payload bytes) of the records of a WARC stream."""
    def need(n: int) -> bytes:
        got = stream.read(n)
        if len(got) != n:
            raise ValueError("a record ends too early")
        return got

    while line := stream.readline():
        if not line.strip():
            continue  # some writers put more blank lines between records
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not start with WARC/")
        head, fields, last = [line], {}, ""
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError("a header does not end")
            head.append(line)
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[:1] in (" ", "\t") and last:  # a folded line
                fields[last] += " " + text.strip()
            else:
                last, _, value = text.partition(":")
                last = last.strip().lower()
                fields[last] = value.strip()
        head.append(line)
        payload = need(int(fields["content-length"]))
        if fields.get("content-type", "").startswith("application/http"):
            at = payload.find(b"\r\n\r\n")
            if at >= 0:
                head.append(payload[:at + 4])
                payload = payload[at + 4:]
        yield fields, b"".join(head), payload


_RECORDS = ("file string, position long, type string, record_id string, refers_to string, page_id long, url string, "
            "n_bytes long, sha256 string, sha1 string, head binary, payload binary")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from urllib.parse import unquote_plus
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    types = {"position": pa.int64(), "page_id": pa.int64(), "n_bytes": pa.int64(), "head": pa.binary(), "payload": pa.binary()}
    schema = pa.schema([(n, types.get(n, pa.string())) for n in names])
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = io.BytesIO(content.as_buffer())
            stream = gzip.GzipFile(fileobj=raw) if raw.read(2) == b"\x1f\x8b" else raw
            raw.seek(0)
            rows, size = [], 0
            for position, (f, head, payload) in enumerate(records_of(stream)):
                sha256 = hashlib.sha256(payload).hexdigest()
                said = f.get("warc-payload-digest", "")
                revisit = f.get("warc-type") == "revisit"
                if said.startswith("sha256:") and not revisit and said[7:] != sha256:
                    raise ValueError(f"{path}, record {position}: the payload's digest is another")
                url = f.get("warc-target-uri")
                rows.append((path, position, f.get("warc-type"), f.get("warc-record-id"), f.get("warc-refers-to"), int(f["page-id"]) if "page-id" in f else None,
                             unquote_plus(url) if url and f.get("target-uri-encoded") else url, len(payload), sha256, hashlib.sha1(payload).hexdigest(), head, payload))
                size += len(head) + len(payload)
                if size > OUT_BYTES:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files (plain or gzip): file, position, type, record_id,
    refers_to, page_id, url, n_bytes, sha256, sha1 (of the payload in the file), head
    (exact header bytes) and payload."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return arrow_map(files, _parse, _RECORDS)


def page_report(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records
    of pages; those of a revisit come from the record it refers to."""
    light = written(records.select("type", "record_id", "refers_to", "page_id", "n_bytes", "sha1"), "warc-read")
    there = light.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"), F.col("n_bytes").alias("to_bytes"), F.col("sha1").alias("to_sha1"))
    got = light.join(there, "refers_to", "left")
    again = F.col("type") == "revisit"
    return got.select("page_id", F.when(again, F.col("to_bytes")).otherwise(F.col("n_bytes")).alias("payload_bytes"),
                      F.when(again, F.col("to_sha1")).otherwise(F.col("sha1")).alias("payload_digest"), F.col("type").alias("record_type"),
                      F.when(again, F.col("to_page")).alias("refers_to"))


def oracle(least: int = LEAST) -> str:
    """DuckDB SQL of ``page_report`` over ``pages`` of distinct ids."""
    return f"""
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {least} AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {least} AND page_id <> top THEN top END AS refers_to
FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
      FROM pages)"""
