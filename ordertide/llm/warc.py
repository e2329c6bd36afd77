"""WARC archives: writing captures, and assembling them again from their records.

A capture is written as three records: a request, a response (or a revisit, when another capture
holds the same payload) and a metadata record. Request and metadata name the third by
WARC-Concurrent-To. Archives are text files: Spark's text writer puts the two line ends that
close a record after each one, so the files are plain WARC 1.1, compressed file by file.

Reading parses whole files record by record and joins request, response or revisit, and
metadata on the identifier they concur in, into one nested row for each capture.

Payloads of at least ``least`` bytes that are equal are stored once, by the capture with the
largest id; smaller ones are always stored.

Defined cases: a null payload is empty; a null url leaves the target out of the records and
comes back as null; captures that share an id but not a payload are told apart by
their payload's digest; rows equal in id and payload come back as so many rows (each
payload stored with every one that has the largest id; their urls are kept); line ends in a
url are percent-encoded; other columns, whatever their names, are ignored; an empty table
gives no records and an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm.work import new_folder

LEAST_BYTES = 1000
#: Fixed values of the records: the moment all of them carry, and the line end of the format.
MOMENT, CRLF = "2024-01-01T00:00:00Z", "\r\n"
RECORDS_PER_FILE = 3000
RECORD = "kind string, record_id string, concurrent_to string, refers_to string, target string, digest string, length long, digest_ok boolean, page_id long, refers_to_page long, headers array<struct<name: string, value: string>>, payload binary"
COLUMNS = {
    **dict.fromkeys(["kind", "record_id", "concurrent_to", "refers_to", "target", "digest"], pa.string()), "length": pa.int64(), "digest_ok": pa.bool_(),
    "page_id": pa.int64(), "refers_to_page": pa.int64(), "headers": pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())])), "payload": pa.binary(),
}


# -------------------------------------------------------------- writing ----


def _urn(*parts: Column) -> Column:
    """A record id in the form of a UUID from what identifies the record."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields])


def _record(kind: Column, fields: list[tuple[str, Column]], content: str, block: Column) -> Column:
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _lines(("WARC-Type", kind), *fields, ("WARC-Date", F.lit(MOMENT)), ("Content-Type", F.lit(content)), ("Content-Length", F.octet_length(block).cast("string"))),
        F.lit(CRLF), block,
    )


def captures(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """(id, url, payload, digest, refers): ``refers`` is the capture that stores the same payload, null for one that stores its own."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    clean = F.replace(F.replace(F.col(url).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col(key).cast("long").alias("id"), clean.alias("url"), payload.alias("payload")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    large = rows.filter(F.octet_length("payload") >= least)
    # one row for each payload that more than one capture has; a hot payload splits on the side of the captures
    shared = large.groupBy("digest").agg(F.max("id").alias("keeper"), F.count("id").alias("n")).filter("n > 1").select(F.col("digest").alias("of"), "keeper")
    joined = rows.join(shared, (F.col("digest") == F.col("of")) & (F.octet_length("payload") >= least), "left")
    return joined.select("id", "url", "payload", "digest", F.when(F.coalesce("id", F.lit(-(2**63))) < F.col("keeper"), F.col("keeper")).alias("refers"))


def write_archive(pages: DataFrame, path: str, **options) -> None:
    """Three records for each row of ``pages`` into compressed WARC files under ``path``."""
    rows = captures(pages, **options)
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    main = _urn(F.lit("response"), name, F.col("digest"))
    target = ("WARC-Target-URI", F.col("url"))
    here = F.regexp_extract("url", r"^[a-z]+://[^/]*([^#]*)", 1)
    host = F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1)
    request = F.concat(F.lit("GET "), F.coalesce(F.nullif(here, F.lit("")), F.lit("/")), F.lit(f" HTTP/1.1{CRLF}Host: "), F.coalesce(host, F.lit("")), F.lit(CRLF + CRLF))
    size = F.octet_length("payload").cast("string")
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF + CRLF))
    again = F.col("refers").isNotNull()
    about = _lines(("pageId", F.col("id").cast("string")), ("refersToPageId", F.col("refers").cast("string")))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    revisit = [
        ("WARC-Refers-To", F.when(again, _urn(F.lit("response"), F.col("refers").cast("string"), F.col("digest")))),
        ("WARC-Profile", F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
    ]
    records = F.array(
        _record(F.lit("request"), [("WARC-Record-ID", _urn(F.lit("request"), name, F.col("digest"))), ("WARC-Concurrent-To", main), target], "application/http; msgtype=request", request),
        _record(F.when(again, F.lit("revisit")).otherwise(F.lit("response")), [("WARC-Record-ID", main), target, digest, *revisit], "application/http; msgtype=response", F.when(again, answer).otherwise(F.concat(answer, "payload"))),
        _record(F.lit("metadata"), [("WARC-Record-ID", _urn(F.lit("metadata"), name, F.col("digest"))), ("WARC-Concurrent-To", main), target], "application/warc-fields", about),
    )
    lines = rows.select(F.explode(records).alias("value"))
    lines.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


# -------------------------------------------------------------- reading ----


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8").split(CRLF)[1:]:
        name, _, value = line.partition(":")
        out[name] = value.strip()
    return out


def _inflate(blob: bytes) -> bytes:
    """All members of a gzip file; other bytes as they are."""
    if blob[:2] != b"\x1f\x8b":
        return blob
    out = []
    while blob:
        member = zlib.decompressobj(31)
        out.append(member.decompress(blob) + member.flush())
        blob = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file."""
    at, end = 0, len(data)
    while at < end:
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        stop = data.index(b"\r\n\r\n", at)
        headers = _headers(data[at:stop])
        size = int(headers["Content-Length"])
        yield headers, data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size


def _number(text: bytes, name: bytes) -> int | None:
    found = re.search(rb"(?:^|\r\n)" + name + rb": (-?\d+)\r\n", text)
    return int(found[1]) if found else None


def _parsed(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    kind = headers["WARC-Type"]
    row: dict = dict.fromkeys(COLUMNS) | {
        "kind": kind, "record_id": headers["WARC-Record-ID"], "concurrent_to": headers.get("WARC-Concurrent-To"),
        "refers_to": headers.get("WARC-Refers-To"), "target": headers.get("WARC-Target-URI"), "headers": [{"name": k, "value": v} for k, v in headers.items()] if with_payload else None,
    }
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        row["digest"] = headers["WARC-Payload-Digest"].partition(":")[2]
        if kind == "response":
            row["length"], row["digest_ok"] = len(body), hashlib.sha1(body).hexdigest() == row["digest"]
        else:
            row["length"] = _number(head + b"\r\n", b"Content-Length")
        row["payload"] = body if with_payload and kind == "response" else None
    elif kind == "metadata":
        row["page_id"], row["refers_to_page"] = _number(block, b"pageId"), _number(block, b"refersToPageId")
    return row


def _read(with_payload: bool):
    def as_batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], k) for n, k in COLUMNS.items()})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["content"]:
                rows: list[dict] = []
                held = 0
                for headers, block in records_of(_inflate(blob.as_py())):
                    rows.append(_parsed(headers, block, with_payload))
                    held += len(rows[-1]["payload"] or b"")
                    if len(rows) == 5000 or held > 8 << 20:
                        yield as_batch(rows)
                        rows, held = [], 0
                yield as_batch(rows)

    return read


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row (``RECORD``) for each record of the archives under ``path``; payload digests are checked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_read(with_payload), RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row for each capture: its request, response (or revisit) and metadata records, joined on the record they concur in."""
    part = F.struct("record_id", "target", F.struct(*[F.col(c) for c in records.columns]).alias("r"))
    keyed = records.withColumn("capture", F.coalesce("concurrent_to", "record_id"))

    def of(name: str, *kinds: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind").isin(*kinds), part))).alias(name)

    # one record of each kind, but for captures that were given more than once
    grouped = keyed.groupBy("capture").agg(of("request", "request"), of("response", "response", "revisit"), of("metadata", "metadata"))
    return grouped.select("capture", F.explode(F.arrays_zip("request", "response", "metadata")).alias("c")).select(
        "capture", F.col("c.request.r").alias("request"), F.col("c.response.r").alias("response"), F.col("c.metadata.r").alias("metadata")
    )


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes ``pages`` as an archive, reads it back, and gives a row for each capture."""
    spark = pages.sparkSession
    path = path or new_folder(spark, "warc")
    write_archive(pages, path)
    done = transactions(read_records(spark, path, with_payload=False).drop("headers", "payload"))
    return done.select(
        F.col("metadata.page_id").alias("page_id"), F.col("response.length").alias("payload_bytes"), F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"), F.col("metadata.refers_to_page").alias("refers_to"), F.col("response.target").alias("url"), F.col("response.digest_ok").alias("digest_ok"),
    )


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, url, octet_length(b) AS n, sha1(b) AS h, max(page_id) OVER (PARTITION BY sha1(b)) AS keeper FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest, CASE WHEN n >= {LEAST_BYTES} AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {LEAST_BYTES} AND page_id < keeper THEN keeper END AS refers_to, url, CASE WHEN n >= {LEAST_BYTES} AND page_id < keeper THEN NULL ELSE TRUE END AS digest_ok
FROM d
"""
