"""WARC archives: writing page captures, reading records, assembling transactions.

A capture is written as three records: the request, the response (or a revisit
of an equal payload) and metadata. Request and metadata name the response by
``WARC-Concurrent-To``; reading joins them back through that field, whatever
files they lie in, and emits one nested row per capture.

Archives are plain WARC/1.1 files, written by Spark's own text writer under its
commit protocol, so a lost task leaves no half file. ``rows_per_file`` bounds a
file, since a reader holds one file at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldlake.session import stored

#: Payloads below this size are never revisits.
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PLAIN32, WARC32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
          "payload_bytes long, payload_digest string, fields map<string,string>, payload binary")


def _base32(sha1_hex: Column) -> Column:
    """The usual spelling of a SHA-1 in WARC: 40 bits at a time, by base conversion."""
    groups = [F.lpad(F.conv(F.substring(sha1_hex, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), PLAIN32, WARC32)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record as text. Its last line feed is the writer's line separator."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    return F.concat(
        F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines, F.concat(F.lit("Content-Length: "), F.octet_length(block))),
        F.lit("\r\n\r\n"), block, F.lit("\r\n\r"))


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", rows_per_file: int = 2000) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``.

    Null html is an empty payload; a null url is written as the page's number. Of
    payloads equal in digest and length and of at least ``LEAST_REVISIT`` bytes, the
    one with the largest page_id is a response, the others revisit it (rows that
    repeat that page are responses too; if no page of the group has a page_id, all
    are responses). Only the largest id per digest is gathered, on the map side
    first; the join back is a plain one on both sides, so a payload with many copies
    is split. An empty table gives a folder without records.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    raw = pages.select(
        "page_id", F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")))), r"[\r\n]", " ").alias("url"),
        html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"), F.octet_length(html).alias("bytes"))
    large = raw.filter(F.col("bytes") >= LEAST_REVISIT)
    kept = large.groupBy("sha1", "bytes").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    kept = stored(kept.filter("n > 1 AND kept IS NOT NULL").drop("n"), "warc-kept")
    rows = raw.join(kept, ["sha1", "bytes"], "left").withColumn(
        "revisit", F.coalesce(F.col("page_id") < F.col("kept"), F.col("kept").isNotNull()))

    capture = lambda page: _uuid(F.lit("capture"), page, F.col("sha1"))
    own = F.when(F.col("revisit") | F.col("kept").isNotNull(), capture(F.col("page_id"))).otherwise(_uuid(F.lit("capture"), F.col("page_id"), F.col("sha1")))
    uri, when = ("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("sha1"))))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit("\r\n\r\n"))
    kind = lambda value: ("Content-Type", F.lit(value))
    side = lambda name: ("WARC-Record-ID", _uuid(F.lit(name), own))
    request = _record(
        [("WARC-Type", F.lit("request")), side("request"), when, uri, ("WARC-Concurrent-To", own), kind("application/http; msgtype=request")],
        F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n")))
    response = _record(
        [("WARC-Type", F.lit("response")), ("WARC-Record-ID", own), when, uri, digest, kind("application/http; msgtype=response")],
        F.concat(http, F.col("html")))
    revisit = _record(
        [("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", own), when, uri, ("WARC-Profile", F.lit(PROFILE)),
         ("WARC-Refers-To", capture(F.col("kept"))), digest, kind("application/http; msgtype=response")], http)
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), side("metadata"), when, uri, ("WARC-Concurrent-To", own), kind("application/warc-fields")],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")))
    three = F.concat_ws("\n", request, F.when(F.col("revisit"), revisit).otherwise(response), metadata)
    rows.select(three.alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", rows_per_file).text(path)


def parse(data: bytes, payloads: bool) -> Iterator[dict]:
    """The records of one archive. Lengths decide where a record ends, so a payload may hold anything."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/1.", at) or (head := data.find(b"\r\n\r\n", at)) < 0:
            raise ValueError(f"no record starts at byte {at}")
        named: dict[str, list[str]] = {}
        for line in data[at:head].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            named.setdefault(name.strip().lower(), []).append(value.strip())
        one = lambda name, of=named: (of.get(name) or [None])[0]
        start = head + 4
        end = start + int(one("content-length"))
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        kind, block = one("warc-type"), data[start:end]
        digest = one("warc-payload-digest")
        row = {
            "record_id": one("warc-record-id"), "type": kind, "concurrent_to": named.get("warc-concurrent-to", []),
            "refers_to": one("warc-refers-to"), "target_uri": one("warc-target-uri"), "date": one("warc-date"),
            "payload_bytes": None, "payload_digest": digest and base64.b32decode(digest.partition(":")[2]).hex(), "fields": [], "payload": None}
        if kind in ("response", "revisit", "request"):
            top, _, payload = block.partition(b"\r\n\r\n")
            lines = top.decode("latin-1").split("\r\n")
            row["fields"] = list({"start": lines[0]} .items()) + [(n.strip().lower(), v.strip()) for n, _, v in (x.partition(":") for x in lines[1:])]
            if kind == "response":
                row |= {"payload_bytes": len(payload), "payload": payload if payloads else None}
                if (own := hashlib.sha1(payload).hexdigest()) != (row["payload_digest"] or own):
                    raise ValueError(f"the payload of {row['record_id']} does not have its digest")
                row["payload_digest"] = own
            elif kind == "revisit":
                size = dict(row["fields"]).get("content-length")
                row["payload_bytes"] = int(size) if size else None
        elif kind == "metadata":
            row["fields"] = [(n.strip(), v.strip()) for n, _, v in (x.partition(":") for x in block.decode().split("\r\n") if x)]
        row["fields"] = list(dict(row["fields"]).items())
        yield row
        at = end + 4


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records below ``path``, one row each; a damaged archive is an error, not a gap.

    ``payloads=False`` leaves the bytes of payloads in the reading task (sizes and
    digests are still taken from the whole payload).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for row in parse(data.as_py(), payloads):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit, with its requests and metadata.

    A request or metadata record belongs to the capture that its concurrent-to field
    names, directly or by way of a request. Records written more than once count
    once on the side of requests and metadata; each response row stays. Side records
    that name no known capture are left out (``orphans`` lists them); a response
    without them has empty lists. Each side is reduced to one row per capture before
    the join.
    """
    main = records.filter(F.col("type").isin("response", "revisit"))
    sides = _sides(records)
    part = lambda kind, name: sides.filter(F.col("type") == kind).groupBy("capture_id").agg(
        F.array_sort(F.collect_set(F.struct("record_id", "target_uri", F.array_sort(F.map_entries("fields")).alias("fields")))).alias(name))
    none = lambda name, like: F.coalesce(F.col(name), F.array().cast(like.schema[name].dataType))
    asks, notes = part("request", "requests"), part("metadata", "metadata")
    return (
        main.withColumnRenamed("record_id", "capture_id")
        .join(asks, "capture_id", "left").join(notes, "capture_id", "left")
        .select("capture_id", F.struct("type", "target_uri", "date", "refers_to", "payload_bytes", "payload_digest", "fields", "payload").alias("response"),
                none("requests", asks).alias("requests"), none("metadata", notes).alias("metadata")))


def _sides(records: DataFrame) -> DataFrame:
    """Requests and metadata with the id they lead to, a request in between resolved."""
    sides = records.filter(F.col("type").isin("request", "metadata")).select(
        "record_id", "type", "target_uri", "fields", F.explode_outer("concurrent_to").alias("to"))
    hops = sides.filter("type = 'request'").select(F.col("record_id").alias("to"), F.col("to").alias("further")).distinct()
    return sides.join(hops, "to", "left").withColumn("capture_id", F.coalesce("further", "to")).drop("further")


def orphans(records: DataFrame) -> DataFrame:
    """Requests and metadata whose concurrent-to field leads to no response or revisit."""
    main = records.filter(F.col("type").isin("response", "revisit")).select(F.col("record_id").alias("capture_id"))
    return _sides(records).join(main, "capture_id", "left_anti").select("record_id", "type", "to")
