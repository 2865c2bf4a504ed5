"""WARC archives: writing pages as captures, reading records, and assembling transactions.

A capture is written as three records: the request, the response (or a revisit that refers to the
response with the same payload) and a metadata record; request and metadata name the response in
``WARC-Concurrent-To``. Reading gives one row per record. ``assemble`` joins records through their
concurrent-to identifiers, in either direction and over one record between (metadata that names the
request), into one nested row per capture.

A record ends with two line ends, which is the line separator the archives are written with, so
Spark's text writer makes them, and a retried task replaces its file. Archives are read as whole
compressed files (``captures_per_file`` bounds them) and unpacked record by record.

Defined results: a null html is an empty payload; a null url becomes ``urn:page:<id>``; white space
and control characters in an url are written as ``%20``; a null page_id stays null; rows that repeat a
page_id are captures of their own, and of equal payloads the last such row is the response; a record
without a capture, and a capture's second request or metadata record, are in ``leftovers``; an empty
table gives an empty result. Other input columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import row_ids

END = "\r\n"
RECORD = ("record_id string, warc_type string, target_uri string, warc_date string, concurrent_to array<string>, "
          "refers_to string, payload_bytes long, payload_digest string, body binary, payload binary")
BATCH_BYTES = 2 << 20
ROOTS = ("response", "revisit")


def _uuid(kind: str, row: Column) -> Column:
    digest = F.md5(F.concat(F.lit(kind + "|"), row))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"))


def _record(headers: list[tuple[str, Column | str | None]], block: Column) -> Column:
    """A record's text; a header with a null value is left out."""
    lines = [F.lit("WARC/1.1" + END)]
    for name, value in [*headers, ("Content-Length", F.octet_length(block).cast("string"))]:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(END)), F.lit("")))
    return F.concat(*lines, F.lit(END), block)


def write_archives(pages: DataFrame, path: str, min_revisit: int = 1000, date: str = "2024-01-01T00:00:00Z",
                   captures_per_file: int = 4000) -> None:
    """Write ``pages`` (page_id, url, html) as gzip archives under ``path``.

    Among equal payloads of ``min_revisit`` bytes or more the row with the largest page_id is the
    response. Record identifiers are made of the rows' places in their files.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = row_ids(pages).select("__row", "page_id", payload.alias("payload"),
                                 F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20").alias("url"))
    base = base.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    groups = (base.where(F.col("bytes") >= min_revisit).groupBy("digest")
              .agg(F.max(F.struct("page_id", "__row"))["__row"].alias("first_row"), F.count("*").alias("n"))
              .where("n > 1").drop("n"))
    # Written, so that its size is known: only a small list of repeated digests is broadcast.
    groups = cut_lineage(groups, "warc-digests")
    rows = base.join(groups, "digest", "left")
    revisit = F.col("first_row") != F.col("__row")
    url = F.coalesce("url", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    own = F.concat(F.lit("<"), _uuid("response", F.col("__row")), F.lit(">"))
    first = F.concat(F.lit("<"), _uuid("response", F.col("first_row")), F.lit(">"))

    def common(kind, record_id):
        return [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", url)]

    def other(kind):
        return common(kind, F.concat(F.lit("<"), _uuid(kind, F.col("__row")), F.lit(">")))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(END + END))
    answer = _record(
        [*common(F.when(revisit, "revisit").otherwise("response"), own),
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
         ("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
         ("WARC-Refers-To", F.when(revisit, first)),
         ("Content-Type", "application/http; msgtype=response")],
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))))
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    target = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1)
    request = _record([*other("request"), ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")],
                      F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(f" HTTP/1.1{END}Host: "),
                               host, F.lit(END + END)))
    metadata = _record([*other("metadata"), ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")],
                       F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END)))
    (rows.select(F.explode(F.array(request, answer, metadata)).alias("value"))
     .write.option("lineSep", END + END).option("compression", "gzip")
     .option("maxRecordsPerFile", 3 * captures_per_file).text(path))


def records_of(stream, with_payload: bool = False) -> Iterator[dict]:
    """The records of one archive. Raises ValueError on what is no WARC record or is cut short."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:60]!r}")
        headers: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        length = int(headers["content-length"][0])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("record cut short")

        def one(name):
            return headers.get(name, [None])[0]

        kind = one("warc-type")
        is_http = (one("content-type") or "").startswith("application/http")
        body, payload = (block[:i + 4], block[i + 4:]) if is_http and (i := block.find(b"\r\n\r\n")) >= 0 else (block, b"")
        full = kind == "response"
        yield {
            "record_id": (one("warc-record-id") or "").strip("<>"), "warc_type": kind, "target_uri": one("warc-target-uri"),
            "warc_date": one("warc-date"), "concurrent_to": [v.strip("<>") for v in headers.get("warc-concurrent-to", [])],
            "refers_to": (one("warc-refers-to") or "").strip("<>") or None,
            "payload_bytes": len(payload) if full else None,
            "payload_digest": hashlib.sha1(payload).hexdigest() if full else None,
            "body": body, "payload": payload if full and with_payload else None}


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives under ``path``, gzip or plain. ``payload`` on request."""

    def parse(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = pa.BufferReader(batch.column(0)[i].as_buffer())
                packed = raw.read(2) == b"\x1f\x8b"
                raw.seek(0)
                stream = gzip.open(raw) if packed else io.BufferedReader(raw)
                rows, size = [], 0
                for record in records_of(stream, with_payload):
                    rows.append(record)
                    size += 500 + len(record["body"]) + len(record["payload"] or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    text = pa.string()
    schema = pa.schema([("record_id", text), ("warc_type", text), ("target_uri", text), ("warc_date", text),
                        ("concurrent_to", pa.list_(text)), ("refers_to", text), ("payload_bytes", pa.int64()),
                        ("payload_digest", text), ("body", pa.binary()), ("payload", pa.binary())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def _capture_of(records: DataFrame) -> DataFrame:
    """record_id and capture_id of every request and metadata record that belongs to a capture."""
    kinds = records.select("record_id", F.col("warc_type").isin(*ROOTS).alias("root"))
    named = records.select("record_id", F.col("warc_type").isin(*ROOTS).alias("root"),
                           F.explode(F.array_distinct("concurrent_to")).alias("other"))
    edges = named.join(kinds.select(F.col("record_id").alias("other"), F.col("root").alias("other_root")), "other")
    near = (edges.where("not root and other_root").select("record_id", F.col("other").alias("capture_id"))
            .unionByName(edges.where("root and not other_root")
                         .select(F.col("other").alias("record_id"), F.col("record_id").alias("capture_id")))
            .groupBy("record_id").agg(F.min("capture_id").alias("capture_id")))
    sides = edges.where("not root and not other_root").select("record_id", "other")
    sides = sides.unionByName(sides.select(F.col("other").alias("record_id"), F.col("record_id").alias("other")))
    far = (sides.join(near.select(F.col("record_id").alias("other"), "capture_id"), "other")
           .groupBy("record_id").agg(F.min("capture_id").alias("far_id")))
    return near.join(far, "record_id", "full").select("record_id", F.coalesce("capture_id", "far_id").alias("capture_id"))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response, request, metadata, n_requests, n_metadata.

    ``records`` should be a written table, as it is read several times. A capture's request and
    metadata are those with the smallest identifier; others are in ``leftovers``.
    """
    fields = F.struct("record_id", "warc_type", "target_uri", "warc_date", "refers_to", "payload_bytes",
                      "payload_digest", "body", "payload")
    rest = records.where(~F.col("warc_type").isin(*ROOTS)).join(_capture_of(records), "record_id")
    side = F.struct("record_id", "warc_type", "target_uri", "warc_date", "body")
    parts = rest.groupBy("capture_id").agg(
        *[F.min(F.when(F.col("warc_type") == kind, side)).alias(kind) for kind in ("request", "metadata")],
        *[F.count(F.when(F.col("warc_type") == kind, 1)).alias(name)
          for kind, name in (("request", "n_requests"), ("metadata", "n_metadata"))])
    roots = records.where(F.col("warc_type").isin(*ROOTS)).select(F.col("record_id").alias("capture_id"), fields.alias("response"))
    return roots.join(parts, "capture_id", "left").withColumns(
        {n: F.coalesce(n, F.lit(0)) for n in ("n_requests", "n_metadata")})


def leftovers(records: DataFrame, captures: DataFrame) -> DataFrame:
    """The records that no row of ``captures`` shows."""
    used = captures.select(F.explode(F.array("response.record_id", "request.record_id", "metadata.record_id"))
                           .alias("record_id")).where("record_id is not null")
    return records.join(used, "record_id", "left_anti")


def page_captures(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of captures of pages; those
    of a revisit come from the response it refers to."""
    found = F.regexp_extract(F.col("metadata.body").cast("string"), r"page-id: (-?[0-9]+)", 1)
    flat = cut_lineage(captures.select(
        "capture_id", F.when(found != "", found.cast("long")).alias("page_id"), "response.payload_bytes",
        "response.payload_digest", F.col("response.warc_type").alias("record_type"),
        F.col("response.refers_to").alias("target")), "warc-captures")
    plain = flat.where("target is null").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    full = flat.where("record_type = 'response'").select(
        F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("digest"))
    revisits = flat.where("target is not null").join(full, "target", "left").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    return plain.unionByName(revisits)
