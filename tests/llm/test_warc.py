import gzip
import io

import pytest

from eventloom.llm.warc import assemble, leftovers, page_captures, read_archives, records_of, write_archives
from eventloom.session import cut_lineage, scratch_path

PAGES = "page_id long, url string, html string"
BIG = "<p>ünï</p>" * 200
NASTY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nxxxxx" * 30
ROWS = [
    (1, "https://a.example/x?y=1", BIG), (2, "http://b.example", BIG), (3, None, None), (4, "u v\r\nX: y", ""),
    (5, "https://c.example/", NASTY), (6, "https://c.example/", NASTY), (7, "s", "short"), (8, "s", "short"),
    (9, "t", "x" * 1000), (10, "t", "x" * 1000), (11, "t", "y" * 999), (12, "t", "y" * 999), (13, "l", "z" * 3_000_000),
    (14, "q", BIG), (14, "q", BIG), (None, "n", "no id"),
]


def brute(rows):
    import hashlib

    out, groups = [], {}
    for i, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        groups.setdefault(data, []).append((-1 if page is None else page, i))
    for i, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        first = max(groups[data])
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), len(data) >= 1000 and first[1] != i, first[0]))
    return out


def round_trip(spark, pages, **kw):
    path = scratch_path(spark, "test-warc")
    write_archives(pages, path, **kw)
    return cut_lineage(read_archives(spark, path, with_payload=True)), path


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, PAGES)
    records, path = round_trip(spark, pages, captures_per_file=3)
    captures = cut_lineage(assemble(records))
    got = page_captures(captures).collect()
    want = brute(ROWS)
    key = lambda r: tuple(map(str, r))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest) for r in got], key=key) == sorted([w[:3] for w in want], key=key)
    single = [w for w in want if w[0] != 14]
    by = {r.page_id: r for r in got if r.page_id != 14}
    for page, _, _, revisit, first in single:
        assert (by[page].record_type, by[page].refers_to) == (("revisit", first) if revisit else ("response", None))
    # Rows that repeat the largest page_id: one response, the others revisit it.
    assert sorted((r.record_type, r.refers_to) for r in got if r.page_id == 14) == [("response", None), ("revisit", 14)]
    assert leftovers(records, captures).count() == 0
    for c in captures.collect():
        assert c.n_requests == c.n_metadata == 1 and c.request.warc_type == "request"
        if c.response.warc_type == "response":
            assert len(c.response.payload) == c.response.payload_bytes
    urls = {r.target_uri for r in records.select("target_uri").collect()}
    assert "u%20v%20%20X:%20y" in urls and "urn:page:3" in urls


def test_files_are_plain_warc(spark, tmp_path):
    path = str(tmp_path / "archives")
    write_archives(spark.createDataFrame(ROWS, PAGES).repartition(1), path)
    import pathlib

    files = list(pathlib.Path(path).glob("part-*"))
    kinds = [r["warc_type"] for f in files for r in records_of(gzip.open(f))]
    assert sorted(set(kinds)) == ["metadata", "request", "response", "revisit"] and len(kinds) == 3 * len(ROWS)


def test_links_over_other_records_and_leftovers(spark):
    schema = ("record_id string, warc_type string, target_uri string, warc_date string, concurrent_to array<string>, "
              "refers_to string, payload_bytes long, payload_digest string, body binary, payload binary")

    def row(name, kind, to=()):
        return (name, kind, "u", "d", list(to), None, 1, "x", b"", None)

    rows = [row("r1", "response"), row("q1", "request", ["r1"]), row("m1", "metadata", ["q1"]),
            row("r2", "response", ["q2"]), row("q2", "request"), row("m2", "metadata", ["r2"]), row("m3", "metadata", ["r2"]),
            row("lost", "metadata", ["nowhere"]), row("r3", "response"), row("info", "warcinfo")]
    records = cut_lineage(spark.createDataFrame(rows, schema))
    captures = assemble(records)
    got = {c.capture_id: (c.request and c.request.record_id, c.metadata and c.metadata.record_id, c.n_requests, c.n_metadata)
           for c in captures.collect()}
    assert got == {"r1": ("q1", "m1", 1, 1), "r2": ("q2", "m2", 1, 2), "r3": (None, None, 0, 0)}
    assert {r.record_id for r in leftovers(records, captures).collect()} == {"m3", "lost", "info"}
    assert assemble(cut_lineage(spark.createDataFrame([], schema))).count() == 0


def test_empty_table_and_extra_columns(spark):
    from pyspark.sql import functions as F

    records, _ = round_trip(spark, spark.createDataFrame([], PAGES))
    assert page_captures(assemble(records)).count() == 0
    extra = spark.createDataFrame(ROWS[:2], PAGES).withColumns({"digest": F.lit("x"), "bytes": F.lit(1), "payload": F.lit("p")})
    assert page_captures(assemble(round_trip(spark, extra)[0])).count() == 2


def test_broken_archives():
    with pytest.raises(ValueError):
        list(records_of(io.BytesIO(b"HTTP/1.1 200 OK\r\n\r\n")))
    with pytest.raises(ValueError):
        list(records_of(io.BytesIO(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nabc")))
