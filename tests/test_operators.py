"""Operators on small frames with known results."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventloom.config import CaptureConfig, LogConfig
from eventloom.functions.redact import scrub_value
from eventloom.operators.dedupe import dedupe, with_fingerprint
from eventloom.operators.delivery import classify_outcomes, suppress_after_429, suppress_events
from eventloom.operators.events import from_fatals, from_messages
from eventloom.operators.gates import before_send, buffer_cap, first_n, last_n, sample
from eventloom.operators.logs import build_log_batches, interpolate_messages, stringify_context, to_log_wire
from eventloom.operators.payload import event_to_row, stringify_tags, to_error_payload
from eventloom.operators.reports import drop_report, merge_reports
from eventloom.operators.requests import collect_request_context
from eventloom.operators.scopes import apply_scope, layer_scopes
from eventloom.operators.scrub import scrub_event, scrub_fatal, scrub_fields
from eventloom.plans.capture import capture_errors, capture_logs
from eventloom.schemas import EVENT, ROUTING
from eventloom.session import scratch_path
from eventloom.sources.jsonl import event_lines, read_events_jsonl, write_events_jsonl
from eventloom.sources.sinks import build_error_bodies, deliver, null_sink, with_batch_key

T0 = dt.datetime(2026, 1, 1)
FULL = type(EVENT)(ROUTING.fields + EVENT.fields)


def event(seq, **changes):
    row = dict(
        event_id=seq, sender_id="s", flush_id="f", scope_id="c", seq=seq, type="Boom", message="m", file="a.php",
        line=10, level="error", environment="production", release=None, timestamp=T0, tags={}, context=None,
        stack_trace=[], breadcrumbs=[], partial=False)
    row.update(changes)
    return tuple(row[f.name] for f in FULL.fields)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), FULL)


def crumb(message, data=None):
    return dict(category="c", message=message, level="info", data=data or {}, timestamp=T0)


def test_dedupe(spark):
    df = events(spark, event(1), event(2), event(3), event(4, message="other", file="b.php", line=20))
    kept = dedupe(df, keep_dropped=False).orderBy("seq").collect()
    assert [(r["seq"], r["tags"].get("duplicate_count")) for r in kept] == [(1, "3"), (4, None)]
    verdicts = dedupe(df).orderBy("seq").collect()
    assert [r["drop_reason"] for r in verdicts] == [None, "dedup", "dedup", None]


def test_messages_of_a_flush_collapse(spark):
    raw = spark.createDataFrame([(1, "f", "one", T0), (2, "f", "two", T0), (3, "g", "three", T0)],
                                "seq long, flush_id string, message string, timestamp timestamp")
    msgs = from_messages(raw)
    assert dedupe(msgs, keep_dropped=False).count() == 2
    assert dedupe(with_fingerprint(msgs, fingerprint_message=True), keep_dropped=False).count() == 3


def test_cap_counts_duplicates_first(spark):
    df = events(spark, *[event(i, line=i // 3) for i in range(9)])
    out = dedupe(buffer_cap(df, 4))
    reasons = [r["drop_reason"] for r in out.orderBy("seq").collect()]
    assert reasons == [None, "dedup", "dedup", None] + ["buffer"] * 5
    assert drop_report(out).head().asDict()["dropped_buffer"] == 5


def _odd(spark):
    """Rows without a flush, without a type, and with equal seq."""
    rows = [event(i // 2, flush_id=None if i % 3 == 0 else f"f{i % 2}", line=i * i % 7, event_id=i) for i in range(200)]
    return with_fingerprint(events(spark, *rows)).withColumn(
        "drop_reason", F.when(F.col("event_id") % 11 == 0, "sampled")).select(
        "event_id", "flush_id", "seq", "fingerprint", "drop_reason")


@pytest.mark.parametrize("n", [25, 1500])
def test_null_groups_and_equal_seq(spark, n):
    df = _odd(spark)
    flushes, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.seq, r.event_id)):
        if r.drop_reason:
            want[r.event_id] = r.drop_reason
            continue
        seen = flushes.setdefault(r.flush_id, [])
        seen.append(r.fingerprint)
        want[r.event_id] = "buffer" if len(seen) > n else "dedup" if r.fingerprint in seen[:-1] else None
    out = dedupe(buffer_cap(df, n))
    assert out.count() == 200
    assert {r.event_id: r.drop_reason for r in out.collect()} == want
    kept = dedupe(buffer_cap(df, n, keep_dropped=False), keep_dropped=False)
    assert {r.event_id for r in kept.collect()} == {k for k, v in want.items() if v is None}
    firsts = first_n(df, n).groupBy("flush_id").count().collect()
    sizes = {r.flush_id: r["count"] for r in df.groupBy("flush_id").count().collect()}
    assert {r.flush_id: r["count"] for r in firsts} == {k: min(n, v) for k, v in sizes.items()}


def test_suppress_without_endpoint(spark):
    rows = spark.createDataFrame([(None, 1, 100), ("e", 2, 100), (None, 3, 105), ("e", 4, 105)],
                                 "endpoint string, seq long, s long")
    rows = rows.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    answers = spark.createDataFrame([(None, 2, 101, 429, 10)], "endpoint string, seq long, s long, status int, retry_after int")
    answers = answers.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    out = suppress_events(rows, answers)
    assert {(r.endpoint, r.seq): r.drop_reason for r in out.collect()} == {
        (None, 1): None, (None, 3): "rate_limit", ("e", 2): None, ("e", 4): None}


def test_hook_that_adds_a_column(spark):
    df = events(spark, event(1), event(2)).withColumn("drop_reason", F.when(F.col("seq") == 2, "sampled"))
    out = before_send(df, lambda rows: rows.withColumns({"team": F.lit("a"), "line": F.col("line").cast("string")}),
                      lambda d: d).orderBy("seq").collect()
    assert [(r["team"], r["line"], r["drop_reason"]) for r in out] == [("a", out[0]["line"], None), (None, None, "sampled")]


def test_json_is_kept_as_written(spark):
    texts = ['{}', '{"a":1.10,"token":"x","a":1e400,"b":{}}', '{ "plain" : 1.0 }', "oops", "5", None, '{"\\u0074oken":"x"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    out = scrub_fields(df, ["c"], ("token",), unreadable="broken").orderBy("i").collect()
    assert [r["c"] for r in out] == ['{}', '{"a":1.10,"token":"[REDACTED]","a":1e400,"b":{}}', '{ "plain" : 1.0 }', "[]", "[]",
                                     None, '{"token":"[REDACTED]"}']
    assert [r["broken"] for r in out] == [[], [], [], ["c"], ["c"], [], []]
    deep = spark.createDataFrame([('{"a":{"b":{"c":1}}}',)], "c string")
    assert scrub_fields(deep, ["c"], ("x",), depth=2).first()[0] == '{"a":{"b":[]}}'


def test_large_cap_and_last_n(spark):
    df = spark.range(5000).select(F.lit("f").alias("flush_id"), F.col("id").alias("seq"))
    assert buffer_cap(df, 1500, keep_dropped=False).count() == 1500
    out = buffer_cap(df, 1500)
    assert out.where("drop_reason = 'buffer'").agg(F.min("seq")).head()[0] == 1500
    tail = last_n(df.select(F.col("flush_id").alias("scope_id"), "seq"), 1200, value=F.col("seq"))
    assert tail.head()["breadcrumbs"] == list(range(3800, 5000))
    few = spark.createDataFrame([("s", i, {"k": w}) for i, w in enumerate("abcd")],
                                "scope_id string, seq long, data map<string,string>")
    assert [x["k"] for x in last_n(few, 3, value=F.col("data")).head()["breadcrumbs"]] == ["b", "c", "d"]


def test_sample_is_strict(spark):
    df = spark.range(1000).withColumnRenamed("id", "event_id")
    assert sample(df, 0.0, keep_dropped=False).count() == 0
    assert sample(df, 1.0, keep_dropped=False).count() == 1000
    assert sample(df, 0.5, draw=F.lit(0.5), keep_dropped=False).count() == 0
    half = sample(df, 0.5, portable=False, keep_dropped=False).count()
    assert 400 < half < 600


def test_payload_placeholders_and_caps(spark):
    frames = [dict(file="x", line=1, function="f", **{"class": "c"}, type="", in_app=True)] * 300
    df = events(
        spark, event(1, type="", message=" \t", file="", line=0, level="fatal"),
        event(2, type=" " * 255 + "x", message="y" * 2000, release="1" * 300, environment="e" * 200,
              stack_trace=frames, breadcrumbs=[crumb(str(i)) for i in range(60)]))
    a, b = [r["payload"] for r in to_error_payload(df).orderBy("seq").collect()]
    assert (a["type"], a["message"], a["file"], a["line"], a["level"], a["release"]) == (
        "<unknown>", "<no message>", "<unknown>", 1, "fatal", None)
    assert b["type"] == "<unknown>" and len(b["message"]) == 1000 and len(b["release"]) == 255
    assert len(b["environment"]) == 100 and len(b["stack_trace"]) == 250
    assert [c["message"] for c in b["breadcrumbs"]] == [str(i) for i in range(50)]
    body = json.loads(build_error_bodies(df, F.lit("https://h/p")).orderBy("seq").head()["body"])
    assert "release" not in body and body["timestamp"] == "2026-01-01T00:00:00+00:00"


def test_tags_as_text(spark):
    df = spark.range(1).select(F.struct(F.lit(True).alias("t"), F.lit(1.0).alias("d"),
                                        F.lit(None).cast("int").alias("n")).alias("tags"))
    assert stringify_tags(df).head()["tags"] == {"t": "true", "d": "1", "n": ""}


def test_fatals(spark):
    raw = spark.createDataFrame(
        [(1, "Call to undefined function x()", "a", 0), (1, "Allowed memory size of 1 bytes exhausted", "", 3),
         (2, "warning", "a", 1)], "errno int, message string, file string, line int").withColumn(
        "timestamp", F.lit(T0))
    a, b = from_fatals(raw).orderBy("message", ascending=False).collect()
    assert (a["type"], a["level"], a["line"], a["partial"], a["tags"]) == ("E_ERROR", "fatal", 1, False, {})
    assert (b["partial"], b["tags"], b["file"]) == (True, {"oom": "true", "partial": "true"}, "<unknown>")


def test_scrub_event_boundaries(spark):
    df = events(spark, event(
        1, message="m ghp_a1", file="ghp_b2", type="ghp_c3", tags={"api_token": "x", "note": "ghp_d4"},
        breadcrumbs=[crumb("pk_e5", {"password": "p", "n": "1"})]))
    r = scrub_event(df, ("token", "password")).head()
    assert (r["message"], r["file"], r["type"]) == ("m [REDACTED]", "ghp_b2", "ghp_c3")
    assert r["tags"] == {"api_token": "[REDACTED]", "note": "ghp_d4"}
    assert r["breadcrumbs"][0]["message"] == "[REDACTED]"
    assert r["breadcrumbs"][0]["data"] == {"password": "[REDACTED]", "n": "1"}
    lean = scrub_fatal(df).head()
    assert (lean["file"], lean["tags"]["api_token"]) == ("[REDACTED]", "x")


def test_scrub_depth(spark):
    node = F.lit("deep")
    for i in range(20):
        node = F.struct(node.alias("n"))
    df = spark.range(1).select(node.alias("c"))
    text = df.select(F.to_json(scrub_value(F.col("c"), df.schema["c"].dataType, ("x",)))).head()[0]
    assert "deep" not in text
    nested = '{"a":' * 18 + "1" + "}" * 18
    js = spark.createDataFrame([(nested,), ("{}",), ("oops",), (None,), ("[1,{\"Token\":2}]",)], "c string")
    got = [r[0] for r in scrub_fields(js, ["c"], ("token",)).collect()]
    assert got == ['{"a":' * 16 + "[]" + "}" * 16, "{}", "[]", None, '[1,{"Token":"[REDACTED]"}]']


def test_before_send(spark):
    df = events(spark, event(1), event(2), event(3, message="drop"))
    def hook(rows):
        return rows.withColumn("keep", F.col("message") != "drop").withColumn(
            "message", F.when(F.col("seq") == 2, "ghp_new").otherwise(F.col("message")))
    out = before_send(df, hook, lambda d: scrub_event(d, ())).orderBy("seq").collect()
    assert [(r["message"], r["drop_reason"]) for r in out] == [
        ("m", None), ("[REDACTED]", None), ("drop", "before_send")]


def test_apply_scope(spark):
    df = events(spark, event(1, tags={"region": "us", "own": "1"}, breadcrumbs=[crumb("mine")]),
                event(2, scope_id="none"))
    scopes = spark.createDataFrame(
        [("c", {"region": "eu"}, {"id": "u1"}, {"order": "42"}, [crumb("theirs")])],
        "scope_id string, tags map<string,string>, user map<string,string>, extra map<string,string>, "
        + "breadcrumbs " + EVENT["breadcrumbs"].dataType.simpleString())
    a, b = apply_scope(df, scopes).orderBy("seq").collect()
    assert a["tags"] == {"region": "eu", "own": "1"}
    assert a["context"]["user"] == {"id": "u1"} and a["context"]["extra"] == {"order": "42"}
    assert [c["message"] for c in a["breadcrumbs"]] == ["mine", "theirs"]
    assert b["tags"] == {} and b["context"] is None


def test_layer_scopes(spark):
    rows = [("a", None, {"x": "1", "y": "1"}, {"id": "a"}, {}), ("b", "a", {"y": "2"}, {}, {"e": "b"}),
            ("c", "b", {"z": "3"}, {"id": "c"}, {})]
    df = spark.createDataFrame(rows, "scope_id string, parent_scope_id string, tags map<string,string>, "
                               "user map<string,string>, extra map<string,string>")
    out = {r["scope_id"]: r for r in layer_scopes(df, 2).collect()}
    assert out["c"]["tags"] == {"x": "1", "y": "2", "z": "3"} and out["c"]["user"] == {"id": "c"}
    assert out["b"]["user"] == {"id": "a"} and out["c"]["extra"] == {"e": "b"} and out["a"]["tags"] == rows[0][2]
    assert {r["scope_id"]: r["tags"] for r in layer_scopes(df).collect()} == {k: r["tags"] for k, r in out.items()}
    with pytest.raises(ValueError, match="ancestors"):
        layer_scopes(df, 1)
    ring = df.withColumn("parent_scope_id", F.when(F.col("scope_id") == "a", "c").otherwise(F.col("parent_scope_id")))
    with pytest.raises(ValueError, match="own ancestor"):
        layer_scopes(ring)


def test_layer_scopes_of_any_depth(spark):
    rows = [(f"s{i}", f"s{i - 1}" if i else None, {str(i): "x"}, {}, {}) for i in range(9)]
    df = spark.createDataFrame(rows, "scope_id string, parent_scope_id string, tags map<string,string>, "
                               "user map<string,string>, extra map<string,string>")
    out = {r["scope_id"]: r["tags"] for r in layer_scopes(df).collect()}
    assert set(out["s8"]) == set("012345678") and len(out) == 9


def test_request_context(spark):
    names = ("REQUEST_URI", "REQUEST_METHOD", "SERVER_NAME", "HTTP_HOST", "HTTP_USER_AGENT",
             "HTTP_X_FORWARDED_FOR", "HTTP_X_REAL_IP", "REMOTE_ADDR", "session_id")
    df = spark.createDataFrame(
        [("/checkout?token=abc&step=2", "post", "shop", "", None, None, None, "203.0.113.55", "s1")],
        ", ".join(f"{n} string" for n in names))
    out = collect_request_context(df, ("token",), "salt", "spark")
    c = out.head()["context"]
    assert (c["http_method"], c["ip_address"], c["url"]) == (
        "POST", "203.0.113.0", "/checkout?token=[REDACTED]&step=2")
    assert c["server"] == {"REQUEST_URI": c["url"], "REQUEST_METHOD": "post", "SERVER_NAME": "shop"}
    assert out.columns == ["context"]


def test_outcomes_and_retry_after(spark):
    df = spark.createDataFrame([(s,) for s in (202, 409, 400, 500, 429, None)], "status int")
    got = [(r["outcome"], r["failure_signal"]) for r in classify_outcomes(df).collect()]
    assert got == [("sent", False), ("sent", False), ("error", False), ("error", True),
                   ("rate_limit", False), ("error", True)]
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [("e", 1, at(0), 429, 30), ("e", 2, at(0), 202, None), ("e", 3, at(31), 202, None),
            ("e", 4, at(40), 429, 60), ("e", 5, at(40), 429, 2), ("e", 6, at(41.9), 202, None),
            ("e", 7, at(42), 202, None), ("e", 8, at(50), 429, 0), ("e", 9, at(50.9), 202, None),
            ("e", 10, at(51), 202, None)]
    df = spark.createDataFrame(rows, "endpoint string, seq long, ts timestamp, status int, retry_after int")
    out = suppress_after_429(df).orderBy("seq").collect()
    assert [r["seq"] for r in out if r["drop_reason"]] == [2, 5, 6, 9]


def test_log_wire_caps_and_fallback(spark):
    df = spark.createDataFrame(
        [(1, "INFO", "m" * 70000, {"k" * 256 + "a": "1", "k" * 256 + "b": "v" * 70000}, T0, "a" * 60, "e" * 80),
         (2, "info", "ok", {}, T0, "", None)],
        "seq int, level string, message string, context map<string,string>, timestamp timestamp, "
        "app_name string, environment string")
    bad = df.limit(1).withColumn("seq", F.lit(3)).withColumn("message", F.unhex(F.lit("ff41")).cast("string"))
    a, b, c = [r["wire"] for r in to_log_wire(df.unionByName(bad)).orderBy("seq").collect()]
    assert (len(a["message"]), len(a["app_name"]), len(a["environment"])) == (65536, 48, 64)
    assert a["context"] == {"k" * 256: "v" * 65536}
    assert (b["app_name"], b["environment"], b["context"]) == (None, None, None)
    assert (c["severity"], c["message"]) == ("info", "<unserializable log entry>")


def test_stringify_context(spark):
    values = F.struct(
        F.struct(F.lit("RuntimeException").alias("class"), F.lit("boom").alias("message")).alias("error"),
        F.create_map(F.lit("a"), F.lit("é/")).alias("nested"), F.lit(7).alias("user_id"), F.lit(True).alias("flag"))
    df = spark.range(1).select(values.alias("c"))
    dtype = df.schema["c"].dataType
    got = df.select(stringify_context(F.col("c"), dtype)).head()[0]
    assert got == {"error": "RuntimeException: boom", "nested": '{"a":"é\\/"}', "user_id": "7", "flag": "true"}
    got = df.select(stringify_context(F.col("c"), dtype, escape_unicode=True)).head()[0]
    assert got["nested"] == '{"a":"\\u00e9\\/"}'


def test_log_batches(spark):
    rows = spark.range(2500).select(
        F.lit("f").alias("flush_id"), F.col("id").alias("seq"), F.lit("info").alias("level"),
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("message"), F.lit(T0).alias("timestamp"),
        F.lit(None).cast("map<string,string>").alias("context"))
    out = with_batch_key(build_log_batches(to_log_wire(rows))).orderBy("batch_no").collect()
    assert [r["records"] for r in out] == [1000, 1000, 500]
    entries = json.loads(out[1]["body"])["logs"]
    assert [e["message"] for e in entries] == [f"m{i}" for i in range(1000, 2000)]
    assert all(len(r["batch_key"]) == 64 for r in out)


def test_capture_logs_counts(spark):
    rows = spark.range(150).select(
        F.lit("f").alias("flush_id"), F.col("id").alias("seq"), F.lit("info").alias("level"),
        F.lit("{password}").alias("message"), F.lit(T0).alias("timestamp"),
        F.create_map(F.lit("password"), F.lit("p")).alias("context"))
    cfg = LogConfig(endpoint="https://h", token="t")
    out = capture_logs(rows, cfg)
    report = out.report().head()
    assert (report["sent"], report["dropped_buffer"]) == (100, 50)
    first = json.loads(out.payloads.head()["body"])["logs"][0]
    assert first["message"] == "p" and first["context"] == {"password": "[REDACTED]"}
    safe = capture_logs(rows, LogConfig(endpoint="https://h", token="t", safe_interpolation=True))
    assert json.loads(safe.payloads.head()["body"])["logs"][0]["message"] == "[REDACTED]"
    off = capture_logs(rows, LogConfig()).report().head()
    assert (off["sent"], off["dropped_buffer"], off["dropped_disabled"]) == (0, 50, 100)
    assert capture_logs(rows, LogConfig()).payloads.count() == 0


def test_merge_reports(spark):
    mk = lambda *reasons: drop_report(spark.createDataFrame([(r,) for r in reasons], "drop_reason string"))
    out = merge_reports(mk("rate_limit", "rate_limit", "dedup"), mk("rate_limit", None)).head()
    assert (out["dropped_rate_limit"], out["dropped_dedup"], out["sent"]) == (3, 1, 1)


def test_capture_errors_with_hook_and_responses(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [event(i, line=i, timestamp=at(i), message=f"m{i} pk_x{i}") for i in range(1, 9)]
    df = events(spark, *rows).withColumn("endpoint", F.lit("e"))
    hook = lambda d: d.withColumn("keep", F.col("line") != 2).withColumn("file", F.lit("same.php"))
    responses = spark.createDataFrame([("e", 4, at(4), 429, 2)],
                                      "endpoint string, seq long, ts timestamp, status int, retry_after int")
    responses = responses.withColumn("seq", F.col("seq"))
    cfg = CaptureConfig(dsn="https://h/p", before_send=hook, events_per_second="1/100", burst=4)
    later = df.where("seq <> 4")
    out = capture_errors(later, None, cfg, responses)
    got = {r["seq"]: r["drop_reason"] for r in out.verdicts.collect()}
    assert got == {1: None, 2: "before_send", 3: None, 5: "rate_limit", 6: None, 7: None, 8: "rate_limit"}
    payload = out.payloads.orderBy("seq").head()["payload"]
    assert (payload["message"], payload["file"]) == ("m1 [REDACTED]", "same.php")


def test_closed_gate(spark):
    out = capture_errors(events(spark, event(1), event(2)), None, CaptureConfig(dsn="https://u@h/p"))
    assert out.report().head()["dropped_disabled"] == 2 and out.payloads.count() == 0


def test_jsonl(spark):
    df = events(spark, event(1, tags={}, breadcrumbs=[crumb("x")]), event(2, tags={"a": "é/"}))
    lines = [json.loads(r[0]) for r in event_lines(df).collect()]
    assert lines[0]["tags"] == [] and lines[0]["release"] is None and lines[0]["context"] == []
    assert lines[0]["breadcrumbs"][0]["data"] == [] and lines[1]["tags"] == {"a": "é/"}
    assert list(lines[0]) == ["type", "message", "file", "line", "level", "environment", "release", "timestamp",
                              "partial", "tags", "context", "stack_trace", "breadcrumbs"]
    path = scratch_path(spark, "test")
    write_events_jsonl(df, path)
    spark.createDataFrame([("oops",), ("",)], "value string").write.mode("append").text(path)
    back = read_events_jsonl(spark, path)
    assert back.where("_corrupt_record is not null").count() == 1
    good = back.where("_corrupt_record is null").collect()
    assert sorted(str(r["tags"]) for r in good) == ["{'a': 'é/'}", "{}"]
    assert event_to_row(df).columns == list(lines[0])


def test_sinks(spark):
    null_sink(spark.range(3))
    seen = []
    deliver(spark.range(3), lambda d: seen.append(d.count()))
    assert seen == [3]
    assert with_batch_key(spark.range(1).select(F.lit("b").alias("body")), random=True).where(
        F.col("batch_key").rlike("^[A-Za-z0-9_-]{16,128}$")).count() == 1


def test_interpolation_uses_raw_context(spark):
    df = spark.createDataFrame([("{token}", {"token": "t"})], "message string, context map<string,string>")
    assert interpolate_messages(df).head()["message"] == "t"
    assert interpolate_messages(df, ("token",)).head()["message"] == "[REDACTED]"


def test_config():
    cfg = CaptureConfig(dsn="https://h/p", api_key="k", sample_rate=3, max_buffered_events=0)
    assert (cfg.sample_rate, cfg.max_buffered_events, cfg.literals) == (1.0, 1, ("https://h/p", "k"))
    assert len(cfg.salt) == 32 and CaptureConfig(session_hash_salt="s").salt == "s"
    with pytest.raises(ValueError):
        CaptureConfig().salt


def test_capture_with_fingerprinted_messages(spark):
    df = events(spark, event(1, message="a"), event(2, message="b"), event(3, message="b"))
    out = capture_errors(df, None, CaptureConfig(dsn="https://h/p", fingerprint_message=True))
    assert [r["drop_reason"] for r in out.verdicts.orderBy("seq").collect()] == [None, None, "dedup"]
