"""Fingerprints, levels, gates, dedupe, reports, event shapes and payloads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.hashing import hmac_sha256
from ..functions.levels import errno_name, errno_severity, log_level, severity
from ..functions.text import empty_map
from ..operators.dedupe import IssueTable, dedupe, issue_rollup, with_fingerprint
from ..operators.events import from_exceptions, from_fatals, from_messages, from_raw_errors
from ..operators.gates import before_send, buffer_cap, gate_enabled, last_n, sample
from ..operators.payload import event_to_row, promote_context, stringify_tags, to_error_payload
from ..operators.reports import COUNTERS, drop_report, health_rollup, merge_reports, observed, rollup_reports
from ..operators.scrub import scrub_event
from ..plans import views
from ..session import scratch_path
from ..sources.delivery import body_sink, receipts, sink_stats
from ..sources.jsonl import read_events_jsonl, write_events_jsonl
from ..sources.sinks import build_error_bodies, null_sink
from .registry import EV, FP, query


@query("fingerprint", f"WITH {EV} SELECT event_id, {FP} AS fingerprint FROM ev")
def fingerprint(spark, sf):
    return with_fingerprint(views.ev(spark, sf)).select("event_id", "fingerprint")


@query("dedupe_flush", f"""
WITH {EV}, fp AS (SELECT *, {FP} AS fingerprint FROM ev)
SELECT flush_id, fingerprint, min(event_id) AS event_id,
       CASE WHEN count(*) > 1 THEN count(*) END AS duplicate_count
FROM fp GROUP BY flush_id, fingerprint""")
def dedupe_flush(spark, sf):
    kept = dedupe(with_fingerprint(views.ev(spark, sf)), keep_dropped=False)
    return kept.select("flush_id", "fingerprint", "event_id", "duplicate_count")


@query("dedupe_verdicts", f"""
WITH {EV}, fp AS (
  SELECT *, row_number() OVER (PARTITION BY flush_id, {FP} ORDER BY seq) AS rn,
         count(*) OVER (PARTITION BY flush_id, {FP}) AS n FROM ev)
SELECT event_id, CASE WHEN rn > 1 THEN 'dedup' END AS drop_reason,
       CASE WHEN rn = 1 AND n > 1 THEN n END AS duplicate_count FROM fp""")
def dedupe_verdicts(spark, sf):
    return dedupe(views.ev(spark, sf)).select("event_id", "drop_reason", "duplicate_count")


@query("dedupe_messages", """
SELECT CAST(doc_id // 100 AS VARCHAR) AS flush_id, sha1('message||0') AS fingerprint,
       min(doc_id) AS event_id, CASE WHEN count(*) > 1 THEN count(*) END AS duplicate_count
FROM documents GROUP BY ALL""")
def dedupe_messages(spark, sf):
    """Plain messages share one fingerprint, so each flush keeps a single one."""
    events = with_fingerprint(from_messages(views.msg(spark, sf)))
    return dedupe(events.drop("tags"), keep_dropped=False).select(
        "flush_id", "fingerprint", "event_id", "duplicate_count")


@query("issue_rollup", f"""
WITH {EV}, fp AS (SELECT *, {FP} AS fingerprint FROM ev)
SELECT sender_id AS project_id, fingerprint, count(*) AS events,
       epoch_us(min(ts)) AS first_seen, epoch_us(max(ts)) AS last_seen, min(event_id) AS first_event_id
FROM fp GROUP BY sender_id, fingerprint""")
def issues(spark, sf):
    ev = views.ev(spark, sf).withColumnRenamed("sender_id", "project_id")
    return issue_rollup(ev, ts="ts").withColumns({
        "first_seen": F.unix_micros("first_seen"), "last_seen": F.unix_micros("last_seen")})


@query("issue_table", f"""
WITH {EV}, fp AS (SELECT *, {FP} AS fingerprint FROM ev)
SELECT sender_id AS project_id, fingerprint, count(*) AS events,
       epoch_us(min(ts)) AS first_seen, epoch_us(max(ts)) AS last_seen, min(event_id) AS first_event_id
FROM fp GROUP BY sender_id, fingerprint""")
def issue_table(spark, sf):
    """The same rollup from a table that is added to, in four parts, one of them twice."""
    ev = views.ev(spark, sf).withColumnRenamed("sender_id", "project_id")
    table = IssueTable(spark, scratch_path(spark, "issues"))
    for part in (2, 0, 1, 3, 1):
        table.add(f"part-{part}", ev.where(F.col("user_id") % 4 == part), ts="ts")
    return table.issues().withColumns({
        "first_seen": F.unix_micros("first_seen"), "last_seen": F.unix_micros("last_seen")})


SAMPLE_SQL = "CAST(('0x' || substr(sha1(CAST(event_id AS VARCHAR) || ':s1'), 1, 8)) AS UBIGINT) % 1000000"

VERDICTS_SQL = f"""
gated AS (
  SELECT *, {FP} AS fingerprint,
         CASE WHEN sender_id = '7' THEN 'disabled' WHEN {SAMPLE_SQL} >= 800000 THEN 'sampled' END AS r1
  FROM ev),
capped AS (
  SELECT *, CASE WHEN r1 IS NULL AND row_number() OVER (
    PARTITION BY flush_id, r1 IS NULL ORDER BY seq) > 20 THEN 'buffer' ELSE r1 END AS r2 FROM gated),
judged AS (
  SELECT *, CASE WHEN r2 IS NULL AND row_number() OVER (
    PARTITION BY flush_id, fingerprint, r2 IS NULL ORDER BY seq) > 1 THEN 'dedup' ELSE r2 END AS drop_reason
  FROM capped)"""

COUNTERS_SQL = """
       count(*) FILTER (WHERE drop_reason IS NULL) AS sent,
       count(*) FILTER (WHERE drop_reason = 'sampled') AS dropped_sampled,
       count(*) FILTER (WHERE drop_reason = 'before_send') AS dropped_before_send,
       count(*) FILTER (WHERE drop_reason = 'disabled') AS dropped_disabled,
       count(*) FILTER (WHERE drop_reason = 'breaker') AS dropped_breaker,
       count(*) FILTER (WHERE drop_reason = 'budget') AS dropped_budget,
       count(*) FILTER (WHERE drop_reason = 'error') AS dropped_error,
       count(*) FILTER (WHERE drop_reason = 'rate_limit') AS dropped_rate_limit,
       count(*) FILTER (WHERE drop_reason = 'dedup') AS dropped_dedup,
       count(*) FILTER (WHERE drop_reason = 'buffer') AS dropped_buffer"""


def _verdicts(spark, sf):
    ev = with_fingerprint(views.ev(spark, sf)).select(
        "event_id", "sender_id", "flush_id", "seq", "fingerprint")
    gated = sample(gate_enabled(ev, F.col("sender_id") != "7"), 0.8, seed="s1")
    return dedupe(buffer_cap(gated, 20))


@query("gate_sample_verdicts", f"""
WITH {EV}, {VERDICTS_SQL} SELECT event_id, r1 AS drop_reason FROM gated""")
def gate_sample(spark, sf):
    ev = views.ev(spark, sf).select("event_id", "sender_id")
    return sample(gate_enabled(ev, F.col("sender_id") != "7"), 0.8, seed="s1").select(
        "event_id", "drop_reason")


@query("sample_by_column", f"""
WITH {EV} SELECT event_id, CASE WHEN (event_id * 7) % 10 >= 4 THEN 'sampled' END AS drop_reason FROM ev""")
def sample_by_column(spark, sf):
    """A column of the rows decides instead of the key."""
    ev = views.ev(spark, sf).select("event_id")
    return sample(ev, 0.4, draw=(F.col("event_id") * 7) % 10 / 10)


@query("null_sink_counters", f"WITH {EV}, {VERDICTS_SQL}, s AS (SELECT r1 AS drop_reason FROM gated) SELECT {COUNTERS_SQL} FROM s")
def null_sink_counters(spark, sf):
    """Rows that are computed and thrown away, counted on the way."""
    ev = views.ev(spark, sf).select("event_id", "sender_id")
    rows, observation = observed(sample(gate_enabled(ev, F.col("sender_id") != "7"), 0.8, seed="s1"))
    null_sink(rows)
    return spark.createDataFrame([observation.get], ", ".join(f"{c} long" for c in COUNTERS)).select(*COUNTERS)


@query("drop_report", f"WITH {EV}, {VERDICTS_SQL} SELECT {COUNTERS_SQL} FROM judged")
def report(spark, sf):
    return drop_report(_verdicts(spark, sf))


@query("report_rollup", f"""
WITH {EV}, {VERDICTS_SQL}
SELECT sender_id, flush_id, {COUNTERS_SQL} FROM judged GROUP BY ROLLUP (sender_id, flush_id)""")
def report_rollup(spark, sf):
    return rollup_reports(
        drop_report(_verdicts(spark, sf), ["sender_id", "flush_id"]), ["sender_id", "flush_id"])


@query("merge_reports", f"""
WITH {EV}, {VERDICTS_SQL}, judgements AS (
  SELECT r1 AS drop_reason FROM gated WHERE r1 IS NOT NULL
  UNION ALL SELECT drop_reason FROM judged WHERE r1 IS NULL)
SELECT {COUNTERS_SQL} FROM judgements""")
def merged(spark, sf):
    verdicts = _verdicts(spark, sf)
    early = F.coalesce(F.col("drop_reason").isin("disabled", "sampled"), F.lit(False))
    return merge_reports(drop_report(verdicts.where(early)), drop_report(verdicts.where(~early)))


@query("buffer_cap", f"""
WITH {EV}
SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY flush_id ORDER BY seq) > 20
                      THEN 'buffer' END AS drop_reason FROM ev""")
def cap(spark, sf):
    return buffer_cap(views.ev(spark, sf).select("event_id", "flush_id", "seq"), 20).select(
        "event_id", "drop_reason")


@query("buffer_cap_filter", f"""
WITH {EV}
SELECT event_id FROM ev QUALIFY row_number() OVER (PARTITION BY flush_id ORDER BY seq) <= 20""")
def cap_filter(spark, sf):
    return buffer_cap(views.ev(spark, sf), 20, keep_dropped=False).select("event_id")


@query("last_n", f"""
WITH {EV}, c AS (
  SELECT scope_id, seq, type, row_number() OVER (PARTITION BY scope_id ORDER BY seq DESC) AS rn
  FROM ev WHERE type <> 'error')
SELECT scope_id, string_agg(CAST(seq AS VARCHAR) || ':' || type, ',' ORDER BY seq) AS trail
FROM c WHERE rn <= 10 GROUP BY scope_id""")
def last(spark, sf):
    value = F.concat(F.col("seq").cast("string"), F.lit(":"), F.col("category"))
    kept = last_n(views.crumbs(spark, sf), 10, value=value, output="trail")
    return kept.withColumn("trail", F.array_join("trail", ","))


@query("severity", f"""
WITH {EV}, v AS (
  SELECT event_id, CASE k % 8 WHEN 0 THEN ' WARN ' WHEN 1 THEN 'critical' WHEN 2 THEN 'err' WHEN 3 THEN 'INFO'
    WHEN 4 THEN 'notice' WHEN 5 THEN 'Alert' WHEN 6 THEN 'emergency' ELSE level END AS raw FROM ev),
n AS (SELECT event_id, lower(trim(raw)) AS name FROM v)
SELECT event_id, CASE WHEN name = 'debug' THEN 'debug' WHEN name IN ('info', 'notice') THEN 'info'
  WHEN name IN ('warning', 'warn') THEN 'warning' WHEN name IN ('fatal', 'emergency', 'alert') THEN 'fatal'
  ELSE 'error' END AS severity FROM n""")
def severities(spark, sf):
    k = F.col("k") % 8
    raw = F.col("level")
    for i, word in enumerate((" WARN ", "critical", "err", "INFO", "notice", "Alert", "emergency")):
        raw = F.when(k == i, word).otherwise(raw)
    return views.ev(spark, sf).select("event_id", severity(raw).alias("severity"))


@query("log_level", f"""
WITH {EV}, v AS (
  SELECT event_id, CASE k % 6 WHEN 0 THEN 'WARNING' WHEN 1 THEN 'Debug' WHEN 2 THEN 'verbose' WHEN 3 THEN ''
    WHEN 4 THEN 'fatal' ELSE ' error' END AS raw FROM ev)
SELECT event_id, CASE WHEN lower(raw) IN ('debug', 'info', 'notice', 'warning', 'error', 'critical', 'alert',
  'emergency') THEN lower(raw) ELSE 'info' END AS log_level FROM v""")
def log_levels(spark, sf):
    k = F.col("k") % 6
    raw = F.lit(" error")
    for i, word in enumerate(("WARNING", "Debug", "verbose", "", "fatal")):
        raw = F.when(k == i, word).otherwise(raw)
    return views.ev(spark, sf).select("event_id", log_level(raw).alias("log_level"))


ERRNO_SQL = """
  CASE errno WHEN 1 THEN 'E_ERROR' WHEN 2 THEN 'E_WARNING' WHEN 4 THEN 'E_PARSE' WHEN 8 THEN 'E_NOTICE'
    WHEN 16 THEN 'E_CORE_ERROR' WHEN 64 THEN 'E_COMPILE_ERROR' WHEN 256 THEN 'E_USER_ERROR'
    WHEN 512 THEN 'E_USER_WARNING' WHEN 1024 THEN 'E_USER_NOTICE' WHEN 4096 THEN 'E_RECOVERABLE_ERROR'
    WHEN 8192 THEN 'E_DEPRECATED' WHEN 16384 THEN 'E_USER_DEPRECATED' ELSE 'E_UNKNOWN' END"""
ERRNO_LEVEL_SQL = """
  CASE WHEN errno IN (8, 1024, 2048, 8192, 16384) THEN 'info' WHEN errno IN (256, 4096) THEN 'error'
       ELSE 'warning' END"""
RAW_SQL = """
raw AS (
  SELECT *, CAST(power(2, k % 15) AS INTEGER) AS errno,
         CASE WHEN k % 9 = 0 THEN 'Allowed memory size of 1 bytes exhausted ghp_abc'
              WHEN k % 9 = 1 THEN ' ' || chr(9) ELSE message END AS note FROM ev)"""


@query("errno", f"""
WITH {EV}, {RAW_SQL}
SELECT event_id, {ERRNO_SQL} AS errno_name, {ERRNO_LEVEL_SQL} AS errno_severity FROM raw""")
def errno(spark, sf):
    return views.raw_errors(spark, sf).select(
        "event_id", errno_name(F.col("errno")).alias("errno_name"),
        errno_severity(F.col("errno")).alias("errno_severity"))


@query("raw_errors", f"""
WITH {EV}, {RAW_SQL}
SELECT event_id, {ERRNO_SQL} AS type, note AS message, file, CAST(line AS BIGINT) AS line,
       {ERRNO_LEVEL_SQL} AS level FROM raw WHERE (errno & 24575) <> 0 AND errno <> 8192""")
def raw(spark, sf):
    """All codes are reported but deprecations (8192)."""
    kept = from_raw_errors(views.raw_errors(spark, sf), 32767 & ~8192)
    return kept.select("event_id", "type", "message", "file", F.col("line").cast("long").alias("line"), "level")


@query("fatals", f"""
WITH {EV}, {RAW_SQL}
SELECT event_id, {ERRNO_SQL} AS type,
       CASE WHEN trim(note, ' ' || chr(9)) = '' THEN '<no message>' ELSE note END AS message,
       CAST(greatest(1, line) AS BIGINT) AS line, 'fatal' AS level, k % 9 = 0 AS partial,
       CASE WHEN k % 9 = 0 THEN 'true' END AS oom
FROM raw WHERE (errno & 341) <> 0""")
def fatals(spark, sf):
    return from_fatals(views.raw_errors(spark, sf)).select(
        "event_id", "type", "message", F.col("line").cast("long").alias("line"), "level", "partial",
        F.try_element_at("tags", F.lit("oom")).alias("oom"))


def _traced(spark, sf):
    frame = lambda i: F.struct(
        F.when(i % 3 == 0, F.lit("/app/vendor/x.php")).when(i % 3 == 1, F.lit("/app/src/y.php")).alias("file"),
        F.when(i % 4 != 0, i).alias("line"),
        F.when(i % 5 != 0, F.concat(F.lit("f"), i.cast("string"))).alias("function"),
        F.lit(None).cast("string").alias("class"))
    ev = views.ev(spark, sf).where(F.col("type") == "error")
    return ev.select(
        "event_id", F.lit("RuntimeException").alias("class"), "message", "file", "line",
        F.col("ts").alias("timestamp"),
        F.transform(F.sequence(F.lit(0), F.col("k") * 2), frame).alias("trace"))


TRACED_SQL = """
err AS (SELECT event_id, k, 2 * k + 1 AS n FROM ev WHERE type = 'error')"""


@query("exceptions_caught", f"""
WITH {EV}, {TRACED_SQL}
SELECT event_id, 'RuntimeException' AS type, 'error' AS level, CAST(least(n, 100) AS BIGINT) AS frames,
       CAST(len(list_filter(range(least(n, 100)), lambda i: i % 3 = 1)) AS BIGINT) AS own_frames,
       array_to_string(list_transform(range(least(n, 100)), lambda i: CASE WHEN i % 5 <> 0 THEN 'f' || i ELSE '' END), ',')
         AS functions,
       CAST(list_sum(list_transform(range(least(n, 100)), lambda i: CASE WHEN i % 4 <> 0 THEN i ELSE 0 END)) AS BIGINT) AS line_sum
FROM err""")
def exceptions_caught(spark, sf):
    events = from_exceptions(_traced(spark, sf))
    total = F.aggregate("stack_trace", F.lit(0), lambda a, f: a + f["line"])
    return events.select(
        "event_id", "type", "level", F.size("stack_trace").cast("long").alias("frames"),
        F.size(F.filter("stack_trace", lambda f: f["in_app"])).cast("long").alias("own_frames"),
        F.array_join(F.transform("stack_trace", lambda f: f["function"]), ",").alias("functions"),
        total.cast("long").alias("line_sum"))


@query("exceptions_uncaught", f"""
WITH {EV}, {TRACED_SQL}
SELECT event_id, CAST(least(n, 50) AS BIGINT) AS frames,
       array_to_string(list_transform(range(least(n, 50)),
         lambda i: CASE WHEN i % 5 <> 0 THEN 'f' || i ELSE '<unknown>' END), ',') AS functions,
       CAST(len(list_filter(range(least(n, 50)), lambda i: i % 4 = 0)) AS BIGINT) AS no_line
FROM err""")
def exceptions_uncaught(spark, sf):
    events = from_exceptions(_traced(spark, sf), caught=False)
    return events.select(
        "event_id", F.size("stack_trace").cast("long").alias("frames"),
        F.array_join(F.transform("stack_trace", lambda f: f["function"]), ",").alias("functions"),
        F.size(F.filter("stack_trace", lambda f: f["line"].isNull())).cast("long").alias("no_line"))


@query("error_payload", """
SELECT doc_id AS event_id, 'message' AS type,
       CASE WHEN trim(substr(text, 1, 1000), ' ' || chr(9) || chr(10) || chr(13) || chr(11)) = ''
            THEN '<no message>' ELSE substr(text, 1, 1000) END AS message,
       '<unknown>' AS file, CAST(1 AS BIGINT) AS line, 'info' AS level, 'backend' AS source,
       'production' AS environment, '1.4.2' AS release,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id), '%Y-%m-%dT%H:%M:%S+00:00') AS timestamp
FROM documents""")
def error_payload(spark, sf):
    shaped = to_error_payload(from_messages(views.msg(spark, sf), release="1.4.2"))
    p = F.col("payload")
    return shaped.select(
        "event_id", *[p[n].alias(n) for n in ("type", "message", "file")],
        p["line"].cast("long").alias("line"),
        *[p[n].alias(n) for n in ("level", "source", "environment", "release", "timestamp")])


@query("stringify_tags", f"""
WITH {EV}
SELECT event_id, regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') AS value,
       CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS even, '' AS missing,
       CAST(k AS VARCHAR) AS k FROM ev""")
def tags(spark, sf):
    typed = F.struct("value", (F.col("k") % 2 == 0).alias("even"),
                     F.lit(None).cast("string").alias("missing"), "k")
    shaped = stringify_tags(views.ev(spark, sf).select("event_id", typed.alias("tags")))
    return shaped.select("event_id", *[
        F.col("tags")[n].alias(n) for n in ("value", "even", "missing", "k")])


PROMOTE_SQL = f"""
WITH {EV}
SELECT event_id, CASE WHEN k % 2 = 0 THEN '/p/' || k END AS url,
       CASE WHEN k % 3 = 0 THEN 'POST' END AS http_method,
       CASE WHEN k % 4 IN (0, 1) THEN CASE WHEN k % 4 = 0 THEN '10.0.0.' || k ELSE '::' || k END END AS ip_address,
       CASE WHEN k % 2 = 0 THEN repeat('ab', 32) END AS session_hash,
       'host' || sender_id AS server_name, 'spark' AS runtime FROM ev"""


def _promotable(spark, sf):
    k = F.col("k")
    text = k.cast("string")
    return views.ev(spark, sf).select("event_id", "k", F.struct(
        F.when(k % 2 == 0, F.concat(F.lit("/p/"), text)).alias("url"),
        F.when(k % 3 == 0, "POST").when(k % 3 == 1, "post").otherwise("TRACE").alias("http_method"),
        F.when(k % 4 == 0, F.concat(F.lit("10.0.0."), text)).when(k % 4 == 1, F.concat(F.lit("::"), text))
        .when(k % 4 == 2, F.concat(F.lit("10.0.0.0"), text)).otherwise("fe80::1%eth0").alias("ip_address"),
        F.when(k % 2 == 0, F.repeat(F.lit("ab"), 32)).otherwise(F.repeat(F.lit("AB"), 32)).alias("session_hash"),
        F.lit("spark").alias("runtime"),
        F.create_map(F.lit("SERVER_NAME"), F.concat(F.lit("host"), F.col("sender_id"))).alias("server"),
    ).alias("context"))


PROMOTED = ("url", "http_method", "ip_address", "session_hash", "server_name", "runtime")


@query("promote_context", PROMOTE_SQL)
def promote(spark, sf):
    return promote_context(_promotable(spark, sf)).select("event_id", *PROMOTED)


@query("promote_context_json", PROMOTE_SQL)
def promote_json(spark, sf):
    """The same from JSON text, where a url that is a number must not be taken."""
    rows = _promotable(spark, sf)
    number = F.regexp_replace(F.to_json("context"), r"\A\{", F.concat(F.lit('{"url":'), F.col("k").cast("string"), F.lit(",")))
    text = F.when(F.col("k") % 2 == 0, F.to_json("context")).otherwise(number)
    return promote_context(rows.withColumn("context", text)).select("event_id", *PROMOTED)


# The salt is shorter than a block, so its pads are its bytes and zeros xor a constant.
PADS = {name: "".join(f"{b ^ mask:02x}" for b in b"my-test-salt".ljust(64, b"\0"))
        for name, mask in (("inner", 0x36), ("outer", 0x5C))}


@query("session_hash", f"""
SELECT event_id, sha256(unhex('{PADS["outer"]}') || unhex(sha256(
         unhex('{PADS["inner"]}') || encode('sess-' || CAST(user_id AS VARCHAR))))) AS session_hash
FROM events""")
def session_hash(spark, sf):
    session = F.concat(F.lit("sess-"), F.col("user_id").cast("string"))
    return views.ev(spark, sf).select(
        "event_id", hmac_sha256(session, "my-test-salt").alias("session_hash"))


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("health", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES) + """),
s AS (SELECT CASE WHEN n = 0 THEN 'fail' WHEN n < 100 THEN 'warn' ELSE 'ok' END AS status FROM c)
SELECT bool_and(status <> 'fail') AS healthy, count(*) FILTER (WHERE status = 'ok') AS ok_checks,
       count(*) FILTER (WHERE status = 'warn') AS warn_checks, count(*) FILTER (WHERE status = 'fail') AS fail_checks,
       count(*) FILTER (WHERE status = 'info') AS info_checks FROM s""")
def health(spark, sf):
    counts = [views.table(spark, sf, t).agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n"))
              for t in TABLES]
    status = F.when(F.col("n") == 0, "fail").when(F.col("n") < 100, "warn").otherwise("ok")
    checks = reduce(lambda a, b: a.unionByName(b), counts).select(
        "name", status.alias("status"), F.col("n").cast("string").alias("detail"))
    return health_rollup(checks)


@query("before_send", f"""
WITH {EV}
SELECT event_id, CASE WHEN k % 10 = 3 THEN 'before_send' END AS drop_reason,
       CASE WHEN k % 10 = 4 THEN 'hook added [REDACTED]'
            WHEN k % 4 = 0 THEN message || ' key [REDACTED]' ELSE message END AS message FROM ev""")
def hook(spark, sf):
    """A hook that drops some rows and writes a token into others, which is masked again."""
    def change(df):
        return df.withColumns({
            "keep": F.col("k") % 10 != 3,
            "message": F.when(F.col("k") % 10 == 4, "hook added ghp_fresh").otherwise(F.col("message")),
        })

    scrub = lambda df: scrub_event(df, ("token", "auth"))
    ev = views.ev(spark, sf)
    events = views.full_events(ev).join(ev.select("event_id", "k"), "event_id")
    return before_send(scrub(events), change, scrub).select("event_id", "drop_reason", "message")


@query("jsonl_roundtrip", f"""
WITH {EV}
SELECT type, message || CASE WHEN k % 4 = 0 THEN ' key ghp_' || CAST(seq AS VARCHAR) ELSE '' END AS message,
       file, CAST(line AS BIGINT) AS line, level, 'production' AS environment,
       CAST(epoch_us(ts) // 1000000 AS BIGINT) AS second, CAST(seq AS VARCHAR) AS api_token,
       '/evt?page=' || k || '&token=t' || seq AS url, CAST(k AS VARCHAR) AS extra_k, partial FROM
  (SELECT *, false AS partial FROM ev)""")
def jsonl(spark, sf):
    """Events written as JSON lines and read back."""
    path = scratch_path(spark, "jsonl")
    write_events_jsonl(views.full_events(views.ev(spark, sf)), path)
    return read_events_jsonl(spark, path).where(F.col("_corrupt_record").isNull()).select(
        "type", "message", "file", F.col("line").cast("long").alias("line"), "level", "environment",
        F.unix_seconds("timestamp").alias("second"), F.col("tags.api_token").alias("api_token"),
        F.col("context.url").alias("url"), F.col("context.extra.k").alias("extra_k"), "partial")


@query("event_rows", f"""
WITH {EV}
SELECT event_id, '{{"kind":"' || type || '","api_token":"' || seq || '"}}' AS tags, '[]' AS empty_tags,
       '["info",{{"k":"' || k || '"}},"' || strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') || '"]' AS crumb,
       strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamp FROM ev""")
def rows(spark, sf):
    """Maps as JSON text, an empty one as []; breadcrumbs with text timestamps."""
    ev = views.ev(spark, sf)
    crumb = F.struct(
        F.lit("c").alias("category"), F.lit("m").alias("message"), F.lit("info").alias("level"),
        F.create_map(F.lit("k"), F.col("k").cast("string")).alias("data"), F.col("ts").alias("timestamp"))
    events = views.full_events(ev).join(ev.select("event_id", crumb.alias("crumb")), "event_id")
    events = events.withColumn("breadcrumbs", F.array("crumb"))
    out = event_to_row(events.withColumn("type", F.col("event_id").cast("string")))
    none = event_to_row(events.withColumns({"tags": empty_map(), "type": F.col("event_id").cast("string")}))
    c = F.col("breadcrumbs")[0]
    text = F.concat(F.lit('["'), c["level"], F.lit('",'), F.to_json(c["data"]), F.lit(',"'), c["timestamp"], F.lit('"]'))
    return out.select(F.col("type").cast("long").alias("event_id"), "tags", text.alias("crumb"), "timestamp").join(
        none.select(F.col("type").cast("long").alias("event_id"), F.col("tags").alias("empty_tags")), "event_id")


@query("error_bodies", f"""
WITH {EV}
SELECT event_id, 'https://ingest.example.com:8443/api/v1/errors' AS url, 'proj1' AS project_id, true AS has_api_key,
       type, message || CASE WHEN k % 4 = 0 THEN ' key ghp_' || CAST(seq AS VARCHAR) ELSE '' END AS message,
       CAST(greatest(1, line) AS BIGINT) AS line, 'host' || sender_id AS server_name, CAST(64 AS BIGINT) AS key_length
FROM ev""")
def bodies(spark, sf):
    events = views.full_events(views.ev(spark, sf))
    out = build_error_bodies(events, F.lit("https://ingest.example.com:8443/proj1"), api_key="k1")
    fields = F.from_json("body", "type string, message string, line long, server_name string")
    return out.withColumn("f", fields).select(
        "event_id", "url", "project_id", "has_api_key", "f.*",
        F.length("batch_key").cast("long").alias("key_length"))


def _answers(rows: list[dict]) -> list[int | None]:
    """A collector of the queries: some bodies are refused, some known already, some get no answer."""
    return [(202, 202, 409, 503, None, 400)[row["event_id"] % 6] for row in rows]


_ANSWER_SQL = "[202, 202, 409, 503, NULL, 400][event_id % 6 + 1]"


def _sent(spark, sf, job: str) -> str:
    """Bodies of all events, written to the sink in two jobs, the first of them twice."""
    spark.dataSource.register(body_sink("eventloom_answers", _answers, ("event_id", "batch_key")))
    bodies = build_error_bodies(views.full_events(views.ev(spark, sf)), F.lit("https://ingest.example.com/proj1"))
    path = scratch_path(spark, "sink")
    for name in ("even", "odd", "even"):
        half = bodies.where(F.col("event_id") % 2 == int(name == "odd")).select("event_id", "batch_key", "body")
        half.write.format("eventloom_answers").option("job", f"{job}-{name}").mode("append").save(path)
    return path


@query("sink_receipts", f"""
WITH {EV}
SELECT event_id, CASE event_id % 2 WHEN 0 THEN 'r-even' ELSE 'r-odd' END AS job, CAST({_ANSWER_SQL} AS INTEGER) AS status,
       coalesce({_ANSWER_SQL} IN (202, 409), false) AS sent, true AS has_key FROM ev""")
def sink_receipts(spark, sf):
    path = _sent(spark, sf, "r")
    return receipts(spark, path, "event_id long, batch_key string").select(
        "event_id", "job", "status", "sent", F.col("batch_key").rlike("^[0-9a-f]{64}$").alias("has_key"))


@query("sink_stats", f"""
WITH {EV}
SELECT CASE event_id % 2 WHEN 0 THEN 's-even' ELSE 's-odd' END AS job,
       count(*) FILTER (WHERE coalesce({_ANSWER_SQL} IN (202, 409), false)) AS sent,
       count(*) FILTER (WHERE NOT coalesce({_ANSWER_SQL} IN (202, 409), false)) AS failed
FROM ev GROUP BY 1""")
def stats_of_sink(spark, sf):
    return sink_stats(spark, _sent(spark, sf, "s"))
