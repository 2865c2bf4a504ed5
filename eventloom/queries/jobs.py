"""Whole capture jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CaptureConfig, LogConfig
from ..operators.reports import COUNTERS
from ..plans import views
from ..plans.capture import (
    capture_errors, capture_fatals, capture_logs, delivery_report, request_context_job)
from .deliveries import OUTAGES_SQL
from .events import COUNTERS_SQL, ERRNO_SQL, RAW_SQL, SAMPLE_SQL
from .logs import FILLED_SQL
from .redaction import CLEAN_SQL
from .registry import EV, FP, LOGS, query, throttle_sql

DSN = "https://ingest.example.com/proj1"

CAPTURED_SQL = f"""
RECURSIVE {EV},
sampled AS (SELECT *, {FP} AS fingerprint, CASE WHEN {SAMPLE_SQL} >= 900000 THEN 'sampled' END AS r1 FROM ev),
capped AS (
  SELECT *, CASE WHEN r1 IS NULL AND row_number() OVER (PARTITION BY flush_id, r1 IS NULL ORDER BY seq) > 30
                 THEN 'buffer' ELSE r1 END AS r2 FROM sampled),
deduped AS (
  SELECT *, CASE WHEN r2 IS NULL AND row_number() OVER (PARTITION BY flush_id, fingerprint, r2 IS NULL ORDER BY seq) > 1
                 THEN 'dedup' ELSE r2 END AS r3,
         count(*) OVER (PARTITION BY flush_id, fingerprint, r2 IS NULL) AS copies FROM capped),
waiting AS (SELECT * FROM deduped WHERE r3 IS NULL),
{throttle_sql("waiting", "sender_id", "ts", 1, 3_600_000_000, 3)},
judged AS (
  SELECT d.*, CASE WHEN r3 IS NULL AND NOT w.allowed THEN 'rate_limit' ELSE r3 END AS drop_reason
  FROM deduped d LEFT JOIN walk w ON w.seq = d.seq)"""


def _error_config(**changes):
    return CaptureConfig(
        dsn=DSN, sample_rate=0.9, sample_seed="s1", max_buffered_events=30,
        events_per_second="1/3600", burst=3, **changes)


def _errors(spark, sf):
    return capture_errors(
        views.full_events(views.ev(spark, sf)), views.scopes(spark, sf), _error_config())


@query("error_capture", f"""
WITH {CAPTURED_SQL}
SELECT event_id, type, message || CASE WHEN k % 4 = 0 THEN ' key [REDACTED]' ELSE '' END AS message,
       CAST(greatest(1, line) AS BIGINT) AS line, CASE WHEN copies > 1 THEN CAST(copies AS VARCHAR) END AS duplicate_count,
       '[REDACTED]' AS api_token, '[REDACTED]' AS auth_code, c_mktsegment AS segment,
       CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS user_name, '203.0.113.0' AS ip_address
FROM judged LEFT JOIN customer ON c_custkey = scope_id WHERE drop_reason IS NULL""")
def errors(spark, sf):
    p = F.col("payload")
    at = lambda col, key: F.try_element_at(col, F.lit(key))
    return _errors(spark, sf).payloads.select(
        "event_id", p["type"].alias("type"), p["message"].alias("message"),
        p["line"].cast("long").alias("line"), at(p["tags"], "duplicate_count").alias("duplicate_count"),
        at(p["tags"], "api_token").alias("api_token"),
        at(p["context"]["extra"], "auth_code").alias("auth_code"), at(p["tags"], "segment").alias("segment"),
        at(p["context"]["user"], "name").alias("user_name"), p["ip_address"].alias("ip_address"))


@query("error_capture_report", f"WITH {CAPTURED_SQL} SELECT {COUNTERS_SQL} FROM judged")
def errors_report(spark, sf):
    return _errors(spark, sf).report()


@query("error_capture_counters", f"WITH {CAPTURED_SQL} SELECT {COUNTERS_SQL} FROM judged")
def errors_counted(spark, sf):
    """The counters that were observed while the verdicts were written."""
    counters = _errors(spark, sf).counters
    return spark.createDataFrame([counters], ", ".join(f"{c} long" for c in COUNTERS)).select(*COUNTERS)


# Rows of type view stand for the answers of the collector, all others are captured.
ANSWERED_SQL = (
    CAPTURED_SQL
    .replace(f"{EV},", f"""{EV},
seen AS (
  SELECT * FROM (SELECT *, last_value(CASE WHEN type = 'view' THEN epoch_us(ts) // 1000000 + greatest(1, k * 60) END IGNORE NULLS)
      OVER (PARTITION BY sender_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM ev)
  WHERE type <> 'view'),""")
    .replace("'sampled' END AS r1 FROM ev)", "'sampled' END AS r1 FROM seen)")
    .replace("waiting AS (SELECT * FROM deduped WHERE r3 IS NULL)", """held AS (
  SELECT * REPLACE (CASE WHEN r3 IS NULL AND epoch_us(ts) // 1000000 < until THEN 'rate_limit' ELSE r3 END AS r3) FROM deduped),
waiting AS (SELECT * FROM held WHERE r3 IS NULL)""")
    .replace("FROM deduped d", "FROM held d"))


@query("error_capture_responses", f"WITH {ANSWERED_SQL} SELECT event_id, drop_reason FROM judged")
def errors_answered(spark, sf):
    """Events wait after a 429 of their endpoint, before they meet the throttle."""
    ev = views.ev(spark, sf)
    events = views.full_events(ev.where(F.col("type") != "view")).withColumn("endpoint", F.col("sender_id"))
    answers = views.shape_attempts(ev.where(F.col("type") == "view"))
    return capture_errors(events, None, _error_config(), responses=answers).verdicts.select("event_id", "drop_reason")


HOOKED_SQL = CAPTURED_SQL.replace("THEN 'sampled' END AS r1", "THEN 'sampled' WHEN line = 2 THEN 'before_send' END AS r1").replace(
    f"{FP} AS fingerprint", "sha1('hooked|' || file || '|' || CAST(line AS VARCHAR)) AS fingerprint")


def _hook(df):
    """Refuses some events, renames all others and leaves a secret for the second scrubbing."""
    return df.withColumns({
        "keep": F.col("line") != 2, "type": F.lit("hooked"),
        "message": F.concat("message", F.lit(" token ghp_"), F.col("event_id").cast("string"))})


@query("error_capture_hook", f"""
WITH {HOOKED_SQL}
SELECT event_id, 'hooked' AS type,
       message || CASE WHEN k % 4 = 0 THEN ' key [REDACTED]' ELSE '' END || ' token [REDACTED]' AS message
FROM judged WHERE drop_reason IS NULL""")
def errors_hooked(spark, sf):
    out = capture_errors(views.full_events(views.ev(spark, sf)), None, _error_config(before_send=_hook))
    return out.payloads.select("event_id", F.col("payload")["type"].alias("type"), F.col("payload")["message"].alias("message"))


# Rows of type error are captured; the others are breadcrumbs, and signups empty their scope.
TRAILED_SQL = CAPTURED_SQL.replace("'sampled' END AS r1 FROM ev)", "'sampled' END AS r1 FROM ev WHERE type = 'error')")


@query("error_capture_crumbs", f"""
WITH {TRAILED_SQL},
marked AS (
  SELECT *, count(*) FILTER (WHERE type = 'signup') OVER (PARTITION BY scope_id ORDER BY seq) AS era,
         count(*) FILTER (WHERE type NOT IN ('error', 'signup')) OVER (PARTITION BY scope_id ORDER BY seq) AS i FROM ev),
c AS (SELECT * FROM marked WHERE type NOT IN ('error', 'signup'))
SELECT e.event_id, count(c.seq) AS crumbs,
       coalesce(string_agg(c.type || ':' || c.seq || ':[REDACTED]', ',' ORDER BY c.seq), '') AS trail
FROM marked e JOIN judged j ON j.event_id = e.event_id AND j.drop_reason IS NULL
LEFT JOIN c ON c.scope_id = e.scope_id AND c.era = e.era AND c.i > e.i - 4 AND c.i <= e.i
GROUP BY e.event_id""")
def errors_trailed(spark, sf):
    """Each event carries the last four breadcrumbs of its scope, scrubbed with it."""
    ev = views.ev(spark, sf)
    crumb = F.struct(
        F.col("type").alias("category"), F.concat(F.col("seq").cast("string"), F.lit(":pk_"), F.col("k").cast("string")).alias("message"),
        F.lit("info").alias("level"), F.create_map(F.lit("password"), F.lit("x")).alias("data"), F.col("ts").alias("timestamp"))
    crumbs = ev.where(F.col("type") != "error").select("scope_id", "seq", crumb.alias("crumb"), (F.col("type") == "signup").alias("reset"))
    events = views.full_events(ev.where(F.col("type") == "error"))
    out = capture_errors(events, None, _error_config(max_breadcrumbs=4), crumbs=crumbs)
    held = F.col("payload")["breadcrumbs"]
    return out.payloads.select(
        "event_id", F.size(held).cast("long").alias("crumbs"),
        F.array_join(F.transform(held, lambda c: F.concat(c["category"], F.lit(":"), c["message"])), ",").alias("trail"))


def _log_config():
    return LogConfig(
        endpoint="https://logs.example.com/v1", token="sk_log_x", app_name="app", max_buffered_logs=70,
        batch_size=50)


@query("log_capture", f"""
WITH {LOGS}, n AS (SELECT *, row_number() OVER (PARTITION BY flush_id ORDER BY seq) - 1 AS i FROM logs),
kept AS (SELECT *, {FILLED_SQL} AS filled FROM n WHERE i < 70)
SELECT flush_id, i // 50 AS batch_no, count(*) AS records,
       '{{"logs":[' || string_agg('{{"severity":"' || CASE role WHEN 'user' THEN 'notice' WHEN 'assistant' THEN 'error' ELSE 'info' END
    || '","message":' || CAST(to_json(filled) AS VARCHAR) || ',"timestamp":"' || ts_text || '","app_name":"app","context":{{"role":"' || role
    || '","turn":"' || turn || '","auth_code":"[REDACTED]"}}}}', ',' ORDER BY seq) || ']}}' AS body
FROM kept GROUP BY flush_id, i // 50""")
def logs(spark, sf):
    return capture_logs(views.logs(spark, sf), _log_config()).payloads


@query("log_capture_report", f"""
WITH {LOGS}, n AS (SELECT *, row_number() OVER (PARTITION BY flush_id ORDER BY seq) AS i FROM logs),
judged AS (SELECT CASE WHEN i > 70 THEN 'buffer' END AS drop_reason FROM n)
SELECT {COUNTERS_SQL} FROM judged""")
def logs_report(spark, sf):
    return capture_logs(views.logs(spark, sf), _log_config()).report()


@query("fatal_capture", f"""
WITH {EV}, {RAW_SQL},
f AS (
  SELECT *, {ERRNO_SQL} AS kind, k % 9 = 0 AS partial FROM raw WHERE (errno & 341) <> 0),
g AS (
  SELECT *, sha1(kind || '|' || file || '|' || CAST(greatest(1, line) AS VARCHAR)) AS fingerprint,
         row_number() OVER (PARTITION BY flush_id ORDER BY seq) AS rn FROM f),
h AS (
  SELECT *, row_number() OVER (PARTITION BY flush_id, fingerprint ORDER BY seq) AS copy,
         count(*) OVER (PARTITION BY flush_id, fingerprint) AS copies FROM g WHERE rn <= 100)
SELECT event_id, kind AS type, 'fatal' AS level,
       CASE WHEN partial THEN 'Allowed memory size of 1 bytes exhausted [REDACTED]'
            WHEN trim(note, ' ' || chr(9)) = '' THEN '<no message>' ELSE note END AS message,
       CASE WHEN partial THEN 'true' END AS oom, CASE WHEN copies > 1 THEN CAST(copies AS VARCHAR) END AS duplicate_count,
       CASE WHEN NOT partial THEN c_mktsegment END AS segment
FROM h LEFT JOIN customer ON c_custkey = scope_id WHERE copy = 1""")
def fatals(spark, sf):
    cfg = CaptureConfig(dsn=DSN, events_per_second="1000", burst=1000)
    out = capture_fatals(views.raw_errors(spark, sf), views.scopes(spark, sf), cfg)
    p = F.col("payload")
    at = lambda key: F.try_element_at(p["tags"], F.lit(key)).alias(key)
    return out.payloads.select(
        "event_id", p["type"].alias("type"), p["level"].alias("level"), p["message"].alias("message"),
        at("oom"), at("duplicate_count"), at("segment"))


@query("request_context", f"""
WITH {CLEAN_SQL}
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '/own' ELSE nullif(url, '') END AS url,
       CASE WHEN page_id % 3 = 0 THEN 'POST' WHEN page_id % 3 = 1 THEN 'GET' END AS http_method, 'own' AS runtime
FROM scrubbed""")
def request_context(spark, sf):
    """Collected context under a context the rows already have."""
    rows = views.req(spark, sf)
    collected = request_context_job(rows, ("ref", "utm"), "salt", "spark")
    dtype = collected.schema["context"].dataType
    own = F.struct(*[
        (F.when(F.col("page_id") % 7 == 0, "/own") if f.name == "url"
         else F.lit("own") if f.name == "runtime" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in dtype.fields])
    out = request_context_job(rows.withColumn("context", own), ("ref", "utm"), "salt", "spark")
    return out.select("page_id", "context.url", "context.http_method", "context.runtime")


@query("delivery_report", f"""
WITH {OUTAGES_SQL},
t AS (SELECT endpoint, count(*) AS attempts, CAST(sum(CASE WHEN good THEN rows ELSE 0 END) AS BIGINT) AS sent,
             CAST(sum(CASE WHEN status = 429 THEN rows ELSE 0 END) AS BIGINT) AS dropped_rate_limit,
             CAST(sum(CASE WHEN NOT good AND status <> 429 THEN rows ELSE 0 END) AS BIGINT) AS dropped_error,
             max(failure_run) AS longest_run FROM r GROUP BY endpoint),
x AS (SELECT endpoint, count(opened_at) AS outages, count(*) FILTER (WHERE opened_at IS NOT NULL AND closed_at IS NULL) AS open_outages,
             CAST(coalesce(sum(closed_at - opened_at), 0) AS BIGINT) AS outage_micros FROM o GROUP BY endpoint)
SELECT t.*, outages, open_outages, outage_micros FROM t JOIN x USING (endpoint)""")
def deliveries(spark, sf):
    return delivery_report(views.attempts(spark, sf), 3)
