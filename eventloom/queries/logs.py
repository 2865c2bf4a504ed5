"""Log records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.logs import (
    build_log_batches, build_log_records, interpolate_messages, stringify_context, to_log_wire)
from ..plans import views
from ..sources.sinks import with_batch_key
from .registry import EV, LOGS, query

FILLED_SQL = "replace(replace(message, '{turn}', CAST(turn AS VARCHAR)), '{role}', role)"


@query("interpolate", f"WITH {LOGS} SELECT seq, {FILLED_SQL} AS message FROM logs")
def interpolated(spark, sf):
    return interpolate_messages(views.logs(spark, sf)).select("seq", "message")


@query("interpolate_safe", f"WITH {LOGS} SELECT seq, {FILLED_SQL} || ' with [REDACTED]' AS message FROM logs")
def interpolated_safe(spark, sf):
    """Where a message names a sensitive field, its masked value is filled in."""
    rows = views.logs(spark, sf).withColumn("message", F.concat("message", F.lit(" with {auth_code}")))
    return interpolate_messages(rows, ("auth",)).select("seq", "message")


@query("log_fallback", f"""
WITH {LOGS}
SELECT seq, CASE WHEN turn % 3 = 1 THEN 'info' WHEN role = 'user' THEN 'notice' WHEN role = 'assistant' THEN 'error'
                 ELSE 'info' END AS severity,
       CASE WHEN turn % 3 = 1 THEN '<unserializable log entry>' ELSE message END AS message,
       CASE WHEN turn % 3 <> 1 THEN ts_text END AS timestamp FROM logs""")
def fallback(spark, sf):
    """Records whose text is no valid UTF-8 become a fixed entry."""
    broken = F.concat("message", F.lit(b"\xc3\x28").cast("string"))
    rows = views.logs(spark, sf).withColumn("message", F.when(F.col("turn") % 3 == 1, broken).otherwise(F.col("message")))
    w = F.col("wire")
    return to_log_wire(rows).select("seq", *[w[n].alias(n) for n in ("severity", "message", "timestamp")])


@query("log_wire", f"""
WITH {LOGS}
SELECT seq, CASE role WHEN 'user' THEN 'notice' WHEN 'assistant' THEN 'error' ELSE 'info' END AS severity,
       {FILLED_SQL} AS message, ts_text AS timestamp,
       'app' AS app_name, CAST(NULL AS VARCHAR) AS environment, role, '[REDACTED]' AS auth_code FROM logs""")
def wire(spark, sf):
    rows = build_log_records(interpolate_messages(views.logs(spark, sf)), ("auth",), app_name="app")
    w = F.col("wire")
    at = lambda key: F.try_element_at(w["context"], F.lit(key)).alias(key)
    return to_log_wire(rows).select(
        "seq", *[w[n].alias(n) for n in ("severity", "message", "timestamp", "app_name", "environment")],
        at("role"), at("auth_code"))


@query("stringify_context", f"""
WITH {EV}
SELECT event_id, CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS flag, CAST(k AS VARCHAR) AS number, '' AS missing,
       'IOError: ' || message AS error, '{{"path":"src\\/' || k || '","n":' || k || '}}' AS nested,
       '[' || k || ',' || line || ']' AS list FROM ev""")
def context(spark, sf):
    k = F.col("k")
    values = F.struct(
        (k % 2 == 0).alias("flag"), k.alias("number"), F.lit(None).cast("string").alias("missing"),
        F.struct(F.lit("IOError").alias("class"), F.col("message").alias("message")).alias("error"),
        F.struct(F.concat(F.lit("src/"), k.cast("string")).alias("path"), k.alias("n")).alias("nested"),
        F.array(k, F.col("line")).alias("list"))
    rows = views.ev(spark, sf).select("event_id", values.alias("context"))
    texts = rows.withColumn("context", stringify_context(F.col("context"), rows.schema["context"].dataType))
    return texts.select("event_id", *[
        F.try_element_at("context", F.lit(n)).alias(n)
        for n in ("flag", "number", "missing", "error", "nested", "list")])


@query("log_batches", f"""
WITH {LOGS}, n AS (
  SELECT *, (row_number() OVER (PARTITION BY flush_id ORDER BY seq) - 1) // 20 AS batch_no FROM logs),
b AS (
  SELECT flush_id, batch_no, count(*) AS records, '{{"logs":[' || string_agg(
    '{{"severity":"' || CASE role WHEN 'user' THEN 'notice' WHEN 'assistant' THEN 'error' ELSE 'info' END
    || '","message":' || CAST(to_json(message) AS VARCHAR) || ',"timestamp":"' || ts_text || '","context":{{"role":"' || role
    || '","turn":"' || turn || '","auth_code":"' || conv_id || '"}}}}', ',' ORDER BY seq) || ']}}' AS body
  FROM n GROUP BY flush_id, batch_no)
SELECT *, sha256(body) AS batch_key FROM b""")
def batches(spark, sf):
    return with_batch_key(build_log_batches(to_log_wire(views.logs(spark, sf)), 20))
