"""Suppression windows, throttling, failure runs, outages and outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.delivery import (
    classify_outcomes, dropped_since_last_send, failure_runs, is_success, outage_intervals,
    outcome_summary, suppress_after_429, suppress_events)
from ..operators.throttle import throttle
from ..plans import views
from .registry import DL, EV, query, throttle_sql

UNTIL_SQL = """
  last_value(CASE WHEN status = 429 THEN epoch_us(ts) // 1000000 + greatest(1, retry_after) END IGNORE NULLS)
    OVER (PARTITION BY endpoint ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query("retry_suppress", f"""
WITH {DL}, u AS (SELECT *, {UNTIL_SQL} AS until FROM dl)
SELECT event_id, CASE WHEN epoch_us(ts) // 1000000 < until THEN 'rate_limit' END AS drop_reason FROM u""")
def retry(spark, sf):
    return suppress_after_429(views.attempts(spark, sf)).select("event_id", "drop_reason")


@query("suppress_events", f"""
WITH {DL}, u AS (SELECT *, {UNTIL_SQL} AS until FROM dl)
SELECT event_id, CASE WHEN epoch_us(ts) // 1000000 < until THEN 'rate_limit' END AS drop_reason
FROM u WHERE status = 503""")
def waiting(spark, sf):
    """Rows without an answer wait on the answers of the others."""
    rows = views.attempts(spark, sf)
    answered = rows.where(F.col("status") != 503).select("endpoint", "seq", "ts", "status", "retry_after")
    return suppress_events(rows.where(F.col("status") == 503), answered).select("event_id", "drop_reason")


@query("throttle", f"""
WITH RECURSIVE {EV}, {throttle_sql("ev", "sender_id", "ts", 1, 3_600_000_000, 3)}
SELECT seq AS event_id, CASE WHEN NOT allowed THEN 'rate_limit' END AS drop_reason FROM walk""")
def throttled(spark, sf):
    """One row per hour and sender, three at once."""
    ev = views.ev(spark, sf).select("event_id", "seq", "sender_id", "ts")
    return throttle(ev, rate="1/3600", burst=3).select("event_id", "drop_reason")


@query("throttle_ties", f"""
WITH RECURSIVE {EV}, {throttle_sql("ev", "sender_id", "ts", 1, 3_600_000_000, 3)}
SELECT seq AS event_id, CASE WHEN NOT allowed THEN 'rate_limit' END AS drop_reason FROM walk""")
def throttled_ties(spark, sf):
    """A hundred events in a row share one place; the event_id orders them."""
    ev = views.ev(spark, sf).select("event_id", F.floor(F.col("seq") / 100).alias("seq"), "sender_id", "ts")
    return throttle(ev, rate="1/3600", burst=3).select("event_id", "drop_reason")


@query("dropped_since", f"""
WITH {DL},
s AS (SELECT *, status IN (202, 409) AS good, count(*) FILTER (WHERE status IN (202, 409))
        OVER (PARTITION BY endpoint ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island FROM dl),
d AS (SELECT *, count(*) FILTER (WHERE NOT good)
        OVER (PARTITION BY endpoint, island ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM s)
SELECT event_id, nullif(n, 0) AS reported_dropped FROM d""")
def dropped(spark, sf):
    good = is_success(F.col("status"))
    out = dropped_since_last_send(
        views.attempts(spark, sf), ~good, good, F.lit(True), sender="endpoint")
    return out.select("event_id", "reported_dropped")


RUNS_SQL = f"""{DL},
s AS (SELECT *, status IN (202, 409) AS good, status NOT IN (202, 409) AND status NOT BETWEEN 400 AND 499 AS bad,
        count(*) FILTER (WHERE status IN (202, 409))
        OVER (PARTITION BY endpoint ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island FROM dl),
r AS (SELECT *, CASE WHEN good THEN 0 ELSE count(*) FILTER (WHERE bad)
        OVER (PARTITION BY endpoint, island ORDER BY seq) END AS failure_run FROM s)"""


@query("failure_runs", f"WITH {RUNS_SQL} SELECT event_id, failure_run, failure_run >= 3 AS tripped, island FROM r")
def runs(spark, sf):
    return failure_runs(views.attempts(spark, sf), 3).select("event_id", "failure_run", "tripped", "island")


OUTAGES_SQL = f"""{RUNS_SQL},
o AS (SELECT endpoint, island, epoch_us(min(ts) FILTER (WHERE failure_run >= 3)) AS opened_at,
             epoch_us(max(ts) FILTER (WHERE good)) AS closed_at, max(failure_run) AS failures
      FROM r GROUP BY endpoint, island)"""


@query("outages", f"""
WITH {OUTAGES_SQL} SELECT endpoint, island, opened_at, closed_at, failures FROM o WHERE opened_at IS NOT NULL""")
def outages(spark, sf):
    out = outage_intervals(failure_runs(views.attempts(spark, sf), 3))
    return out.withColumns({c: F.unix_micros(c) for c in ("opened_at", "closed_at")})


@query("outcomes", f"""
WITH {DL}, o AS (
  SELECT *, CASE WHEN status IN (202, 409) THEN 'sent' WHEN status = 429 THEN 'rate_limit' ELSE 'error' END AS outcome,
         status = 503 AS failure_signal FROM dl)
SELECT endpoint, outcome, count(*) AS attempts, CAST(sum(rows) AS BIGINT) AS records,
       count(*) FILTER (WHERE failure_signal) AS failure_signals FROM o GROUP BY endpoint, outcome""")
def outcomes(spark, sf):
    return outcome_summary(classify_outcomes(views.attempts(spark, sf)))
