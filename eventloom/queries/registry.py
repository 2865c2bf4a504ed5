"""Registration of queries and the SQL shared by their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


EV = """
ev AS (
  SELECT event_id, event_id AS seq, ts, user_id,
         CAST(user_id % 8 AS VARCHAR) AS sender_id,
         CAST(user_id % 8 AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS flush_id,
         user_id AS scope_id, event_type AS type,
         'evt ' || CAST(event_id AS VARCHAR) AS message,
         'src/mod' || CAST(user_id % 4 AS VARCHAR) || '.php' AS file,
         CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k,
         CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) % 5 AS line,
         CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'warn' ELSE 'info' END AS level,
         value, props
  FROM events
)"""

FP = "sha1(type || '|' || file || '|' || CAST(line AS VARCHAR))"

DL = EV + """,
dl AS (
  SELECT sender_id AS endpoint, event_id, seq, ts,
         CASE type WHEN 'purchase' THEN 202 WHEN 'signup' THEN 409 WHEN 'view' THEN 429
                   WHEN 'click' THEN 400 ELSE 503 END AS status,
         k * 60 AS retry_after, CAST(k + 1 AS BIGINT) AS rows
  FROM ev
)"""

LOGS = """
logs AS (
  SELECT CAST(conv_id // 50 AS VARCHAR) AS flush_id, conv_id * 1000 + turn AS seq, conv_id, turn, role,
         CASE role WHEN 'user' THEN 'Notice' WHEN 'assistant' THEN 'ERROR' ELSE 'verbose' END AS level,
         'turn {turn} by {role}: {missing} ' || text AS message,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn), '%Y-%m-%dT%H:%M:%S+00:00') AS ts_text
  FROM conversations
)"""


def throttle_sql(source: str, key: str, ts: str, gain: int, token: int, burst: int) -> str:
    """CTEs ``walk`` (key, seq, allowed): a bucket per key followed row by row."""
    full = token * burst
    return f"""
numbered AS (
  SELECT {key} AS key, seq, epoch_us({ts}) AS us,
         row_number() OVER (PARTITION BY {key} ORDER BY seq) AS rn
  FROM {source}
),
walk(key, seq, rn, us, level, allowed) AS (
  SELECT key, seq, rn, us, CAST({full - token} AS BIGINT), true FROM numbered WHERE rn = 1
  UNION ALL
  SELECT key, seq, rn, us, CASE WHEN full_level >= {token} THEN full_level - {token} ELSE full_level END,
         full_level >= {token}
  FROM (
    SELECT n.key, n.seq, n.rn, n.us,
           CAST(least({full}, w.level + greatest(0, n.us - w.us) * {gain}) AS BIGINT) AS full_level
    FROM walk w JOIN numbered n ON n.key = w.key AND n.rn = w.rn + 1
  )
)"""
