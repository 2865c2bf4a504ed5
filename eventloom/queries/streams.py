"""Streaming jobs over the events and conversations tables, run until the input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CaptureConfig
from ..plans import views
from ..session import scratch_path
from ..streaming.jobs import stream_dedupe, stream_first_only, stream_redact
from ..streaming.stateful import failure_alerts, flush_log_batches, stream_log_batches, stream_throttle
from .registry import DL, EV, FP, query, throttle_sql


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, a gigabyte per micro-batch. The bracket makes the path a pattern, so
    it may be a file or a folder."""
    schema = views.table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", 1 << 30)
    return reader.parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def drain(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over all input there is and read what it wrote."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    (stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint")
     .trigger(availableNow=True).start(f"{path}/out", format="parquet").awaitTermination())
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


@query("stream_redact", f"""
WITH {EV}
SELECT event_id, message || CASE WHEN k % 4 = 0 THEN ' key [REDACTED]' ELSE '' END AS message,
       '[REDACTED]' AS api_token, CAST(greatest(1, line) AS BIGINT) AS line
FROM ev WHERE CAST(('0x' || substr(sha1(CAST(event_id AS VARCHAR) || ':s1'), 1, 8)) AS UBIGINT) % 1000000 < 500000""")
def redact(spark, sf):
    events = views.full_events(views.shape_events(source(spark, sf, "events")))
    cfg = CaptureConfig(dsn="https://ingest.example.com/proj1", sample_rate=0.5, sample_seed="s1")
    p = F.col("payload")
    return drain(stream_redact(events, cfg).select(
        "event_id", p["message"].alias("message"),
        F.try_element_at(p["tags"], F.lit("api_token")).alias("api_token"),
        p["line"].cast("long").alias("line")), "redact")


@query("stream_dedupe", f"""
WITH {EV}, fp AS (SELECT *, {FP} AS fingerprint FROM ev)
SELECT epoch_us(date_trunc('day', ts)) AS window_start, sender_id, fingerprint, count(*) AS events,
       min(event_id) AS first_event_id
FROM fp GROUP BY ALL""")
def dedupe(spark, sf):
    """All windows, as the last ones stay open when the input ends."""
    events = views.shape_events(source(spark, sf, "events"))
    counted = stream_dedupe(events)
    spark = counted.sparkSession
    path = scratch_path(spark, "dedupe")

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    (counted.writeStream.outputMode("update").option("checkpointLocation", f"{path}/checkpoint")
     .foreachBatch(replace).trigger(availableNow=True).start().awaitTermination())
    updates = spark.read.parquet(f"{path}/out")
    latest = F.max_by(F.struct("events", "first_event_id"), "batch")
    return updates.groupBy("window_start", "sender_id", "fingerprint").agg(latest.alias("l")).select(
        F.unix_micros("window_start").alias("window_start"), "sender_id", "fingerprint", "l.*")


@query("stream_first_only", f"""
WITH {EV}, fp AS (SELECT *, {FP} AS fingerprint FROM ev)
SELECT sender_id, fingerprint FROM fp GROUP BY ALL""")
def first_only(spark, sf):
    events = views.shape_events(source(spark, sf, "events"))
    kept = stream_first_only(events, delay="400 days")
    return drain(kept.select("sender_id", "fingerprint"), "first")


@query("stream_throttle", f"""
WITH RECURSIVE {EV}, {throttle_sql("ev", "sender_id", "ts", 1, 3_600_000_000, 3)}
SELECT seq AS event_id, allowed FROM walk""")
def throttle(spark, sf):
    events = views.shape_events(source(spark, sf, "events"))
    path = scratch_path(spark, "throttle")
    stream_throttle(events, path, f"{path}/checkpoint", rate="1/3600", burst=3, columns=["event_id"]).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("event_id", "allowed")


@query("failure_alerts", f"""
WITH {DL},
s AS (SELECT endpoint, seq, epoch_us(ts) // 1000000 AS second, status IN (202, 409) AS good FROM dl
      WHERE status IN (202, 409) OR status NOT BETWEEN 400 AND 499),
g AS (SELECT *, good OR second - lag(second) OVER (PARTITION BY endpoint ORDER BY seq) > 3600 AS cleared FROM s),
i AS (SELECT *, count(*) FILTER (WHERE cleared) OVER (PARTITION BY endpoint ORDER BY seq) AS island FROM g),
r AS (SELECT *, count(*) FILTER (WHERE NOT good) OVER (PARTITION BY endpoint, island ORDER BY seq) AS n FROM i)
SELECT endpoint, seq, n AS failures FROM r WHERE NOT good AND n = 2""")
def alerts(spark, sf):
    events = views.shape_events(source(spark, sf, "events"))
    path = scratch_path(spark, "alerts")
    failure_alerts(views.shape_attempts(events), path, f"{path}/checkpoint", 2).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("endpoint", "seq", "failures")


def _bodies_sql(size: int) -> str:
    return f"""
WITH n AS (
  SELECT role, conv_id * 1000 + turn AS seq, 'turn {{turn}} by {{role}}: {{missing}} ' || text AS message,
         row_number() OVER (PARTITION BY role ORDER BY conv_id * 1000 + turn) - 1 AS place,
         count(*) OVER (PARTITION BY role) AS total FROM conversations)
SELECT role, place < total // {size} * {size} AS full_batch, count(*) AS records,
       md5(string_agg(message, chr(10) ORDER BY seq)) AS messages
FROM n GROUP BY role, place // {size}, place < total // {size} * {size}"""


def _bodies(spark, sf, size: int) -> DataFrame:
    """Batches by the record's role, sent as they fill up and flushed at the end; the bodies are read back."""
    records = views.shape_logs(source(spark, sf, "conversations")).withColumn("role", F.col("context")["role"])
    path = scratch_path(spark, "batches")
    stream_log_batches(records, path, f"{path}/checkpoint", size, ("role",)).awaitTermination()
    sent = spark.read.parquet(f"{path}/out").drop("micro_batch").withColumn("full_batch", F.lit(True))
    rest = flush_log_batches(spark, path, records.schema, size, ("role",)).withColumn("full_batch", F.lit(False))
    messages = F.from_json("body", "logs array<struct<message:string>>")["logs"]["message"]
    return sent.unionByName(rest).select(
        F.substring_index("flush_id", "=", -1).alias("role"), "full_batch", "records",
        F.md5(F.array_join(messages, "\n")).alias("messages"))


@query("stream_log_batches", _bodies_sql(20))
def log_batches(spark, sf):
    return _bodies(spark, sf, 20)


@query("stream_log_batches_default", _bodies_sql(1000))
def log_batches_default(spark, sf):
    """The default size: most senders of a small table only have a remainder to flush."""
    return _bodies(spark, sf, 1000)
