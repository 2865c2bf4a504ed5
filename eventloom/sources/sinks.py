"""Request bodies and where they go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.net import dsn_parts, ingest_url
from ..operators.payload import to_error_payload

Sink = Callable[[DataFrame], None]

# The collector's paths.
ERROR_PATH = "/api/v1/errors"
BATCH_PATH = "/v1/logs/batch"


def with_batch_key(df: DataFrame, body: str = "body", random: bool = False) -> DataFrame:
    """Add an idempotency key. The default depends on the body only, so a recomputed task sends
    the same key again; ``random`` gives a UUID."""
    key = F.uuid() if random else F.sha2(F.col(body), 256)
    return df.withColumn("batch_key", key)


def build_error_bodies(
    df: DataFrame, dsn: Column, api_key: str | None = None, dropped: Column | None = None
) -> DataFrame:
    """One JSON body per event with its target URL. Events without a usable DSN are left out."""
    shaped = df if "payload" in df.columns else to_error_payload(df)
    routed = shaped.withColumn("__dsn", dsn_parts(dsn)).where(F.col("__dsn").isNotNull())
    keys = [c for c in ("event_id", "sender_id", "flush_id", "seq") if c in df.columns]
    bodies = routed.select(
        *keys,
        F.col("__dsn.project_id").alias("project_id"),
        ingest_url(F.col("__dsn"), ERROR_PATH).alias("url"),
        F.lit(api_key is not None).alias("has_api_key"),
        (F.lit(None).cast("long") if dropped is None else dropped).alias("reported_dropped"),
        F.to_json("payload").alias("body"))
    return with_batch_key(bodies)


def null_sink(df: DataFrame) -> None:
    """Compute every row and keep none."""
    df.write.format("noop").mode("overwrite").save()


def deliver(
    df: DataFrame, sink: Sink, checkpoint: str | None = None, trigger: dict | None = None
) -> StreamingQuery | None:
    """Hand a frame to a sink: at once for a table, per micro-batch for a stream. ``trigger`` takes
    the arguments of Spark's trigger; by default what is available is processed once."""
    if not df.isStreaming:
        sink(df)
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    return (df.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, _: sink(batch)).trigger(**(trigger or {"availableNow": True})).start())
