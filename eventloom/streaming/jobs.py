"""Streaming forms of the operators that need no state of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CaptureConfig
from ..functions.net import dsn_parts
from ..operators.dedupe import with_fingerprint
from ..operators.gates import gate_enabled, sample
from ..operators.payload import to_error_payload
from ..operators.scrub import scrub_event


def stream_redact(events: DataFrame, cfg: CaptureConfig) -> DataFrame:
    """Gate, sample, scrub and shape events as they arrive (append mode, no state). Without a usable
    DSN nothing passes, as in the batch job."""
    dsn = dsn_parts(F.lit(cfg.dsn).cast("string"))
    kept = sample(gate_enabled(events, cfg.enabled, dsn, keep_dropped=False), cfg.sample_rate,
                  seed=cfg.sample_seed, keep_dropped=False)
    clean = scrub_event(kept, cfg.fragments, cfg.literals, cfg.max_scan_bytes)
    return to_error_payload(clean)


def stream_dedupe(
    events: DataFrame, window: str = "1 day", delay: str = "1 hour", ts: str = "ts",
    by: Sequence[str] = ("sender_id",),
) -> DataFrame:
    """Count and first event per fingerprint in tumbling windows of event time."""
    events = events if "fingerprint" in events.columns else with_fingerprint(events)
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, window), *by, "fingerprint")
        .agg(F.count(F.lit(1)).alias("events"), F.min_by("event_id", "seq").alias("first_event_id"))
        .select(F.col("window.start").alias("window_start"), *by, "fingerprint", "events",
                "first_event_id")
    )


def stream_first_only(
    events: DataFrame, delay: str = "1 hour", ts: str = "ts", by: Sequence[str] = ("sender_id",)
) -> DataFrame:
    """Pass on the first row per fingerprint within the watermark delay."""
    events = events if "fingerprint" in events.columns else with_fingerprint(events)
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*by, "fingerprint"])
