"""Whole jobs: errors, logs, fatals, request context and delivery reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CaptureConfig, LogConfig
from ..functions.net import dsn_parts, log_endpoint
from ..functions.redact import scrub_text
from ..functions.text import merge_maps
from ..operators.dedupe import dedupe, with_fingerprint
from ..operators.delivery import (
    classify_outcomes, failure_runs, is_success, suppress_events)
from ..operators.events import from_fatals
from ..operators.gates import (
    REASON, before_send, buffer_cap, first_n, gate_enabled, mark, sample, with_verdict)
from ..operators.logs import (
    build_log_batches, build_log_records, interpolate_messages, to_log_wire)
from ..operators.payload import merge_context, to_error_payload
from ..operators.reports import drop_report, observed
from ..operators.requests import collect_request_context
from ..operators.scopes import apply_scope
from ..operators.scrub import scrub_event
from ..operators.slices import ROWS_PER_SLICE, without_nulls
from ..operators.throttle import throttle
from ..operators.trail import attach_trail
from ..session import cut_lineage

KEYS = ("event_id", "sender_id", "flush_id", "seq")


@dataclass(frozen=True)
class Capture:
    """``verdicts`` has one narrow row per input row, ``payloads`` one per row that is sent.

    ``counters`` are the ten counters, counted while the verdicts were written (errors and fatals); a job
    on logs counts them with ``report``.
    """

    verdicts: DataFrame
    payloads: DataFrame
    counters: dict[str, int] | None = None

    def report(self, by: Sequence[str] = ()) -> DataFrame:
        return drop_report(self.verdicts, by)


def capture_errors(
    events: DataFrame, scopes: DataFrame | None, cfg: CaptureConfig,
    responses: DataFrame | None = None, lean_rows: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE, crumbs: DataFrame | None = None,
) -> Capture:
    """Gate, sample, scope, scrub, hook, buffer cap, dedupe, throttle and payload.

    With ``crumbs`` (scope_id, seq, crumb, optionally reset) each event gets the last
    ``max_breadcrumbs`` of its scope before it, behind its own and ahead of those of ``scopes``. Only
    rows that are sent meet them, unless a hook needs them earlier. Events are known
    by (event_id, flush_id, seq); null values match and rows that agree in all three are one delivery.

    Without a hook no verdict depends on scrubbed text, so verdicts are settled on a few narrow
    columns first and only the rows that are sent are joined to their scope and scrubbed.

    With ``lean_rows`` events marked partial skip sampling, scope and hook; only their message
    and file are scrubbed, and a closed gate drops them without counting them.
    """
    lean = F.coalesce(F.col("partial"), F.lit(False)) if lean_rows else F.lit(False)

    def scrub(df: DataFrame) -> DataFrame:
        return scrub_event(df, cfg.fragments, cfg.literals, cfg.max_scan_bytes)

    def enrich(df: DataFrame) -> DataFrame:
        full = df.where(~lean) if lean_rows else df
        if crumbs is not None:
            own = full.schema["breadcrumbs"].dataType
            is_reset = F.coalesce(F.col("reset"), F.lit(False)) if "reset" in crumbs.columns else F.lit(False)
            trailed = attach_trail(
                full, crumbs.where(~is_reset), cfg.max_breadcrumbs, crumb=F.col("crumb"),
                resets=crumbs.where(is_reset) if "reset" in crumbs.columns else None, output="__trail",
                rows_per_slice=rows_per_slice)
            full = trailed.withColumn("breadcrumbs", F.concat(
                F.coalesce("breadcrumbs", F.array().cast(own)), F.col("__trail").cast(own))).drop("__trail")
        full = scrub(full if scopes is None else apply_scope(full, scopes))
        return full.unionByName(df.where(lean)) if lean_rows else full

    dsn = dsn_parts(F.lit(cfg.dsn).cast("string"))
    base = with_verdict(events)
    if lean_rows:
        base = base.withColumns({
            c: F.when(lean, scrub_text(F.col(c), cfg.literals, cfg.max_scan_bytes))
            .otherwise(F.col(c)) for c in ("message", "file")})
        base = mark(base, lean & (F.lit(not cfg.enabled) | dsn.isNull()), "uncounted")
    base = gate_enabled(base, cfg.enabled, dsn)
    base = sample(base, cfg.sample_rate, seed=cfg.sample_seed, exempt=lean if lean_rows else None)
    hooked = cfg.before_send is not None
    if hooked:
        shown = F.col(REASON).isNull() & ~lean
        live = before_send(enrich(base.where(shown)), cfg.before_send, scrub)
        base = cut_lineage(
            live.unionByName(base.where(~shown), allowMissingColumns=True), "hooked")

    endpoint = [] if responses is None else ["endpoint"]
    printed = with_fingerprint(base, cfg.fingerprint_message)
    verdicts = printed.select(*KEYS, *endpoint, "timestamp", "fingerprint", REASON)
    verdicts = dedupe(buffer_cap(verdicts, cfg.max_buffered_events))
    verdicts = cut_lineage(verdicts, "verdicts")
    if responses is not None:
        verdicts = suppress_events(
            verdicts, responses.withColumnRenamed("ts", "timestamp"), ts="timestamp",
            rows_per_slice=rows_per_slice)
    verdicts = throttle(
        verdicts, "sender_id", cfg.events_per_second, cfg.burst, ts="timestamp",
        rows_per_slice=rows_per_slice)
    counted, observation = observed(verdicts)
    verdicts = cut_lineage(counted, "verdicts")

    place = ["event_id", "flush_id", "seq"]
    sent = verdicts.where(F.col(REASON).isNull()).select(*place, "duplicate_count").dropDuplicates(place)
    side, keys = without_nulls(sent, place)
    rows, _ = without_nulls(base.drop(REASON), place)
    rows = rows.join(side.drop(*place), keys).drop(*keys)
    rows = rows if hooked else enrich(rows)
    tag = F.create_map(F.lit("duplicate_count"), F.col("duplicate_count").cast("string"))
    rows = rows.withColumn("tags", F.when(
        F.col("duplicate_count").isNotNull(), merge_maps(F.col("tags"), tag)
    ).otherwise(F.col("tags")))
    payloads = to_error_payload(rows).select(*KEYS, "payload")
    return Capture(verdicts, payloads, observation.get)


def capture_logs(
    records: DataFrame, cfg: LogConfig, rows_per_slice: int = ROWS_PER_SLICE
) -> Capture:
    """Buffer cap, interpolation, scrubbing, wire form and batches of log records.

    ``records`` has flush_id, seq, level, message, context and timestamp. ``payloads`` holds one
    row per batch body.
    """
    enabled = log_endpoint(F.lit(cfg.endpoint).cast("string")).isNotNull() & F.lit(bool(cfg.token))
    # One first-n over narrow rows serves the verdicts, the batches and the places in them.
    buffered = cut_lineage(first_n(
        records.select("flush_id", "seq"), cfg.max_buffered_logs, place="__place"), "buffered")
    side, keys = without_nulls(buffered, ["flush_id", "seq"])
    side = side.groupBy(*keys).agg(F.min("__place").alias("__place"))
    rows, _ = without_nulls(records, ["flush_id", "seq"])
    joined = rows.join(side, keys, "left").drop(*keys)
    verdicts = mark(with_verdict(joined.select("flush_id", "seq", "__place")), F.col("__place").isNull(), "buffer")
    verdicts = mark(verdicts, ~enabled, "disabled").drop("__place")

    kept = joined.where(F.col("__place").isNotNull() & enabled)
    filled = interpolate_messages(kept, cfg.fragments if cfg.safe_interpolation else None)
    clean = build_log_records(
        filled, cfg.fragments, cfg.literals, cfg.app_name, cfg.environment, cfg.max_scan_bytes)
    batches = build_log_batches(to_log_wire(clean), cfg.batch_size, place="__place")
    return Capture(verdicts, batches)


def capture_fatals(
    raw: DataFrame, scopes: DataFrame | None, cfg: CaptureConfig,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> Capture:
    """Errors that ended a process, out-of-memory ones by the lean way. Both kinds share the
    buffer, the fingerprints and the throttle of their flush."""
    fatal = from_fatals(raw, cfg.environment, cfg.release)
    return capture_errors(fatal, scopes, cfg, lean_rows=True, rows_per_slice=rows_per_slice)


def with_collected_context(
    events: DataFrame, collector: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run a function that adds a ``collected`` context and lay it under the events' own."""
    return merge_context(collector(events), "collected")


def request_context_job(
    requests: DataFrame, fragments: Sequence[str], salt: str, runtime: str
) -> DataFrame:
    """Collected request context, under the event's own context where the rows carry one."""
    if "context" not in requests.columns:
        return collect_request_context(requests, fragments, salt, runtime)
    return with_collected_context(
        requests, lambda df: collect_request_context(df, fragments, salt, runtime, "collected"))


def delivery_report(
    attempts: DataFrame, threshold: int = 5, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Per endpoint: counters by outcome, longest failure run, outages and how long they lasted."""
    judged = classify_outcomes(attempts)
    runs = failure_runs(judged, threshold, rows_per_slice=rows_per_slice)
    islands = runs.groupBy("endpoint", "island").agg(
        F.count(F.lit(1)).alias("attempts"),
        *[F.sum(F.when(F.col("outcome") == o, F.col("rows")).otherwise(0)).alias(o)
          for o in ("sent", "rate_limit", "error")],
        F.max("failure_run").alias("run"),
        F.min(F.when(F.col("tripped"), F.col("ts"))).alias("opened_at"),
        F.max(F.when(is_success(F.col("status")), F.col("ts"))).alias("closed_at"))
    lasted = F.unix_micros(F.col("closed_at").cast("timestamp")) - F.unix_micros(
        F.col("opened_at").cast("timestamp"))
    opened = F.col("opened_at").isNotNull()
    return islands.groupBy("endpoint").agg(
        F.sum("attempts").alias("attempts"),
        F.sum("sent").alias("sent"),
        F.sum("rate_limit").alias("dropped_rate_limit"),
        F.sum("error").alias("dropped_error"),
        F.max("run").alias("longest_run"),
        F.count_if(opened).alias("outages"),
        F.count_if(opened & F.col("closed_at").isNull()).alias("open_outages"),
        F.coalesce(F.sum(F.when(opened, lasted)), F.lit(0)).alias("outage_micros"))
