"""Analysis of delivery attempts: outcomes, suppression windows, failure runs, outages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gates import mark
from .slices import ROWS_PER_SLICE, running, without_nulls


def is_success(status: Column) -> Column:
    return F.coalesce(status.isin(202, 409), F.lit(False))


def is_failure_signal(status: Column) -> Column:
    """No answer, or one outside 4xx that is no success."""
    return ~is_success(status) & ~F.coalesce(status.between(400, 499), F.lit(False))


def classify_outcomes(df: DataFrame, status: str = "status") -> DataFrame:
    """Add ``outcome`` (sent, rate_limit, error) and ``failure_signal``; a null status stands for
    a request that got no answer."""
    code = F.col(status)
    outcome = (F.when(is_success(code), "sent").when(code == 429, "rate_limit").otherwise("error"))
    return df.withColumns({"outcome": outcome, "failure_signal": is_failure_signal(code)})


def outcome_summary(df: DataFrame, by: Sequence[str] = ("endpoint",), rows: str = "rows") -> DataFrame:
    """Attempts and records per outcome; a log batch counts all its records."""
    return df.groupBy(*by, "outcome").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum(rows).alias("records"),
        F.count_if("failure_signal").alias("failure_signals"),
    )


def suppress_after_429(
    df: DataFrame, endpoint: str = "endpoint", seq: str = "seq", ts: str = "ts",
    status: str = "status", retry_after: str = "retry_after", keep_dropped: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Drop rows that fall into the wait an earlier 429 asked for.

    Whole seconds are compared; a missing or non-positive wait means one second. The latest 429
    before a row decides, even when it asks for less than one before it.
    """
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    wait = F.when(F.col(retry_after) > 0, F.col(retry_after)).otherwise(F.lit(1))
    until = F.when(F.col(status) == 429, second + wait)
    out = running(
        df, [endpoint], seq, lasts={"suppressed_until": until}, rows_per_slice=rows_per_slice)
    return mark(out, second < F.col("suppressed_until"), "rate_limit", keep_dropped)


def suppress_events(
    events: DataFrame, responses: DataFrame, endpoint: str = "endpoint", seq: str = "seq",
    ts: str = "ts", rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Drop waiting events that fall into the wait a 429 among ``responses`` asked for.

    Both frames share endpoint, a common order ``seq`` and ts; responses add status and
    retry_after."""
    kept = [endpoint, seq, ts]
    line = events.select(
        *kept, F.lit(None).cast("int").alias("status"), F.lit(None).cast("int").alias("retry_after"),
        F.lit(True).alias("__event"),
    ).unionByName(responses.select(
        *kept, F.col("status").cast("int"), F.col("retry_after").cast("int"),
        F.lit(False).alias("__event")))
    judged = suppress_after_429(line, endpoint, seq, ts, rows_per_slice=rows_per_slice)
    # Rows without an endpoint share one; events of equal seq and time share their fate.
    hits = judged.where(F.col("__event") & F.col("drop_reason").isNotNull()).select(*kept).distinct()
    side, keys = without_nulls(hits, kept)
    rows, _ = without_nulls(events, kept)
    out = rows.join(side.select(*keys, F.lit(True).alias("__hit")), keys, "left").select(*events.columns, "__hit")
    return mark(out, F.col("__hit"), "rate_limit").drop("__hit")


def dropped_since_last_send(
    df: DataFrame, dropped: Column, sent: Column, attempted: Column, sender: str = "sender_id",
    seq: str = "seq", rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``reported_dropped``: drops since the sender's last success, told on each attempt and
    left null when there were none."""
    out = running(df, [sender], seq, {"__since": (dropped.cast("int"), sent)},
                  rows_per_slice=rows_per_slice)
    told = F.when(attempted & (F.col("__since") > 0), F.col("__since"))
    return out.withColumn("reported_dropped", told).drop("__since")


def failure_runs(
    df: DataFrame, threshold: int = 5, endpoint: str = "endpoint", seq: str = "seq",
    status: str = "status", rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``failure_run`` (failure signals since the last success, this row included),
    ``tripped`` and ``island`` (successes before this row). 4xx answers neither add nor reset."""
    code = F.col(status)
    good, bad = is_success(code), is_failure_signal(code)
    out = running(
        df, [endpoint], seq,
        {"__run": (bad.cast("int"), good), "island": (good.cast("int"), None)},
        rows_per_slice=rows_per_slice)
    run = F.when(good, F.lit(0)).otherwise(F.col("__run") + bad.cast("int")).cast("long")
    return out.withColumn("failure_run", run).withColumn(
        "tripped", F.col("failure_run") >= threshold).drop("__run")


def outage_intervals(
    runs: DataFrame, endpoint: str = "endpoint", ts: str = "ts", status: str = "status"
) -> DataFrame:
    """Outages per endpoint from ``failure_runs``: from the row that tripped to the success that
    closed the island (null while it lasts)."""
    success_ts = F.when(is_success(F.col(status)), F.col(ts))
    return (
        runs.groupBy(endpoint, "island")
        .agg(F.min(F.when(F.col("tripped"), F.col(ts))).alias("opened_at"),
             F.max(success_ts).alias("closed_at"),
             F.max("failure_run").alias("failures"))
        .where(F.col("opened_at").isNotNull())
    )
