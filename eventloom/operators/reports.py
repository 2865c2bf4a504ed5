"""Counter reports and health rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .gates import REASON

# The reasons a row can be dropped for, in report order.
REASONS = (
    "sampled", "before_send", "disabled", "breaker", "budget",
    "error", "rate_limit", "dedup", "buffer",
)
COUNTERS = ("sent", *(f"dropped_{r}" for r in REASONS))


def counters(weight: Column | None = None) -> list[Column]:
    """The ten counters as aggregates; ``weight`` counts a row as many."""
    amount = F.lit(1) if weight is None else weight

    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast("long")

    counts = [count(F.col(REASON).isNull()).alias("sent")]
    return counts + [count(F.col(REASON) == r).alias(f"dropped_{r}") for r in REASONS]


def drop_report(df: DataFrame, by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """The ten counters, for the whole frame or per group."""
    return df.groupBy(*by).agg(*counters(weight)) if by else df.agg(*counters(weight))


def observed(df: DataFrame, name: str = "counters") -> tuple[DataFrame, Observation]:
    """The frame, and its ten counters once an action has run over all of it: ``observation.get``.

    They are counted while the rows are written, without a pass of their own.
    """
    observation = Observation(name)
    return df.observe(observation, *counters()), observation


def merge_reports(*reports: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counter-wise sum of several reports."""
    merged = reports[0]
    for other in reports[1:]:
        merged = merged.unionByName(other)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS]
    return merged.groupBy(*by).agg(*sums) if by else merged.agg(*sums)


def rollup_reports(reports: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counters per group with subtotals and the grand total."""
    return reports.rollup(*by).agg(*[F.sum(c).cast("long").alias(c) for c in COUNTERS])


def health_rollup(checks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Healthy means no failed check; warnings and notes do not count."""
    status = F.col("status")
    aggs = [F.coalesce(F.bool_and(status != "fail"), F.lit(True)).alias("healthy")]
    aggs += [F.count_if(status == s).alias(f"{s}_checks") for s in ("ok", "warn", "fail", "info")]
    return checks.groupBy(*by).agg(*aggs) if by else checks.agg(*aggs)
