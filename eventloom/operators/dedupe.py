"""Deduplication by fingerprint and issue rollups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import fingerprint
from ..functions.text import merge_maps
from ..session import delete_folder, finished_folders
from .gates import REASON, at_group, is_large, mark, with_verdict
from .ordered import tie_breaker
from .slices import ROWS_PER_SLICE


def with_fingerprint(df: DataFrame, fingerprint_message: bool = False) -> DataFrame:
    """Add ``fingerprint``. The message is not part of it unless asked for, so all plain messages
    of a flush count as one."""
    message = F.col("message") if fingerprint_message else None
    return df.withColumn(
        "fingerprint", fingerprint(F.col("type"), F.col("file"), F.col("line"), message))


def dedupe(
    df: DataFrame, group: str = "flush_id", order: str = "seq", keep_dropped: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Keep the first live row per (group, fingerprint); with repeats it gains a
    ``duplicate_count``, also put into ``tags`` where that column exists.

    First is by ``order``, then event_id; rows that agree in both are one delivery and share their
    fate. Rows without a group are a group. A window finds the first place, behind ``buffer_cap`` without a
    shuffle of its own; where copies number more than ``rows_per_slice``, they are counted before the shuffle and meet
    their first place in a join.
    """
    df = df if "fingerprint" in df.columns else with_fingerprint(df)
    df = with_verdict(df)
    columns = [order, *tie_breaker(df, order)]
    live = F.col(REASON).isNull()
    head, copies = F.min(F.struct(*columns)), F.count(F.lit(1))
    rows = df if keep_dropped else df.where(live)
    # Fingerprints are counted only where a group is large.
    if is_large(df, [group], rows_per_slice) and is_large(df, [group, "fingerprint"], rows_per_slice):
        heads = df.where(live).groupBy(group, "fingerprint").agg(head.alias("__head"), copies.alias("__copies"))
        joined = at_group(rows, heads, [group, "fingerprint"])
    else:
        same = Window.partitionBy(group, "fingerprint", *([live] if keep_dropped else []))
        joined = rows.withColumns({"__head": head.over(same), "__copies": copies.over(same)})
    out = mark(joined, F.struct(*columns) > F.col("__head"), "dedup", keep_dropped).drop("__head")
    copies = F.when(F.col(REASON).isNull() & (F.col("__copies") > 1), F.col("__copies"))
    out = out.withColumn("duplicate_count", copies).drop("__copies")
    if "tags" in df.columns:
        tag = F.create_map(F.lit("duplicate_count"), F.col("duplicate_count").cast("string"))
        out = out.withColumn("tags", F.when(
            F.col("duplicate_count").isNotNull(), merge_maps(F.col("tags"), tag)
        ).otherwise(F.col("tags")))
    return out.select(*df.columns, "duplicate_count")


def issue_rollup(
    df: DataFrame, project: str = "project_id", order: str = "seq", ts: str = "timestamp",
    sample: str = "event_id",
) -> DataFrame:
    """Issues of a project: rows per fingerprint, first and last time seen, id of the first row
    (by ``order``, then id)."""
    df = df if "fingerprint" in df.columns else with_fingerprint(df)
    return df.groupBy(project, "fingerprint").agg(
        F.count(F.lit(1)).alias("events"),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
        F.min_by(sample, F.struct(*dict.fromkeys([order, sample]))).alias("first_event_id"),
    )


_ISSUE = ("events", "first_seen", "last_seen")


def _issue_parts(df: DataFrame, project: str, order: str, ts: str, sample: str) -> DataFrame:
    """Partial rollup of some rows, which merges with others."""
    df = df if "fingerprint" in df.columns else with_fingerprint(df)
    first = F.min(F.struct(F.col(order).alias("place"), F.col(sample).alias("event_id")))
    return df.groupBy(F.col(project).alias("project_id"), "fingerprint").agg(
        F.count(F.lit(1)).alias("events"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), first.alias("first"))


def _merge_issues(parts: DataFrame) -> DataFrame:
    return parts.groupBy("project_id", "fingerprint").agg(
        F.sum("events").alias("events"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.min("first").alias("first"))


class IssueTable:
    """The issue rollup of all days so far, kept in a folder that executors share.

    ``add`` reads the rows of one day only. Its partial rollup is stored under the day and merged with the
    table before it into the next version; a day that is added again replaces its part, and the version is then
    merged from the stored parts, never from rows. A version counts once it is written whole.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        return sorted(int(n) for n in finished_folders(self.spark, f"{self.path}/versions"))

    def days(self) -> list[str]:
        return sorted(finished_folders(self.spark, f"{self.path}/days"))

    def add(self, day: str, df: DataFrame, project: str = "project_id", order: str = "seq", ts: str = "timestamp",
            sample: str = "event_id") -> None:
        seen, versions = day in self.days(), self.versions()
        _issue_parts(df, project, order, ts, sample).write.mode("overwrite").parquet(f"{self.path}/days/{day}")
        part = self.spark.read.parquet(f"{self.path}/days/{day}")
        if seen or not versions:
            merged = [self.spark.read.parquet(f"{self.path}/days/{d}") for d in self.days()]
        else:
            merged = [self.spark.read.parquet(f"{self.path}/versions/{versions[-1]}"), part]
        number = versions[-1] + 1 if versions else 0
        _merge_issues(reduce(DataFrame.unionByName, merged)).write.mode("overwrite").parquet(f"{self.path}/versions/{number}")
        for old in versions[:-1]:  # the one before stays for those who read it
            delete_folder(self.spark, f"{self.path}/versions/{old}")

    def issues(self) -> DataFrame:
        """What ``issue_rollup`` gives for all rows added."""
        current = self.spark.read.parquet(f"{self.path}/versions/{self.versions()[-1]}")
        return current.select("project_id", "fingerprint", *_ISSUE, F.col("first.event_id").alias("first_event_id"))
