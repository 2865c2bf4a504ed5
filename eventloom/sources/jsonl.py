"""Event files: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.payload import event_to_row
from ..schemas import CONTEXT, EVENT_LINE

_MAP_DDL = "map<string,string>"


def _map_or_empty(col: Column) -> Column:
    """JSON text of a map, where [] stands for an empty one."""
    return F.from_json(F.when(col == "[]", "{}").otherwise(col), _MAP_DDL)


def read_events_jsonl(
    spark: SparkSession, path: str, context_schema: T.StructType | None = CONTEXT
) -> DataFrame:
    """Event lines as rows. A line that is no JSON object keeps its text in ``_corrupt_record``.

    ``context_schema=None`` leaves the context as JSON text.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    line = F.from_json("value", EVENT_LINE, options)
    raw = spark.read.text(path).where(F.col("value") != "").select(line.alias("e")).select("e.*")
    context = F.col("context")
    if context_schema is not None:
        context = F.from_json(
            F.when(context == "[]", "{}").otherwise(context), context_schema.simpleString())
    crumbs = F.transform("breadcrumbs", lambda c: c.withField("data", _map_or_empty(c["data"])))
    return raw.withColumns({
        "tags": _map_or_empty(F.col("tags")), "context": context, "breadcrumbs": crumbs})


def event_lines(df: DataFrame) -> DataFrame:
    """One column ``value`` with the JSON line of each event; empty maps are written as []."""
    rows = event_to_row(df)

    def crumb(c: Column) -> Column:
        data = F.coalesce(F.to_json(c["data"]), F.lit("[]"))
        return c.withField("data", F.parse_json(F.when(data == "{}", "[]").otherwise(data)))

    shaped = rows.withColumns({
        "tags": F.parse_json("tags"), "context": F.parse_json("context"),
        "breadcrumbs": F.transform("breadcrumbs", crumb)})
    return shaped.select(
        F.to_json(F.struct(*shaped.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_events_jsonl(df: DataFrame, path: str) -> None:
    event_lines(df).write.mode("append").text(path)
