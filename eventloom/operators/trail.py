"""Breadcrumb trails: what a scope had recorded when an event was captured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import in_order
from ..session import cut_lineage
from .slices import ROWS_PER_SLICE, running


def attach_trail(
    events: DataFrame, crumbs: DataFrame, n: int = 50, scope: str = "scope_id", seq: str = "seq",
    crumb: Column | None = None, resets: DataFrame | None = None, output: str = "trail",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Give each event the last ``n`` breadcrumbs its scope held at capture, oldest first.

    ``seq`` orders events, breadcrumbs and ``resets`` (which empty a scope) of a scope together
    and is unique there. Breadcrumbs are numbered per scope and stored in blocks of ``n``; each
    block row also holds the block before it, so an event finds its whole trail in the one block
    of its latest breadcrumb. No event is ever paired with more than 2n breadcrumbs.
    """
    crumb = F.struct(*[c for c in crumbs.columns if c not in (scope,)]) if crumb is None else crumb
    items = crumbs.select(
        scope, seq, F.lit("crumb").alias("__kind"), crumb.alias("__crumb"))
    crumb_type = items.schema["__crumb"].dataType
    nothing = F.lit(None).cast(crumb_type).alias("__crumb")
    line = items.unionByName(events.select(scope, seq, F.lit("event").alias("__kind"), nothing))
    if resets is not None:
        line = line.unionByName(resets.select(scope, seq, F.lit("reset").alias("__kind"), nothing))

    line = line.where(F.col(scope).isNotNull())  # an event without a scope has no trail

    is_crumb = F.col("__kind") == "crumb"
    line = running(
        line, [scope], seq,
        {"__count": (is_crumb.cast("int"), None),
         "__held": (is_crumb.cast("int"), F.col("__kind") == "reset")},
        rows_per_slice=rows_per_slice)
    # Read three times below: written once instead of numbered three times.
    line = cut_lineage(line, "trail")

    here = F.floor(F.col("__count") / n)
    blocks = (
        line.where(is_crumb)
        .select(scope, F.struct(F.col("__count").alias("i"), F.col("__crumb").alias("c")).alias("__item"),
                F.explode(F.array(here, here + 1)).alias("__block"))
        .groupBy(scope, "__block")
        .agg(F.collect_list("__item").alias("__items"))
    )
    wanted = (
        line.where((F.col("__kind") == "event") & (F.col("__held") > 0))
        .select(scope, seq, "__count", F.least(F.col("__held"), F.lit(n)).alias("__take"),
                F.floor((F.col("__count") - 1) / n).alias("__block"))
        .dropDuplicates([scope, seq])  # an event delivered twice has one trail
    )
    found = wanted.join(blocks, [scope, "__block"])
    first = F.col("__count") - F.col("__take")
    held = F.filter("__items", lambda x: (x["i"] >= first) & (x["i"] < F.col("__count")))
    trail = in_order(held, crumb_type, "i", "c")
    trails = found.select(scope, seq, trail.alias(output))
    empty = F.array().cast(trails.schema[output].dataType)
    return events.join(trails, [scope, seq], "left").select(
        *events.columns, F.coalesce(output, empty).alias(output))
