"""Stages that decide whether a row is kept.

In verdict mode every row stays and the first stage that drops it fills ``drop_reason``; a row
with a null ``drop_reason`` has survived so far. In filter mode (``keep_dropped=False``) dropped
rows leave.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import DRAW_RANGE, fast_draw, portable_draw
from ..functions.levels import FATAL_MASK
from ..functions.text import in_order
from .ordered import tie_breaker
from .slices import ROWS_PER_SLICE, without_nulls

REASON = "drop_reason"


def with_verdict(df: DataFrame) -> DataFrame:
    return df if REASON in df.columns else df.withColumn(REASON, F.lit(None).cast("string"))


def mark(df: DataFrame, dropped: Column, reason: str, keep_dropped: bool = True) -> DataFrame:
    """Give rows without a reason ``reason`` where ``dropped`` holds (null counts as not dropped)."""
    hit = F.coalesce(dropped, F.lit(False))
    if not keep_dropped:
        return df.where(~hit)
    df = with_verdict(df)
    return df.withColumn(
        REASON, F.when(F.col(REASON).isNull() & hit, F.lit(reason)).otherwise(F.col(REASON)))


def gate_enabled(
    df: DataFrame, enabled: Column | bool = True, dsn: Column | None = None,
    keep_dropped: bool = True,
) -> DataFrame:
    """Drop everything while capturing is off or no usable DSN is set."""
    enabled = F.lit(enabled) if isinstance(enabled, bool) else enabled
    closed = ~enabled if dsn is None else ~enabled | dsn.isNull()
    return mark(df, closed, "disabled", keep_dropped)


def sample(
    df: DataFrame, rate: float, key: str = "event_id", seed: str = "0", portable: bool = True,
    draw: Column | None = None, exempt: Column | None = None, keep_dropped: bool = True,
) -> DataFrame:
    """Keep a row iff its draw is below ``rate``. The draw depends on the key alone, so a
    recomputed task decides the same way; ``draw`` (in [0,1)) replaces it. ``exempt`` rows stay."""
    if draw is not None:
        dropped = draw >= rate
    else:
        number = portable_draw(F.col(key), seed) if portable else fast_draw(F.col(key), seed)
        dropped = number >= round(rate * DRAW_RANGE)
    dropped = dropped if exempt is None else dropped & ~exempt
    return mark(df, dropped, "sampled", keep_dropped)


def before_send(
    df: DataFrame, hook: Callable[[DataFrame], DataFrame],
    rescrub: Callable[[DataFrame], DataFrame], keep_dropped: bool = True,
) -> DataFrame:
    """Run a user function over scrubbed rows. It may change columns and may add a boolean
    ``keep``; what it returns is scrubbed again. Rows already dropped are not shown to it."""
    df = with_verdict(df)
    shown = hook(df.where(F.col(REASON).isNull()))
    if "keep" in shown.columns:
        refused = ~F.coalesce(F.col("keep"), F.lit(False))
        shown = mark(shown, refused, "before_send", keep_dropped).drop("keep")
    shown = rescrub(shown)
    if not keep_dropped:
        return shown
    # The hook may add columns and change types; rows it didn't see have nothing there.
    types = dict(df.dtypes)
    unseen = df.where(F.col(REASON).isNotNull()).select(*[
        F.col(c) if types.get(c) == kind else F.lit(None).cast(shown.schema[c].dataType).alias(c)
        for c, kind in shown.dtypes])
    return shown.unionByName(unseen)


def drop_suppressed(df: DataFrame, mask: Column | int, errno: str = "errno") -> DataFrame:
    """Keep runtime errors whose code is in the reporting mask."""
    mask = F.lit(mask) if isinstance(mask, int) else mask
    return df.where(F.col(errno).bitwiseAND(mask) != 0)


def fatal_only(df: DataFrame, errno: str = "errno") -> DataFrame:
    return df.where(F.col(errno).bitwiseAND(F.lit(FATAL_MASK)) != 0)


#: Parts a group is dealt to before its first rows are found.
PARTS = 64


def first_n(
    df: DataFrame, n: int, group: str = "flush_id", order: str = "seq", descending: bool = False,
    place: str | None = None,
) -> DataFrame:
    """The first (or last) ``n`` rows of each group by ``order``, then event_id; rows without a group
    are a group. ``place`` names a column for the position in the group, from 0.

    A group is first dealt to parts, of which each keeps ``n`` rows, so that no task gets more than
    ``PARTS`` times ``n`` rows of a group.
    """
    columns = [order, *tie_breaker(df, order)]
    by = [F.desc(c) if descending else F.asc(c) for c in columns]
    part = F.pmod(F.xxhash64(*columns), F.lit(PARTS))
    rank = F.row_number()
    near = (df.withColumn("__part", part)
            .withColumn("__rank", rank.over(Window.partitionBy(group, "__part").orderBy(*by)))
            .where(F.col("__rank") <= n).drop("__part"))
    out = near.withColumn("__rank", rank.over(Window.partitionBy(group).orderBy(*by))).where(F.col("__rank") <= n)
    if place is not None:
        out = out.withColumn(place, F.col("__rank") - 1)
    return out.drop("__rank")


def is_large(df: DataFrame, groups: list[str], rows_per_slice: int) -> bool:
    """Whether some group has more rows than one task should sort; counting runs a job over the group columns."""
    most = df.groupBy(*groups).count().agg(F.max("count")).first()[0]
    return (most or 0) > rows_per_slice


def at_group(df: DataFrame, side: DataFrame, groups: list[str]) -> DataFrame:
    """Left join of ``side`` (unique on ``groups``) where null groups match; Spark's adaptive skew join
    splits the rows of large groups."""
    left, keys = without_nulls(df, groups)
    right, _ = without_nulls(side, groups)
    joined = left.join(right.drop(*groups), keys, "left")
    return joined.select(*df.columns, *[c for c in side.columns if c not in groups])


def buffer_cap(
    df: DataFrame, n: int = 100, group: str = "flush_id", order: str = "seq",
    keep_dropped: bool = True, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """A flush buffers its first ``n`` live rows; later ones are dropped ``buffer``.

    Rows are ordered by ``order``, then event_id; rows that agree in both are one delivery and share
    their fate. A window per flush ranks the rows; where a flush has more than ``rows_per_slice``, its last
    buffered place is found on narrow columns instead and met by its rows.
    """
    df = with_verdict(df)
    columns = [order, *tie_breaker(df, order)]
    alive = F.col(REASON).isNull()
    if not is_large(df, [group], rows_per_slice):
        if not keep_dropped:
            place = F.rank().over(Window.partitionBy(group).orderBy(*columns))
            return df.where(alive).withColumn("__place", place).where(F.col("__place") <= n).select(*df.columns)
        place = F.rank().over(Window.partitionBy(group, alive).orderBy(*columns))
        return mark(df.withColumn("__place", place), F.col("__place") > n, "buffer").select(*df.columns)
    live = df.where(alive).select(group, *columns)
    last = first_n(live, n, group, order).groupBy(group).agg(F.max(F.struct(*columns)).alias("__last"))
    joined = at_group(df, last, [group])
    out = mark(joined, F.struct(*columns) > F.col("__last"), "buffer", keep_dropped).select(*df.columns)
    return out if keep_dropped else out.where(F.col(REASON).isNull())


def last_n(
    df: DataFrame, n: int = 50, group: str = "scope_id", order: str = "seq",
    output: str = "breadcrumbs", value: Column | None = None,
) -> DataFrame:
    """The most recent ``n`` rows of each group as one array in their original order."""
    value = F.struct(*[c for c in df.columns if c != group]) if value is None else value
    kept = first_n(df.select(group, order, value.alias("__value")), max(1, n), group, order, True)
    items = F.collect_list(F.struct(F.col(order).alias("o"), F.col("__value").alias("v")))
    dtype = kept.schema["__value"].dataType
    return kept.groupBy(group).agg(in_order(items, dtype, "o", "v").alias(output))
