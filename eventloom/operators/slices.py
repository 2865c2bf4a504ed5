"""Running totals and lookups that stay balanced when one key holds a large share of the rows.

Rows are counted by key first. Where no key has more than ``rows_per_slice`` rows, one window per key does;
otherwise the rows are scanned in ranges (``ordered``), which cuts large keys into partitions. Results
don't depend on the way taken.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import END, PART, carried, fold_running, range_count, scan_ranges, tie_breaker

ROWS_PER_SLICE = 4_000_000


def running(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    sums: Mapping[str, tuple[Column, Column | None]] | None = None,
    lasts: Mapping[str, Column] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add values accumulated over the earlier rows of each key, in order of ``seq``, then event_id.

    ``sums`` maps a name to (amount, reset): the amounts, none negative, of the rows before this
    one and after the last row where ``reset`` held. ``lasts`` maps a name to an expression: its
    last non-null value before this row. Counting the keys runs a job while the plan is built.
    """
    sums, lasts = dict(sums or {}), dict(lasts or {})
    columns = df.columns
    df, keys = without_nulls(df, keys)
    order = [seq, *tie_breaker(df, seq)]
    size = df.groupBy(*keys).count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    inputs = {}
    for name, (amount, reset) in sums.items():
        inputs[f"__amount_{name}"] = F.coalesce(amount.cast("long"), F.lit(0).cast("long"))
        inputs[f"__reset_{name}"] = F.coalesce(reset, F.lit(False)) if reset is not None else F.lit(False)
    for name, value in lasts.items():
        inputs[f"__value_{name}"] = value
    df = df.withColumns(inputs)
    if (size["most"] or 0) <= rows_per_slice:
        joined = _windows(df, keys, order, sums, lasts)
        carry = {name: F.lit(None) for name in [*sums, *lasts]}
    else:
        added = [T.StructField(f"__{part}_{n}", T.LongType()) for n in sums for part in ("before", "base")]
        added += [T.StructField(f"__own_{n}", df.schema[f"__value_{n}"].dataType) for n in lasts]
        scanned = scan_ranges(df, [*keys, *order], fold_running(keys, list(sums), list(lasts)), added,
                              range_count(df, size["rows"], rows_per_slice), "ranges")
        ends = carried(scanned.where(END), keys, list(sums), list(lasts))
        # At most two rows a partition.
        joined = scanned.where(~F.col(END)).join(F.broadcast(ends), [*keys, PART], "left")
        carry = {name: F.col(f"__carry_{name}") for name in [*sums, *lasts]}
    out = {}
    for name in sums:
        own, base = F.col(f"__before_{name}"), F.col(f"__base_{name}")
        out[name] = F.when(base.isNotNull(), own - base).otherwise(
            own + F.coalesce(carry[name], F.lit(0))).cast("long")
    for name in lasts:
        out[name] = F.coalesce(F.col(f"__own_{name}"), carry[name])
    return joined.select(*columns, *[c.alias(name) for name, c in out.items()])


def without_nulls(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Stand-ins for the keys that are never null, as joins would not match null keys: rows
    without a key form a group like any other and may be large."""
    added = {}
    for i, key in enumerate(keys):
        dtype = df.schema[key].dataType
        plain = isinstance(dtype, (T.StringType, T.NumericType))
        value = F.col(key) if plain else F.col(key).cast("string")
        blank = F.lit(0).cast(dtype) if isinstance(dtype, T.NumericType) else F.lit("")
        added[f"__key{i}"] = F.coalesce(value, blank)
        added[f"__null{i}"] = F.col(key).isNull()
    return df.withColumns(added), list(added)


def _windows(df, keys, order, sums, lasts):
    """The same columns as a scan of ranges gives, by one window per key."""
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first, second = {}, {}
    for name, (_, reset) in sums.items():
        first[f"__before_{name}"] = F.coalesce(F.sum(f"__amount_{name}").over(earlier), F.lit(0))
        mark = F.when(F.col(f"__reset_{name}"), F.col(f"__before_{name}") + F.col(f"__amount_{name}"))
        # Amounts are never negative, so the total at the latest reset is the largest one.
        second[f"__base_{name}"] = F.lit(None).cast("long") if reset is None else F.max(mark).over(earlier)
    for name in lasts:
        first[f"__own_{name}"] = F.last(f"__value_{name}", ignorenulls=True).over(earlier)
    df = df.withColumns(first)
    return df.withColumns(second) if second else df


def numbered(
    df: DataFrame, keys: Sequence[str], seq: str, name: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add the zero-based position of each row within its key."""
    return running(df, keys, seq, {name: (F.lit(1), None)}, rows_per_slice=rows_per_slice)
