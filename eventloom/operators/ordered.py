"""Ordered scans: what is carried along the rows of a key, whatever share of all rows the key has.

Rows are range-partitioned by key and order at sampled splitters and sorted inside each partition, so a
large key simply covers several partitions. One pass folds every partition. What it can't know is the
state that the partitions before hand to its first key; it leaves that open and writes, beside its rows,
one small row with the states it ends in. Those rows, at most two a partition, are chained in partition
order, and meet the rows left open by a broadcast join. Nothing depends on a list of large keys, and no
task gets more than a partition. The folded table is written, so the pass runs once and a lost executor
re-reads files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

PART, END = "__part", "__end"


def tie_breaker(df: DataFrame, order: str = "seq") -> list[str]:
    """What orders rows of equal ``order``: the event_id where there is one."""
    return [c for c in ("event_id",) if c in df.columns and c != order]


def scan_ranges(
    df: DataFrame, order: Sequence[str], fold: Callable, added: Sequence[T.StructField], parts: int, label: str,
) -> DataFrame:
    """Run ``fold(part, batches)`` over sorted ranges and write what it yields.

    ``fold`` yields the input's columns followed by those of ``added``, which end with a row's
    partition and whether it is an end row.
    """
    fields = [T.StructField(f.name, f.dataType) for f in df.schema]
    schema = T.StructType([*fields, *added, T.StructField(PART, T.IntegerType()), T.StructField(END, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fold(TaskContext.get().partitionId(), batches)

    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return cut_lineage(ranged.mapInArrow(run, schema), label)


def range_count(df: DataFrame, rows: int, rows_per_slice: int) -> int:
    """Partitions for so many rows, no fewer than a shuffle has anyway."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_slice))


def differs(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one above it; true for the first."""
    out = np.ones(len(column), bool)
    above, below = column.slice(0, len(column) - 1), column.slice(1)
    unequal = pc.or_(pc.fill_null(pc.not_equal(above, below), False), pc.xor(pc.is_null(above), pc.is_null(below)))
    out[1:] = unequal.to_numpy(zero_copy_only=False)
    return out


def new_keys(columns: Sequence[pa.Array], before: tuple | None) -> np.ndarray:
    """Where the key in ``columns`` changes; ``before`` is the key above the first row."""
    out = reduce(np.logical_or, [differs(c) for c in columns])
    out[0] = before is None or before != tuple(c[0].as_py() for c in columns)
    return out


def _latest(flags: np.ndarray) -> np.ndarray:
    """Place of the last true flag up to each row, -1 for none."""
    return np.maximum.accumulate(np.where(flags, np.arange(len(flags)), -1))


class _Sum:
    """A total since the last reset, along one segment (the rows of a key in a partition).

    ``before`` counts from the segment's start, ``base`` is that count at the latest reset.
    """

    def __init__(self, name: str):
        self.amount, self.reset = f"__amount_{name}", f"__reset_{name}"
        self.total, self.mark = 0, None

    def step(self, batch: pa.RecordBatch, start: np.ndarray) -> list[pa.Array]:
        amount = batch.column(self.amount).to_numpy(zero_copy_only=False).astype(np.int64)
        reset = batch.column(self.reset).to_numpy(zero_copy_only=False).astype(bool)
        counted = np.cumsum(amount) - amount
        before = counted - np.where(start >= 0, counted[start], -self.total)
        latest = _latest(reset)
        held = np.append(-1, latest[:-1])
        after = before + amount
        inside = (held >= 0) & (held >= start)
        base, known = np.where(inside, after[held], 0), inside
        if self.mark is not None:
            carried = (start < 0) & ~inside
            base, known = np.where(carried, self.mark, base), inside | carried
        self._after, self._latest, self._start, self._mark = after, latest, start, self.mark
        return [pa.array(before), pa.array(base, mask=~known)]

    def at(self, i: int) -> tuple:
        """State after row i of the batch."""
        place = self._latest[i]
        if place >= 0 and place >= self._start[i]:
            mark = int(self._after[place])
        else:
            mark = self._mark if self._start[i] < 0 else None
        return int(self._after[i]), mark

    def now(self) -> tuple:
        return self.total, self.mark

    def move_to(self, i: int) -> None:
        self.total, self.mark = self.at(i)


class _Last:
    """The last value that is not null."""

    def __init__(self, name: str):
        self.value_column, self.value = f"__value_{name}", None

    def step(self, batch: pa.RecordBatch, start: np.ndarray) -> list[pa.Array]:
        values = batch.column(self.value_column)
        latest = _latest(values.is_valid().to_numpy(zero_copy_only=False))
        held = np.append(-1, latest[:-1])
        inside = (held >= 0) & (held >= start)
        out = values.take(pa.array(held, mask=~inside))
        if self.value is not None:
            out = pc.if_else(pa.array((start < 0) & ~inside), pa.scalar(self.value, values.type), out)
        self._values, self._latest, self._start, self._before = values, latest, start, self.value
        return [out]

    def at(self, i: int) -> tuple:
        place = self._latest[i]
        if place >= 0 and place >= self._start[i]:
            return (self._values[int(place)].as_py(),)
        return (self._before if self._start[i] < 0 else None,)

    def now(self) -> tuple:
        return (self.value,)

    def move_to(self, i: int) -> None:
        (self.value,) = self.at(i)


def fold_running(keys: Sequence[str], sums: Sequence[str], lasts: Sequence[str]) -> Callable:
    """Per row the state before it inside its segment; end rows have the state after the first and the last segment."""

    def fold(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [*[_Sum(n) for n in sums], *[_Last(n) for n in lasts]]
        key, first_open, schema, names = None, True, None, None

        def end_row(key: tuple, state: list) -> pa.RecordBatch:
            known = dict(zip(keys, key))
            given = [pa.array([known.get(f.name)], f.type) for f in schema]
            own = [pa.array([v], t) for v, t in zip(state, types)]
            return pa.RecordBatch.from_arrays(
                [*given, *own, pa.array([part], pa.int32()), pa.array([True])], names=names)

        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            columns = [batch.column(k) for k in keys]
            new = new_keys(columns, key)
            start = _latest(new)
            held = [x for p in parts for x in p.now()]
            own = [x for p in parts for x in p.step(batch, start)]
            if schema is None:
                schema, types = batch.schema, [x.type for x in own]
                names = [*schema.names, *_own_names(sums, lasts), PART, END]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *own, pa.array(np.full(size, part, np.int32)), pa.array(np.zeros(size, bool))], names=names)
            if first_open:
                cut = np.flatnonzero(new)
                cut = cut[cut > 0] if key is None else cut
                if len(cut):
                    j = int(cut[0])
                    state = held if j == 0 else [x for p in parts for x in p.at(j - 1)]
                    yield end_row(key if j == 0 else tuple(c[j - 1].as_py() for c in columns), state)
                    first_open = False
            for p in parts:
                p.move_to(size - 1)
            key = tuple(c[size - 1].as_py() for c in columns)
        if key is not None:
            yield end_row(key, [x for p in parts for x in p.now()])

    return fold


def _own_names(sums: Sequence[str], lasts: Sequence[str]) -> list[str]:
    return [*[f"__{part}_{n}" for n in sums for part in ("before", "base")], *[f"__own_{n}" for n in lasts]]


def carried(ends: DataFrame, keys: Sequence[str], sums: Sequence[str], lasts: Sequence[str]) -> DataFrame:
    """Per key and partition what the partitions before leave behind, from the end rows."""
    window = Window.partitionBy(*keys).orderBy(PART)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    first, second = {}, {}
    for name in sums:
        first[f"__sofar_{name}"] = F.coalesce(F.sum(f"__before_{name}").over(earlier), F.lit(0))
        # Amounts are never negative, so the total at the latest reset is the largest one.
        floor = F.max(F.col(f"__sofar_{name}") + F.col(f"__base_{name}")).over(earlier)
        second[f"__carry_{name}"] = F.col(f"__sofar_{name}") - F.coalesce(floor, F.lit(0))
    for name in lasts:
        first[f"__carry_{name}"] = F.last(f"__own_{name}", ignorenulls=True).over(earlier)
    ends = ends.withColumns(first) if first else ends
    ends = ends.withColumns(second) if second else ends
    return ends.select(*keys, PART, *[f"__carry_{n}" for n in [*sums, *lasts]])
