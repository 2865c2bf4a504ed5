"""Token-bucket throttling per key, exact for keys of any size.

A bucket starts full, refills with time up to its burst and pays one token per allowed row. All
arithmetic is on integers: with a rate of ``p/q`` tokens per microsecond one token is ``q`` units.

Two rows of a key that lie so far apart that an empty bucket fills up in between cut the key into
stretches that don't know of each other: each starts from a full bucket, and one of no more rows than the
burst is allowed as a whole. Only longer stretches are followed row by row.

Rows are scanned in ranges (``ordered``), so a large key covers several partitions. A partition doesn't know
the level its first key comes in with. What rows do to the bucket is a piecewise linear function of that
level; equal neighbours merge as rows are added, which keeps it at some tens of pieces, and it ends as soon
as it is constant, at the latest where a stretch ends. Rows up to there are the partition's head. One small
row a partition is chained, and the heads, each within one partition, are replayed from their true levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .gates import REASON, mark, with_verdict
from .ordered import END, PART, differs, new_keys, range_count, scan_ranges, tie_breaker
from .slices import ROWS_PER_SLICE


@dataclass(frozen=True)
class Bucket:
    """Units gained per microsecond, units per token and units of a full bucket."""

    gain: int
    token: int
    full: int

    @classmethod
    def of(cls, rate_per_second: str | int | Fraction, burst: int) -> Bucket:
        """The rate is taken as the nearest fraction with a denominator up to a million per second;
        a burst that doesn't fit 64-bit levels is refused while the plan is built."""
        rate = Fraction(rate_per_second).limit_denominator(1_000_000) / 1_000_000
        if burst < 1 or rate < 0 or (burst + 1) * rate.denominator >= 1 << 62 or rate.numerator >= 1 << 62:
            raise ValueError(f"rate {rate_per_second} and burst {burst} don't fit 64-bit levels")
        return cls(rate.numerator, rate.denominator, burst * rate.denominator)

    def refill(self, level: int, elapsed: int) -> int:
        return min(self.full, level + max(0, elapsed) * self.gain)


def replay(bucket: Bucket, level: int, last: int | None, times: list[int], levels: list[int] | None = None):
    """Decide rows in order from a level; returns decisions and the level and time afterwards.
    ``levels`` collects the level after each row."""
    allowed = []
    gain, token, full = bucket.gain, bucket.token, bucket.full
    for now in times:
        if last is not None and now > last:
            level = min(full, level + (now - last) * gain)
        last = now
        if level >= token:
            level -= token
            allowed.append(True)
        else:
            allowed.append(False)
        if levels is not None:
            levels.append(level)
    return allowed, level, last


def level_pieces(bucket: Bucket, times: list[int], pieces=None, last: int | None = None):
    """How the level after ``times`` depends on the level at the first row.

    Pieces are (start, slope, offset): from ``start`` up to the next piece the result is
    ``slope * level + offset``, with slope 0 or 1.
    """
    pieces = [(0, 1, 0)] if pieces is None else pieces
    token, full = bucket.token, bucket.full
    for now in times:
        gained = 0 if last is None else max(0, now - last) * bucket.gain
        last = now
        out: list[tuple[int, int, int]] = []

        def put(start, slope, offset):
            if not out or out[-1][1:] != (slope, offset):
                out.append((start, slope, offset))

        for i, (start, slope, offset) in enumerate(pieces):
            stop = pieces[i + 1][0] if i + 1 < len(pieces) else full + 1
            offset += gained
            if slope == 0:
                offset = min(full, offset)
                put(start, 0, offset - token if offset >= token else offset)
                continue
            # Below `pays` the row is refused; from `caps` on the bucket is full.
            pays, caps = token - offset, full - offset
            if start < min(stop, pays):
                put(start, 1, offset)
            low = max(start, pays)
            if low < min(stop, caps):
                put(low, 1, offset - token)
            low = max(start, caps)
            if low < stop:
                put(low, 0, full - token)
        pieces = out
    return pieces, last


def apply_pieces(pieces, level: int) -> int:
    slope, offset = 1, 0
    for start, s, o in pieces:
        if start > level:
            break
        slope, offset = s, o
    return slope * level + offset


class _Line:
    """The bucket of the open key: its level, or the head's function of the level it came in with."""

    def __init__(self, bucket: Bucket):
        self.bucket, self.level, self.pieces, self.last = bucket, None, None, None

    def full(self) -> None:
        self.at(self.bucket.full, None)

    def at(self, level: int, last: int | None) -> None:
        self.level, self.pieces, self.last = level, None, last

    def unknown(self) -> None:
        self.level, self.pieces, self.last = None, [(0, 1, 0)], None

    def take(self, times: list[int], levels: list[int] | None = None) -> tuple[int, list[bool]]:
        """How many rows belong to the head, and the decisions of the others."""
        head, allowed = 0, []
        while self.level is None and head < len(times):
            self.pieces, self.last = level_pieces(self.bucket, times[head:head + 1], self.pieces, self.last)
            head += 1
            if len(self.pieces) == 1 and self.pieces[0][1] == 0:
                self.level, self.pieces = self.pieces[0][2], None
        if self.level is not None:
            allowed, self.level, self.last = replay(self.bucket, self.level, self.last, times[head:], levels)
        return head, allowed

    def function(self) -> list[tuple[int, int, int]]:
        return self.pieces if self.level is None else [(0, 0, self.level)]


#: Elapsed time no two rows can have.
_NEVER = (1 << 63) - 1
_ADDED = [
    T.StructField("__allowed", T.BooleanType()), T.StructField("__head", T.BooleanType()), T.StructField("__after", T.LongType()),
    *[T.StructField(n, T.StringType()) for n in ("__first_key", "__last_key")],
    *[T.StructField(n, T.LongType()) for n in ("__first_us", "__last_us")],
    *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("__starts", "__slopes", "__offsets")]]
_ENDS = [f.name for f in _ADDED[3:]]
_END_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3]


def _decide(bucket: Bucket, line: _Line, new: np.ndarray, us: np.ndarray, last_us: int | None, given: np.ndarray,
            every: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decisions of sorted rows that go on from ``line``, which of them are of the head, and levels after them.

    ``new`` marks rows with a key unlike the one above. ``given`` is the level that a row of a written state
    sets, -1 for all others. Levels are right for rows that were followed: all of them if ``every``.
    """
    size = len(us)
    fill = min(-(-bucket.full // bucket.gain), _NEVER) if bucket.gain else _NEVER
    burst = bucket.full // bucket.token
    cut = new.copy()
    # Compared in two halves, as a difference of two times can pass 64 bits.
    above = np.append(us[0] if last_us is None else last_us, us[:-1])
    cut |= (us > above) & (us.astype(np.uint64) - above.astype(np.uint64) >= np.uint64(fill))
    cut |= given >= 0
    allowed, head, after = np.ones(size, bool), np.zeros(size, bool), np.zeros(size, np.int64)
    starts = np.flatnonzero(cut)
    edges = [0, *starts[starts > 0].tolist(), size]
    lengths = np.diff(edges)
    # Short stretches in the middle are allowed already; the first goes on from before, the last goes on.
    follow = (lengths > burst) | (given[edges[:-1]] >= 0) | every
    follow[[0, -1]] = True
    for n in np.flatnonzero(follow).tolist():
        a, b = edges[n], edges[n + 1]
        if given[a] >= 0:
            line.at(int(given[a]), int(us[a]))
            after[a] = given[a]
            a += 1
        elif cut[a]:
            line.full()
        levels: list[int] = []
        unknown, decided = line.take(us[a:b].tolist(), levels)
        head[a:a + unknown] = True
        allowed[a + unknown:b] = decided
        after[a + unknown:b] = levels
    return allowed, head, after


def _fold(bucket: Bucket, place_columns: list[str], every: bool):
    def fold(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = _Line(bucket)
        line.unknown()
        first_key = first_us = key = before = None
        fate = (False, False, 0)
        schema, waiting = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            size = batch.num_rows
            allowed, head, after = np.ones(size, bool), np.zeros(size, bool), np.zeros(size, np.int64)
            place = [batch.column(c) for c in place_columns]
            live = batch.column("__live").to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(live)
            if len(rows):
                at = [c.take(pa.array(rows)) for c in place]
                us = batch.column("__us").take(pa.array(rows)).to_numpy()
                # Rows of one place are one delivery: the first is decided.
                single = new_keys(at, before)
                own = np.flatnonzero(single)
                if len(own):
                    keys = at[0].take(pa.array(own))
                    new = differs(keys)
                    new[0] = key is not None and keys[0].as_py() != key
                    if waiting:
                        first_key, first_us, waiting = keys[0].as_py(), int(us[own[0]]), False
                    given = batch.column("__level").take(pa.array(rows[own])).fill_null(-1).to_numpy()
                    found = _decide(bucket, line, new, us[own], line.last, given, every)
                    key = keys[len(keys) - 1].as_py()
                else:
                    found = np.empty(0, bool), np.empty(0, bool), np.empty(0, np.int64)
                source = np.cumsum(single) - 1  # -1: a copy of the last row before this batch
                for whole, values, old in zip((allowed, head, after), found, fate):
                    whole[rows] = np.append(values, old)[source]
                before = tuple(c[len(rows) - 1].as_py() for c in at)
                fate = allowed[rows[-1]], head[rows[-1]], after[rows[-1]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(allowed, mask=head), pa.array(head), pa.array(after),
                 *[pa.nulls(size, t) for t in _END_TYPES],
                 pa.array(np.full(size, part, np.int32)), pa.array(np.zeros(size, bool))],
                names=[*schema.names, "__allowed", "__head", "__after", *_ENDS, PART, END])
        if not waiting:
            starts, slopes, offsets = zip(*line.function())
            state = [first_key, key, first_us, line.last, list(starts), list(slopes), list(offsets)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(1, f.type) for f in schema], pa.nulls(1, pa.bool_()), pa.array([False]), pa.nulls(1, pa.int64()),
                 *[pa.array([v], t) for v, t in zip(state, _END_TYPES)], pa.array([part], pa.int32()), pa.array([True])],
                names=[*schema.names, "__allowed", "__head", "__after", *_ENDS, PART, END])

    return fold


def _chain(bucket: Bucket):
    """The level each partition's first key comes in with; one row a partition, in partition order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, level, last = None, None, None
        for batch in batches:
            parts, entries = [], []
            for r in batch.to_pylist():
                same = key is not None and r["__first_key"] == key
                entry = bucket.refill(level, r["__first_us"] - last) if same else bucket.full
                pieces = list(zip(r["__starts"], r["__slopes"], r["__offsets"]))
                key, level, last = r["__last_key"], apply_pieces(pieces, entry), r["__last_us"]
                parts.append(r[PART])
                entries.append(entry)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(entries, pa.int64())], names=[PART, "__entry"])

    return run


def _replay_heads(bucket: Bucket, place_columns: list[str]):
    """Decide the heads, sorted by partition and place, from the level they come in with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, level, last, before, fate = None, 0, None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            place = [batch.column(c) for c in (PART, *place_columns)]
            single = new_keys(place, before)
            decided, after = [], []
            for number, us, entry, own in zip(place[0].to_pylist(), batch.column("__us").to_pylist(),
                                              batch.column("__entry").to_pylist(), single.tolist()):
                if number != part:
                    part, level, last = number, entry, None
                if own:
                    (fate,), level, last = replay(bucket, level, last, [us])
                decided.append(fate)
                after.append(level)
            before = tuple(c[batch.num_rows - 1].as_py() for c in place)
            for name, values in (("__allowed", pa.array(decided, pa.bool_())), ("__after", pa.array(after, pa.int64()))):
                batch = batch.set_column(batch.schema.get_field_index(name), name, values)
            yield batch

    return run


def throttle(
    df: DataFrame, key: str = "sender_id", rate: str | int | Fraction = "10", burst: int = 20,
    seq: str = "seq", ts: str = "ts", keep_dropped: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Drop rows ``rate_limit`` that find the bucket of their key empty.

    Rows of a key are decided in order of ``seq``, then event_id; rows that agree in both are one delivery,
    pay once and share their fate. A clock that runs backwards gains nothing. Only rows not dropped earlier
    take part, and none without a time, which stays. Null keys share one bucket.
    """
    df = with_verdict(df)
    decided, _ = _throttle(df, Bucket.of(rate, burst), key, seq, ts, rows_per_slice)
    return mark(decided, ~F.col("__allowed"), "rate_limit", keep_dropped).select(*df.columns)


#: What is left of a key's bucket: the level after its last row, and that row's time in microseconds.
BUCKETS = "key string, level long, last long"


def throttle_from(
    df: DataFrame, state: DataFrame | None, key: str = "sender_id", rate: str | int | Fraction = "10", burst: int = 20,
    seq: str = "seq", ts: str = "ts", rows_per_slice: int = ROWS_PER_SLICE,
) -> tuple[DataFrame, DataFrame]:
    """``throttle`` that goes on from buckets left before (``BUCKETS``, one row a key) and returns those left now.

    The rows have ``drop_reason``; keys without rows keep their bucket.
    """
    df = with_verdict(df)
    decided, scanned = _throttle(df, Bucket.of(rate, burst), key, seq, ts, rows_per_slice, state, True)
    order = F.struct("__kind", seq, *tie_breaker(df, seq))
    left = F.max_by(F.struct(F.col("__after").alias("level"), F.col("__us").alias("last")), order)
    buckets = scanned.where("__live").groupBy(F.col("__key").alias("key")).agg(left.alias("left")).select("key", "left.*")
    return mark(decided, ~F.col("__allowed"), "rate_limit").select(*df.columns), buckets


def _throttle(df, bucket, key, seq, ts, rows_per_slice, state=None, every=False) -> tuple[DataFrame, DataFrame]:
    """The rows with ``__allowed``, and all scanned rows, those of the state included, with ``__after``."""
    place = ["__key", "__kind", seq, *tie_breaker(df, seq)]
    rows = df.withColumns({
        "__key": F.coalesce(F.col(key).cast("string"), F.lit("")),
        "__kind": F.lit(1),
        "__us": F.unix_micros(F.col(ts).cast("timestamp")),
        "__live": F.col(REASON).isNull() & F.col(ts).isNotNull(),
        "__level": F.lit(None).cast("long")})
    if state is not None:
        # A key's state is a row ahead of all others.
        rows = rows.unionByName(state.select(
            F.col("key").alias("__key"), F.lit(0).alias("__kind"), F.col("last").alias("__us"), F.lit(True).alias("__live"),
            F.col("level").alias("__level")), allowMissingColumns=True)
    # Sampling the ranges reads the input; so does the count, of no column.
    scanned = scan_ranges(rows, place, _fold(bucket, place, every), _ADDED, range_count(df, rows.count(), rows_per_slice), "throttle")
    ends = scanned.where(END).select(PART, *_ENDS)
    # As many rows as there are partitions.
    entries = ends.repartition(1).sortWithinPartitions(PART).mapInArrow(_chain(bucket), f"{PART} int, __entry long")
    body = scanned.where(~F.col(END))
    kept = [*rows.columns, "__allowed", "__after"]
    heads = (body.where("__head").join(F.broadcast(entries), PART).repartition(PART).sortWithinPartitions(PART, *place))
    heads = heads.mapInArrow(_replay_heads(bucket, place), heads.schema)
    whole = body.where("not __head").select(*kept).unionByName(heads.select(*kept))
    return whole.where("__kind = 1"), whole
