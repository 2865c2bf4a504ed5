"""Hard negatives by a vertical scan with branch and bound (BOND) over columnar vectors.

Vectors are stored in blocks: one column of integers per dimension, rows sorted by label, with the least
and the largest value of every column. An anchor reads the columns of a block in descending order of its
own components' magnitude and adds up partial scores. What the columns not read yet can still add lies
between two sums of products with their least and largest values; with these bounds rows leave the bitmap
of candidates, and the rows left over are carried on by their places alone. A block none of whose rows
can matter is skipped before its first column is read.

1. The anchors' best rows of the same label, the positives. A row leaves when its upper bound is below the
   n-th best lower bound of the block, or the n-th best score that the task has seen.
2. A positive of score p opens the window ``lower * p <= 100 * score <= upper * p`` for rows of other
   labels. A row leaves when its bounds lie outside all windows of the anchor, or below the n-th best
   score seen in each of them. What is left has its exact score and is tested against each window.

Every task hands over at most n rows an anchor (and window), and these are ranked. Anchors go to the
tasks in passes of at most ``PASS_BYTES`` of vectors, so a broadcast is bounded; each pass reads all blocks.
All scores are exact integers.

Defined results: rows with a null identifier, label or vector, or any null or non-finite component take
no part. A component x becomes floor(scale * x); shorter vectors count as filled up with zeros. Rows with a
component so large that a score might not fit 64 bits (2^31 - 1, or the root of 2^63 / dimensions, if
smaller) take no part either. Equal scores rank by identifier, then by place. Rows that share an identifier
are rows of their own: a repeated anchor gives its results again, and one can be the other's positive. An
anchor without positives, or without negatives in a window, gives no row. An empty table gives an empty
result. Columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from heapq import heappush, heapreplace
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Bytes of the columns of a block, and of the anchors of a pass.
BLOCK_BYTES = 8 << 20
PASS_BYTES = 4 << 20
#: Columns read between two looks at the bounds.
STEP = 8

BLOCK = "task int, block int, ids binary, labels binary, anchors binary, columns array<binary>"
ANCHOR = "place string, id long, label long, vector binary"
HIT = "place string, slot int, score long, hit_id long, hit_place string"


PARTS = ("task", "block", "ids", "labels", "anchors", "columns")


def _pack(task: int, block: int, held: list[tuple[np.ndarray, ...]], dims: int) -> pa.RecordBatch:
    ids, labels, anchors, matrix = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((ids, labels))
    columns = [np.ascontiguousarray(matrix[order, d]).tobytes() for d in range(dims)]
    return pa.RecordBatch.from_arrays(
        [pa.array([task], pa.int32()), pa.array([block], pa.int32()),
         *(pa.array([x[order].tobytes()], pa.binary()) for x in (ids, labels, anchors)),
         pa.array([columns], pa.list_(pa.binary()))], list(PARTS))


def to_blocks(vectors: DataFrame, dims: int, block_rows: int) -> DataFrame:
    """One row per block of vectors (id long, label long, anchor boolean, vector array<long> without nulls)."""

    def run(batches):
        task = TaskContext.get().partitionId()
        block, held = 0, []
        for batch in batches:
            vector = batch.column("vector")
            sizes = np.diff(vector.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            matrix = np.zeros((batch.num_rows, dims), np.int32)
            matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = vector.flatten().to_numpy()
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            anchors = batch.column("anchor").to_numpy(zero_copy_only=False)
            for a in range(0, batch.num_rows, block_rows):
                b = a + block_rows
                held.append((ids[a:b], labels[a:b], anchors[a:b], matrix[a:b]))
                if sum(len(h[0]) for h in held) >= block_rows:
                    yield _pack(task, block, held, dims)
                    block, held = block + 1, []
        if held:
            yield _pack(task, block, held, dims)

    return vectors.mapInArrow(run, BLOCK)


@dataclass
class Block:
    name: str
    ids: np.ndarray
    labels: np.ndarray
    anchors: np.ndarray
    columns: list[np.ndarray]
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, task: int, block: int, ids: bytes, labels: bytes, anchors: bytes, columns: list[bytes]) -> Block:
        parts = [np.frombuffer(c, np.int32) for c in columns]
        return cls(f"{task}:{block}", np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64),
                   np.frombuffer(anchors, np.bool_), parts,
                   np.array([c.min() for c in parts], np.int64), np.array([c.max() for c in parts], np.int64))

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))


def blocks_of(batches):
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in PARTS)):
            yield Block.of(*row)


class Best:
    """The n best rows: larger score, then smaller identifier."""

    def __init__(self, n: int):
        self.n, self.heap = n, []

    @property
    def full(self) -> bool:
        return len(self.heap) >= self.n

    @property
    def least(self) -> int:
        return self.heap[0][0]

    def offer(self, score: int, id: int, place: tuple) -> None:
        entry = (score, -id, place)  # rows that agree in score and identifier give the same result
        if not self.full:
            heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapreplace(self.heap, entry)

    def rows(self):
        return [(score, -minus_id, place) for score, minus_id, place in self.heap]


def scan(block: Block, query: np.ndarray, start: int, stop: int, skip: Callable[[], np.ndarray] | None,
         alive: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the rows from ``start`` to ``stop`` that ``alive`` lets through to the end.

    ``alive`` gets lower and upper bounds of the scores and tells which rows go on. ``skip`` marks rows
    that are no candidates from the start.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    one, other = query[order] * block.low[order], query[order] * block.high[order]
    # What all columns from a step on can add at least and at most.
    least = np.append(np.cumsum(np.minimum(one, other)[::-1])[::-1], 0)
    most = np.append(np.cumsum(np.maximum(one, other)[::-1])[::-1], 0)
    wide = int(np.abs(query) @ np.maximum(np.abs(block.low), np.abs(block.high))) if len(query) else 0
    kind = np.int32 if wide < 1 << 31 else np.int64
    none = np.empty(0, np.int64)
    if stop <= start or not alive(np.array([least[0]]), np.array([most[0]])).any():
        return none, none
    bitmap = None if skip is None else ~skip()
    places, scores = None, np.zeros(stop - start, kind)
    for begin in range(0, len(order), STEP):
        for d in order[begin:begin + STEP]:
            weight = query[d]
            if weight == 0:
                continue
            column = block.columns[d][start:stop] if places is None else block.columns[d][places]
            scores += column * kind(weight) if kind is np.int32 else column.astype(np.int64) * weight
        done = min(begin + STEP, len(order))
        keep = alive(scores + kind(least[done]), scores + kind(most[done]))
        if places is None:
            bitmap = keep if bitmap is None else bitmap & keep
            found = np.flatnonzero(bitmap)
            if 4 * len(found) < 3 * len(bitmap):  # from here on the candidates alone
                places, scores = found + start, scores[found]
        elif not keep.all():
            places, scores = places[keep], scores[keep]
        if places is not None and not len(places):
            return none, none
    if places is None:
        found = np.flatnonzero(bitmap) if bitmap is not None else np.arange(stop - start)
        places, scores = found + start, scores[found]
    return places, scores.astype(np.int64)


def _offer(best: Best, block: Block, places: np.ndarray, scores: np.ndarray) -> None:
    """All rows that can be among the n best of ``places`` go to ``best``."""
    if len(scores) > best.n:
        cut = np.partition(scores, -best.n)[-best.n]
        chosen = np.flatnonzero(scores >= cut)
        if len(chosen) > 4 * best.n:  # many equal scores: the smallest identifiers decide
            chosen = chosen[np.lexsort((places[chosen], block.ids[places[chosen]], -scores[chosen]))[:best.n]]
        places, scores = places[chosen], scores[chosen]
    for place, score in zip(places.tolist(), scores.tolist()):
        best.offer(score, int(block.ids[place]), (block.name, place))


def _hits(found: dict[tuple[str, int], Best]):
    rows = [(place, slot, score, id, f"{hit[0]}:{hit[1]}")
            for (place, slot), best in found.items() for score, id, hit in best.rows()]
    for start in range(0, len(rows), 50_000):
        columns = list(zip(*rows[start:start + 50_000]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            ["place", "slot", "score", "hit_id", "hit_place"])


def _positives(anchors, n: int):
    """For every anchor its n best rows of the same label in the blocks of a task."""

    def run(batches):
        found: dict[tuple[str, int], Best] = {}
        for block in blocks_of(batches):
            for place, _, label, vector in anchors.value:
                start, stop = block.of_label(label)
                if start == stop:
                    continue
                best = found.setdefault((place, 0), Best(n))
                own = place.rsplit(":", 1)
                itself = int(own[1]) - start if own[0] == block.name else None

                def alive(low, high):
                    cut = best.least if best.full else None
                    if len(low) > n + 1:  # one more, as the anchor itself may be among them
                        inner = np.partition(low, -n - 1)[-n - 1]
                        cut = inner if cut is None else max(cut, inner)
                    return np.ones(len(high), bool) if cut is None else high >= cut

                def is_itself():
                    out = np.zeros(stop - start, bool)
                    out[itself] = True
                    return out

                query = np.frombuffer(vector, np.int32).astype(np.int64)
                places, scores = scan(block, query, start, stop, None if itself is None else is_itself, alive)
                _offer(best, block, places, scores)
        yield from _hits(found)

    return run


def _negatives(anchors, n: int):
    """For every window of every anchor its n best rows of other labels in the blocks of a task."""

    def run(batches):
        found: dict[tuple[str, int], Best] = {}
        for block in blocks_of(batches):
            for place, label, vector, windows in anchors.value:
                best = [(found.setdefault((place, slot), Best(n)), low, high) for slot, low, high in windows]
                start, stop = block.of_label(label)

                def alive(low, high):
                    # Rows that may still enter some window; the windows' own hull is looked at first.
                    floor = [max(b.least, a) if b.full else a for b, a, _ in best]
                    keep = (high >= min(floor)) & (low <= max(z for _, _, z in best))
                    return keep

                def same_label():
                    out = np.zeros(len(block.ids), bool)
                    out[start:stop] = True
                    return out

                query = np.frombuffer(vector, np.int32).astype(np.int64)
                places, scores = scan(block, query, 0, len(block.ids), same_label if stop > start else None, alive)
                for into, low, high in best:
                    inside = (scores >= low) & (scores <= high)
                    _offer(into, block, places[inside], scores[inside])
        yield from _hits(found)

    return run


def _best(hits: DataFrame, n: int) -> DataFrame:
    """Rank the tasks' rows; a task sent at most n for each anchor and slot."""
    order = Window.partitionBy("place", "slot").orderBy(F.desc("score"), "hit_id", "hit_place")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def usable(vectors: DataFrame, id: str, label: str, vector: str, scale: float) -> tuple[DataFrame, int]:
    """Rows that take part, as (id, label, vector of integers), and the number of dimensions."""
    raw = F.col(f"`{vector}`").cast("array<double>")
    finite = ~F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                          raw.alias("vector")).where(F.col("id").isNotNull() & F.col("label").isNotNull()
                                                     & F.col("vector").isNotNull()).where(finite)
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    limit = min((1 << 31) - 1, isqrt(((1 << 63) - 1) // max(dims, 1)))
    whole = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale)))))
    return whole.where(~F.exists("vector", lambda x: (x > limit) | (x < -limit))), dims


def hard_negatives(vectors: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label",
                   vector: str = "embedding", scale: float = 256, positives: int = 5, negatives: int = 3,
                   lower: int = 50, upper: int = 95, block_rows: int | None = None,
                   anchors_per_pass: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, for every anchor and positive.

    ``is_anchor`` is a condition over a long column named ``id``. ``lower`` and ``upper`` are percents of
    the positive's score. Blocks and passes are cut by bytes if no numbers are given.
    """
    spark = vectors.sparkSession
    rows, dims = usable(vectors, id, label, vector, scale)
    rows = rows.withColumn("anchor", F.coalesce(is_anchor, F.lit(False)))
    block_rows = block_rows or max(1, BLOCK_BYTES // (4 * dims + 16))
    blocks = cut_lineage(to_blocks(rows, dims, block_rows), "vector-blocks")

    def pick(batches):
        for block in blocks_of(batches):
            chosen = np.flatnonzero(block.anchors)
            for cut in range(0, len(chosen), 2048):
                part = chosen[cut:cut + 2048]
                matrix = np.array([c[part] for c in block.columns], np.int32).reshape(dims, len(part)).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{block.name}:{p}" for p in part]), pa.array(block.ids[part]), pa.array(block.labels[part]),
                     pa.array([v.tobytes() for v in matrix], pa.binary())], ["place", "id", "label", "vector"])

    anchors = cut_lineage(blocks.mapInArrow(pick, ANCHOR), "anchors")
    passes = max(1, -(-anchors.count() // (anchors_per_pass or max(1, PASS_BYTES // (4 * dims + 64)))))
    turn = F.pmod(F.xxhash64("place"), F.lit(passes))

    results = []
    for number in range(passes):
        mine = anchors.where(turn == number)
        sent = spark.sparkContext.broadcast([(r["place"], r["id"], r["label"], r["vector"]) for r in mine.collect()])
        near = cut_lineage(_best(blocks.mapInArrow(_positives(sent, positives), HIT), positives), "positives")
        windows: dict[str, list[tuple[int, int, int]]] = {}
        for r in near.select("place", "rank", "score").collect():  # at most `positives` rows an anchor
            low, high = -((-lower * r["score"]) // 100), upper * r["score"] // 100
            if low <= high:
                windows.setdefault(r["place"], []).append((r["rank"], low, high))
        open_anchors = spark.sparkContext.broadcast(
            [(place, label, vector, windows[place]) for place, _, label, vector in sent.value if place in windows])
        far = _best(blocks.mapInArrow(_negatives(open_anchors, negatives), HIT), negatives)
        results.append(cut_lineage(
            far.join(near.select("place", F.col("rank").alias("slot"), F.col("score").alias("positive_score"),
                                 F.col("hit_id").alias("positive_id")), ["place", "slot"])
            .join(mine.select("place", F.col("id").alias("anchor_id")), "place")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("hit_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")), "hard-negatives"))
        sent.unpersist()
        open_anchors.unpersist()
    return reduce(DataFrame.unionByName, results)
