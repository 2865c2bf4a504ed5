"""Exact deduplication by a content sort: equal texts end up side by side, and neighbours are compared in full.

Rows are range-partitioned by the bytes of their normalised text at sampled splitters and sorted inside
each partition with Spark's external sort. The splitters are made of the first ``prefix`` bytes, a hash
of the whole text and the identifier, so a sample stays small however long texts are, texts with a
common beginning spread, and copies of one text, even a third of all rows, are dealt over several
partitions by identifier. Inside a partition the order is prefix, hash, text, identifier: copies are
neighbours, and only the comparison of whole texts decides.

One scan of a partition settles every group that can't reach beyond it. Groups under the first or the
last key of a partition may go on next door: each hands over one small row, with its text once, and
those rows, two a partition, are added up by text.

Memory: a scan holds one Arrow batch, the text of the open group and the identifiers of the group's rows
in that partition, never their texts.

Defined results: null counts as the empty text, and empty texts are copies of each other. Texts of any
length are compared in whole. Of equal texts the row with the largest identifier stays (the smallest with
``keep="smallest"``); a null identifier comes after all others; of rows that agree in text and identifier
exactly one is kept. An empty table gives an empty result. Other columns of the input, whatever their
names, don't matter to ``exact_groups``; ``drop_copies`` hands them on untouched.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import cut_lineage
from .common import row_ids

PREFIX = 32


def _changes(column: pa.Array, before) -> np.ndarray:
    """Where a value differs from the one above; ``before`` stands above the first, None for nothing."""
    out = np.ones(len(column), bool)
    out[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    if before is not None:
        out[0] = column[0].as_py() != before
    return out


class _Group:
    """Rows of one text, so far, in this partition."""

    def __init__(self, text: str, sha: str):
        self.text, self.sha, self.rows, self.n = text, sha, [], 0

    def add(self, ids: pa.Array, keys: pa.Array) -> None:
        place = pa.array(np.arange(len(ids)))
        self.rows.append((ids.take(place), keys.take(place)))  # copies, so that the batch with its texts can go
        self.n += len(ids)


def _scan(id_type: pa.DataType):
    names = ["id", "row", "sha", "keep", "n", "kept", "part", "edge", "text"]

    def table(ids, rows, sha, keep, n, kept, part, edge, text):
        return pa.RecordBatch.from_arrays(
            [ids, rows, sha, keep, pa.array(n, pa.int64()), pa.array(kept, pa.bool_()), pa.array([part] * len(ids), pa.int32()),
             pa.array(edge, pa.int32()), pa.array(text, pa.string())], names=names)

    def run(batches):
        part = TaskContext.get().partitionId()
        pending: list[_Group] = []  # all under one key
        last_key, is_first, edges = None, True, 0

        def extend(batch, start, stop, new_text):
            for a, b in _stretches(start, stop, new_text):
                if new_text[a] or not pending:
                    pending.append(_Group(batch.column("text")[a].as_py(), batch.column("sha")[a].as_py()))
                pending[-1].add(batch.column("id").slice(a, b - a), batch.column("row").slice(a, b - a))

        def flush(at_edge):
            nonlocal edges
            for group in pending:
                keep, first = group.rows[0][0][0], True
                for ids, rows in group.rows:
                    size = len(ids)
                    yield table(ids, rows, pa.array([group.sha] * size), pa.array([keep.as_py()] * size, id_type), [group.n] * size,
                                [first] + [False] * (size - 1), part, [edges if at_edge else None] * size,
                                [group.text if first and at_edge else None] + [None] * (size - 1))
                    first = False
                edges += at_edge
            pending.clear()

        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            new_key = _changes(batch.column("key"), last_key)
            new_text = new_key | _changes(batch.column("text"), pending[-1].text if pending else None)
            last_key = batch.column("key")[size - 1].as_py()
            keys = np.flatnonzero(new_key)
            if not len(keys):
                extend(batch, 0, size, new_text)
                continue
            extend(batch, 0, keys[0], new_text)
            if pending:
                yield from flush(is_first)
                is_first = False
            if is_first and len(keys) > 1:
                extend(batch, keys[0], keys[1], new_text)
                yield from flush(True)
                is_first = False
                keys = keys[1:]
            a, b = keys[0], keys[-1]
            if b > a:  # whole groups of keys that neither begin nor end the partition
                starts = np.flatnonzero(new_text[a:b])
                counts = np.diff(np.append(starts, b - a))
                ids = batch.column("id").slice(a, b - a)
                kept = np.zeros(b - a, bool)
                kept[starts] = True
                yield table(ids, batch.column("row").slice(a, b - a), batch.column("sha").slice(a, b - a),
                            ids.take(pa.array(np.repeat(starts, counts))), np.repeat(counts, counts), kept, part,
                            [None] * (b - a), [None] * (b - a))
            extend(batch, b, size, new_text)
        if pending:
            yield from flush(True)

    return run


def _stretches(start: int, stop: int, new: np.ndarray):
    """Ranges of rows with one text."""
    cuts = [start, *(start + 1 + np.flatnonzero(new[start + 1:stop])).tolist(), stop]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _groups(docs: DataFrame, row: Column, id: str, text: str, normalise: Callable[[Column], Column] | None, keep: str,
            prefix: int) -> DataFrame:
    """Per row: id, row, text_sha256, keep_id, group_size, kept."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    content = F.coalesce(normalise(content), F.lit("")) if normalise else content
    raw = F.col("text").cast("binary")
    # Sixteen hexadecimal digits of the hash: one comparable key of bounded size.
    key = F.concat(F.substring(raw, 1, prefix), F.lpad(F.hex(F.xxhash64("text")), 16, "0").cast("binary"))
    order = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    source = docs.select(F.col(f"`{id}`").alias("id"), row.alias("row"), content.alias("text")).withColumn("key", key)
    ordered = (source.repartitionByRange("key", order).sortWithinPartitions("key", "text", order)
               .select("id", "row", "key", "text", F.sha2(raw, 256).alias("sha")))
    id_field = source.schema["id"]
    schema = T.StructType([
        T.StructField("id", id_field.dataType), T.StructField("row", T.StringType()), T.StructField("sha", T.StringType()),
        T.StructField("keep", id_field.dataType), T.StructField("n", T.LongType()), T.StructField("kept", T.BooleanType()),
        T.StructField("part", T.IntegerType()), T.StructField("edge", T.IntegerType()), T.StructField("text", T.StringType())])
    scanned = cut_lineage(ordered.mapInArrow(_scan(to_arrow_type(id_field.dataType)), schema), "content-sort")

    # Two rows a partition, but for texts of equal beginning and equal hash.
    edges = scanned.where("text is not null").select("part", "edge", "text", "n", "keep")
    best = F.max("keep") if keep == "largest" else F.min("keep")
    whole = edges.groupBy("text").agg(F.sum("n").alias("whole_n"), best.alias("whole_keep"), F.min("part").alias("first_part"))
    whole = edges.select("part", "edge", "text").join(whole, "text").drop("text")
    out = scanned.drop("text").join(F.broadcast(whole), ["part", "edge"], "left")
    is_edge = F.col("whole_n").isNotNull()
    return out.select(
        "id", "row", F.when(is_edge, F.col("whole_keep")).otherwise(F.col("keep")).alias("keep_id"),
        F.when(is_edge, F.col("whole_n")).otherwise(F.col("n")).alias("group_size"),
        (F.col("kept") & (~is_edge | (F.col("part") == F.col("first_part")))).alias("kept"),
        F.col("sha").alias("text_sha256"))


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest",
                 normalise: Callable[[Column], Column] | None = None, prefix: int = PREFIX) -> DataFrame:
    """One row per row of ``docs``: its identifier, keep_id, group_size, kept and text_sha256.

    ``normalise`` maps the text column to what is compared; without it texts are compared as they are.
    """
    out = _groups(docs, F.lit(None).cast("string"), id, text, normalise, keep, prefix).drop("row")
    return out.withColumnRenamed("id", id)


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest",
                normalise: Callable[[Column], Column] | None = None, prefix: int = PREFIX) -> DataFrame:
    """The rows of ``docs`` that stay, one of each text, with all their columns."""
    base = row_ids(docs, "__row")
    kept = _groups(base, F.col("__row"), id, text, normalise, keep, prefix).where("kept").select(F.col("row").alias("__row"))
    return base.join(kept, "__row", "left_semi").drop("__row")
