"""Substring deduplication: windows of words that occur again anywhere are cut out.

A window is ``width`` consecutive words. Its minimiser is the smallest hash among the runs of ``gram``
words in it. Consecutive windows with the same minimiser form a super-k-mer, which travels as one
packed string to the bucket of that minimiser; equal windows have equal minimisers, so a bucket holds
all copies of its windows, and sorting them counts them exactly, by their words.

- Only minimisers of two runs, or at two places of one, can hide a repeat. A first pass marks them in a bit set of fixed
  size (2 ** ``filter_bits`` bits, sent to all tasks); other super-k-mers stay at home. If the bit set
  fills up, more strings travel than needed, and the result is the same.
- Equal packed strings, as copies of documents make them, are counted before they move, so a passage
  in a third of all documents arrives once per task.
- A bucket with more than ``bucket_windows`` windows in different strings is not sorted in one task: its
  windows are counted by a grouping over 128-bit digests. Such buckets are marked in a second bit set of fixed
  size; another bucket that meets a marked one's bit is counted that way too, with the same result.
- A run ends where the value of the minimiser changes, not its place, so repetitive text, in which it comes
  again every few words, makes long runs; very long ones are cut every ``run_windows`` windows.

Words covered by a repeated window are removed; windows are judged on the input.

Defined results: a null or empty text has no words, and the digest of the empty text; a text of fewer
than ``width`` words keeps all; texts of any length are worked on in whole, the longest one at a time; rows that repeat are copies of each other and lose all their windows;
an empty table gives an empty result. Input columns with the names of result columns are replaced.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .common import WordHash, bit_place, bit_set, chain, in_bit_set, mix, row_ids, slices

RUN_WINDOWS = 512
BUCKET_WINDOWS = 300_000
FILTER_BITS = 27
RESULT = "n_words long, n_removed long, kept_sha256 string, kept_text string"


def runs(hashes: np.ndarray, doc: np.ndarray, width: int, gram: int, longest: int):
    """Super-k-mers of concatenated texts: first window, number of windows, minimiser."""
    return runs_with_places(hashes, doc, width, gram, longest)[:3]


def runs_with_places(hashes: np.ndarray, doc: np.ndarray, width: int, gram: int, longest: int):
    """The same, and whether the minimiser has several places in the run, so that windows inside may be equal.

    ``doc`` is the text of each word. Windows over the end of a text are left out.
    """
    n = len(hashes) - width + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none, none.astype(np.uint64), none.astype(bool)
    value = chain(hashes, gram)
    place = np.arange(len(value))
    span, wanted = 1, width - gram + 1
    while span < wanted:  # the smallest of span values from each place on, the leftmost of equal ones
        step = min(span, wanted - span)
        left, right = value[:-step], value[step:]
        take = right < left
        value, place = np.where(take, right, left), np.where(take, place[step:], place[:-step])
        span += step
    valid = doc[:n] == doc[width - 1:]
    index = np.flatnonzero(valid)
    if not len(index):
        return none, none, none.astype(np.uint64), none.astype(bool)
    place, value = place[index], value[index]
    new = np.ones(len(index), bool)
    new[1:] = (value[1:] != value[:-1]) | (index[1:] != index[:-1] + 1) | (doc[index[1:]] != doc[index[:-1]])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(index)))
    moved = np.append(False, place[1:] != place[:-1]) & ~new
    several = np.add.reduceat(moved, first, dtype=np.int64) > 0
    if length.max() > longest:
        pieces = -(-length // longest)
        offset = np.concatenate([np.arange(p) * longest for p in pieces])
        several = np.repeat(several, pieces)
        first, length = np.repeat(first, pieces) + offset, np.minimum(np.repeat(length, pieces) - offset, longest)
    return index[first], length, value[first], several


def _words(texts, hashes: WordHash):
    words, sizes = [], []
    for text in texts:
        own = text.encode().split() if text else []
        words += own
        sizes.append(len(own))
    return words, np.array(sizes, np.int64), hashes.of(words), np.repeat(np.arange(len(texts)), sizes)


def _bit(value: np.ndarray, bits: int) -> np.ndarray:
    return (mix(value) >> np.uint64(64 - bits)).astype(np.int64)


def repeated_minimisers(base: DataFrame, width: int, gram: int, bits: int) -> bytes:
    """Bit set of the minimisers of two super-k-mers or more, or of one in which they have several places."""

    def emit(batches):
        hashes = WordHash()
        for piece in slices(batches, "text"):
            _, _, h, doc = _words(piece.column("text").to_pylist(), hashes)
            _, _, value, several = runs_with_places(h, doc, width, gram, RUN_WINDOWS)
            yield pa.RecordBatch.from_arrays([pa.array(_bit(np.append(value, value[several]), bits))], ["bit"])

    twice = base.select("text").mapInArrow(emit, "bit long").groupBy("bit").count().where("count > 1")
    # At most 2 ** bits / 8 bytes in all, in pieces of 4 KB. Spark counts bits and pieces from 1.
    bit = F.col("bit") + 1
    pieces = twice.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = bytearray(((1 << bits) + 7) // 8)
    for row in pieces.toLocalIterator():
        start = (row["part"] - 1) * PIECE
        piece = bytes(row["bits"])[: len(out) - start]
        out[start:start + len(piece)] = piece
    return bytes(out)


PIECE = 4096


def count_windows(strings: list[tuple[bytes, int]], width: int) -> list[list[tuple[int, int]]]:
    """Per packed string the word ranges covered by windows that occur twice or more in all strings,
    each string counted as often as it says."""
    # Windows stay in their strings: a hash and three numbers are held of each, and those of equal hash are compared by words.
    key, string, first, begin, end = array("Q"), array("q"), array("q"), array("q"), array("q")
    for s, (packed, _) in enumerate(strings):
        ends = [-1, *(i for i, b in enumerate(packed) if b == 32), len(packed)]
        n = max(len(ends) - width, 0)
        begin.extend(i + 1 for i in ends[:n])
        end.extend(ends[width:])
        first.append(len(string))
        string.extend([s] * n)
        key.extend(xxhash.xxh3_64_intdigest(packed[ends[i] + 1:ends[i + width]]) for i in range(n))
    keys = np.frombuffer(key, np.uint64)
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(keys) else order
    size = np.diff(np.append(starts, len(keys)))
    several = np.array([copies > 1 for _, copies in strings], bool)
    pick = (size > 1) | several[np.frombuffer(string, np.int64)[order[starts]]]
    found: list[list[int]] = [[] for _ in strings]
    for at, n in zip(starts[pick].tolist(), size[pick].tolist()):
        equal: dict[bytes, list[int]] = {}
        for w in order[at:at + n].tolist():
            equal.setdefault(strings[string[w]][0][begin[w]:end[w]], []).append(w)
        for same in equal.values():
            if len(same) > 1 or several[string[same[0]]]:
                for w in same:
                    found[string[w]].append(w - first[string[w]])
    return [ranges(sorted(places), width) for places in found]


def ranges(places: list[int], width: int) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for i in places:
        if merged and i <= merged[-1][1]:
            merged[-1] = (merged[-1][0], i + width)
        else:
            merged.append((i, i + width))
    return merged


SPANS = "array<struct<start:int,stop:int>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _spans(found) -> pa.Array:
    return pa.array([[{"start": a, "stop": b} for a, b in x] for x in found], SPAN_TYPE)


def remove_repeats(docs: DataFrame, width: int = 35, gram: int = 8, filter_bits: int = FILTER_BITS,
                   run_windows: int = RUN_WINDOWS, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_sha256 and kept_text (kept words joined by one space)."""
    spark = docs.sparkSession
    base = row_ids(docs)
    sent = spark.sparkContext.broadcast(repeated_minimisers(base, width, gram, filter_bits))

    def emit(batches):
        hashes, marked = WordHash(), np.frombuffer(sent.value, np.uint8)
        for piece in slices(batches, "text"):
            words, sizes, h, doc = _words(piece.column("text").to_pylist(), hashes)
            first, length, value = runs(h, doc, width, gram, run_windows)
            bit = _bit(value, filter_bits)
            pick = np.flatnonzero(marked[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            begin = np.cumsum(sizes) - sizes
            rows = piece.column("__row").to_pylist()
            packed = [b" ".join(words[a:a + n + width - 1]) for a, n in zip(first[pick].tolist(), length[pick].tolist())]
            own = doc[first[pick]] if len(pick) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[pick].view(np.int64)), pa.array([xxhash.xxh3_128_digest(p) for p in packed], pa.binary()),
                 pa.array([rows[d] for d in own], pa.string()), pa.array((first[pick] - begin[own]).astype(np.int32)),
                 pa.array(length[pick].astype(np.int64)), pa.array(packed, pa.binary())],
                ["minimiser", "digest", "row", "start", "windows", "packed"])

    # Written once: counted by string, and looked up by place.
    moved = cut_lineage(base.select("__row", "text").mapInArrow(
        emit, "minimiser long, digest binary, row string, start int, windows long, packed binary"), "super-k-mers")
    strings = moved.groupBy("minimiser", "digest").agg(F.count("*").alias("copies"), F.first("windows").alias("windows"),
                                                     F.first("packed").alias("packed"))
    written = strings = cut_lineage(strings, "packed-strings")
    large = strings.groupBy("minimiser").agg(F.sum("windows").alias("windows")).where(F.col("windows") > bucket_windows)
    marks = bit_set(large.select("minimiser").mapInArrow(_places(filter_bits), "bit long"), filter_bits)
    some_large = any(marks)
    strings = strings.select("minimiser", "digest", "packed", "copies")
    if some_large:
        sent_marks = spark.sparkContext.broadcast(marks)

        def mark(batches):
            members = np.frombuffer(sent_marks.value, np.uint8)
            for batch in batches:
                own = in_bit_set(batch.column("minimiser").to_numpy().view(np.uint64), members, filter_bits)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "large"])

        strings = strings.mapInArrow(mark, "minimiser long, digest binary, packed binary, copies long, large boolean")

    def count(batches):
        def groups():
            for batch in batches:
                yield from zip(batch.column("minimiser").to_pylist(), batch.column("digest").to_pylist(),
                               batch.column("packed").to_pylist(), batch.column("copies").to_pylist())

        digests, found = [], []
        for _, members in groupby(groups(), key=lambda g: g[0]):
            members = list(members)  # at most bucket_windows windows
            for member, spans in zip(members, count_windows([(m[2], m[3]) for m in members], width)):
                if spans:
                    digests.append(member[1])
                    found.append(spans)
            if len(digests) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), _spans(found)], ["digest", "spans"])
                digests, found = [], []
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), _spans(found)], ["digest", "spans"])

    small = strings.where("not large") if some_large else strings
    repeats = (small.repartition("minimiser").sortWithinPartitions("minimiser")
               .select("minimiser", "digest", "packed", "copies").mapInArrow(count, f"digest binary, spans {SPANS}"))
    if some_large:
        repeats = repeats.unionByName(_count_large(strings.where("large"), width))
    by_row = (moved.select("digest", "row", "start").join(repeats, "digest")
              .select(F.col("row").alias("__row"), F.transform("spans", lambda s: F.struct(
                  (s["start"] + F.col("start")).alias("start"), (s["stop"] + F.col("start")).alias("stop"))).alias("s"))
              .groupBy("__row").agg(F.flatten(F.collect_list("s")).alias("__spans")))
    # Few numbers per document; the packed strings are done with.
    by_row = cut_lineage(by_row, "repeated-spans")
    release(moved, written)
    names = {f.split()[0] for f in RESULT.split(", ")}
    marked_docs = base.drop(*names).join(by_row, "__row", "left").drop("__row")
    return _cut(marked_docs)


def _places(bits: int):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bit_place(batch.column("minimiser").to_numpy().view(np.uint64), bits))], ["bit"])

    return run


def _count_large(strings: DataFrame, width: int) -> DataFrame:
    """What ``count_windows`` finds, for buckets of any size."""

    def explode(batches):
        for batch in batches:
            for digest, packed, copies in zip(*(batch.column(c).to_pylist() for c in ("digest", "packed", "copies"))):
                words = packed.split(b" ")
                n = len(words) - width + 1
                # Equal windows of a string travel as one row, at most run_windows places long.
                places: dict[bytes, list[int]] = {}
                for i in range(n):
                    places.setdefault(xxhash.xxh3_128_digest(b" ".join(words[i:i + width])), []).append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest] * len(places), pa.binary()), pa.array(list(places.values()), pa.list_(pa.int32())),
                     pa.array(list(places), pa.binary()), pa.array([copies * len(p) for p in places.values()], pa.int64())],
                    ["digest", "at", "window", "copies"])

    windows = strings.select("digest", "packed", "copies").mapInArrow(
        explode, "digest binary, at array<int>, window binary, copies long")
    twice = windows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    return (windows.join(twice, "window").groupBy("digest")
            .agg(F.transform(F.sort_array(F.flatten(F.collect_list("at"))),
                             lambda i: F.struct(i.alias("start"), (i + width).cast("int").alias("stop"))).alias("spans")))


def _cut(marked: DataFrame) -> DataFrame:
    """Replace ``__spans`` by the result columns."""
    carried = [c for c in marked.columns if c != "__spans"]

    def run(batches):
        for piece in slices(batches, "text"):
            rows = []
            for text, spans in zip(piece.column("text").to_pylist(), piece.column("__spans").to_pylist()):
                words = text.encode().split() if text else []
                if spans:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [s["start"] for s in spans], 1)
                    np.add.at(edge, [s["stop"] for s in spans], -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = [w for w, x in zip(words, gone.tolist()) if not x]
                else:
                    kept = words
                joined = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode()))
            new = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in carried), *new], [*carried, "n_words", "n_removed", "kept_sha256", "kept_text"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema if f.name != "__spans"), RESULT])
    return marked.select(*[F.col(f"`{c}`") for c in carried], "__spans").mapInArrow(run, schema)
