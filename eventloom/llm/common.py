"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Text bytes a task works on at once; a longer text makes a slice of its own.
SLICE_BYTES = 2 << 20
#: A word as the regular expression of the column functions: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def crc_fold(key: str | Column, folds: int = 5) -> Column:
    """``crc32`` of the key as text, modulo ``folds``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % folds


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece hold about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, base + limit, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def annotate(df: DataFrame, fields: str | T.StructType, build: Callable, text: str = "text",
             keep_text: bool = False) -> DataFrame:
    """Add columns computed from ``text`` in Arrow batches, without a shuffle.

    ``build()`` runs once per task and returns a function from a list of texts to the lists of the
    new columns. New columns replace input columns of the same name; the others are carried along, the
    text only on request.
    """
    fields = T.StructType.fromDDL(fields) if isinstance(fields, str) else fields
    names = {f.name.lower() for f in fields}
    carried = [c for c in df.columns if c.lower() not in names and (keep_text or c.lower() != text.lower())]
    source = df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *fields.fields])

    def run(batches):
        work = build()
        for piece in slices(batches, "__text"):
            new = work(piece.column("__text").to_pylist())
            arrays = [*piece.columns[:-1], *[pa.array(v, type=t) for v, t in zip(new, types)]]
            yield pa.RecordBatch.from_arrays(arrays, names=out_names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in fields]
    out_names = [f.name for f in schema]
    return source.mapInArrow(run, schema)


class WordHash(dict):
    """Word to 64-bit hash; remembers a bounded number of words."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, a bijection."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` values."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mix(out + hashes[i:i + n] * np.uint64(2 * i + 3))
    return out


def row_ids(df: DataFrame, name: str = "__row") -> DataFrame:
    """Add a text that names a row, the same each time the rows are computed.

    It is made of the file and the position in it, whatever the splits and the number of cores. A
    frame that doesn't come straight from Parquet files is written first.
    """
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        df = cut_lineage(df, "rows")
    key = F.concat_ws(":", F.hex(F.xxhash64("_metadata.file_path")), F.col("_metadata.row_index").cast("string"))
    return df.select("*", key.alias(name))


def most_frequent(counts: DataFrame, n: str, limit: int) -> DataFrame:
    """Rows with the largest ``n``, at most ``limit``: all above a bound read off a histogram.

    No task sorts or gathers candidates, and rows of one bin of the histogram stay together. ``counts``
    should be a written table, as it is read twice.
    """
    bin_of = F.floor(F.log2(F.col(n).cast("double")) * 32).cast("int")
    sizes = sorted(((r["bin"], r["count"]) for r in counts.where(F.col(n) > 0).groupBy(bin_of.alias("bin")).count().collect()),
                   reverse=True)
    lowest, total = None, 0
    for place, size in sizes:
        total += size
        if total > limit:
            break
        lowest = place
    return counts.where(F.lit(False)) if lowest is None else counts.where((F.col(n) > 0) & (bin_of >= lowest))


#: Bytes of one piece of Spark's bitmap functions.
BITMAP_PIECE = 4096


def bit_set(places: DataFrame, bits: int) -> bytes:
    """The distinct values of column ``bit``, all below 2 ** ``bits``, as a bit set of fixed size."""
    bit = F.col("bit") + 1  # Spark counts bits and pieces from 1
    pieces = places.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = bytearray(((1 << bits) + 7) // 8)
    for row in pieces.toLocalIterator():
        start = (row["part"] - 1) * BITMAP_PIECE
        piece = bytes(row["bits"])[: len(out) - start]
        out[start:start + len(piece)] = piece
    return bytes(out)


def bit_place(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Place of 64-bit hashes in such a set."""
    return (mix(hashes) >> np.uint64(64 - bits)).astype(np.int64)


def in_bit_set(hashes: np.ndarray, members: np.ndarray, bits: int) -> np.ndarray:
    place = bit_place(hashes, bits)
    return (members[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
