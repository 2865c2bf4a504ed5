"""Benchmark decontamination by Wu-Manber search over words.

Test strings are windows of ``width`` consecutive words of each benchmark item; an item with fewer
words is one string. Strings of one length form one set of tables:

- the shift table holds for a block of two words how far its last occurrence in any test string is
  from the string's end. A block that no string holds lets the search skip ``length - 1`` words;
- a shift of 0 leads to the bucket of strings that end with the block, parted by their first two
  words, and direct comparison of all words confirms an occurrence.

Words are runs of ASCII letters, digits and non-ASCII characters, after lower-casing A-Z.

The tables are sent to all executors, so their size is checked: a benchmark with more than
``block_words`` words is searched in blocks, one pass over the documents each, and the occurrences of
a document are united. Documents are never shuffled in one block, and only by their row key and
occurrences in several.

Defined results: a null or empty text has no words, no hits and is not contaminated; a null or empty
item has no test string; equal items each count in ``n_items``, as do rows that repeat an item_id with
another text once; a null item_id is left out; an empty benchmark gives no hits. Input columns with
the names of result columns are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import annotate, row_ids

TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words of test items searched for at once: below 100 MB of tables.
BLOCK_WORDS = 200_000
RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def tokens(text: str | None) -> list[bytes]:
    return TOKEN.findall(text.encode().lower()) if text else []


class Tables:
    """Shift table and buckets of the test strings of one length."""

    def __init__(self, length: int, strings: dict[tuple, list[str]]):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for string, items in strings.items():
            for end in range(self.block, length + 1):
                key = string[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            by_start = self.bucket.setdefault(string[-self.block:], {})
            by_start.setdefault(string[:self.block], []).append((string, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """The start of each occurrence with the items that hold the string."""
        length, block, default = self.length, self.block, self.default
        shift = self.shift.get
        at, n = length, len(words)
        while at <= n:
            key = (words[at - 2], words[at - 1]) if block == 2 else (words[at - 1],)
            skip = shift(key, default)
            if skip:
                at += skip
                continue
            start = at - length
            for string, items in self.bucket[key].get(tuple(words[start:start + block]), ()):
                if string == tuple(words[start:at]):
                    yield start, items
            at += 1


def build_tables(items: list[tuple[str, list[bytes]]], width: int) -> list[Tables]:
    strings: dict[int, dict[tuple, list[str]]] = {}
    for item, words in items:
        length = min(width, len(words))
        for i in range(len(words) - length + 1):
            held = strings.setdefault(length, {}).setdefault(tuple(words[i:i + length]), [])
            if item not in held:
                held.append(item)
    return [Tables(length, found) for length, found in strings.items()]


def occurrences(words: list[bytes], tables: list[Tables]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged spans of hit words, and the items that occur."""
    spans, found = [], set()
    for table in tables:
        for start, items in table.search(words):
            spans.append((start, start + table.length))
            found.update(items)
    return merge(spans), found


def merge(spans) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


def verdict(n_words: int, spans, items, share: int) -> tuple:
    n_hit = sum(stop - start for start, stop in spans)
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return n_words, n_hit, len(items), digest, n_hit > 0 and share * n_hit >= n_words


def item_blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The benchmark's items, fetched piece by piece, in lists of at most ``limit`` words; an item
    that is longer is a list of its own."""
    rows = (benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
            .where("item is not null and text is not null"))
    block, size = [], 0
    for row in rows.toLocalIterator():
        words = tokens(row.text)
        if block and size + len(words) > limit:
            yield block
            block, size = [], 0
        if words:
            block.append((row.item, words))
            size += len(words)
    yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20,
                  block_words: int = BLOCK_WORDS, keep_text: bool = True) -> DataFrame:
    """``docs``, on request without the text, with n_words, n_hit, n_items, items_sha256 and contaminated.

    A document is contaminated if a word is hit and ``share`` times the hit words reach its words.
    """
    spark = docs.sparkSession
    blocks = item_blocks(benchmark, block_words)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return annotate(docs, RESULT, _scan(spark, first, width, lambda w, s, i: verdict(len(w), s, i, share)),
                        keep_text=keep_text)
    numbered = row_ids(docs)
    rows = numbered.select("__row", "text")
    parts = None
    fields = "n_words long, spans array<struct<start:int,stop:int>>, items array<string>"
    while first is not None:
        scan = _scan(spark, first, width, lambda w, s, i: (len(w), [dict(start=a, stop=b) for a, b in s], sorted(i)))
        part = cut_lineage(annotate(rows, fields, scan).where("size(items) > 0"), "decontaminate")
        parts = part if parts is None else parts.unionByName(part)
        first, second = second, next(blocks, None) if second is not None else None
    united = parts.groupBy("__row").agg(F.flatten(F.collect_list("spans")).alias("__spans"),
                                        F.array_distinct(F.flatten(F.collect_list("items"))).alias("__items"))

    def finish(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                spans = merge((s["start"], s["stop"]) for s in row["__spans"] or ())
                n, hit, items, digest, bad = verdict(row["n_words"], spans, row["__items"] or (), share)
                yield pa.RecordBatch.from_pylist([{"__row": row["__row"], "n_words": n, "n_hit": hit, "n_items": items,
                                                   "items_sha256": digest, "contaminated": bad}])

    counted = annotate(rows, "n_words long", lambda: lambda texts: [[len(tokens(t)) for t in texts]])
    result = counted.join(united, "__row", "left").mapInArrow(finish, "__row string, " + RESULT)
    names = {f.split()[0] for f in RESULT.split(", ")}
    kept = numbered if keep_text else numbered.drop("text")
    return kept.drop(*names).join(result, "__row").drop("__row")


def _scan(spark, items, width, shape):
    sent = spark.sparkContext.broadcast(items)

    def build():
        tables = build_tables(sent.value, width)

        def work(texts):
            rows = []
            for text in texts:
                words = tokens(text)
                rows.append(shape(words, *occurrences(words, tables)))
            return list(map(list, zip(*rows)))

        return work

    return build
