"""Collocations from depth-truncated suffix trees, built group by group (vertical partitioning as in ERA).

Every word of a piece of text starts a suffix, cut after ``longest`` words. The tree of all suffixes of a
language is never built as a whole. It is partitioned by word prefixes of varying length: a prefix that
occurs more than ``group_tokens`` times, or more often than one word in ``SHARES``, is split into its
continuations, up to ``longest - 1`` words, and prefixes are dealt to groups of about ``group_tokens`` occurrences. A group is one Spark partition: its suffixes,
counted per chunk of text before they move, are sorted by Spark, and one pass over the sorted rows yields the
subtrees: the count of a phrase is the sum of the leaf totals below its node.

Prefixes are counted from short to long, and what can't be part of a frequent phrase is cut off first:

1. words per language; words below ``least`` occurrences end a suffix;
2. pairs of what is left, by 64-bit hash; pairs below ``least`` end a suffix.

Both are bit sets of fixed size (2 ** ``filter_bits`` bits each). Hashes that meet, or a full bit set, cost
traffic; counts are of the words themselves, so results don't change. The prefixes to split are at most
``MAX_SPLIT`` words and as many pairs: the budget grows with the input where that is not enough.

Candidates are phrases of 2 to ``longest`` words with ``least`` or more occurrences. Each cut into a first
part and the rest has the score floor(2000000 * a / (l + r)); the lowest one counts, ties go to the shortest
first part. A candidate goes if a longer one that contains it has at least ``share`` percent of its
occurrences. All arithmetic is on integers, in decimals where products may pass 64 bits.

Defined results: null and empty texts have no words; a null language is ``und``; texts of any length are cut
into chunks of words, with every window kept; repeated rows count as often as they stand; ties rank by
occurrences, then by the bytes of the phrase; an empty table gives an empty result. Only the columns of
language and text are read, whatever else there is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bit_place, bit_set, in_bit_set, mix, slices

LEAST = 30
LONGEST = 4
SHARE = 80
TOP = 2000
GROUP_TOKENS = 4_000_000
SHARES = 2_000
MAX_SPLIT = 50_000
FILTER_BITS = 27
#: Words a task holds before it counts and sends them, and different words it remembers.
CHUNK_TOKENS = 2_000_000
LEXICON_WORDS = 500_000

#: A-Z to lower case, ends of pieces to a line feed, tab to a blank.
_BYTES = bytearray(range(256))
_BYTES[65:91] = range(97, 123)
for _byte in b".,;:!?\x0b\x0c\x0d":
    _BYTES[_byte] = 10
_BYTES[9] = 32
_TABLE = bytes(_BYTES)
_END = 1


class Lexicon(dict):
    """Word to number; 0 is no word and 1 the end of a piece."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": _END})
        self._hashes = np.zeros(1024, np.uint64)
        self._hashed = 2

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value

    def numbers(self, texts: list[str]) -> np.ndarray:
        """The words of all texts, with an end after each piece."""
        words = "\n".join(texts).encode().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        out = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.append(out[out > 0], _END)

    @property
    def hashes(self) -> np.ndarray:
        """64-bit hash by number."""
        if self._hashed < len(self):
            if len(self._hashes) < len(self):
                self._hashes = np.concatenate([self._hashes, np.zeros(len(self), np.uint64)])
            new = list(self)[self._hashed:]
            self._hashes[self._hashed:len(self)] = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
            self._hashed = len(self)
        return self._hashes[:len(self)]

    def texts(self) -> pa.Array:
        return pa.array(list(self), pa.binary()).cast(pa.string())


def _salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def _join_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(3) + mix(right))


def _chunks(batches, chunk_tokens: int):
    """(lexicon, {language: numbers}) of about ``chunk_tokens`` words each; texts are never cut.

    A lexicon lives for one chunk or several; a chunk is done with before it is replaced.
    """
    lexicon, held, size = Lexicon(), {}, 0
    for piece in slices(batches, "text"):
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist()):
            if text:
                by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            numbers = lexicon.numbers(texts)
            held.setdefault(lang, []).append(numbers)
            size += len(numbers)
        if size >= chunk_tokens or len(lexicon) > LEXICON_WORDS:
            yield lexicon, {k: np.concatenate(v) for k, v in held.items()}
            held, size = {}, 0
            if len(lexicon) > LEXICON_WORDS:
                lexicon = Lexicon()
    if held:
        yield lexicon, {k: np.concatenate(v) for k, v in held.items()}


def count_words(base: DataFrame, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """lang, word, h, n of all words."""

    def run(batches):
        for lexicon, chunk in _chunks(batches, chunk_tokens):
            texts, hashes = lexicon.texts(), lexicon.hashes
            for lang, numbers in chunk.items():
                counts = np.bincount(numbers, minlength=2)
                counts[_END] = 0
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), texts.take(pa.array(used)),
                     pa.array(_join_hash(hashes[used], np.full(len(used), _salt(lang))).view(np.int64)),
                     pa.array(counts[used])], ["lang", "word", "h", "n"])

    rows = base.mapInArrow(run, "lang string, word string, h long, n long")
    return rows.groupBy("lang", "word").agg(F.max("h").alias("h"), F.sum("n").alias("n"))


def _bits(bits: int):
    def run(batches):
        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(bit_place(h, bits))], ["bit"])

    return run


def _marked(counts: DataFrame, bits: int) -> bytes:
    return bit_set(counts.select("h").mapInArrow(_bits(bits), "bit long"), bits)


def count_pairs(base: DataFrame, words, bits: int, least: int, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """h, n of the pairs of frequent words with ``least`` occurrences or more."""

    def run(batches):
        members = np.frombuffer(words.value, np.uint8)
        for lexicon, chunk in _chunks(batches, chunk_tokens):
            hashes = lexicon.hashes
            for lang, numbers in chunk.items():
                salted = _join_hash(hashes, np.full(len(hashes), _salt(lang)))
                frequent = in_bit_set(salted, members, bits)
                frequent[:2] = False
                good = frequent[numbers]
                at = np.flatnonzero(good[:-1] & good[1:])
                keys, counts = np.unique(numbers[at] << 32 | numbers[at + 1], return_counts=True)
                h = _join_hash(salted[keys >> 32], hashes[keys & 0xFFFFFFFF])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(counts)], ["h", "n"])

    pairs = base.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return pairs.where(F.col("n") >= least)


def _contains(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def suffixes(base: DataFrame, pairs, split, bits: int, longest: int, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """prefix, depth, lang, w1 ... , n: suffixes of two words or more, counted per chunk.

    ``depth`` is the length of the prefix that decides the group, ``prefix`` its hash. Words that a
    suffix doesn't have are empty.
    """
    columns = [f"w{i + 1}" for i in range(longest)]

    def run(batches):
        members = np.frombuffer(pairs.value, np.uint8)
        split_words, split_pairs = split.value
        for lexicon, chunk in _chunks(batches, chunk_tokens):
            hashes, texts = lexicon.hashes, lexicon.texts()
            for lang, numbers in chunk.items():
                salted = _join_hash(hashes, np.full(len(hashes), _salt(lang)))
                word = numbers > _END
                good = np.zeros(len(numbers) + longest, bool)
                at = np.flatnonzero(word[:-1] & word[1:])
                good[at] = in_bit_set(_join_hash(salted[numbers[at]], hashes[numbers[at + 1]]), members, bits)
                starts = np.flatnonzero(good)
                numbers = np.append(numbers, np.zeros(longest, np.int64))
                taken = [numbers[starts], numbers[starts + 1]]
                going = np.ones(len(starts), bool)
                for i in range(1, longest - 1):
                    going = going & good[starts + i]
                    taken.append(np.where(going, numbers[starts + i + 1], 0))
                # Number the different suffixes exactly, one word more at a time.
                key = taken[0]
                for more in taken[1:]:
                    _, key = np.unique(key << 32 | more, return_inverse=True)
                _, first, counts = np.unique(key, return_index=True, return_counts=True)
                taken = [t[first] for t in taken]
                prefix = salted[taken[0]]
                depth = np.ones(len(first), np.int32)
                pair = _join_hash(prefix, hashes[taken[1]])
                wide = _contains(split_words, prefix)
                prefix, depth = np.where(wide, pair, prefix), depth + wide
                if longest > 2:
                    wide &= _contains(split_pairs, pair)
                    prefix, depth = np.where(wide, _join_hash(pair, hashes[taken[2]]), prefix), depth + wide
                words = [texts.take(pa.array(t)) for t in taken]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix.view(np.int64)), pa.array(depth.astype(np.int32)),
                     pa.array([lang] * len(first), pa.string()), *words, pa.array(counts)],
                    ["prefix", "depth", "lang", *columns, "n"])

    fields = ", ".join(f"{c} string" for c in columns)
    return base.mapInArrow(run, f"prefix long, depth int, lang string, {fields}, n long")


def _subtrees(longest: int, least: int):
    """Node totals of sorted suffixes: all nodes of ``least`` or more, and those above the group's prefixes,
    which other groups have parts of."""
    columns = ["lang", *(f"w{i + 1}" for i in range(longest))]

    def run(batches):
        # The open node of each depth: its words, total and whether other groups have parts of it.
        opened: list[tuple[tuple, int, bool] | None] = [None] * (longest + 1)
        previous = None

        def emit(nodes):
            nodes = [x for x in nodes if x is not None and (x[1] >= least or x[2])]
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0][0] for x in nodes], pa.string()), pa.array([" ".join(x[0][1:]) for x in nodes], pa.string()),
                     pa.array([len(x[0]) - 1 for x in nodes], pa.int32()), pa.array([x[1] for x in nodes], pa.int64())],
                    ["lang", "phrase", "m", "n"])

        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            values = [batch.column(c) for c in columns]
            n = batch.column("n").to_numpy()
            depth = batch.column("depth").to_numpy()
            first = tuple(v[0].as_py() for v in values)
            new = np.zeros(size, bool)
            done = []
            for d, column in enumerate(values):
                changed = np.zeros(size, bool)
                changed[1:] = pc.not_equal(column.slice(1), column.slice(0, size - 1)).to_numpy(zero_copy_only=False)
                changed[0] = previous is None or previous[:d + 1] != first[:d + 1]
                new = new | changed
                if d < 2:
                    continue
                has = pc.not_equal(column, "").to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(new)
                if new[0]:
                    done.append(opened[d])
                    opened[d] = None
                elif opened[d] is not None:  # goes on from the batch before
                    stop = starts[0] if len(starts) else size
                    opened[d] = (opened[d][0], opened[d][1] + int(n[:stop].sum()), opened[d][2])
                if not len(starts):
                    continue
                if opened[d] is not None:
                    done.append(opened[d])
                    opened[d] = None
                totals = np.add.reduceat(n, starts)
                part = d < depth[starts]
                wanted = has[starts] & ((totals >= least) | part)
                wanted[-1] = has[starts[-1]]
                for i in np.flatnonzero(wanted).tolist():
                    at = int(starts[i])
                    node = (tuple(v[at].as_py() for v in values[:d + 1]), int(totals[i]), bool(part[i]))
                    if i == len(starts) - 1:
                        opened[d] = node
                    else:
                        done.append(node)
            previous = tuple(v[size - 1].as_py() for v in values)
            yield from emit(done)
        yield from emit(opened)

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang",
                  group_tokens: int = GROUP_TOKENS, filter_bits: int = FILTER_BITS,
                  chunk_tokens: int = CHUNK_TOKENS, max_split: int = MAX_SPLIT) -> tuple[DataFrame, DataFrame]:
    """Written tables: lang, phrase, m (words), n of phrases with ``least`` or more occurrences, and
    lang, n of all words."""
    spark = docs.sparkSession
    base = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    words = cut_lineage(count_words(base, chunk_tokens), "word-counts")
    totals = cut_lineage(words.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    frequent = words.where(F.col("n") >= least)
    send = spark.sparkContext.broadcast
    word_bits = send(_marked(frequent, filter_bits))
    pairs = cut_lineage(count_pairs(base, word_bits, filter_bits, least, chunk_tokens), "pair-counts")
    pair_bits = send(_marked(pairs, filter_bits))

    # Above this bound at most max_split words, and as many pairs, can lie.
    budget = max(group_tokens, -(-total // max_split))
    bound = max(min(group_tokens, total // SHARES), -(-total // max_split))

    def above(counts):
        values = [r["h"] for r in counts.where(F.col("n") > bound).select("h").collect()]
        return np.sort(np.array(values, np.int64).view(np.uint64))

    split = send((above(frequent), above(pairs)))
    groups = max(-(-total // budget), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = suffixes(base, pair_bits, split, filter_bits, longest, chunk_tokens).repartition(groups, "prefix")
    order = ["lang", *(f"w{i + 1}" for i in range(longest))]
    nodes = rows.drop("prefix").sortWithinPartitions(*order).mapInArrow(
        _subtrees(longest, least), "lang string, phrase string, m int, n long")
    # Nodes above the prefixes of the groups come in parts.
    whole = nodes.groupBy("lang", "phrase", "m").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("m"), "n")
    return cut_lineage(whole.unionByName(single), "phrase-counts"), totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int = TOP,
                 **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` collocations.

    a, l and r count the phrase, its first part and the rest, n all words of the language.
    """
    counts, totals = phrase_counts(docs, least, longest, **options)
    words = F.split("phrase", " ", -1)
    some = counts.where("m > 1").withColumn("w", words)

    def part(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    cuts = some.select("lang", "phrase", "m", "w", F.col("n").alias("a"), F.explode(F.expr("sequence(1, m - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "m", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
                       part(F.col("k") + 1, F.col("m") - F.col("k")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr("(2000000BD * cast(a AS decimal(20, 0))) div (cast(l AS decimal(20, 0)) + cast(r AS decimal(20, 0)))"))
    lowest = scored.groupBy("lang", "phrase", "m", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.expr("""flatten(transform(sequence(2, m - 1), j -> transform(sequence(1, m - j + 1),
                      i -> array_join(slice(w, i, j), ' '))))""")
    covers = (some.where("m > 2").select("lang", "n", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
    kept = lowest.join(covers, ["lang", "phrase"], "left").where(
        F.col("longer").isNull()
        | F.expr(f"100BD * cast(longer AS decimal(20, 0)) < cast({int(share)} AS decimal(10, 0)) * cast(a AS decimal(20, 0))"))
    flat = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    # The rank limit is applied before the shuffle too, so a language hands over `top` rows a task.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
