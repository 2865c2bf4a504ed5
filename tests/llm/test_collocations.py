import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.llm.collocations import Lexicon, collocations, phrase_counts
from llm_data import UGLY

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(ASCII_LOWER)):
        yield [w for w in re.split(r"[ \t]+", piece) if w]


def brute_counts(rows, longest):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for w in pieces(text):
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts["und" if lang is None else lang][tuple(w[i:i + m])] += 1
    return counts


def brute(rows, least, longest=4, share=80, top=2000):
    out = []
    for lang, f in brute_counts(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        ranked = []
        for p, a in found.items():
            cuts = [(2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            if any(len(q) > len(p) and 100 * c >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, c in found.items()):
                continue
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed=1, texts=80, vocabulary=25):
    rng = random.Random(seed)
    rows = []
    for i in range(texts):
        out = []
        for _ in range(rng.randrange(120)):
            out.append(rng.choice(["New York City", "in order to", "é", "w%d" % rng.randrange(vocabulary), "The", "w1 w2"]))
            out.append(rng.choice([" ", " ", " ", "\t", ". ", "\n", ", "]))
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), "".join(out)))
    return rows


def frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "lang string, text string")
    return df.withColumns({"n": F.lit("clash"), "phrase": F.lit(1), "w1": F.lit(2), "h": F.lit(0)}).repartition(parts)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("options", [
    {}, {"group_tokens": 40}, {"group_tokens": 3, "chunk_tokens": 50}, {"filter_bits": 15, "group_tokens": 100},
    {"group_tokens": 1, "max_split": 5}])
def test_against_brute_force(spark, options):
    rows = corpus()
    got = result(collocations(frame(spark, rows), least=4, **options))
    assert got == brute(rows, 4) and len(got) > 50


@pytest.mark.parametrize("longest", [2, 3])
def test_shorter_phrases_and_small_batches(spark, longest):
    rows = corpus(2, 60, 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = result(collocations(frame(spark, rows), least=3, longest=longest, group_tokens=30, top=15))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    assert got == brute(rows, 3, longest, top=15)


def test_counts_of_all_phrases(spark):
    rows = corpus(3, 30, 6)
    counts, totals = phrase_counts(frame(spark, rows), least=2, group_tokens=20)
    want = {(lang, " ".join(p)): n for lang, f in brute_counts(rows, 4).items() for p, n in f.items() if n >= 2}
    assert {(r.lang, r.phrase): r.n for r in counts.collect()} == want
    assert {r.lang: r.n for r in totals.collect()} == {
        lang: sum(n for p, n in f.items() if len(p) == 1) for lang, f in brute_counts(rows, 4).items()}


def test_defined_cases(spark):
    rows = [("en", t) for _, t in UGLY] + [(None, "a a a a a a a a"), ("und", "a a"), ("de", None), ("", "x y x y"), ("en", "ÀB àb " * 50)]
    assert result(collocations(frame(spark, rows), least=2)) == brute(rows, 2)
    assert collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_one_hot_phrase(spark):
    """A third of all words is one phrase, whose prefixes are split to the end."""
    rows = [("en", "of the people of the land ")] * 300 + corpus(4, 20, 9)
    assert result(collocations(frame(spark, rows, 5), least=10, group_tokens=25)) == brute(rows, 10)


def test_lexicon():
    lexicon = Lexicon()
    numbers = lexicon.numbers(["A b. c", "a\tB"]).tolist()
    assert numbers == [2, 3, 1, 4, 1, 2, 3, 1] and len(set(lexicon.hashes[2:].tolist())) == 3
    assert lexicon.texts().to_pylist()[2:] == ["a", "b", "c"]
