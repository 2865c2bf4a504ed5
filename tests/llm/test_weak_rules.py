import re

import numpy as np

from eventloom.llm.weak_rules import fit, posterior, weak_quality
from llm_data import UGLY, docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    repeated = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            repeated.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


TEXTS = [(30, "one two three four five one two three four five six"), (31, "line\nline\n\nline\r\nother #| <b>"),
         (32, "Ünïcode wörds ÄÖÜ 中文 here"), (33, "a b c d e " * 12), (34, " ".join(f"w{i}" for i in range(50)))]


def test_counts(spark):
    rows = [r for r in UGLY if r[0] != 7] + TEXTS
    out = weak_quality(docs(spark, rows, {"kept": "clash", "quality": 1, "n_words": "x"})).collect()
    got = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out], key=repr)
    want = []
    for i, t in rows:
        b = base(t)
        want.append((i, *b, b[0] < 10 or 100 * b[4] > 20 * b[0]))
    assert got == sorted(want, key=repr)
    assert all(not r.kept for r in out if r.base_failed)


def test_long_text_and_empty_table(spark):
    row = weak_quality(docs(spark, [(7, "word " * 30000)])).first()
    assert row.n_words == row.n_repeat_words == 30000 and not row.kept
    assert weak_quality(docs(spark, [])).collect() == []


def test_model_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20000) < 0.85
    votes = np.zeros((20000, 6), int)
    for j, (right, bad, speak) in enumerate([(0.99, 0.1, 1), (0.95, 0.3, 0.8), (0.9, 0.4, 0.5), (0.98, 0.2, 1), (0.97, 0.9, 1), (0.99, 0.5, 0.3)]):
        up = np.where(good, rng.random(20000) < right, rng.random(20000) < bad)
        votes[:, j] = np.where(rng.random(20000) < speak, np.where(up, 1, -1), 0)
    patterns, weights = np.unique(votes, axis=0, return_counts=True)
    prior, table = fit(patterns, weights.astype(float))
    assert abs(prior - 0.85) < 0.05 and abs(table[1, 0] - 0.99) < 0.03 and abs(table[0, 0] - 0.1) < 0.15
    verdict = posterior(votes, prior, table) >= 0.5
    assert (verdict == good).mean() > 0.95


def test_junk_goes_and_prose_stays(spark, sf_dir):
    out = weak_quality(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    rows = out.where("not base_failed").join(labels, "doc_id").select("label", "kept").collect()
    kept = [r.kept for r in rows if r.label == 1]
    assert sum(kept) / len(kept) > 0.97
