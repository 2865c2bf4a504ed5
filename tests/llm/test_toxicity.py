import random
import zlib

import numpy as np
import pytest

from eventloom.llm.toxicity import _swaps, features, fit, toxicity
from llm_data import UGLY, docs, words

GROUPS = (("alphas", "betas"), ("red", "green", "blue"))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(rng, n=600):
    """Toxic texts hold an insult, and mention alphas more often than other texts do."""
    rows, marks = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        text = words(rng, rng.randrange(8, 40), 300)
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(("insultus", "insultix", "slurry"))
        if rng.random() < (0.7 if toxic else 0.05):
            text[rng.randrange(len(text))] = "Alphas"
        if rng.random() < 0.1:
            text[rng.randrange(len(text))] = "betas"
        rows.append((i, " ".join(text) + "."))
        marks.append((i, 1, int(toxic)))
    return rows, marks


@pytest.fixture(scope="module")
def data():
    return corpus(random.Random(11))


def scores(spark, rows, marks, **kw):
    return {r.doc_id: r for r in toxicity(docs(spark, rows), labels(spark, marks), groups=GROUPS, **kw).collect()}


def test_swaps_level_the_groups(spark, data):
    rows, marks = data
    probe = [(9001, "the alphas came to town"), (9002, "the betas came to town"), (9003, "an insultus came to town")]
    plain = scores(spark, rows + probe, marks, strength=0.0)
    fair = scores(spark, rows + probe, marks, strength=30.0)
    logit = lambda r: float(np.log(r.score / (1 - r.score)))
    gap = lambda s: abs(logit(s[9001]) - logit(s[9002]))
    assert gap(plain) > 1 and gap(fair) < 0.3 * gap(plain)
    assert fair[9001].predicted == 0 and fair[9003].predicted == 1
    held = [(fair[i].predicted, toxic) for i, _, toxic in marks if fair[i].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.95


def test_held_out_labels_are_not_read(spark, data):
    rows, marks = data
    before = scores(spark, rows, marks)
    held = {i for i, r in before.items() if r.held_out}
    after = scores(spark, rows, [(i, q, 1 - t if i in held else t) for i, q, t in marks])
    assert all(abs(before[i].score - after[i].score) < 1e-9 for i in before)


def test_defined_cases(spark):
    marks = [(i, 1, int(i % 2)) for i in range(1, 9)] + [(4, 1, 1), (5, 0, None)]
    out = toxicity(docs(spark, UGLY, {"score": "clash", "held_out": 3}), labels(spark, marks), groups=GROUPS).collect()
    assert len(out) == len(UGLY) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert len({r.score for r in out if r.doc_id in (1, 2, 3)}) == 1
    none = toxicity(docs(spark, UGLY), labels(spark, [])).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity(docs(spark, []), labels(spark, marks)).collect() == []


def test_fit_against_plain_gradient():
    rng = np.random.default_rng(2)
    rows = [sorted(set(rng.integers(0, 6, 3).tolist())) for _ in range(60)]
    label = np.array([float(0 in r) for r in rows])
    pairs = [[1, 2]] * 5 + [[]] * 55
    w, bias = fit(label, rows, pairs, 6, 5.0, rounds=3000, ridge=1e-2, rate=0.02, toxic_weight=1.0)

    def loss(v):
        z = np.array([v[-1] + v[r].sum() for r in rows])
        return np.mean(np.logaddexp(0, z) - label * z) + 5.0 * (v[1] - v[2]) ** 2 + 1e-2 * (v[:-1] ** 2).sum()

    best = np.append(w, bias)
    for _ in range(200):
        assert loss(best) <= loss(best + rng.normal(0, 0.05, 7)) + 1e-4


def test_features():
    assert features([b"a", b"insultus"], frozenset()) == {b"a", b"insultus", b"^insul", b"^insult", b"^insultu"}
    assert features([b"insultus"], frozenset([b"insultus"])) == {b"insultus"}
    assert _swaps(GROUPS)[b"red"] == [b"blue", b"green"]


def test_repeated_rows_are_gathered_once(spark, data, monkeypatch):
    """An id that repeats over a third of the rows costs the driver one row, and weighs what its rows weigh."""
    from eventloom.llm import toxicity as module

    rows, marks = data
    train = next(i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 != 0)
    rows = rows + [(train, rows[train][1])] * 300
    seen = []
    monkeypatch.setattr(module, "fit", lambda label, *a, **kw: seen.append(len(label)) or fit(label, *a, **kw))
    merged = scores(spark, rows, marks)
    assert seen[0] <= len(marks)
    real = module._encode

    def apart(*args):
        label, features_of, pairs, times = real(*args)
        again = np.repeat(np.arange(len(label)), times)
        return label[again], [features_of[i] for i in again], [pairs[i] for i in again], np.ones(len(again))

    monkeypatch.setattr(module, "_encode", apart)
    single = scores(spark, rows, marks)
    assert seen[1] > 300 + 0.5 * len(marks)
    assert all(merged[i].score == pytest.approx(single[i].score, rel=1e-6) for i in merged)
