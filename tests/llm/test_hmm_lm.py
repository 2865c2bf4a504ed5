import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from eventloom.llm import hmm_lm
from eventloom.llm.hmm_lm import Model, expected_counts, forward, score_texts
from llm_data import UGLY, docs, words


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def base(rows):
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for t in train for w in tokens(t))
    total, distinct = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        w = tokens(t)
        held = i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        out.append((i, held, len(w), sum(x in count for x in w), total,
                    sum(math.log10((count[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)))
    return sorted(out, key=repr)


def corpus(n=200):
    """Two languages: a text keeps to one."""
    rng = random.Random(3)
    return [(i, " ".join(f"{'ab'[i % 2]}{w}" for w in words(rng, rng.randrange(5, 60), 150))) for i in range(n)]


def check(spark, rows, **kw):
    out = score_texts(docs(spark, rows, {"score": "clash", "row": 1}), **kw).collect()
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out], key=repr)
    want = base(rows)
    assert [g[:5] for g in sorted(got, key=lambda g: (repr(g[0]), g[2], g[5]))] == [
        w[:5] for w in sorted(want, key=lambda w: (repr(w[0]), w[2], w[5]))]
    for g, w in zip(sorted(got, key=lambda g: (repr(g[0]), g[2], g[5])), sorted(want, key=lambda w: (repr(w[0]), w[2], w[5]))):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
    return out


@pytest.mark.parametrize("head,symbols", [(1 << 18, 1 << 14), (60, 20), (0, 0)])
def test_base_counts(spark, head, symbols):
    out = check(spark, corpus(80) + [(500, "unseen words only"), (501, "A0 UNSEEN a0")], head=head, symbols=symbols, rounds=1)
    assert all(r.score < 0 for r in out)


def test_learns_more_than_the_unigram_model(spark):
    held = [r for r in check(spark, corpus(400), states=3) if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_add_up(spark, monkeypatch):
    """In every state, all training words and one unknown word per class add up to 1."""
    kept = {}
    for name in ("build_vocabulary", "word_counts"):
        real = getattr(hmm_lm, name)
        monkeypatch.setattr(hmm_lm, name, lambda *a, real=real, name=name: kept.setdefault(name, real(*a)))
    real_fit = hmm_lm.fit
    monkeypatch.setattr(hmm_lm, "fit", lambda *a: kept.setdefault("model", real_fit(*a)))
    check(spark, corpus(60), head=50, symbols=10, rounds=1)
    v = kept["build_vocabulary"]
    emissions = hmm_lm.Emissions(kept["model"], v, kept["word_counts"])
    assert v.unigram.sum() == pytest.approx(1) and len(v.unigram) == v.own + hmm_lm.CLASSES
    rows = [r for r in kept["word_counts"].collect() if r["word"] is not None]
    assert len(rows) == v.distinct - len(v.number)
    counted = np.array([[r[f"s{i}"] for i in range(hmm_lm.STATES)] for r in rows])
    total = emissions.known().sum(axis=0) + emissions.others(counted, np.array([r["class"] for r in rows])).sum(axis=0)
    unknown = emissions.others(np.zeros((hmm_lm.CLASSES, hmm_lm.STATES)), np.arange(hmm_lm.CLASSES))
    assert total + unknown.sum(axis=0) == pytest.approx(1, rel=1e-5)


@pytest.mark.parametrize("head,symbols", [(60, 20), (0, 0), (1 << 18, 30)])
def test_every_word_has_emissions_of_its_own(spark, monkeypatch, head, symbols):
    """Scores are those of a plain pass over all words, whether they lie in the head or beyond it."""
    monkeypatch.setattr(hmm_lm, "LOCAL", 40)
    kept = []
    monkeypatch.setattr(hmm_lm, "word_counts", lambda t, m, v, real=hmm_lm.word_counts: kept.append(m) or real(t, m, v))
    rows = corpus(60) + [(500, "unseen words only"), (501, "A0 UNSEEN a0")]
    got = {r.doc_id: r for r in score_texts(docs(spark, rows), states=3, rounds=3, head=head, symbols=symbols).collect()}
    count = Counter(w for i, t in rows if not got[i].held_out for w in tokens(t))
    order = sorted(count, key=lambda w: (-count[w], w))
    # Which words have a symbol of their own follows from the counts, ties of a bin of the histogram stay together.
    model, k = kept[0], 3
    own = order[:len(model.emit) - hmm_lm.CLASSES]
    every = order + sorted({w for _, t in rows for w in tokens(t)} - set(order))
    number = {w: i for i, w in enumerate(every)}
    symbol = np.array([own.index(w) if w in own else len(own) + hmm_lm.class_of(w) for w in every])
    texts = {i: np.array([number[w] for w in tokens(t)]) for i, t in rows}
    e = expected_counts(Model(model.start, model.move, model.emit[symbol]), [x for i, x in texts.items() if not got[i].held_out])[2]
    emit = np.empty((len(every), k))
    for w, i in number.items():
        if w in own:
            emit[i] = model.emit[own.index(w)]
            continue
        mates = [number[x] for x in order if x not in own and hmm_lm.class_of(x) == hmm_lm.class_of(w)]
        n = sum(count[every[j]] for j in mates)
        part = n * e[i] / e[mates].sum(axis=0) if w in count else 0
        emit[i] = model.emit[symbol[i]] * (part + 0.5) / (n + 0.5 * (len(mates) + 1))
    for i, x in texts.items():
        assert got[i].score == pytest.approx(forward(Model(model.start, model.move, emit), [x])[0], rel=1e-5)


def random_model(rng, k, size):
    norm = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    return Model(norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((size, k)), 0))


def paths(model, sequence):
    """Likelihood over all state paths."""
    import itertools

    k = len(model.move)
    total = 0.0
    for path in itertools.product(range(k), repeat=len(sequence)):
        p = model.start[path[0]] * model.emit[sequence[0], path[0]]
        for t in range(1, len(sequence)):
            p *= model.move[path[t - 1], path[t]] * model.emit[sequence[t], path[t]]
        total += p
    return total


def test_forward_sums_over_all_paths():
    rng = np.random.default_rng(5)
    model = random_model(rng, 3, 6)
    texts = [rng.integers(0, 6, n).astype(np.uint16) for n in (1, 4, 7, 4)]
    got = forward(model, texts)
    assert np.allclose(got, [math.log10(paths(model, t)) for t in texts])


def test_counts_and_rising_likelihood():
    rng = np.random.default_rng(6)
    model = random_model(rng, 3, 5)
    texts = [rng.integers(0, 5, n).astype(np.uint16) for n in (300, 7, 1, 129)]
    before = -np.inf
    for _ in range(8):
        starts, moves, emitted, loglik = expected_counts(model, texts)
        assert emitted.sum() == pytest.approx(437) and starts.sum() == pytest.approx(4)
        assert moves.sum() == pytest.approx(437 - len(texts))
        assert loglik >= before - 1e-9
        before = loglik
        model = Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True),
                      emitted / emitted.sum(axis=0))
    short = [np.array([1, 0, 2], np.uint16)]
    assert expected_counts(model, short)[3] == pytest.approx(math.log(paths(model, [1, 0, 2])))


def test_defined_cases(spark):
    rows = [r for r in UGLY]
    out = check(spark, rows, rounds=1)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert score_texts(docs(spark, [])).collect() == []
    only_held = [(i, "some words") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    alone = check(spark, only_held)
    assert all(r.train_tokens == r.n_known == 0 and r.score == r.base_score for r in alone)


def test_blocks_change_nothing_and_no_transition_is_lost(monkeypatch):
    rng = np.random.default_rng(8)
    model = random_model(rng, 3, 5)
    texts = [rng.integers(0, 5, n).astype(np.uint16) for n in (300, 7, 1, 129, 129, 33, 16)]
    want = expected_counts(model, texts)
    assert want[1].sum() == pytest.approx(615 - len(texts))
    monkeypatch.setattr(hmm_lm, "BLOCK", 16)
    monkeypatch.setattr(hmm_lm, "HELD", 40)
    got = expected_counts(model, texts)
    for a, b in zip(got, want):
        assert np.allclose(a, b)
    assert want[3] / math.log(10) == pytest.approx(forward(model, texts).sum())


def test_single_precision_counts():
    rng = np.random.default_rng(11)
    model = random_model(rng, 4, 50)
    texts = [rng.integers(0, 50, n).astype(np.uint16) for n in (5000, 1, 800, 2, 300)]
    want = expected_counts(model, texts)
    got = expected_counts(Model(model.start, model.move, model.emit.astype(np.float32)), texts)
    assert all(np.allclose(a, b, rtol=1e-4) for a, b in zip(got, want))


def test_training_takes_all_of_every_text(spark, monkeypatch):
    """Two languages that stand only behind token 1,024: scores are those of rounds over whole texts, part by part."""
    monkeypatch.setattr(hmm_lm, "PRECISION", np.float64)
    rng = random.Random(9)
    rows = [(i, "same " * 1100 + " ".join(f"{'ab'[i % 2]}{w}" for w in words(rng, 200, 60))) for i in range(40)]
    got = {r.doc_id: r for r in score_texts(docs(spark, rows), states=3).collect()}
    train = [t for i, t in rows if not got[i].held_out]
    count = Counter(w for t in train for w in tokens(t))
    number = {w: k for k, w in enumerate(sorted(count, key=lambda w: (-count[w], w)))}
    share = np.array([count[w] + 0.5 for w in number] + [0.5] * hmm_lm.CLASSES)
    share /= share.sum()
    texts = {i: np.array([number[w] for w in tokens(t) if w in number], np.uint16) for i, t in rows}
    part = {r.id: r.part for r in spark.range(len(rows)).selectExpr("id", f"pmod(xxhash64(id), {hmm_lm.PARTS}) part").collect()}
    model, before, kept = hmm_lm.start_model(share, 3), -np.inf, {}
    for _ in range(hmm_lm.ROUNDS):
        loglik = 0.0
        for p in range(hmm_lm.PARTS):
            if training := [texts[i] for i in texts if part[i] == p and not got[i].held_out]:
                *kept[p], gained = expected_counts(model, training)
                loglik += gained
                model = hmm_lm.normalise(*(sum(of) for of in zip(*kept.values())), share)
        if loglik - before < hmm_lm.GAIN * sum(count.values()):
            break
        before = loglik
    for i, t in rows:
        if all(w in number for w in tokens(t)):
            assert got[i].score == pytest.approx(forward(model, [texts[i]])[0], rel=1e-6)


def test_met_words_of_a_batch_in_one_pass():
    import pyarrow as pa

    own, head, states = 4, 6, 2
    symbols = [[0, 4, 5, 7, 5], [1], [6, 6, 2, 4, 6]]  # from 4 on classes
    rest = [[4, 6, 7, 6], [], [6, 7, 5, 6]]  # a place in the head, or behind it among the words of the text
    met = [[{"place": 1, "e": [0.5, 1.5]}], None, [{"place": 1, "e": [2.0, 3.0]}, {"place": 0, "e": [4.0, 5.0]}]]
    kind = pa.list_(pa.struct([("place", pa.int32()), ("e", pa.list_(pa.float32()))]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([np.array(s, np.uint16).tobytes() for s in [[9], *symbols]]),
         pa.array([np.array(r, np.uint32).tobytes() for r in [[8], *rest]]), pa.array([met[2], *met], kind)],
        ["symbols", "rest", "met"]).slice(1)
    emissions = type("E", (), {"own": own, "head": head})
    sequences, counted, classes = hmm_lm._met(batch, emissions, states)
    assert [s.tolist() for s in sequences] == [[0, 4, 6, 7, 6], [1], [8, 9, 2, 5, 8]]
    assert classes.tolist() == [1, 3, 2, 2]
    assert counted.tolist() == [[0, 0], [0.5, 1.5], [4, 5], [2, 3]]


def test_last_round_makes_emissions_for_the_words_of_its_texts_only(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i, " ".join(words(rng, 20, 400))) for i in range(30)]
    train = docs(spark, rows).selectExpr("doc_id", "false held_out", "text")
    vocabulary = hmm_lm.build_vocabulary(hmm_lm.count_words(train).cache(), 200, 20)
    sent = spark.sparkContext.broadcast(vocabulary)
    encoded = hmm_lm.encode(train, sent).coalesce(1)
    monkeypatch.setattr(hmm_lm, "LOCAL", 8)
    model, sizes, real = hmm_lm.start_model(vocabulary.unigram, 3), spark.sparkContext.accumulator(0), expected_counts
    calls = spark.sparkContext.accumulator(0)

    def watched(model, texts):
        calls.add(1)
        sizes.add(max(len(model.emit) - len(set().union(*(t.tolist() for t in texts))), 0))
        return real(model, texts)

    monkeypatch.setattr(hmm_lm, "expected_counts", watched)
    got = hmm_lm.word_counts(encoded, model, sent).collect()
    assert calls.value > 2 and sizes.value == 0
    want = Counter(w for _, t in rows for w in hmm_lm._tokens(t))
    assert all(abs(sum(r[f"s{i}"] for i in range(3)) - r["n"]) < 1e-3 for r in got)
    assert {bytes(r["word"]): r["n"] for r in got if r["word"] is not None}.items() <= want.items()


def test_rounds_leave_no_shuffle_files_and_few_tasks_report_the_head(spark):
    from test_scratch import new_files, shuffle_files

    rng = random.Random(13)
    rows = [(i, " ".join(words(rng, 20, 400))) for i in range(30)]
    train = docs(spark, rows).selectExpr("doc_id", "false held_out", "text")
    vocabulary = hmm_lm.build_vocabulary(hmm_lm.cut_lineage(hmm_lm.count_words(train)), 200, 20)
    sent = spark.sparkContext.broadcast(vocabulary)
    encoded = hmm_lm.cut_lineage(hmm_lm.encode(train, sent).repartition(6))
    model, before = hmm_lm.start_model(vocabulary.unigram, 3), shuffle_files(spark)
    assert hmm_lm.part_counts(encoded, model) is not None
    assert not new_files(spark, before)
    # 630 tokens are one task's work: each word is reported once, whatever the files.
    counts = hmm_lm.word_counts(encoded, model, sent)
    assert "Coalesce 1" in counts._jdf.queryExecution().executedPlan().toString()
    want = Counter(w for _, t in rows for w in tokens(t))
    assert {bytes(r["word"]): r["n"] for r in counts.collect() if r["word"] is not None}.items() <= want.items()
