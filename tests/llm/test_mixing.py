import random

import pytest

from eventloom.llm.mixing import pareto_mix
from llm_data import UGLY, docs


def mixed(df, **kw):
    return [r.asDict() for r in pareto_mix(df, **kw).collect()]


def levelled(sizes, weights, budget=1.5, cap=2):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, left, open_ = {}, budget * sum(sizes.values()), set(names)
    while open_:
        total = sum(weight[n] for n in open_)
        over = [n for n in open_ if left * weight[n] / total > cap * sizes[n]]
        if not over:
            target.update({n: left * weight[n] / total for n in open_})
            break
        for n in over:
            target[n] = cap * sizes[n]
        left -= sum(target[n] for n in over)
        open_ -= set(over)
    return target


def test_targets_and_words(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice("aaaaabbcde")) for i in range(3000)]
    out = mixed(docs(spark, rows))
    sizes, taken, target, largest = {}, {}, {}, {}
    for r in out:
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest.get(s, 0), r["size"])
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == r["copies"] * r["size"]
        assert r["copies"] >= r["certain"]
        assert r["source_size"] >= r["size"]
    want = levelled(sizes, (3, 1, 2))
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= largest[s]
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_inclusion_follows_probability(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 40), "ab"[i % 2]) for i in range(4000)]
    out = [r for r in mixed(docs(spark, rows), weights=(1, 1), budget=0.8) if 0 < r["inclusion"] < 1]
    for low, high in ((0.5, 0.75), (0.75, 1.0)):
        part = [r for r in out if low <= r["inclusion"] < high]
        if len(part) > 300:
            share = sum(r["copies"] > r["certain"] for r in part) / len(part)
            assert share == pytest.approx(sum(r["inclusion"] for r in part) / len(part), abs=0.08)


def test_reruns_agree_and_seed_matters(spark):
    df = docs(spark, [(i, "w " * (i % 17 + 1), "a") for i in range(500)])
    key = lambda rows: sorted((r["doc_id"], r["taken"]) for r in rows)
    first = key(mixed(df, budget=0.5))
    assert first == key(mixed(df.repartition(7), budget=0.5))
    assert first != key(mixed(df, budget=0.5, seed=18))


def test_defined_cases(spark):
    rows = [(*r, "s") for r in UGLY] + [(20, "no source here", None), (21, None, "empty"), (22, "", "empty")]
    out = mixed(docs(spark, rows, {"target": "clash", "size": 3}))
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["size"] == by[2][0]["size"] == by[3][0]["size"] == 0 and by[1][0]["taken"] == 0
    assert by[21][0]["target"] == 0 and by[21][0]["source_size"] == 0
    assert by[20][0]["source"] is None and by[20][0]["source_size"] == 3
    assert [r["size"] for r in by[5]] == [6, 6]
    assert by[8][0]["size"] == 4
    assert mixed(docs(spark, [])) == []
    assert [r["taken"] for r in mixed(docs(spark, [(1, None)]))] == [0]
