import hashlib
import random
from collections import Counter

import pytest

from eventloom.llm.common import WordHash
from eventloom.llm.superkmer import RUN_WINDOWS, _words, count_windows, remove_repeats, runs
from llm_data import UGLY, docs, words


def brute(texts, width):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def check(spark, rows, width, **kw):
    df = docs(spark, rows, {"n_removed": "clash", "kept_text": 1})
    got = sorted([((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text)) for r in remove_repeats(df, width, **kw).collect()], key=repr)
    want = sorted([(i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], width))], key=repr)
    assert got == want
    return got


def corpus():
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randrange(60), 12))) for i in range(120)]
    shared = " ".join(words(rng, 25, 500))
    rows += [(200 + i, " ".join([*words(rng, 9, 500), shared, *words(rng, 5, 500)])) for i in range(20)]
    rows += [(300, "x y " * 400), (301, "lone " * 5), (302, rows[3][1]), (303, rows[3][1].upper())]
    return rows


@pytest.mark.parametrize("options", [
    {}, {"run_windows": 3}, {"bucket_windows": 4}, {"bucket_windows": 40, "filter_bits": 15}, {"filter_bits": 15}, {"gram": 5}, {"gram": 1}])
def test_against_brute_force(spark, options):
    got = check(spark, corpus(), 5, **{"gram": 2, **options})
    assert any(r[2] for r in got) and any(not r[2] for r in got if r[1] > 5)


def test_production_width(spark):
    rng = random.Random(6)
    passage = words(rng, 50, 9000)
    rows = [(i, " ".join([*words(rng, 80, 9000), *passage[i % 3:], *words(rng, 30, 9000)])) for i in range(12)]
    rows += [(50, " ".join(passage[:34])), (51, " ".join(passage[:35]))]
    got = check(spark, rows, 35)
    assert [r[2] for r in got if r[0] == 50] == [0] and [r[2] for r in got if r[0] == 51] == [35]


def test_defined_cases(spark):
    check(spark, UGLY, 5, gram=2)
    assert remove_repeats(docs(spark, [])).collect() == []


def test_runs_cover_each_window_once():
    import numpy as np

    rng = np.random.default_rng(1)
    h = rng.integers(0, 50, 400).astype(np.uint64)
    doc = np.repeat([0, 1, 2, 3], [100, 3, 200, 97])
    for longest in (4, 1000):
        first, length, _ = runs(h, doc, 9, 3, longest)
        covered = sorted(i for a, n in zip(first, length) for i in range(a, a + n))
        assert covered == [i for i in range(392) if doc[i] == doc[i + 8]] and length.max() <= longest


def test_count_windows():
    assert count_windows([(b"a b c", 1), (b"b c d", 1)], 2) == [[(1, 3)], [(0, 2)]]
    assert count_windows([(b"a b", 3), (b"a b c", 1)], 2) == [[(0, 2)], [(0, 2)]]
    assert count_windows([(b"a a a", 1)], 2) == [[(0, 3)]]


@pytest.mark.parametrize("period", [1, 2, 5, 9])
def test_repetitive_text_moves_little(period):
    """Runs of one minimiser value hold each word little more than once, whatever the period."""
    text = " ".join(f"w{i % period}" for i in range(20_000))
    _, _, h, doc = _words([text], WordHash())
    first, length, _ = runs(h, doc, 35, 8, RUN_WINDOWS)
    moved = sum(n + 34 for n in length.tolist())
    assert length.sum() == 20_000 - 34 and moved < 4 * 20_000


def test_repetitive_texts_against_brute_force(spark):
    rows = [(i, " ".join(f"w{j % p}" for j in range(n))) for i, (p, n) in enumerate([(1, 300), (2, 211), (3, 90), (5, 1200), (2, 30), (7, 64)])]
    for options in ({}, {"bucket_windows": 20, "run_windows": 16}):
        check(spark, rows, 9, gram=3, **options)


def test_windows_of_a_bucket_stay_in_their_strings():
    import tracemalloc

    rng = random.Random(8)
    own = [f"{rng.getrandbits(80):020x}".encode() for _ in range(6000)]
    strings = [(b" ".join(own), 1), (b" ".join(own[2000:2500]), 1), (b" ".join(own[:3] * 20), 3), (b"a b", 2)]
    tracemalloc.start()
    found = count_windows(strings, 35)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [[(2000, 2500)], [(0, 500)], [(0, 60)], []]
    assert peak < 6000 * 200  # a window alone has 730 bytes


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    from eventloom.llm import superkmer

    monkeypatch.setattr(superkmer.xxhash, "xxh3_64_intdigest", lambda w: 5)
    strings = [(b"a b c d e f", 1), (b"x b c d y", 1), (b"q r s", 1), (b"u v w", 2)]
    assert count_windows(strings, 3) == [[(1, 4)], [(1, 4)], [], [(0, 3)]]
    assert count_windows([], 3) == [] and count_windows([(b"a", 1)], 3) == [[]]
