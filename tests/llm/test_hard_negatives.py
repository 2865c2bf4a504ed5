import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm.hard_negatives import Block, hard_negatives, scan

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=5, positives=5, negatives=3, lower=50, upper=95):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v], k) for i, v, k in rows
          if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v, k) in enumerate(ok):
        if i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, kind) for m, (j, w, kind) in enumerate(ok) if m != n]
        best = sorted(((-s, j) for s, j, kind in scored if kind == k))[:positives]
        for minus, p in best:
            score = -minus
            inside = sorted((-s, j) for s, j, kind in scored if kind != k and lower * score <= 100 * s <= upper * score)
            out += [(i, p, r + 1, j, score, -s) for r, (s, j) in enumerate(inside[:negatives])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, dims, seed, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    out = []
    for i in range(n):
        centre = rng.choice(centres)
        out.append((i, [c + rng.gauss(0, 0.6) for c in centre], rng.randrange(labels)))
    return out


@pytest.mark.parametrize("options", [{}, {"block_rows": 7}, {"block_rows": 40, "anchors_per_pass": 9}])
@pytest.mark.parametrize("dims", [3, 24])
def test_against_brute_force(spark, options, dims):
    rows = vectors(300, dims, dims)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"place": F.lit("clash"), "score": F.lit(1), "id": F.lit("x")}).repartition(3)
    got = result(hard_negatives(df, F.col("id") % 5 == 0, **options))
    assert got == brute(rows) and len(got) > 100


def test_ties_and_repeated_rows(spark):
    rng = random.Random(8)
    rows = [(i, [float(rng.randrange(3)), float(rng.randrange(2))], rng.randrange(2)) for i in range(150)]
    rows += [(j, [1.0, 1.0], 0) for j in (10, 10, 10, 3, 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(hard_negatives(df, F.col("id") % 5 == 0, block_rows=16)) == brute(rows)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 4, 5, labels=2)
    rows += [(100, None, 1), (105, [1.0, None, 0.0, 0.0], 1), (110, [nan, 0.0, 0.0, 0.0], 0), (115, [inf, 0.0, 0.0, 0.0], 0),
             (120, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], 0), (125, [0.0] * 4, 0), (130, [-1.0] * 4, 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(hard_negatives(df, F.col("id") % 5 == 0)) == brute(rows)
    # Short vectors are filled up; one too large for exact scores is left out.
    short = [(0, [1.0], 0), (1, [1.0, 5.0], 0), (2, [0.6, 9.0], 1), (3, [], 1)]
    want = result(hard_negatives(spark.createDataFrame(short, SCHEMA), F.col("id") == 0))
    assert want == [(0, 1, 1, 2, 65536, 256 * 153)]
    huge = [*short, (4, [3e38, 0.0], 0)]
    assert result(hard_negatives(spark.createDataFrame(huge, SCHEMA), F.col("id") == 0)) == want


def test_empty(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA), F.col("id") % 5 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0], 1)], SCHEMA)
    assert hard_negatives(one, F.col("id") % 5 == 0).collect() == []


def test_scan_reads_few_columns_and_stays_exact():
    rng = np.random.default_rng(2)
    matrix = rng.integers(-90, 90, (400, 32)).astype(np.int32)
    read = []

    class Column(np.ndarray):
        def __getitem__(self, item):
            read.append(item)
            return np.asarray(self)[item]

    block = Block.of(0, 0, np.arange(400).tobytes(), np.zeros(400, np.int64).tobytes(), np.zeros(400, bool).tobytes(),
                     [np.ascontiguousarray(matrix[:, d]).tobytes() for d in range(32)])
    block.columns = [c.view(Column) for c in block.columns]
    query = np.zeros(32, np.int64)
    query[[3, 5, 7]] = [400, -300, 2]
    scores = matrix.astype(np.int64) @ query
    cut = int(np.sort(scores)[-5])
    places, exact = scan(block, query, 0, 400, None, lambda low, high: high >= cut)
    assert sorted(places.tolist()) == np.flatnonzero(scores >= cut).tolist() and exact.tolist() == scores[places].tolist()
    assert len(read) == 3
    read.clear()
    assert not len(scan(block, query, 0, 400, None, lambda low, high: high >= 10**9)[0]) and not read
    big = query * 10**6
    places, exact = scan(block, big, 0, 400, None, lambda low, high: high >= cut * 10**6)
    assert exact.tolist() == (scores[places] * 10**6).tolist()
