"""Operators with slices far smaller than the large keys, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.dedupe import dedupe
from eventloom.operators.delivery import dropped_since_last_send, failure_runs, is_success, suppress_after_429
from eventloom.operators.gates import buffer_cap
from eventloom.operators.logs import build_log_batches
from eventloom.operators.ordered import END, PART, fold_running, scan_ranges
from eventloom.operators.slices import numbered, running
from eventloom.operators.throttle import Bucket, apply_pieces, level_pieces, replay, throttle
from eventloom.operators.trail import attach_trail

T0 = dt.datetime(2026, 1, 1)


def skewed(rng, n, others=20):
    """Half of the rows in one key; seq has gaps."""
    seq = 0
    for _ in range(n):
        seq += rng.choice([1, 1, 1, 2, 500])
        yield ("hot" if rng.random() < 0.5 else f"k{rng.randrange(others)}"), seq


@pytest.mark.parametrize("rows_per_slice", [7, 90, 10**6])
def test_running(spark, rows_per_slice):
    rng = random.Random(rows_per_slice)
    rows = [(k, s, rng.randrange(3), rng.random() < 0.05, rng.choice([None] * 9 + [s]))
            for k, s in skewed(rng, 2000)]
    df = spark.createDataFrame(rows, "k string, seq long, amount int, reset boolean, v long")
    out = running(df, ["k"], "seq", {"total": (F.col("amount"), None), "since": (F.col("amount"), F.col("reset"))},
                  {"last": F.col("v")}, rows_per_slice)
    expected, state = {}, {}
    for k, s, amount, reset, v in rows:
        total, since, last = state.get(k, (0, 0, None))
        expected[s] = (total, since, last)
        state[k] = (total + amount, 0 if reset else since + amount, last if v is None else v)
    assert {r["seq"]: (r["total"], r["since"], r["last"]) for r in out.collect()} == expected


@pytest.mark.parametrize("dtype", ["string", "long", "date"])
def test_running_with_null_key(spark, dtype):
    blank = {"string": "", "long": 0, "date": dt.date(1970, 1, 1)}[dtype]
    rows = [(None, i) for i in range(300)] + [(blank, 300 + i) for i in range(50)]
    df = spark.createDataFrame(rows, f"k {dtype}, seq long")
    got = [r["n"] for r in numbered(df, ["k"], "seq", "n", 10).orderBy("seq").collect()]
    assert got == [*range(300), *range(50)]


def test_ranges_cut_one_key(spark):
    """All rows in one key, with an outlier, a gap and a dense stretch: no partition gets much more than the others."""
    seqs = [*range(0, 6000, 3), *range(10**6, 10**6 + 8000), 10**15]
    df = spark.createDataFrame([("hot", s) for s in seqs], "k string, seq long")
    scanned = scan_ranges(df, ["k", "seq"], fold_running(["k"], [], []), [], 100, "t")
    sizes = [r["n"] for r in scanned.where(~F.col(END)).groupBy(PART).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == len(seqs) and len(sizes) > 90 and max(sizes) < 300
    assert scanned.where(END).count() == len(sizes)
    got = numbered(df, ["k"], "seq", "n", 100).orderBy("seq").collect()
    assert [r["n"] for r in got] == list(range(len(seqs)))


@pytest.mark.parametrize("rows_per_slice", [1, 13, 10**6])
def test_running_breaks_ties_by_event(spark, rows_per_slice):
    """Every row in one key and at one seq, values of many types along."""
    df = spark.range(300).select(
        F.lit("k").alias("k"), F.lit(1).cast("long").alias("seq"), F.col("id").alias("event_id"),
        F.create_map(F.lit("a"), F.col("id")).alias("m"), F.timestamp_seconds("id").alias("t"),
        F.when(F.col("id") % 50 == 49, F.timestamp_seconds("id")).alias("v")).repartition(4)
    out = running(df, ["k"], "seq", {"n": (F.lit(1), F.col("event_id") % 100 == 10)}, {"last": F.col("v")}, rows_per_slice)
    got = {r["event_id"]: (r["n"], r["last"] and r["last"].minute * 60 + r["last"].second, r["m"]["a"]) for r in out.collect()}
    for i in range(300):
        resets = [j for j in range(i) if j % 100 == 10]
        lasts = [j for j in range(i) if j % 50 == 49]
        assert got[i] == (i - resets[-1] - 1 if resets else i, lasts[-1] if lasts else None, i)


def test_running_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, seq long")
    for n in (0, 10):
        assert numbered(empty, ["k"], "seq", "n", n).collect() == []


def test_bucket_that_does_not_fit():
    assert Bucket.of("0.333333333333333", 20) == Bucket.of("1/3", 20)
    with pytest.raises(ValueError, match="64-bit"):
        Bucket.of("1/999999", 10**8)


def test_throttle_with_repeated_rows(spark):
    rows = [("s", i // 2, T0) for i in range(40)]
    out = throttle(spark.createDataFrame(rows, "sender_id string, seq long, ts timestamp"), rate="1/11", burst=5)
    assert out.count() == 40


@pytest.mark.parametrize("rows_per_slice", [3, 10**6])
def test_throttle_ties(spark, rows_per_slice):
    """Rows of one seq are decided by event_id; rows that agree in both pay once."""
    rows = [("s", 7, i, T0) for i in range(30)] + [("s", 7, 2, T0)] * 4 + [("s", 7, 20, T0)]
    df = spark.createDataFrame(rows, "sender_id string, seq long, event_id long, ts timestamp").repartition(5)
    out = throttle(df, rate=0, burst=5, rows_per_slice=rows_per_slice).where("drop_reason is null").collect()
    assert sorted(r["event_id"] for r in out) == [0, 1, 2, 2, 2, 2, 2, 3, 4]


def test_throttle_leaves_other_rows_alone(spark):
    rows = [(i, None if i % 5 == 0 else T0, "buffer" if i % 3 == 0 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, ts timestamp, drop_reason string").withColumn("sender_id", F.lit(None).cast("string"))
    got = {r["seq"]: r["drop_reason"] for r in throttle(df, rate=0, burst=4, rows_per_slice=7).collect()}
    live = [i for i in range(60) if i % 5 and i % 3]
    assert got == {i: "buffer" if i % 3 == 0 else "rate_limit" if i in live[4:] else None for i in range(60)}
    assert throttle(df.where("false")).count() == 0


@pytest.mark.parametrize("rate,burst,gap", [(1, 3, 3_000_000), ("1/7", 1, 7_000_000), (0, 2, 10**12), ("1000000", 2, 2)])
def test_throttle_by_stretches(spark, rate, burst, gap):
    """Gaps just below and just at what fills a bucket, in one key and in many."""
    rng = random.Random(gap)
    for keys in (1, 40):
        rows, now = [], 0
        for i in range(1200):
            now += rng.choice([0, 0, gap // 5, gap - 1, gap, -3])
            rows.append((f"k{rng.randrange(keys)}", i, i % 2, T0 + dt.timedelta(microseconds=now)))
        df = spark.createDataFrame(rows, "sender_id string, seq long, event_id long, ts timestamp").repartition(3)
        bucket, state, expected = Bucket.of(rate, burst), {}, {}
        for k, s, _, ts in rows:
            us = (ts - T0) // dt.timedelta(microseconds=1)
            level, last = state.get(k, (bucket.full, None))
            (allowed,), level, last = replay(bucket, level, last, [us])
            state[k], expected[s] = (level, last), None if allowed else "rate_limit"
        for rows_per_slice in (30, 10**6):
            out = throttle(df, rate=rate, burst=burst, rows_per_slice=rows_per_slice)
            assert {r["seq"]: r["drop_reason"] for r in out.collect()} == expected


@pytest.mark.parametrize("rate,burst,step", [("1/50", 3, 40), ("1", 20, 1), ("1/3", 1, 2), ("7/11", 5, 1)])
def test_throttle(spark, rate, burst, step):
    rng = random.Random(burst)
    rows, now = [], 0
    for i in range(1500):
        now += rng.choice([0, 1, step * 900_000, step * 333_333, -5])
        if rng.random() < 0.005:
            now += 10**9
        rows.append((rng.choice(["hot", "hot", "a", None]), i, T0 + dt.timedelta(microseconds=now)))
    df = spark.createDataFrame(rows, "sender_id string, seq long, ts timestamp")
    bucket, state, expected = Bucket.of(rate, burst), {}, {}
    for k, s, ts in rows:
        us = (ts - T0) // dt.timedelta(microseconds=1)
        level, last = state.get(k, (bucket.full, None))
        (allowed,), level, last = replay(bucket, level, last, [us])
        state[k], expected[s] = (level, last), None if allowed else "rate_limit"
    assert "rate_limit" in expected.values()
    for rows_per_slice in (40, 10**6):
        out = throttle(df, rate=rate, burst=burst, rows_per_slice=rows_per_slice)
        assert {r["seq"]: r["drop_reason"] for r in out.collect()} == expected


def test_throttle_literals():
    bucket = Bucket.of(1, 3)
    allowed, level, last = replay(bucket, bucket.full, None, [0] * 4)
    assert allowed == [True, True, True, False]
    assert replay(bucket, level, last, [2_000_000] * 3)[0] == [True, True, False]


def test_level_pieces_match_replay_and_stay_few():
    rng = random.Random(5)
    for _ in range(60):
        bucket = Bucket(rng.randrange(1, 4), rng.randrange(1, 40), 0)
        bucket = Bucket(bucket.gain, bucket.token, bucket.token * rng.randrange(1, 6))
        times, now = [], 0
        for _ in range(rng.randrange(1, 60)):
            now += rng.choice([0, 1, 2, 5, 13, -1, bucket.token])
            times.append(now)
        pieces, last = level_pieces(bucket, times)
        assert len(pieces) <= 10 + 20 * bucket.full // bucket.token
        for level in range(bucket.full + 1):
            _, end, end_time = replay(bucket, level, None, times)
            assert (apply_pieces(pieces, level), last) == (end, end_time)


@pytest.mark.parametrize("n,rows_per_slice", [(3, 15), (10, 40), (4, 10**6)])
def test_attach_trail(spark, n, rows_per_slice):
    rng = random.Random(n)
    kinds = [(k, s, rng.choice(["event", "event", "crumb", "crumb", "crumb", "reset"] if rng.random() < 0.3
                               else ["event", "crumb"])) for k, s in skewed(rng, 1200, 10)]
    kinds = [("quiet", 1_000_000, "crumb")] + kinds + [("quiet", 2_000_000 + i, "event") for i in range(200)]
    pick = lambda kind: spark.createDataFrame(
        [(k, s, {"at": str(s)}) for k, s, x in kinds if x == kind], "scope_id string, seq long, data map<string,string>")
    out = attach_trail(pick("event").drop("data"), pick("crumb"), n, crumb=F.col("data"),
                       resets=pick("reset"), rows_per_slice=rows_per_slice)
    held, expected = {}, {}
    for k, s, kind in kinds:
        if kind == "crumb":
            held[k] = (held.get(k, []) + [str(s)])[-n:]
        elif kind == "reset":
            held[k] = []
        else:
            expected[k, s] = list(held.get(k, []))
    got = {(r["scope_id"], r["seq"]): [x["at"] for x in r["trail"]] for r in out.collect()}
    assert got == expected


def test_delivery_windows_in_slices(spark):
    rng = random.Random(9)
    rows = [(k, s, T0 + dt.timedelta(seconds=s), rng.choice([202, 409, 429, 400, 503, 503, None]), rng.randrange(90))
            for k, s in skewed(rng, 1500)]
    df = spark.createDataFrame(rows, "endpoint string, seq long, ts timestamp, status int, retry_after int")
    good = is_success(F.col("status"))
    small, large = 25, 10**6

    def both(build):
        return [sorted(map(repr, build(n).collect())) for n in (small, large)]

    for build in (
        lambda n: failure_runs(df, 3, rows_per_slice=n),
        lambda n: suppress_after_429(df, rows_per_slice=n),
        lambda n: dropped_since_last_send(df, ~good, good, F.lit(True), "endpoint", rows_per_slice=n),
    ):
        a, b = both(build)
        assert a == b and len(a) == 1500
    # One key followed by hand.
    run, island, expected = 0, 0, []
    for k, s, _, status, _ in rows:
        if k != "hot":
            continue
        if status in (202, 409):
            run = 0
        elif status is None or not 400 <= status <= 499:
            run += 1
        expected.append((s, run, island))
        island += status in (202, 409)
    got = failure_runs(df, 3, rows_per_slice=small).where("endpoint = 'hot'").orderBy("seq").collect()
    assert [(r["seq"], r["failure_run"], r["island"]) for r in got] == expected


def test_batches_of_a_large_flush(spark):
    df = spark.range(1000).select(
        F.lit("f").alias("flush_id"), (F.col("id") * 3).alias("seq"), F.struct(F.col("id").alias("v")).alias("wire"))
    a = build_log_batches(df, 30, rows_per_slice=17).orderBy("batch_no").collect()
    b = build_log_batches(df, 30).orderBy("batch_no").collect()
    assert a == b and len(a) == 34


@pytest.mark.parametrize("keep_dropped", [True, False])
def test_cap_and_dedupe_by_window_and_by_join(spark, keep_dropped):
    """Null groups, equal places, repeated rows and rows dropped before, both ways against brute force."""
    rng = random.Random(6)
    rows = [(rng.choice(["f", "f", "g", None]), rng.randrange(40), rng.randrange(5), rng.choice("ab"),
             rng.choice([None, None, None, "sampled"])) for _ in range(400)]
    rows += rows[:60]
    df = spark.createDataFrame(rows, "flush_id string, seq long, event_id long, fingerprint string, drop_reason string")
    expected = []
    live = [r for r in rows if r[4] is None]
    last = {f: sorted((r[1], r[2]) for r in live if r[0] == f)[:30][-1] for f in ("f", "g", None)}
    kept = [r for r in live if (r[1], r[2]) <= last[r[0]]]
    for r in rows:
        place, same = (r[1], r[2]), [(k[1], k[2]) for k in kept if k[0] == r[0] and k[3] == r[3]]
        reason = r[4] or ("buffer" if place > last[r[0]] else "dedup" if place > min(same) else None)
        if keep_dropped or reason is None:
            expected.append((*r[:4], reason, len(same) if reason is None and len(same) > 1 else None))
    for rows_per_slice in (5, 10**6):
        capped = buffer_cap(df, 30, keep_dropped=keep_dropped, rows_per_slice=rows_per_slice)
        out = dedupe(capped, keep_dropped=keep_dropped, rows_per_slice=rows_per_slice)
        assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, expected))


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line for line in plan.splitlines())


def test_cap_and_dedupe_share_one_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 7).cast("string").alias("flush_id"),
                                  (F.col("id") % 3).alias("fingerprint"))
    assert shuffles(dedupe(buffer_cap(df, 20))) == 1
