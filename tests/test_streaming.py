"""Streams fed in several micro-batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.throttle import throttle
from eventloom.session import delete_folder, scratch_path
from eventloom.operators.slices import ROWS_PER_SLICE
from eventloom.streaming.jobs import stream_dedupe, stream_first_only
from eventloom.streaming.stateful import (
    RUNS, failure_alerts, flush_log_batches, latest_state, stream_log_batches, stream_throttle)

T0 = dt.datetime(2026, 1, 1)


def feed(spark, df, parts):
    """Write ``df`` as several files in seq order and read them one per micro-batch."""
    path = scratch_path(spark, "feed")
    count = df.count()
    for i in range(parts):
        low, high = count * i // parts, count * (i + 1) // parts
        df.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(stream, mode="append"):
    path = scratch_path(stream.sparkSession, "drain")
    (stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint")
     .trigger(availableNow=True).start(f"{path}/out", format="parquet").awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def rows(spark, n):
    return spark.range(n).select(
        F.col("id").alias("seq"), F.col("id").alias("event_id"),
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("sender_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * F.lit(2))).alias("ts"),
        F.lit("t").alias("type"), F.lit("f").alias("file"), (F.col("id") % 4).cast("int").alias("line"))


def written(spark, start, *args, **options):
    path = scratch_path(spark, "stateful")
    start(*args[:1], path, f"{path}/checkpoint", *args[1:], **options).awaitTermination()
    return path, spark.read.parquet(f"{path}/out").drop("micro_batch")


@pytest.mark.parametrize("rows_per_slice", [9, ROWS_PER_SLICE])
def test_throttle_across_batches(spark, rows_per_slice):
    df = rows(spark, 240)
    _, out = written(spark, stream_throttle, feed(spark, df, 3), rate="1/11", burst=2, columns=["seq"], rows_per_slice=rows_per_slice)
    want = throttle(df, rate="1/11", burst=2).select("seq", F.col("drop_reason").isNull().alias("allowed"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_throttle_of_one_hot_key_with_ties(spark):
    """All rows in one key and few seqs, clocks that jump back and stand still; buckets of quiet keys stay."""
    df = spark.range(400).select(
        F.col("id").alias("event_id"), F.col("id").alias("seq"), F.when(F.col("id") % 100 == 3, "quiet").otherwise("hot").alias("sender_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.floor(F.col("id") / 7) * 3 - F.col("id") % 2)).alias("ts"))
    stream = feed(spark, df, 5).withColumn("seq", F.floor(F.col("seq") / 10))
    path, out = written(spark, stream_throttle, stream, rate="2/5", burst=4, columns=["event_id"], rows_per_slice=30)
    want = throttle(df.withColumn("seq", F.floor(F.col("seq") / 10)), rate="2/5", burst=4)
    want = want.select("event_id", F.col("drop_reason").isNull().alias("allowed"))
    got = sorted(map(tuple, out.collect()))
    assert got == sorted(map(tuple, want.collect())) and {a for _, a in got} == {True, False}
    state = latest_state(spark, path, "key string, level long, last long").collect()
    assert sorted(r["key"] for r in state) == ["hot", "quiet"]


def signals(spark, n, keys, step=1):
    rng = random.Random(n)
    status = [rng.choice([202, 503, 503, 503, None, 404, 500]) for _ in range(n)]
    gaps = [rng.choice([1, 1, 1, 1, 5000]) * step for _ in range(n)]
    at = [sum(gaps[:i + 1]) for i in range(n)]
    return spark.createDataFrame(
        [(rng.choice(keys), i, T0 + dt.timedelta(seconds=at[i]), status[i]) for i in range(n)],
        "endpoint string, seq long, ts timestamp, status int")


def replay_alerts(rows, threshold, keep):
    state, fired = {}, []
    for r in rows:
        good, bad = r["status"] in (202, 409), r["status"] is None or r["status"] not in (202, 409) and not 400 <= r["status"] <= 499
        if not (good or bad):
            continue
        key, second = r["endpoint"] or "", int(r["ts"].timestamp())
        n, last = state.get(key, (0, None))
        if good or last is not None and second - last > keep:
            n = 0
        n += bad
        state[key] = n, second
        if bad and n == threshold:
            fired.append((key, r["seq"], n))
    return sorted(fired)


@pytest.mark.parametrize("keys", [["one"], ["a", "b", None]])
def test_alerts_against_replay(spark, keys):
    df = signals(spark, 300, keys)
    want = replay_alerts(df.orderBy("seq").collect(), 3, 3600)
    for parts in (1, 4):
        _, out = written(spark, failure_alerts, feed(spark, df, parts), 3, rows_per_slice=25)
        assert sorted(map(tuple, out.select("endpoint", "seq", "failures").collect())) == want and len(want) > 5


def test_alerts_across_batches(spark):
    bad = [0, 1, 2, 3, 5, 6, 7, 8, 10, 11, 12]
    statuses = {**{i: 503 for i in bad}, 4: 202, 9: 404}
    at = lambda i: T0 + dt.timedelta(seconds=i if i < 12 else 4000)
    df = spark.createDataFrame([("e", i, at(i), s) for i, s in sorted(statuses.items())],
                               "endpoint string, seq long, ts timestamp, status int")
    path, out = written(spark, failure_alerts, feed(spark, df, 4), 3)
    assert sorted(map(tuple, out.collect())) == [("e", 2, 3), ("e", 7, 3)]
    assert [tuple(r)[:2] for r in latest_state(spark, path, RUNS).collect()] == [("e", 1)]
    fresh = written(spark, failure_alerts, feed(spark, df.where("seq >= 10").withColumn("seq", F.col("seq") - 10), 3), 3)[1]
    assert fresh.count() == 0


def test_a_micro_batch_run_again_replaces_itself(spark):
    """What a failure after the write leaves behind: output and state of a batch that is then run again."""
    df = rows(spark, 120)
    path = scratch_path(spark, "again")
    source = feed(spark, df, 3)
    stream_throttle(source, path, f"{path}/checkpoint", rate="1/11", burst=2, columns=["seq"]).awaitTermination()
    first = sorted(map(tuple, spark.read.parquet(f"{path}/out").collect()))
    delete_folder(spark, f"{path}/checkpoint/commits/2")
    stream_throttle(source, path, f"{path}/checkpoint", rate="1/11", burst=2, columns=["seq"]).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{path}/out").collect())) == first


def test_dedupe_windows_close(spark):
    df = rows(spark, 400).withColumn("sender_id", F.lit("s"))
    closed = drain(stream_dedupe(feed(spark, df, 4), "1 minute", "10 seconds"))
    got = {(r["window_start"], r["fingerprint"]): (r["events"], r["first_event_id"]) for r in closed.collect()}
    full = {k: v for k, v in got.items() if v[0]}
    assert full and all(v[0] in (7, 8) for v in full.values())
    first = drain(stream_first_only(feed(spark, df, 4), "1 hour"))
    assert first.count() == 4


def log_rows(spark, n, senders):
    return spark.range(n).select(
        F.col("id").alias("seq"), F.when(F.col("id") % senders > 0, (F.col("id") % senders).cast("string")).alias("sender_id"),
        F.lit("info").alias("level"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("message"),
        F.lit(T0).alias("timestamp"), F.lit(None).cast("map<string,string>").alias("context"))


def messages(df):
    entries = F.from_json("body", "logs array<struct<message:string>>")["logs"]["message"]
    return [(r["flush_id"], r["records"], [int(m[1:]) for m in r["m"]]) for r in df.withColumn("m", entries).collect()]


@pytest.mark.parametrize("senders,parts", [(1, 3), (3, 4), (7, 2)])
def test_log_batches_fill_across_micro_batches(spark, senders, parts):
    """Full batches in order, whatever the micro-batches; the rest is flushed."""
    df = log_rows(spark, 300, senders)
    path, out = written(spark, stream_log_batches, feed(spark, df, parts), 20, rows_per_slice=33)
    sent, rest = messages(out), messages(flush_log_batches(spark, path, df.schema, 20))
    assert all(n == 20 == len(m) for _, n, m in sent)
    assert all(len(m) < 20 for _, _, m in rest)
    for key in range(senders):
        own = "sender/" + (f"={key}" if key else "")
        held = sorted((m for f, _, m in [*sent, *rest] if f == own), key=lambda m: m[0])
        assert sum(held, []) == [i for i in range(300) if i % senders == key]


def test_log_batches_with_defaults(spark):
    df = log_rows(spark, 2300, 2)
    path, out = written(spark, stream_log_batches, feed(spark, df, 3))
    assert sorted((f, n) for f, n, _ in messages(out)) == [("sender/", 1000), ("sender/=1", 1000)]
    assert sorted((f, n) for f, n, _ in messages(flush_log_batches(spark, path, df.schema))) == [("sender/", 150), ("sender/=1", 150)]
    assert flush_log_batches(spark, scratch_path(spark, "none"), df.schema).count() == 0
