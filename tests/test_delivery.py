"""The sink with counters, the kept issue table, deep scopes and secrets of projects."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import scopes as scopes_module
from eventloom.operators.dedupe import IssueTable, issue_rollup
from eventloom.operators.reports import COUNTERS, drop_report, observed
from eventloom.operators.scopes import layer_scopes
from eventloom.operators.scrub import with_project_literals
from eventloom.functions.redact import scrub_text
from eventloom.session import scratch_path
from eventloom.sources.delivery import body_sink, receipts, sink_stats
from eventloom.sources.sinks import null_sink, with_batch_key


def bodies(spark, n):
    return with_batch_key(spark.range(n).select(F.col("id").alias("event_id"), F.concat(F.lit("body "), F.col("id")).alias("body")))


def write(spark, df, name, send, path, **options):
    spark.dataSource.register(body_sink(name, send))
    writer = df.write.format(name).mode("append")
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(path)


def test_sink_counts_and_receipts(spark):
    path = scratch_path(spark, "sink")
    write(spark, bodies(spark, 100).repartition(4), "sink_a",
          lambda rows: [(202, 409, 500, None)[r["event_id"] % 4] for r in rows], path, job="one", chunk=7)
    assert [tuple(r) for r in sink_stats(spark, path).collect()] == [("one", 50, 50)]
    got = receipts(spark, path).collect()
    assert len(got) == 100 and len({r["batch_key"] for r in got}) == 100 and sum(r["sent"] for r in got) == 50
    # The same job again, now with a receiver that knows all bodies: counts are replaced, not added.
    write(spark, bodies(spark, 100), "sink_b", lambda rows: [409] * len(rows), path, job="one")
    write(spark, bodies(spark, 10), "sink_b", lambda rows: [None] * len(rows), path, job="two")
    assert sorted(map(tuple, sink_stats(spark, path).collect())) == [("one", 100, 0), ("two", 0, 10)]
    assert receipts(spark, path).where("job = 'one'").count() == 100


def test_sink_that_fails_leaves_no_counts(spark):
    path = scratch_path(spark, "sink")
    write(spark, bodies(spark, 5), "sink_c", lambda rows: [202] * len(rows), path, job="good")

    def broken(rows):
        raise OSError("no route")

    for send in (broken, lambda rows: [202]):
        with pytest.raises(Exception):
            write(spark, bodies(spark, 50), "sink_d", send, path, job="bad")
    assert [tuple(r) for r in sink_stats(spark, path).collect()] == [("good", 5, 0)]
    assert receipts(spark, path).count() == 5
    with pytest.raises(Exception, match="batch_key"):
        write(spark, bodies(spark, 1).drop("batch_key"), "sink_e", broken, path)


def test_sink_counts_a_task_once_that_ran_twice(spark):
    """The first attempts of some tasks die after they have sent everything."""
    path, marks = scratch_path(spark, "sink"), scratch_path(spark, "marks")

    def send(rows):
        import os

        os.makedirs(marks, exist_ok=True)
        answers = []
        for row in rows:
            known = os.path.exists(f"{marks}/{row['batch_key']}")
            open(f"{marks}/{row['batch_key']}", "w").close()
            answers.append(409 if known else 202)
        return answers

    df = bodies(spark, 60)
    write(spark, df.where("event_id % 2 = 0"), "sink_f", send, path, job="lost")  # sent, then forgotten
    write(spark, df, "sink_f", send, path, job="lost")
    assert [tuple(r) for r in sink_stats(spark, path).collect()] == [("lost", 60, 0)]
    by_status = {r["status"]: r["count"] for r in receipts(spark, path).groupBy("status").count().collect()}
    assert by_status == {202: 30, 409: 30}


def test_observed_counters(spark):
    df = spark.range(100).select(F.when(F.col("id") % 3 == 0, "buffer").when(F.col("id") % 3 == 1, "dedup").alias("drop_reason"))
    rows, observation = observed(df)
    null_sink(rows)
    assert observation.get == {c: drop_report(df).first()[c] for c in COUNTERS}


def test_issue_table_reads_only_the_new_day(spark):
    rng = random.Random(3)
    rows = [(i, i // 7, rng.choice("pq"), rng.choice("AB"), "f", rng.randrange(3), rng.randrange(5)) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, seq long, project_id string, type string, file string, line int, day int")
    df = df.withColumn("timestamp", F.timestamp_seconds("event_id"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    table = IssueTable(spark, scratch_path(spark, "issues"))
    whole = lambda days: sorted(map(tuple, issue_rollup(df.where(F.col("day").isin(days))).collect()))
    for n, day in enumerate((3, 0, 1, 4, 2)):
        part = df.where(F.col("day") == day)
        before = read.value
        table.add(str(day), part.mapInArrow(counted, part.schema))
        assert read.value - before == part.count()
        assert sorted(map(tuple, table.issues().collect())) == whole([3, 0, 1, 4, 2][:n + 1])
    # A day that comes again replaces its rows.
    table.add("0", df.where("day = 0 and event_id > 50"))
    want = issue_rollup(df.where("day <> 0 or event_id > 50"))
    assert sorted(map(tuple, table.issues().collect())) == sorted(map(tuple, want.collect()))
    assert len(table.versions()) == 2


SCOPE = "scope_id string, parent_scope_id string, tags map<string,string>, user map<string,string>, extra map<string,string>, reset boolean"


def test_a_chain_of_a_thousand_scopes(spark, monkeypatch):
    """Eleven rounds at most, with a reset in the middle and a parent that has no row."""
    rows = [(f"s{i}", f"s{i - 1}", {"depth": str(i), f"k{i // 100}": str(i)}, {"u": str(i)} if i % 300 == 0 else {}, {"e": "0"} if i == 0 else {}, i == 450)
            for i in range(1000)]
    random.Random(1).shuffle(rows)
    writes = []
    cut = scopes_module.cut_lineage
    monkeypatch.setattr(scopes_module, "cut_lineage", lambda df, label: writes.append(label) or cut(df, label))
    out = {r["scope_id"]: r for r in layer_scopes(spark.createDataFrame(rows, SCOPE)).collect()}
    assert len(writes) - 1 <= 11 and len(out) == 1000
    last, early = out["s999"], out["s449"]
    assert last["tags"] == {"depth": "999", **{f"k{j}": str(min(j * 100 + 99, 999)) for j in range(4, 10)}}
    assert last["user"] == {"u": "900"} and last["extra"] == {}
    assert early["tags"] == {"depth": "449", **{f"k{j}": str(min(j * 100 + 99, 449)) for j in range(5)}} and early["extra"] == {"e": "0"}
    with pytest.raises(ValueError, match="ancestors"):
        layer_scopes(spark.createDataFrame(rows, SCOPE), max_depth=548)
    assert layer_scopes(spark.createDataFrame(rows, SCOPE), max_depth=549).count() == 1000


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_rings_of_scopes(spark, size):
    rows = [(f"r{i}", f"r{(i + 1) % size}", {}, {}, {}, False) for i in range(size)] + [("a", "r0", {}, {}, {}, False), ("b", None, {}, {}, {}, False)]
    with pytest.raises(ValueError, match="own ancestor"):
        layer_scopes(spark.createDataFrame(rows, SCOPE))


def test_ten_thousand_secrets(spark):
    rng = random.Random(2)
    secrets = {p: [f"s{p}x{j}q" for j in range(5)] + [f"s{p}x{rng.randrange(5)}q-long"] for p in range(2000)}
    rows = [(i, rng.randrange(2100) if i % 9 else None, " ".join(
        rng.choice(secrets[rng.randrange(3)] + ["word"]) for _ in range(6))) for i in range(500)]
    rows = [(i, p, text + (" " + " ".join(rng.sample(secrets[p], 3)) if p in secrets else "")) for i, p, text in rows]
    table = spark.createDataFrame([(p, s) for p, own in secrets.items() for s in own] + [(5, None), (6, "")], "project_id int, secret string")
    df = spark.createDataFrame(rows, "id int, project_id int, text string")
    out = with_project_literals(df, table).select("id", scrub_text(F.col("text"), F.col("literals")).alias("text"))

    def brute(p, text):
        for s in sorted(set(secrets.get(p, [])), key=lambda s: (-len(s), s)):
            text = text.replace(s, "[REDACTED]")
        return text

    assert {r["id"]: r["text"] for r in out.collect()} == {i: brute(p, text) for i, p, text in rows}
    assert sum("REDACTED" in r["text"] for r in out.collect()) > 300
