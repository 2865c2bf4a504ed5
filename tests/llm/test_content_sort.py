import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.llm.content_sort import drop_copies, exact_groups
from llm_data import UGLY, docs


def brute(rows, largest=True):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max(known) if largest else min(known)) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: i != keep):
            out.append((i, keep, len(ids), first, sha))
            first = False
    return sorted(out, key=repr)


def result(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()], key=repr)


def corpus():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(5))) for _ in range(300)]
    head = "a beginning that many texts share, longer than the prefix "
    texts += [head + str(rng.randrange(40)) for _ in range(200)] + ["hot"] * 400
    return [(i, t) for i, t in enumerate(rng.sample(texts, len(texts)))]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("parts", [1, 7, 64])
def test_against_brute_force(spark, keep, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        rows = corpus()
        df = docs(spark, rows, {"keep_id": "clash", "n": 1, "key": 2, "row": 3, "part": 4}).repartition(5)
        got = result(exact_groups(df, keep=keep))
        assert got == brute(rows, keep == "largest")
        assert sum(r[3] for r in got) == len({t for _, t in rows})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def test_hot_text_meets_in_several_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, "same") for i in range(5000)] + [(9000 + i, str(i)) for i in range(50)]
        df = docs(spark, rows).repartition(6)
        assert result(exact_groups(df)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_keys_of_different_texts(spark):
    """Without a prefix and with all texts of one hash key only the comparison tells texts apart."""
    rows = [(i, t) for i, t in enumerate(["x", "y", "x", "z", "y", "x"] * 30)]
    original = F.xxhash64
    F.xxhash64 = lambda *_: F.lit(1).cast("long")
    try:
        assert result(exact_groups(docs(spark, rows).repartition(3), prefix=0)) == brute(rows)
    finally:
        F.xxhash64 = original


def test_defined_cases(spark):
    rows = [*UGLY, (None, None), (None, "only without ids"), (None, "only without ids"), (70, "long " * 200_000), (71, "long " * 200_000)]
    assert result(exact_groups(docs(spark, rows))) == brute(rows)
    assert exact_groups(docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        exact_groups(docs(spark, rows), keep="any")


def test_normalised_and_other_id_types(spark):
    df = spark.createDataFrame([("p", "A  b"), ("q", "a b"), ("r", "c")], "name string, body string")
    out = exact_groups(df, "name", "body", normalise=lambda c: F.regexp_replace(F.lower(c), " +", " "))
    assert {(r.name, r.keep_id, r.kept) for r in out.collect()} == {("p", "q", False), ("q", "q", True), ("r", "r", True)}


def test_drop_copies_keeps_rows_whole(spark, tmp_path):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, "b")]
    df = docs(spark, rows, {"kept": "own", "text_sha256": None})
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = drop_copies(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text, r.kept) for r in out.collect()) == [(2, "a", "own"), (4, "", "own"), (5, "b", "own")]
