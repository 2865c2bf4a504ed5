import zlib

import numpy as np
import pytest

from eventloom.llm.quality_pu import pu_quality
from llm_data import UGLY, docs

DATA = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def auc(score, label):
    rank = np.argsort(np.argsort(score))
    n = label.sum()
    return (rank[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


@pytest.fixture(scope="module")
def scored(spark):
    frame = pu_quality(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))
    return frame.toPandas()


def test_held_out_accuracy(spark, scored):
    both = scored.merge(spark.read.parquet(f"{DATA}/labels.parquet").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert auc(held.score.values, held.quality.values) > 0.9
    good = held[held.quality == 1]
    assert (good.predicted == 1).mean() > 0.97
    assert ((held.quality == 1) == (held.predicted == 1)).mean() > 0.93


def test_shape(scored):
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.3) == (scored.predicted == 1)).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(scored.doc_id, scored.held_out))


def test_held_out_labels_are_not_read(spark, scored):
    from pyspark.sql import functions as F

    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    turned = spark.read.parquet(f"{DATA}/labels.parquet").withColumn(
        "quality", F.when(fold == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = pu_quality(spark.read.parquet(f"{DATA}/documents.parquet"), turned).toPandas()
    both = scored.merge(again, on="doc_id")
    assert np.allclose(both.score_x, both.score_y, atol=1e-6)


def test_defined_cases(spark):
    df = docs(spark, UGLY, {"score": "clash", "features": 1})
    out = pu_quality(df, labels(spark, [(i, 1, 0) for i in range(1, 9)] + [(4, 0, 0), (4, None, None)])).collect()
    assert len(out) == len(UGLY) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 5}) == 1
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    alone = pu_quality(df, labels(spark, [])).collect()
    assert {r.score for r in alone} == {0.5} and {r.predicted for r in alone} == {1}
    assert pu_quality(docs(spark, []), labels(spark, [])).collect() == []
