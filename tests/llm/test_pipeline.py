import pytest

import corpus_pipeline
from llm_data import UGLY, docs

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of each stage."""
    from eventloom.session import cut_lineage

    frames = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(cut_lineage(stage(spark, frames[-1], DATA)))
    return [f.toPandas() for f in frames]


def test_columns_and_names(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "benchmark", "mix"]
    for frame in steps[:-1]:
        assert list(frame.columns) == COLUMNS
    assert set(steps[-1].columns) >= {"doc_id", "size", "source_size", "target", "taken"}


def test_near_duplicates(steps):
    from test_ngram_join import brute

    before, after = steps[1], steps[2]
    groups = brute(list(zip(before.doc_id, before.text)))
    assert sorted(after.doc_id) == sorted({g[2] for g in groups})


def test_substrings(steps):
    from test_superkmer import brute

    before, after = steps[2], steps[3].set_index("doc_id")
    for doc, text, (_, gone, _, kept) in zip(before.doc_id, before.text, brute(list(before.text), 35)):
        assert after.text[doc] == (kept if gone else text)
        assert after.n_chars[doc] == len(after.text[doc])


def test_benchmark(steps, spark):
    from test_decontaminate import brute

    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    verdicts = brute(list(zip(steps[3].doc_id, steps[3].text)), items, 13)
    assert sorted(steps[4].doc_id) == sorted(v[0] for v in verdicts if not v[5])


def test_mix(steps):
    mixed = steps[5]
    assert sorted(mixed.doc_id) == sorted(steps[4].doc_id)
    for _, group in mixed.groupby("source"):
        assert abs(group.taken.sum() - group.target.iloc[0]) <= group["size"].max()


def test_quality_keeps_good_documents(steps, spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").toPandas()
    good = set(labels[labels.quality == 1].doc_id) & set(steps[0].doc_id)
    assert len(good & set(steps[1].doc_id)) / len(good) > 0.95


def test_odd_documents_and_clashing_columns(spark):
    from eventloom.session import cut_lineage

    extra = {"score": "mine", "n_words": 7, "predicted": "x", "kept_text": "k", "contaminated": "c", "features": "f"}
    frame = docs(spark, UGLY, extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = frame
        frame = cut_lineage(stage(spark, frame, DATA))
        assert frame.columns == before.columns and frame.dtypes == before.dtypes, name
        assert {tuple(r[c] for c in extra) for r in frame.collect()} <= {tuple(extra.values())}
    assert corpus_pipeline.STAGES[-1][1](spark, frame, DATA).count() == frame.count()


def test_empty_table(spark):
    from eventloom.session import cut_lineage

    frame = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        frame = cut_lineage(stage(spark, frame, DATA))
        assert frame.count() == 0
