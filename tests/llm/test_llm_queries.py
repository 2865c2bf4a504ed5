import pytest

import __spark_entry__ as entry
from eventloom.llm.queries import ORACLES, QUERIES
from oracle import connect, difference

COLUMNS = {
    "op1": "page_id payload_bytes payload_digest record_type refers_to",
    "op2": "doc_id held_out score predicted",
    "op3": "doc_id n_shingles component_id",
    "op4": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5": "doc_id n_words n_removed kept_sha256",
    "op6": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7": "doc_id size source_size target taken",
    "op8": "doc_id licenses",
    "op9": "doc_id held_out score predicted",
    "op10": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op11": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13": "lang rank phrase a l r n score",
    "op12": "doc_id keep_id group_size kept text_sha256",
}


def test_names():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)
    assert set(entry.queries()) >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(frame.columns)
    if name in ORACLES:
        assert difference(frame, connect(sf_dir), ORACLES[name]) is None
    else:
        assert frame.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
