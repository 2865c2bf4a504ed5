"""A corpus pipeline of five operators: filter, deduplicate, decontaminate and mix documents.

Each stage takes what the one before kept, as written Parquet, and its decisions take effect. All but
the last return the columns of ``documents``; a column of the input that has the name of an operator's
own result is carried through untouched. Nulls, empty texts, repeated rows and empty tables are treated
as the operators in ``eventloom/llm`` define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.decontaminate import decontaminate
from eventloom.llm.mixing import pareto_mix
from eventloom.llm.ngram_join import keep_one
from eventloom.llm.quality_pu import pu_quality
from eventloom.llm.superkmer import remove_repeats
from eventloom.session import configure, cut_lineage


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row as one struct, out of reach of result columns."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pu_quality(_packed(docs), labels).where("predicted = 1").select("__doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, over any number of links, the one with the smallest doc_id stays.

    The rule of a link is op3's, 3-word shingles and 90 percent: the stage drops just the documents that
    op3 names as copies. ``keep_one(docs, percent=80, width=5)`` is the looser rule of five words.
    """
    return keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeated windows go; ``n_chars`` follows. A document that loses all words stays, empty."""
    kept = remove_repeats(docs.select("doc_id", "text", F.struct(
        *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__doc")))
    # A text that loses nothing stays as it is.
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    out = kept.withColumn("__new", text)
    values = {"text": F.col("__new"), "n_chars": F.when(F.col("n_removed") > 0, F.length("__new").cast("long"))
              .otherwise(F.col("__doc.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(values[c] if values.get(c) is not None else F.col(f"__doc.`{c}`")).alias(c) for c in docs.columns])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(_packed(docs), items, keep_text=False).where("not contaminated").select("__doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken, and how many words that gives."""
    return pareto_mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("benchmark", benchmark),
    ("mix", mix),
]
#: Training a classifier is beyond SQL; stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
