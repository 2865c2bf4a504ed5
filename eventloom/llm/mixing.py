"""Mixing sources to target weights by Pareto order sampling, with column functions only.

Every document has an expected number of copies: its source's ratio of target to size, moderately
higher for longer documents. The whole part is certain. The rest is its inclusion probability p in a
Pareto sample: documents of a source are ranked by the random odds u / (1 - u) over the inclusion odds
p / (1 - p), and one further copy goes to each document in that order until the words reach the
target, so the size of the sample is fixed and only who is in it is random.

The ranking needs no sort of a whole source. Rank values fall into bins; words per bin and their
running sums show the one bin in which the target is reached, and only its documents are sorted.

Defined results: a null text has size 0; a document of size 0 has no words to take; a null source is
a source of its own, the last one; a source without words has target 0; rows with equal doc_id are
separate documents, and equal rows get equal random numbers. An empty table gives an empty result.
Input columns other than the three used are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage
from .common import WORD

#: Rank bins of a source. Sorting concerns one bin, so about 1/4096 of a source's documents.
BINS = 4096
#: How far a document's length moves its expected copies from its source's ratio. Up to 1.2 / 0.8 the
#: ranked documents of a source always suffice to reach its target.
TILT = (0.8, 1.2)


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) from 52 bits of a digest of seed, id and text."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], budget: float, cap: float) -> DataFrame:
    """One row per source: its size and its share of ``budget`` times all words.

    Shares above ``cap`` times the source are cut and the excess is shared again by weight. That ends
    at ``min(cap * size, level * weight)`` with one level for all: sources are ordered by the level
    at which they are cut, and the level is set by those that are not.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = (sources.withColumn("weight", weight)
              .withColumn("limit", cap * F.col("source_size").cast("double"))
              .withColumn("cut_at", F.col("limit") / F.col("weight")))
    order = W.orderBy("cut_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    level = ((budget * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    leveled = ranked.withColumn("level", level)
    final = F.min(F.when(F.col("level") <= F.col("cut_at"), F.struct("cut_at", "level"))).over(everything)["level"]
    return leveled.withColumn("final", final).select(
        "source", "source_size", "n_docs",
        F.when(F.col("final").isNull(), F.col("limit"))
        .otherwise(F.least("limit", F.col("final") * F.col("weight"))).alias("target"))


def pareto_mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5, cap: int = 2,
               seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, certain, inclusion, copies, taken of each document.

    ``weights`` repeat over the sources in code point order; ``budget`` is the mix in multiples of all
    words; no document is taken more than ``cap`` times.
    """
    narrow = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        uniform(F.col("doc_id"), F.col("text"), seed).alias("u"))
    # Texts are read once; what follows works on a few bytes per document.
    narrow = cut_lineage(narrow, "mix-sizes")
    targets = cut_lineage(source_targets(narrow, weights, budget, cap), "mix-targets")
    # Join keys: nulls get a key of their own.
    with_key = [F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source_key")]
    goal = targets.select(*with_key, "source_size", "n_docs", "target")
    sized = narrow.select("*", *with_key).join(goal, ["no_source", "source_key"])
    tilt = F.least(F.lit(TILT[1]), F.greatest(F.lit(TILT[0]), F.lit(0.5) + 0.5 * F.col("size") * F.col("n_docs")
                                              / F.col("source_size")))
    tilted = sized.withColumn("tilt", F.when(F.col("source_size") > 0, tilt).otherwise(1.0))
    mean = (tilted.groupBy("no_source", "source_key")
            .agg((F.sum(F.round(F.col("tilt") * 1e6).cast("long") * F.col("size"))).alias("tilted_words")))
    # One row per source: written, so that its size is known when joins are planned.
    mean = cut_lineage(mean, "mix-means")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / (F.col("tilted_words") / 1e6)).otherwise(0.0)
    expected = (tilted.join(mean, ["no_source", "source_key"])
                .withColumn("expected", F.least(F.lit(float(cap)), F.col("tilt") * ratio))
                .withColumn("certain", F.floor("expected"))
                .withColumn("inclusion", F.when(F.col("size") > 0, F.col("expected") - F.col("certain")).otherwise(0.0)))
    # u / (1 - u) over p / (1 - p), as the share of the former in both: same order, from 0 to 1.
    u, p = F.col("u"), F.col("inclusion")
    rank = F.when(p > 0, u * (1 - p) / (u * (1 - p) + (1 - u) * p))
    ranked = expected.withColumn("rank", rank).withColumn(
        "bin", F.least(F.lit(BINS - 1), F.floor(F.col("rank") * BINS)).cast("int"))
    key = ["no_source", "source_key"]
    bins = (ranked.groupBy(*key, "bin")
            .agg(F.sum("size").alias("words"), F.sum(F.col("certain") * F.col("size")).alias("certain_words"),
                 F.first("target").alias("target")))
    by_bin = W.partitionBy(*key).orderBy(F.col("bin").asc_nulls_first())
    open_words = F.col("target") - F.sum("certain_words").over(W.partitionBy(*key))
    edges = (bins.withColumn("open", open_words)
             .withColumn("ahead", F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), F.col("words"))).over(
                 by_bin.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
             .where(F.col("bin").isNotNull())
             .select(*key, "bin", "ahead", "open",
                     F.when(F.col("ahead") + F.col("words") <= F.col("open"), "all")
                     .when(F.col("ahead") >= F.col("open"), "none").otherwise("edge").alias("state")))
    edges = cut_lineage(edges, "mix-edges")
    # Documents with whole copies only are in no bin and skip the join.
    whole = (ranked.where("bin is null").withColumn("extra", F.lit(0).cast("long")))
    placed = ranked.where("bin is not null").join(edges, [*key, "bin"])
    in_bin = (W.partitionBy(*key, "bin").orderBy("rank", "doc_id", "size", "u")
              .rowsBetween(W.unboundedPreceding, -1))
    start = F.col("ahead") + F.coalesce(F.sum("size").over(in_bin), F.lit(0))
    # The document in which the target falls is taken if that ends nearer to it.
    edge = (placed.where("state = 'edge'").withColumn("start", start)
            .withColumn("extra", (2 * (F.col("open") - F.col("start")) >= F.col("size")).cast("long")))
    rest = placed.where("state <> 'edge'").withColumn("extra", (F.col("state") == "all").cast("long"))
    rows = whole.unionByName(rest, allowMissingColumns=True).unionByName(edge, allowMissingColumns=True)
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "certain", "inclusion",
        (F.col("certain") + F.col("extra")).alias("copies"),
        ((F.col("certain") + F.col("extra")) * F.col("size")).alias("taken"))
