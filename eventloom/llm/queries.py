"""The registered queries of this folder, each over its whole table, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op7_pareto_mix", rf"""
WITH n AS (
  SELECT doc_id, source, CAST(len({WORDS_SQL}) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5(concat_ws('|', '17', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13))
               AS BIGINT)::DOUBLE + 0.5) / 4503599627370496::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place
  FROM n GROUP BY source
), w AS (
  SELECT *, CASE place WHEN 0 THEN 3::DOUBLE WHEN 1 THEN 1::DOUBLE ELSE 2::DOUBLE END AS weight,
         2::DOUBLE * source_size AS lim FROM s
), l AS (
  SELECT *, lim / weight AS cut_at,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), f AS (SELECT arg_min(level, cut_at) AS level FROM l WHERE level <= cut_at),
t AS (
  SELECT source, source_size, n_docs, least(lim, coalesce((SELECT level FROM f) * weight, lim)) AS target FROM l
), d AS (
  SELECT n.*, t.source_size, t.target, CASE WHEN t.source_size > 0
    THEN least(1.2::DOUBLE, greatest(0.8::DOUBLE, 0.5::DOUBLE + 0.5::DOUBLE * size * n_docs / t.source_size))
    ELSE 1::DOUBLE END AS tilt
  FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(2::DOUBLE, tilt * (target /
    (sum(CAST(round(tilt * 1000000) AS BIGINT) * size) OVER (PARTITION BY source) / 1000000::DOUBLE)))
    ELSE 0::DOUBLE END AS expected FROM d
), p AS (
  SELECT *, CAST(floor(expected) AS BIGINT) AS certain,
         CASE WHEN size > 0 THEN expected - floor(expected) ELSE 0 END AS p FROM e
), r AS (
  SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / (u * (1 - p) + (1 - u) * p) END AS rank,
         target - sum(certain * size) OVER (PARTITION BY source) AS open_words FROM p
), c AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, p > 0 ORDER BY rank, doc_id, size, u
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM r
)
SELECT doc_id, size, source_size, target,
       CAST((certain + CASE WHEN p > 0 AND 2 * (open_words - start) >= size THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM c
""")
def op7(table) -> DataFrame:
    """The mix of all documents: words taken of each."""
    from .mixing import pareto_mix

    return pareto_mix(table("documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op6_weak_supervision")
def op6(table) -> DataFrame:
    """Counts and verdict of each document."""
    from .weak_rules import weak_quality

    return weak_quality(table("documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


DECONTAMINATE_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL
), bw AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT item, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)
), occ AS (SELECT r, item, i, m FROM dw JOIN bw USING (m, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM occ) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""


@query("op10_wu_manber", DECONTAMINATE_SQL)
def op10(table) -> DataFrame:
    """Benchmark passages in each document."""
    from .decontaminate import decontaminate

    return decontaminate(table("documents").select("doc_id", "text"), table("benchmark"), keep_text=False).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op8_license_sentences")
def op8(table) -> DataFrame:
    """Licence sentences and licences of each document."""
    from .licenses import scan_licenses

    scanned = scan_licenses(table("documents").select("doc_id", "text"))
    return scanned.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                          F.concat_ws(",", "sentence_ids").alias("sentence_ids"),
                          F.concat_ws(",", "licenses").alias("licenses"))


@query("op1_warc_transactions", """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM g
""")
def op1(table) -> DataFrame:
    """Each page's capture, from archives written and read back."""
    from ..session import cut_lineage, scratch_path
    from .warc import assemble, page_captures, read_archives, write_archives

    pages = table("pages")
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    records = cut_lineage(read_archives(pages.sparkSession, path), "warc-records")
    return page_captures(assemble(records))


@query("op5_superkmer_dedup", r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), x AS (
  SELECT DISTINCT r, p FROM (
    SELECT r, unnest(range(i, i + 35)) AS p FROM g
    WHERE h IN (SELECT h FROM g GROUP BY h HAVING count(*) > 1))
), k AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN x USING (r, p) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
""")
def op5(table) -> DataFrame:
    """What is left of each document without repeated windows."""
    from .superkmer import remove_repeats

    return remove_repeats(table("documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_ngram_jaccard")
def op3(table) -> DataFrame:
    """Each document's component of documents that link."""
    from .ngram_join import linked_groups

    return linked_groups(table("documents")).select("doc_id", "n_shingles", "component_id")


@query("op2_quality_pu")
def op2(table) -> DataFrame:
    """Quality score of each document."""
    from .quality_pu import pu_quality

    return pu_quality(table("documents").select("doc_id", "text"), table("labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query("op9_counterfactual_toxicity")
def op9(table) -> DataFrame:
    """Toxicity score of each document."""
    from .toxicity import toxicity

    return toxicity(table("documents").select("doc_id", "text"), table("labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query("op4_hmm_lm")
def op4(table) -> DataFrame:
    """Probability of each document under the unigram model and the hidden Markov model."""
    from .hmm_lm import score_texts

    return score_texts(table("documents"))


@query("op12_content_sort", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (t)
""")
def op12(table) -> DataFrame:
    """The document that stays for each, by equal texts."""
    from .content_sort import exact_groups

    return exact_groups(table("documents").select("doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op11_bond_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score,
       s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score
  AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
""")
def op11(table) -> DataFrame:
    """Hard negatives of every fiftieth vector; every seventh has a label of noise."""
    from .hard_negatives import hard_negatives

    vectors = table("embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(vectors, F.col("id") % 50 == 0)


@query("op13_era_collocations", r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents)
), f AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS n
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM p, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
  GROUP BY ALL
), t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND n >= 30),
s AS (
  SELECT c.lang, c.phrase, c.a, k, x.n AS l, y.n AS r, (2000000::HUGEINT * c.a) // (x.n::HUGEINT + y.n) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), u AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[i:i + j - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM c)))
  GROUP BY lang, phrase
)
SELECT s.lang, row_number() OVER w AS rank, s.phrase, a, l, r, t.n, CAST(score AS BIGINT) AS score
FROM s LEFT JOIN u ON s.lang = u.lang AND s.phrase = u.phrase JOIN t ON t.lang = s.lang
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
WINDOW w AS (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase)
QUALIFY row_number() OVER w <= 2000
""")
def op13(table) -> DataFrame:
    """Collocations of each language."""
    from .collocations import collocations

    return collocations(table("documents").select("lang", "text"))
