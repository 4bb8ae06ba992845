"""The registered queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, html, jaccard, linededup, mixing, neighbours, packing, quality, rangejoin, rules, scoring
from . import toxicity, whitening

QUERIES = {}
ORACLES = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.lattice_scores(table(spark, sf_dir, "documents"))


@query
def op2_domain_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = linededup.LineCopies(min_words=1)
    rows = linededup.drop_repeated_lines(table(spark, sf_dir, "documents"), copies, count="lines_removed")
    return rows.select("doc_id", "text", "lines_removed")


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_documents(table(spark, sf_dir, "documents"), jaccard.Near(words=3, percent=90))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


@query
def op12_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangejoin.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


ORACLES["op9_quality_rules"] = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce("text", '') AS t FROM documents),
words AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
spots AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3),
windows AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM spots),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(3, coalesce(after - i, 3))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after FROM twice) GROUP BY r),
base AS (
  SELECT doc_id, t, w, lines, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM words LEFT JOIN covered USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 25 * n_words
            OR 100 * (length(t) - length(replace(t, '!', ''))) > 25 * n_words
            OR 100 * n_dup_lines > 50 * len(lines)
            OR 100 * (length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')))
               > 50 * (length(t) - length(regexp_replace(t, '\p{L}', '', 'g')))
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM base
"""
