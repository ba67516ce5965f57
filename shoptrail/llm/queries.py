"""Registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoptrail.llm import (
    bpe, filter_audit, hard_negatives, jaccard_join, language, mixture, neighbours, quality_model, quality_rules, simhash, substring_dedup,
    tokens_by_section, url_rules,
)
from shoptrail.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"


def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return bpe.round_trip(documents, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


#: Fixed rules of the query: host, path, verdict.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return tokens_by_section.count_by_section(documents, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of removed passages as text, ``start-end`` with commas between."""
    cleaned = substring_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = F.transform("removed", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string")))
    return cleaned.withColumn("removed", F.array_join(shown, ","))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similar(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op5_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_ROWS} AS rules(host, path, verdict)")
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh id are moved to the next class first."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_token_counts": op2_token_counts,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_source_mixture": op5_source_mixture,
    "op6_language_id": op6_language_id,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_byte_level_bpe": op8_byte_level_bpe,
    "op9_url_filters": op9_url_filters,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op9_url_filters": f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
    FROM pages
),
parts AS (
    SELECT page_id, row_number() OVER () AS n,
           translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
),
fitting AS (
    SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
    FROM parts JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fitting USING (n)
""",
    "op11_filter_audit": r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
measured AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copied
    FROM texts
),
failed AS (
    SELECT doc_id, part,
           (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
           + 4 * (100 * upper > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * copied::INT AS mask
    FROM measured
),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
counted AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, mask
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (
    SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS f,
           1 << (strpos('ABCDE', substr(filter_order, step, 1)) - 1) AS own,
           (SELECT coalesce(sum(1 << (i - 1)), 0) FROM range(1, 6) AS bits(i)
            WHERE contains(substr(filter_order, 1, step - 1), substr('ABCDE', i, 1)))::INT AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
rows_of AS (
    SELECT part, filter_order, step, f,
           sum(n) FILTER (mask & (own | before) = 0) AS kept,
           sum(n) FILTER (mask & own <> 0 AND mask & before = 0) AS removed,
           sum(n) FILTER (mask & own <> 0 AND mask & before <> 0) AS redundant,
           sum(n) FILTER (mask = own) AS unique_fails,
           sum(good) FILTER (mask & own <> 0 AND mask & before = 0) AS good_lost,
           sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0) AS toxic_lost
    FROM counted, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM rows_of
""",
    "op12_hard_negatives": """
WITH clean AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM clean a JOIN clean b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 5
""",
}
