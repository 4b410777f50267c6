"""The registered queries of this folder, each over its whole table, and their
SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import (
    filter_audit,
    html_text,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    spelling_variants,
    token_counts,
    vector_search,
    warc,
)
from txrisk.llm.common import table
from txrisk.session import scratch_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COUNTED_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vector_search.search(rows, F.col("vec_id") % 100 == 0)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("scores")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.col("removed_words").cast("bigint"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("uses")).alias("taken")
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, added_tokens=True)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the lines with a word, those deleted, and what is left."""
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return found.select(
        "doc_id", "n_lines", "n_deleted", F.length(text).cast("bigint").alias("n_chars"),
        F.md5(text.cast("binary")).alias("text_md5"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_audit.documents_with_filters(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    lost = {"good_lost": "good", "toxic_lost": "toxic"}
    return filter_audit.filter_audit(rows, "ABCDE", lost)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache is new, so every distinct text is encoded."""
    cache = scratch_dir(spark, "token-counts")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), COUNTED_TOKENIZER, cache)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join, op2_quality_classifier, op3_vector_search, op4_pii, op5_html_text,
        op6_quality_rules, op7_mixing, op8_packing, op9_warc, op10_line_dedup,
        op11_filter_audit, op12_spelling_variants, op13_token_counts,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLES: dict[str, str] = {
    "op1_ngram_join": f"""
        WITH RECURSIVE words AS MATERIALIZED (
            SELECT doc_id,
                {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS ws
            FROM documents
        ), sets AS MATERIALIZED (
            SELECT doc_id, CASE
                WHEN len(ws) = 0 THEN []
                WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 3),
                    lambda i: array_to_string(ws[i:i + 4], ' ')))
                END AS grams
            FROM words
        ), entries AS MATERIALIZED (
            SELECT doc_id, unnest(grams) AS gram FROM sets
        ), pairs AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM entries a JOIN entries b ON a.gram = b.gram AND a.doc_id < b.doc_id
            GROUP BY ALL
        ), linked AS MATERIALIZED (
            SELECT a, b FROM pairs
            JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
            WHERE 100 * shared >= 80 * (len(x.grams) + len(y.grams) - shared)
        ), ways AS MATERIALIZED (
            SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION
            SELECT r.doc_id, w.b FROM reach r JOIN ways w ON w.a = r.other
        ), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, component_id
        FROM sets JOIN least USING (doc_id)""",
    "op3_vector_search": """
        WITH vectors AS MATERIALIZED (
            SELECT vec_id,
                list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM vectors q JOIN vectors c
                ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT query_id, vec_id, score, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op6_quality_rules": rf"""
        WITH texts AS MATERIALIZED (
            SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
                {_WORDS.format("coalesce(text, '')")} AS ws,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
            FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS gram
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM texts)
        ), repeated AS (
            SELECT doc_id, count(DISTINCT place) AS n FROM (
                SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM (
                    SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM windows)
                WHERE times > 1)
            GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, host, t, k, len({_WORDS.format("l")}) AS n,
                regexp_replace(trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' '),
                    '[0-9]+', '0', 'g') AS line
            FROM (SELECT doc_id, host, md5(t) AS t, unnest(ls) AS l,
                unnest(range(len(ls))) AS k FROM texts)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth FROM lines
        ), holders AS (
            SELECT host, line, count(DISTINCT t) AS n FROM placed GROUP BY host, line
        ), hosts AS (SELECT host, count(*) AS n FROM texts GROUP BY host),
        frequent AS (
            SELECT host, line FROM holders h JOIN hosts s USING (host)
            WHERE h.n > 2 AND h.n > 0.02 * s.n
        ), removed AS (
            SELECT doc_id, sum(n) AS n FROM placed p JOIN frequent USING (host, line)
            WHERE nth = 1 GROUP BY doc_id
        ), figures AS (
            SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
                CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT)
                    AS n_symbols,
                CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
                CAST(coalesce(m.n, 0) AS BIGINT) AS removed_words
            FROM texts LEFT JOIN repeated r USING (doc_id) LEFT JOIN removed m USING (doc_id)
        ), judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
            FROM figures
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            removed_words,
            NOT base_failed AND NOT n_words - removed_words < 0.2 * n_words AS kept
        FROM judged""",
    "op11_filter_audit": f"""
        WITH RECURSIVE texts AS MATERIALIZED (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                {_WORDS.format("coalesce(text, '')")} AS ws,
                min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
            FROM documents
        ), marks AS (
            SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
        ), masks AS (
            SELECT part, quality, toxic,
                CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
                + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
                + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))
                    > 10 * length(t) THEN 4 ELSE 0 END
                + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                + CASE WHEN first_id < doc_id THEN 16 ELSE 0 END AS mask
            FROM texts LEFT JOIN marks USING (doc_id)
        ), cells AS MATERIALIZED (
            SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good,
                count(*) FILTER (WHERE toxic = 1) AS toxic
            FROM masks GROUP BY part, mask
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
        ), prefixes AS (
            SELECT '' AS prefix, '' AS letter, 0 AS before, 0 AS applied, 0 AS bit
            UNION ALL
            SELECT p.prefix || l.letter, l.letter, p.applied, p.applied | l.bit, l.bit
            FROM prefixes p JOIN letters l ON p.applied & l.bit = 0
        ), figures AS MATERIALIZED (
            SELECT part, prefix, letter,
                coalesce(sum(n) FILTER (WHERE mask & applied = 0), 0) AS kept,
                coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0) AS removed,
                coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before <> 0), 0)
                    AS redundant,
                coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
                coalesce(sum(good) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0)
                    AS good_lost,
                coalesce(sum(toxic) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0)
                    AS toxic_lost
            FROM prefixes CROSS JOIN cells WHERE prefix <> '' GROUP BY ALL
        ), orders AS (
            SELECT prefix AS filter_order, unnest([1, 2, 3, 4, 5]) AS step
            FROM prefixes WHERE length(prefix) = 5
        ), rows AS (
            SELECT part, filter_order, step, letter, kept, removed, redundant, unique_fails,
                good_lost, toxic_lost
            FROM orders JOIN figures ON prefix = left(filter_order, step)
        )
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept,
            CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
            CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
            CAST(toxic_lost AS BIGINT) AS toxic_lost,
            CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM rows""",
}
