"""Registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import (
    bpe,
    collocations,
    decontaminate,
    html_wrappers,
    jaccard_join,
    language_id,
    personal_data,
    quality_gam,
    quality_rules,
    secret_scan,
    substring_dedup,
    token_alignment,
    token_counts,
)
from tidepool.session import stage_table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_table(spark, folder, "documents"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link_classes(_table(spark, folder, "documents"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_wrappers.extract_text(_table(spark, folder, "pages"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, folder, "documents"))


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), VOCABULARY)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, folder, "documents"), VOCABULARY)


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_rules(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_gam.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(_table(spark, folder, "documents"), lambda counts: stage_table(counts, "phrase-counts"))


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.find_private(_table(spark, folder, "documents"))


OP12_SQL = r"""
    WITH pieces AS (
        SELECT row_number() OVER () AS id, lang, piece FROM (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
    f1 AS (SELECT lang, w[i] AS w1, count(*) AS f FROM starts GROUP BY ALL),
    f2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM starts WHERE i + 1 <= len(w) GROUP BY ALL),
    f3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM starts WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
    cuts AS (
        SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.w1, t.w2, 2 AS size, 1 AS k, t.f AS a, x.f AS l, y.f AS r
        FROM f2 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 y ON y.lang = t.lang AND y.w1 = t.w2 WHERE t.f >= 10
        UNION ALL
        SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.w1, t.w2, 3, 1, t.f, x.f, y.f
        FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f2 y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
        UNION ALL
        SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.w1, t.w2, 3, 2, t.f, x.f, y.f
        FROM f3 t JOIN f2 x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN f1 y ON y.lang = t.lang AND y.w1 = t.w3),
    scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
    chosen AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, size, phrase ORDER BY score, k) = 1),
    longer AS (SELECT lang, w1, w2, max(f) AS f FROM (
        SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
    kept AS (SELECT c.* FROM chosen c LEFT JOIN longer g ON c.size = 2 AND g.lang = c.lang AND g.w1 = c.w1 AND g.w2 = c.w2
             WHERE g.f IS NULL OR 100 * g.f < 50 * c.a)
    SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept k JOIN total USING (lang) QUALIFY rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op12_phrase_collocations": OP12_SQL}
