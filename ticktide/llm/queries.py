"""The registered queries of the text operators, with production parameters, and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticktide.llm import (
    cgk, collocations, crf_lang, gru_lm, hard_negatives, html_paths, kneser_ney, licenses, mixing, pii, quality_rules,
    simhash, token_shards,
)
from ticktide.llm.tables import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.materialise(table(spark, sf_dir, "documents"), token_shards.shards_path(spark))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op5_candidate_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op6_html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_paths.extracted(table(spark, sf_dir, "pages"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cgk.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.scored(table(spark, sf_dir, "documents"))


def op10_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_lang.predict(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scanned(table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_order": op2_token_order,
    "op3_simhash": op3_simhash,
    "op4_mixing": op4_mixing,
    "op5_candidate_pii": op5_candidate_pii,
    "op6_html_paths": op6_html_paths,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_cgk_decontamination": op8_cgk_decontamination,
    "op9_gru_scores": op9_gru_scores,
    "op10_crf_language": op10_crf_language,
    "op11_license_scan": op11_license_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}

# The targets come from the same integers: sources are taken in order of their ceiling per weight until the
# level that the rest would get lies below the next ceiling.
CHECKS = {
    "op4_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           coalesce(md5(text), '') AS text_hash, row_number() OVER (PARTITION BY doc_id, source, text) AS nth FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, sum(source_size) OVER () AS all_words,
           sum(3 * source_size) OVER up - 3 * source_size AS fixed,
           sum(weight) OVER () - sum(weight) OVER up + weight AS weights
    FROM sources WINDOW up AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)
), level AS (
    SELECT (all_words - fixed)::BIGINT AS rest, weights::BIGINT AS weights FROM ordered
    WHERE (all_words - fixed) * weight <= 3 * source_size * weights
    ORDER BY source_size::DOUBLE / weight LIMIT 1
), rated AS (
    SELECT source, source_size,
           CASE WHEN rest IS NOT NULL AND rest * weight <= 3 * source_size * weights
                THEN (rest * weight)::DOUBLE / weights::DOUBLE ELSE (3 * source_size)::DOUBLE END AS target
    FROM sources LEFT JOIN level ON true
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM rated
), counted AS (
    SELECT doc_id, sized.source, size, source_size, target, rate,
           (floor(rate) + CASE WHEN ('0x' || md5(concat_ws(':', 17, coalesce(doc_id::VARCHAR, ''), text_hash, nth))[1:13])::BIGINT / 4503599627370496.0
                                    < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
    FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
)
SELECT *, copies * size AS taken FROM counted
""",
    "op12_hard_negatives": """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, a.vec_id = r.vec_id AS itself, r.vec_id,
           list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM usable a, usable r WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same AND NOT itself
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
    "op13_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), opened AS (
    SELECT lang, unnest(w) AS w1, unnest(w[2:] || [NULL]) AS w2, unnest(w[3:] || [NULL, NULL]) AS w3 FROM worded WHERE len(w) > 0
), f1 AS (
    SELECT lang, w1, count(*) AS f FROM opened WHERE w1 IS NOT NULL GROUP BY ALL
), f2 AS (
    SELECT lang, w1, w2, count(*) AS f FROM opened WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (
    SELECT lang, w1, w2, w3, count(*) AS f FROM opened WHERE w3 IS NOT NULL GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang
), c2 AS (
    SELECT c.lang, c.w1, c.w2, c.f AS a, l.f AS l, r.f AS r
    FROM f2 c JOIN f1 l ON l.lang = c.lang AND l.w1 = c.w1 JOIN f1 r ON r.lang = c.lang AND r.w1 = c.w2 WHERE c.f >= 10
), c3 AS (
    SELECT c.lang, c.w1, c.w2, c.w3, c.f AS a, l.f AS l1, lr.f AS r1, ll.f AS l2, r.f AS r2
    FROM f3 c JOIN f1 l ON l.lang = c.lang AND l.w1 = c.w1 JOIN f2 lr ON lr.lang = c.lang AND lr.w1 = c.w2 AND lr.w2 = c.w3
    JOIN f2 ll ON ll.lang = c.lang AND ll.w1 = c.w1 AND ll.w2 = c.w2 JOIN f1 r ON r.lang = c.lang AND r.w1 = c.w3
    WHERE c.f >= 10
), longer AS (
    SELECT lang, w1, w2, max(a) AS most
    FROM (SELECT lang, w1, w2, a FROM c3 UNION ALL SELECT lang, w2, w3, a FROM c3) GROUP BY ALL
), cuts AS (
    SELECT lang, w1 || ' ' || w2 AS phrase, a, 1 AS k, l, r
    FROM c2 LEFT JOIN longer USING (lang, w1, w2) WHERE most IS NULL OR 100 * most < 50 * a
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, 1, l1, r1 FROM c3
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, 2, l2, r2 FROM c3
), lowest AS (
    SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang) QUALIFY rank <= 2000
""",
}
