"""Registered queries: data-quality checks (A1-A13, L2) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from .registry import register
from .tables import (DOC_ALL_SQL, DOC_NUMERIC, DOC_RAW_SQL, DOC_TARGET, doc_all, doc_raw, read, with_)


def _union_sql(cols, template):
    return "\n  UNION ALL ".join(template.format(c=c) for c in cols)


@register("a1_shape", with_(DOC_ALL_SQL) + """
SELECT count(*) AS total_rows, CAST(9 AS BIGINT) AS total_columns FROM doc_all""")
def a1_shape(spark, sf):
    return Q.shape(doc_all(spark, sf))


@register("a2_null_counts", with_(DOC_ALL_SQL) + "SELECT * FROM (\n  " + _union_sql(
    ["doc_id", "lang", "source", "n_chars", "n_words", "n_lines", "n_digits", "quality", "toxic"],
    "SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS null_count FROM doc_all") + ")")
def a2_null_counts(spark, sf):
    return Q.null_counts(doc_all(spark, sf))


@register("a3_duplicate_count", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_count, coalesce(sum(n - 1), 0) = 0 AS passed
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source)""")
def a3_duplicate_count(spark, sf):
    return Q.duplicate_count(read(spark, sf, "documents").select("text", "lang", "source"))


@register("a4_drop_duplicates", "SELECT DISTINCT text, lang, source FROM documents")
def a4_drop_duplicates(spark, sf):
    return Q.drop_duplicates(read(spark, sf, "documents").select("text", "lang", "source"))


@register("a5_value_counts", "SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def a5_value_counts(spark, sf):
    return Q.value_counts(read(spark, sf, "documents"), "lang")


@register("a6_imbalance", with_(DOC_RAW_SQL) + """,
per AS (SELECT quality, count(*) AS n FROM doc_raw GROUP BY quality),
r AS (SELECT sum(n) AS total_rows, min(n) FILTER (WHERE quality IS NOT NULL) AS mn,
             max(n) FILTER (WHERE quality IS NOT NULL) AS mx, count(*) FILTER (WHERE quality IS NOT NULL) AS k FROM per)
SELECT CAST(total_rows AS BIGINT) AS total_rows, CAST(k AS BIGINT) AS n_classes, CAST(mn AS BIGINT) AS minority_count,
       CAST(mx AS BIGINT) AS majority_count, round(round((mn / total_rows) * 100, 2), 6) AS minority_pct,
       mn / total_rows >= 0.2 AS passed, mn / total_rows < 0.2 AS rebalance_needed
FROM r""")
def a6_imbalance(spark, sf):
    return Q.imbalance(doc_raw(spark, sf), DOC_TARGET, 0.20)


@register("a7_class_share", with_(DOC_ALL_SQL) + """
SELECT quality, count(*) AS n, round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 6) AS pct
FROM doc_all WHERE quality IS NOT NULL GROUP BY quality""")
def a7_class_share(spark, sf):
    return Q.class_share(doc_all(spark, sf), DOC_TARGET)


@register("a8_skewness", with_(DOC_ALL_SQL) + """
SELECT "column", round(s, 6) AS skewness, round(round(s, 2), 6) AS skewness_2dp, abs(round(s, 2)) <= 1.0 AS passed
FROM (""" + _union_sql(DOC_NUMERIC, "SELECT '{c}' AS \"column\", skewness(CAST({c} AS DOUBLE)) AS s FROM doc_all") + ")")
def a8_skewness(spark, sf):
    return Q.skewness(doc_all(spark, sf), DOC_NUMERIC, 1.0)


_FENCES_SQL = """fences AS (
  SELECT "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
  """ + _union_sql(DOC_NUMERIC, "SELECT '{c}' AS \"column\", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, "
                                "quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM doc_all") + "))"


@register("a9_iqr_fences", with_(DOC_ALL_SQL, _FENCES_SQL) + """
SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lower, 6) AS lower,
       round(upper, 6) AS upper FROM fences""")
def a9_iqr_fences(spark, sf):
    return Q.iqr_fences(doc_all(spark, sf), DOC_NUMERIC)


@register("a10_outlier_counts", with_(DOC_ALL_SQL, _FENCES_SQL) + """,
cnt AS (""" + _union_sql(DOC_NUMERIC, "SELECT '{c}' AS \"column\", count_if(CAST(d.{c} AS DOUBLE) < f.lower OR "
                                      "CAST(d.{c} AS DOUBLE) > f.upper) AS n FROM doc_all d, fences f "
                                      "WHERE f.\"column\" = '{c}'") + """)
SELECT c."column", CAST(c.n AS BIGINT) AS n_outliers, round(f.lower, 6) AS lower, round(f.upper, 6) AS upper,
       c.n = 0 AS passed
FROM cnt c JOIN fences f ON c."column" = f."column\"""")
def a10_outlier_counts(spark, sf):
    return Q.outlier_counts(doc_all(spark, sf), DOC_NUMERIC)


_A11_SQL = """
WITH meta AS (SELECT * FROM (VALUES ('p_size', 'numeric', 'int', true), ('p_retailprice', 'numeric', 'double', true),
                      ('p_brand', 'numeric', 'string', false), ('p_type', 'categorical', 'string', true),
                      ('p_partkey', 'categorical', 'bigint', false)) m("column", declared, actual, kind_ok)),
u AS (SELECT 'p_size' AS "column", CAST(0 AS BIGINT) AS unparsable
      UNION ALL SELECT 'p_retailprice', CAST(0 AS BIGINT)
      UNION ALL SELECT 'p_brand', count_if(p_brand IS NOT NULL AND TRY_CAST(p_brand AS DOUBLE) IS NULL) FROM part
      UNION ALL SELECT 'p_type', CAST(0 AS BIGINT)
      UNION ALL SELECT 'p_partkey', CAST(0 AS BIGINT))
SELECT m."column", declared, actual, kind_ok, CAST(unparsable AS BIGINT) AS unparsable, kind_ok AND unparsable = 0 AS passed
FROM meta m JOIN u ON m."column" = u."column\""""


@register("a11_type_issues", _A11_SQL)
def a11_type_issues(spark, sf):
    part = read(spark, sf, "part")
    return Q.type_issues(part, ["p_size", "p_retailprice", "p_brand"], ["p_type", "p_partkey"])


@register("a13_leakage_check", with_(DOC_RAW_SQL) + """
SELECT 'toxic' AS "column", true AS present, round(corr(CAST(toxic AS DOUBLE), CAST(quality AS DOUBLE)), 6) AS corr
FROM doc_raw
UNION ALL SELECT 'n_chars', true, round(corr(CAST(n_chars AS DOUBLE), CAST(quality AS DOUBLE)), 6) FROM doc_raw
UNION ALL SELECT 'survival_months', false, CAST(NULL AS DOUBLE)""")
def a13_leakage_check(spark, sf):
    return Q.leakage_check(doc_raw(spark, sf), ["toxic", "n_chars", "survival_months"], DOC_TARGET)
