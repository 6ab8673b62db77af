"""Registered queries: profiling."""

from __future__ import annotations

from ..functions.scalars import hash_draw
from ..operators import profile as P
from ..operators.encode import level_rows
from .registry import register
from .tables import DOC_ALL_SQL, DOC_NUMERIC, DOC_RAW_SQL, doc_all, doc_raw, read, with_


def _u(cols, tpl):
    return "\n  UNION ALL ".join(tpl.format(c=c) for c in cols)


@register("a14_describe", with_(DOC_ALL_SQL) + "SELECT \"column\", count, round(mean, 6) AS mean, round(std, 6) AS std, "
          "round(min, 6) AS min, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, round(max, 6) AS max "
          "FROM (" + _u(DOC_NUMERIC, "SELECT '{c}' AS \"column\", count({c}) AS count, avg(CAST({c} AS DOUBLE)) AS mean, "
                        "stddev_samp(CAST({c} AS DOUBLE)) AS std, CAST(min({c}) AS DOUBLE) AS min, "
                        "quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, "
                        "quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM doc_all") + ")")
def a14_describe(spark, sf):
    return P.describe(doc_all(spark, sf), DOC_NUMERIC)


_CORR_COLS = DOC_NUMERIC + ["quality"]


def _corr_sql():
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            if a == b:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN count({a}) > 1 AND "
                             f"stddev_pop(CAST({a} AS DOUBLE)) > 0 THEN CAST(1.0 AS DOUBLE) END AS corr FROM doc_raw")
            else:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                             f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM doc_raw")
    return "\nUNION ALL ".join(parts)


@register("a15_corr_matrix", with_(DOC_RAW_SQL) + _corr_sql())
def a15_corr_matrix(spark, sf):
    return P.corr_matrix(doc_raw(spark, sf), _CORR_COLS)


@register("a16_crosstab", with_(DOC_RAW_SQL) + "SELECT lang, quality, count(*) AS n FROM doc_raw GROUP BY lang, quality")
def a16_crosstab(spark, sf):
    return P.crosstab(doc_raw(spark, sf), "lang", "quality")


@register("a17_histogram", with_(DOC_ALL_SQL) + """,
mm AS (SELECT CAST(min(n_chars) AS DOUBLE) AS lo, CAST(max(n_chars) AS DOUBLE) AS hi FROM doc_all),
p0 AS (SELECT CASE WHEN hi > lo THEN lo ELSE lo - 0.5 END AS lo, CASE WHEN hi > lo THEN hi ELSE hi + 0.5 END AS hi FROM mm),
p AS (SELECT lo, hi, (hi - lo) / 10 AS w FROM p0),
b AS (SELECT CAST(least(floor((CAST(n_chars AS DOUBLE) - p.lo) / p.w), 9) AS INTEGER) AS bin, count(*) AS n
      FROM doc_all, p GROUP BY 1),
e AS (SELECT CAST(i AS INTEGER) AS bin, p.lo + i * p.w AS "left", CASE WHEN i < 9 THEN p.lo + (i + 1) * p.w ELSE p.hi END AS "right"
      FROM range(10) t(i), p)
SELECT e.bin, round(e."left", 6) AS "left", round(e."right", 6) AS "right", coalesce(b.n, 0) AS n
FROM e LEFT JOIN b ON e.bin = b.bin""")
def a17_histogram(spark, sf):
    return P.histogram(doc_all(spark, sf), "n_chars", 10)


@register("a18_density", with_(DOC_ALL_SQL) + """,
s AS (SELECT count(n_chars) AS n, stddev_samp(CAST(n_chars AS DOUBLE)) AS sd, CAST(min(n_chars) AS DOUBLE) AS lo,
             CAST(max(n_chars) AS DOUBLE) AS hi FROM doc_all),
p AS (SELECT n, lo, sd * pow(n, -1.0 / 5) AS h, (hi - lo) / 99 AS step FROM s),
vc AS (SELECT CAST(n_chars AS DOUBLE) AS v, count(*) AS w FROM doc_all GROUP BY 1),
g AS (SELECT CAST(i AS INTEGER) AS point FROM range(100) t(i))
SELECT g.point, round(p.lo + g.point * p.step, 6) AS x,
       round(sum(vc.w * exp(-0.5 * ((p.lo + g.point * p.step - vc.v) / p.h) * ((p.lo + g.point * p.step - vc.v) / p.h)))
             * (1.0 / (p.n * p.h * sqrt(2 * pi()))), 6) AS density
FROM g, vc, p GROUP BY g.point, p.lo, p.step, p.n, p.h""")
def a18_density(spark, sf):
    return P.density(doc_all(spark, sf), "n_chars", 100)


@register("a19_box_stats", with_(DOC_ALL_SQL) + """,
q AS (""" + _u(DOC_NUMERIC, "SELECT '{c}' AS \"column\", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, "
                            "quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 "
                            "FROM doc_all") + """),
l AS (""" + _u(DOC_NUMERIC, "SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM doc_all") + """)
SELECT q."column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       count_if(NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_fliers
FROM q JOIN l ON q."column" = l."column" GROUP BY q."column", q1, median, q3""")
def a19_box_stats(spark, sf):
    return P.box_stats(doc_all(spark, sf), DOC_NUMERIC)


@register("a20_pair_sample", with_(DOC_RAW_SQL) + """
SELECT doc_id, quality, n_chars, n_words FROM (
  SELECT *, row_number() OVER (PARTITION BY quality ORDER BY
     CAST(('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), '42')), 1, 8)) AS BIGINT), doc_id) AS r
  FROM doc_raw) WHERE r <= 25""")
def a20_pair_sample(spark, sf):
    d = doc_raw(spark, sf).select("doc_id", "quality", "n_chars", "n_words")
    return P.pair_sample(d, ["n_chars", "n_words"], "quality", "doc_id", 25, draw=hash_draw("doc_id"))


@register("k4_levels_long", """
SELECT "column", value, dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS rank FROM (
  SELECT DISTINCT 'p_name' AS "column", p_name AS value FROM part WHERE p_name IS NOT NULL
  UNION ALL SELECT DISTINCT 'p_brand', p_brand FROM part WHERE p_brand IS NOT NULL)""")
def k4_levels_long(spark, sf):
    return level_rows(read(spark, sf, "part"), ["p_name", "p_brand"])


@register("k4_sorted_levels", """
SELECT "column", list_sort(list(DISTINCT value)) AS levels FROM (
  SELECT 'lang' AS "column", lang AS value FROM documents WHERE lang IS NOT NULL
  UNION ALL SELECT 'source', source FROM documents WHERE source IS NOT NULL) GROUP BY "column\"""")
def k4_sorted_levels(spark, sf):
    return P.sorted_levels(read(spark, sf, "documents"), ["lang", "source"])

