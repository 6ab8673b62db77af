"""Registered queries: drift between the first and second half of January in ``events``."""

from __future__ import annotations

from ..operators import drift as D
from .registry import register
from .tables import read

CUT = "2024-01-16 00:00:00"
NUM = ["value", "user_id"]
CAT = ["event_type"]

_SETS_SQL = """sets AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS a,
                        CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS b FROM events)"""

_NUM_SQL = """lng AS (SELECT 'value' AS "column", CAST(value AS DOUBLE) AS v, a, b FROM sets WHERE value IS NOT NULL AND NOT isnan(value)
              UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE), a, b FROM sets WHERE user_id IS NOT NULL),
g AS (SELECT "column", v, sum(a) AS a, sum(b) AS b FROM lng GROUP BY "column", v),
c AS (SELECT "column", v, sum(a) OVER w / sum(a) OVER (PARTITION BY "column") AS fa,
             sum(b) OVER w / sum(b) OVER (PARTITION BY "column") AS fb,
             lead(v) OVER (PARTITION BY "column" ORDER BY v) AS nv,
             sum(a) OVER (PARTITION BY "column") AS na, sum(b) OVER (PARTITION BY "column") AS nb
      FROM g WINDOW w AS (PARTITION BY "column" ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
st AS (SELECT "column", max(abs(fa - fb)) AS ks, coalesce(sum(abs(fa - fb) * (nv - v)), 0) AS w,
              CAST(max(na) AS BIGINT) AS n_ref, CAST(max(nb) AS BIGINT) AS n_cur FROM c GROUP BY "column"),
sd AS (SELECT 'value' AS "column", stddev_pop(value) AS s FROM sets WHERE a = 1
       UNION ALL SELECT 'user_id', stddev_pop(CAST(user_id AS DOUBLE)) FROM sets WHERE a = 1),
num AS (SELECT st."column", ks, w, s, w / CASE WHEN s = 0 THEN 1 ELSE s END AS wn, n_ref, n_cur
        FROM st JOIN sd ON st."column" = sd."column")"""

_CAT_SQL = """cg AS (SELECT event_type AS value, sum(a) AS a, sum(b) AS b FROM sets WHERE event_type IS NOT NULL GROUP BY 1),
cs AS (SELECT value, a / sum(a) OVER () AS p, b / sum(b) OVER () AS q FROM cg),
cat AS (SELECT 'event_type' AS "column",
               sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                              + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END))) AS js FROM cs)"""


def _sets(spark, sf):
    e = read(spark, sf, "events")
    return D.split_by_time(e, "ts", CUT)


@register("d1_numeric_drift", "WITH " + _SETS_SQL + ",\n" + _NUM_SQL + """
SELECT "column", round(ks, 6) AS ks_stat, round(w, 6) AS wasserstein, round(s, 6) AS ref_std,
       round(wn, 6) AS wasserstein_norm, n_ref, n_cur FROM num""")
def d1_numeric_drift(spark, sf):
    ref, cur = _sets(spark, sf)
    return D.numeric_drift_stats(ref, cur, NUM)


@register("d2_categorical_drift", "WITH " + _SETS_SQL + ",\n" + _CAT_SQL + """
SELECT "column", round(js, 6) AS js_distance FROM cat""")
def d2_categorical_drift(spark, sf):
    ref, cur = _sets(spark, sf)
    return D.js_distance(ref, cur, CAT).select("column", "js_distance")


@register("d3_d4_drift_decision", "WITH " + _SETS_SQL + ",\n" + _NUM_SQL + ",\n" + _CAT_SQL + """,
cols AS (SELECT "column", 'numeric' AS kind, 'wasserstein_norm' AS method, wn AS statistic, wn >= 0.1 AS drifted FROM num
         UNION ALL SELECT "column", 'categorical', 'jensen_shannon', js, js >= 0.1 FROM cat)
SELECT count(*) AS n_columns, count_if(drifted) AS n_drifted, round(count_if(drifted) / count(*), 6) AS share,
       count_if(drifted) / count(*) >= 0.5 AS dataset_drift,
       CASE WHEN count_if(drifted) / count(*) >= 0.5 THEN 'retrain' ELSE 'skip' END AS decision FROM cols""")
def d3_d4_drift_decision(spark, sf):
    ref, cur = _sets(spark, sf)
    _, summary = D.drift_report(ref, cur, NUM, CAT, method="distances")
    return summary


@register("d3_drift_columns", "WITH " + _SETS_SQL + ",\n" + _NUM_SQL + ",\n" + _CAT_SQL + """
SELECT "column", 'numeric' AS kind, 'wasserstein_norm' AS method, round(wn, 6) AS statistic,
       CAST(0.1 AS DOUBLE) AS threshold, wn >= 0.1 AS drifted FROM num
UNION ALL SELECT "column", 'categorical', 'jensen_shannon', round(js, 6), CAST(0.1 AS DOUBLE), js >= 0.1 FROM cat""")
def d3_drift_columns(spark, sf):
    ref, cur = _sets(spark, sf)
    cols, _ = D.drift_report(ref, cur, NUM, CAT, method="distances")
    return cols

