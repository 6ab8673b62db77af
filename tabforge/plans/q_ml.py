"""Registered queries: feature scores and selection, scaling, split and folds, metrics
(A21-A26, K1-K3, M2-M4, M9, M10).

Metrics are checked on a transparent rule (prediction = n_chars > 500, score =
n_chars) so that SQL can recompute them; the trained models use the same
operators on their own predictions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import metrics as M
from ..operators import split as SP
from .registry import register
from .tables import DOC_ALL_SQL, DOC_NUMERIC, DOC_RAW_SQL, doc_all, doc_raw, with_

ANOVA_COLS = DOC_NUMERIC + ["toxic"]
DRAW_SQL = "CAST(('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), '42')), 1, 8)) AS BIGINT)"


def _anova_sql(src: str) -> str:
    per = ", ".join([f"sum(CAST({c} AS DOUBLE)) AS s_{c}, sum(CAST({c} AS DOUBLE) * CAST({c} AS DOUBLE)) AS q_{c}"
                     for c in ANOVA_COLS])
    tot = ", ".join([f"sum(s_{c} * s_{c} / n) AS b_{c}, sum(s_{c}) AS ss_{c}, sum(q_{c}) AS qq_{c}" for c in ANOVA_COLS])
    sel = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS feature, ((b_{c} - ss_{c} * ss_{c} / nn) / (k - 1)) / ((qq_{c} - b_{c}) / (nn - k)) AS f_score FROM tot"
        for c in ANOVA_COLS)
    return (f"per AS (SELECT quality, count(*) AS n, {per} FROM {src} WHERE quality IS NOT NULL GROUP BY quality),\n"
            f"tot AS (SELECT CAST(sum(n) AS DOUBLE) AS nn, CAST(count(*) AS DOUBLE) AS k, {tot} FROM per),\n"
            f"scores AS ({sel})")


@register("a21_anova_f", with_(DOC_RAW_SQL, _anova_sql("doc_raw")) + "SELECT feature, round(f_score, 6) AS f_score FROM scores")
def a21_anova_f(spark, sf):
    return FE.anova_f(doc_raw(spark, sf), ANOVA_COLS, "quality")


@register("k2_feature_ranking", with_(DOC_RAW_SQL, _anova_sql("doc_raw")) +
          "SELECT feature, round(f_score, 6) AS f_score, row_number() OVER (ORDER BY f_score DESC, feature) AS rank FROM scores")
def k2_feature_ranking(spark, sf):
    return FE.rank_features(FE.anova_f(doc_raw(spark, sf), ANOVA_COLS, "quality"))


@register("k1_m3_select_top_k", with_(DOC_RAW_SQL, _anova_sql("doc_raw")) + """
SELECT feature, rank <= 3 AS selected FROM (
  SELECT feature, row_number() OVER (ORDER BY f_score DESC, CASE feature """
          + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(ANOVA_COLS)) + """ END) AS rank FROM scores)""")
def k1_m3_select_top_k(spark, sf):
    scores = FE.anova_f(doc_raw(spark, sf), ANOVA_COLS, "quality")
    keep = FE.select_top_k(scores, 3, ANOVA_COLS)
    return scores.select("feature", F.col("feature").isin(keep).alias("selected"))


@register("m2_standard_scaler", with_(DOC_ALL_SQL) + "SELECT doc_id, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) OVER () = 0 "
    f"THEN 1 ELSE stddev_pop(CAST({c} AS DOUBLE)) OVER () END, 6) AS {c}" for c in DOC_NUMERIC) + " FROM doc_all")
def m2_standard_scaler(spark, sf):
    d = doc_all(spark, sf).select("doc_id", *DOC_NUMERIC)
    return FE.apply_scaler(d, FE.fit_standard_scaler(d, DOC_NUMERIC))


_QUOTA_SQL = """cc AS (SELECT quality AS cls, count(*) AS c FROM doc_raw GROUP BY quality),
tt AS (SELECT sum(c) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(c)) AS BIGINT) AS n_test FROM cc),
a1 AS (SELECT cls, c, (tt.n - tt.n_test) * c / tt.n AS cont, floor((tt.n - tt.n_test) * c / tt.n) AS fl,
              tt.n - tt.n_test AS draws FROM cc, tt),
a2 AS (SELECT *, draws - sum(fl) OVER () AS need, row_number() OVER (ORDER BY cont - fl DESC, cls DESC) AS rk FROM a1),
tr AS (SELECT cls, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS n_train FROM a2),
rk AS (SELECT doc_id, quality, n_chars, row_number() OVER (PARTITION BY quality ORDER BY """ + DRAW_SQL + """, doc_id) - 1 AS r
       FROM doc_raw),
splits AS (SELECT rk.doc_id, rk.quality, rk.n_chars, CASE WHEN rk.r < tr.n_train THEN 'train' ELSE 'test' END AS split
           FROM rk JOIN tr ON rk.quality = tr.cls)"""


@register("m4_stratified_split", with_(DOC_RAW_SQL, _QUOTA_SQL) + "SELECT doc_id, quality, split FROM splits")
def m4_stratified_split(spark, sf):
    d = doc_raw(spark, sf).select("doc_id", "quality")
    return SP.stratified_split(d, "quality", "doc_id", 0.2, 42)


_FOLD_SQL = """cls AS (SELECT quality AS cls, count(*) AS c FROM doc_raw GROUP BY quality),
off AS (SELECT cls, c, coalesce(sum(c) OVER (ORDER BY cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
        FROM cls),
al AS (SELECT cls, i, CAST(ceil((a + c - i) / 5) - ceil((a - i) / 5) AS BIGINT) AS sz FROM off, range(5) t(i)),
cum AS (SELECT cls, i, sum(sz) OVER (PARTITION BY cls ORDER BY i) AS hi FROM al),
frk AS (SELECT doc_id, quality, n_chars, row_number() OVER (PARTITION BY quality ORDER BY """ + DRAW_SQL + """, doc_id) - 1
        AS r FROM doc_raw),
folds AS (SELECT doc_id, quality, n_chars, CAST(min(i) AS INTEGER) AS fold FROM frk JOIN cum ON cum.cls = frk.quality
          AND frk.r < cum.hi GROUP BY doc_id, quality, n_chars)"""


@register("m9_stratified_folds", with_(DOC_RAW_SQL, _FOLD_SQL) + "SELECT doc_id, quality, fold FROM folds")
def m9_stratified_folds(spark, sf):
    d = doc_raw(spark, sf).select("doc_id", "quality")
    return SP.stratified_folds(d, "quality", "doc_id", 5, 42)


# every seventh label is missing: rows without a label are a class of their own, the last
_NULLED_SQL = """doc_raw AS (SELECT doc_id, n_chars, CASE WHEN doc_id % 7 <> 3 THEN quality END AS quality FROM doc_labelled)"""


def _nulled_sql(sql: str) -> str:
    """The same SQL over labels with gaps, null last and equal to itself."""
    sql = sql.replace("ON rk.quality = tr.cls", "ON rk.quality IS NOT DISTINCT FROM tr.cls").replace(
        "ON cum.cls = frk.quality", "ON cum.cls IS NOT DISTINCT FROM frk.quality")
    sql = sql.replace("cont - fl DESC, cls DESC", "cont - fl DESC, cls DESC NULLS LAST").replace("ORDER BY cls ROWS", "ORDER BY cls NULLS LAST ROWS")
    return with_(DOC_RAW_SQL.replace("doc_raw AS", "doc_labelled AS"), _NULLED_SQL, sql)


def _nulled(spark, sf):
    return doc_raw(spark, sf).select("doc_id", F.when(F.col("doc_id") % 7 != 3, F.col("quality")).alias("quality"))


@register("m4_split_null_label", _nulled_sql(_QUOTA_SQL) + "SELECT doc_id, quality, split FROM splits")
def m4_split_null_label(spark, sf):
    return SP.stratified_split(_nulled(spark, sf), "quality", "doc_id", 0.2, 42)


@register("m9_folds_null_label", _nulled_sql(_FOLD_SQL) + "SELECT doc_id, quality, fold FROM folds")
def m9_folds_null_label(spark, sf):
    return SP.stratified_folds(_nulled(spark, sf), "quality", "doc_id", 5, 42)


def _rule(df, threshold=500):
    return df.select("doc_id", F.col("quality").alias("label"),
                     (F.col("n_chars") > threshold).cast("int").alias("prediction"),
                     F.col("n_chars").cast("double").alias("score"))


_RULE_SQL = "ruled AS (SELECT doc_id, quality AS label, CAST(n_chars > 500 AS INTEGER) AS prediction, " \
            "CAST(n_chars AS DOUBLE) AS score FROM doc_raw)"


@register("a22_confusion", with_(DOC_RAW_SQL, _RULE_SQL) + """
SELECT count_if(label <> 1 AND prediction <> 1) AS tn, count_if(label <> 1 AND prediction = 1) AS fp,
       count_if(label = 1 AND prediction <> 1) AS fn, count_if(label = 1 AND prediction = 1) AS tp FROM ruled""")
def a22_confusion(spark, sf):
    return M.confusion(_rule(doc_raw(spark, sf)))


_METRICS_SQL = """
SELECT round(CASE WHEN tp + tn + fp + fn = 0 THEN 0 ELSE (tp + tn) / (tp + tn + fp + fn) END, 4) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 4) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 4) AS f1, tn, fp, fn, tp
FROM (SELECT count_if(label <> 1 AND prediction <> 1) AS tn, count_if(label <> 1 AND prediction = 1) AS fp,
             count_if(label = 1 AND prediction <> 1) AS fn, count_if(label = 1 AND prediction = 1) AS tp FROM ruled)"""


@register("a23_binary_metrics", with_(DOC_RAW_SQL, _RULE_SQL) + _METRICS_SQL)
def a23_binary_metrics(spark, sf):
    return M.binary_metrics(_rule(doc_raw(spark, sf)))


@register("a24_class_report", with_(DOC_RAW_SQL, _RULE_SQL) + """,
per AS (SELECT cls, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS precision,
               CASE WHEN support = 0 THEN 0 ELSE hit / support END AS recall, support FROM (
          SELECT c.cls, count_if(CAST(r.label AS VARCHAR) = c.cls) AS support,
                 count_if(CAST(r.prediction AS VARCHAR) = c.cls) AS predicted,
                 count_if(CAST(r.label AS VARCHAR) = c.cls AND r.label = r.prediction) AS hit
          FROM (SELECT DISTINCT CAST(label AS VARCHAR) AS cls FROM ruled UNION SELECT DISTINCT CAST(prediction AS VARCHAR)
                FROM ruled) c, ruled r GROUP BY c.cls)),
rows AS (SELECT cls, precision, recall, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
                CAST(support AS BIGINT) AS support FROM per)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rows
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM rows
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rows""")
def a24_class_report(spark, sf):
    return M.class_report(_rule(doc_raw(spark, sf)))


@register("a25_roc_auc", with_(DOC_RAW_SQL, _RULE_SQL) + """,
g AS (SELECT score AS s, count_if(label = 1) AS p, count_if(label <> 1) AS n FROM ruled GROUP BY score),
c AS (SELECT s, p, n, sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM g)
SELECT round(sum(p * ((cn - n) + n / 2.0)) / (CAST(sum(p) AS DOUBLE) * sum(n)), 6) AS roc_auc FROM c""")
def a25_roc_auc(spark, sf):
    return M.roc_auc(_rule(doc_raw(spark, sf)))


@register("a26_cv_summary", with_(DOC_RAW_SQL, _FOLD_SQL) + """,
pf AS (SELECT fold, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS score FROM (
         SELECT fold, count_if(quality = 1 AND n_chars > 500) AS tp, count_if(quality <> 1 AND n_chars > 500) AS fp,
                count_if(quality = 1 AND NOT n_chars > 500) AS fn FROM folds GROUP BY fold))
SELECT 'rule_n_chars_500' AS model, round(avg(score), 4) AS cv_mean, round(stddev_pop(score), 4) AS cv_std FROM pf""")
def a26_cv_summary(spark, sf):
    d = doc_raw(spark, sf).select("doc_id", "quality", "n_chars")
    folds = SP.stratified_folds(d, "quality", "doc_id", 5, 42)
    ruled = folds.select("fold", F.col("quality").alias("label"), (F.col("n_chars") > 500).cast("int").alias("prediction"))
    per_fold = M.binary_metrics(ruled, by=["fold"], places=None).select(
        F.lit("rule_n_chars_500").alias("model"), F.col("f1").alias("score"))
    return M.cv_summary(per_fold)


@register("m10_fit_diagnosis", with_(DOC_RAW_SQL, _QUOTA_SQL) + """,
acc AS (SELECT t.threshold,
          round(avg(CASE WHEN split = 'train' THEN CAST(CAST(n_chars > t.threshold AS INTEGER) = quality AS INTEGER) END), 4) AS train_acc,
          round(avg(CASE WHEN split = 'test' THEN CAST(CAST(n_chars > t.threshold AS INTEGER) = quality AS INTEGER) END), 4) AS test_acc
        FROM splits, (VALUES (500), (1000), (3000)) t(threshold) GROUP BY t.threshold)
SELECT 'rule_n_chars_' || CAST(threshold AS VARCHAR) AS model, train_acc, test_acc,
  CASE WHEN train_acc - test_acc > 0.1 THEN 'OVERFIT — train/test gap: ' || printf('%.4f', train_acc - test_acc)
       WHEN train_acc < 0.8 AND test_acc < 0.8 THEN 'UNDERFIT — both scores below 0.8'
       ELSE 'GOOD FIT — train/test gap: ' || printf('%.4f', train_acc - test_acc) END AS diagnosis
FROM acc""")
def m10_fit_diagnosis(spark, sf):
    # one split, one aggregate for all rules (a single scan and rank), then one row per rule
    d = SP.stratified_split(doc_raw(spark, sf).select("doc_id", "quality", "n_chars"), "quality", "doc_id", 0.2, 42)
    rules = (500, 1000, 3000)
    aggs = []
    for t in rules:
        hit = ((F.col("n_chars") > t).cast("int") == F.col("quality")).cast("int")
        aggs += [F.avg(F.when(F.col("split") == "train", hit)).alias(f"tr_{t}"),
                 F.avg(F.when(F.col("split") == "test", hit)).alias(f"te_{t}")]
    per_rule = F.array(*[F.struct(F.lit(f"rule_n_chars_{t}").alias("model"),
                                  F.round(F.col(f"tr_{t}"), 4).alias("train_acc"),
                                  F.round(F.col(f"te_{t}"), 4).alias("test_acc")) for t in rules])
    r = d.agg(*aggs).select(F.inline(per_rule))
    return r.withColumn("diagnosis", M.diagnose(F.col("train_acc"), F.col("test_acc")))
