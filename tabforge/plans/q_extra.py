"""Registered queries: remaining inventory rows (J2 on labels, P4, A28, F9-F11, M5, M8, L4)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean as C
from ..operators import metrics as M
from ..operators import models as MO
from ..operators import score as SC
from ..operators import split as SP
from ..operators.resample import smote
from ..session import materialize
from ..spec import ScoringSpec
from .q_ml import _QUOTA_SQL
from .registry import register
from .tables import DOC_ALL_SQL, DOC_NUMERIC, DOC_RAW_SQL, doc_all, doc_raw, read, with_


@register("j2_unlabelled_documents", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j2_unlabelled_documents(spark, sf):
    """Documents outside the labelled domain: the rows a trained model has to score live."""
    d = read(spark, sf, "documents").select("doc_id", "lang")
    return C.outside_domain(d, "doc_id", read(spark, sf, "labels"))


@register("p4_assemble", with_(DOC_RAW_SQL) + "SELECT doc_id, [" + ", ".join(
    f"CAST({c} AS DOUBLE)" for c in DOC_NUMERIC) + "] AS features, CAST(quality AS DOUBLE) AS label FROM doc_raw")
def p4_assemble(spark, sf):
    a = C.assemble(doc_raw(spark, sf), DOC_NUMERIC, "quality", keep=["doc_id"])
    return a.select("doc_id", vector_to_array("features").alias("features"), "label")


@register("a28_quality_by_dataset", with_(DOC_RAW_SQL, _QUOTA_SQL) + """
SELECT CASE split WHEN 'train' THEN 'reference' ELSE 'current' END AS dataset,
       round(CASE WHEN tp + tn + fp + fn = 0 THEN 0 ELSE (tp + tn) / (tp + tn + fp + fn) END, 4) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 4) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 4) AS f1, tn, fp, fn, tp
FROM (SELECT split, count_if(quality <> 1 AND n_chars <= 500) AS tn, count_if(quality <> 1 AND n_chars > 500) AS fp,
             count_if(quality = 1 AND n_chars <= 500) AS fn, count_if(quality = 1 AND n_chars > 500) AS tp
      FROM splits GROUP BY split)""")
def a28_quality_by_dataset(spark, sf):
    d = SP.stratified_split(doc_raw(spark, sf).select("doc_id", "quality", "n_chars"), "quality", "doc_id", 0.2, 42)
    d = d.select(F.when(F.col("split") == "train", "reference").otherwise("current").alias("dataset"),
                 F.col("quality").alias("label"), (F.col("n_chars") > 500).cast("int").alias("prediction"))
    return M.binary_metrics(d, by=["dataset"])


@register("f9_f11_review", with_(DOC_ALL_SQL) + """,
p AS (SELECT doc_id, CAST(n_words AS DOUBLE) / (CAST(n_words AS DOUBLE) + 300) AS p1 FROM doc_all)
SELECT doc_id, CASE WHEN p1 >= 0.5 THEN 'high' ELSE 'low' END AS prediction,
       round(greatest(p1, 1 - p1) * 100, 2) AS confidence,
       CAST(round(p1 * 100, 2) AS VARCHAR) || '%' AS p1_text,
       round(round(p1 * 100, 2), 6) AS p1_parsed,
       round(greatest(p1, 1 - p1) * 100, 2) >= 50 AS high_confidence,
       CASE WHEN round(greatest(p1, 1 - p1) * 100, 2) < 50 THEN 'Low confidence' END AS warning,
       round(round(p1 * 100, 2), 6) AS high_prob, round(round((1 - p1) * 100, 2), 6) AS low_prob, 'rule' AS model_used, true AS stamped
FROM p""")
def f9_f11_review(spark, sf):
    d = doc_all(spark, sf).select("doc_id", (F.col("n_words").cast("double") / (F.col("n_words").cast("double") + 300))
                                  .alias("p1"))
    d = d.select("*", F.array(1 - F.col("p1"), F.col("p1")).alias("probability"), (F.col("p1") >= 0.5).cast("int").alias("prediction"))
    spec = ScoringSpec([], {}, {}, class_names={0: "low", 1: "high"}, warning_text="Low confidence")
    txt = S.percent_text("p1")
    return SC.review(d, spec, "rule").select(
        "doc_id", "prediction", "confidence", txt.alias("p1_text"), S.parse_percent(txt).alias("p1_parsed"), "high_confidence",
        "warning", "high_prob", "low_prob", "model_used", F.col("timestamp").isNotNull().alias("stamped"))


def _linear_checks(spark, sf, name):
    """What must hold of a linear model on the held-out split, whatever the optimizer's last digits: the counts add
    up, both classes are told apart, and the AUC beats chance and is not far below logistic regression's."""
    d = materialize(SP.stratified_split(doc_raw(spark, sf), "quality", "doc_id", 0.2, 42), "linear")
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    train = materialize(smote(train, "doc_id", "quality", DOC_NUMERIC), "linear-train")  # balanced classes, as in L4
    ev = MO.evaluate(MO.fit(name, train, DOC_NUMERIC, "quality"), test, "quality").first()
    base = ev if name == "logistic_regression" else MO.evaluate(MO.fit("logistic_regression", train, DOC_NUMERIC, "quality"), test, "quality").first()
    return spark.createDataFrame([(name, ev["test_samples"], ev["tn"] + ev["fp"], ev["tn"] > 0, ev["roc_auc"] > 0.5,
                                   ev["roc_auc"] >= base["roc_auc"] - 0.05)],
                                 "model string, test_samples bigint, negatives bigint, finds_negatives boolean, beats_chance boolean, "
                                 "near_logistic boolean")


def _linear_sql(name: str) -> str:
    return with_(DOC_RAW_SQL, _QUOTA_SQL) + f"""
SELECT '{name}' AS model, count(*) AS test_samples, count_if(quality <> 1) AS negatives, true AS finds_negatives, true AS beats_chance,
       true AS near_logistic FROM splits WHERE split = 'test'"""


@register("m5_logistic_regression", _linear_sql("logistic_regression"))
def m5_logistic_regression(spark, sf):
    return _linear_checks(spark, sf, "logistic_regression")


@register("m8_svm_rff", _linear_sql("svm"))
def m8_svm_rff(spark, sf):
    return _linear_checks(spark, sf, "svm")
