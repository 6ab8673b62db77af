"""Scoring rules (the reference's four cases), batch vs stream, and an end-to-end run on sf0.001."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from paths import SF001
from tabforge.operators import clean as C
from tabforge.operators import models as MO
from tabforge.operators import score as SC
from tabforge.plans import pipelines as PL
from tabforge.plans import q_pipeline as QP
from tabforge.session import scratch_path
from tabforge.spec import PATIENT_SCORING, TrainSpec
from tabforge.streaming import scoring as STR

FIELDS = ["age", "race", "marital_status", "differentiate", "a_stage", "tumor_size", "estrogen_status",
          "progesterone_status", "regional_node_examined", "regional_node_positive"]
CASES = [
    # FIXED VALUES (the reference's four scoring records)
    ("1", "45", "WHITE", "married", "well", "regional", "30", "pos", "+", "12", "1"),
    ("2", "45", "Unknown", "Married", "Well differentiated", "Regional", "30", "Positive", "Positive", "12", "1"),
    ("3", "60", "Black", "Widowed", "Poorly differentiated", "Distant", "50", "Negative", "Negative", "5", "10"),
    ("4", "200", "White", "Single", "Moderately differentiated", "Regional", "20", "Positive", "Negative", "8", "2"),
    # own additions
    ("5", "45", "white", "single", "well", "regional", "30", "yes", "no", "7", "7"),
    ("6", "45d", "white", "single", "well", "regional", "30", "pos", "neg", "7", "1"),
    ("7", "1_000", "white", "single", "well", "regional", "30", "pos", "neg", "7", "1"),
    ("8", "\t45 ", "white", None, "well", "regional", "nan", "pos", "neg", "7", "1"),
]


def _checked(spark):
    df = spark.createDataFrame(CASES, "case string, " + ", ".join(f"{f} string" for f in FIELDS))
    x = SC.check(SC.normalize(df, PATIENT_SCORING), PATIENT_SCORING)
    return {r["case"]: r for r in x.collect()}


def test_reference_scoring_cases(spark):
    r = _checked(spark)
    assert r["1"]["errors"] == [] and r["1"]["race"] == "White" and r["1"]["differentiate"] == "Well differentiated"
    assert r["1"]["progesterone_status"] == "Positive"
    assert any(e.startswith("invalid:race:'Unknown' valid: [Black, Other, White]") for e in r["2"]["errors"])
    assert "cross:regional_node_positive>regional_node_examined" in r["3"]["errors"]
    assert r["4"]["errors"] == ["range:age"]
    accepted = [k for k in ("1", "2", "3", "4") if not r[k]["errors"]]
    assert accepted == ["1"]


def test_own_scoring_cases(spark):
    r = _checked(spark)
    assert r["5"]["errors"] == []                      # equality passes, yes/no aliases are strings
    assert "number:age" in r["6"]["errors"]            # '45d' is not a number
    assert r["7"]["errors"] == ["range:age"]           # '1_000' is the number 1000
    assert r["8"]["age"] == 45.0                       # tab-padded text is trimmed
    assert "number:tumor_size" in r["8"]["errors"] and "missing:marital_status" in r["8"]["errors"]


def test_split_rejected_partitions_all_rows(spark):
    df = spark.createDataFrame(CASES, "case string, " + ", ".join(f"{f} string" for f in FIELDS))
    x = SC.check(SC.normalize(df, PATIENT_SCORING), PATIENT_SCORING)
    ok, bad = C.split_rejected(x)
    assert ok.count() + bad.count() == len(CASES)


@pytest.fixture(scope="module")
def small_model(spark):
    spec = TrainSpec(**{**QP.DOC_TRAIN.__dict__, "models": ("random_forest",), "cv_folds": 3})
    t = PL.train_pipeline(QP.doc_raw(spark, SF001), spec)
    path = scratch_path(spark, "test-model")
    MO.save(t.scoring_model, path)
    return t, path


def test_end_to_end_training(spark, small_model):
    t, _ = small_model
    res = t.results.collect()
    assert len(res) == 1 and res[0]["is_best"] and 0 <= res[0]["test_accuracy"] <= 1
    ev = t.evaluation.first()
    assert ev["test_samples"] == ev["tn"] + ev["fp"] + ev["fn"] + ev["tp"] > 0
    assert t.folds.count() == 3


def test_stream_equals_batch(spark, small_model):
    t, path = small_model
    model = MO.load(path)
    src = QP.raw_scoring_input(spark, SF001)
    batch, rejected = SC.score(src, model, QP.DOC_SCORING, t.best)
    inbox = scratch_path(spark, "inbox")
    src.repartition(3).write.parquet(inbox)
    pred, quar = STR.run_scoring_stream(spark, inbox, src.schema, model, QP.DOC_SCORING, t.best,
                                        scratch_path(spark, "pred"), scratch_path(spark, "quar"))
    cols = ["doc_id", "prediction", "confidence", "high_prob", "low_prob", "high_confidence"]
    a = batch.select(*cols).toPandas().sort_values("doc_id").reset_index(drop=True)
    b = pred.select(*cols).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
    assert quar.count() == rejected.count()


def test_reload_gives_same_predictions(spark, small_model):
    t, path = small_model
    d = QP.doc_raw(spark, SF001)
    a = t.scoring_model.transform(d).select("doc_id", "prediction").orderBy("doc_id").collect()
    b = MO.load(path).transform(d).select("doc_id", "prediction").orderBy("doc_id").collect()
    assert a == b


def test_live_fallback_when_few_rows(spark):
    fb = spark.range(5)
    cur, src = STR.live_or_fallback(spark, scratch_path(spark, "absent"), fb)
    assert src == "test data"
    assert F is not None


def test_report_shapes(spark, small_model):
    import json
    from tabforge.sources import reports as RP
    t, _ = small_model
    comp = json.loads(RP.comparison_report(t.results).toJSON().first())["comparison"]
    assert set(comp) == {"random_forest"}
    assert set(comp["random_forest"]) == {"cv_mean", "cv_std", "train_metrics", "test_metrics", "diagnosis"}
    ev = json.loads(RP.evaluation_report(t.evaluation, t.best).toJSON().first())
    assert set(ev["confusion_matrix"]) == {"true_negative", "false_positive", "false_negative", "true_positive"}
    assert "f1_score" in ev["metrics"] and ev["test_samples"] > 0


def test_score_empty_and_all_rejected_input(spark, small_model):
    """No rows in gives no rows out; rows that all fail their checks all go to the quarantine."""
    t, path = small_model
    model = MO.load(path)
    src = QP.raw_scoring_input(spark, SF001)
    s0, r0 = SC.score(src.where(F.lit(False)), model, QP.DOC_SCORING, t.best)
    assert s0.count() == 0 and r0.count() == 0
    bad = src.withColumn("n_chars", F.lit("not a number"))
    s1, r1 = SC.score(bad, model, QP.DOC_SCORING, t.best)
    assert s1.count() == 0 and r1.count() == src.count()
    assert r1.where(~F.array_contains("errors", "number:n_chars")).count() == 0
