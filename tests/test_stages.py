"""L5 as separate jobs that hand over through the shared folder."""

import dataclasses

import pytest

from paths import SF001
from tabforge.operators import models as MO
from tabforge.plans import q_pipeline as QP
from tabforge.plans import stages as ST
from tabforge.session import scratch_path
from tabforge.sources import io as IO
from tabforge.sources import publish as PB

SPEC = dataclasses.replace(QP.DOC_TRAIN, models=("random_forest",), cv_folds=2)


def _no_input():
    raise AssertionError("the raw table is read again")


def test_another_job_runs_the_rest_alone(spark, monkeypatch):
    store, version = scratch_path(spark, "runs"), IO.input_version(spark, f"{SF001}/documents.parquet", f"{SF001}/labels.parquet")
    go = lambda s, raw, **kw: ST.run_stages(s, raw, SPEC, store, version, quality=QP.DOC_QUALITY, **kw)
    with pytest.raises(ValueError, match="needs the result of ingest"):
        go(spark, _no_input, want=["transform"])
    first, ran = go(spark, lambda: QP.doc_raw(spark, SF001), want=["ingest", "validate", "transform", "features"])
    assert ran == ["ingest", "validate", "transform", "features"] and first.validation.count() > 0

    other = spark.newSession()  # shares no temporary state with the first
    real = PB.publish
    monkeypatch.setattr(PB, "publish", lambda *a, **kw: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):  # dies after training, before the stage is done
        go(other, _no_input, want=["train"])
    monkeypatch.setattr(PB, "publish", real)
    second, ran = go(other, _no_input, want=["train"])
    assert ran == ["train"] and second.best == "random_forest"
    assert second.fs.selected == first.fs.selected and second.fs.scaler == first.fs.scaler
    third, ran = go(other, _no_input)
    assert ran == ["evaluate"]
    assert go(spark, _no_input)[1] == []
    # the loaded scoring model gives what the evaluation saw
    ev = third.evaluation.first()
    keep = [r[0] for r in third.fs.test.select("doc_id").collect()]
    again = MO.predict(third.scoring_model, QP.doc_raw(spark, SF001).where(QP.F.col("doc_id").isin(keep)), keep=["doc_id", "quality"])
    assert again.where("prediction = quality").count() == ev["tn"] + ev["tp"] and again.count() == ev["test_samples"]


def test_changed_input_or_settings_are_another_run():
    a = ST.run_key("1-aa", SPEC)
    assert a == ST.run_key("1-aa", dataclasses.replace(SPEC))
    assert len({a, ST.run_key("2-bb", SPEC), ST.run_key("1-aa", dataclasses.replace(SPEC, seed=7)), ST.run_key("1-aa", SPEC, QP.DOC_QUALITY)}) == 4
    with pytest.raises(ValueError, match="unknown stages"):
        ST.run_stages(None, _no_input, SPEC, "/x", "1", want=["trian"])
