"""L5 as separate jobs: each stage stores its result, and another process goes on from there.

A run is named by a digest of its input's version and its specs, so changed input or settings start a new run and the same ones
find what is done. A stage's tables and models are written aside; publishing one row that names them makes the stage done.
A job that dies half way leaves the stage undone, and of two jobs that run one stage the later result stays.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession

from ..sources import publish as PB
from ..spec import QualitySpec, TrainSpec
from .pipelines import STAGES, FeatureSet, Prepared, Trained, train_pipeline


def run_key(version: str, spec: TrainSpec, quality: QualitySpec | None = None) -> str:
    """The run's name; ``version`` is that of the input (``io.input_version``)."""
    parts = [version, dataclasses.asdict(spec), dataclasses.asdict(quality) if quality else None]
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:24]


def _parts(t: Trained, stage: str) -> tuple[dict, dict, dict]:
    """(tables, models, values) of a stage's result."""
    if stage == "ingest":
        return {"table": t.table}, {}, {}
    if stage == "validate":
        return {"validation": t.validation}, {}, {}
    if stage == "transform":
        return {"table": t.prep.table, "levels": t.prep.levels}, {"prep_stage": t.prep.prep_stage}, {"features": t.prep.features, "info": t.prep.info}
    if stage == "features":
        fs = t.fs
        return {"train": fs.train, "test": fs.test, "scores": fs.scores}, {"scale_stage": fs.scale_stage}, {"selected": fs.selected, "scaler": fs.scaler}
    if stage == "train":
        return {"results": t.results, "folds": t.folds}, {"fitted": t.fitted, "scoring_model": t.scoring_model}, {"best": t.best}
    return {"evaluation": t.evaluation, "class_report": t.class_report}, {}, {}


def save_stage(spark: SparkSession, home: str, stage: str, t: Trained) -> None:
    tables, models, values = _parts(t, stage)
    files = f"{home}/{stage}/files/{uuid.uuid4().hex}"
    for name, df in tables.items():
        if df is not None:
            df.write.parquet(f"{files}/{name}")
    for name, model in models.items():
        model.write().save(f"{files}/{name}")
    state = {"files": files, "tables": [n for n, df in tables.items() if df is not None], "values": values}
    PB.publish(spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1), f"{home}/{stage}", "result", mode="overwrite")


def load_stage(spark: SparkSession, home: str, stage: str, t: Trained) -> bool:
    """Puts a stage's stored result into ``t``; False if it is not done."""
    row = PB.read_published(spark, f"{home}/{stage}")
    if row is None:
        return False
    state = json.loads(row.first()["state"])
    table = lambda n: spark.read.parquet(f"{state['files']}/{n}") if n in state["tables"] else None
    model = lambda n, kind=PipelineModel: kind.load(f"{state['files']}/{n}")
    values = state["values"]
    if stage == "transform":
        t.prep = Prepared(table("table"), model("prep_stage"), table("levels"), values["features"], values["info"])
    elif stage == "features":
        t.fs = FeatureSet(table("train"), table("test"), values["selected"], table("scores"), model("scale_stage", SQLTransformer),
                          {c: tuple(v) for c, v in values["scaler"].items()})
    elif stage == "train":
        t.results, t.folds, t.best = table("results"), table("folds"), values["best"]
        t.fitted, t.scoring_model = model("fitted"), model("scoring_model")
    else:  # tables alone, by their names in Trained
        for n in {"ingest": ["table"], "validate": ["validation"], "evaluate": ["evaluation", "class_report"]}[stage]:
            setattr(t, n, table(n))
    return True


def run_stages(spark: SparkSession, raw: Callable[[], DataFrame], spec: TrainSpec, store: str, version: str, want: Sequence[str] = STAGES,
               quality: QualitySpec | None = None) -> tuple[Trained, list[str]]:
    """Runs those of the wanted stages that are not done, in order; returns the run's results so far and the stages that ran.

    ``raw`` is called only if ingest has to run. A stage whose predecessor is neither done nor wanted is an error."""
    if unknown := set(want) - set(STAGES):
        raise ValueError(f"unknown stages {sorted(unknown)}")
    home = f"{store.rstrip('/')}/{run_key(version, spec, quality)}"
    t, ran = Trained(), []
    for stage in STAGES:
        if load_stage(spark, home, stage, t) or stage not in want:
            continue
        if stage != "ingest" and t.table is None:
            raise ValueError(f"stage {stage} needs the result of ingest")
        only = {s: s == stage for s in STAGES}
        t = train_pipeline(raw() if stage == "ingest" else t.table, spec, only, quality, earlier=t)
        save_stage(spark, home, stage, t)
        load_stage(spark, home, stage, t)  # later stages read the stored result, as another job would
        ran.append(stage)
    return t, ran
