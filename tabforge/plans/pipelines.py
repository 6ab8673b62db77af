"""Composed pipelines (L1-L7) as plain callables any scheduler can run.

Feature columns in model space are named ``f_<col>`` (encoded / log-scaled)
and ``s_<col>`` (standardised). The scoring model is one ``PipelineModel``:
raw -> f_ (SQL stage) -> s_ (SQL stage) -> assembler -> classifier, so batch
scoring, streaming and monitoring all use the same fitted object.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import strip_string_columns
from ..operators import clean as C
from ..operators import drift as D
from ..operators import encode as EN
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import models as MO
from ..operators import quality as Q
from ..operators import resample as R
from ..operators import score as SC
from ..operators import split as SP
from ..session import materialize
from ..spec import QualitySpec, ScoringSpec, TrainSpec


def ingest(df: DataFrame, names: list[str] | None = None, dedupe: bool = True) -> DataFrame:
    """L1: positional rename (P1), strip strings (F1), drop exact duplicates (A4)."""
    out = C.rename_positional(df, names) if names else df
    out = strip_string_columns(out)
    return Q.drop_duplicates(out) if dedupe else out


def validate(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """L2."""
    return Q.validate(df, spec)


@dataclass
class Prepared:
    table: DataFrame                    # id, label, f_<c>..., is_synthetic
    prep_stage: PipelineModel           # raw -> f_<c>
    levels: DataFrame | None            # category levels (column, value, code)
    features: list[str]                 # candidate feature names (raw names)
    info: dict = field(default_factory=dict)


def _prep_sql(spec: TrainSpec, integers: set[str]) -> str:
    exprs = []
    for c in spec.features:
        if c in spec.categorical:  # LevelEncoder has added it
            continue
        if c in spec.skewed_cols:
            e = f"CASE WHEN CAST(`{c}` AS DOUBLE) > -1 THEN log1p(CAST(`{c}` AS DOUBLE)) END"
        else:
            e = f"CAST(`{c}` AS BIGINT)" if c in integers else f"CAST(`{c}` AS DOUBLE)"
        exprs.append(f"{e} AS `f_{c}`")
    return f"SELECT {', '.join(['*', *exprs])} FROM __THIS__"


def transform(df: DataFrame, spec: TrainSpec, target_mapping: dict | None = None) -> Prepared:
    """L3: drop -> outliers (P6) -> log1p (F4) -> encode (F6) -> target (F5); rebalancing is
    applied here only in the reference order (``resample_after_split=False``)."""
    x = C.drop_columns(df, spec.drop_cols) if spec.drop_cols else df
    # stage boundary: derived inputs (e.g. measurements of whole texts) are computed once here;
    # every later pass of the transform reads this narrow copy
    keep = [spec.id_col, spec.target] + [c for c in spec.features if c not in (spec.id_col, spec.target)]
    x = materialize(x.select(*keep), "l3-input")
    if spec.outlier_cols:
        x = C.remove_outliers(x, spec.outlier_cols, mode=spec.outlier_mode, method=spec.quantile_method)
    if target_mapping:
        x = EN.encode_target(x, spec.target, target_mapping)
    x = x.where(F.col(spec.target).isNotNull())
    cats = [c for c in spec.features if c in spec.categorical]
    levels = materialize(EN.fit_label_encoder(x, cats), "l3-levels") if cats else None
    integers = {c for c in spec.features if isinstance(x.schema[c].dataType, T.IntegralType)}
    stage = PipelineModel(stages=[*([EN.LevelEncoder(cats, levels)] if cats else []), SQLTransformer(statement=_prep_sql(spec, integers))])
    t = stage.transform(x).select(F.col(spec.id_col), F.col(spec.target).cast("int").alias(spec.target),
                                  *[F.col(f"f_{c}") for c in spec.features])
    t = materialize(t, "l3-prepared")
    info = {}
    if spec.rebalance and not spec.resample_after_split:
        t = R.smote(t, spec.id_col, spec.target, [f"f_{c}" for c in spec.features], spec.smote_k, spec.seed)
        t = materialize(t, "l3-rebalanced")
    else:
        t = t.withColumn("is_synthetic", F.lit(False))
    return Prepared(t, stage, levels, list(spec.features), info)


#: Training rows that are worth a task of their own in each round of a fit.
ROWS_PER_TASK = 50_000


@dataclass
class FeatureSet:
    train: DataFrame
    test: DataFrame
    selected: list[str]
    scores: DataFrame
    scale_stage: SQLTransformer
    scaler: dict


def features(prep: Prepared, spec: TrainSpec) -> FeatureSet:
    """L4: ANOVA F top-k (A21, K1) -> stratified split (M4) -> rebalance train (recommended order)
    -> standard scaler fitted on train (M2) -> fold ids on train (M9)."""
    t = prep.table
    fcols = [f"f_{c}" for c in prep.features]
    if spec.resample_after_split:
        # the split is read by the scores, the rebalancing, the scaler and both outputs: staged once
        sp = materialize(SP.stratified_split(t, spec.target, spec.id_col, spec.test_size, spec.seed), "l4-split")
        train = sp.where(F.col("split") == "train").drop("split")
        test = sp.where(F.col("split") == "test").drop("split")
        scores = FE.anova_f(train, fcols, spec.target)
        selected_f = FE.select_top_k(scores, spec.top_k, fcols)
        if spec.rebalance:
            train = materialize(R.smote(train.drop("is_synthetic"), spec.id_col, spec.target, fcols, spec.smote_k, spec.seed),
                                "l4-rebalanced")
    else:
        scores = FE.anova_f(t, fcols, spec.target)
        selected_f = FE.select_top_k(scores, spec.top_k, fcols)
        sp = SP.stratified_split(t, spec.target, spec.id_col, spec.test_size, spec.seed)
        train = sp.where(F.col("split") == "train").drop("split")
        test = sp.where(F.col("split") == "test").drop("split")
    params = FE.fit_standard_scaler(train, selected_f)
    exprs = [f"(CAST(`{c}` AS DOUBLE) - ({m!r})) / ({s!r}) AS `s_{c[2:]}`" for c, (m, s) in params.items()]
    stage = SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")
    train = SP.stratified_folds(stage.transform(train), spec.target, spec.id_col, spec.cv_folds, spec.seed)
    # spread over the cluster, but not into tasks of a few rows: the fits read it hundreds of times
    parts = min(train.sparkSession.sparkContext.defaultParallelism, -(-t.count() // ROWS_PER_TASK))
    train = materialize(train.repartition(max(parts, 1), spec.id_col), "l4-train")
    test = materialize(stage.transform(test), "l4-test")
    return FeatureSet(train, test, [c[2:] for c in selected_f], scores, stage, params)


@dataclass
class Trained:
    """What the stages of L5 left; a stage that did not run, now or in the earlier run, leaves None."""

    table: DataFrame | None = None
    validation: DataFrame | None = None
    prep: Prepared | None = None
    fs: FeatureSet | None = None
    results: DataFrame | None = None
    folds: DataFrame | None = None
    best: str | None = None
    fitted: PipelineModel | None = None
    scoring_model: PipelineModel | None = None
    evaluation: DataFrame | None = None
    class_report: DataFrame | None = None


STAGES = ("ingest", "validate", "transform", "features", "train", "evaluate")


def train_pipeline(raw: DataFrame, spec: TrainSpec, stages: dict | None = None, quality: QualitySpec | None = None,
                   earlier: Trained | None = None) -> Trained:
    """Ingest -> validate -> transform -> features -> train & compare -> evaluate the best model.

    Each stage can be switched off with ``stages={'train': False}`` and so on. A later stage then works on what the
    ``earlier`` run left, and it is an error if that is missing. Validation needs a ``quality`` spec."""
    on = {s: True for s in STAGES} | (stages or {})
    if unknown := set(on) - set(STAGES):
        raise ValueError(f"unknown stages {sorted(unknown)}")
    t = Trained(**(earlier.__dict__ if earlier else {}))

    def need(value, stage: str):
        if value is None:
            raise ValueError(f"stage {stage} is off and no earlier run left its result")
        return value

    if on["ingest"]:
        t.table = ingest(raw)
    elif t.table is None:
        t.table = raw
    if on["validate"] and quality is not None:
        t.validation = validate(t.table, quality)
    if on["transform"]:
        t.prep = transform(t.table, spec)
    if on["features"]:
        t.fs = features(need(t.prep, "transform"), spec)
    if on["train"]:
        fs = need(t.fs, "features")
        t.results, t.folds, t.best, fitted = MO.train_all(
            fs.train, fs.test, [f"s_{c}" for c in fs.selected], spec.target, spec.models, "fold", spec.cv_folds, spec.seed)
        t.fitted = fitted[t.best]
        t.scoring_model = PipelineModel(stages=[need(t.prep, "transform").prep_stage, fs.scale_stage, *t.fitted.stages])
    if on["evaluate"]:
        model, test = need(t.fitted, "train"), need(t.fs, "features").test
        t.evaluation = MO.evaluate(model, test, spec.target).withColumn("model_name", F.lit(t.best))
        t.class_report = M.class_report(MO.predict(model, test, keep=[spec.target]), spec.target, "prediction")
    return t


def score_batch(df: DataFrame, model: PipelineModel, spec: ScoringSpec, model_name: str):
    """(scored, rejected)."""
    return SC.score(df, model, spec, model_name)


def monitor(reference: DataFrame, current: DataFrame, model: PipelineModel, numeric: list[str],
            categorical: list[str], method: str, target: str | None = None):
    """Predict both sets with the same model, then drift per column (features, target,
    prediction) and the dataset verdict. Quality per set is added where a true label exists."""
    cats = list(categorical) + ["prediction"] + ([target] if target else [])
    keep = list(numeric) + list(categorical) + ([target] if target else [])

    def predicted(df: DataFrame, name: str) -> DataFrame:  # the model runs once on each set
        out = model.transform(df).select(*keep, F.col("prediction").cast("int").cast("string").alias("prediction"))
        return materialize(out.withColumn(target, F.col(target).cast("string")) if target else out, f"monitor-{name}")

    ref, cur = predicted(reference, "reference"), predicted(current, "current")
    cols, summary = D.drift_report(ref, cur, numeric, cats, method)
    quality = None
    if target:
        both = ref.select(F.lit("reference").alias("dataset"), F.col(target).cast("int").alias("label"),
                          F.col("prediction").cast("int").alias("prediction")).unionByName(
            cur.select(F.lit("current").alias("dataset"), F.col(target).cast("int").alias("label"),
                       F.col("prediction").cast("int").alias("prediction")))
        quality = M.binary_metrics(both, by=["dataset"])
    return cols, summary, quality
