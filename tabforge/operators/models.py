"""Model training, comparison and prediction.

Every model is a Spark ML ``Pipeline`` (assembler + estimator), fitted on a
DataFrame, saved and loaded as a ``PipelineModel``. Cross-validation uses the
stratified fold column (M9); each fold fit is itself a distributed job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import RANDOM_STATE
from . import metrics as M
from .boosting import BoostedTrees, fit_boosted
from .features import fit_standard_scaler

# Model parameters (same settings as the reference's model configuration).
MODEL_PARAMS = {
    "logistic_regression": {"max_iter": 1000, "C": 1.0},
    "random_forest": {"n_estimators": 100, "max_depth": 10},
    "gbt": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6},
    "gbt_first_order": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6},
    "svm": {"C": 1.0, "components": 200},
}
DEFAULT_MODELS = ("random_forest", "gbt")


def _rff_stage(df: DataFrame, cols: Sequence[str], components: int, seed: int) -> SQLTransformer:
    """Random Fourier features for an RBF kernel (Rahimi & Recht 2007), gamma = 1/(d * var(X)).
    The projection is a fixed SQL expression, so it is saved with the pipeline."""
    import numpy as np
    cols = list(cols)
    r = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
               *[F.avg(F.col(c).cast("double") * F.col(c).cast("double")).alias(f"q{i}") for i, c in enumerate(cols)]).collect()[0]
    means = [r[f"m{i}"] or 0.0 for i in range(len(cols))]
    sq = [r[f"q{i}"] or 0.0 for i in range(len(cols))]
    mu = sum(means) / len(cols)
    var = sum(sq) / len(cols) - mu * mu
    gamma = 1.0 / (len(cols) * var) if var > 0 else 1.0
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), size=(components, len(cols)))
    b = rng.uniform(0.0, 2 * math.pi, size=components)
    scale = math.sqrt(2.0 / components)
    exprs = []
    for j in range(components):
        lin = " + ".join(f"({float(w[j, i])!r}) * CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
        exprs.append(f"{float(scale)!r} * cos({lin} + ({float(b[j])!r})) AS `_rff{j}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def _scale_stage(df: DataFrame, cols: Sequence[str]) -> SQLTransformer:
    """Columns ``_z_<c>`` with mean 0 and deviation 1 on the training rows, as a fixed SQL expression."""
    exprs = [f"(CAST(`{c}` AS DOUBLE) - ({m!r})) / ({s!r}) AS `_z_{c}`" for c, (m, s) in fit_standard_scaler(df, list(cols)).items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def build_pipeline(name: str, train: DataFrame, features: Sequence[str], label: str = "label",
                   seed: int = RANDOM_STATE, params: dict | None = None) -> Pipeline:
    p = dict(MODEL_PARAMS[name])
    p.update(params or {})
    feats = list(features)
    stages = []
    if name in ("svm", "logistic_regression"):  # linear models work on scaled columns
        scale = _scale_stage(train, feats)
        stages.append(scale)
        feats = [f"_z_{c}" for c in feats]
    if name == "svm":
        stages.append(_rff_stage(scale.transform(train), feats, p["components"], seed))
        feats = [f"_rff{j}" for j in range(p["components"])]
    if name == "gbt":  # reads plain columns, missing values included
        return Pipeline(stages=[BoostedTrees(feats, label, **p)])
    stages.append(VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep"))
    if name == "random_forest":
        # a level starts from the rows' cached nodes instead of walking all trees again; the trees are the same, and
        # their few levels need no checkpoint between them
        est = RandomForestClassifier(labelCol=label, numTrees=p["n_estimators"], maxDepth=p["max_depth"], seed=seed,
                                     cacheNodeIds=True, checkpointInterval=-1)
    elif name == "gbt_first_order":
        est = GBTClassifier(labelCol=label, maxIter=p["n_estimators"], stepSize=p["learning_rate"],
                            maxDepth=p["max_depth"], seed=seed)
    elif name == "svm":
        # hinge loss, then a logistic fit of the margin for the probabilities
        n = max(train.count(), 1)
        svc = LinearSVC(labelCol=label, maxIter=p.get("max_iter", 100), regParam=1.0 / (p["C"] * n), standardization=False,
                        rawPredictionCol="_margin", predictionCol="_side")
        est = LogisticRegression(labelCol=label, featuresCol="_margin", maxIter=100, regParam=1.0 / n, standardization=False)
        return Pipeline(stages=[*stages, svc, est])
    elif name == "logistic_regression":
        n = max(train.count(), 1)
        est = LogisticRegression(labelCol=label, maxIter=p.get("max_iter", 1000), regParam=1.0 / (p["C"] * n),
                                 elasticNetParam=0.0, standardization=False)
    else:
        raise ValueError(f"unknown model {name}")
    stages.append(est)
    return Pipeline(stages=stages)


def fit(name: str, train: DataFrame, features: Sequence[str], label: str = "label", seed: int = RANDOM_STATE,
        params: dict | None = None) -> PipelineModel:
    t = train.withColumn(label, F.col(label).cast("double"))
    return build_pipeline(name, t, features, label, seed, params).fit(t)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Adds prediction (int) and prob_1 (probability of class 1)."""
    out = model.transform(df)
    cols = list(keep) if keep is not None else [c for c in df.columns]
    p = vector_to_array("probability") if isinstance(out.schema["probability"].dataType, VectorUDT) else F.col("probability")
    return out.select(*cols, F.col("prediction").cast("int").alias("prediction"), p[1].alias("prob_1"))


def _fold_f1(name, df, features, label, fold_col, f, seed, model=None):
    """F1 on fold ``f`` of ``model``, or of one that is fitted here on the other folds."""
    te = df.where(F.col(fold_col) == f)
    m = model or fit(name, df.where(F.col(fold_col) != f), features, label, seed)
    r = M.binary_metrics(predict(m, te, keep=[label]), label=label, places=None).collect()[0]
    return float(r["f1"])


def train_all(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, models: Sequence[str] = DEFAULT_MODELS,
              fold_col: str | None = "fold", k: int = 5, seed: int = RANDOM_STATE, parallelism: int | None = None):
    """M11 + K3: cross-validate, fit, score train and test, diagnose; best = highest CV mean
    (strictly greater, first in order wins ties).

    All fits (k folds + the final fit, for every model) are submitted at once from driver
    threads, like ``CrossValidator(parallelism=...)``: each fit is a chain of small distributed
    jobs, and running them side by side hides the per-iteration scheduling latency.

    Returns (results DataFrame, fold scores DataFrame, best name, fitted models)."""
    from concurrent.futures import ThreadPoolExecutor
    spark = train.sparkSession
    train = train.persist()
    n_fits = len(models) * ((k if fold_col else 0) + 1)
    workers = max(1, min(parallelism or 12, n_fits))
    rows, fold_rows, fitted = [], [], {}
    best, best_score = None, -1.0
    with ThreadPoolExecutor(max_workers=workers) as ex:
        jobs = {}
        if "gbt" in models and fold_col:  # its fold models grow in the same jobs as the final one
            grown = ex.submit(fit_boosted, train, features, label, fold_col, k, **MODEL_PARAMS["gbt"])
        for name in models:
            if name == "gbt" and fold_col:
                continue
            jobs[name] = (ex.submit(fit, name, train, features, label, seed),
                          [ex.submit(_fold_f1, name, train, features, label, fold_col, f, seed) for f in range(k)]
                          if fold_col else [])
        for name in models:
            if name not in jobs:
                *by_fold, final = [PipelineModel(stages=[m]) for m in grown.result()]
                full = ex.submit(lambda m: m, final)
                cv_f = [ex.submit(_fold_f1, name, train, features, label, fold_col, f, seed, m) for f, m in enumerate(by_fold)]
            else:
                full, cv_f = jobs[name]
            cv = [x.result() for x in cv_f]
            m = full.result()
            cv_mean = round(sum(cv) / len(cv), 4) if cv else None
            cv_std = round(math.sqrt(sum((x - sum(cv) / len(cv)) ** 2 for x in cv) / len(cv)), 4) if cv else None
            fitted[name] = m
            tr = M.binary_metrics(predict(m, train, keep=[label]), label=label).collect()[0]
            te = M.binary_metrics(predict(m, test, keep=[label]), label=label).collect()[0]
            rows.append((name, cv_mean, cv_std, tr["accuracy"], tr["f1"], tr["precision"], tr["recall"],
                         te["accuracy"], te["f1"], te["precision"], te["recall"]))
            fold_rows += [(name, i, float(sc)) for i, sc in enumerate(cv)]
            score = cv_mean if cv_mean is not None else te["f1"]
            if score > best_score:
                best, best_score = name, score
    res = spark.createDataFrame(rows, "model string, cv_mean double, cv_std double, train_accuracy double, train_f1 double, "
                                      "train_precision double, train_recall double, test_accuracy double, test_f1 double, "
                                      "test_precision double, test_recall double")
    res = res.withColumn("diagnosis", M.diagnose(F.col("train_accuracy"), F.col("test_accuracy"))) \
             .withColumn("is_best", F.col("model") == F.lit(best))
    folds = spark.createDataFrame(fold_rows, "model string, fold int, score double")
    train.unpersist()
    return res, folds, best, fitted


def evaluate(model: PipelineModel, test: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy, precision, recall, f1, roc_auc and the confusion counts in one row."""
    pr = predict(model, test, keep=[label]).persist()
    m = M.binary_metrics(pr, label=label).first()
    auc = M.roc_auc(pr, label=label, score="prob_1").first()["roc_auc"]  # null when the test set has one class
    pr.unpersist()
    row = (m["accuracy"], m["precision"], m["recall"], m["f1"], m["tn"], m["fp"], m["fn"], m["tp"],
           None if auc is None else round(auc, 4), m["tn"] + m["fp"] + m["fn"] + m["tp"])
    return test.sparkSession.createDataFrame([row], "accuracy double, precision double, recall double, f1 double, tn bigint, fp bigint, "
                                                    "fn bigint, tp bigint, roc_auc double, test_samples bigint")


def save(model: PipelineModel, path: str) -> None:
    """Persist the fitted pipeline (works on any shared file system)."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
