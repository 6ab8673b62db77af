"""Classification metrics (A22-A26) and the fit diagnosis.

All metrics are aggregates over (label, prediction[, score]) columns; the AUC
collapses rows by score first and uses the bucketed running count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import DIAGNOSIS_TEXTS, OVERFIT_GAP, UNDERFIT_LEVEL
from .ordered import running_sum


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None,
              positive=1) -> DataFrame:
    """Tn, fp, fn, tp (optionally per group)."""
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    aggs = [F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp")]
    d = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return d.groupBy(*(by or [])).agg(*aggs)


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None,
                   places: int | None = 4) -> DataFrame:
    """Accuracy, precision, recall, f1 for the positive class; 0 when undefined."""
    cm = confusion(df, label, prediction, by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    acc = _safe_div(tp + tn, tp + tn + fp + fn)
    r = (lambda c: F.round(c, places)) if places is not None else (lambda c: c)
    return cm.select(*(by or []), r(acc).alias("accuracy"), r(prec).alias("precision"), r(rec).alias("recall"),
                     r(f1).alias("f1"), "tn", "fp", "fn", "tp")


def _class_name(df: DataFrame, c: str) -> Column:
    """A class as text, the same for 1, 1.0 and '1'."""
    v = F.col(c)
    if isinstance(df.schema[c].dataType, T.StringType):
        return v
    number = v.cast("double")
    return F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(v.cast("string"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, f1, support, then 'macro avg' and 'weighted avg' rows."""
    d = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    pairs = d.groupBy(_class_name(d, label).alias("_lab"), _class_name(d, prediction).alias("_pre")).agg(F.count(F.lit(1)).alias("n"))
    lab, pre = F.col("_lab"), F.col("_pre")
    per_true = pairs.groupBy(lab.alias("cls")).agg(F.sum("n").alias("support"),
                                                   F.sum(F.when(lab == pre, F.col("n")).otherwise(0)).alias("hit"))
    per_pred = pairs.groupBy(pre.alias("cls")).agg(F.sum("n").alias("predicted"))
    per = per_true.join(per_pred, "cls", "full").select(
        "cls", F.coalesce("support", F.lit(0)).alias("support"), F.coalesce("hit", F.lit(0)).alias("hit"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"))
    p = _safe_div(F.col("hit"), F.col("predicted"))
    r = _safe_div(F.col("hit"), F.col("support"))
    f = F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))
    rows = per.select("cls", p.alias("precision"), r.alias("recall"), f.alias("f1"), F.col("support").cast("bigint"))
    avg = rows.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                   F.avg("f1").alias("f1"), F.sum("support").cast("bigint").alias("support"))
    wavg = rows.agg(F.lit("weighted avg").alias("cls"),
                    (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                    (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                    (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                    F.sum("support").cast("bigint").alias("support"))
    return rows.unionByName(avg).unionByName(wavg)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """Area under the ROC curve with ties counted half (Mann-Whitney form).

    Rows collapse to (score, positives, negatives); nb = negatives with a lower
    score, from a bucketed running sum; AUC = sum p*(nb + n/2) / (P*N)."""
    d = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    g = d.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == F.lit(positive)).alias("p"), F.count_if(F.col(label) != F.lit(positive)).alias("n"))
    c = running_sum(g, ["s"], ["n"])
    t = c.agg(F.sum(F.col("p") * ((F.col("cum_n") - F.col("n")) + F.col("n") / 2.0)).alias("num"),
              F.sum("p").alias("P"), F.sum("n").alias("N"))
    return t.select(F.when((F.col("P") == 0) | (F.col("N") == 0), F.lit(None).cast("double"))
                    .otherwise(F.col("num") / (F.col("P").cast("double") * F.col("N"))).alias("roc_auc"))


def cv_summary(scores: DataFrame, by: str = "model", score: str = "score") -> DataFrame:
    """Mean and population std of fold scores, rounded to 4."""
    return scores.groupBy(by).agg(F.round(F.avg(score), 4).alias("cv_mean"),
                                  F.round(F.stddev_pop(score), 4).alias("cv_std"))


def fit_verdict(train_acc: Column, test_acc: Column) -> Column:
    """M10 as data: struct (code, gap); code is a key of ``spec.DIAGNOSIS_TEXTS``. A missing accuracy has no code."""
    gap = train_acc - test_acc
    best = F.greatest(train_acc, test_acc)
    code = F.when(gap.isNull(), F.lit(None).cast("string")).when(gap > OVERFIT_GAP, "overfit").when(best < UNDERFIT_LEVEL, "underfit").otherwise("good")
    return F.struct(code.alias("code"), gap.alias("gap"))


def diagnose(train_acc: Column, test_acc: Column) -> Column:
    """The verdict's text."""
    verdict = fit_verdict(train_acc, test_acc)
    texts = F.create_map(*[F.lit(x) for pair in DIAGNOSIS_TEXTS.items() for x in pair])
    return F.replace(texts[verdict["code"]], F.lit("{gap}"), F.format_string("%.4f", verdict["gap"]))
