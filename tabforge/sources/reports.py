"""Report shapes of the reference's JSON artifacts, built from our result tables.

Each builder returns a one-row DataFrame whose single column is the nested
struct/map; ``write_report(df, path)`` or ``df.toJSON()`` turns it into the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def comparison_report(results: DataFrame) -> DataFrame:
    """map<model, struct<cv_mean, cv_std, train_metrics, test_metrics, diagnosis>> (one row per run)."""
    def metrics(prefix: str):
        return F.struct(*[F.col(f"{prefix}_{m}").alias(m) for m in ("accuracy", "f1", "precision", "recall")])
    entry = F.struct("cv_mean", "cv_std", metrics("train").alias("train_metrics"), metrics("test").alias("test_metrics"),
                     "diagnosis")
    return results.agg(F.map_from_entries(F.collect_list(F.struct(F.col("model"), entry))).alias("comparison"))


def drift_status(summary: DataFrame) -> DataFrame:
    """{drift_detected, timestamp} from the drift summary row."""
    return summary.select(F.col("dataset_drift").alias("drift_detected"),
                          F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"))


def evaluation_report(evaluation: DataFrame, model_name: str) -> DataFrame:
    """{timestamp, model_name, metrics, confusion_matrix, test_samples} from ``models.evaluate``."""
    return evaluation.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.lit(model_name).alias("model_name"),
        F.create_map(*[x for m in ("accuracy", "precision", "recall", "f1", "roc_auc")
                       for x in (F.lit("f1_score" if m == "f1" else m), F.col(m).cast("double"))]).alias("metrics"),
        F.struct(F.col("tn").alias("true_negative"), F.col("fp").alias("false_positive"),
                 F.col("fn").alias("false_negative"), F.col("tp").alias("true_positive")).alias("confusion_matrix"),
        F.col("test_samples"))
