"""Feature scoring, selection and scaling.

Fitted state is a handful of numbers per feature; the feature pipeline (L4) writes it into a
Spark ML ``SQLTransformer``, which is saved with the model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_number


def anova_f(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """One-way ANOVA F statistic of each feature against the class column.

    One aggregate grouped by class gives (n, mean, population variance) per feature; Spark
    merges these with numerically stable updates. With the grand mean M = sum(n m) / N:
    between = sum n (m - M)^2, within = sum n v, F = (between/(k - 1)) / (within/(N - k)).
    This is the same F as the textbook sums-of-squares form, without its cancellation
    (sum Q - sum S^2/n) when the mean is large against the spread or N is in the billions.
    Returns (feature, f_score)."""
    from pyspark.sql import Window
    cols = list(cols)
    x = {c: F.col(c).cast("double") for c in cols}
    per = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        *[F.count(x[c]).alias(f"_n_{c}") for c in cols],
        *[F.avg(x[c]).alias(f"_m_{c}") for c in cols],
        *[F.var_pop(x[c]).alias(f"_v_{c}") for c in cols])
    every = Window.partitionBy()  # over the k class rows only
    per = per.select("*", *[F.try_divide(F.sum(F.col(f"_n_{c}") * F.col(f"_m_{c}")).over(every),
                                         F.sum(f"_n_{c}").over(every)).alias(f"_gm_{c}") for c in cols])
    aggs = []
    for c in cols:
        n, m, v, gm = F.col(f"_n_{c}").cast("double"), F.col(f"_m_{c}"), F.col(f"_v_{c}"), F.col(f"_gm_{c}")
        aggs += [F.sum(n).alias(f"_tn_{c}"), F.count_if(n > 0).cast("double").alias(f"_nk_{c}"),
                 F.sum(n * (m - gm) * (m - gm)).alias(f"_ssb_{c}"), F.sum(n * v).alias(f"_ssw_{c}")]
    tot = per.agg(*aggs)
    exprs = []
    for c in cols:
        N, k, b, w = (F.col(f"_{t}_{c}") for t in ("tn", "nk", "ssb", "ssw"))
        # constant features (no spread inside classes) and a single class give null, like NaN in the library
        f = F.try_divide(F.try_divide(b, k - 1), F.try_divide(w, N - k))
        exprs.append(f.alias(f"_f_{c}"))
    pairs = ", ".join(f"'{c}', `_f_{c}`" for c in cols)
    return tot.select(*exprs).selectExpr(f"stack({len(cols)}, {pairs}) as (feature, f_score)")


def rank_features(scores: DataFrame) -> DataFrame:
    """K2: features by descending score, with their rank (ties by name)."""
    from pyspark.sql import Window
    w = Window.orderBy(F.desc("f_score"), "feature")  # one row per feature: tiny
    return scores.select("feature", "f_score", F.row_number().over(w).alias("rank"))


def select_top_k(scores: DataFrame, k: int, order: Sequence[str]) -> list[str]:
    """K1: names of the k best features, returned in the original column order.
    NaN scores (constant features) rank last."""
    rows = scores.select("feature", F.nanvl("f_score", F.lit(float("-inf"))).alias("f")).collect()
    best = sorted(rows, key=lambda r: (-(r["f"] if r["f"] is not None else float("-inf")), order.index(r["feature"])))
    keep = {r["feature"] for r in best[:k]}
    return [c for c in order if c in keep]


def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """M2 fit: mean and *population* std per column in one pass (std 0 -> 1); NaN is skipped, as in the
    reference library's scaler."""
    r = df.agg(*[F.avg(as_number(c)).alias(f"m_{c}") for c in cols],
               *[F.stddev_pop(as_number(c)).alias(f"s_{c}") for c in cols]).collect()[0]
    out = {}
    for c in cols:
        if r[f"m_{c}"] is None:
            raise ValueError(f"cannot fit a scaler: column {c!r} has no values")
        s = r[f"s_{c}"]
        out[c] = (float(r[f"m_{c}"]), float(s) if s not in (None, 0.0) else 1.0)
    return out


def scaler_expr(c: str, mean: float, std: float):
    return (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """M2 apply: (x - mean) / std with the fitted numbers as literals."""
    out = df
    for c, (m, s) in params.items():
        out = out.withColumn(c, scaler_expr(c, m, s))
    return out
