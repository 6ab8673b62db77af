"""Drift from day summaries (ST2, D5): rows are read once, when they arrive, and never again.

A summary row of a numeric column is a KLL quantile sketch with the count, mean and variance of its values; of a category
column, the count of one level. Both merge: days, batches and runs are added up in any order, and a drift run reads
summaries alone, whatever the number of rows behind them.

Each set is read back as its k quantiles. A sketch of up to ``k`` values holds them all; beyond that a share is off by
at most ``rank_error(k)`` (with 99 % confidence). ``ks_error_bound`` bounds the KS statistic's error; counts, means,
deviations and category distances are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .drift import DISTANCE_THRESHOLD, js_of_counts

#: Size of the sketches: about 100 KB for a column and day at most.
K = 4096


def rank_error(k: int) -> float:
    """Error of a share read from a KLL sketch of size k (fixed constants of the sketch's published error formula)."""
    return 2.296 / k ** 0.9021


def ks_error_bound(n_ref: Column, n_cur: Column, k: int) -> Column:
    """Both sketches' errors, and half a step of each side's k shares."""
    one = lambda n: F.when(n <= k, F.lit(0.0)).otherwise(rank_error(k))
    return one(n_ref) + one(n_cur) + 1.0 / k


def summarize(df: DataFrame, by: Sequence[str], numeric: Sequence[str], categorical: Sequence[str] = (), k: int = K) -> DataFrame:
    """(by..., column, kind, level, n, mean, variance, sketch): a row for each numeric column, and for each level of a category.

    Nulls and NaN are left out; a column without values has no row. ``by`` may be a day, a batch, or nothing."""
    parts = []
    if numeric:
        value = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in numeric}
        aggs = [a for i, c in enumerate(numeric) for a in (
            F.count(value[c]).alias(f"_n{i}"), F.avg(value[c]).alias(f"_m{i}"), F.var_pop(value[c]).alias(f"_v{i}"),
            F.kll_sketch_agg_double(value[c], F.lit(k)).alias(f"_s{i}"))]
        rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit("numeric").alias("kind"), F.lit(None).cast("string").alias("level"),
                                  F.col(f"_n{i}").alias("n"), F.col(f"_m{i}").alias("mean"), F.col(f"_v{i}").alias("variance"),
                                  F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(numeric)])
        parts.append(df.groupBy(*by).agg(*aggs).select(*by, F.inline(rows)).where("n > 0"))
    if categorical:
        pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in categorical)
        long = df.selectExpr(*[f"`{c}`" for c in by], f"stack({len(categorical)}, {pairs}) as (`column`, `level`)").where("level is not null")
        parts.append(long.groupBy(*by, "column", "level").agg(F.count("*").alias("n")).select(
            *by, "column", F.lit("categorical").alias("kind"), "level", "n", F.lit(None).cast("double").alias("mean"),
            F.lit(None).cast("double").alias("variance"), F.lit(None).cast("binary").alias("sketch")))
    if not parts:
        raise ValueError("no columns to summarize")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _merged(s: DataFrame, side: str, k: int) -> DataFrame:
    """One row for each numeric column: count, population deviation and sketch of all its summaries."""
    s = s.where("kind = 'numeric'")
    total = s.groupBy("column").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mu"),
                                    F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    centre = total.select("column", "mu")  # a row for each column
    gap = F.col("mean") - F.col("mu")
    var = s.join(F.broadcast(centre), "column").groupBy("column").agg(
        (F.sum(F.col("n") * (F.col("variance") + gap * gap)) / F.sum("n")).alias("v"))
    return total.join(var, "column").select("column", F.col("n").alias(f"n_{side}"), F.sqrt("v").alias(f"{side}_std"),
                                            F.col("sketch").alias(f"s_{side}"))


def numeric_drift(reference: DataFrame, current: DataFrame, k: int = K) -> DataFrame:
    """(column, n_ref, n_cur, ks_stat, ks_error, wasserstein, ref_std, wasserstein_norm) of two tables of summaries. A column that
    only one side has values of gets null distances."""
    both = _merged(reference, "ref", k).join(_merged(current, "cur", k).drop("cur_std"), "column", "full")
    shares = F.lit((np.arange(k) + 0.5) / k)  # a literal, as the function asks for a constant
    point = lambda side, a, b: both.where("s_ref is not null and s_cur is not null").select(
        "column", F.explode(F.kll_sketch_get_quantile_double(f"s_{side}", shares)).alias("value"), F.lit(a).alias("a"), F.lit(b).alias("b"))
    points = point("ref", 1, 0).unionByName(point("cur", 0, 1)).groupBy("column", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    w = Window.partitionBy("column").orderBy("value")  # at most 2 k points
    gap = F.abs(F.sum(F.col("a") - F.col("b")).over(w.rowsBetween(Window.unboundedPreceding, 0))) / k
    found = points.select("column", gap.alias("gap"), (F.lead("value").over(w) - F.col("value")).alias("step")).groupBy("column").agg(
        F.max("gap").alias("ks_stat"), F.coalesce(F.sum(F.col("gap") * F.col("step")), F.lit(0.0)).alias("wasserstein"))
    out = both.drop("s_ref", "s_cur").join(found, "column", "left")
    n_ref, n_cur = (F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("n_ref", "n_cur"))
    return out.select("column", n_ref.alias("n_ref"), n_cur.alias("n_cur"), "ks_stat",
                      F.when(F.col("ks_stat").isNotNull(), ks_error_bound(n_ref, n_cur, k)).alias("ks_error"), "wasserstein", "ref_std",
                      (F.col("wasserstein") / F.when(F.col("ref_std") == 0, F.lit(1.0)).otherwise(F.col("ref_std"))).alias("wasserstein_norm"))


def category_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(column, js_distance, n_levels, chi2, n_ref, n_cur) of two tables of summaries; exact."""
    side = lambda s, a, b: s.where("kind = 'categorical'").select(
        "column", F.col("level").alias("value"), (F.col("n") * a).alias("a"), (F.col("n") * b).alias("b"))
    g = side(reference, 1, 0).unionByName(side(current, 0, 1)).groupBy("column", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return js_of_counts(g)


def drift_of_summaries(reference: DataFrame, current: DataFrame, k: int = K, threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """D3 by distances: (column, kind, method, statistic, n_ref, n_cur, threshold, drifted) of every column."""
    num = numeric_drift(reference, current, k).select("column", F.lit("numeric").alias("kind"), F.lit("wasserstein_norm").alias("method"),
                                                      F.col("wasserstein_norm").alias("statistic"), "n_ref", "n_cur")
    cat = category_drift(reference, current).select("column", F.lit("categorical").alias("kind"), F.lit("jensen_shannon").alias("method"),
                                                    F.col("js_distance").alias("statistic"), "n_ref", "n_cur")
    return num.unionByName(cat).withColumns({"threshold": F.lit(threshold),
                                             "drifted": F.coalesce(F.col("statistic") >= threshold, F.lit(False))})
