"""Profiling (A14-A20, K4): the numbers behind the reference's exploratory charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import as_number, pearson
from .ordered import exact_quantiles, melt, numeric_copy


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max); sample std, exact quartiles."""
    df = numeric_copy(df, cols)
    lng = melt(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    mom = lng.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], names=["q25", "q50", "q75"], staged=True).drop("n")
    return mom.join(q, "column").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every ordered pair, one aggregate pass.
    The diagonal is 1.0 for a column with spread and null otherwise (NaN in pandas)."""
    cols = list(cols)
    aggs = []
    for a in cols:
        x = F.col(a).cast("double")
        aggs.append(F.when((F.count(x) > 1) & (F.stddev_pop(x) > 0), F.lit(1.0)).alias(f"{a}|{a}"))
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            aggs.append(pearson(F.col(a), F.col(b)).alias(f"{a}|{b}"))
    one = df.agg(*aggs)
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            x, y = (a, b) if i <= j else (b, a)
            rows.append(f"'{a}', '{b}', `{x}|{y}`")
    return one.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (col_a, col_b, corr)")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) two-way counts, nulls kept as their own level."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max]; the max value falls in the last bin; empty bins are listed.
    A constant column gets the range [v - 0.5, v + 0.5], as numpy's histogram does. NaN is missing."""
    df, x = numeric_copy(df, [col]), as_number(col)
    lohi = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).collect()[0]
    lo, hi = lohi["lo"], lohi["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, left double, right double, n bigint")
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.createDataFrame([(i, lo + i * width, lo + (i + 1) * width if i < bins - 1 else float(hi))
                                   for i in range(bins)], "bin int, left double, right double")
    return edges.join(counts, "bin", "left").select("bin", "left", "right", F.coalesce("n", F.lit(0)).alias("n"))


def density(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density on an evenly spaced grid over [min, max], Scott's bandwidth
    (n^-1/5 times the sample std). NaN is missing.

    Values are shared out linearly to bins of a thousandth of the bandwidth, which keeps their mean and moves the curve by about
    one part in 10^7; a bin is then added to the grid points within eight bandwidths of it, beyond which a
    kernel is under 10^-13. So the work after one narrow pass depends on bins and grid, not on distinct values."""
    df, x = numeric_copy(df, [col]), as_number(col)
    s = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi")).collect()[0]
    n, sd, lo, hi = s["n"], s["sd"], s["lo"], s["hi"]
    spark = df.sparkSession
    if not n or not sd:
        return spark.createDataFrame([], "point int, x double, density double")
    h = sd * n ** (-1.0 / 5)
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    width = h / 1000
    at = (x - F.lit(lo)) / F.lit(width)
    low = F.floor(at)
    shared = df.where(x.isNotNull()).select(low.alias("b"), (at - low).alias("up")).select(F.inline(F.array(
        F.struct(F.col("b").alias("b"), (1 - F.col("up")).alias("w")), F.struct((F.col("b") + 1).alias("b"), F.col("up").alias("w")))))
    bins = shared.groupBy("b").agg(F.sum("w").alias("w")).withColumn("v", F.col("b") * F.lit(width))  # from lo
    near = lambda f, d: f((F.col("v") + F.lit(d * 8 * h)) / F.lit(step))
    if step:
        first, last = F.greatest(near(F.ceil, -1), F.lit(0)), F.least(near(F.floor, 1), F.lit(points - 1))
        reach = F.when(first <= last, F.sequence(first, last))
    else:
        reach = F.array(F.lit(0).cast("bigint"))
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    z = (F.col("point") * F.lit(step) - F.col("v")) / F.lit(h)
    sums = bins.select("v", "w", F.explode(reach).alias("point")).groupBy("point").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s"))
    grid = spark.range(points).select(F.col("id").alias("point")).join(F.broadcast(sums), "point", "left")  # a row for each point
    return grid.select(F.col("point").cast("int").alias("point"), (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"),
                       (F.coalesce("s", F.lit(0.0)) * F.lit(norm)).alias("density"))


def box_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (furthest values inside the fences), number of fliers."""
    df = numeric_copy(df, cols)
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], names=["q1", "median", "q3"], staged=True)
    fences = {r["column"]: r for r in q.collect()}
    lng = melt(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    lo_e = F.lit(None).cast("double")
    hi_e = F.lit(None).cast("double")
    for c, r in fences.items():
        iqr = r["q3"] - r["q1"]
        lo_e = F.when(F.col("column") == c, F.lit(r["q1"] - k * iqr)).otherwise(lo_e)
        hi_e = F.when(F.col("column") == c, F.lit(r["q3"] + k * iqr)).otherwise(hi_e)
    inside = (F.col("value") >= lo_e) & (F.col("value") <= hi_e)
    w = lng.groupBy("column").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_fliers"))
    return q.join(w, "column").select("column", "q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers")


def top_n_per_group(df: DataFrame, group: str, order: Sequence[str], n: int, salt_buckets: int | None = None) -> DataFrame:
    """The first n rows per group in ``order``, in two stages so that a hot group is
    never sorted by one task: each (group, salt) keeps n, then each group keeps n of those.
    The salt count follows the shuffle parallelism, so a hot group's share per task shrinks
    as the cluster grows."""
    if salt_buckets is None:
        salt_buckets = max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(salt_buckets))
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    first = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n)
    w2 = Window.partitionBy(group).orderBy(*order)
    return first.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= n).drop("_salt", "_r")


def pair_sample(df: DataFrame, cols: Sequence[str], label: str, key: str, n_per_class: int = 200,
                seed: int = 42, draw=None) -> DataFrame:
    """Repeatable stratified sample (n per class) of the chosen columns for pair plots."""
    d = df.select(key, label, *cols, (draw if draw is not None else F.xxhash64(F.col(key), F.lit(seed))).alias("_d"))
    return top_n_per_group(d, label, ["_d", key], n_per_class).drop("_d")


def sorted_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K4: (column, levels) with the sorted distinct non-null values of each category column, as one list
    for each column. ``encode.level_rows`` gives the same as rows, for columns of any number of levels."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    lng = df.selectExpr(f"stack({len(cols)}, {pairs}) as (`column`, `value`)").where(F.col("value").isNotNull())
    return lng.select("column", "value").distinct().groupBy("column").agg(
        F.array_sort(F.collect_list("value")).alias("levels"))
