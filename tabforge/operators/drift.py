"""Distribution drift between a reference set and a current set.

Numeric columns: two-sample Kolmogorov-Smirnov statistic and the Wasserstein-1
distance normalised by the reference standard deviation. Categorical columns:
Jensen-Shannon distance (natural log), or a chi-square test of homogeneity, which
for two levels is the two-proportion z test. All statistics come from grouped counts per distinct
value (both sets in one scan); running shares use the bucketed running sum.
Only scalar results reach the driver, where the p-values are evaluated.

The method is named by the caller: "tests" (p < 0.05), "distances" (>= 0.1), or "library", the common
library rule: reference sets of at most 1000 rows use the tests, larger ones the distances.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import DRIFT_SHARE
from ..session import materialize
from .ordered import running_sum

SMALL_SET = 1000
DISTANCE_THRESHOLD = 0.1
P_THRESHOLD = 0.05
#: Steps of the exact KS distribution: the size of both sets multiplied.
EXACT_CELLS = 1_000_000


def _tagged(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    ref = reference.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    cur = current.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    return ref.unionByName(cur)


def value_counts_by_set(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, a, b), staged: how often each set has each value. Both sets are scanned once."""
    t = _tagged(reference, current, cols)
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
    lng = t.selectExpr(f"stack({len(cols)}, {pairs}) as (`column`, `value`)", "_a", "_b")
    lng = lng.where(F.col("value").isNotNull() & ~F.isnan("value"))
    g = lng.groupBy("column", "value").agg(F.sum("_a").cast("bigint").alias("a"), F.sum("_b").cast("bigint").alias("b"))
    return materialize(g, "drift-counts")


def numeric_cdf_table(g: DataFrame) -> DataFrame:
    """(column, value, a, b, Fa, Fb, next_value, na, nb): per distinct value, counts in each set,
    running shares and the next distinct value."""
    tot = g.groupBy("column").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    c = running_sum(g, ["value"], ["a", "b"], ["column"], with_next=True)
    c = c.join(F.broadcast(tot), "column")  # one row per column
    # an empty side has no distribution: its shares are null (try_divide), not an ANSI error
    return c.select("column", "value", "a", "b", F.try_divide(F.col("cum_a"), F.col("na")).alias("Fa"),
                    F.try_divide(F.col("cum_b"), F.col("nb")).alias("Fb"), F.col("next_value"), "na", "nb")


def ks_asymptotic_p(d: float, n: int, m: int) -> float | None:
    """Two-sided p-value of the two-sample KS statistic (asymptotic Kolmogorov series
    with the usual small-sample correction of the argument)."""
    if d is None or not n or not m:
        return None
    en = math.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s = sum(2 * (-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    return min(max(s, 0.0), 1.0)


def ks_exact_p(d: float, n: int, m: int) -> float:
    """Two-sided p-value of the two-sample KS statistic for continuous values, exactly.

    Without drift every order of the n + m values is equally likely, so the p-value is the share of the
    lattice paths from (0, 0) to (n, m) that somewhere leave the band in which the shares i/n and j/m differ by less than d."""
    band = round(d * n * m)  # the statistic is a whole number of 1 / (n m)
    if band <= 0:
        return 1.0
    inside = [0] * (m + 1)
    inside[0] = 1
    for i in range(n + 1):
        run = 0
        for j in range(m + 1):
            run = run + inside[j] if abs(i * m - j * n) < band else 0
            inside[j] = run
    return 1.0 - Fraction(inside[m], math.comb(n + m, n)).__float__()


def ks_p(d: float | None, n: int, m: int) -> float | None:
    """The exact p-value while n m is at most EXACT_CELLS, the asymptotic one beyond, where the two agree to three digits."""
    if d is None or not n or not m:
        return None
    return ks_exact_p(d, n, m) if n * m <= EXACT_CELLS else ks_asymptotic_p(d, n, m)


def numeric_drift_stats(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, ks_stat, wasserstein, ref_std, wasserstein_norm, n_ref, n_cur)."""
    g = value_counts_by_set(reference, current, cols)
    c = numeric_cdf_table(g)
    w = F.when(F.col("next_value").isNotNull(), F.abs(F.col("Fa") - F.col("Fb")) * (F.col("next_value") - F.col("value")))
    st = c.groupBy("column").agg(F.max(F.abs(F.col("Fa") - F.col("Fb"))).alias("ks_stat"),
                                 F.coalesce(F.sum(w), F.lit(0.0)).alias("wasserstein"),
                                 F.first("na").alias("n_ref"), F.first("nb").alias("n_cur"))
    # population std of the reference set from the collapsed counts, centred first; no ranges needed
    mean = g.groupBy("column").agg(F.try_divide(F.sum(F.col("a") * F.col("value")), F.sum("a")).alias("_mean"))
    sd = g.join(F.broadcast(mean), "column").groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(F.col("a") * (F.col("value") - F.col("_mean")) * (F.col("value") - F.col("_mean"))),
                            F.sum("a"))).alias("ref_std"))
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)  # otherwise the distance is undefined (null)
    st = st.withColumn("wasserstein", F.when(both, F.col("wasserstein")))
    return st.join(sd, "column").select(
        "column", "ks_stat", "wasserstein", "ref_std",
        (F.col("wasserstein") / F.when(F.col("ref_std") == 0, F.lit(1.0)).otherwise(F.col("ref_std"))).alias("wasserstein_norm"),
        F.col("n_ref").cast("bigint").alias("n_ref"), F.col("n_cur").cast("bigint").alias("n_cur"))


def category_shares(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, a, b, p, q): counts and shares per category in each set (full outer by value)."""
    t = _tagged(reference, current, cols)
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    lng = t.selectExpr(f"stack({len(cols)}, {pairs}) as (`column`, `value`)", "_a", "_b").where(F.col("value").isNotNull())
    return _shares(lng.groupBy("column", "value").agg(F.sum("_a").cast("bigint").alias("a"), F.sum("_b").cast("bigint").alias("b")))


def _shares(g: DataFrame) -> DataFrame:
    tot = g.groupBy("column").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    return g.join(F.broadcast(tot), "column").select(
        "column", "value", "a", "b", F.try_divide(F.col("a"), F.col("na")).alias("p"),
        F.try_divide(F.col("b"), F.col("nb")).alias("q"),
        "na", "nb")


def js_distance(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, js_distance, n_levels, chi2, n_ref, n_cur) with natural logs."""
    return _distances(category_shares(reference, current, cols))


def js_of_counts(counts: DataFrame) -> DataFrame:
    """D2 of counts (column, value, a, b) that are at hand: a of the reference, b of the current set."""
    return _distances(_shares(counts))


def _distances(s: DataFrame) -> DataFrame:
    mid = (F.col("p") + F.col("q")) / 2.0
    kl_p = F.when(F.col("p") > 0, F.col("p") * F.log(F.col("p") / mid)).otherwise(0.0)
    kl_q = F.when(F.col("q") > 0, F.col("q") * F.log(F.col("q") / mid)).otherwise(0.0)
    # chi-square of homogeneity: both sets against their pooled shares, so a level that only one set has counts
    pooled = F.try_divide(F.col("a") + F.col("b"), F.col("na") + F.col("nb"))
    gap = lambda n, total: F.try_divide((F.col(n) - pooled * F.col(total)) * (F.col(n) - pooled * F.col(total)), pooled * F.col(total))
    chi = gap("a", "na") + gap("b", "nb")
    return s.groupBy("column").agg(
        F.when((F.first("na") > 0) & (F.first("nb") > 0),  # an empty side leaves the distance undefined
               F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(kl_p) + 0.5 * F.sum(kl_q)))).alias("js_distance"),
        F.count(F.lit(1)).alias("n_levels"), F.sum(chi).alias("chi2"),
        F.first("na").cast("bigint").alias("n_ref"), F.first("nb").cast("bigint").alias("n_cur"))


def two_proportion_p(chi2: float | None) -> float | None:
    """Two-sided p-value of the pooled two-proportion z test; z squared is the chi-square of the two levels."""
    return None if chi2 is None else math.erfc(math.sqrt(max(chi2, 0.0) / 2))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised incomplete gamma)."""
    if x is None or dof <= 0:
        return None
    if x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    if z < a + 1:  # series for the lower part
        term = total = 1.0 / a
        ap = a
        for _ in range(1000):
            ap += 1
            term *= z / ap
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - math.lgamma(a)))
    b = z + 1 - a  # continued fraction for the upper part
    c, d = 1.0 / 1e-300, 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return min(1.0, math.exp(-z + a * math.log(z) - math.lgamma(a)) * h)


def drift_report(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 method: str, share_threshold: float = DRIFT_SHARE) -> tuple[DataFrame, DataFrame]:
    """Per-column results and the dataset verdict. ``method``: "tests", "distances" or "library".

    Returns (columns: column, kind, method, statistic, threshold, drifted;
             summary: n_columns, n_drifted, share, dataset_drift, decision)."""
    if method not in ("tests", "distances", "library"):
        raise ValueError(f"unknown drift method {method!r}")
    spark = reference.sparkSession
    rows = []
    if numeric:
        for r in numeric_drift_stats(reference, current, numeric).collect():
            small = r["n_ref"] <= SMALL_SET
            if method == "tests" or (method == "library" and small):
                p = ks_p(r["ks_stat"], r["n_ref"], r["n_cur"])
                rows.append((r["column"], "numeric", "ks_p_value", p, P_THRESHOLD, p is not None and p < P_THRESHOLD))
            else:
                v = r["wasserstein_norm"]
                rows.append((r["column"], "numeric", "wasserstein_norm", v, DISTANCE_THRESHOLD,
                             v is not None and v >= DISTANCE_THRESHOLD))
    if categorical:
        for r in js_distance(reference, current, categorical).collect():
            small = r["n_ref"] <= SMALL_SET
            if method == "tests" or (method == "library" and small):
                two = r["n_levels"] == 2
                p = two_proportion_p(r["chi2"]) if two else chi2_sf(r["chi2"], r["n_levels"] - 1)
                rows.append((r["column"], "categorical", "z_p_value" if two else "chi2_p_value", p, P_THRESHOLD, p is not None and p < P_THRESHOLD))
            else:
                v = r["js_distance"]
                rows.append((r["column"], "categorical", "jensen_shannon", v, DISTANCE_THRESHOLD,
                             v is not None and v >= DISTANCE_THRESHOLD))
    cols = spark.createDataFrame(rows, "column string, kind string, method string, statistic double, "
                                       "threshold double, drifted boolean")
    summary = cols.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted")).select(
        "n_columns", "n_drifted", F.try_divide(F.col("n_drifted"), F.col("n_columns")).alias("share"))
    summary = summary.select("*", (F.col("share") >= share_threshold).alias("dataset_drift"),
                             F.when(F.col("share") >= share_threshold, "retrain").otherwise("skip").alias("decision"))
    return cols, summary


def split_by_time(df: DataFrame, ts: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Reference = rows before ``cut``, current = rows from ``cut`` on."""
    c = F.lit(cut).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) < c), df.where(F.col(ts) >= c)

