"""Data-quality checks (A1-A13) and the validation suite (L2).

Each check is generic in its column names. Checks that read the same table are
merged into one aggregate per pass; fences are a handful of numbers and travel
to the executors as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import parse_number, pearson
from ..spec import QualitySpec
from ..session import materialize
from .ordered import approx_quantiles, exact_quantiles, numeric_copy, to_number

MAX_BROADCAST_BYTES = 64 << 20  # estimated size of a broadcast side

_FLOATS = (T.DoubleType, T.FloatType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, _NUMERIC)


def columns_by_kind(df: DataFrame) -> tuple[list[str], list[str]]:
    """P5: (numeric columns, string columns) in schema order."""
    num = [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return num, txt


def _missing(df: DataFrame, c: str) -> Column:
    """Null, and NaN for float columns (pandas counts both as missing)."""
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, _FLOATS):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _long(one_row: DataFrame, cols: Sequence[str], value_name: str, prefix: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{prefix}{c}`" for c in cols)
    return one_row.selectExpr(f"stack({len(cols)}, {pairs}) as (`column`, `{value_name}`)")


def shape(df: DataFrame) -> DataFrame:
    """A1: total_rows, total_columns."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.lit(len(df.columns)).cast("bigint").alias("total_columns"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: (column, null_count) for every column in one pass."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(_missing(df, c)).alias(f"_n_{c}") for c in cols])
    return _long(one, cols, "null_count", "_n_")


def _dedup_key(df: DataFrame, cols: Sequence[str], digest_strings: bool) -> list[Column]:
    """Grouping key for whole-row comparisons. Long strings are replaced by their
    SHA-256 digest so the shuffle moves 32 bytes instead of whole texts."""
    out = []
    for c in cols:
        if digest_strings and isinstance(df.schema[c].dataType, T.StringType):
            out.append(F.sha2(F.col(f"`{c}`"), 256).alias(c))
        else:
            out.append(F.col(f"`{c}`").alias(c))
    return out


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None, digest_strings: bool = True) -> DataFrame:
    """A3: rows identical to an earlier row (pandas ``duplicated().sum()``); passed when 0."""
    cols = list(cols or df.columns)
    g = df.select(*_dedup_key(df, cols, digest_strings)).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_count")).select(
        "duplicate_count", (F.col("duplicate_count") == 0).alias("passed"))


def drop_duplicates(df: DataFrame, cols: Sequence[str] | None = None, digest_strings: bool = True) -> DataFrame:
    """A4: keep one row of each group of identical rows.

    Rows in a group are identical, so which one is kept does not matter. A narrow
    pass over the keys (digests of string columns) finds those that repeat. While these
    fit a measured broadcast, all other rows pass through where they lie and only the
    repeated ones are shuffled; beyond it every row is."""
    cols = list(cols or df.columns)
    keyed = df.withColumn("_k", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(_dedup_key(df, cols, digest_strings))]))
    again = materialize(keyed.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_k"), "repeated-keys")
    if again.count() * (80 * len(cols) + 24) > MAX_BROADCAST_BYTES:
        return keyed.dropDuplicates(["_k"]).drop("_k")
    single = keyed.join(F.broadcast(again), "_k", "left_anti")
    repeated = keyed.join(F.broadcast(again), "_k", "left_semi").dropDuplicates(["_k"])
    return single.unionByName(repeated).drop("_k")


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """A5: (value, n) with nulls excluded."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))


def imbalance(df: DataFrame, target: str, threshold: float = 0.20) -> DataFrame:
    """Minority share = smallest class count / all rows (nulls included)."""
    per = df.groupBy(target).agg(F.count(F.lit(1)).alias("_n"))
    r = per.agg(
        F.sum("_n").alias("total_rows"),
        F.min(F.when(F.col(target).isNotNull(), F.col("_n"))).alias("minority_count"),
        F.max(F.when(F.col(target).isNotNull(), F.col("_n"))).alias("majority_count"),
        F.count(F.when(F.col(target).isNotNull(), 1)).alias("n_classes"),
    )
    share = F.col("minority_count") / F.col("total_rows")
    return r.select(
        F.col("total_rows").cast("bigint").alias("total_rows"),
        F.col("n_classes").cast("bigint").alias("n_classes"),
        F.col("minority_count").cast("bigint").alias("minority_count"),
        F.col("majority_count").cast("bigint").alias("majority_count"),
        F.round(share * 100, 2).alias("minority_pct"),
        (share >= threshold).alias("passed"),
        (share < threshold).alias("rebalance_needed"),
    )


def class_share(df: DataFrame, target: str) -> DataFrame:
    """(class, n, pct) with pct of non-null rows, like ``value_counts(normalize=True)*100``."""
    per = value_counts(df, target)
    # the grouped result has one row per class, so an unpartitioned window is cheap here
    return per.select(target, "n", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("pct"))


def skewness(df: DataFrame, cols: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """Sample-corrected skewness (pandas ``skew``, DuckDB ``skewness``), one pass.

    Spark's ``skewness`` is the population form g1; G1 = g1*sqrt(n(n-1))/(n-2).
    n < 3 gives null; a constant column gives 0.0 like pandas."""
    aggs = []
    for c in cols:
        v = to_number(df, c)
        x = F.when(~F.isnan(v), v)
        aggs += [F.count(x).alias(f"_n_{c}"), F.skewness(x).alias(f"_g_{c}"), F.stddev_pop(x).alias(f"_s_{c}")]
    one = df.agg(*aggs)
    exprs = []
    for c in cols:
        n = F.col(f"_n_{c}").try_cast("double")
        g = F.when(n < 3, F.lit(None)).when(F.col(f"_s_{c}") == 0, F.lit(0.0)).otherwise(
            F.col(f"_g_{c}") * F.sqrt(n * (n - 1)) / (n - 2))
        exprs.append(g.alias(f"_k_{c}"))
    lng = _long(one.select(*exprs), cols, "skewness", "_k_")
    return lng.select("column", "skewness", F.round("skewness", 2).alias("skewness_2dp"),
                      (F.abs(F.round("skewness", 2)) <= threshold).alias("passed"))


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "exact", staged: bool = False) -> DataFrame:
    """(column, q1, q3, iqr, lower, upper) with linear-interpolated quartiles."""
    if method == "exact":
        q = exact_quantiles(df, cols, [0.25, 0.75], names=["q1", "q3"], staged=staged)
    else:
        q = approx_quantiles(df, cols, [0.25, 0.75], names=["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.select("column", "q1", "q3", iqr.alias("iqr"), (F.col("q1") - k * iqr).alias("lower"),
                    (F.col("q3") + k * iqr).alias("upper"))


def collect_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "exact", staged: bool = False) -> dict[str, tuple]:
    """Fences as a small dict {column: (lower, upper)} - two numbers per column.
    A column without any value gets (None, None), like NaN quartiles in pandas: no value
    compares as an outlier, and a filter between the fences keeps no row."""
    got = {r["column"]: (r["lower"], r["upper"]) for r in iqr_fences(df, cols, k, method, staged).collect()}
    return {c: got.get(c, (None, None)) for c in cols}


def outlier_counts(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "exact",
                   fences: dict | None = None) -> DataFrame:
    """A10: outliers per column against fences computed independently over all rows.
    One extra pass over the staged numbers counts all columns at once."""
    df = numeric_copy(df, cols)
    fences = fences or collect_fences(df, cols, k, method)
    aggs = []
    for c in cols:
        lo, hi = fences[c]
        x = to_number(df, c)
        x = F.when(~F.isnan(x), x)
        lo_c, hi_c = F.lit(lo).cast("double"), F.lit(hi).cast("double")
        aggs.append(F.count_if((x < lo_c) | (x > hi_c)).alias(f"_o_{c}"))
    one = df.agg(*aggs)
    lng = _long(one, cols, "n_outliers", "_o_")
    num = lambda v: None if v is None else float(v)
    fdf = df.sparkSession.createDataFrame([(c, num(fences[c][0]), num(fences[c][1])) for c in cols],
                                          "column string, lower double, upper double")
    return lng.join(F.broadcast(fdf), "column").select(
        "column", F.col("n_outliers").cast("bigint").alias("n_outliers"), "lower", "upper",
        (F.col("n_outliers") == 0).alias("passed"))


def type_issues(df: DataFrame, numeric_cols: Sequence[str], categorical_cols: Sequence[str]) -> DataFrame:
    """Declared kind vs actual type, plus the count of non-null values that do
    not parse as a number (for numeric columns stored as text)."""
    aggs, rows = [], []
    for c in numeric_cols:
        dt = df.schema[c].dataType
        if is_numeric_type(dt):
            aggs.append(F.lit(0).cast("bigint").alias(f"_u_{c}"))
        else:
            s = F.col(c).cast("string")
            aggs.append(F.count_if(s.isNotNull() & parse_number(s).isNull()).alias(f"_u_{c}"))
        rows.append((c, "numeric", dt.simpleString(), is_numeric_type(dt)))
    for c in categorical_cols:
        dt = df.schema[c].dataType
        aggs.append(F.lit(0).cast("bigint").alias(f"_u_{c}"))
        rows.append((c, "categorical", dt.simpleString(), not is_numeric_type(dt)))
    cols = list(numeric_cols) + list(categorical_cols)
    one = df.agg(*aggs)
    lng = _long(one, cols, "unparsable", "_u_")
    meta = df.sparkSession.createDataFrame(rows, "column string, declared string, actual string, kind_ok boolean")
    return meta.join(F.broadcast(lng), "column").select(
        "column", "declared", "actual", "kind_ok", F.col("unparsable").cast("bigint").alias("unparsable"),
        (F.col("kind_ok") & (F.col("unparsable") == 0)).alias("passed"))


def schema_check(df: DataFrame, expected: Sequence[str]) -> dict:
    """Missing columns are an error, extra ones are reported."""
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected]
    return {"passed": not missing, "missing_cols": missing, "extra_cols": extra}


def leakage_check(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Presence of suspected leakage columns and their correlation with the target."""
    present = [c for c in cols if c in df.columns]
    aggs = [pearson(F.col(c).try_cast("double"), F.col(target).try_cast("double")).alias(f"_r_{c}") for c in present]
    spark = df.sparkSession
    if not present:
        return spark.createDataFrame([(c, False, None) for c in cols], "column string, present boolean, corr double")
    lng = _long(df.agg(*aggs), present, "corr", "_r_")
    meta = spark.createDataFrame([(c, c in present) for c in cols], "column string, present boolean")
    return meta.join(F.broadcast(lng), "column", "left").select("column", "present", "corr")


def validate(df: DataFrame, spec: QualitySpec, raise_on_schema: bool = True) -> DataFrame:
    """L2: eight checks in fixed order as one long report table
    (check, column, metric, value, passed). Only the schema check raises.

    The input is persisted once and read by four jobs: one wide aggregate for
    shape, nulls, skewness, types and leakage; one grouped pass for duplicates;
    one for class counts; the quantile machinery (plus one count pass) for
    outliers. Only the report rows (a few per column) reach the driver."""
    from pyspark import StorageLevel
    spark = df.sparkSession
    sc = schema_check(df, spec.expected_columns)
    if not sc["passed"] and raise_on_schema:
        raise ValueError(f"Schema validation failed: missing {sc['missing_cols']}")
    rows = [("1_schema", c, "missing", 1.0, False) for c in sc["missing_cols"]]
    rows += [("1_schema", c, "extra", 1.0, True) for c in sc["extra_cols"]]
    rows.append(("1_schema", None, "n_expected", float(len(spec.expected_columns)), sc["passed"]))

    x = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        num = [c for c in spec.numeric_cols if c in x.columns]
        cat = [c for c in spec.categorical_cols if c in x.columns]
        leak = [c for c in spec.leakage_cols if c in x.columns]
        aggs = [F.count(F.lit(1)).alias("_rows")]
        aggs += [F.count_if(_missing(x, c)).alias(f"_null_{c}") for c in x.columns]
        for c in num:
            v = to_number(x, c)
            v = F.when(~F.isnan(v), v)
            n, g, sd = F.count(v).cast("double"), F.skewness(v), F.stddev_pop(v)  # double: n*(n-1) overflows bigint
            # bias-corrected skewness, rounded by SQL (half-up) inside the same aggregate
            k = (F.when(n < 3, F.lit(None).cast("double")).when(sd == 0, F.lit(0.0))
                 .otherwise(F.round(g * F.sqrt(n * (n - 1)) / (n - 2), 2)))
            aggs.append(k.alias(f"_sk_{c}"))
            if not is_numeric_type(x.schema[c].dataType):
                t = F.col(c).cast("string")
                aggs.append(F.count_if(t.isNotNull() & parse_number(t).isNull()).alias(f"_u_{c}"))
        aggs += [pearson(F.col(c).try_cast("double"), F.col(spec.target).try_cast("double")).alias(f"_r_{c}") for c in leak]
        one = x.agg(*aggs).collect()[0]

        for c in x.columns:
            n = one[f"_null_{c}"]
            rows.append(("2_nulls", c, "null_count", float(n), n == 0))
        d = duplicate_count(x).collect()[0]
        rows.append(("3_duplicates", None, "duplicate_count", float(d["duplicate_count"]), bool(d["passed"])))
        im = imbalance(x, spec.target, spec.imbalance_threshold).collect()[0]
        rows.append(("4_imbalance", spec.target, "minority_pct", im["minority_pct"], bool(im["passed"])))
        for c in num:
            k2 = one[f"_sk_{c}"]
            rows.append(("5_skewness", c, "skewness", k2, k2 is not None and abs(k2) <= spec.skew_threshold))
        ocols = [c for c in spec.outlier_cols if c in x.columns]
        oc = outlier_counts(x, ocols, spec.iqr_multiplier, spec.quantile_method).collect() if ocols else []
        for r in sorted(oc, key=lambda r: spec.outlier_cols.index(r["column"])):
            rows.append(("6_outliers", r["column"], "n_outliers", float(r["n_outliers"]), bool(r["passed"])))
        for c in num:
            ok = is_numeric_type(x.schema[c].dataType)
            u = 0 if ok else one[f"_u_{c}"]
            rows.append(("7_datatypes", c, "unparsable", float(u), ok and u == 0))
        for c in cat:
            ok = not is_numeric_type(x.schema[c].dataType)
            rows.append(("7_datatypes", c, "unparsable", 0.0, ok))
        for c in spec.leakage_cols:
            rows.append(("8_leakage", c, "corr_with_target", one[f"_r_{c}"] if c in leak else None, True))
    finally:
        x.unpersist()
    return spark.createDataFrame(rows, "check string, column string, metric string, value double, passed boolean")
