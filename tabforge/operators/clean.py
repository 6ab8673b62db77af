"""Projections, filters, lookups and record checks (P1-P11, J1-J3, U2-U3, A4 via quality).

Record checks never raise per row: each check appends a message to an
``errors`` array column, and the caller splits good rows from rejected ones
(P11) in the same pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lookup_key, parse_number
from .ordered import to_number
from .quality import collect_fences

# maps with more entries than this are joined (broadcast, size-checked) instead of inlined
MAX_INLINE_MAP = 64
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20  # estimated size of a broadcast side (values plus row overhead)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Force a name list onto the columns by position; widths must agree."""
    if len(names) != len(df.columns):
        raise ValueError(f"Length mismatch: table has {len(df.columns)} columns, {len(names)} names given")
    return df.toDF(*names)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; an absent name is an error (Spark alone would ignore it)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{missing} not found in columns")
    return df.drop(*cols)


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project to the named features in the given order; raise when any is missing."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"Missing features: {missing}")
    return df.select(*keep, *features)


def assemble(df: DataFrame, features: Sequence[str], label: str | None = None, out: str = "features",
             keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector and label on the same row (never aligned by position)."""
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")
    cols = list(keep) + [out] + ([F.col(label).cast("double").alias("label")] if label else [])
    return va.transform(df).select(*cols)


def remove_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, mode: str = "sequential",
                    method: str = "exact") -> DataFrame:
    """Keep rows inside the IQR fences, bounds inclusive; null values are removed.

    ``sequential`` (reference behaviour): the fence of column j is computed on
    rows that survived columns before j, so one small aggregate per column.
    ``independent``: all fences from all rows in one aggregate.
    """
    if mode == "independent":
        fences = collect_fences(df, cols, k, method)
        cond = F.lit(True)
        for c in cols:
            lo, hi = fences[c]
            cond = cond & to_number(df, c).between(F.lit(lo).cast("double"), F.lit(hi).cast("double"))
        return df.where(cond)
    # The fence of column j depends only on the fenced columns of surviving rows, so the k passes
    # run on a staged narrow copy of those columns; the source is then filtered once.
    from ..session import materialize
    narrow = materialize(df.select(*[to_number(df, c).alias(c) for c in cols]), "fence-columns")
    cond, fences = F.lit(True), {}
    for c in cols:
        lo, hi = collect_fences(narrow.where(cond), [c], k, method, staged=True)[c]
        cond = cond & F.col(c).between(F.lit(lo).cast("double"), F.lit(hi).cast("double"))
        fences[c] = (lo, hi)
    cond = F.lit(True)
    for c, (lo, hi) in fences.items():
        cond = cond & to_number(df, c).between(F.lit(lo).cast("double"), F.lit(hi).cast("double"))
    return df.where(cond)


# --- record checks ----------------------------------------------------------

def add_errors(df: DataFrame, checks: Sequence[tuple[Column, Column]], errors: str = "errors") -> DataFrame:
    """Append the message of every failed check to the ``errors`` array, in check order.

    The previous array is referenced once, so chaining many checks keeps the
    expression linear in their number."""
    prev = F.col(errors) if errors in df.columns else F.array().cast("array<string>")
    if not checks:
        return df.withColumn(errors, prev)
    new = F.filter(F.array(*[F.when(cond, msg) for cond, msg in checks]), lambda x: x.isNotNull())
    return df.withColumn(errors, F.concat(prev, new))


def required_check(df: DataFrame, fields: Sequence[str], errors: str = "errors") -> DataFrame:
    """All required columns exist and hold a value."""
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"Missing required fields: {missing}")
    return add_errors(df, [(F.col(f).isNull(), F.lit(f"missing:{f}")) for f in fields], errors)


def range_check(df: DataFrame, ranges: Mapping[str, tuple[float, float]], errors: str = "errors") -> DataFrame:
    """Inclusive allowed range per numeric field (null values are left to P9)."""
    return add_errors(df, [(F.col(f).isNotNull() & ~F.col(f).between(lo, hi), F.lit(f"range:{f}"))
                           for f, (lo, hi) in ranges.items()], errors)


def cross_field_check(df: DataFrame, pairs: Sequence[tuple[str, str]], errors: str = "errors") -> DataFrame:
    """``a <= b`` for each pair; equality passes."""
    return add_errors(df, [(F.coalesce(F.col(a) > F.col(b), F.lit(False)), F.lit(f"cross:{a}>{b}")) for a, b in pairs],
                      errors)


def split_rejected(df: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with their error list)."""
    ok = df.where(F.size(errors) == 0).drop(errors)
    bad = df.where(F.size(errors) > 0)
    return ok, bad


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42, draw: Column | None = None) -> DataFrame:
    """P10: repeatable sample of n rows - the n smallest hash draws (a distributed top-n)."""
    d = draw if draw is not None else F.xxhash64(F.col(key), F.lit(seed))
    return df.withColumn("_d", d).orderBy("_d", key).limit(n).drop("_d")


# --- lookups (joins) ----------------------------------------------------------

def map_lookup(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None,
               errors: str | None = "errors") -> DataFrame:
    """Alias -> canonical value on ``lower(strip(value))``; an unknown key adds an
    error naming the sorted valid values. Small maps are inlined as a map literal;
    larger ones are broadcast when their rows and bytes are within the limits, and joined
    by a shuffle otherwise."""
    out = out or col
    valid = ", ".join(sorted(set(mapping.values())))
    key = lookup_key(col)
    if len(mapping) <= MAX_INLINE_MAP:
        m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        res = df.withColumn("_canon", m[key])
    else:
        size = sum(len(str(k).encode()) + len(str(v).encode()) + 32 for k, v in mapping.items())
        dim = df.sparkSession.createDataFrame(list(mapping.items()), "_key string, _canon string")
        if len(mapping) <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES:
            dim = F.broadcast(dim)
        res = df.withColumn("_key", key).join(dim, "_key", "left").drop("_key")
    if errors:
        msg = F.concat(F.lit(f"invalid:{col}:'"), F.coalesce(F.col(col).cast("string"), F.lit("None")),
                       F.lit(f"' valid: [{valid}]"))
        res = add_errors(res, [(F.col("_canon").isNull(), msg)], errors)
    return res.withColumn(out, F.col("_canon")).drop("_canon")


def outside_domain(df: DataFrame, col: str, domain: DataFrame, domain_col: str | None = None) -> DataFrame:
    """Rows whose value is not in the domain (anti join). The domain is broadcast
    only when its distinct rows and their bytes (one job measures both) are within the
    limits; otherwise a shuffle anti join."""
    domain_col = domain_col or col
    d = domain.select(F.col(domain_col).alias(col)).distinct()
    st = d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(col).cast("string"))).alias("b")).first()
    n, size = st["n"], (st["b"] or 0) + 16 * st["n"]
    right = F.broadcast(d) if n <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES else d
    return df.join(right, col, "left_anti")


def parse_numbers(df: DataFrame, fields: Sequence[str], errors: str = "errors") -> DataFrame:
    """F3 over several fields: text -> double, unparsable text -> error entry."""
    out = df
    for f in fields:
        out = out.withColumn(f"_num_{f}", parse_number(F.col(f)))
    out = add_errors(out, [(F.col(f).isNotNull() & F.col(f"_num_{f}").isNull(), F.lit(f"number:{f}")) for f in fields],
                     errors)
    for f in fields:
        out = out.withColumn(f, F.col(f"_num_{f}")).drop(f"_num_{f}")
    return out


def side_by_side(reference: DataFrame, current: DataFrame, tag: str = "dataset") -> DataFrame:
    """Both sets in one table with a tag column."""
    return reference.withColumn(tag, F.lit("reference")).unionByName(current.withColumn(tag, F.lit("current")))
