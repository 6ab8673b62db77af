"""Class rebalancing by synthetic interpolation.

Every class smaller than the largest is brought up to the largest count. For a
class with n rows that needs m new rows, rows are numbered 0..n-1 in hash-draw
order; synthetic row i (0 <= i < m) takes base row ``i mod n``, its
``1 + draw(base, i, 'n') mod k``-th nearest neighbour (exact, see ``knn``), and
``u = draw(base, i, 'u') / 2^32``: x = base + u * (neighbour - base).

All choices are hash draws of (row id, i, seed), so the output does not depend
on partitioning, retries or cluster size.

The m synthetic rows come from a distributed ``range(m)`` whose partition count
follows m, not from the base rows: a tiny class that needs billions of rows is
spread over many tasks instead of one task per base row. Base rows and
neighbour pairs are attached by joins (broadcast only below a checked
size; shuffled above it, where every base key carries about m / n rows).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import hash_draw
from .knn import knn_exact
from .split import class_rank

# the per-class base rows and neighbour pairs are broadcast up to this many bytes; above it, shuffle joins
BROADCAST_BYTES = 32 << 20
# synthetic rows per task of the generating range
ROWS_PER_TASK = 1_000_000


def smote(df: DataFrame, id_col: str, label: str, features: Sequence[str], k: int = 5, seed: int = 42,
          flag: str = "is_synthetic", checkpoint: bool = True) -> DataFrame:
    """U1 output: original rows (flag false) plus synthetic rows (flag true, negative ids). Integer features come
    back as integers (the interpolated value cut towards zero); a missing feature value is an error."""
    feats = list(features)
    base = df.select(F.col(id_col), F.col(label), *[F.col(c).cast("double").alias(c) for c in feats])
    if checkpoint:  # the source is read once; neighbours, ranks and interpolation read the staged copy
        from ..session import materialize
        base = materialize(base, "smote-input")
    spark = df.sparkSession
    gaps = base.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in feats]).first().asDict() if feats else {}
    if gaps := {c: n for c, n in gaps.items() if n}:
        raise ValueError(f"rebalancing needs a number in every feature; missing values: {gaps}")
    whole = [c for c in feats if isinstance(df.schema[c].dataType, T.IntegralType)]
    back = lambda x: x.withColumns({c: F.col(c).cast(df.schema[c].dataType) for c in whole}) if whole else x
    counts = {r[label]: int(r["count"]) for r in base.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if not counts:
        return back(base.withColumn(flag, F.lit(False)))
    n_major = max(counts.values())
    out = base.withColumn(flag, F.lit(False))
    id_offset = 0
    for cls in sorted(counts):
        n = counts[cls]
        m = n_major - n
        if m <= 0:
            continue
        if n < 2:
            raise ValueError(f"class {cls!r} has {n} row(s): at least 2 are needed to interpolate")
        kk = min(k, n - 1)
        pts = base.where(F.col(label) == F.lit(cls))
        nn = knn_exact(pts, id_col, feats, kk)
        ranked = class_rank(pts, label, id_col, seed, draw_col="_d").select(
            F.col("_rank").alias("_r"), F.col(id_col).alias("_base"), *[F.col(c).alias(f"b_{c}") for c in feats])
        # neighbour pairs with the neighbour's values: n * kk rows
        pairs = nn.select(F.col("id").alias("_base"), F.col("nbr_rank").alias("_nr"), F.col("nbr_id").alias("_nb")).join(
            pts.select(F.col(id_col).alias("_nb"), *[F.col(c).alias(f"n_{c}") for c in feats]), "_nb")
        width = 8 * (len(feats) + 4)  # bytes of a row
        if n * width <= BROADCAST_BYTES:
            ranked = F.broadcast(ranked)
        if n * kk * width <= BROADCAST_BYTES:
            pairs = F.broadcast(pairs)
        # synthetic row i takes base rank i mod n
        parts = max(spark.sparkContext.defaultParallelism, math.ceil(m / ROWS_PER_TASK))
        syn = spark.range(0, m, 1, parts).select(F.col("id").alias("_i"), (F.col("id") % F.lit(n)).alias("_r"))
        syn = syn.join(ranked, "_r")
        syn = syn.withColumn("_nr", (F.lit(1) + F.pmod(hash_draw("_base", "_i", F.lit("n"), seed=seed), F.lit(kk))).cast("int"))
        syn = syn.withColumn("_u", hash_draw("_base", "_i", F.lit("u"), seed=seed) / F.lit(4294967296.0))
        syn = syn.join(pairs, ["_base", "_nr"])
        syn = syn.select(
            (-(F.col("_i") + 1 + F.lit(id_offset))).cast(df.schema[id_col].dataType).alias(id_col),
            F.lit(cls).cast(df.schema[label].dataType).alias(label),
            *[(F.col(f"b_{c}") + F.col("_u") * (F.col(f"n_{c}") - F.col(f"b_{c}"))).alias(c) for c in feats],
            F.lit(True).alias(flag))
        out = out.unionByName(syn)
        id_offset += m
    return back(out)
