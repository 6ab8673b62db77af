"""Connected components by alternating large-star and small-star rounds.

Edges live in tables only. A round combines minima before each shuffle and
joins them back, so a node with many neighbours is a skewed join that Spark
splits, not one group in one task. Rounds are cut by tables in the shared
checkpoint folder, and the number of rounds grows with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that is the larger end of a path; root is the component's smallest node.

    Smallest nodes themselves do not appear. Self-links and nulls are dropped.
    """
    stars = materialize(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(),
        "components")
    seen = _signature(stars)
    while seen[0]:
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(stars.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        small = large.join(large.groupBy("hi").agg(F.min("lo").alias("m")), "hi")
        stars = materialize(
            small.select("hi", F.col("m").alias("lo")).unionAll(small.where("lo > m").select(F.col("lo"), F.col("m"))).distinct(),
            "components")
        now = _signature(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
