"""Stratified train/test split (M4) and stratified folds (M9).

Row order comes from a hash draw of (id, seed), never from ``rand()``, so the
result does not depend on partitioning or task retries. A quota becomes a cut, the
draw and id of the row at that rank of its class; rows are compared with their class's cuts
and are neither ranked nor moved. Rows without a label are a class of their own, the last.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import hash_draw
from ..session import materialize
from .ordered import running_sum


def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Share ``n_draws`` out over classes in proportion to ``counts``: floors first,
    then one more for the largest remainders (ties: higher class value first,
    null last)."""
    total = sum(counts.values())
    cont = {k: n_draws * v / total for k, v in counts.items()}
    fl = {k: int(math.floor(x)) for k, x in cont.items()}
    need = n_draws - sum(fl.values())
    order = sorted(counts, key=lambda k: (-(cont[k] - fl[k]), k is None, -k if isinstance(k, (int, float)) else 0))
    for k in order[:need]:
        fl[k] += 1
    return fl


def split_quotas(counts: dict, test_size: float) -> dict:
    """{class: (n_train, n_test)} with n_test = ceil(test_size * N) overall."""
    n = sum(counts.values())
    n_test = int(math.ceil(test_size * n))
    n_train = n - n_test
    tr = approximate_mode(counts, n_train)
    rest = {k: counts[k] - tr[k] for k in counts}
    te = approximate_mode(rest, n_test)
    return {k: (tr[k], te[k]) for k in counts}


def class_rank(df: DataFrame, label: str, id_col: str, seed: int, draw_col: str = "_draw") -> DataFrame:
    """Adds ``_rank``: 0-based position of the row inside its class (null is a class), by (draw, id)."""
    x = df.withColumn(draw_col, hash_draw(id_col, seed=seed)).withColumn("_one", F.lit(1).cast("bigint"))
    x = running_sum(x, [draw_col, id_col], ["_one"], [label])
    return x.withColumn("_rank", F.col("cum__one") - 1).drop("cum__one", "_one")


#: Classes whose quotas are numbers on the driver; those of more classes are worked out as a table, by the same rule.
MAX_CLASSES = 10_000


def _draws(df: DataFrame, label: str, id_col: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """(class, draw, id, stretch) of all rows, stored, and the rows by class and stretch of draws, 2^16 stretches in all."""
    rows = materialize(df.select(F.struct(F.col(f"`{label}`").alias("v")).alias("class"), hash_draw(id_col, seed=seed).cast("bigint").alias("draw"),
                                 F.col(f"`{id_col}`").alias("id")), "draws").withColumn("stretch", F.shiftright("draw", 16))
    return rows, rows.groupBy("class", "stretch").agg(F.count(F.lit(1)).alias("c"))


def _class_counts(counts: DataFrame) -> tuple[DataFrame, dict | None]:
    """(class, n) as a table, and as a dict if they are few."""
    table = counts.groupBy("class").agg(F.sum("c").alias("n"))
    rows = table.limit(MAX_CLASSES + 1).collect()
    return table, {r["class"]["v"]: int(r["n"]) for r in rows} if len(rows) <= MAX_CLASSES else None


def _quota_table(counts: DataFrame, draws: int) -> DataFrame:
    """``approximate_mode`` as a table: (class, n, got)."""
    total = counts.agg(F.sum("n")).first()[0]
    number = F.col("class.v").cast("double") if isinstance(counts.schema["class"].dataType["v"].dataType, T.NumericType) else F.lit(0.0)
    part = F.lit(draws) * F.col("n") / F.lit(total)
    x = materialize(counts.select("class", "n", F.floor(part).alias("got"), (F.floor(part) - part).alias("_rest"), F.col("class.v").isNull().alias("_null"),
                                  (-number).alias("_number"), F.lit(1).alias("_one")), "quotas")
    need = draws - x.agg(F.sum("got")).first()[0]
    ranked = running_sum(x, ["_rest", "_null", "_number", "class"], ["_one"])
    return ranked.select("class", "n", (F.col("got") + F.when(F.col("cum__one") <= need, 1).otherwise(0)).alias("got"))


def draw_cuts(rows: DataFrame, counts: DataFrame, ranks: DataFrame, few: bool) -> DataFrame:
    """``ranks`` (class, q, rank) to (class, q, draw, id): the row at that 0-based rank of its class by (draw, id); none beyond the last.

    Draws are even over 32 bits, so the counts by stretches find the stretch that holds a rank, and
    only its rows, one of 65,536, are put in order. Nothing else is ranked or moved. ``few``: there are at most MAX_CLASSES
    classes, so that their ranks may be broadcast."""
    small = F.broadcast if few else lambda x: x
    upto = Window.partitionBy("class").orderBy("stretch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("upto", F.sum("c").over(upto))
    at = counts.join(small(ranks), "class").where((F.col("rank") >= F.col("upto") - F.col("c")) & (F.col("rank") < F.col("upto")))
    at = at.select("class", "stretch", "q", (F.col("rank") - F.col("upto") + F.col("c") + 1).alias("nth"))
    order = Window.partitionBy("class", "stretch").orderBy("draw", "id")
    held = rows.join(small(at.select("class", "stretch").distinct()), ["class", "stretch"], "left_semi").withColumn("nth", F.row_number().over(order))
    return held.join(small(at), ["class", "stretch", "nth"]).select("class", "q", "draw", "id")


def _after(df: DataFrame, label: str, id_col: str, cuts: DataFrame, few: bool, seed: int, out: str) -> DataFrame:
    """Adds ``out``: how many of its class's cuts (the cut's own row counts) a row has reached."""
    kind = f"array<struct<q:int,draw:bigint,id:{df.schema[id_col].dataType.simpleString()}>>"
    wide = cuts.groupBy("class").agg(F.array_sort(F.collect_list(F.struct(F.col("q").cast("int").alias("q"), "draw", "id"))).cast(kind).alias("_cuts"))
    names = [c for c in df.columns if c != out]
    x = df.withColumn("_class", F.struct(F.col(f"`{label}`").alias("v"))).withColumn("_draw", hash_draw(id_col, seed=seed).cast("bigint"))
    wide = wide.withColumnRenamed("class", "_class")
    x = x.join(F.broadcast(wide) if few else wide, "_class", "left")
    mine = F.struct(F.col("_draw"), F.col(f"`{id_col}`").alias("id"))
    reached = F.coalesce(F.size(F.filter("_cuts", lambda c: F.struct(c["draw"], c["id"]) <= mine)), F.lit(0))
    return x.select(*[F.col(f"`{c}`") for c in names], reached.alias(out))


def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.2, seed: int = 42,
                     exact: bool = True) -> DataFrame:
    """M4: adds ``split`` in {'train','test'} with exact per-class quotas.

    The train rows of a class are the first by (draw, id); the first test row is its cut, and all
    rows are compared with it where they lie. ``exact=False`` cuts the draw at the test share
    (the shares are then only approximately met)."""
    if not exact:
        u = hash_draw(id_col, seed=seed) / F.lit(4294967296.0)
        return df.withColumn("split", F.when(u < test_size, "test").otherwise("train"))
    rows, counts = _draws(df, label, id_col, seed)
    table, known = _class_counts(counts)
    if known is None:
        n = table.agg(F.sum("n")).first()[0]
        first = _quota_table(table, n - math.ceil(test_size * n)).select("class", F.lit(0).alias("q"), F.col("got").alias("rank"))
    else:
        first = _ranks_frame(table, {c: [a] for c, (a, _) in split_quotas(known, test_size).items()})
    x = _after(df, label, id_col, draw_cuts(rows, counts, first, known is not None), known is not None, seed, "split")
    return x.withColumn("split", F.when(F.col("split") > 0, "test").otherwise("train"))


def _ranks_frame(table: DataFrame, ranks: dict) -> DataFrame:
    """(class, q, rank) of a list of ranks for each class."""
    kind = table.schema["class"].dataType
    schema = T.StructType([T.StructField("class", kind), T.StructField("q", T.IntegerType()), T.StructField("rank", T.LongType())])
    return table.sparkSession.createDataFrame([((c,), q, r) for c, rs in ranks.items() for q, r in enumerate(rs)], schema)


def _class_order(c) -> tuple:
    """Sorted order of class values, null last."""
    return (c is None, 0 if c is None else c)


def fold_allocation(counts: dict, k: int) -> dict:
    """Per class, how many rows each of the k folds gets: classes are laid out one
    after another in sorted order and position p goes to fold p mod k."""
    alloc, off = {}, 0
    for c in sorted(counts, key=_class_order):
        n = counts[c]
        a, b = off, off + n
        alloc[c] = [(-(-(b - i) // k)) - (-(-(a - i) // k)) for i in range(k)]
        off = b
    return alloc


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """M9: adds ``fold`` in 0..k-1; fold sizes per class differ by at most one.

    A class's rows, in order of (draw, id), are cut where its folds begin; rows are compared with the cuts where they lie."""
    rows, counts = _draws(df, label, id_col, seed)
    table, known = _class_counts(counts)
    if known is None:
        # positions of a class after those of the classes before it: fold i has the positions that leave i
        placed = running_sum(table.withColumn("_null", F.col("class.v").isNull()), ["_null", "class"], ["n"])
        size = lambda i: F.ceil((F.col("cum_n") - i) / k) - F.ceil((F.col("cum_n") - F.col("n") - i) / k)
        upto = [sum((size(j) for j in range(i)), F.lit(0)) for i in range(1, k)]
        first = placed.select("class", F.posexplode(F.array(*[u.cast("bigint") for u in upto])).alias("q", "rank")) if k > 1 else _ranks_frame(table, {})
    else:
        first = _ranks_frame(table, {c: list(accumulate(sizes))[:-1] for c, sizes in fold_allocation(known, k).items()})
    return _after(df, label, id_col, draw_cuts(rows, counts, first, known is not None), known is not None, seed, "fold")
