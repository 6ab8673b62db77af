"""Ordered analytics without a single-partition window.

A plain ``sum(..) over (order by v)`` with no partition moves every row to one
task, and one partitioned by a hot group moves that group to one. Here the rows
are dealt into ranges by (group, order) and staged; each range is summed on its own, and
the totals of the ranges a group runs over (a row for each group and range) give the
offsets. A hot group spans many ranges, many small groups share one. Nothing is
collected to the driver, and there is one path for every size.

Callers collapse duplicates first (``groupBy(value).count()``), which also
takes care of hot values: one value is one row after the collapse.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import parse_number
from ..session import materialize


def to_number(df: DataFrame, c: str):
    """The column as a double; text by the rule of F3, which does not take '45d' for a number."""
    col = F.col(f"`{c}`")
    return parse_number(col) if isinstance(df.schema[c].dataType, T.StringType) else col.try_cast("double")


def numeric_copy(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as numbers, staged: whatever they are derived from (measurements of whole texts, say) is computed once."""
    return materialize(df.select(*[to_number(df, c).alias(c) for c in dict.fromkeys(cols)]), "numbers")


def melt(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), name: str = "column",
         value: str = "value") -> DataFrame:
    """Wide -> long: one row per (row, column) with the value as a number (text by the rule of F3)."""
    if not cols:
        raise ValueError("melt needs at least one column")
    numbers = df.select(*[F.col(f"`{k}`") for k in keep], *[to_number(df, c).alias(f"_m{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', `_m{i}`" for i, c in enumerate(cols))
    return numbers.selectExpr(*[f"`{k}`" for k in keep], f"stack({len(cols)}, {pairs}) as (`{name}`, `{value}`)")


def running_sum(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                partition_cols: Sequence[str] = (), buckets: int | None = None,
                prefix: str = "cum_", with_next: bool = False) -> DataFrame:
    """Add ``cum_<c>``: inclusive running sum of each ``c`` ordered by ``order_cols``
    within ``partition_cols`` (nulls first in both; a null group is a group).
    ``order_cols`` must be unique within a partition. ``buckets`` is the number of ranges
    (default: the shuffle partitions, coalesced by size).

    ``with_next`` also adds ``next_<lead>``: the next value of the first order
    column in the same partition (null for the last row)."""
    pc, oc = list(partition_cols), list(order_cols)
    lead = oc[0]
    keys = [F.col(f"`{c}`") for c in pc + oc]
    ranged = df.repartitionByRange(buckets, *keys) if buckets else df.repartitionByRange(*keys)
    x = materialize(ranged.withColumn("_rng", F.spark_partition_id()), "ranges")
    group = [F.col(f"`{c}`") for c in pc]
    totals = x.groupBy(*group, "_rng").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols], F.min(F.struct(lead)).alias("_first"))
    over = Window.partitionBy(*group).orderBy("_rng")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.struct(c).alias(f"_g_{i}") for i, c in enumerate(pc)], F.col("_rng").alias("_g"),
                           *[F.sum(f"_t_{c}").over(earlier).alias(f"_o_{c}") for c in sum_cols],
                           F.lead("_first").over(over)[lead].alias("_nf"))
    inner = Window.partitionBy(*group, "_rng").orderBy(*oc)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.select("*", *[F.sum(c).over(upto).alias(f"_i_{c}") for c in sum_cols], F.lead(lead).over(inner).alias("_in"),
                 *[F.struct(c).alias(f"_k_{i}") for i, c in enumerate(pc)])
    same = F.col("_rng") == F.col("_g")
    for i in range(len(pc)):  # structs of a null are equal, plain nulls are not
        same = same & (F.col(f"_k_{i}") == F.col(f"_g_{i}"))
    x = x.join(totals, same)
    nxt = [F.coalesce("_in", "_nf").alias(f"next_{lead}")] if with_next else []
    return x.select(*[F.col(f"`{c}`") for c in df.columns],
                    *[(F.coalesce(F.col(f"_o_{c}"), F.lit(0)) + F.col(f"_i_{c}")).alias(prefix + c) for c in sum_cols], *nxt)


def value_counts_long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value, n): distinct non-null, non-NaN values per column with counts.
    Map-side partial aggregation collapses hot values before the shuffle."""
    long = melt(df, cols, keep=by)
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def _grouped_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Quantiles in each of any number of groups: value counts -> running counts by range -> pick ranks."""
    # the collapsed value counts are read three times below: stage them once in the shared folder
    vc = materialize(value_counts_long(df, cols, by), "value-counts")
    grp = list(by) + ["column"]
    cum = running_sum(vc, ["value"], ["n"], grp)
    tot = vc.groupBy(*grp).agg(F.sum("n").alias("_N"))
    x = cum.join(tot, grp)  # groups are few: planner broadcasts the small side
    aggs = []
    for p, nm in zip(probs, names):
        pos = F.lit(float(p)) * (F.col("_N") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        inside = lambda k: (F.col("cum_n") - F.col("n") <= k) & (k < F.col("cum_n"))
        aggs += [F.min(F.when(inside(lo), F.col("value"))).alias(f"_lo_{nm}"),
                 F.min(F.when(inside(hi), F.col("value"))).alias(f"_hi_{nm}"),
                 F.first(pos - lo, ignorenulls=True).alias(f"_f_{nm}")]
    r = x.groupBy(*grp).agg(F.first("_N").alias("n"), *aggs)
    return r.select(*grp, "n", *[
        (F.col(f"_lo_{nm}") + (F.col(f"_hi_{nm}") - F.col(f"_lo_{nm}")) * F.col(f"_f_{nm}")).alias(nm)
        for nm in names])


#: Bins of one round of selection, and values an interval may hold when it is sorted as it is.
BINS, LEAVES = 4096, 100_000
_MOST = 1.7976931348623157e308


class _Interval:
    """Where the value of a rank lies: between ``lo`` and ``hi``, with ``inside`` values, after ``before`` smaller ones."""

    def __init__(self, lo: float, hi: float, inside: int, before: int):
        self.lo, self.hi, self.inside, self.before = lo, hi, inside, before
        self.key = (lo, hi)

    def share(self, v):
        lo, hi = max(self.lo, -_MOST), min(self.hi, _MOST)
        if hi - lo <= _MOST:
            return (v - F.lit(lo)) / F.lit(hi - lo)
        return (v / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)

    def bin(self, v, bins: int):
        at = F.floor(F.least(F.greatest(self.share(v) * bins, F.lit(0.0)), F.lit(bins - 1.0)))
        return F.when(v < -_MOST, -1).when(v > _MOST, bins).otherwise(at)


def select_ranks(df: DataFrame, ranks: dict[str, Sequence[int]], spans: dict[str, tuple], bins: int = BINS,
                 leaves: int = LEAVES) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks of number columns, exactly, without a shuffle of the values.

    ``spans``: least and greatest value and number of values of each column (no null, no NaN). Each rank has an
    interval that holds its value, at first from the least value to the greatest. A round counts the values of all open intervals
    by bins, combined map-side to a few rows, and goes on with the bin that holds the rank, from its least value to its
    greatest: an interval gets smaller by the number of bins, or becomes one value, however often that repeats.
    Intervals of at most ``leaves`` values are sorted as they are. The driver holds an interval for each rank.
    """
    at = {(c, r): _Interval(*spans[c], 0) for c, rs in ranks.items() for r in rs}

    def rows_of(todo: dict) -> tuple[list, DataFrame]:
        own = sorted({(c, i.key): i for (c, _), i in todo.items()}.items(), key=lambda x: x[0])
        v = lambda c: F.col(f"`{c}`")
        each = [F.when(v(c).between(F.lit(lo), F.lit(hi)) & ~F.isnan(v(c)), F.struct(
            F.lit(n).alias("n"), v(c).alias("value"), i.bin(v(c), bins).alias("bin"))) for n, ((c, (lo, hi)), i) in enumerate(own)]
        return own, df.select(F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x")).select("x.*")

    while todo := {k: i for k, i in at.items() if i.inside > leaves and i.lo < i.hi}:
        own, rows = rows_of(todo)
        found: dict[tuple, list] = {}
        for r in sorted(rows.groupBy("n", "bin").agg(F.count(F.lit(1)).alias("c"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()):
            found.setdefault(own[r["n"]][0], []).append(r)
        for (c, rank), i in todo.items():
            before = i.before
            for r in found[c, i.key]:
                if rank < before + r["c"]:
                    at[c, rank] = _Interval(r["lo"], r["hi"], r["c"], before)
                    break
                before += r["c"]
    out = {k: i.lo for k, i in at.items() if i.lo == i.hi}
    if todo := {k: i for k, i in at.items() if i.lo < i.hi}:
        own, rows = rows_of(todo)
        places = {n: sorted({r - i.before for (c, r), i in todo.items() if (c, i.key) == key}) for n, (key, _) in enumerate(own)}
        pick = F.create_map(*[x for n, ps in places.items() for x in (F.lit(n), F.array(*[F.lit(p) for p in ps]))])
        rows = rows.groupBy("n").agg(F.array_sort(F.collect_list("value")).alias("all"))
        got = {r["n"]: dict(zip(places[r["n"]], r["v"])) for r in rows.select(
            "n", F.transform(pick[F.col("n")], lambda p: F.get("all", p)).alias("v")).collect()}
        number = {key: n for n, (key, _) in enumerate(own)}
        out |= {(c, r): got[number[c, i.key]][r - i.before] for (c, r), i in todo.items()}
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, staged: bool = False, bins: int = BINS, leaves: int = LEAVES) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas default, DuckDB ``quantile_cont``)
    per column, by selection: the values at the two ranks around each quantile. ``staged``: the columns are
    numbers in a narrow stored copy already. A column without values has no row. With ``by``, groups may be
    many: their quantiles come from running counts in tables.

    Returns (by..., column, n, <name_i>...)."""
    names = list(names or [f"q{int(round(p * 1000)):03d}" for p in probs])
    if by:
        return _grouped_quantiles(df, cols, probs, by, names)
    cols = list(dict.fromkeys(cols))
    if not staged:
        df = numeric_copy(df, cols)
    kept = [F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in cols]
    one = df.agg(*[f(x).alias(f"{m}{i}") for i, x in enumerate(kept) for m, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    spans = {c: (one[f"lo{i}"], one[f"hi{i}"], one[f"n{i}"]) for i, c in enumerate(cols) if one[f"n{i}"]}
    places = {c: [(float(p) * (n - 1)) for p in probs] for c, (_, _, n) in spans.items()}
    got = select_ranks(df, {c: sorted({int(r(x)) for x in ps for r in (math.floor, math.ceil)}) for c, ps in places.items()}, spans, bins, leaves)
    rows = []
    for c, ps in places.items():
        ends = [(got[c, math.floor(x)], got[c, math.ceil(x)], x - math.floor(x)) for x in ps]
        rows.append((c, spans[c][2], *[lo if lo == hi else lo + (hi - lo) * f for lo, hi, f in ends]))
    return df.sparkSession.createDataFrame(rows, "column string, n bigint, " + ", ".join(f"`{n}` double" for n in names))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 100000,
                     names: Sequence[str] | None = None) -> DataFrame:
    """Bounded-memory option for very high-cardinality columns (rank error ~ n/accuracy)."""
    names = list(names or [f"q{int(round(p * 1000)):03d}" for p in probs])
    long = melt(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    q = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"),
                                   F.percentile_approx("value", list(probs), accuracy).alias("_q"))
    return q.select("column", "n", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])
