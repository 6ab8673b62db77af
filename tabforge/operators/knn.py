"""Exact k nearest neighbours inside one table (J4), without cross joins.

1. Identical vectors collapse to one point that keeps its k+1 smallest ids, so a
   hot group of copies never turns into pairs.
2. A tree of median cuts, on the widest dimension each time, is fitted on a
   bounded sample and deals the points to cells of about equal numbers; dense
   regions get small cells, sparse ones wide cells. The cells' true bounds come from one
   aggregate.
3. Each cell finds the neighbours within itself. The distance of the last one
   bounds the search: a point asks only those other cells whose box is not
   farther, once, and the answers are merged. Both steps cut their cell further, by the same
   rule, and skip every leaf that lies beyond the bound.

The result does not depend on the sample: cells decide the work, boxes and bounds the search.
Output: (id, nbr_rank 1..k, nbr_id, dist2). Ties are broken by neighbour id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .profile import top_n_per_group

#: Points that the cuts are fitted on; cells are at most a sixteenth of them.
SAMPLE = 65_536
#: Points that a cell should hold, and points of a leaf within it.
PER_CELL, LEAF = 4096, 128


def _cut(x: np.ndarray) -> tuple[int, float] | None:
    """Widest dimension and a value that leaves points on both sides (<= goes left); None if all points are equal."""
    spread = x.max(axis=0) - x.min(axis=0)
    dim = int(spread.argmax())
    if not spread[dim] > 0:
        return None
    v = np.sort(x[:, dim])
    at = v[(len(v) - 1) // 2]
    return dim, float(at if at < v[-1] else v[np.searchsorted(v, at) - 1])


def fit_cuts(x: np.ndarray, cells: int) -> tuple:
    """Nested (dimension, value, left, right); a leaf is ()."""
    cut = _cut(x) if cells > 1 and len(x) > 1 else None
    if cut is None:
        return ()
    left = x[:, cut[0]] <= cut[1]
    return (*cut, fit_cuts(x[left], cells // 2), fit_cuts(x[~left], cells - cells // 2))


def cell_of(tree: tuple, x: np.ndarray) -> np.ndarray:
    out, todo = np.zeros(len(x), np.int64), [(tree, 1, np.arange(len(x)))]
    while todo:
        node, name, at = todo.pop()
        if not node:
            out[at] = name
            continue
        left = x[at, node[0]] <= node[1]
        todo += [(node[2], 2 * name, at[left]), (node[3], 2 * name + 1, at[~left])]
    return out


def _leaves(x: np.ndarray) -> list[np.ndarray]:
    out, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        cut = _cut(x[at]) if len(at) > LEAF else None
        if cut is None:
            out.append(at)
        else:
            left = x[at, cut[0]] <= cut[1]
            todo += [at[left], at[~left]]
    return out


def _gap2(lo: np.ndarray, hi: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least squared distance of the box (lo, hi) to each box (low, high)."""
    return (np.maximum(np.maximum(low - hi, lo - high), 0.0) ** 2).sum(axis=-1)


def _dist2(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    d = np.zeros((len(q), len(x)))
    for j in range(x.shape[1]):  # dimension by dimension, in order: the same rounding everywhere
        d += (q[:, j, None] - x[None, :, j]) ** 2
    return d


#: Boxes a hair beyond a bound are searched too: their gaps are rounded.
SLACK = 1 + 1e-9


def search(q: np.ndarray, bound: np.ndarray, x: np.ndarray, owner: np.ndarray, ids: np.ndarray, n: int):
    """The first ``n`` entries by (squared distance, id) of each query, among those not beyond its ``bound``.

    Entry e belongs to point ``owner[e]`` (ascending) and has id ``ids[e]``. Returns (query, distance, id) arrays, by query."""
    leaves = _leaves(x)
    low, high = (np.array([f(x[at], axis=0) for at in leaves]) for f in (np.min, np.max))
    first = np.searchsorted(owner, np.arange(len(x) + 1))
    entries = [np.concatenate([np.arange(first[p], first[p + 1]) for p in at]) for at in leaves]
    row, dist, name = [], [], []
    for block in _leaves(q) if len(q) else []:
        y, r = q[block], bound[block].copy()
        best = np.full((len(block), n), np.inf)
        gaps = _gap2(y.min(axis=0), y.max(axis=0), low, high)
        for k in np.argsort(gaps, kind="stable"):
            if gaps[k] > r.max() * SLACK:
                break
            e = entries[k]
            at = leaves[k]
            d = _dist2(y, x[at])[:, np.repeat(np.arange(len(at)), first[at + 1] - first[at])]  # a column for each entry
            i, j = np.nonzero(d <= r[:, None])
            if not len(i):
                continue
            row.append(block[i])
            dist.append(d[i, j])
            name.append(ids[e[j]])
            both = np.concatenate([best, d], axis=1)
            best = np.partition(both, n - 1, axis=1)[:, :n]
            r = np.minimum(r, best.max(axis=1))
    if not row:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    row, dist, name = (np.concatenate(v) for v in (row, dist, name))
    order = np.lexsort((name, dist, row))
    row, dist, name = row[order], dist[order], name[order]
    start = np.searchsorted(row, row, "left")
    keep = np.arange(len(row)) - start < n
    return row[keep], dist[keep], name[keep]


def knn_exact(df: DataFrame, id_col: str, cols: Sequence[str], k: int = 5) -> DataFrame:
    """A missing coordinate is an error: it has no distance."""
    cols = list(cols)
    spark = df.sparkSession
    ship_package(spark)
    x = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in cols])  # -0.0 and 0.0 are one value
    pts = materialize(df.select(F.col(id_col).cast("bigint").alias("id"), x.alias("x")), "knn-points")
    n, gaps = pts.agg(F.count(F.lit(1)), F.count_if(F.exists("x", lambda v: v.isNull() | F.isnan(v)))).first()
    if gaps:
        raise ValueError(f"{gaps} rows have a missing coordinate")
    k = min(k, max(n - 1, 0))
    if k == 0:
        return spark.createDataFrame([], "id bigint, nbr_rank int, nbr_id bigint, dist2 double")
    few = top_n_per_group(pts, "x", ["id"], k + 1)  # salted: a hot vector's copies are not one task
    vecs = materialize(few.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids")), "knn-vectors")

    nv = vecs.count()
    cells = min(SAMPLE // 16, -(-nv // PER_CELL))
    # a cut of the hashes: about SAMPLE rows arrive in all, however many partitions there are
    share = min(1 << 30, SAMPLE * (1 << 30) // max(nv, 1))
    rows = sorted(vecs.where(F.pmod(F.xxhash64("x"), F.lit(1 << 30)) < share).select("x").collect()) if cells > 1 else []
    tree = fit_cuts(np.array([r["x"] for r in rows]), cells) if rows else ()

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cols))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(cell_of(tree, matrix(b.column(0)))), *b.columns], ["cell", "x", "ids"])

    dealt = materialize(vecs.mapInArrow(deal, "cell long, x array<double>, ids array<bigint>"), "knn-cells")
    span = [f(F.col("x")[j]).alias(f"{m}{j}") for m, f in (("lo", F.min), ("hi", F.max)) for j in range(len(cols))]
    boxes = sorted(dealt.groupBy("cell").agg(*span).collect())  # a row for each cell, at most SAMPLE // 16
    names = np.array([b["cell"] for b in boxes])
    low, high = (np.array([[b[f"{m}{j}"] for j in range(len(cols))] for b in boxes]) for m in ("lo", "hi"))

    def points(t: pa.Table):
        v = t.combine_chunks()
        own = v["ids"].combine_chunks() if isinstance(v["ids"], pa.ChunkedArray) else v["ids"]
        vec = v["x"].combine_chunks() if isinstance(v["x"], pa.ChunkedArray) else v["x"]
        counts = pa.compute.list_value_length(own).to_numpy(zero_copy_only=False)
        return matrix(vec), np.repeat(np.arange(len(own)), counts), own.flatten().to_numpy(zero_copy_only=False)

    def lists(row, dist, name, size: int):
        """Answers as one list for each query."""
        cut = np.searchsorted(row, np.arange(size + 1)).astype(np.int32)
        return (pa.ListArray.from_arrays(pa.array(cut), pa.array(dist, pa.float64())),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(name, pa.int64())))

    def own(t: pa.Table) -> pa.Table:
        p, owner, ids = points(t)
        row, dist, name = search(p, np.full(len(p), np.inf), p, owner, ids, k + 1)
        cut = np.searchsorted(row, np.arange(len(p) + 1))
        far = np.where(cut[1:] - cut[:-1] > k, dist[np.maximum(cut[1:] - 1, 0)], np.inf)
        here = names == t["cell"][0].as_py()
        ask = []
        for a in range(0, len(p), 1024):  # other cells that are not beyond a point's bound
            near = _gap2(p[a:a + 1024, None], p[a:a + 1024, None], low[None], high[None]) <= far[a:a + 1024, None] * SLACK
            near[:, here] = False
            ask += [names[m].tolist() for m in near]
        d, i = lists(row, dist, name, len(p))
        return pa.table({"x": t["x"], "far": pa.array(far), "d": d, "i": i, "ask": pa.array(ask, pa.list_(pa.int64()))})

    first = materialize(dealt.groupBy("cell").applyInArrow(own, "x array<double>, far double, d array<double>, i array<bigint>, ask array<bigint>"),
                        "knn-own")

    def others(asked: pa.Table, t: pa.Table) -> pa.Table:
        kinds = [pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64())]
        if not len(asked) or not len(t):
            return pa.table([pa.array([], kind) for kind in kinds], ["x", "d", "i"])
        p, owner, ids = points(t)
        q = asked["x"].combine_chunks()
        d, i = lists(*search(matrix(q), asked["far"].to_numpy(), p, owner, ids, k + 1), len(asked))
        return pa.table({"x": q, "d": d, "i": i})

    asks = first.select(F.explode("ask").alias("cell"), "x", "far")
    more = asks.groupBy("cell").cogroup(dealt.groupBy("cell")).applyInArrow(others, "x array<double>, d array<double>, i array<bigint>")
    answers = first.select("x", "d", "i").unionByName(more)
    found = answers.groupBy("x").agg(F.flatten(F.collect_list(F.arrays_zip("d", "i"))).alias("all"))
    found = found.select("x", F.slice(F.array_sort("all"), 1, k + 1).alias("all"))  # by distance, then id
    # each member takes the first k entries of its vector's list, skipping itself
    mine = pts.join(found, "x").select("id", F.posexplode(F.slice(F.filter("all", lambda e: e["i"] != F.col("id")), 1, k)).alias("r", "e"))
    return mine.select("id", (F.col("r") + 1).cast("int").alias("nbr_rank"), F.col("e.i").alias("nbr_id"), F.col("e.d").alias("dist2"))
