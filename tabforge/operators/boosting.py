"""Second-order gradient boosted trees for 0/1 labels (M7).

Training is a chain of Spark jobs over one narrow staged table: the bins of a row's features as bytes, its label, its
fold and its margins, by blocks of rows, as the jobs are many and would otherwise spend most of their time on handing
single rows to Python. A level of a tree is one job. Every task walks its rows down the growing tree and adds up
gradient, hessian and count by (model, node, feature, bin); Spark sums the tables of the tasks; the driver receives at
most models x nodes x features x 256 sums, whatever the number of rows, and picks the split of highest gain of each
node. Of two children only the one with fewer rows is summed; the other is their parent less that one, exactly, as all
sums are whole numbers. Leaves are Newton steps, -G / (H + lambda).

The models of all folds and the final one grow side by side in the same jobs, so k-fold validation reads the table
once a level and not k + 1 times.

Gradients are rounded to multiples of 2^-20, so that their sums are whole numbers: given the cuts, the trees do not
depend on partitioning, on the order of rows or on retries. Each tree is added to the margins once, in the pass that
sums the root of the next one, so a job walks one tree, however many there are. The new margins are kept in the cache
and written every ``REFRESH`` trees; a lost executor costs its own tasks, at most those trees again.

Defined cases: rows with a null label are not trained on; null and NaN features are missing values, and each split
learns the side that they go to; labels other than 0 and 1, and a table without rows, are errors; a feature without
values, or with one, is never split on; one class only gives trees of one leaf.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_staged, materialize, ship_package

#: Bins of a feature (cuts + 1), the code of a missing value, and both together.
MAX_BINS, MISSING, CODES = 255, 255, 256
#: Gradients are whole multiples of 1 / SCALE; sums of 2^33 rows of a task, and 2^43 of all tasks, are exact.
SCALE = 1 << 20
#: Trees between two writes of the margins.
REFRESH = 10
#: Levels at most: a tree has 2^(depth + 1) places.
MAX_DEPTH = 12
#: Rows that are worth a task of their own.
ROWS_PER_TASK = 50_000
#: Bytes of a block of rows.
BLOCK_BYTES = 16_384
#: Rows that a task sums at once (hessian and count share a number, see ``PACK``).
CHUNK = 32_768
#: Hessian sums of a chunk are counted in multiples of this, so that its row counts fit below them (2^18 x 2^15 x 2^16 < 2^53).
PACK = 1 << 16
#: Gain that a split must go beyond.
MIN_GAIN = 1e-6
SUMS = "slot bigint, g bigint, h bigint, n bigint"


def _number(c: str):
    """The column as a double, NaN as null."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature at its approximate quantiles (one pass); a value goes left of a cut it equals."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = df.agg(*[F.percentile_approx(_number(c), at, F.lit(10_000)).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.asarray(q if q is not None else [], dtype=np.float64)) for q in row]


class _Trees:
    """Trees of several models as arrays (model, tree, place); the children of place p are 2p + 1 and 2p + 2.
    ``feature`` is -1 at a leaf."""

    def __init__(self, models: int, trees: int, depth: int):
        shape = (models, trees, 2 ** (depth + 1) - 1)
        self.feature = np.full(shape, -1, dtype=np.int32)
        self.bin = np.zeros(shape, dtype=np.int32)
        self.missing_left = np.ones(shape, dtype=bool)
        self.value = np.zeros(shape)

    def part(self, start: int, end: int) -> "_Trees":
        out = object.__new__(_Trees)
        for k, v in self.__dict__.items():
            setattr(out, k, v[:, start:end].copy())
        return out

    def walk(self, bins: np.ndarray, start: np.ndarray, m: int, t: int, steps: int) -> np.ndarray:
        """The place of rows in tree ``t`` of model ``m`` after so many steps; the bins of a row begin at its ``start``."""
        place = np.zeros(len(start), dtype=np.int64)
        if not steps:
            return place
        inner = np.arange(2 ** steps - 1)  # the places that a step can leave
        feature, cut, missing_left = (x[m, t][:len(inner)] for x in (self.feature, self.bin, self.missing_left))
        code = np.arange(CODES)
        left = np.where(code == MISSING, missing_left[:, None], code <= cut[:, None])
        child = np.where(feature[:, None] >= 0, 2 * inner[:, None] + 2 - left, inner[:, None]).ravel()
        feature = np.maximum(feature, 0).astype(np.int64)
        for _ in range(steps):
            place = child[place * CODES + bins[start + feature[place]]]
        return place


def gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the log loss, as whole multiples of 1 / SCALE."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - y) * SCALE), np.rint(p * (1.0 - p) * SCALE)


def best_splits(g: np.ndarray, h: np.ndarray, n: np.ndarray, reg_lambda: float, min_child_weight: float):
    """The best split of each node from sums of shape (nodes, features, codes): gain, feature, bin, missing_left, and the
    sums of gradient, hessian and count of the left and the right side. Ties go to the first feature, the lowest bin, and missing values to the left."""
    g, h = g / SCALE, h / SCALE
    gt, ht, nt = (x[:, 0, :].sum(axis=1)[:, None, None, None] for x in (g, h, n))
    left = []
    for x in (g, h, n):
        right_missing = np.cumsum(x[:, :, :MISSING], axis=2)
        left.append(np.stack([right_missing + x[:, :, MISSING:], right_missing], axis=3))
    gl, hl, nl = left
    gr, hr, nr = gt - gl, ht - hl, nt - nl
    gain = gl ** 2 / (hl + reg_lambda) + gr ** 2 / (hr + reg_lambda) - gt ** 2 / (ht + reg_lambda)
    gain[(hl < min_child_weight) | (hr < min_child_weight) | (nl <= 0) | (nr <= 0)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    feature, b, side = np.unravel_index(at, gain.shape[1:])
    node = np.arange(len(flat))
    sides = [tuple(x[node, feature, b, side] for x in one) for one in (left, (gr, hr, nr))]
    return flat[node, at], feature, b, side == 0, sides


def _block_rows(n_features: int, n_models: int) -> int:
    """Rows of a block, at most a chunk."""
    return min(max(BLOCK_BYTES // (n_features + 12 + 8 * n_models), 1), CHUNK)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all blocks of a binary column, in order, uncopied, and where each block begins and ends in them."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def _blocks(rows: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary column with the bytes of the rows from each edge to the next."""
    rows = np.ascontiguousarray(rows)
    at = (edges * (rows.nbytes // len(rows))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(at), pa.py_buffer(rows)])


def _unpack(batch: pa.RecordBatch, n_features: int, n_models: int):
    """bins (rows, features), labels, folds and margins (rows, models) of a batch of blocks."""
    bins, y, fold, margin = (_bytes(batch.column(c))[0] for c in ("bins", "y", "fold", "margin"))
    return bins.reshape(-1, n_features), y.view(np.float64), fold.view(np.int32), margin.view(np.float64).reshape(-1, n_models)


def _slices(batches: Iterable[pa.RecordBatch], n_features: int, n_models: int) -> Iterator[pa.RecordBatch]:
    """The blocks by parts of at most ``CHUNK`` rows."""
    step = CHUNK // _block_rows(n_features, n_models)
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def _chunks(batches: Iterable[pa.RecordBatch], n_features: int, n_models: int):
    """The rows by parts of ``CHUNK`` (fewer at the end), however small or large the batches are."""
    held, n = [], 0
    for part in _slices(batches, n_features, n_models):
        held.append(_unpack(part, n_features, n_models))
        n += len(held[-1][0])
        if n >= CHUNK:
            whole = [np.concatenate(x) for x in zip(*held)]
            yield [x[:CHUNK] for x in whole]
            held, n = [tuple(x[CHUNK:] for x in whole)], n - CHUNK
    if n:
        yield [np.concatenate(x) for x in zip(*held)]


def _bin_rows(cuts: list[np.ndarray], n_models: int):
    size = _block_rows(len(cuts), n_models)

    def bin_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = np.empty((batch.num_rows, len(cuts)), dtype=np.uint8)
            for j, c in enumerate(cuts):
                x = batch.column(f"x{j}").to_numpy(zero_copy_only=False).astype(np.float64)
                codes[:, j] = np.where(np.isnan(x), MISSING, np.searchsorted(c, x, side="left"))
            y, fold = (batch.column(c).to_numpy(zero_copy_only=False).astype(kind) for c, kind in (("y", np.float64), ("fold", np.int32)))
            edges = np.append(np.arange(0, len(codes), size), len(codes))
            columns = [_blocks(x, edges) for x in (codes, y, fold, np.zeros((len(codes), n_models)))]
            yield pa.RecordBatch.from_arrays(columns, names=["bins", "y", "fold", "margin"])
    return bin_rows


def _new_margins(tree: _Trees, n_features: int, depth: int):
    n_models = len(tree.feature)

    def new_margins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, n_features, n_models):
            bins, _, _, margin = _unpack(part, n_features, n_models)
            margin, start = margin.copy(), np.arange(len(bins)) * n_features
            for m in range(n_models):
                margin[:, m] += tree.value[m, 0][tree.walk(bins.ravel(), start, m, 0, depth)]
            edges = _bytes(part.column("bins"))[1] // n_features
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("bins", "y", "fold")), _blocks(margin, edges)],
                                             names=["bins", "y", "fold", "margin"])
    return new_margins


def _level_sums(tree: _Trees, slots: list[np.ndarray], level: int, n_features: int):
    """Sums of the rows of a task by slot (model and node, feature, code) in the growing tree. ``slots[m]`` gives the
    number of a node of model m that is summed, -1 elsewhere; the numbers of a model follow each other."""
    n_models = len(tree.feature)
    width = n_features * CODES
    size = (max((int(s.max()) for s in slots), default=-1) + 1) * width

    def level_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, h, n = (np.zeros(size, dtype=np.int64) for _ in range(3))
        for bins, y, fold, margin in _chunks(batches, n_features, n_models):
            flat, start = bins.ravel(), np.arange(len(bins)) * n_features
            codes = bins + np.arange(n_features) * CODES
            for m in range(n_models):
                if (slots[m] < 0).all():
                    continue
                mine = np.nonzero(fold != m)[0]  # model m leaves fold m out; the last model has no fold
                open_ = slots[m][tree.walk(flat, start[mine], m, 0, level)]
                mine, open_ = mine[open_ >= 0], open_[open_ >= 0]
                gq, hq = gradients(margin[mine, m], y[mine])
                low = int(slots[m][slots[m] >= 0].min())
                span = (int(slots[m].max()) + 1 - low) * width
                code = (codes[mine] + ((open_ - low) * width)[:, None]).ravel()
                at = slice(low * width, low * width + span)
                g[at] += np.bincount(code, np.repeat(gq, n_features), span).astype(np.int64)
                both = np.bincount(code, np.repeat(hq * PACK + 1, n_features), span).astype(np.int64)
                h[at] += both // PACK
                n[at] += both % PACK
        used = np.nonzero(n)[0]
        for i in range(0, len(used), 100_000):
            u = used[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(g[u]), pa.array(h[u]), pa.array(n[u])], names=["slot", "g", "h", "n"])
    return level_sums


def fit_boosted(df: DataFrame, features: Sequence[str], label: str = "label", fold_col: str | None = None, k: int = 0,
                n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 6, reg_lambda: float = 1.0,
                min_child_weight: float = 1.0, cuts: list[np.ndarray] | None = None) -> list["BoostedTreesModel"]:
    """k + 1 models grown side by side: model i < k without the rows of fold i, the last one with all rows.
    Cuts are taken from all rows. The driver holds at most models x 2^(depth-1) x features x 256 sums, a task half of them."""
    features = list(features)
    if not 1 <= max_depth <= MAX_DEPTH:
        raise ValueError(f"max_depth must lie between 1 and {MAX_DEPTH}")
    if not features:
        raise ValueError("no features to train on")
    spark = df.sparkSession
    ship_package(spark)
    rows = df.where(F.col(label).isNotNull())
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col(label).cast("double").isin(0.0, 1.0)).alias("foreign")).first()
    if not seen["n"]:
        raise ValueError("no labelled rows to train on")
    if seen["foreign"]:
        raise ValueError("labels must be 0 or 1")
    cuts = quantile_cuts(rows, features) if cuts is None else cuts
    n_models, n_features = k + 1, len(features)
    fold = F.coalesce(F.col(fold_col).cast("int"), F.lit(-1)) if fold_col else F.lit(-1)
    # a row of the last model's number would be left out of it
    fold = F.when(fold.between(0, k - 1), fold).otherwise(-1)
    narrow = rows.select(*[_number(c).alias(f"x{j}") for j, c in enumerate(features)], F.col(label).cast("double").alias("y"), fold.alias("fold"))
    schema = "bins binary, y binary, fold binary, margin binary"
    run, version = uuid.uuid4().hex[:8], 0

    def stage(table: DataFrame) -> DataFrame:
        out = materialize(table, f"boost-{run}-{version}")
        # one small task needs no exchange of its sums (a plan choice only)
        return (out.coalesce(1) if seen["n"] <= ROWS_PER_TASK else out).persist()

    table, before = stage(narrow.mapInArrow(_bin_rows(cuts, n_models), schema)), None
    forest = _Trees(n_models, n_estimators, max_depth)
    for t in range(n_estimators):
        nodes, counted, parents = [(m, 0) for m in range(n_models)], np.arange(n_models), None
        for level in range(max_depth):
            if not nodes:
                break
            slots = [np.full(forest.feature.shape[2], -1, dtype=np.int64) for _ in range(n_models)]
            for i, at in enumerate(counted):
                slots[nodes[at][0]][nodes[at][1]] = i
            job = _level_sums(forest.part(t, t + 1), slots, level, n_features)
            got = table.mapInArrow(job, SUMS).groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).toArrow()
            if before is not None:  # the first pass over the new margins has filled their cache
                before.unpersist()
                before = None
            sums = []
            at = got.column("slot").to_numpy()
            for j, c in enumerate(("g", "h", "n")):
                dense = np.zeros(len(counted) * n_features * CODES, dtype=np.int64)
                dense[at] = got.column(c).to_numpy()
                dense = dense.reshape(len(counted), n_features, CODES)
                if parents is not None:  # siblings are neighbours in ``nodes``
                    some, dense = dense, np.empty((len(nodes), n_features, CODES), dtype=np.int64)
                    dense[counted], dense[counted ^ 1] = some, parents[j] - some
                sums.append(dense)
            nodes, counted, split = _grow(forest, t, nodes, *sums, learning_rate, reg_lambda, min_child_weight)
            parents = [x[split] for x in sums]
        if t + 1 < n_estimators:
            before, table = table, table.mapInArrow(_new_margins(forest.part(t, t + 1), n_features, max_depth), schema)
            if (t + 1) % REFRESH:
                table = table.persist()
            else:
                version += 1
                table = stage(table)
                before.unpersist()
                before = None
                drop_staged(spark, f"boost-{run}-{version - 1}-")
    table.unpersist()
    drop_staged(spark, f"boost-{run}-{version}-")
    return [BoostedTreesModel.of(forest, m, cuts, features) for m in range(n_models)]


def _grow(forest: _Trees, t: int, nodes, g, h, n, learning_rate: float, reg_lambda: float, min_child_weight: float):
    """Splits every open node where that gains and gives both children their leaf values, which hold unless they are
    split in turn. Returns the children by pairs, the position of the one with fewer rows in each pair, and the
    positions of the nodes that were split."""
    gain, feature, b, missing_left, sides = best_splits(g, h, n, reg_lambda, min_child_weight)
    children, fewer, split = [], [], []
    for i, (m, place) in enumerate(nodes):
        if place == 0:
            forest.value[m, t, 0] = -learning_rate * (g[i, 0].sum() / SCALE) / (h[i, 0].sum() / SCALE + reg_lambda)
        if gain[i] > MIN_GAIN:
            forest.feature[m, t, place], forest.bin[m, t, place] = feature[i], b[i]
            forest.missing_left[m, t, place] = missing_left[i]
            split.append(i)
            fewer.append(len(children) + int(sides[0][2][i] > sides[1][2][i]))
            for child, (gs, hs, _) in zip((2 * place + 1, 2 * place + 2), sides):
                forest.value[m, t, child] = -learning_rate * gs[i] / (hs[i] + reg_lambda)
                children.append((m, child))
    return children, np.array(fewer, dtype=np.int64), np.array(split, dtype=np.int64)


class BoostedTrees(Estimator, HasInputCols, HasLabelCol, HasPredictionCol, HasProbabilityCol):
    """``fit_boosted`` as an estimator of one model, for a pipeline. Reads plain columns, so it needs no assembler."""

    def __init__(self, inputCols: Sequence[str], labelCol: str = "label", **settings):
        super().__init__()
        self._set(inputCols=list(inputCols), labelCol=labelCol)
        self.settings = settings

    def _fit(self, dataset: DataFrame) -> "BoostedTreesModel":
        return fit_boosted(dataset, self.getInputCols(), self.getLabelCol(), **self.settings)[-1]


class BoostedTreesModel(Model, HasInputCols, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds probability (array of both classes) and prediction (1.0 if class 1 is likelier). The trees are a parameter,
    so the model is saved and loaded with its pipeline."""

    trees = Param(Params._dummy(), "trees", "the trees as JSON lists: feature, threshold, missing_left, value, depth",
                  typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list | None = None, trees: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    @staticmethod
    def of(forest: _Trees, m: int, cuts: list[np.ndarray], features: list[str]) -> "BoostedTreesModel":
        # a split behind the last cut has all values on the left and the missing ones on the right
        ends = [np.append(c, np.full(MAX_BINS - len(c), np.inf)) for c in cuts]
        feature, b = forest.feature[m], forest.bin[m]
        threshold = np.stack(ends)[feature, b]
        depth = int(np.log2(feature.shape[1] + 1)) - 1
        state = {"depth": depth, "feature": feature.tolist(), "threshold": np.where(feature >= 0, threshold, 0.0).tolist(),
                 "missing_left": forest.missing_left[m].astype(int).tolist(), "value": forest.value[m].tolist()}
        return BoostedTreesModel(inputCols=list(features), trees=json.dumps(state))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        state = json.loads(self.getOrDefault(self.trees))
        feature, value = np.array(state["feature"]), np.array(state["value"])
        threshold = np.array(state["threshold"])
        missing_left, depth = np.array(state["missing_left"], dtype=bool), state["depth"]

        @F.pandas_udf("double")
        def chance(x: pd.DataFrame) -> pd.Series:
            a = x.to_numpy(dtype=np.float64)
            rows, margin = np.arange(len(a)), np.zeros(len(a))
            for t in range(len(feature)):
                place = np.zeros(len(a), dtype=np.int64)
                for _ in range(depth):
                    f = feature[t][place]
                    v = a[rows, f]
                    left = np.where(np.isnan(v), missing_left[t][place], v <= threshold[t][place])
                    place = np.where(f >= 0, 2 * place + 2 - left, place)
                margin += value[t][place]
            return pd.Series(1.0 / (1.0 + np.exp(-margin)))

        p = "_chance"
        out = dataset.withColumn(p, chance(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.getInputCols())])))
        return out.withColumn(self.getProbabilityCol(), F.array(1 - F.col(p), F.col(p))) \
                  .withColumn(self.getPredictionCol(), (F.col(p) > 0.5).cast("double")).drop(p)
