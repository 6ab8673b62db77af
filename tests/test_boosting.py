"""Second-order boosting (M7) against a plain numpy version, and its defined cases; the work of a forest's levels."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabforge.operators import boosting as B
from tabforge.operators import models as MO
from tabforge.session import scratch_path


def _rows(n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(n) < 0.05)).astype(float)
    x[rng.random((n, 3)) < 0.1] = np.nan
    return x, y


def _table(spark, x, y, fold=None):
    fold = np.arange(len(y)) % 3 if fold is None else fold
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t), int(f)) for i, (r, t, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, fold int")


def _plain(x, y, cuts, trees, depth, eta=0.1, lam=1.0, mcw=1.0):
    """Brute force: every cut of every feature with either side for missing values, node by node."""
    margin, forest = np.zeros(len(y)), []

    def grow(rows, level, g, h):
        G, H = g[rows].sum() / B.SCALE, h[rows].sum() / B.SCALE
        best = (B.MIN_GAIN, None)
        if level < depth:
            for f in range(x.shape[1]):
                v, miss = x[rows, f], np.isnan(x[rows, f])
                for c in [*cuts[f], np.inf]:
                    for to_left in (True, False):
                        left = np.where(miss, to_left, v <= c)
                        if left.all() or not left.any():
                            continue
                        gl, hl = g[rows[left]].sum() / B.SCALE, h[rows[left]].sum() / B.SCALE
                        if hl < mcw or H - hl < mcw:
                            continue
                        gain = gl ** 2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G ** 2 / (H + lam)
                        if gain > best[0]:
                            best = (gain, (f, c, to_left, left))
        if best[1] is None:
            return -eta * G / (H + lam)
        f, c, to_left, left = best[1]
        return f, c, to_left, grow(rows[left], level + 1, g, h), grow(rows[~left], level + 1, g, h)

    def at(node, r):
        while isinstance(node, tuple):
            f, c, to_left, lo, hi = node
            node = lo if (to_left if np.isnan(r[f]) else r[f] <= c) else hi
        return node

    for _ in range(trees):
        g, h = B.gradients(margin, y)
        forest.append(grow(np.arange(len(y)), 0, g, h))
        margin = margin + np.array([at(forest[-1], r) for r in x])
    return 1 / (1 + np.exp(-margin))


def test_equal_to_a_plain_version_with_folds_and_missing_values(spark):
    x, y = _rows()
    t = _table(spark, x, y)
    cuts = B.quantile_cuts(t, ["a", "b", "c"], 20)
    models = B.fit_boosted(t.repartition(3), ["a", "b", "c"], "y", "fold", 3, n_estimators=12, max_depth=3, cuts=cuts)
    assert len(models) == 4
    for m, model in enumerate(models):
        use = np.arange(len(y)) % 3 != m
        want = _plain(x[use], y[use], cuts, 12, 3)
        got = model.transform(t).orderBy("id").select(F.col("probability")[1].alias("p")).toPandas()["p"].to_numpy()
        assert np.allclose(got[use], want, atol=1e-9)


def test_layout_and_order_do_not_change_the_trees(spark, monkeypatch):
    x, y = _rows(400, 5)
    t = _table(spark, x, y)
    cuts = B.quantile_cuts(t, ["a", "b", "c"])
    one = B.fit_boosted(t.coalesce(1), ["a", "b", "c"], "y", n_estimators=11, max_depth=4, cuts=cuts)[0]
    monkeypatch.setattr(B, "ROWS_PER_TASK", 10)  # the plan with an exchange
    two = B.fit_boosted(t.repartition(7, "c").sortWithinPartitions(F.desc("id")), ["a", "b", "c"], "y", n_estimators=11, max_depth=4, cuts=cuts)[0]
    assert one.getOrDefault(one.trees) == two.getOrDefault(two.trees)


def test_learns_what_one_split_cannot(spark, tmp_path):
    x, y = _rows(1500, 7)
    t = _table(spark, x, y)
    train, test = t.where("id < 1000"), t.where("id >= 1000")
    model = MO.fit("gbt", train, ["a", "b", "c"], "y", params={"n_estimators": 30, "max_depth": 4})
    path = scratch_path(spark, "boost")
    MO.save(model, path)
    again = PipelineModel.load(path)
    a, b = (MO.predict(m, test, keep=["id", "y"]).orderBy("id").collect() for m in (model, again))
    assert a == b
    right = sum(r["prediction"] == r["y"] for r in a) / len(a)
    first = MO.fit("gbt_first_order", train.na.fill(0.0), ["a", "b", "c"], "y", params={"n_estimators": 30, "max_depth": 4})
    base = MO.predict(first, test.na.fill(0.0), keep=["y"]).where("prediction = y").count() / len(a)
    assert right >= base - 0.02 and right > 0.75


def test_defined_cases(spark):
    t = _table(spark, np.array([[1.0, np.nan, 2.0], [2.0, np.nan, 2.0]]), np.array([1.0, 1.0]))
    p = B.fit_boosted(t, ["a", "b", "c"], "y", n_estimators=2)[0].transform(t)
    assert p.where("probability[1] <= 0.5 OR prediction <> 1").count() == 0  # one class, a column without values, a constant one
    with pytest.raises(ValueError, match="no labelled rows"):
        B.fit_boosted(t.withColumn("y", F.lit(None).cast("double")), ["a"], "y")
    with pytest.raises(ValueError, match="0 or 1"):
        B.fit_boosted(t.withColumn("y", F.lit(2)), ["a"], "y")
    with pytest.raises(ValueError, match="max_depth"):
        B.fit_boosted(t, ["a"], "y", max_depth=40)
    nulls = t.withColumn("fold", F.lit(None).cast("int"))  # rows without a fold train every model
    a, b = B.fit_boosted(nulls, ["a", "b", "c"], "y", "fold", 1, n_estimators=2)
    assert a.getOrDefault(a.trees) == b.getOrDefault(b.trees)
    assert B.fit_boosted(t, ["a"], "y", n_estimators=1)[0].transform(t.limit(0)).count() == 0


def test_a_job_walks_one_tree_and_sums_one_child_of_two(spark, monkeypatch):
    x, y = _rows(600, 11)
    seen, staged, level_sums, materialize = [], [], B._level_sums, B.materialize

    def spy(trees, slots, level, *rest):
        seen.append((trees.feature.shape[1], level, sum(int((s >= 0).sum()) for s in slots)))
        return level_sums(trees, slots, level, *rest)

    def stage(df, name):
        staged.append((out := materialize(df, name)).count())
        return out

    monkeypatch.setattr(B, "_level_sums", spy)
    monkeypatch.setattr(B, "materialize", stage)
    B.fit_boosted(_table(spark, x, y).coalesce(1), ["a", "b", "c"], "y", "fold", 1, n_estimators=12, max_depth=3)
    assert {trees for trees, _, _ in seen} == {1}  # the trees before it are in the margins
    assert all(nodes <= (2 if level == 0 else 2 ** level) for _, level, nodes in seen)  # of two models
    assert max(staged) <= 3  # blocks, not single rows


def test_sums_of_blocks_are_those_of_rows(monkeypatch):
    monkeypatch.setattr(B, "CHUNK", 50)  # parts that begin and end within blocks and batches
    monkeypatch.setattr(B, "BLOCK_BYTES", 7 * (2 + 12 + 16))
    rng = np.random.default_rng(1)
    n, cuts = 333, [np.array([-0.5, 0.0, 0.7]), np.array([0.1])]
    x, y, fold = rng.normal(size=(n, 2)), (rng.random(n) < 0.4).astype(float), rng.integers(-1, 1, n).astype(np.int32)
    x[::9, 1] = np.nan
    batch = pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(y), pa.array(fold)], names=["x0", "x1", "y", "fold"])
    blocks = list(B._bin_rows(cuts, 2)([batch.slice(0, 100), batch.slice(100, 0), batch.slice(100)]))
    tree = B._Trees(2, 1, 2)
    for m in range(2):
        tree.feature[m, 0, :3], tree.bin[m, 0, :3], tree.missing_left[m, 0, :3] = [1, 0, -1], [0, m, 0], [False, True, True]
        tree.value[m, 0] = rng.normal(size=7)
    blocks = list(B._new_margins(tree, 2, 2)(blocks))
    right = ~(x[:, 1] <= 0.1)  # missing ones too
    place = [np.where(right, 2, np.where(x[:, 0] <= cuts[0][m], 3, 4)) for m in range(2)]
    margin = np.stack([tree.value[m, 0][place[m]] for m in range(2)], axis=1)
    got = np.concatenate([B._unpack(b, 2, 2)[3] for b in blocks])
    assert np.array_equal(got, margin)
    slots = [np.full(7, -1) for _ in range(2)]
    slots[0][3], slots[1][3], slots[1][2 * 2] = 0, 1, 2
    out = [r for b in B._level_sums(tree, slots, 2, 2)(blocks) for r in b.to_pylist()]
    want = {}
    for m in range(2):
        g, h = B.gradients(margin[:, m], y)
        for i in np.nonzero(fold != m)[0]:
            if (s := int(slots[m][place[m][i]])) >= 0:
                for f in range(2):
                    code = B.MISSING if np.isnan(x[i, f]) else int(np.searchsorted(cuts[f], x[i, f]))
                    e = want.setdefault((s * 2 + f) * B.CODES + code, [0, 0, 0])
                    e[0], e[1], e[2] = e[0] + int(g[i]), e[1] + int(h[i]), e[2] + 1
    assert {r["slot"]: [r["g"], r["h"], r["n"]] for r in out} == want


def test_forest_does_not_walk_its_trees_again_at_every_level(spark):
    x, y = _rows(400, 13)
    t = _table(spark, x, y).na.fill(0.0).coalesce(2).persist()
    pipe = MO.build_pipeline("random_forest", t, ["a", "b", "c"], "y", params={"n_estimators": 8, "max_depth": 6})
    *_, est = pipe.getStages()
    assert est.getCacheNodeIds()
    cached = pipe.fit(t).stages[-1].toDebugString.split("\n")[1:]  # the first line has the name of the run
    est.setCacheNodeIds(False)
    assert cached == pipe.fit(t).stages[-1].toDebugString.split("\n")[1:]
    t.unpersist()
