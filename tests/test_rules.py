"""Rules at the edges: null labels, foreign categories, restarts, mixed types, one-class sets, appended tables."""

import pytest
from pyspark.sql import functions as F

from paths import SF001
from tabforge.functions import scalars as S
from tabforge.operators import clean as C
from tabforge.operators import drift as D
from tabforge.operators import encode as EN
from tabforge.operators import metrics as M
from tabforge.operators import models as MO
from tabforge.operators import quality as Q
from tabforge.operators import score as SC
from tabforge.operators.resample import smote
from tabforge.plans import pipelines as PL
from tabforge.plans import q_pipeline as QP
from tabforge import session
from tabforge.session import drop_staged, ensure_checkpoint_dir, materialize, scratch_path
from tabforge.sources import io as IO
from tabforge.spec import ScoringSpec, TrainSpec
from tabforge.streaming import scoring as STR


def test_text_with_a_float_suffix_is_no_number(spark):
    d = spark.createDataFrame([("45d", 1), ("7", 0), ("1e3", 1), (None, 0)], "v string, y int")
    r = Q.type_issues(d, ["v"], []).first()
    assert r["unparsable"] == 1
    assert {x["column"]: x["q1"] for x in Q.iqr_fences(d, ["v"]).collect()} == {"v": 255.25}  # of 7 and 1000
    assert sorted(x["v"] for x in C.remove_outliers(d, ["v"], k=100).collect()) == ["1e3", "7"]


def test_class_report_over_mixed_types(spark):
    d = spark.createDataFrame([(1.0, 1), (1.0, 0), (0.0, 0), (0.0, 0)], "label double, prediction int")
    r = {x["cls"]: x for x in M.class_report(d).collect()}
    assert set(r) == {"0", "1", "macro avg", "weighted avg"} and r["1"]["recall"] == 0.5 and r["0"]["precision"] == pytest.approx(2 / 3)


def test_csv_with_line_breaks_quotes_and_blanks(spark):
    rows = [(1, 'a\n"b", c'), (2, "  pad "), (3, ""), (4, None), (5, "x\\y")]
    path = scratch_path(spark, "csv")
    IO.write_csv(spark.createDataFrame(rows, "id int, s string").coalesce(1), path)
    back = {r["id"]: r["s"] for r in IO.read_csv(spark, path, "id int, s string").collect()}
    assert back == dict(rows) | {3: None}  # an empty cell is a missing value, quoted or not


def test_write_and_verify_counts_an_append_alone(spark):
    path = scratch_path(spark, "append")
    for _ in range(2):
        r = IO.write_and_verify(spark.range(10), path, "append").first()
        assert (r["rows_written"], r["rows_read"], r["count_ok"]) == (10, 10, True)
    assert spark.read.parquet(path).count() == 20


def test_strip_is_that_of_python(spark):
    texts = ["  a ", "\x1f　b c\x85", "​d", " ", "e\t"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(S.strip_ws("s")).collect()]
    assert got == [t.strip() for t in texts]


def test_a_new_level_counts_and_two_levels_are_a_z_test(spark):
    mk = lambda a, b, c: spark.createDataFrame([(v,) for v, n in (("a", a), ("b", b), ("c", c)) for _ in range(n)], "cat string")
    cols, _ = D.drift_report(mk(500, 500, 0), mk(480, 480, 40), [], ["cat"], "tests")
    r = cols.first()
    assert r["method"] == "chi2_p_value" and r["drifted"] and r["statistic"] < 1e-6
    r = D.drift_report(mk(60, 40, 0), mk(45, 55, 0), [], ["cat"], "tests")[0].first()
    assert r["method"] == "z_p_value" and r["statistic"] == pytest.approx(0.033672, abs=1e-6)  # z = 2.1240
    with pytest.raises(TypeError):
        D.drift_report(mk(1, 1, 0), mk(1, 1, 0), [], ["cat"])


def test_evaluation_of_a_one_class_set(spark):
    d = QP.doc_raw(spark, SF001).where("quality = 1")
    r = MO.evaluate(QP.fixed_model(spark), d, "quality").first()
    assert r["roc_auc"] is None and r["tp"] + r["fn"] == r["test_samples"] > 0


def test_smote_refuses_gaps_and_keeps_integers(spark):
    rows = [(i, int(i >= 8), i % 5, float(i)) for i in range(40)]
    d = spark.createDataFrame(rows, "id bigint, y int, code int, v double")
    out = smote(d, "id", "y", ["code", "v"], k=3)
    assert dict(out.dtypes)["code"] == "int" and out.groupBy("y").count().select("count").distinct().count() == 1
    with pytest.raises(ValueError, match="missing values.*code.*1"):
        smote(d.withColumn("code", F.when(F.col("id") != 3, F.col("code"))), "id", "y", ["code", "v"])


SPEC = ScoringSpec(["n"], {"kind": {"a": "A"}}, {"n": (0, 100)}, categories={"src": ["s1", "s2"]}, class_names={0: "low", 1: "high"})


def checked(spark, rows, spec=SPEC):
    d = spark.createDataFrame(rows, "n string, kind string, src string")
    return SC.check(SC.normalize(d, spec), spec)


def test_unknown_and_missing_categories_are_rejected(spark):
    out = [r["errors"] for r in checked(spark, [("1", "a", "s1"), ("1", "a", "NEVER"), ("1", "a", None), ("x", "b", "s2")]).collect()]
    assert out[0] == [] and out[1] == ["invalid:src:'NEVER' not one of 2 known values"] and out[2] == ["missing:src"] and len(out[3]) >= 2
    many = ScoringSpec(**{**SPEC.__dict__, "categories": {"src": [f"s{i}" for i in range(1, 200)]}})
    assert [len(r["errors"]) for r in checked(spark, [("1", "a", "s7"), ("1", "a", "NEVER"), ("1", "a", None)], many).collect()] == [0, 1, 1]


def test_equal_records_have_ids_of_their_own_and_nothing_stays_cached(spark):
    src = QP.raw_scoring_input(spark, SF001).drop("doc_id")
    twice = src.unionByName(src)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    scored, rejected = SC.score(twice, QP.fixed_model(spark), QP.FIXED_SCORING, "fixed")
    n = scored.count() + rejected.count()
    assert n == twice.count() == scored.select("row_id").unionByName(rejected.select("row_id")).distinct().count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_stream_starts_keep_history_and_replays_add_nothing(spark):
    src = QP.raw_scoring_input(spark, SF001)
    model, out = QP.fixed_model(spark), (scratch_path(spark, "pred"), scratch_path(spark, "quar"))
    start = lambda inbox, **kw: STR.run_scoring_stream(spark, inbox, src.schema, model, QP.FIXED_SCORING, "fixed", *out, **kw)[0].count()
    inbox = scratch_path(spark, "inbox")
    src.where("doc_id % 2 = 0").write.parquet(inbox)
    first = start(inbox)
    assert start(inbox) == first  # nothing new: nothing added
    src.where("doc_id % 2 = 1").write.mode("append").parquet(inbox)
    both = start(inbox)
    assert both > first
    # another query, with a checkpoint of its own, starts at batch 0 again and must not replace the rows
    assert start(inbox, checkpoint_path=scratch_path(spark, "other-checkpoint")) == 2 * both
    live, name = STR.live_or_fallback(spark, out[0], spark.range(1), start="2000-01-01", end="2100-01-01", min_rows=5)
    assert name == "live predictions" and live.count() == 2 * both
    assert STR.live_or_fallback(spark, out[0], spark.range(1), start="2100-01-01", min_rows=5)[1] == "test data"


def test_monitoring_input_hides_no_other_errors(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        live, _ = STR.live_or_fallback(spark, str(tmp_path / "broken"), spark.range(1))
        live.count()


def test_stages_can_be_switched_off(spark):
    raw = QP.doc_raw(spark, SF001)
    first = PL.train_pipeline(raw, QP.DOC_TRAIN, {"features": False, "train": False, "evaluate": False}, quality=QP.DOC_QUALITY)
    assert first.prep is not None and first.validation.count() > 0 and first.fs is None and first.results is None
    second = PL.train_pipeline(raw, QP.DOC_TRAIN, {"ingest": False, "validate": False, "transform": False, "train": False, "evaluate": False},
                               earlier=first)
    assert second.prep is first.prep and second.fs is not None
    with pytest.raises(ValueError, match="transform is off"):
        PL.train_pipeline(raw, QP.DOC_TRAIN, {"transform": False})
    with pytest.raises(ValueError, match="unknown stages"):
        PL.train_pipeline(raw, QP.DOC_TRAIN, {"trian": False})


def test_encoder_has_no_limit_on_levels_and_inlines_few(spark, monkeypatch):
    d = spark.range(3000).select(F.concat(F.lit("v"), F.format_string("%05d", F.col("id") * 7 % 3000)).alias("c"), (F.col("id") % 3).cast("string").alias("s"))
    enc = EN.fit_label_encoder(d, ["c", "s"])
    want = {v: i for i, v in enumerate(sorted(r["c"] for r in d.select("c").distinct().collect()))}
    assert {r["value"]: r["code"] for r in enc.where("column = 'c'").collect()} == want
    plain = sorted(map(tuple, EN.apply_label_encoder(d, enc).collect()))
    for limit in (0, 10 ** 6):
        monkeypatch.setattr(EN, "MAX_INLINE_LEVELS", limit)
        assert sorted(map(tuple, EN.apply_label_encoder(d, enc).collect())) == plain


def test_scratch_needs_a_shared_folder_off_a_local_master():
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster())


def test_staged_copies_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_STAGED", {})  # only the copy made here
    d = materialize(spark.range(5))
    path = d.inputFiles()[0]
    assert drop_staged(spark) > 0 and not IO._exists(spark, path.rsplit("/", 1)[0])


@pytest.mark.parametrize("most", [0, 10_000])
def test_split_and_folds_have_the_same_rows_however_many_classes(spark, monkeypatch, most):
    """Quotas by table (no class fits the driver) and by numbers; against plain ranks."""
    from tabforge.operators import split as SP
    monkeypatch.setattr(SP, "MAX_CLASSES", most)
    df = spark.range(900).selectExpr("id", "case when id % 11 = 0 then null else id % 7 end as y", "'x' as split")
    rows = sorted((r["id"], r["y"]) for r in df.collect())
    draws = {r["id"]: r["d"] for r in df.select("id", S.hash_draw("id", seed=42).alias("d")).collect()}
    classes = {}
    for i, y in rows:
        classes.setdefault(y, []).append((draws[i], i))
    quota = SP.split_quotas({y: len(v) for y, v in classes.items()}, 0.3)
    folds = SP.fold_allocation({y: len(v) for y, v in classes.items()}, 4)
    want_split, want_fold = {}, {}
    for y, v in classes.items():
        for n, (_, i) in enumerate(sorted(v)):
            want_split[i] = "train" if n < quota[y][0] else "test"
            want_fold[i] = next(f for f in range(4) if n < sum(folds[y][:f + 1]))
    assert {r["id"]: r["split"] for r in SP.stratified_split(df, "y", "id", 0.3).collect()} == want_split
    assert {r["id"]: r["fold"] for r in SP.stratified_folds(df, "y", "id", 4).collect()} == want_fold


@pytest.mark.parametrize("bins, leaves", [(2, 1), (3, 4), (4096, 100_000)])
def test_quantiles_by_selection_at_any_bins(spark, bins, leaves):
    """Ties, both infinities, the widest range, a constant and an empty column."""
    import numpy as np
    from tabforge.operators import ordered as O
    rng = np.random.default_rng(4)
    a = rng.lognormal(0, 9, 500)
    a[:120] = 7.0
    b = np.concatenate((rng.normal(size=497) * 1e-300, [1.7e308, -1.7e308, 5e-324]))
    rows = [(float(x), float(y), 2.0, None, float("inf") if i < 30 else float("-inf") if i < 200 else float(i)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame([*rows, (None, float("nan"), None, None, None)], "a double, b double, c double, d double, e double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["column"]: r for r in O.exact_quantiles(df, list("abcde"), probs, names=[f"q{i}" for i in range(7)], bins=bins, leaves=leaves).collect()}
    assert set(got) == set("abce")
    for c, v in (("a", a), ("b", b), ("c", np.full(500, 2.0))):
        v = np.sort(v)
        for i, p in enumerate(probs):
            k = p * 499
            lo, hi = v[int(np.floor(k))], v[int(np.ceil(k))]
            assert got[c][f"q{i}"] == (lo if lo == hi else lo + (hi - lo) * (k - np.floor(k)))
    assert got["e"]["q0"] == float("-inf") and got["e"]["q6"] == float("inf") and got["e"]["q3"] == 279.5


def test_exact_ks_distribution_equals_enumeration():
    from fractions import Fraction
    from itertools import combinations
    for n in range(1, 7):
        for m in range(1, 7):
            paths = []
            for a in combinations(range(n + m), n):
                i = j = 0
                most = Fraction(0)
                for k in range(n + m):
                    i, j = (i + 1, j) if k in a else (i, j + 1)
                    most = max(most, abs(Fraction(i, n) - Fraction(j, m)))
                paths.append(most)
            for d in set(paths):
                assert D.ks_exact_p(float(d), n, m) == pytest.approx(sum(x >= d for x in paths) / len(paths), abs=1e-12)
    assert D.ks_p(0.06, 1000, 1000) == pytest.approx(D.ks_asymptotic_p(0.06, 1000, 1000), abs=5e-3)
    assert D.ks_p(None, 3, 3) is None and D.ks_p(0.5, 0, 3) is None and D.ks_exact_p(0.0, 3, 3) == 1.0


def test_density_of_many_distinct_values_equals_the_kernel_sum(spark):
    import numpy as np
    from tabforge.operators import profile as PR
    for v in (np.random.default_rng(2).normal(size=3000) * 5 + 1, np.concatenate((np.random.default_rng(3).lognormal(0, 2, 2000), [5.0] * 500))):
        got = sorted((r["point"], r["x"], r["density"]) for r in PR.density(spark.createDataFrame([(float(x),) for x in v], "v double"), "v", 60).collect())
        h = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min(), v.max(), 60)
        want = np.exp(-0.5 * ((grid[:, None] - v[None]) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert np.allclose([x for _, x, _ in got], grid) and np.abs(np.array([d for *_, d in got]) - want).max() < 1e-6


def test_transform_with_100000_levels_saved_and_reloaded(spark):
    n = 100_000
    d = spark.range(n).select("id", (F.col("id") % 2).cast("int").alias("y"), F.format_string("v%07d", "id").alias("cat"),
                              F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("few"), F.col("id").cast("double").alias("x"))
    prep = PL.transform(d, TrainSpec(id_col="id", target="y", features=["cat", "x", "few"], categorical=["cat", "few"], outlier_cols=[],
                                     drop_cols=[], skewed_cols=[]))
    assert prep.table.columns[:5] == ["id", "y", "f_cat", "f_x", "f_few"]
    bad = "f_cat <> id OR f_cat IS NULL OR f_few <> CASE id % 3 WHEN 0 THEN -1 ELSE id % 3 - 1 END"
    assert prep.table.count() == n and prep.table.where(bad).count() == 0
    path = scratch_path(spark, "prep")
    MO.save(prep.prep_stage, path)
    new = spark.createDataFrame([(1, "v0000007", "k2", 0.0), (2, "unseen", None, 0.0)], "id int, cat string, few string, x double")
    again = MO.load(path).transform(new).orderBy("id").collect()
    assert [(r["f_cat"], r["f_few"]) for r in again] == [(7, 1), (-1, -1)]
    assert "v0099999" not in prep.prep_stage.transform(d)._jdf.queryExecution().toString()  # no branch a level
