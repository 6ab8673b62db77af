"""Golden unit tests on tiny inline tables: nulls, NaN, ties, constant columns, empty input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.functions import scalars as S
from tabforge.operators import clean as C
from tabforge.operators import encode as EN
from tabforge.operators import ordered as O
from tabforge.operators import profile as P
from tabforge.operators import quality as Q


def test_strip_ws_removes_tabs_and_newlines(spark):
    df = spark.createDataFrame([(" \t a b \n",), ("x",), (None,)], "s string")
    out = [r[0] for r in df.select(S.strip_ws("s")).collect()]
    assert out == ["a b", "x", None]


@pytest.mark.parametrize("text,expected", [
    ("45", 45.0), (" 1e3 ", 1000.0), ("-.5", -0.5), ("\t12\n", 12.0),
    ("45d", None), ("1_000", 1000.0), ("1__0", None), ("_1", None), ("nan", None), ("", None), ("abc", None), (None, None)])
def test_parse_number_is_strict(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(S.parse_number("s")).first()[0] == expected


def test_safe_log1p_null_below_minus_one(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (0.0,), (math.e - 1,)], "x double")
    out = [r[0] for r in df.select(S.safe_log1p("x")).collect()]
    assert out[0] is None and out[1] is None and out[2] == 0.0 and abs(out[3] - 1.0) < 1e-12


def test_hash_draw_known_value(spark):
    # md5("17:42")[:8] as an unsigned 32-bit number, also reproducible in DuckDB
    assert spark.range(1).select(S.hash_draw(F.lit(17))).first()[0] == 3830443448


def test_null_counts_include_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r["column"]: r["null_count"] for r in Q.null_counts(df).collect()}
    assert got == {"x": 2, "s": 1}


def test_duplicates_count_after_first(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (None, None), (None, None)], "k int, s string")
    assert Q.duplicate_count(df).first()["duplicate_count"] == 3
    assert Q.drop_duplicates(df).count() == 3


def test_skewness_edge_cases(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 10.0)], "c double, v double")
    got = {r["column"]: r["skewness"] for r in Q.skewness(df, ["c", "v"]).collect()}
    assert got["c"] == 0.0
    x = np.array([1.0, 2.0, 10.0])
    n, m = len(x), x.mean()
    g1 = ((x - m) ** 3).mean() / ((x - m) ** 2).mean() ** 1.5
    assert abs(got["v"] - g1 * math.sqrt(n * (n - 1)) / (n - 2)) < 1e-12
    tiny = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert Q.skewness(tiny, ["v"]).first()["skewness"] is None



def test_validation_suite_skewness_matches_operator(spark):
    """L2's skewness rows (computed inside its wide aggregate) equal A8's, edge cases included."""
    from tabforge.spec import QualitySpec
    df = spark.createDataFrame([(5.0, 1.0, 0), (5.0, 2.0, 1), (5.0, 10.0, 0), (5.0, 3.5, 0)], "c double, v double, y int")
    spec = QualitySpec(expected_columns=["c", "v", "y"], numeric_cols=["c", "v"], categorical_cols=[], target="y",
                       outlier_cols=["v"])
    rep = {r["column"]: (r["value"], r["passed"]) for r in Q.validate(df, spec).where("check = '5_skewness'").collect()}
    a8 = {r["column"]: r["skewness"] for r in Q.skewness(df, ["c", "v"]).collect()}
    assert rep["c"] == (0.0, True)
    assert rep["v"][0] == round(a8["v"], 2) == 1.63 and rep["v"][1] is False  # the suite reports 2 places
    tiny = spark.createDataFrame([(1.0, 0), (2.0, 1)], "v double, y int")
    spec2 = QualitySpec(expected_columns=["v", "y"], numeric_cols=["v"], categorical_cols=[], target="y", outlier_cols=[])
    r = Q.validate(tiny, spec2).where("check = '5_skewness'").first()
    assert r["value"] is None and r["passed"] is False

def test_imbalance_counts_null_target_in_denominator(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,), (None,)], "y int")
    r = Q.imbalance(df, "y").first()
    assert r["minority_count"] == 1 and r["total_rows"] == 5 and r["minority_pct"] == 20.0 and r["passed"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_match_numpy_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.exponential(10, 3000), 1)  # many ties
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    q = O.exact_quantiles(df, ["v"], [0.1, 0.25, 0.5, 0.75, 0.99], names=["a", "b", "c", "d", "e"]).first()
    want = np.quantile(x, [0.1, 0.25, 0.5, 0.75, 0.99])
    assert np.allclose([q["a"], q["b"], q["c"], q["d"], q["e"]], want, rtol=0, atol=1e-9)


def test_running_sum_matches_cumsum_per_group(spark):
    rng = np.random.default_rng(7)
    rows = [(int(g), float(v), int(w)) for g, v, w in zip(rng.integers(0, 3, 2000), rng.normal(size=2000),
                                                        rng.integers(1, 5, 2000))]
    df = spark.createDataFrame(rows, "g int, v double, w bigint").dropDuplicates(["g", "v"])
    got = O.running_sum(df, ["v"], ["w"], ["g"], buckets=16, with_next=True).toPandas()
    pdf = df.toPandas().sort_values(["g", "v"])
    pdf["cum_w"] = pdf.groupby("g")["w"].cumsum()
    pdf["next_v"] = pdf.groupby("g")["v"].shift(-1)
    m = got.merge(pdf, on=["g", "v"], suffixes=("", "_want"))
    assert len(m) == len(pdf)
    assert (m["cum_w"] == m["cum_w_want"]).all()
    assert np.allclose(m["next_v"].fillna(1e300), m["next_v_want"].fillna(1e300))


def test_label_encoder_orders_by_text_and_marks_unknown(spark):
    df = spark.createDataFrame([("b",), ("B",), ("a",), ("b",)], "c string")
    enc = EN.fit_label_encoder(df, ["c"])
    codes = {r["value"]: r["code"] for r in enc.collect()}
    assert codes == {"B": 0, "a": 1, "b": 2}  # upper case sorts first, as in Python
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    out = [r[0] for r in EN.apply_label_encoder(new, enc, ["c"], unknown="minus_one").collect()]
    assert out == [1, -1, -1]
    err = EN.apply_label_encoder(new, enc, ["c"], unknown="error").collect()
    assert err[0]["errors"] == [] and err[1]["errors"][0].startswith("invalid:c:'zzz'")


def test_alias_lookup_error_lists_sorted_valid_values(spark):
    df = spark.createDataFrame([(" WHITE ",), ("Unknown",)], "race string")
    out = C.map_lookup(df, "race", {"white": "White", "black": "Black", "african american": "Black"}).collect()
    assert out[0]["race"] == "White" and out[0]["errors"] == []
    assert out[1]["race"] is None and out[1]["errors"] == ["invalid:race:'Unknown' valid: [Black, White]"]


def test_histogram_puts_max_in_last_bin_and_lists_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    h = {r["bin"]: r["n"] for r in P.histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 0, 2: 0, 3: 0, 4: 1}


def test_remove_outliers_sequential_differs_from_independent(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.lognormal(0, 1, 500), rng.lognormal(0, 1, 500)))]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    seq = C.remove_outliers(df, ["a", "b"], mode="sequential").count()
    ind = C.remove_outliers(df, ["a", "b"], mode="independent").count()
    pdf = df.toPandas()
    d = pdf
    for c in ["a", "b"]:
        q1, q3 = d[c].quantile(0.25), d[c].quantile(0.75)
        d = d[(d[c] >= q1 - 1.5 * (q3 - q1)) & (d[c] <= q3 + 1.5 * (q3 - q1))]
    assert seq == len(d)
    assert ind >= 0


def test_empty_table_checks(spark):
    df = spark.createDataFrame([], "x double, y int")
    assert Q.shape(df).first()["total_rows"] == 0
    assert {r["null_count"] for r in Q.null_counts(df).collect()} == {0}
    assert Q.duplicate_count(df).first()["duplicate_count"] == 0


def test_numbers_stored_as_text_do_not_crash_checks(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("x",), ("100",)], "v string")
    ti = Q.type_issues(df, ["v"], []).first()
    assert ti["unparsable"] == 1 and not ti["passed"]
    assert Q.skewness(df, ["v"]).first()["skewness"] is not None
    assert Q.outlier_counts(df, ["v"]).first()["n_outliers"] == 1


def test_validate_with_approx_quantiles(spark):
    from tabforge.spec import QualitySpec
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v), int(i % 5 == 0)) for i, v in enumerate(rng.normal(size=2000))], "v double, y int")
    spec = QualitySpec(expected_columns=["v", "y"], numeric_cols=["v"], categorical_cols=[], target="y",
                       outlier_cols=["v"], quantile_method="approx")
    rep = {(r["check"], r["column"]): r for r in Q.validate(df, spec).collect()}
    exact = Q.outlier_counts(df, ["v"]).first()["n_outliers"]
    assert abs(rep[("6_outliers", "v")]["value"] - exact) <= 3


def test_exact_quantiles_by_group(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.lognormal(2, 1, 4000), 2)
    g = rng.integers(0, 3, 4000)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)], "g int, v double")
    got = {r["g"]: (r["q1"], r["q3"]) for r in
           O.exact_quantiles(df, ["v"], [0.25, 0.75], by=["g"], names=["q1", "q3"]).collect()}
    for k in range(3):
        want = np.quantile(x[g == k], [0.25, 0.75])
        assert np.allclose(got[k], want, atol=1e-9)


def test_empty_table_edge_cases(spark):
    """Empty input: checks report zero or null, filters keep nothing, the scaler refuses."""
    from tabforge.operators import clean as CL
    from tabforge.operators import features as FE
    from tabforge.spec import QualitySpec
    e = spark.createDataFrame([], "id bigint, x double, y double, label int")
    oc = Q.outlier_counts(e, ["x"]).first()
    assert oc["n_outliers"] == 0 and oc["lower"] is None and oc["passed"]
    spec = QualitySpec(expected_columns=e.columns, numeric_cols=["x", "y"], categorical_cols=[], target="label",
                       outlier_cols=["x", "y"])
    rep = Q.validate(e, spec)
    assert {r["check"] for r in rep.collect()} >= {"1_schema", "2_nulls", "6_outliers"}
    assert CL.remove_outliers(e, ["x", "y"]).count() == 0
    assert CL.remove_outliers(e, ["x", "y"], mode="independent").count() == 0
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in P.corr_matrix(e, ["x", "y"]).collect()}
    assert corr[("x", "x")] is None and corr[("x", "y")] is None
    with pytest.raises(ValueError, match="no values"):
        FE.fit_standard_scaler(e, ["x"])


def test_all_null_column_fences_remove_every_row(spark):
    """A column without values has no fences (NaN quartiles in pandas): no row passes its filter."""
    from tabforge.operators import clean as CL
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None), (3, 3.0, None)], "id int, x double, y double")
    assert CL.remove_outliers(df, ["x"]).count() == 3
    assert CL.remove_outliers(df, ["x", "y"]).count() == 0
    assert Q.outlier_counts(df, ["y"]).first()["n_outliers"] == 0


def test_corr_diagonal_null_for_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in P.corr_matrix(df, ["x", "c"]).collect()}
    assert corr[("x", "x")] == 1.0 and corr[("c", "c")] is None


def test_pearson_constant_and_pairwise_complete(spark):
    """Constant columns give null instead of an ANSI division error; rows with a missing side are skipped."""
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, None), (4.0, 5.0, 8.0), (None, 5.0, 1.0), (3.0, 5.0, 7.0)],
                               "x double, c double, y double")
    r = df.agg(S.pearson("x", "c").alias("xc"), S.pearson("x", "y").alias("xy")).first()
    assert r["xc"] is None
    xs, ys = np.array([1.0, 4.0, 3.0]), np.array([2.0, 8.0, 7.0])
    assert abs(r["xy"] - np.corrcoef(xs, ys)[0, 1]) < 1e-12
    lk = Q.leakage_check(df, ["c"], "x").first()
    assert lk["present"] and lk["corr"] is None


def test_histogram_constant_column_centres_the_value(spark):
    """numpy widens a zero range to [v - 0.5, v + 0.5]: all values land in the middle bin."""
    df = spark.createDataFrame([(5.0,)] * 7, "x double")
    h = P.histogram(df, "x", 10).orderBy("bin").collect()
    counts, edges = np.histogram(np.full(7, 5.0), bins=10)
    assert [r["n"] for r in h] == counts.tolist()
    assert abs(h[0]["left"] - edges[0]) < 1e-12 and abs(h[-1]["right"] - edges[-1]) < 1e-12


def test_nan_is_missing_in_counts_bins_and_scaler(spark):
    """NaN is skipped like in pandas, although Spark orders NaN above every number."""
    from tabforge.operators import features as FE
    nan = float("nan")
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0, 100.0, nan, nan, None]], "x double")
    oc = Q.outlier_counts(df, ["x"]).first()
    assert (oc["lower"], oc["upper"], oc["n_outliers"]) == (-1.0, 7.0, 1)
    h = P.histogram(df, "x", 4).orderBy("bin").collect()
    counts, edges = np.histogram(np.array([1.0, 2.0, 3.0, 4.0, 100.0]), bins=4)
    assert [r["n"] for r in h] == counts.tolist() and h[-1]["right"] == edges[-1]
    m, s = FE.fit_standard_scaler(df, ["x"])["x"]
    ref = np.array([1.0, 2.0, 3.0, 4.0, 100.0])
    assert abs(m - ref.mean()) < 1e-12 and abs(s - ref.std()) < 1e-12
    d = P.density(df, "x", 5).collect()
    assert len(d) == 5 and all(r["density"] == r["density"] for r in d)


def test_input_version_stable_and_follows_input(spark, tmp_path):
    from tabforge.sources import io as IO
    p = str(tmp_path / "t")
    spark.range(10).write.parquet(p)
    v1, v2 = IO.input_version(spark, p), IO.input_version(spark, p)
    assert v1 == v2
    spark.range(20).write.mode("overwrite").parquet(p)
    assert IO.input_version(spark, p) != v1


def test_single_class_input(spark):
    """One class: AUC and F score are undefined (null), imbalance is 100 % with no rebalancing."""
    from tabforge.operators import features as FE
    from tabforge.operators import metrics as M
    df = spark.createDataFrame([(i, float(i % 5), 1, 1, float(i)) for i in range(20)],
                               "id bigint, x double, label int, prediction int, score double")
    assert M.roc_auc(df).first()["roc_auc"] is None
    assert FE.anova_f(df, ["x"], "label").first()["f_score"] is None
    im = Q.imbalance(df, "label").first()
    assert im["minority_pct"] == 100.0 and im["passed"] and not im["rebalance_needed"]
    rep = {r["cls"]: r for r in M.class_report(df).collect()}
    assert rep["1"]["f1"] == 1.0 and rep["macro avg"]["support"] == 20


def test_drift_with_an_empty_side_is_undefined_not_an_error(spark):
    """An empty (or all-null) reference or current set gives null distances, no ANSI division error,
    and no column counted as drifted."""
    from tabforge.operators import drift as D
    full = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(50)], "x double, cat string")
    empty = spark.createDataFrame([], full.schema)
    for ref, cur in ((empty, full), (full, empty)):
        num = D.numeric_drift_stats(ref, cur, ["x"]).first()
        assert num["ks_stat"] is None and num["wasserstein"] is None and num["wasserstein_norm"] is None
        assert D.js_distance(ref, cur, ["cat"]).first()["js_distance"] is None
        cols, summary = D.drift_report(ref, cur, ["x"], ["cat"], "library")
        assert summary.first()["n_drifted"] == 0


def test_anova_f_stable_under_a_large_offset(spark):
    """F does not change when every value is shifted; the stable form keeps it at 1e9 offsets,
    where the sums-of-squares form cancels to noise."""
    from tabforge.operators import features as FE
    rng = np.random.default_rng(7)
    y = rng.integers(0, 3, 3000)
    v = rng.normal(0, 1, 3000) + 0.2 * y
    df = spark.createDataFrame([(int(a), float(b), float(b) + 1e9) for a, b in zip(y, v)], "y int, v double, big double")
    f = {r["feature"]: r["f_score"] for r in FE.anova_f(df, ["v", "big"], "y").collect()}
    groups = [v[y == c] for c in range(3)]
    grand = v.mean()
    ssb = sum(len(g) * (g.mean() - grand) ** 2 for g in groups)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
    expect = (ssb / 2) / (ssw / (len(v) - 3))
    assert abs(f["v"] - expect) < 1e-9 * expect
    assert abs(f["big"] - expect) < 1e-5 * expect


def test_lookups_same_rows_broadcast_or_shuffled(spark, monkeypatch):
    """Alias maps above the inline size and anti-join domains give the same rows whether they are
    broadcast or, beyond the row/byte limits, shuffled."""
    df = spark.createDataFrame([(i, f" K{i} ") for i in range(0, 30000, 7)] + [(-1, "nope")], "id int, v string")
    mapping = {f"k{i}": f"c{i % 3}" for i in range(25000)}
    dom = spark.createDataFrame([(f"K{i}",) for i in range(0, 30000, 14)], "v string")
    def run():
        a = sorted((r["id"], r["v2"], len(r["errors"])) for r in C.map_lookup(df, "v", mapping, out="v2").collect())
        b = sorted(r["id"] for r in C.outside_domain(df.withColumn("v", F.trim("v")), "v", dom).collect())
        return a, b
    bcast = run()
    monkeypatch.setattr(C, "MAX_BROADCAST_BYTES", 0)
    assert run() == bcast
    a, b = bcast
    assert (-1, None, 1) in a and sum(1 for x in a if x[1] is None) == 1 + sum(1 for i in range(0, 30000, 7) if i >= 25000)
    assert -1 in b and 14 not in b and 7 in b


def test_large_encoder_joined_without_collect_matches_dict(spark, monkeypatch):
    """Above the inline size a DataFrame encoder is joined as a table (broadcast within the byte
    bound, shuffled beyond it); codes and the -1 for unknown values equal the dict path."""
    vals = [f"v{i:05d}" for i in range(12000)]
    train = spark.createDataFrame([(v,) for v in vals], "c string")
    enc = EN.fit_label_encoder(train, ["c"])
    df = spark.createDataFrame([(i, vals[i * 7 % 12000]) for i in range(3000)] + [(-1, "unseen")], "id int, c string")
    as_dict = EN.collect_encoder(enc)
    want = sorted(tuple(r) for r in EN.apply_label_encoder(df, as_dict).collect())
    assert sorted(tuple(r) for r in EN.apply_label_encoder(df, enc).collect()) == want
    monkeypatch.setattr(EN, "MAX_BROADCAST_BYTES", 0)
    assert sorted(tuple(r) for r in EN.apply_label_encoder(df, enc).collect()) == want
    assert (-1, -1) in want and (0, 0) in want
