"""Tables that grow while they are read: event counts with state, day summaries, atomic publish."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import drift as D
from tabforge.operators import summaries as SU
from tabforge.session import materialize, scratch_path
from tabforge.sources import io as IO
from tabforge.sources import publish as PB
from tabforge.streaming import events as EV
from tabforge.streaming import scoring as STR

T0 = dt.datetime(2024, 1, 10, 12)


def _events(spark, rows):
    return spark.createDataFrame([(i, T0 + dt.timedelta(hours=h) if h is not None else None, k) for i, h, k in rows], "id bigint, at timestamp, kind string")


def test_repeats_late_rows_and_restarts(spark):
    inbox, path = scratch_path(spark, "in"), scratch_path(spark, "counts")

    def arrive(rows):
        df = _events(spark, rows)
        df.coalesce(1).write.mode("append").parquet(inbox)
        got = EV.run_day_counts(spark, inbox, df.schema, path, "id", "at", ["kind"], "24 hours")
        return {(r["day"].day, r["kind"]): r["n"] for r in got.collect()}

    assert arrive([(1, 0, "a"), (1, 0, "a"), (2, 1, "a"), (3, 30, None), (None, 1, "b"), (None, 1, "b"), (None, 2, "b"), (9, None, "a")]) == {
        (10, "a"): 2, (11, None): 1, (10, "b"): 2}
    # the watermark stands at hour 6: hour 7 is late but counts, hour 5 is too late, and id 3 is known from the last start
    assert arrive([(4, 7, "a"), (5, 5, "a"), (3, 30, None), (6, 31, None)]) == {(10, "a"): 3, (11, None): 2, (10, "b"): 2}
    assert arrive([]) == {(10, "a"): 3, (11, None): 2, (10, "b"): 2}


def test_a_replayed_batch_replaces_its_revision(spark):
    inbox, path = scratch_path(spark, "in"), scratch_path(spark, "counts")
    df = _events(spark, [(1, 0, "a"), (2, 1, "a")])
    df.write.parquet(inbox)
    for _ in range(2):  # the second query has lost its checkpoint and plays the batch again
        got = EV.run_day_counts(spark, inbox, df.schema, path, "id", "at", ["kind"], "1 day", {"last": F.max("id")},
                                checkpoint_path=scratch_path(spark, "lost"))
        assert [tuple(r) for r in got.select("kind", "n", "last").collect()] == [("a", 2, 2)]


@pytest.mark.parametrize("k", [64, 4096])
def test_summaries_of_days_are_within_their_bound(spark, k):
    rng = np.random.default_rng(5)
    rows = [(int(i % 7), float(x) if i % 50 else float("nan"), None if i % 90 == 0 else float(i % 3), "abc"[i % 3] if i % 4 else None)
            for i, x in enumerate(rng.normal(size=3000))]
    df = spark.createDataFrame(rows, "day int, x double, few double, kind string")
    days = materialize(SU.summarize(df, ["day"], ["x", "few"], ["kind"], k), "summaries")
    ref, cur = F.col("day") < 3, F.col("day") >= 3
    got = {r["column"]: r for r in SU.numeric_drift(days.where(ref), days.where(cur), k).collect()}
    for r in D.numeric_drift_stats(df.where(ref), df.where(cur), ["x", "few"]).collect():
        g = got[r["column"]]
        assert (g["n_ref"], g["n_cur"]) == (r["n_ref"], r["n_cur"])
        assert abs(g["ks_stat"] - r["ks_stat"]) <= g["ks_error"] + 1e-12
        assert g["ref_std"] == pytest.approx(r["ref_std"])
        if k == 4096:
            assert g["wasserstein"] == pytest.approx(r["wasserstein"], rel=0.05, abs=2e-3)
    a, b = (x.first() for x in (SU.category_drift(days.where(ref), days.where(cur)), D.js_distance(df.where(ref), df.where(cur), ["kind"])))
    assert a["js_distance"] == pytest.approx(b["js_distance"]) and a["n_levels"] == b["n_levels"] == 3


def test_summaries_of_empty_and_one_sided_columns(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, 2.0, None), (2, None, None)], "day int, x double, kind string")
    days = SU.summarize(df, ["day"], ["x"], ["kind"])
    assert [tuple(r) for r in days.select("day", "column", "n").collect()] == [(1, "x", 2)]
    r = SU.numeric_drift(days.where("day = 1"), days.where("day = 2")).first()
    assert (r["n_ref"], r["n_cur"], r["ks_stat"], r["wasserstein_norm"]) == (2, 0, None, None)
    assert not SU.drift_of_summaries(days.where("day = 1"), days.where("day = 2")).first()["drifted"]
    assert SU.summarize(df.limit(0), [], ["x"], ["kind"]).count() == 0
    with pytest.raises(ValueError):
        SU.summarize(df, ["day"], [])


def test_days_outside_the_range_are_not_read(spark):
    path = scratch_path(spark, "days")
    spark.range(6).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) as date").write.partitionBy("date").parquet(path)
    got = STR.read_days(spark, path, "2024-01-02 10:00:00", "2024-01-04")
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3]
    assert len(got.inputFiles()) == 3
    assert STR.read_days(spark, path, "2025-01-01") is None


def test_a_run_replaces_its_own_rows_and_a_dead_writer_shows_nothing(spark):
    table = scratch_path(spark, "published")
    assert PB.read_published(spark, table) is None
    PB.publish(spark.range(3), table, "a")
    PB.publish(spark.range(10, 12), table, "b")

    @F.udf("bigint")
    def dies(x):
        raise RuntimeError("half way")

    with pytest.raises(Exception, match="half way"):
        PB.publish(spark.range(5).select(dies("id").alias("id")), table, "b")
    ids = lambda: sorted(r["id"] for r in PB.read_published(spark, table).collect())
    assert ids() == [0, 1, 2, 10, 11]
    PB.publish(spark.range(20, 21), table, "b")
    assert ids() == [0, 1, 2, 20]
    PB.publish(spark.range(30, 31).selectExpr("id", "'x' as more"), table, "c")  # a new column is null in older runs
    assert ids() == [0, 1, 2, 20, 30] and "more" in PB.read_published(spark, table).columns
    assert PB.vacuum(spark, table, grace_s=3600) == 0 and PB.vacuum(spark, table, grace_s=0) >= 1
    assert ids() == [0, 1, 2, 20, 30]
    PB.publish(spark.range(1), table, "d", mode="overwrite")
    assert ids() == [0]
    assert PB.flush(spark, table, max_age_s=3600) == 0 and PB.flush(spark, table) == 1
    assert PB.read_published(spark, table) is None


def test_two_writers_at_once_both_stay(spark):
    table, entries = scratch_path(spark, "published"), PB.entries
    PB.publish(spark.range(1), table, "first")
    stale = entries(spark, table)
    answers = [stale]  # the writer reads the version before another one's commit, and must read again

    def behind(s, t):
        return answers.pop() if answers else entries(s, t)

    PB.publish(spark.range(1, 2), table, "other")
    PB.entries = behind
    try:
        PB.publish(spark.range(2, 3), table, "late")
    finally:
        PB.entries = entries
    assert sorted(r["id"] for r in PB.read_published(spark, table).collect()) == [0, 1, 2]


def test_flush_of_cached_copies(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(2)

    for _ in range(2):
        assert IO.cached(spark, "flushed", build).count() == 2
    assert len(calls) == 1
    assert IO.cached(spark, "flushed", build, max_age_s=-1).count() == 2 and len(calls) == 2  # expired
    assert IO.flush_cached(spark) >= 1
    assert IO.cached(spark, "flushed", build).count() == 2 and len(calls) == 3
    assert IO.drop_cached(spark, "flushed") and not IO.drop_cached(spark, "flushed")


def test_fit_verdict_is_data_and_text(spark):
    from tabforge.operators import metrics as M
    d = spark.createDataFrame([(0.95, 0.8), (0.7, 0.75), (0.9, 0.85), (0.79, 0.8), (None, 0.8)], "a double, b double")
    got = [tuple(r) for r in d.select(M.fit_verdict(F.col("a"), F.col("b"))["code"], M.diagnose(F.col("a"), F.col("b"))).collect()]
    assert got == [("overfit", "OVERFIT — train/test gap: 0.1500"), ("underfit", "UNDERFIT — both scores below 0.8"),
                   ("good", "GOOD FIT — train/test gap: 0.0500"), ("good", "GOOD FIT — train/test gap: -0.0100"), (None, None)]
