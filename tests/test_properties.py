"""Property tests: the ordered primitives give the same answer for any bucket count and partitioning."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabforge.operators import ordered as O
from tabforge.operators import split as SP

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(values=st.lists(st.integers(-50, 50), min_size=1, max_size=200), buckets=st.integers(2, 40),
       parts=st.integers(1, 9))
def test_running_sum_any_buckets(spark, values, buckets, parts):
    rows = [(i % 3, float(v), 1) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g int, v double, w bigint").groupBy("g", "v").sum("w") \
        .withColumnRenamed("sum(w)", "w").repartition(parts)
    got = O.running_sum(df, ["v"], ["w"], ["g"], buckets=buckets).toPandas().sort_values(["g", "v"])
    want = got.copy()
    want["cum"] = want.groupby("g")["w"].cumsum()
    assert (got["cum_w"].values == want["cum"].values).all()


@SETTINGS
@given(values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=150),
       p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]))
def test_exact_quantile_any_data(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = O.exact_quantiles(df, ["v"], [p], names=["q"]).first()["q"]
    want = float(np.quantile(np.array(values), p))
    assert abs(got - want) <= 1e-9 * max(1.0, abs(want))


@settings(max_examples=15, deadline=None)
@given(counts=st.dictionaries(st.integers(0, 4), st.integers(1, 500), min_size=1, max_size=5),
       test_size=st.sampled_from([0.1, 0.2, 0.25, 0.33]))
def test_split_quotas_sum_up(counts, test_size):
    q = SP.split_quotas(counts, test_size)
    n = sum(counts.values())
    assert sum(t for _, t in q.values()) == int(np.ceil(test_size * n))
    for k, (a, b) in q.items():
        assert a + b == counts[k] and a >= 0 and b >= 0
    alloc = SP.fold_allocation(counts, 5)
    for k, sizes in alloc.items():
        assert sum(sizes) == counts[k] and max(sizes) - min(sizes) <= 1
