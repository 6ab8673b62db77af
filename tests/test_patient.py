"""The reference's own table shape (16 columns, text target) through the generic operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import encode as EN
from tabforge.operators import ordered as O
from tabforge.operators import profile as P
from tabforge.operators import quality as Q
from tabforge.plans import pipelines as PL
from tabforge.spec import (PATIENT_CATEGORICAL, PATIENT_COLUMNS, PATIENT_QUALITY, PATIENT_TARGET_MAPPING, TrainSpec)


@pytest.fixture(scope="module")
def patients(spark):
    rng = np.random.default_rng(5)
    n = 240
    rows = []
    for i in range(n):
        dead = rng.random() < 0.18
        rows.append((
            int(rng.integers(30, 70)), str(rng.choice(["White", "Black", "Other"])),
            str(rng.choice(["Married", "Single", "Divorced"])), str(rng.choice(["T1", "T2", "T3"])),
            str(rng.choice(["N1", "N2"])), str(rng.choice(["IIA", "IIB", "IIIA"])),
            str(rng.choice(["Well differentiated", "Poorly differentiated"])), str(rng.choice(["1", "2", "3"])),
            str(rng.choice(["Regional", "Distant"])), int(rng.lognormal(3, 0.6)) + (40 if dead else 0),
            str(rng.choice(["Positive", "Negative"])), str(rng.choice(["Positive", "Negative"])),
            int(rng.integers(1, 30)), int(rng.integers(1, 5)) + (6 if dead else 0), int(rng.integers(1, 100)),
            "Dead" if dead else "Alive"))
    schema = ", ".join(f"{c} {'int' if c in ('age', 'tumor_size', 'regional_node_examined', 'regional_node_positive', 'survival_months') else 'string'}"
                       for c in PATIENT_COLUMNS)
    return spark.createDataFrame(rows, schema)


def test_positional_rename_from_title_case(spark, patients):
    raw = patients.toDF(*[c.replace("_", " ").title() for c in PATIENT_COLUMNS])
    back = PL.ingest(raw, names=PATIENT_COLUMNS)
    assert back.columns == PATIENT_COLUMNS and back.count() == patients.dropDuplicates().count()


def test_patient_validation_report(spark, patients):
    rep = {(r["check"], r["column"], r["metric"]): r for r in Q.validate(patients, PATIENT_QUALITY).collect()}
    assert rep[("1_schema", None, "n_expected")]["passed"]
    assert rep[("2_nulls", "age", "null_count")]["value"] == 0
    im = rep[("4_imbalance", "status", "minority_pct")]
    share = patients.where("status = 'Dead'").count() / patients.count()
    assert im["value"] == round(share * 100, 2) and im["passed"] == (share >= 0.2)
    assert ("8_leakage", "survival_months", "corr_with_target") in rep
    assert all(rep[("7_datatypes", c, "unparsable")]["passed"] for c in PATIENT_CATEGORICAL)


def test_missing_column_raises(spark, patients):
    with pytest.raises(ValueError, match="Schema validation failed"):
        Q.validate(patients.drop("grade"), PATIENT_QUALITY)


def test_patient_transform_and_training(spark, patients):
    spec = TrainSpec(features=[c for c in PATIENT_COLUMNS if c not in ("survival_months", "status")],
                     categorical=[c for c in PATIENT_CATEGORICAL if c != "status"], target="status", id_col="pid",
                     outlier_cols=["tumor_size", "regional_node_examined", "regional_node_positive"],
                     skewed_cols=["tumor_size", "regional_node_positive"], drop_cols=["survival_months"], top_k=10,
                     models=("random_forest",), cv_folds=3, resample_after_split=False)
    df = patients.withColumn("pid", F.monotonically_increasing_id())
    prep = PL.transform(df, spec, target_mapping=PATIENT_TARGET_MAPPING)
    t = prep.table
    counts = {r["status"]: r["count"] for r in t.groupBy("status").count().collect()}
    assert counts[0] == counts[1]  # rebalanced in the reference order
    fs = PL.features(prep, spec)
    assert len(fs.selected) == 10
    assert fs.train.count() + fs.test.count() == t.count()


def test_approx_quantiles_close_to_exact(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=5000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    a = O.approx_quantiles(df, ["v"], [0.25, 0.75], accuracy=100000, names=["q1", "q3"]).first()
    e = np.quantile(x, [0.25, 0.75])
    assert abs(a["q1"] - e[0]) < 0.01 and abs(a["q3"] - e[1]) < 0.01


def test_one_hot_and_pair_sample(spark, patients):
    enc = EN.fit_label_encoder(patients, ["race"])
    oh = EN.one_hot(patients.select("race"), ["race"], enc)
    assert set(oh.columns) == {"race", "race=Black", "race=Other", "race=White"}
    assert oh.where(F.col("race=Black") + F.col("race=Other") + F.col("race=White") != 1).count() == 0
    df = patients.withColumn("pid", F.monotonically_increasing_id())
    s = P.pair_sample(df, ["age", "tumor_size"], "status", "pid", n_per_class=10)
    assert {r["status"]: r["count"] for r in s.groupBy("status").count().collect()} == {"Alive": 10, "Dead": 10}
