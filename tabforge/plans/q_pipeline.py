"""Registered queries: composed pipelines (L1-L7), sources/sinks (S1-S11), scoring (L6, ST1, ST2).

Scoring, streaming, monitoring and evaluation run a fixed model whose stages are
SQL with coefficients as literals, so DuckDB computes the same classes. A
trained model's numbers depend on the trainer, so there the queries return checks
of its results (counts, ranges, the choice of the best).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import models as MO
from ..operators import quality as Q
from ..operators import split as SP
from ..session import materialize, scratch_path
from ..sources import io as IO
from ..spec import QualitySpec, ScoringSpec, TrainSpec
from ..streaming import scoring as STR
from . import pipelines as PL
from .q_ml import _QUOTA_SQL
from .registry import register
from .tables import DOC_ALL_SQL, DOC_FEATURES_SQL, DOC_NUMERIC, DOC_RAW_SQL, doc_all, doc_raw, read, with_

# Our alias map for language codes in scoring input (canonical = the code used in training).
LANG_CODES = {"en": "en", "english": "en", "de": "de", "german": "de", "deutsch": "de", "fr": "fr",
              "french": "fr", "es": "es", "spanish": "es"}

DOC_QUALITY = QualitySpec(
    expected_columns=["doc_id", "lang", "source", "n_chars", "n_words", "n_lines", "n_digits", "quality", "toxic"],
    numeric_cols=list(DOC_NUMERIC), categorical_cols=["lang", "source"], target="quality",
    outlier_cols=list(DOC_NUMERIC), leakage_cols=["toxic"])

DOC_TRAIN = TrainSpec(
    features=["n_chars", "n_words", "n_lines", "n_digits", "lang", "source"], categorical=["lang", "source"],
    target="quality", id_col="doc_id", outlier_cols=["n_chars", "n_words", "n_digits"],
    skewed_cols=["n_chars", "n_digits"], drop_cols=["toxic"], top_k=4)

DOC_SCORING = ScoringSpec(
    numeric_fields=list(DOC_NUMERIC), alias_maps={"lang": LANG_CODES},
    ranges={"n_chars": (1, 30000), "n_words": (1, 6000), "n_lines": (1, 2000), "n_digits": (0, 30000)},
    cross_field=[("n_words", "n_chars"), ("n_digits", "n_chars")],
    class_names={0: "low", 1: "high"}, warning_text="Low confidence — additional review recommended")

KNOWN_SOURCES = [f"src{i}" for i in range(20)]
FIXED_SCORING = ScoringSpec(**{**DOC_SCORING.__dict__, "categories": {"source": KNOWN_SOURCES}})

# Coefficients of the fixed model, the same text in Spark and DuckDB.
_FIXED_Z = ("CAST(0.004 AS DOUBLE) * CAST(n_words AS DOUBLE) - CAST(0.9 AS DOUBLE) + "
            "CASE lang WHEN 'en' THEN CAST(0.2 AS DOUBLE) WHEN 'de' THEN CAST(-0.2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END")
_FIXED_P = f"1 / (1 + exp(-({_FIXED_Z})))"


def fixed_model(spark) -> PipelineModel:
    """A logistic model with given coefficients as a saved and reloaded ``PipelineModel``."""
    model = PipelineModel(stages=[
        SQLTransformer(statement=f"SELECT *, {_FIXED_P} AS _p1 FROM __THIS__"),
        SQLTransformer(statement="SELECT *, array(1 - _p1, _p1) AS probability, CASE WHEN _p1 > 0.5D THEN 1D ELSE 0D END AS prediction "
                                 "FROM __THIS__")])
    path = scratch_path(spark, "fixed-model")
    MO.save(model, path)
    return MO.load(path)


def trained(spark, sf):
    """L5 with all stages over the labelled documents."""
    return PL.train_pipeline(doc_raw(spark, sf), DOC_TRAIN, quality=DOC_QUALITY)


def raw_scoring_input(spark, sf):
    """Scoring records as text, the way a form or file delivers them: every document. Some have a source that no
    model has seen, some have none."""
    d = doc_all(spark, sf)
    source = F.when(F.col("doc_id") % 50 == 7, "NEVER_SEEN").when(F.col("doc_id") % 50 != 9, F.col("source"))
    return d.select("doc_id", *[F.col(c).cast("string").alias(c) for c in DOC_NUMERIC],
                    F.upper(F.col("lang")).alias("lang"), source.alias("source"))


_WS = r"[ \t\n\r\f\x0B]"


def _strip(c):
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


@register("l1_ingest", f"SELECT DISTINCT {_strip('text')} AS text, {_strip('lang')} AS lang, {_strip('source')} AS source "
                       "FROM documents")
def l1_ingest(spark, sf):
    return PL.ingest(read(spark, sf, "documents").select("text", "lang", "source"))


def _l2_sql():
    cols = DOC_QUALITY.expected_columns
    num = DOC_NUMERIC
    parts = ["SELECT '1_schema' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", 'n_expected' AS metric, "
             "CAST(9 AS DOUBLE) AS value, true AS passed"]
    parts += [f"SELECT '2_nulls', '{c}', 'null_count', CAST(count_if({c} IS NULL) AS DOUBLE), count_if({c} IS NULL) = 0 "
              f"FROM doc_raw" for c in cols]
    parts.append("SELECT '3_duplicates', NULL, 'duplicate_count', CAST(coalesce(sum(n - 1), 0) AS DOUBLE), "
                 "coalesce(sum(n - 1), 0) = 0 FROM (SELECT count(*) AS n FROM doc_raw GROUP BY ALL_COLS)".replace(
                     "ALL_COLS", ", ".join(cols)))
    parts.append("SELECT '4_imbalance', 'quality', 'minority_pct', round(round((mn / t) * 100, 2), 6), mn / t >= 0.2 "
                 "FROM (SELECT min(n) FILTER (WHERE quality IS NOT NULL) AS mn, sum(n) AS t FROM "
                 "(SELECT quality, count(*) AS n FROM doc_raw GROUP BY quality))")
    parts += [f"SELECT '5_skewness', '{c}', 'skewness', round(round(skewness(CAST({c} AS DOUBLE)), 2), 6), "
              f"abs(round(skewness(CAST({c} AS DOUBLE)), 2)) <= 1.0 FROM doc_raw" for c in num]
    parts += [f"SELECT '6_outliers', '{c}', 'n_outliers', CAST(count_if(CAST(d.{c} AS DOUBLE) < f.lower OR "
              f"CAST(d.{c} AS DOUBLE) > f.upper) AS DOUBLE), count_if(CAST(d.{c} AS DOUBLE) < f.lower OR "
              f"CAST(d.{c} AS DOUBLE) > f.upper) = 0 FROM doc_raw d, fences f WHERE f.\"column\" = '{c}'" for c in num]
    parts += [f"SELECT '7_datatypes', '{c}', 'unparsable', CAST(0 AS DOUBLE), true" for c in num + ["lang", "source"]]
    parts.append("SELECT '8_leakage', 'toxic', 'corr_with_target', round(corr(CAST(toxic AS DOUBLE), "
                 "CAST(quality AS DOUBLE)), 6), true FROM doc_raw")
    fences = ("fences AS (SELECT \"column\", q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM ("
              + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, "
                                   f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM doc_raw" for c in num) + "))")
    return with_(DOC_RAW_SQL, fences) + "\nUNION ALL ".join(parts)


@register("l2_validation_report", _l2_sql())
def l2_validation_report(spark, sf):
    return PL.validate(doc_raw(spark, sf), DOC_QUALITY)


def _l3_sql():
    from .q_resample import smote_sql

    def fence(src, col, name):
        q = lambda p: f"quantile_cont(CAST({col} AS DOUBLE), {p})"
        return (f"{name} AS (SELECT {q(0.25)} - 1.5 * ({q(0.75)} - {q(0.25)}) AS lo, "
                f"{q(0.75)} + 1.5 * ({q(0.75)} - {q(0.25)}) AS hi FROM {src})")
    ctes = [DOC_RAW_SQL, fence("doc_raw", "n_chars", "f1"),
            "s1 AS (SELECT d.* FROM doc_raw d, f1 WHERE CAST(d.n_chars AS DOUBLE) BETWEEN f1.lo AND f1.hi)",
            fence("s1", "n_words", "f2"),
            "s2 AS (SELECT d.* FROM s1 d, f2 WHERE CAST(d.n_words AS DOUBLE) BETWEEN f2.lo AND f2.hi)",
            fence("s2", "n_digits", "f3"),
            "s3 AS (SELECT d.* FROM s2 d, f3 WHERE CAST(d.n_digits AS DOUBLE) BETWEEN f3.lo AND f3.hi)",
            """lv AS (SELECT "column", value, dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS code FROM (
                 SELECT DISTINCT 'lang' AS "column", lang AS value FROM s3 WHERE lang IS NOT NULL
                 UNION ALL SELECT DISTINCT 'source', source FROM s3 WHERE source IS NOT NULL))""",
            """prep AS (SELECT s3.doc_id, CAST(s3.quality AS INTEGER) AS quality,
                 CASE WHEN CAST(n_chars AS DOUBLE) > -1 THEN ln(1 + CAST(n_chars AS DOUBLE)) END AS f_n_chars,
                 CAST(n_words AS DOUBLE) AS f_n_words, CAST(n_lines AS DOUBLE) AS f_n_lines,
                 CASE WHEN CAST(n_digits AS DOUBLE) > -1 THEN ln(1 + CAST(n_digits AS DOUBLE)) END AS f_n_digits,
                 CAST(coalesce(a.code, -1) AS DOUBLE) AS f_lang, CAST(coalesce(b.code, -1) AS DOUBLE) AS f_source
               FROM s3 LEFT JOIN lv a ON a."column" = 'lang' AND a.value = s3.lang
               LEFT JOIN lv b ON b."column" = 'source' AND b.value = s3.source WHERE s3.quality IS NOT NULL)"""]
    feats = ["f_n_chars", "f_n_words", "f_n_lines", "f_n_digits", "f_lang", "f_source"]
    # counts and codes are integers, also in synthetic rows (cut towards zero)
    whole = {"f_n_words": "BIGINT", "f_n_lines": "BIGINT", "f_lang": "INTEGER", "f_source": "INTEGER"}
    rnd = ", ".join(f"CAST(trunc({c}) AS {whole[c]}) AS {c}" if c in whole else f"round({c}, 6) AS {c}" for c in feats)
    return (with_(*ctes) + smote_sql("prep", "doc_id", "quality", feats)
            + f"\nSELECT doc_id, quality, {rnd}, false AS is_synthetic FROM prep"
            + f"\nUNION ALL SELECT doc_id, CAST(quality AS INTEGER), {rnd}, is_synthetic FROM gen")


_L4_TRAIN = _l3_sql().split("),\nlv AS", 1)[0].split("doc_raw AS", 1)[1].split("),\n", 1)[1] + """),
kept AS (SELECT doc_id, quality FROM s3 WHERE quality IS NOT NULL),
""" + _QUOTA_SQL.replace("doc_raw", "kept").replace(", n_chars", "").replace(", rk.n_chars", "").replace("splits AS", "splits4 AS")


@register("l3_transform", _l3_sql())
def l3_transform(spark, sf):
    spec = TrainSpec(**{**DOC_TRAIN.__dict__, "resample_after_split": False})
    return PL.transform(doc_raw(spark, sf), spec).table


_L5_CHECKS = ["rows_add_up", "scores_in_range", "gap_diagnosed", "best_is_highest"]


@register("l5_train_compare", " UNION ALL ".join(
    f"SELECT '{m}' AS model, " + ", ".join(f"true AS {c}" for c in _L5_CHECKS) + ", true AS evaluated, true AS validated"
    for m in DOC_TRAIN.models))
def l5_train_compare(spark, sf):
    """Trains and compares all models; for each one, what must hold of its results whatever the trainer found."""
    t = trained(spark, sf)
    r = t.results.withColumn("top", F.max("cv_mean").over(Window.partitionBy()))
    scores = [f"{p}_{m}" for p in ("train", "test") for m in ("accuracy", "f1", "precision", "recall")] + ["cv_mean"]
    in_range = F.lit(True)
    for c in scores:
        in_range = in_range & F.col(c).between(0, 1)
    ev = t.evaluation.first()
    rows = t.fs.train.count() + t.fs.test.count()
    classes = t.class_report.where(F.col("cls") == "weighted avg").first()
    ok = ev["tn"] + ev["fp"] + ev["fn"] + ev["tp"] == t.fs.test.count() == classes["support"]
    text = F.col("train_accuracy") - F.col("test_accuracy") > 0.1
    return r.select(
        "model", F.lit(ok and rows > 0).alias("rows_add_up"), in_range.alias("scores_in_range"),
        (F.col("diagnosis").startswith("OVERFIT") == text).alias("gap_diagnosed"),
        F.when(F.col("is_best"), F.col("cv_mean") == F.col("top")).otherwise(F.col("cv_mean") <= F.col("top")).alias("best_is_highest"),
        F.lit(t.best == ev["model_name"]).alias("evaluated"), F.lit(t.validation.count() > 0).alias("validated"))


@register("l4_feature_table", with_(DOC_RAW_SQL, _L4_TRAIN) + """
SELECT CAST(n_real AS BIGINT) AS n_real, true AS balanced, true AS scaled, true AS folds_even, CAST(4 AS INTEGER) AS n_selected
FROM (SELECT count(*) AS n_real FROM splits4 WHERE split = 'train')""")
def l4_feature_table(spark, sf):
    """L4 over the labelled documents: the real training rows, and what must hold of the finished table."""
    fs = PL.features(PL.transform(doc_raw(spark, sf), DOC_TRAIN), DOC_TRAIN)
    t, cols = fs.train, [f"s_{c}" for c in fs.selected]
    per = t.groupBy("quality").agg(F.count("*").alias("n"))
    folds = t.groupBy("quality", "fold").agg(F.count("*").alias("n")).groupBy("quality").agg((F.max("n") - F.min("n")).alias("d"))
    scaled = F.lit(True)
    for c in cols:
        scaled = scaled & (F.abs(F.avg(c)) < 1e-6) & (F.abs(F.stddev_pop(c) - 1) < 1e-6)
    a = t.agg(F.count_if(~F.col("is_synthetic")).alias("n_real"), scaled.alias("scaled"))
    b = per.agg((F.min("n") == F.max("n")).alias("balanced"))
    c = folds.agg((F.max("d") <= 1).alias("folds_even"))
    one = F.lit(1).alias("k")  # three one-row tables side by side
    return a.select("*", one).join(b.select("*", one), "k").join(c.select("*", one), "k").select(
        "n_real", "balanced", "scaled", "folds_even", F.lit(len(cols)).alias("n_selected"))


@register("m13_evaluate", with_(DOC_RAW_SQL) + f""",
p AS (SELECT quality AS y, {_FIXED_P} AS p1 FROM doc_raw),
c AS (SELECT count_if(y <> 1 AND p1 <= 0.5) AS tn, count_if(y <> 1 AND p1 > 0.5) AS fp, count_if(y = 1 AND p1 <= 0.5) AS fn,
             count_if(y = 1 AND p1 > 0.5) AS tp FROM p),
g AS (SELECT p1, count_if(y = 1) AS a, count_if(y <> 1) AS b FROM p GROUP BY p1),
u AS (SELECT sum(a * (below + b / 2)) / (sum(a) * sum(b)) AS auc
      FROM (SELECT *, coalesce(sum(b) OVER (ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g))
SELECT round((tp + tn) / (tp + tn + fp + fn), 4) AS accuracy, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 4) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 4) AS f1, tn, fp, fn, tp,
       round(auc, 4) AS roc_auc, tn + fp + fn + tp AS test_samples FROM c, u""")
def m13_evaluate(spark, sf):
    return MO.evaluate(fixed_model(spark), doc_raw(spark, sf), "quality")


@register("m12_s8_reload_predict", with_(DOC_FEATURES_SQL) + f"""
SELECT doc_id, CASE WHEN {_FIXED_P} > 0.5 THEN 1 ELSE 0 END AS prediction FROM doc_features""")
def m12_s8_reload_predict(spark, sf):
    """Predictions of a saved and reloaded pipeline model over every document."""
    return MO.predict(fixed_model(spark), doc_all(spark, sf), keep=["doc_id"]).select("doc_id", "prediction")


_QUAR_NUM = r"^[+-]?(([0-9]+(\.[0-9]*)?)|(\.[0-9]+))([eE][+-]?[0-9]+)?$"


def _scoring_sql() -> str:
    """CTEs: src (records as scored) and checked (with their errors, joined)."""
    lang_case = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_CODES.items())
    valid = ", ".join(sorted(set(LANG_CODES.values())))
    known = ", ".join(f"'{v}'" for v in KNOWN_SOURCES)
    nums = []
    for c in DOC_NUMERIC:
        nums.append(f"CASE WHEN CAST({c} AS VARCHAR) IS NOT NULL AND NOT regexp_matches({_strip(f'CAST({c} AS VARCHAR)')}, "
                    f"'{_QUAR_NUM}') THEN 'number:{c}' END")
    rng = []
    for c, (lo, hi) in DOC_SCORING.ranges.items():
        rng.append(f"CASE WHEN {c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi}) THEN 'range:{c}' END")
    errs = nums + [
        f"CASE WHEN lang_c IS NULL THEN 'invalid:lang:''' || coalesce(lang, 'None') || ''' valid: [{valid}]' END"]
    errs += [f"CASE WHEN {c} IS NULL THEN 'missing:{n}' END" for c, n in [(c, c) for c in DOC_NUMERIC] + [("lang_c", "lang"), ("source", "source")]]
    errs += [f"CASE WHEN source NOT IN ({known}) THEN 'invalid:source:''' || source || ''' not one of {len(KNOWN_SOURCES)} known values' END"]
    errs += rng
    errs += [f"CASE WHEN {a} > {b} THEN 'cross:{a}>{b}' END" for a, b in DOC_SCORING.cross_field]
    return with_(DOC_FEATURES_SQL) + f""",
src AS (SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS n_chars, CAST(d.n_words AS DOUBLE) AS n_words,
               CAST(d.n_lines AS DOUBLE) AS n_lines, CAST(d.n_digits AS DOUBLE) AS n_digits, upper(d.lang) AS lang,
               CASE lower({_strip('upper(d.lang)')}) {lang_case} END AS lang_c,
               CASE WHEN doc_id % 50 = 7 THEN 'NEVER_SEEN' WHEN doc_id % 50 <> 9 THEN source END AS source
        FROM doc_features d),
checked AS (SELECT *, concat_ws(';', {', '.join(errs)}) AS errors FROM src)"""


def _scored_sql() -> str:
    """The review of the accepted records by the fixed model."""
    return _scoring_sql() + f""",
ok AS (SELECT doc_id, n_chars, n_words, n_lines, n_digits, lang AS raw_lang, lang_c AS lang, source FROM checked WHERE errors = ''),
p AS (SELECT *, {_FIXED_P} AS p1 FROM ok),
scored AS (SELECT doc_id, n_chars, n_words, n_lines, n_digits, lang, source, raw_lang, CASE WHEN p1 > 0.5 THEN 'high' ELSE 'low' END AS prediction,
       round(greatest(p1, 1 - p1) * 100, 2) AS confidence, round(p1 * 100, 2) AS high_prob, round((1 - p1) * 100, 2) AS low_prob,
       'fixed' AS model_used, round(greatest(p1, 1 - p1) * 100, 2) >= 50 AS high_confidence,
       CASE WHEN round(greatest(p1, 1 - p1) * 100, 2) < 50 THEN 'Low confidence — additional review recommended' END AS warning FROM p)
"""


@register("l6_batch_score", _scored_sql() + "SELECT * FROM scored")
def l6_batch_score(spark, sf):
    scored, _ = PL.score_batch(raw_scoring_input(spark, sf), fixed_model(spark), FIXED_SCORING, "fixed")
    return scored.drop("timestamp", "row_id")


@register("l6_quarantine", _scoring_sql() + "SELECT doc_id, errors FROM checked WHERE errors <> ''")
def l6_quarantine(spark, sf):
    """Rejected records: bad numbers, ranges, rules, and categories that the model has no code for."""
    _, rejected = PL.score_batch(raw_scoring_input(spark, sf), fixed_model(spark), FIXED_SCORING, "fixed")
    return rejected.select("doc_id", F.array_join("errors", ";").alias("errors"))


@register("st1_stream_score", _scored_sql() + "SELECT * FROM scored")
def st1_stream_score(spark, sf):
    """ST1: the scoring input is written as several files and consumed by a checkpointed stream, in two starts."""
    src = raw_scoring_input(spark, sf)
    inbox, model = scratch_path(spark, "stream-inbox"), fixed_model(spark)
    out = scratch_path(spark, "predictions"), scratch_path(spark, "quarantine")
    for half in (0, 1):  # the second start takes up where the first one ended
        src.where(F.col("doc_id") % 2 == half).repartition(2, "doc_id").write.mode("append").parquet(inbox)
        pred, _ = STR.run_scoring_stream(spark, inbox, src.schema, model, FIXED_SCORING, "fixed", *out)
    return pred.drop("timestamp", "query_id", "batch_id", "date", "row_id")


def _monitor_sql() -> str:
    num = "\n  UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v, a, b FROM sets" for c in DOC_NUMERIC)
    cat = "\n  UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, a, b FROM sets"
                                for c in ["lang", "source", "prediction", "quality"])
    return with_(DOC_RAW_SQL, _QUOTA_SQL) + f""",
sets AS (SELECT d.*, CASE WHEN {_FIXED_P} > 0.5 THEN 1 ELSE 0 END AS prediction, CAST(s.split = 'train' AS INTEGER) AS a,
                CAST(s.split = 'test' AS INTEGER) AS b FROM doc_raw d JOIN splits s ON s.doc_id = d.doc_id),
lng AS ({num}),
g AS (SELECT "column", v, sum(a) AS a, sum(b) AS b FROM lng GROUP BY "column", v),
c AS (SELECT "column", v, sum(a) OVER w / sum(a) OVER (PARTITION BY "column") AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY "column") AS fb,
             lead(v) OVER (PARTITION BY "column" ORDER BY v) AS nv
      FROM g WINDOW w AS (PARTITION BY "column" ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
w AS (SELECT "column", coalesce(sum(abs(fa - fb) * (nv - v)), 0) AS w FROM c GROUP BY "column"),
sd AS (SELECT "column", stddev_pop(v) AS s FROM lng WHERE a = 1 GROUP BY "column"),
ct AS ({cat}),
cg AS (SELECT "column", value, sum(a) AS a, sum(b) AS b FROM ct WHERE value IS NOT NULL GROUP BY "column", value),
cs AS (SELECT "column", a / sum(a) OVER (PARTITION BY "column") AS p, b / sum(b) OVER (PARTITION BY "column") AS q FROM cg),
js AS (SELECT "column", sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                                       + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END))) AS js FROM cs GROUP BY "column"),
cols AS (
  SELECT w."column", 'numeric' AS kind, 'wasserstein_norm' AS method, w / CASE WHEN s = 0 THEN 1 ELSE s END AS statistic
  FROM w JOIN sd ON w."column" = sd."column"
  UNION ALL SELECT "column", 'categorical', 'jensen_shannon', js FROM js),
t AS (SELECT count_if(statistic >= 0.1) / count(*) AS share FROM cols)
SELECT "column", kind, method, round(statistic, 6) AS statistic, CAST(0.1 AS DOUBLE) AS threshold, statistic >= 0.1 AS drifted,
       round(share, 6) AS share, CASE WHEN share >= 0.5 THEN 'retrain' ELSE 'skip' END AS decision, 'test data' AS current_source FROM cols, t"""


@register("l7_st2_monitor", _monitor_sql())
def l7_st2_monitor(spark, sf):
    """L7/ST2: reference = training split; current = live predictions, of which there are none, so the test split.
    Drift of numeric and category features, target and prediction."""
    d = doc_raw(spark, sf)
    split = SP.stratified_split(d.select("doc_id", "quality"), "quality", "doc_id", 0.2, 42).select("doc_id", "split")
    d = materialize(d.join(split, "doc_id"), "monitor-input")
    current, source = STR.live_or_fallback(spark, scratch_path(spark, "no-predictions"), d.where("split = 'test'"))
    cols, summary, _ = PL.monitor(d.where("split = 'train'"), current, fixed_model(spark), DOC_NUMERIC, ["lang", "source"], "distances", "quality")
    verdict = summary.first()
    return cols.select("column", "kind", "method", F.round("statistic", 6).alias("statistic"), "threshold", "drifted",
                       F.round(F.lit(verdict["share"]), 6).alias("share"), F.lit(verdict["decision"]).alias("decision"),
                       F.lit(source).alias("current_source"))


@register("s1_csv_roundtrip", with_(DOC_ALL_SQL) + """
SELECT a.doc_id, a.lang, a.source, a.n_chars, a.n_words, a.quality, d.text FROM doc_all a JOIN documents d ON a.doc_id = d.doc_id""")
def s1_csv_roundtrip(spark, sf):
    """Whole texts with their line breaks and quotes through CSV and back."""
    d = doc_all(spark, sf).select("doc_id", "lang", "source", "n_chars", "n_words", "quality").join(
        read(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    path = scratch_path(spark, "csv")
    IO.write_csv(d, path)
    back = IO.read_csv(spark, path, d.schema)
    return back.drop("_corrupt_record")


@register("s2_scan", "SELECT * FROM labels")
def s2_scan(spark, sf):
    return IO.scan(spark, f"{sf.rstrip('/')}/labels.parquet")


@register("s3_s5_write_verify", "SELECT count(*) AS rows_written, count(*) AS rows_read, true AS count_ok FROM lineitem")
def s3_s5_write_verify(spark, sf):
    return IO.write_and_verify(read(spark, sf, "lineitem"), scratch_path(spark, "lineitem-copy"))


@register("s6_cached_dataset", with_(DOC_ALL_SQL) + "SELECT doc_id, n_chars, quality FROM doc_all")
def s6_cached_dataset(spark, sf):
    name = "doc-all"
    base = sf.rstrip("/")
    ver = IO.input_version(spark, f"{base}/documents.parquet", f"{base}/labels.parquet")
    IO.drop_cached(spark, name, ver)
    build = lambda: doc_all(spark, sf).select("doc_id", "n_chars", "quality")
    IO.cached(spark, name, build, version=ver)  # miss
    return IO.cached(spark, name, build, version=ver)  # hit: the stored copy


@register("s7_split_table", with_(DOC_RAW_SQL) + """,
cc AS (SELECT quality AS cls, count(*) AS c FROM doc_raw GROUP BY quality),
tt AS (SELECT sum(c) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(c)) AS BIGINT) AS n_test FROM cc),
a1 AS (SELECT cls, (tt.n - tt.n_test) * c / tt.n AS cont, floor((tt.n - tt.n_test) * c / tt.n) AS fl,
              tt.n - tt.n_test AS draws FROM cc, tt),
a2 AS (SELECT *, draws - sum(fl) OVER () AS need, row_number() OVER (ORDER BY cont - fl DESC, cls DESC) AS rk FROM a1),
tr AS (SELECT cls, fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS n_train FROM a2),
rk AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY
          CAST(('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), '42')), 1, 8)) AS BIGINT), doc_id) - 1 AS r
       FROM doc_raw)
SELECT rk.doc_id, rk.quality, 'test' AS split FROM rk JOIN tr ON rk.quality = tr.cls WHERE rk.r >= tr.n_train""")
def s7_split_table(spark, sf):
    d = SP.stratified_split(doc_raw(spark, sf).select("doc_id", "quality"), "quality", "doc_id", 0.2, 42)
    path = scratch_path(spark, "splits")
    IO.write_splits(d, path)
    return IO.read_split(spark, path, "test").select("doc_id", "quality", "split")


@register("s9_report_sink", _l2_sql())
def s9_report_sink(spark, sf):
    rep = Q.validate(doc_raw(spark, sf), DOC_QUALITY)
    path = scratch_path(spark, "reports")
    IO.write_report(rep, path)
    return spark.read.json(path).drop("timestamp", "run_id")


@register("s10_s4_prediction_history", _scored_sql() + """
SELECT doc_id, prediction, confidence, CAST(run AS INTEGER) AS run, date = current_date AS of_today FROM scored, range(1, 3) AS r(run),
       (SELECT current_date AS date)""")
def s10_s4_prediction_history(spark, sf):
    """Append scored rows twice (two runs) by date, export the history as CSV and read it back."""
    scored, _ = PL.score_batch(raw_scoring_input(spark, sf), fixed_model(spark), FIXED_SCORING, "fixed")
    hist = scratch_path(spark, "history")
    flat = scored.select("doc_id", "prediction", "confidence", F.to_date("timestamp").alias("date"))
    for run in (1, 2):
        IO.append(flat.withColumn("run", F.lit(run)), hist, ["date"])
    out = scratch_path(spark, "history-csv")
    IO.write_csv(spark.read.parquet(hist), out)
    back = IO.read_csv(spark, out, "doc_id bigint, prediction string, confidence double, run int, date date")
    return back.select("doc_id", "prediction", "confidence", "run", (F.col("date") == F.current_date()).alias("of_today"))


_RULES = {"long_texts": 500, "longer_texts": 1500}
_RATIOS = {"accuracy": ("tp + tn", "tp + tn + fp + fn"), "precision": ("tp", "tp + fp"), "recall": ("tp", "tp + fn"), "f1": ("2 * tp", "2 * tp + fp + fn")}


def _tracking_sql() -> str:
    one = []
    for name, cut in _RULES.items():
        cols = [f"max(CASE WHEN split = '{s}' THEN round(CASE WHEN {b} = 0 THEN 0 ELSE ({a}) / ({b}) END, 4) END) AS {s}_{m}"
                for s in ("train", "test") for m, (a, b) in _RATIOS.items()]
        one.append(f"""SELECT '{name}' AS run_id, 'training' AS parent_run_id, {", ".join(cols)}, '{cut}' AS param_cut
FROM (SELECT split, count_if(quality <> 1 AND n_chars <= {cut}) AS tn, count_if(quality <> 1 AND n_chars > {cut}) AS fp,
             count_if(quality = 1 AND n_chars <= {cut}) AS fn, count_if(quality = 1 AND n_chars > {cut}) AS tp FROM splits GROUP BY split)""")
    return with_(DOC_RAW_SQL, _QUOTA_SQL) + "\nUNION ALL ".join(one)


@register("s11_run_tracking", _tracking_sql())
def s11_run_tracking(spark, sf):
    """Two rules as runs under one parent: all parameters, and all metrics on both splits."""
    d = materialize(SP.stratified_split(doc_raw(spark, sf).select("doc_id", "quality", "n_chars"), "quality", "doc_id", 0.2, 42), "tracking")
    path = scratch_path(spark, "runs")
    for name, cut in _RULES.items():
        ruled = d.select("split", F.col("quality").alias("label"), (F.col("n_chars") > cut).cast("int").alias("prediction"))
        m = {r["split"]: r for r in M.binary_metrics(ruled, by=["split"]).collect()}
        IO.log_run(spark, path, name, "metric", {f"{s}_{k}": m[s][k] for s in ("train", "test") for k in _RATIOS}, "training")
        IO.log_run(spark, path, name, "param", {"param_cut": cut}, "training")
    wide = IO.runs_wide(spark, path, "metric")
    wide = wide.select("run_id", "parent_run_id", *[F.col(f"{s}_{k}").cast("double").alias(f"{s}_{k}") for s in ("train", "test") for k in _RATIOS])
    return wide.join(IO.runs_wide(spark, path, "param").select("run_id", "param_cut"), "run_id")
