"""Scoring of many records at once (L6 pieces: normalize, validate, predict, review).

A record that fails a rule is not an exception: it gets error entries and is
routed to the quarantine output, while valid records are scored in the same
pass. The model is loaded once per job, not per record.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..spec import ScoringSpec
from . import clean as C
from . import encode as EN


def normalize(df: DataFrame, spec: ScoringSpec, errors: str = "errors") -> DataFrame:
    """Numbers from text (F3) and aliases to canonical values (J1), with error entries."""
    out = df if errors in df.columns else df.withColumn(errors, F.array().cast("array<string>"))
    out = C.parse_numbers(out, [f for f in spec.numeric_fields if f in out.columns], errors)
    for field, mapping in spec.alias_maps.items():
        if field in out.columns:
            out = C.map_lookup(out, field, mapping, out=field, errors=errors)
    return out


def check(df: DataFrame, spec: ScoringSpec, errors: str = "errors") -> DataFrame:
    """Required fields (P9), ranges (P7), cross-field rules."""
    req = list(spec.numeric_fields) + list(spec.alias_maps) + list(spec.categories)
    missing = [f for f in req if f not in df.columns]
    out = df
    if missing:  # a missing column is a data error for every row, not a crash
        for f in missing:
            out = out.withColumn(f, F.lit(None).cast("string"))
    out = C.required_check(out, req, errors)
    for f, values in spec.categories.items():
        out = known_check(out, f, values, errors)
    out = C.range_check(out, spec.ranges, errors)
    return C.cross_field_check(out, spec.cross_field, errors)


def known_check(df: DataFrame, field: str, values: list[str], errors: str = "errors") -> DataFrame:
    """F7, scoring path: a category that the model has no code for is an error (null is left to P9)."""
    src = F.col(field).cast("string")
    msg = F.concat(F.lit(f"invalid:{field}:'"), src, F.lit(f"' not one of {len(set(values))} known values"))
    if len(values) <= EN.MAX_INLINE_LEVELS:
        return C.add_errors(df, [(src.isNotNull() & ~src.isin(list(values)), msg)], errors)
    known = df.sparkSession.createDataFrame([(v,) for v in sorted(set(values))], "_known string")
    if sum(len(v.encode()) + 24 for v in values) <= EN.MAX_BROADCAST_BYTES:
        known = F.broadcast(known)
    out = df.join(known, src == F.col("_known"), "left")
    return C.add_errors(out, [(src.isNotNull() & F.col("_known").isNull(), msg)], errors).drop("_known")


def review(pred: DataFrame, spec: ScoringSpec, model_name: str) -> DataFrame:
    """Class text, confidence and class shares in percent, high-confidence flag, warning."""
    is_vector = isinstance(pred.schema["probability"].dataType, VectorUDT)
    p = vector_to_array("probability") if is_vector else F.col("probability")
    names = F.create_map(*[F.lit(x) for kv in spec.class_names.items() for x in kv])
    conf = F.round(F.array_max(p) * 100.0, 2)
    thr = spec.confidence_threshold * 100
    out = pred.withColumn("prediction", names[F.col("prediction").cast("int")]) \
        .withColumn("confidence", conf) \
        .withColumns({f"{spec.class_names[k].lower()}_prob": F.round(p[k] * 100.0, 2) for k in sorted(spec.class_names, reverse=True)}) \
        .withColumn("model_used", F.lit(model_name)) \
        .withColumn("high_confidence", F.col("confidence") >= F.lit(thr)) \
        .withColumn("warning", F.when(F.col("confidence") < F.lit(thr), F.lit(spec.warning_text))) \
        .withColumn("timestamp", F.current_timestamp())
    return out


def score(df: DataFrame, model: PipelineModel, spec: ScoringSpec, model_name: str,
          errors: str = "errors", keep_raw: bool = True) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected) of a whole table; the checked rows are staged once, nothing stays cached."""
    return _route(materialize(_checked(df, spec, errors, keep_raw), "score-input"), model, spec, model_name, errors)


def score_with_handle(df: DataFrame, model: PipelineModel, spec: ScoringSpec, model_name: str,
                      errors: str = "errors", keep_raw: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scored, rejected, checked) for a micro-batch; the caller unpersists ``checked``."""
    x = _checked(df, spec, errors, keep_raw).persist(StorageLevel.MEMORY_AND_DISK)
    return (*_route(x, model, spec, model_name, errors), x)


def _checked(df: DataFrame, spec: ScoringSpec, errors: str, keep_raw: bool) -> DataFrame:
    """Normalized and checked records. ``row_id``, if the input has none, is a hash of the content and the row's
    own number in the input, so equal records have ids of their own."""
    base = df
    if "row_id" not in base.columns:
        content = F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256)
        base = base.withColumn("row_id", F.concat_ws("-", content, F.monotonically_increasing_id().cast("string")))
    if keep_raw:
        for f in spec.alias_maps:
            if f in base.columns:
                base = base.withColumn(f"raw_{f}", F.col(f).cast("string"))
    return check(normalize(base, spec, errors), spec, errors)


def _route(x: DataFrame, model: PipelineModel, spec: ScoringSpec, model_name: str, errors: str) -> tuple[DataFrame, DataFrame]:
    """Rejected rows keep their raw input and the error list; scored rows keep the normalized input (and a raw
    copy of changed text fields), then the review columns. ``x`` is stored: one pass over the input feeds both,
    and the routing filter is not pushed below the projections, which would compute them once per use."""
    ok, bad = C.split_rejected(x, errors)
    pred = model.transform(ok)
    extra = [c for c in pred.columns if c not in ok.columns and c not in ("prediction", "probability")]
    pred = pred.drop(*extra)
    return review(pred, spec, model_name).drop("probability"), bad
