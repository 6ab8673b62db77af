"""Category encoding.

The encoder is a table (column, value, code) fitted from the distinct values:
codes follow the sorted order of the text (upper case before lower case, as in
a byte-wise sort), by a running count over ranges, so a column may have any
number of levels. A few levels are inlined; more are joined, by a broadcast
only within a measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import map_values
from .ordered import running_sum

MAX_INLINE_LEVELS = 64   # up to this many levels of a column the codes are a map literal (a linear search per row)
MAX_BROADCAST_BYTES = 64 << 20  # above the inline size: broadcast up to this estimated size, else shuffle join


def level_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, rank): the sorted distinct non-null values of each column, ranks from 0."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    lng = df.selectExpr(f"stack({len(cols)}, {pairs}) as (`column`, `value`)").where(F.col("value").isNotNull())
    distinct = lng.distinct().withColumn("_one", F.lit(1).cast("bigint"))
    return running_sum(distinct, ["value"], ["_one"], ["column"]).select("column", "value", (F.col("cum__one") - 1).alias("rank"))


def fit_label_encoder(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F6 fit: (column, value, code) with code = 0-based rank of the value's text."""
    return level_rows(df, cols).select("column", "value", F.col("rank").cast("int").alias("code"))


def collect_encoder(encoder: DataFrame) -> dict[str, dict[str, int]]:
    """The levels as a dict, for a model stage that carries them with it (low-cardinality categories)."""
    out: dict[str, dict[str, int]] = {}
    for r in encoder.collect():
        out.setdefault(r["column"], {})[r["value"]] = int(r["code"])
    return out


Known = tuple[dict[str, tuple[int, int]], dict[str, dict[str, int]]]


def measure_encoder(encoder: DataFrame, cols: Sequence[str] | None = None) -> Known:
    """Number and bytes of the levels of each column, and the levels of the columns that have few: all that reaches the driver."""
    stats = {r["column"]: (int(r["n"]), int(r["b"] or 0)) for r in encoder.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("b")).collect()}
    few = [c for c in (cols or stats) if stats.get(c, (0, 0))[0] <= MAX_INLINE_LEVELS]
    return stats, {c: {} for c in few} | collect_encoder(encoder.where(F.col("column").isin(few))) if few else {}


def apply_label_encoder(df: DataFrame, encoder: DataFrame | Mapping[str, Mapping[str, int]],
                        cols: Sequence[str] | None = None, unknown: str = "minus_one",
                        errors: str = "errors", known: Known | None = None) -> DataFrame:
    """replace each category by its code.

    unknown='minus_one' -> -1 (monitoring path); 'null' -> null;
    'error' -> null plus an entry in the ``errors`` array (scoring path), which lists the valid
    values when they are few and gives their number otherwise. ``known`` spares measuring an encoder table again.
    """
    from .clean import add_errors
    if isinstance(encoder, DataFrame):
        stats, small = known or measure_encoder(encoder, cols)
        cols = list(cols or stats.keys())
    else:
        cols = list(cols or encoder.keys())
        stats = {c: (len(encoder[c]), sum(len(str(v).encode()) for v in encoder[c])) for c in cols}
        small = {c: dict(encoder[c]) for c in cols if len(encoder[c]) <= MAX_INLINE_LEVELS}
    out = df
    value_of = "_encoder_value"
    if unknown == "error" and errors not in out.columns:
        out = out.withColumn(errors, F.array().cast("array<string>"))
    for c in cols:
        src, code = F.col(c).cast("string"), f"_code_{c}"
        n, size = stats.get(c, (0, 0))
        if c in small:
            out = out.withColumn(code, map_values(src, small[c]).cast("int"))
            valid = f"{sorted(small[c])}"
        else:
            if isinstance(encoder, DataFrame):
                dim = encoder.where(F.col("column") == F.lit(c)).select(F.col("value").alias(value_of), F.col("code").cast("int").alias(code))
            else:
                dim = df.sparkSession.createDataFrame(list(encoder[c].items()), f"{value_of} string, `{code}` int")
            if size + 24 * n <= MAX_BROADCAST_BYTES:
                dim = F.broadcast(dim)
            out = out.join(dim, src == F.col(value_of), "left").drop(value_of)
            valid = f"{n} known values"
        value = F.col(code)
        if unknown == "minus_one":
            value = F.coalesce(value, F.lit(-1))
        elif unknown == "error":
            msg = F.concat(F.lit(f"invalid:{c}:'"), F.coalesce(src, F.lit("None")), F.lit(f"' valid: {valid}"))
            out = add_errors(out, [(F.col(code).isNull(), msg)], errors)
        out = out.withColumn(c, value.cast("int")).drop(code)
    return out


def encode_target(df: DataFrame, col: str, mapping: Mapping[str, int], out: str | None = None) -> DataFrame:
    """target text -> 0/1; unknown -> null."""
    return df.withColumn(out or col, map_values(F.col(col).cast("string"), dict(mapping)).cast("int"))


def one_hot(df: DataFrame, cols: Sequence[str], encoder: DataFrame | Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Recommended alternative to ordinal codes for unordered categories: one 0/1 column per level."""
    enc = collect_encoder(encoder) if isinstance(encoder, DataFrame) else encoder  # as many columns as levels
    out = df
    for c in cols:
        for v in sorted(enc[c], key=lambda x: enc[c][x]):
            out = out.withColumn(f"{c}={v}", (F.col(c).cast("string") == F.lit(v)).cast("int"))
    return out


class LevelEncoder(Transformer, HasInputCols, MLReadable, MLWritable):
    """F6 / F7 as a pipeline stage: adds ``f_<c>``, the code of each column ``c``; unknown and missing values are -1.

    The levels are a table (column, value, code), not an expression, so a column may have any number of them: they are
    joined, and stored as Parquet beside the stage. A fresh stage reads the table that it was given (a staged copy); a
    loaded one reads its own folder."""

    def __init__(self, inputCols: Sequence[str] | None = None, levels: DataFrame | None = None):
        super().__init__()
        self._set(inputCols=list(inputCols or []))
        self.levels, self._known = levels, None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = [f"f_{c}" for c in self.getInputCols()]
        levels = self.levels.withColumn("column", F.concat(F.lit("f_"), "column"))
        if self._known is None:  # once a stage, not once a batch
            self._known = measure_encoder(levels, cols)
        out = dataset.withColumns({f"f_{c}": F.col(f"`{c}`").cast("string") for c in self.getInputCols()})
        return apply_label_encoder(out, levels, cols, known=self._known)

    def write(self) -> "_LevelWriter":
        return _LevelWriter(self)

    @classmethod
    def read(cls) -> "_LevelReader":
        return _LevelReader()


class _LevelWriter(MLWriter):
    def __init__(self, stage: LevelEncoder):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.levels.write.parquet(f"{path}/levels")


class _LevelReader(MLReader):
    def load(self, path: str) -> LevelEncoder:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = LevelEncoder(levels=self.sparkSession.read.parquet(f"{path}/levels"))
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        return stage
