"""Structured Streaming (ST1, ST2).

ST1: records arrive as files; each micro-batch is normalized, checked, scored
with the fitted ``PipelineModel`` and written: scored rows appended to the
predictions table, rejected rows to a quarantine table. The query is
checkpointed beside its predictions (or where the caller says), so a restart resumes where it stopped and a
lost executor only re-runs its tasks. Rows are stored by date, query id and batch: a replayed batch replaces
its own rows, and a new query (with a new checkpoint) never those of an earlier one. The per-batch work is stateless, so no
watermark is needed.

ST2: the periodic drift job reads a time range of the predictions table and
falls back to a reference split when fewer than ``min_rows`` rows arrived.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import score as SC
from ..operators import summaries as SU
from ..spec import MIN_LIVE_ROWS, ScoringSpec


def start_scoring_stream(spark: SparkSession, source_dir: str, schema: T.StructType, model: PipelineModel,
                         spec: ScoringSpec, model_name: str, predictions_path: str, quarantine_path: str,
                         checkpoint_path: str | None = None, fmt: str = "parquet", available_now: bool = True,
                         max_files_per_trigger: int | None = None, summary_path: str | None = None,
                         summary_columns: tuple[list[str], list[str]] = ([], []), summary_k: int = SU.K):
    """ST1: start the stream; returns the ``StreamingQuery``. With ``summary_path`` each batch also stores a mergeable
    summary of its scored rows' (numeric, categorical) columns, from which ``summaries.drift_of_summaries`` tells drift."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")  # kept in the checkpoint
        scored, rejected, checked = SC.score_with_handle(batch, model, spec, model_name)
        try:
            for rows, path in ((scored, predictions_path), (rejected, quarantine_path)):
                _delete_batch(spark, path, query, epoch_id)  # what an earlier try of this batch left, on whatever day
                _store(rows, path, query, epoch_id)
            if summary_path:
                _delete_batch(spark, summary_path, query, epoch_id)
                _store(SU.summarize(scored, [], *summary_columns, k=summary_k), summary_path, query, epoch_id)
        finally:
            checked.unpersist()  # release the batch's cached rows before the next trigger

    w = src.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_path or f"{predictions_path.rstrip('/')}/_checkpoint")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_scoring_stream(spark: SparkSession, source_dir: str, schema: T.StructType, model: PipelineModel,
                       spec: ScoringSpec, model_name: str, predictions_path: str, quarantine_path: str,
                       checkpoint_path: str | None = None, fmt: str = "parquet", **options) -> tuple[DataFrame, DataFrame]:
    """ST1 until the input is drained (``availableNow``); returns (predictions, quarantine) tables."""
    q = start_scoring_stream(spark, source_dir, schema, model, spec, model_name, predictions_path, quarantine_path,
                             checkpoint_path, fmt, available_now=True, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    # output schemas come from the same scoring plan applied to an empty input
    empty_scored, empty_rejected = SC.score(spark.createDataFrame([], schema), model, spec, model_name)
    keys = {"query_id": F.lit(""), "batch_id": F.lit(0).cast("bigint"), "date": F.current_date()}
    return (_read_or_empty(spark, predictions_path, empty_scored.withColumns(keys)),
            _read_or_empty(spark, quarantine_path, empty_rejected.withColumns(keys)))


def _store(rows: DataFrame, path: str, query: str, batch: int) -> None:
    keys = {"date": F.current_date(), "query_id": F.lit(query), "batch_id": F.lit(batch).cast("bigint")}
    rows.withColumns(keys).write.mode("append").partitionBy(*keys).parquet(path)


def _glob(spark: SparkSession, pattern: str) -> list:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return [s.getPath() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []]


def _delete_batch(spark: SparkSession, path: str, query: str, batch: int) -> None:
    for p in _glob(spark, f"{path}/date=*/query_id={query}/batch_id={batch}"):
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_days(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame | None:
    """The rows stored on the days from that of ``start`` to that of ``end``: the days' names are listed, and then only
    the folders of those asked for are. None where there are none."""
    first, last = (str(x)[:10] if x else None for x in (start, end))
    days = [p.toString() for p in _glob(spark, f"{path}/date=*")
            if (not first or p.getName()[5:] >= first) and (not last or p.getName()[5:] <= last)]
    return spark.read.option("basePath", path).parquet(*sorted(days)) if days else None


def _read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A sink that received no rows has no files; return an empty table of the right schema then."""
    stored = read_days(spark, path)
    return spark.createDataFrame([], like.schema) if stored is None else stored


def live_or_fallback(spark: SparkSession, predictions_path: str, fallback: DataFrame, ts_col: str = "timestamp",
                     start: str | None = None, end: str | None = None, min_rows: int = MIN_LIVE_ROWS):
    """ST2: the current set for monitoring - live predictions in [start, end) when at least
    ``min_rows`` exist, otherwise the fallback (test split). Returns (DataFrame, source name)."""
    if _glob(spark, f"{predictions_path}/date=*"):
        live = read_days(spark, predictions_path, start, end)
    else:  # a table without folders by day, or none yet
        try:
            live = spark.read.parquet(predictions_path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            live = None
    if live is None:
        return fallback, "test data"
    if start:
        live = live.where(F.col(ts_col) >= F.lit(start).cast("timestamp"))
    if end:
        live = live.where(F.col(ts_col) < F.lit(end).cast("timestamp"))
    n = live.limit(min_rows).count()
    if n < min_rows:
        return fallback, "test data"
    return live, "live predictions"
