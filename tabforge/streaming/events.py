"""ST1 with state: counts by day of a stream of events in which rows repeat and come late.

The stream has an event-time watermark. A repeat of an event (the same id) within the watermark's delay is dropped, a late event that is
newer than the watermark is added to its day, an older one is dropped. Ids and open days are Spark's own state, kept
under the checkpoint, so another start goes on where the last one ended; both are let go once the watermark has passed them.
(For state beyond an executor's heap set ``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider.)

The sink stores each batch's changed rows as a revision of their days; a replayed batch replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import delete_path


def day_counts(events: DataFrame, id_col: str, ts_col: str, by: Sequence[str], delay: str, aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """(day, by..., n, aggs...) of a streaming table, for output mode "update".

    Rows without a time are in no day. Rows without an id repeat each other only if all their columns are equal."""
    rows = events.withColumn(ts_col, F.col(ts_col).cast("timestamp")).where(F.col(ts_col).isNotNull())
    whole = F.when(F.col(id_col).isNull(), F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in events.columns])), 256))
    once = rows.withColumn("_whole", whole).withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col, "_whole"])
    cells = once.groupBy(F.window(ts_col, "1 day").alias("_day"), *by)
    out = cells.agg(F.count("*").alias("n"), *[c.alias(name) for name, c in (aggs or {}).items()])
    return out.select(F.to_date("_day.start").alias("day"), *by, "n", *(aggs or {}))


def run_day_counts(spark: SparkSession, source_dir: str, schema: T.StructType, path: str, id_col: str, ts_col: str, by: Sequence[str],
                   delay: str, aggs: Mapping[str, Column] | None = None, checkpoint_path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Takes in all files that arrived since the last start and returns the counts so far; one table has one checkpoint."""
    out = day_counts(spark.readStream.schema(schema).format(fmt).load(source_dir), id_col, ts_col, by, delay, aggs)

    def write(batch: DataFrame, batch_id: int) -> None:
        delete_path(spark, f"{path}/batch_id={batch_id}")  # what an earlier try of this batch left
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").partitionBy("batch_id").parquet(path)

    q = (out.writeStream.outputMode("update").foreachBatch(write).trigger(availableNow=True)
         .option("checkpointLocation", checkpoint_path or f"{path.rstrip('/')}/_checkpoint").start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_day_counts(spark, path, by, out.schema)


def read_day_counts(spark: SparkSession, path: str, by: Sequence[str], schema: T.StructType) -> DataFrame:
    """The last revision of each day."""
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(path)
    keys = ["day", *by]
    values = [c for c in schema.names if c not in keys]
    return (stored.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
            .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in values]))
