"""Sources and sinks.

Everything is columnar Parquet on a shared file system (or a catalog table);
CSV and JSON are edge formats. Writes are task-parallel, so the reference's
500-row chunking has no counterpart.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from . import publish


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             corrupt_col: str | None = "_corrupt_record", multi_line: bool = True) -> DataFrame:
    """Headered CSV with an explicit schema; malformed lines land in ``_corrupt_record``. Quoted cells may hold
    line breaks and doubled quotes; with ``multi_line=False`` they may not, and large files are split between tasks."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if corrupt_col and corrupt_col not in st.fieldNames():
        st = T.StructType(st.fields + [T.StructField(corrupt_col, T.StringType(), True)])
    r = spark.read.schema(st).option("header", header).option("mode", "PERMISSIVE")
    r = r.option("multiLine", multi_line).option("quote", '"').option("escape", '"')
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header (one file per task)."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def scan(spark: SparkSession, source: str) -> DataFrame:
    """Full scan of a Parquet path or a catalog table name."""
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              partitions: int, properties: Mapping[str, str] | None = None) -> DataFrame:
    """S2 (optional): parallel JDBC read split on a numeric column."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=dict(properties or {}))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write Parquet (task-parallel files, optional partition folders)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_and_verify(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """(rows_written, rows_read, count_ok). The input is computed once, into blocks that the count and the write
    both read; the read-back count comes from the file footers, less what was there before an append."""
    spark = df.sparkSession
    before = spark.read.parquet(path).count() if mode == "append" and _exists(spark, path) else 0
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        n = kept.count()
        write_table(kept, path, mode)
    finally:
        kept.unpersist()
    back = spark.read.parquet(path).count() - before
    return spark.createDataFrame([(n, back, n == back)], "rows_written bigint, rows_read bigint, count_ok boolean")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows (batch); the streaming path is in ``streaming``."""
    write_table(df, path, "append", partition_by)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Deletes a folder and what is in it; whether there was one."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def _cache_path(spark: SparkSession, name: str = "", version: str = "") -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cache/{name}{('-' + version) if version else ''}"


def cached(spark: SparkSession, name: str, build: Callable[[], DataFrame], max_age_s: float = 24 * 3600,
           version: str = "") -> DataFrame:
    """Named materialization with expiry. A fresh copy under the shared checkpoint folder is
    read back; otherwise the table is rebuilt, published and read. ``version`` keys the copy to its
    input so a changed input never hits a stale copy. Two jobs that miss together write folders of their own; the later one stays."""
    path = _cache_path(spark, name, version)
    _, runs = publish.entries(spark, path)
    if not runs or time.time() - runs[-1]["at"] > max_age_s:
        publish.publish(build(), path, "copy", mode="overwrite")
    return publish.read_published(spark, path)


def flush_cached(spark: SparkSession) -> int:
    """Deletes all named copies of the shared folder; returns their number. Jobs that read one at the time fail."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_cache_path(spark))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    copies = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
    for c in copies:
        fs.delete(c, True)
    return len(copies)


def input_version(spark: SparkSession, *paths: str) -> str:
    """A stable key for the current state of the input files, for ``cached(version=...)``.

    Every file under ``paths`` adds a digest of (path, size, modification time); the sum is
    order independent, so the listing is streamed and never held. A rewritten or added file
    changes the key, so a stale copy is not read; the same files give the same key in every job."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total, n = 0, 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        it = hp.getFileSystem(conf).listFiles(hp, True)
        while it.hasNext():
            st = it.next()
            key = f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}".encode()
            total = (total + int.from_bytes(hashlib.sha256(key).digest()[:8], "big")) % (1 << 64)
            n += 1
    return f"{n}-{total:016x}"


def drop_cached(spark: SparkSession, name: str, version: str = "") -> bool:
    """Delete one named copy."""
    return delete_path(spark, _cache_path(spark, name, version))


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One table partitioned by split name."""
    write_table(df, path, "overwrite", [split_col])


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """Read one split; the filter prunes partitions (only that folder is listed and read)."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


def write_report(df: DataFrame, path: str, run_id: str | None = None, mode: str = "append") -> str:
    """Report rows as JSON lines, tagged with a run id and timestamp."""
    rid = run_id or uuid.uuid4().hex[:12]
    (df.withColumn("run_id", F.lit(rid)).withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
       .write.mode(mode).json(path))
    return rid


def log_run(spark: SparkSession, path: str, run_id: str, kind: str, values: Mapping[str, object],
            parent_run_id: str | None = None) -> None:
    """Append parameters/metrics of one run to a long ``runs`` table."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_id, parent_run_id, kind, k, None if v is None else str(v), now) for k, v in values.items()]
    spark.createDataFrame(rows, "run_id string, parent_run_id string, kind string, key string, value string, "
                                "ts timestamp_ntz").write.mode("append").parquet(path)


def runs_wide(spark: SparkSession, path: str, kind: str = "metric") -> DataFrame:
    """One row per run, one column per key (latest value wins)."""
    r = spark.read.parquet(path).where(F.col("kind") == kind)
    latest = r.groupBy("run_id", "parent_run_id", "key").agg(F.max_by("value", "ts").alias("value"))
    return latest.groupBy("run_id", "parent_run_id").pivot("key").agg(F.first("value"))
