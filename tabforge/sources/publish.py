"""Atomic publish (S3, S4, S6): rows are written aside, and a manifest that names their folder makes them visible.

A table is ``data/`` with a folder for each write, and ``_manifest/`` with numbered versions. A writer commits by creating the next
version, which succeeds for one writer only; the other reads the new version and tries again. Readers follow
the last version, so a writer that dies half way leaves nothing to be seen, and a run id that is written again replaces its own rows.
A version lists the folders of all live runs (a few hundred bytes each), so runs are counted in thousands, not rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: A commit that finds its version taken so often gives up.
TRIES = 50


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, table: str) -> list[int]:
    fs, p = _fs(spark, f"{table}/_manifest")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def entries(spark: SparkSession, table: str) -> tuple[int, list[dict]]:
    """(version, its runs): run_id, folder, at (seconds) and schema; (0, []) before the first publish."""
    found = _versions(spark, table)
    if not found:
        return 0, []
    text = "".join(r[0] for r in spark.read.text(f"{table}/_manifest/v{found[-1]:09d}.json", wholetext=True).collect())
    return found[-1], json.loads(text)


def _commit(spark: SparkSession, table: str, change: Callable[[list[dict]], list[dict]]) -> int:
    """Creates the next version from the last one; another writer's version is taken up first."""
    jvm = spark.sparkContext._jvm
    for _ in range(TRIES):
        version, runs = entries(spark, table)
        fs, draft = _fs(spark, f"{table}/_manifest/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(change(runs)).encode()))
        finally:
            out.close()
        _, final = _fs(spark, f"{table}/_manifest/v{version + 1:09d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        keep[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE  # refuses to replace a version
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), keep)
            return version + 1
        except Exception as e:  # only a taken version is tried again
            fs.delete(draft, False)
            if version + 1 not in _versions(spark, table):
                raise e
    raise RuntimeError(f"{table}: {TRIES} other writers came first")


def publish(df: DataFrame, table: str, run_id: str, mode: str = "append") -> int:
    """Writes ``df`` as the rows of ``run_id`` and returns the version: "append" adds them to those of other runs, "overwrite" leaves them alone."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{table}/{folder}")
    own = {"run_id": run_id, "folder": folder, "at": time.time(), "schema": df.schema.json()}
    return _commit(spark, table, lambda runs: [r for r in runs if mode == "append" and r["run_id"] != run_id] + [own])


def read_published(spark: SparkSession, table: str) -> DataFrame | None:
    """The rows of all live runs, by column name; None where nothing was published."""
    _, runs = entries(spark, table)
    if not runs:
        return None
    return spark.read.option("mergeSchema", len({r["schema"] for r in runs}) > 1).parquet(*[f"{table}/{r['folder']}" for r in runs])


def flush(spark: SparkSession, table: str, max_age_s: float = 0.0) -> int:
    """Takes all runs, or those older than ``max_age_s``, out of the table; returns their number. Running readers keep their files."""
    limit, gone = time.time() - max_age_s, []

    def change(runs: list[dict]) -> list[dict]:
        gone[:] = [r for r in runs if r["at"] <= limit]
        return [r for r in runs if r["at"] > limit]

    _commit(spark, table, change)
    return len(gone)


def vacuum(spark: SparkSession, table: str, grace_s: float = 7 * 24 * 3600) -> int:
    """Deletes folders that the last version does not name and that are older than the grace, which must be longer than any write or read."""
    live = {r["folder"].rsplit("/", 1)[1] for r in entries(spark, table)[1]}
    fs, p = _fs(spark, f"{table}/data")
    if not fs.exists(p):
        return 0
    old = [s.getPath() for s in fs.listStatus(p)
           if s.getPath().getName() not in live and s.getModificationTime() / 1000.0 <= time.time() - grace_s]
    for path in old:
        fs.delete(path, True)
    return len(old)
