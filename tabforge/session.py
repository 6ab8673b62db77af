"""Session helpers.

On a cluster the session is made by the caller; these helpers only fill in what
is unset (shuffle partitions, time zone, checkpoint directory) so that local
tests and benchmarks behave like the cluster without overriding its settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tabforge") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset and the master is
    local (tests) a fresh scratch folder is created and registered; a cluster
    without the setting is refused, as its machines do not share local folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tabforge-ckpt-", dir=os.environ.get("TABFORGE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_STAGED: dict[int, list[str]] = {}


def drop_staged(spark: SparkSession, prefix: str = "") -> int:
    """Delete the copies that ``materialize`` wrote in this session, or those whose name starts with a prefix; tables
    that read them are no longer usable. Returns their number."""
    staged = _STAGED.get(id(spark.sparkContext), [])
    paths = [x for x in staged if x.rsplit("/", 1)[1].startswith(prefix)]
    for path in paths:
        staged.remove(path)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet to the shared folder and reading it back.

    Survives executor loss (unlike a local checkpoint), and the read side gets
    exact file statistics for the optimizer. ``drop_staged`` deletes the copies.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    _STAGED.setdefault(id(spark.sparkContext), []).append(path)
    return spark.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once a session, for drivers that have it on their own path only."""
    if getattr(spark, "_tabforge_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tabforge-ship-"), "tabforge.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(top)):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    spark._tabforge_shipped = True
