"""Shared helpers of the corpus operators.

Every operator selects its input columns into fixed inner names first, so extra
columns of the caller, whatever they are called, never clash with its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path  # noqa: F401
from ..session import ship_package as ship  # noqa: F401

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE_SPACE = " \t\n\u000b\f\r"
#: A word is a longest run of other characters.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch, where the session has Spark's default: rows hold whole texts here.
BATCH = 1000


def prepare(spark: SparkSession) -> None:
    """What a query that runs Python on the executors needs: the package, and batches that fit long rows."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to differ from every column of ``df``."""
    used = {c.lower() for c in df.columns}
    return ["_" * next(i for i in range(len(used) + 2) if "_" * i + n not in used) + n for n in names]


def all_columns(df: DataFrame) -> list[Column]:
    """Every column of ``df``, whatever characters its name has."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
