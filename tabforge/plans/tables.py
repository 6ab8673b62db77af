"""Base tables derived from the driver's Parquet tables, and their SQL twins.

The reference's raw patient table (numeric columns, categories, imbalanced
0/1 target) is stood in for by ``documents`` joined with ``labels``: text
measurements are the numeric features (skewed, with outliers), ``lang`` and
``source`` the categories, ``quality`` the target.

Text features are computed on ``documents`` before the join, so whole texts
are read once by the scan and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import digit_count, line_count, word_count

DOC_NUMERIC = ["n_chars", "n_words", "n_lines", "n_digits"]
DOC_CATEGORICAL = ["lang", "source"]
DOC_TARGET = "quality"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", "source", "n_chars", word_count("text").alias("n_words"),
                    line_count("text").alias("n_lines"), digit_count("text").alias("n_digits"))


def doc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: the stand-in for the raw patient table."""
    lab = read(spark, sf_dir, "labels")
    return doc_features(spark, sf_dir).join(lab, "doc_id")


def doc_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, labels where known (null otherwise)."""
    lab = read(spark, sf_dir, "labels")
    return doc_features(spark, sf_dir).join(lab, "doc_id", "left")


# --- SQL twins (DuckDB) ----------------------------------------------------

DOC_FEATURES_SQL = r"""doc_features AS (
  SELECT doc_id, lang, source, n_chars,
         CAST(len(regexp_extract_all(text, '[^ \t\n\r\f]+')) AS BIGINT) AS n_words,
         CAST(len(regexp_extract_all(text, '\n')) + 1 AS BIGINT) AS n_lines,
         CAST(len(regexp_extract_all(text, '[0-9]')) AS BIGINT) AS n_digits
  FROM documents)"""

DOC_RAW_SQL = DOC_FEATURES_SQL + """,
doc_raw AS (SELECT f.*, l.quality, l.toxic FROM doc_features f JOIN labels l ON f.doc_id = l.doc_id)"""

DOC_ALL_SQL = DOC_FEATURES_SQL + """,
doc_all AS (SELECT f.*, l.quality, l.toxic FROM doc_features f LEFT JOIN labels l ON f.doc_id = l.doc_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
