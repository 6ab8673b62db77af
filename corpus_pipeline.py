"""The corpus pipeline: documents to packed training sequences.

Five stages, each written as Parquet and read again by the next: toxic texts
go, then exact copies, then near copies, then the sources are mixed to their
target weights, then the mix is packed. All but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabforge.llm.common import prepare, read_table, scratch_path
from tabforge.llm.exact_dedup import drop_exact_copies
from tabforge.llm.mixing import apply_mix
from tabforge.llm.packing import pack
from tabforge.llm.queries import held_out
from tabforge.llm.simhash import drop_near_copies
from tabforge.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, by a model learnt from the labels of rows that are not held out."""
    prepare(spark)
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"), learn=~held_out())
    return drop_toxic(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: 4-word shingles, at most 4 differing bits."""
    prepare(spark)
    return drop_near_copies(docs, words=4, max_bits=4, seed=42)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix of sources takes them."""
    return apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    from public_tokenizers import path

    prepare(spark)
    return pack(docs, path("word_bpe_49k.json"), size=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: Toxicity, SimHash and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared checkpoint folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
