"""The pipeline's stages against brute force over what each is given."""

import re

import corpus_pipeline as P
import public_tokenizers
from edge import edge_docs
from test_dedup import brute_components, brute_fp
from test_sequences import check_pack

from tabforge.llm.common import scratch_path
from tabforge.llm.queries import QUERIES, held_out
from tabforge.llm.toxicity import fit_toxicity, score_toxicity

SF001 = "/root/testdata/sf0.001"


def stage(spark, k, docs, sf=SF001):
    path = scratch_path(spark, f"test-stage{k}")
    P.STAGES[k][1](spark, docs, sf).write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    clean = stage(spark, 0, docs)
    model = fit_toxicity(docs, spark.read.parquet(f"{SF001}/labels.parquet"), learn=~held_out())
    want = {r["doc_id"] for r in score_toxicity(docs, model).where("score < 0.5").collect()}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == want
    once = stage(spark, 1, clean)
    groups = {}
    for r in clean.collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or ""), []).append(r)
    keep = {min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"]))["doc_id"] for g in groups.values()}
    assert once.columns == docs.columns and sorted(r["doc_id"] for r in once.collect()) == sorted(keep)
    apart = stage(spark, 2, once)
    fps = {r["doc_id"]: brute_fp(r["text"]) for r in once.collect()}
    comp = brute_components(list(fps.items()))
    assert apart.columns == docs.columns and sorted(r["doc_id"] for r in apart.collect()) == sorted({comp[f] for f in fps.values()})
    mixed = stage(spark, 3, apart)
    assert mixed.columns == docs.columns and [f.dataType for f in mixed.schema] == [f.dataType for f in docs.schema]
    assert all(r["n_chars"] == len(r["text"]) for r in mixed.collect())
    packed = stage(spark, 4, mixed)
    check_pack(packed.collect(), [(r["doc_id"], r["text"]) for r in mixed.collect()])


def test_run_and_edge_rows(spark):
    assert P.run(spark, SF001).count() > 0 and "pipeline" not in QUERIES
    docs = edge_docs(spark)
    for k in range(5):
        docs = stage(spark, k, docs)
    assert docs.count() > 0
    empty = edge_docs(spark).limit(0)
    for k in range(5):
        empty = stage(spark, k, empty)
    assert empty.count() == 0 and public_tokenizers
