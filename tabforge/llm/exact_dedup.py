"""Exact dedup with a heavy-hitter split (Misra-Gries), in DataFrame functions only.

Texts are equal when identical after every white-space character is deleted.
One narrow pass turns each text into a SHA-256 digest and its length; the text
itself is never shuffled. A Misra-Gries frequent-items sketch over the digests
(``approx_top_k``) names the digests that may hold more than 1/1024 of all
rows; an exact count over their rows (combined before the shuffle) gives each
one's winner, and these at most ``MAX_HEAVY`` verified winners are broadcast, so
rows of hot groups are settled where they lie. All other digests take the
ordinary shuffle: one pre-aggregated group table, joined back.

The sketch only chooses the route. Whatever it names or misses, each row's
group is counted exactly, so the result does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, all_columns, fresh, materialize, text_or_empty

#: Counters of the sketch; it finds every digest with over 1/(0.75 * TRACKED) of the rows.
TRACKED = 4096
#: A digest is heavy from this share of the rows on ...
HEAVY_SHARE = 1 / 1024
#: ... so at most this many names leave the sketch (estimates never exceed the true count by more than the error bound).
MAX_HEAVY = 2048


def _winner(id_col: str):
    """Order within a group: most code points, smallest id (null last), then the row's own number."""
    return F.min(F.struct((-F.col("n_points")).alias("neg"), F.col(id_col).isNull().alias("no_id"),
                          F.col(id_col).alias("keep_id"), F.col("row_no").alias("keep_row")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_points.

    Defined cases: a null text is empty, and all empty or blank texts are one
    group. Ties in length go to the smallest id, a null id losing to any other;
    rows that repeat an id still have exactly one kept row per group. An empty
    table gives an empty result. Columns other than the two named are ignored.
    """
    text = text_or_empty(text_col)
    rows = materialize(
        docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
        .select("doc_id", F.unhex(F.sha2(F.translate("t", WHITE_SPACE, "").cast("binary"), 256)).alias("digest"),
                F.char_length("t").cast("long").alias("n_points"))
        .withColumn("sketch_key", F.xxhash64("digest"))
        .withColumn("row_no", F.monotonically_increasing_id()), "dedup-digests")

    sketch = rows.agg(F.expr(f"approx_top_k(sketch_key, {MAX_HEAVY}, {TRACKED})").alias("top"), F.count("*").alias("n"))
    names = (sketch.select(F.explode("top").alias("x"), "n")
             .where(F.col("x.count") > F.greatest(F.col("n") * HEAVY_SHARE, F.lit(16)))
             .select(F.col("x.item").alias("sketch_key")))
    summary = [F.count("*").alias("group_size"), _winner("doc_id").alias("best")]
    winners = materialize(rows.join(F.broadcast(names), "sketch_key", "left_semi").groupBy("digest").agg(*summary),
                          "dedup-winners")

    heavy = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    light = rest.join(rest.groupBy("digest").agg(*summary), "digest")
    return heavy.unionByName(light).select(
        "doc_id", F.col("best.keep_id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("best.keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "n_points")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    The kept rows are found by (digest, id), which spreads a hot group over its
    ids; rows that repeat both are reduced to one where they already lie together.
    """
    d, i, c = fresh(docs, "digest", "id", "points")
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(
        F.unhex("text_sha256").alias("kept_digest"), F.struct("doc_id").alias("kept_id"), F.col("n_points").alias("kept_points"))
    text = text_or_empty(text_col)
    marked = docs.withColumns({d: F.unhex(F.sha2(F.translate(text, WHITE_SPACE, "").cast("binary"), 256)),
                               i: F.struct(F.col(id_col).alias("doc_id")), c: F.char_length(text).cast("long")})
    # >=, as no row of a group is longer: an equality would be a third key, and the texts would be shuffled again for the last step
    same = (marked[d] == kept["kept_digest"]) & (marked[i] == kept["kept_id"]) & (marked[c] >= kept["kept_points"])
    return marked.join(kept, same, "left_semi").dropDuplicates([d, i]).select(*all_columns(docs))
