"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

1. Targets. Sources take weights in turn and share a multiple of all words;
   what exceeds a source's cap goes to the others by weight. Sorted by
   cap / weight, the capped sources are a prefix, so running sums give the level.
2. Lines. Each source's documents lie one after another in a hash order of
   their own for each pass, and the line is cut into blocks of equal words. Hash
   ranges make small groups: a running sum within each, offsets across them.
3. Schedule. Slot i of K has the golden-ratio point i * g mod K, where g is the number next
   to K / 1.618 without a common factor; it belongs to the source
   in whose stretch of the cumulative block counts it falls. The points are a
   permutation, so each source gets exactly the slots it needs, evenly spread.
   Slots are ranked within each source, and slot r takes block r of its line.

A hot source is many hash ranges and slot chunks, never one group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, all_columns, fresh, materialize, text_or_empty

#: Rows that one hash range, and slots that one chunk, should hold.
PER_RANGE = 1024


def source_targets(sizes: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) with source_no, weight and target added; one row per source, null last."""
    order = Window.orderBy(F.asc_nulls_last("source"))
    ranked = sizes.withColumn("source_no", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("source_no") % len(weights) + 1))
    ranked = ranked.withColumn("most", cap * F.col("source_size"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    all_rows = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("level", (share * F.sum("source_size").over(all_rows) - before) / after)
    level = level.withColumn("capped", F.col("most") <= F.col("level") * F.col("weight"))
    level = level.withColumn("level", F.first(F.when(~F.col("capped"), F.col("level")), True).over(all_rows))
    return level.select("source", "source_size", "source_no", "weight",
                        F.when(F.col("capped"), F.col("most")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def golden_step(k: int) -> int:
    """The number next to k / golden ratio without a common factor with k."""
    near = round(k / ((1 + math.sqrt(5)) / 2))
    return next((g for d in range(k) for g in (near - d, near + d) if 0 < g < k and math.gcd(g, k) == 1), 1)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple = (3, 1, 2), share: float = 1.5, cap: float = 2.0, block: int = 1024, seed: int = 17) -> DataFrame:
    """One row per input row: doc_id, text_key, size, source, source_size, target, taken, first_slot, blocks.

    Words are counted; a source's taken words are its target, rounded. A document
    is taken once more in each further pass over its source's line, of which there are at most
    ``cap`` (rounded up).

    Defined cases: null and empty texts have size 0, are never taken and have no
    slot; a null source is a source of its own, the last; rows that repeat an id
    are rows of their own. An empty table gives an empty result. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    rows = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text_or_empty(text_col).alias("t"))
        .select("doc_id", "source", F.xxhash64("t").alias("text_key"), F.regexp_count("t", F.lit(WORD)).cast("long").alias("size"))
        .withColumn("row_no", F.monotonically_increasing_id()), "mix-sizes")
    sources = materialize(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
                          .withColumn("line", F.round("target").cast("long"))
                          .withColumn("need", F.ceil(F.col("line") / block))
                          .withColumn("first", F.sum("need").over(Window.orderBy("source_no")) - F.col("need")), "mix-sources")
    n_rows, k = rows.count(), sources.agg(F.sum("need")).first()[0] or 0
    known = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])

    # lines of documents
    bits = max(0, math.ceil(math.log2(max(1, n_rows) / PER_RANGE)))
    copies = known.where("size > 0 and line > 0").select(
        "source_no", "source_size", "line", "size", "row_no", "doc_id",
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("line") / F.col("source_size")).cast("int") - 1)).alias("turn"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("turn").cast("string"), F.col("doc_id").cast("string")).cast("binary"))
    copies = copies.withColumn("order", F.conv(F.substring(key, 1, 15), 16, 10).cast("long"))  # 60 bits
    copies = copies.withColumn("range", F.shiftright("order", 60 - bits))
    lane = ["source_no", "turn", "range"]
    ranges = copies.groupBy(*lane).agg(F.sum("size").alias("words"))
    ranges = ranges.withColumn("before", F.sum("words").over(Window.partitionBy("source_no", "turn").orderBy("range")) - F.col("words"))
    within = F.sum("size").over(Window.partitionBy(*lane).orderBy("order", "doc_id", "row_no"))
    placed = copies.withColumn("upto", within).join(ranges.drop("words"), lane)
    start = F.col("turn") * F.col("source_size") + F.col("before") + F.col("upto") - F.col("size")
    placed = placed.select("row_no", "source_no", "line", start.alias("start"), (start + F.col("size")).alias("end")).where("start < line")
    placed = placed.withColumn("end", F.least("end", "line"))
    pieces = placed.select("row_no", "source_no", "start", "end", F.explode(
        F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))).alias("rank"))
    pieces = pieces.select("row_no", "source_no", "rank", (F.least("end", (F.col("rank") + 1) * block)
                                                           - F.greatest("start", F.col("rank") * block)).alias("words"))

    # schedule of slots
    back = pow(golden_step(k), -1, k) if k > 1 else 1
    chunks = sources.where("need > 0").select("source_no", "need", "first", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("need") - 1) / PER_RANGE))).alias("c")).repartition("source_no", "c")
    points = chunks.select("source_no", F.explode(F.sequence(
        F.col("first") + F.col("c") * PER_RANGE,
        F.col("first") + F.least(F.col("need"), (F.col("c") + 1) * PER_RANGE) - 1)).alias("point"))
    slot = F.pmod(F.col("point").cast("decimal(19,0)") * F.lit(back).cast("decimal(18,0)"), F.lit(max(k, 1)).cast("decimal(18,0)"))
    slots = points.select("source_no", slot.cast("long").alias("slot")).withColumn("chunk", F.floor(F.col("slot") / (4 * PER_RANGE)))
    stretch = slots.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    stretch = stretch.withColumn("before", F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk")) - F.col("n"))
    # slots come out of a table with a row for each source, whose size says nothing about theirs: no broadcast joins
    slots = slots.withColumn("nth", F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot"))).hint("merge").join(
        stretch.drop("n").hint("merge"), ["source_no", "chunk"]).select("source_no", "slot", (F.col("before") + F.col("nth") - 1).alias("rank"))

    taken = pieces.hint("merge").join(slots.hint("merge"), ["source_no", "rank"]).groupBy("row_no").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("blocks"))
    return known.join(taken, "row_no", "left").select(
        "doc_id", "text_key", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        "first_slot", F.coalesce("blocks", F.lit(0).cast("long")).alias("blocks"), "row_no")


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              length_col: str | None = "n_chars", **how) -> DataFrame:
    """``docs`` as the mix takes them: a row for each whole copy, and for a part its first words, joined by spaces.

    All columns are kept; ``length_col`` (if there) is the code points of a cut text.
    Rows of a partition come in the order of their first slots. Texts without words are
    in no mix and go.
    """
    mix = mix_sources(docs, id_col, text_col, source_col, **how).where("taken > 0")
    i, t, nth, size, taken, slot, words = fresh(docs, "id", "key", "nth", "size", "taken", "slot", "words")
    key = Window.partitionBy(i, t)
    mix = mix.select(F.struct("doc_id").alias(i), F.col("text_key").alias(t), F.col("row_no"), F.col("size").alias(size),
                     F.col("taken").alias(taken), F.col("first_slot").alias(slot))
    mix = mix.withColumn(nth, F.row_number().over(key.orderBy("row_no"))).drop("row_no")
    marked = docs.withColumns({i: F.struct(F.col(id_col).alias("doc_id")), t: F.xxhash64(text_or_empty(text_col))})
    both = marked.withColumn(nth, F.row_number().over(key.orderBy(F.lit(1))))
    # the numbers as bounds, not as a third key: the texts lie by (id, text) already and are not shuffled again
    mix = mix.select(F.col(i).alias("mix_i"), F.col(t).alias("mix_t"), F.col(nth).alias("mix_nth"), size, taken, slot)
    both = both.join(mix, (both[i] == mix["mix_i"]) & (both[t] == mix["mix_t"]) & (both[nth] >= mix["mix_nth"]) & (both[nth] <= mix["mix_nth"]))
    whole = F.array_repeat(F.col(size), F.floor(F.col(taken) / F.col(size)).cast("int"))
    part = F.col(taken) % F.col(size)
    both = both.withColumn(words, F.explode(F.concat(whole, F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))))
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all(text_col, F.lit(f"({WORD})"), F.lit(1)), 1, F.col(words).cast("int")))
    is_cut = F.col(words) < F.col(size)
    both = both.sortWithinPartitions(slot).withColumn(text_col, F.when(is_cut, cut).otherwise(F.col(text_col)))
    if length_col in docs.columns:
        both = both.withColumn(length_col, F.when(is_cut, F.char_length(text_col)).otherwise(F.col(length_col)).cast(docs.schema[length_col].dataType))
    return both.select(*all_columns(docs))
