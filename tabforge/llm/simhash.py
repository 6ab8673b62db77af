"""SimHash near-duplicates through vantage-point trees.

Fingerprints: 64 bits over word shingles, computed in one narrow pass, so texts
are never shuffled. Links: all pairs of different fingerprints at ``max_bits``
or fewer differing bits, exact.

Whole 64-bit Hamming distances between unrelated fingerprints crowd around 32,
where a ball's border holds most points and triangle bounds prune little.
So there is one vantage-point tree for each of ``max_bits // 2 + 1`` slices of the
bits: the Hamming distance within a slice is a (pseudo)metric too, and a pair
within ``max_bits`` overall is within 1 bit on at least one slice. A node
holds a vantage value and a radius; points within the radius go inside, others
outside, and outside points within the slice bound of the border are copied
inside as well. By the triangle inequality every linked pair meets in a leaf.

The top of each tree is fitted on a bounded sample (``SAMPLE``) and only decides
shards, never results; a task then goes on splitting its shard by the same rule
and compares the points of a leaf exactly. Leaves give spanning links, not all
pairs, so a family of k copies costs k rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import all_columns, fresh, materialize, text_or_empty
from .components import connected_components

#: Fingerprints that the tops of the trees are fitted on, at most.
SAMPLE = 65536
#: Fingerprints that one shard should hold, before border copies; at most SAMPLE // 16 shards a tree.
PER_SHARD = 2048
#: Points of a leaf, compared with each other.
LEAF = 192

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """The fingerprint (signed 64 bits) of a UTF-8 text: 0 without any word."""
    w = (text or b"").translate(_LOWER).split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    first = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
    last = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = list(zip(first[k:k + (1 << 16)], last[k:k + (1 << 16)]))
        h = np.fromiter((digest(joined[a:b], seed) for a, b in part), "<u8", len(part))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp) per row; a null text is empty, and an empty text has fingerprint 0."""
    text = text_or_empty(text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("t"))
    schema = StructType([*narrow.schema.fields[:2], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([simhash(t.as_py(), words, seed) for t in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fp], ["doc_id", "text_key", "fp"])

    return narrow.mapInArrow(run, schema)


# --- vantage-point trees -----------------------------------------------------

def slices_of(max_bits: int) -> list[tuple[np.uint64, int]]:
    """(mask, bound) of each slice: a pair within ``max_bits`` is within ``bound`` on at least one."""
    m = max_bits // 2 + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(np.uint64(((1 << (b - a)) - 1) << a), max_bits // m) for a, b in zip(cuts, cuts[1:])]


def _split(x: np.ndarray, mask: np.uint64, bound: int) -> tuple[np.uint64, int] | None:
    """Vantage value and radius that leave the least work, of a few tries; None if nothing can be parted."""
    best = None
    for v in x[:: max(1, len(x) // 5)][:5]:
        c = np.bincount(np.bitwise_count((x ^ v) & mask), minlength=66).cumsum()
        inside = np.minimum(c[np.minimum(np.arange(65) + bound, 65)], len(x))
        outside = len(x) - c[:65]
        cost = inside.astype(float) ** 2 + outside.astype(float) ** 2
        cost[(outside == 0) | (inside == len(x))] = np.inf
        r = int(cost.argmin())
        if cost[r] < np.inf and (best is None or cost[r] < best[0]):
            best = (cost[r], v, r)
    return best and (best[1], best[2])


def fit_tree(sample: np.ndarray, mask: np.uint64, bound: int, depth: int) -> tuple:
    """A nested (vantage, radius, inside, outside), or () for a leaf."""
    cut = _split(sample, mask, bound) if depth and len(sample) > 1 else None
    if cut is None:
        return ()
    d = np.bitwise_count((sample ^ cut[0]) & mask)
    return (*cut, fit_tree(sample[d <= cut[1]], mask, bound, depth - 1), fit_tree(sample[d > cut[1]], mask, bound, depth - 1))


def route(tree: tuple, x: np.ndarray, mask: np.uint64, bound: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, positions in x) for every leaf that any point belongs to or borders on."""
    todo = [(tree, 1, np.arange(len(x)))]
    while todo:
        node, name, at = todo.pop()
        if not len(at):
            continue
        if not node:
            yield name, at
            continue
        v, r, inside, outside = node
        d = np.bitwise_count((x[at] ^ v) & mask)
        todo += [(inside, 2 * name, at[d <= r + bound]), (outside, 2 * name + 1, at[d > r])]


def _hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union of linked positions, in place: label points to the smallest position reached."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def link_shard(x: np.ndarray, mask: np.uint64, bound: int, max_bits: int) -> np.ndarray:
    """label[i]: smallest position that i reaches over pairs found in this shard."""
    label = np.arange(len(x))
    whole = np.uint64(2 ** 64 - 1)
    todo = [(np.arange(len(x)), mask, bound)]
    while todo:
        at, m, b = todo.pop()
        if len(at) < 2:
            continue
        y = x[at]
        if len(at) > LEAF:
            cut = _split(y, m, b)
            if cut is not None:
                d = np.bitwise_count((y ^ cut[0]) & m)
                todo += [(at[d <= cut[1] + b], m, b), (at[d > cut[1]], m, b)]
                continue
            if m != whole:  # alike on this slice: go on over all bits
                todo.append((at, whole, max_bits))
                continue
        for k in range(0, len(at), LEAF):
            i, j = np.nonzero(np.bitwise_count(y[k:k + LEAF, None] ^ y[None, :]) <= max_bits)
            i += k
            if (up := i < j).any():
                _hook(label, at[i[up]], at[j[up]])
    return label


def fingerprint_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): spanning links between different fingerprints (column fp, distinct) within ``max_bits``."""
    spark = distinct.sparkSession
    n = distinct.count()
    parts = slices_of(max_bits)
    depth = 0
    while (1 << depth) * PER_SHARD < n and (1 << depth) < SAMPLE // 16:
        depth += 1
    # a cut of the hashes: about SAMPLE rows arrive in all, however many partitions there are
    order, share = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)), min(1 << 30, SAMPLE * (1 << 30) // max(n, 1))
    rows = sorted(distinct.where(order < share).select(order, "fp").collect()) if depth else []
    sample = np.array([r[1] for r in rows], np.int64).view(np.uint64)
    trees = [fit_tree(sample, m, b, depth) for m, b in parts]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for t, (tree, (m, b)) in enumerate(zip(trees, parts)):
                for leaf, at in route(tree, fp.view(np.uint64), m, b):
                    shard = np.full(len(at), leaf * len(parts) + t, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fp[at])], ["shard", "fp"])

    def link(table: pa.Table) -> pa.Table:
        fp = np.sort(table.column("fp").to_numpy().astype(np.int64))
        m, b = parts[table.column("shard")[0].as_py() % len(parts)]
        label = link_shard(fp.view(np.uint64), m, b, max_bits)
        at = np.nonzero(label != np.arange(len(fp)))[0]
        return pa.table({"a": fp[at], "b": fp[label[at]]})

    dealt = distinct.select("fp").mapInArrow(deal, "shard long, fp long")
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    return dealt.groupBy("shard").applyInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4,
                    seed: int = 42) -> DataFrame:
    """One row per input row: doc_id, text_key, fp, component_fp (names the component), component_id (smallest id
    reachable over links, itself included).

    Defined cases: null and empty texts have fingerprint 0 and link like any
    other; equal fingerprints are one component; null ids take the component of
    their fingerprint and never name one (a component of null ids only has a null
    component_id); repeated rows stay. An empty table gives an empty result.
    Columns other than the two named are ignored.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, words, seed), "simhash")
    groups = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-groups")
    groups = groups.withColumn("component_fp", F.col("fp"))
    if max_bits > 0:
        stars = connected_components(fingerprint_links(groups.select("fp"), max_bits))
        members = stars.select(F.col("node").alias("fp"), "root").unionAll(stars.select("root", "root").distinct())
        linked = members.join(groups, "fp")
        named = linked.join(linked.groupBy("root").agg(F.min("least_id").alias("linked_id")), "root").select("fp", "root", "linked_id")
        groups = groups.join(named, "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("component_fp"),
            F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("linked_id")).alias("least_id"))
        # stored, so that the join below has plain shuffles on both sides and Spark can split a hot fingerprint's rows
        groups = materialize(groups, "simhash-components")
    return rows.join(groups, "fp").select("doc_id", "text_key", "fp", "component_fp", F.col("least_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component, all columns kept: the one of smallest id (null last), then smallest text key.

    Rows that repeat both id and text are reduced to one where they already lie together.
    """
    found = near_duplicates(docs, id_col, text_col, **how)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    keep = found.groupBy("component_fp").agg(first.alias("k")).select(
        F.struct("k.doc_id").alias("keep_id"), F.col("k.text_key").alias("keep_text"))
    i, t = fresh(docs, "id", "key")
    marked = docs.withColumns({i: F.struct(F.col(id_col).alias("doc_id")), t: F.xxhash64(text_or_empty(text_col))})
    kept = marked.join(keep, (marked[i] == keep["keep_id"]) & (marked[t] == keep["keep_text"]), "left_semi")
    return kept.dropDuplicates([i, t]).select(*all_columns(docs))
