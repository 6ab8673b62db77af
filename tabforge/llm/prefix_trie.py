"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

Conversations are rebuilt turn by turn (a head that a block of five shares, then their own). A node is a distinct
sequence of first turns; it is told by running sums of hashes of (place, role, text), 128 bits, which
need no order of summation, so a conversation of any length is spread over many tasks. A node is
owned by its smallest member, and its rows of membership (conversation, depth, node) name its ancestors.

Rollup of node values over subtrees: a component of the forest has a centroid, the lowest node with at
least half of the component below it. The centroid's own total within the component (it and all below it) is
added to every node on the path from it to the component's top. Then the centroid goes, each of its
children's subtrees is a component of its own, the rest stays one, and all are taken again. No part
is more than half as large, so a node gets one addend a round, and rounds grow with the logarithm of the
nodes, however deep the trie is. Components above a bound are split in rounds of joins; those within it
are dealt to tasks, which go on by the same rule in arrays. Subtree sizes, by which centroids are chosen, are
counted once from the memberships and then kept by subtraction on the paths.

A digest over the conversations that end at a node needs one sequence of bytes; ids are joined to
blocks where they lie in order, so that the last step reads a row for a block, and it holds one block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import running_sum
from .common import materialize, text_or_empty

#: Nodes of a component that a task finishes alone; ids of a block of the digest.
BUDGET = 100_000
BLOCK = 10_000
#: Conversations that share a head; lengths of heads are below HEADS.
SHARING, HEADS = 5, 9


def decompose(parent: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Subtree sums of ``values`` (each node's own included) in a forest of parent indices (-1: a top)."""
    n = len(parent)
    child_of = np.argsort(parent, kind="stable")
    first = np.searchsorted(parent[child_of], np.arange(n), "left")
    last = np.searchsorted(parent[child_of], np.arange(n), "right")
    pre, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    top, count = np.full(n, -1, np.int64), 0
    for root in np.flatnonzero(parent < 0).tolist():
        stack = [root]
        while stack:
            v = stack.pop()
            if v < 0:  # all below it are done
                end[~v] = count
                continue
            pre[v], top[v], count = count, root, count + 1
            stack.append(~v)
            stack += child_of[first[v]:last[v]].tolist()
    out = [np.zeros(n, v.dtype) for v in values]
    live = np.arange(n)
    while len(live):
        live = live[np.lexsort((pre[live], top[live]))]
        _, start, comp, total = np.unique(top[live], return_index=True, return_inverse=True, return_counts=True)
        key = comp * (n + 1) + pre[live]  # ascending
        size = np.searchsorted(key, comp * (n + 1) + end[live], "left") - np.arange(len(live))
        half = np.flatnonzero(2 * size >= total[comp])
        half = half[np.lexsort((size[half], comp[half]))]
        at = half[np.searchsorted(comp[half], np.arange(len(total)), "left")]  # place of each component's centroid
        c, c_size = live[at], size[at]
        place = np.arange(len(live))
        below = (place > at[comp]) & (place < (at + c_size)[comp])
        path = (pre[live] <= pre[c][comp]) & (pre[c][comp] < end[live])
        for v, o in zip(values, out):
            run = np.concatenate((np.zeros(1, v.dtype), np.cumsum(v[live])))
            o[live[path]] += (run[at + c_size] - run[at])[comp[path]]
        branch = np.maximum.accumulate(np.where(below & (parent[live] == c[comp]), place, -1))
        top[live[below]] = live[branch[below]]
        gone = np.zeros(len(live), bool)
        gone[at] = True
        rest = ~below & ~gone  # what is left above keeps its top
        live = live[below | rest]
    return out


def rebuilt_turns(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv) of all conversations, and (conv, depth, digest, size) of their rebuilt turns."""
    role, text = text_or_empty(F.col(role_col).cast("string")), text_or_empty(text_col)
    rows = messages.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.md5(text.cast("binary")).alias("body"),
        F.octet_length(text).cast("long").alias("size"))
    # rows that are equal in all of these may lie in any order
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "body"]
    salted = rows.withColumn("salt", F.monotonically_increasing_id() % 1024)
    dealt = materialize(salted.repartitionByRange(*order, "salt").sortWithinPartitions(*order).select(
        "conv", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "body").cast("binary")).alias("digest"), "size",
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")), "trie-turns")
    spans = dealt.groupBy("conv", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv", "part", F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0)) - 1).toDF("conv", "part", "before")
    turns = materialize(dealt.join(spans, ["conv", "part"]).select("conv", (F.col("id") - F.col("before")).alias("pos"), "digest", "size"), "trie-places")
    base = lambda c: F.col(c) - F.col(c) % SHARING
    head = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % HEADS
    convs = dealt.groupBy("conv").agg(F.count("*").alias("n")).withColumn("base", base("conv"))
    bases = convs.select(F.col("conv").alias("of"), F.col("n").alias("base_n"))
    convs = materialize(convs.join(bases, F.col("base") == F.col("of"), "left").select(
        "conv", "base", head("conv").alias("h"), F.least(head("conv"), F.coalesce("base_n", F.lit(0))).alias("taken")), "trie-convs")
    heads = turns.where((F.col("conv") % SHARING == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv", "of")
    shared = convs.select("conv", "base", "h").join(heads, (F.col("base") == F.col("of")) & (F.col("pos") <= F.col("h"))).select(
        "conv", F.col("pos").alias("depth"), "digest", "size")
    own = turns.join(convs.select("conv", "h", "taken"), "conv").where(F.col("pos") > F.col("h")).select(
        "conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "digest", "size")
    return convs.select("conv"), shared.unionAll(own)


def memberships(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (nid, owner, depth, n_convs, size) and memberships (conv, depth, nid), the root at depth 0 in both."""
    parts = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), "depth", "digest")
        parts += [h.bitwiseAND(F.lit(0xFFFFFFFF)).alias(f"h{2 * seed}"), F.shiftrightunsigned(h, 32).alias(f"h{2 * seed + 1}")]
    names = [f"h{i}" for i in (2, 3, 4, 5)]
    run = running_sum(turns.select("conv", "depth", "size", *parts), ["depth"], names, ["conv"])
    paths = materialize(run.select("conv", "depth", "size", *[F.col(f"cum_{n}").alias(n) for n in names]), "trie-paths")
    inner = paths.groupBy("depth", *names).agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs"), F.max("size").alias("size"))
    root = convs.agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs")).where("n_convs > 0")
    inner = materialize(inner.withColumn("nid", F.monotonically_increasing_id()), "trie-nodes")
    nodes = inner.select("nid", "owner", "depth", "n_convs", "size").unionAll(
        root.select(F.lit(-1).cast("long"), "owner", F.lit(0).cast("long"), "n_convs", F.lit(0).cast("long")))
    members = paths.select("conv", "depth", *names).join(inner.select("nid", "depth", *names), ["depth", *names]).select("conv", "depth", "nid")
    members = members.unionAll(convs.select("conv", F.lit(0).cast("long"), F.lit(-1).cast("long")))
    return nodes, materialize(members, "trie-members")


def _sizes(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(nid, below) nodes of each subtree: of each member, what it owns at the node's depth and deeper."""
    owned = nodes.groupBy(F.col("owner").alias("conv")).agg(F.min("depth").alias("a"), F.max("depth").alias("z"))
    return members.join(owned, "conv").groupBy("nid").agg(
        F.sum(F.col("z") - F.greatest("a", "depth") + 1).alias("below"))


def rollup(nodes: DataFrame, members: DataFrame, values: list[str], budget: int = BUDGET) -> DataFrame:
    """``nodes`` (nid, owner, depth, parent, values...) to (nid, values...) summed over each subtree."""
    up = members.select(F.col("conv").alias("m_conv"), F.col("depth").alias("m_depth"), F.col("nid").alias("m_nid"))
    steps = materialize(up.join(nodes.select(F.col("nid").alias("m_nid"), F.col("parent").alias("m_parent")), "m_nid"), "trie-steps")
    state = nodes.join(_sizes(members, nodes), "nid").withColumn("comp", F.lit(-1).cast("long"))
    state = state.select("nid", "owner", "depth", "parent", *values, "below", "comp")
    parts, small = [], []
    while True:
        # stored with the size of each component: its top has all of it below
        tops = state.groupBy("comp").agg(F.max("below").alias("all"))
        state = materialize(state.join(tops, "comp"), "trie-state")
        small.append(state.where(F.col("all") <= budget))
        state = state.where(F.col("all") > budget)
        if state.isEmpty():
            break
        cut = state.where(2 * F.col("below") >= F.col("all")).groupBy("comp").agg(
            F.min(F.struct("below", F.col("nid").alias("c"), F.col("owner").alias("c_owner"), F.col("depth").alias("c_depth"))).alias("x"))
        cut = materialize(cut.select("comp", "x.c", "x.c_owner", "x.c_depth", F.col("x.below").alias("c_below")), "trie-centroids")
        every = state.drop("all").join(cut, "comp")
        # a node is below the centroid if its owner's path goes on from there; on the path up if the centroid's owner is a member
        child = steps.select("m_conv", "m_parent", F.col("m_nid").alias("child"))
        every = every.join(child, (F.col("owner") == F.col("m_conv")) & (F.col("c") == F.col("m_parent")), "left").drop("m_conv", "m_parent")
        held = steps.select("m_conv", "m_nid")
        every = every.join(held, (F.col("c_owner") == F.col("m_conv")) & (F.col("nid") == F.col("m_nid")), "left")
        every = materialize(every.withColumn("under", F.col("child").isNotNull() & (F.col("depth") > F.col("c_depth"))).withColumn(
            "path", F.col("m_nid").isNotNull() & (F.col("depth") <= F.col("c_depth"))).drop("m_conv", "m_nid"), "trie-split")
        total = every.where(F.col("under") | (F.col("nid") == F.col("c"))).groupBy("comp").agg(*[F.sum(v).alias(f"t_{v}") for v in values])
        parts.append(every.where("path").select("nid", "comp").join(total, "comp").select("nid", *[F.col(f"t_{v}").alias(v) for v in values]))
        state = every.where(F.col("nid") != F.col("c")).select(
            "nid", "owner", "depth", "parent", *values, F.when(F.col("path"), F.col("below") - F.col("c_below")).otherwise(F.col("below")).alias("below"),
            F.when(F.col("under"), F.col("child")).otherwise(F.col("comp")).alias("comp"))
    rest = small[0]
    for s in small[1:]:
        rest = rest.unionAll(s)

    def finish(table: pa.Table) -> pa.Table:
        nid, parent, comp = (table[c].to_numpy() for c in ("nid", "parent", "comp"))
        order = np.argsort(nid)
        at = np.minimum(np.searchsorted(nid, parent, sorter=order), len(nid) - 1)
        p = order[at]
        p = np.where((nid[p] == parent) & (comp[p] == comp), p, -1)
        sums = decompose(p, [table[v].to_numpy() for v in values])
        return pa.table({"nid": nid, **dict(zip(values, sums))})

    groups = rest.agg(F.floor(F.count("*") / budget).alias("n")).first()["n"] + 1
    rest = rest.select("nid", F.coalesce("parent", F.lit(-2)).alias("parent"), "comp", *values, F.pmod(F.xxhash64("comp"), F.lit(groups)).alias("g"))
    parts.append(rest.groupBy("g").applyInArrow(finish, "nid long, " + ", ".join(f"{v} long" for v in values)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionAll(p)
    return every.groupBy("nid").agg(*[F.sum(v).alias(v) for v in values])


def end_digests(ends: DataFrame) -> DataFrame:
    """(nid, conv) to (nid, ends_sha256) of the comma-joined ids in ascending order."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nid, conv = b["nid"].to_numpy(), b["conv"].to_numpy()
            cut = np.flatnonzero(np.concatenate(([True], nid[1:] != nid[:-1])))
            cut = np.unique(np.concatenate((cut, np.arange(0, len(nid), BLOCK), [len(nid)])))
            text = [",".join(map(str, conv[a:z].tolist())) for a, z in zip(cut[:-1], cut[1:])]
            yield pa.record_batch({"nid": nid[cut[:-1]], "first": conv[cut[:-1]], "ids": pa.array(text, pa.string())})

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for b in batches:
            done = []
            for nid, ids in zip(b["nid"].to_pylist(), b["ids"].to_pylist()):
                if nid != now:
                    if h is not None:
                        done.append((now, h.hexdigest()))
                    now, h = nid, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pa.record_batch({"nid": pa.array([x for x, _ in done], pa.int64()), "ends_sha256": pa.array([x for _, x in done], pa.string())})
        if h is not None:
            yield pa.record_batch({"nid": pa.array([now], pa.int64()), "ends_sha256": pa.array([h.hexdigest()], pa.string())})

    near = ends.repartitionByRange("nid", "conv").sortWithinPartitions("nid", "conv").mapInArrow(blocks, "nid long, first long, ids string")
    return near.repartition("nid").sortWithinPartitions("nid", "first").drop("first").mapInArrow(digests, "nid long, ends_sha256 string")


def prefix_trie(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                budget: int = BUDGET) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Defined cases: turns go by turn (null first), then role, then the MD5 of the text; equal rows are turns of their own.
    Rows without a conversation belong to none and are left out; null roles and texts count as empty. A
    conversation that is rebuilt without turns is a member of the root alone. An empty table gives an empty
    result. Other columns are ignored.
    """
    convs, turns = rebuilt_turns(messages, conv_col, turn_col, role_col, text_col)
    nodes, members = memberships(convs, turns)
    above = members.select(F.col("conv").alias("owner"), (F.col("depth") + 1).alias("depth"), F.col("nid").alias("parent"))
    nodes = nodes.join(above, ["owner", "depth"], "left")
    children = nodes.groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children.where("of is not null"), F.col("nid") == F.col("of"), "left").select(
        "nid", "owner", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    nodes = materialize(nodes, "trie-tree")
    sums = rollup(nodes.select("nid", "owner", "depth", "parent", "n_leaves", "saved_tokens"), members, ["n_leaves", "saved_tokens"], budget)
    ends = members.groupBy("conv").agg(F.max(F.struct("depth", "nid")).alias("x")).select(F.col("x.nid").alias("nid"), "conv")
    owners = nodes.select(F.col("nid").alias("p_nid"), F.col("owner").alias("parent_conv_id"))
    # both sides are joined by node; a hot parent is a hot key of one side only
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, "nid").join(end_digests(ends), "nid", "left").join(
        owners, F.col("parent") == F.col("p_nid"), "left")
    return out.select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
