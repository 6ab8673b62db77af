"""Document fingerprints from closed syncmers.

A k-mer of characters is a closed syncmer if its least inner s-mer (by hash) is
its first or its last. The choice depends on the k-mer alone, not on what
surrounds it, so an edit only moves the anchors it touches, and any window of
``k - s`` k-mers has one. Anchors with their positions serve positional matching
(``anchors``, ``aligned_share``); the document's fingerprint is a sketch of its set of anchors: for
each of ``bins`` ranges of their hashes, 16 bits of the least one. The share of agreeing
bins estimates the Jaccard similarity j of two anchor sets, and the likeness is
2 j / (1 + j), the share of anchors that they have in common.

The query compares each document with its successor by id, which needs the neighbours side
by side: one range shuffle by id and text hash, with the first document of each range
also sent to the range before. Ranges are cut at quantiles, so none holds much more than its share, null and repeated ids included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import text_or_empty

K, S, BINS = 16, 9, 128
#: Texts under this length also have anchors of these sizes.
SHORT, SHORT_K, SHORT_S = 64, 4, 2
#: Documents that a range of ids should hold, ranges at most, and range cuts that are looked through at a time.
PER_RANGE, MAX_RANGES, STRIDE = 2048, 1 << 16, 256

_SHARES = ["near_edited", "near_next", "aligned_edited", "aligned_next"]

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX2
    return h ^ (h >> np.uint64(27))


def _rolling(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of each window of n characters, by doubling: the window's halves are combined."""
    h, size = _scramble((points + np.uint64(1)) * _MIX), 1
    parts, done, rest = [], 0, n
    while rest:  # windows of the sizes in n's binary form, one after another
        if rest & 1:
            parts.append((h, done, size))
            done += size
        rest >>= 1
        if rest:
            h = _scramble(h[:-size] * _MIX + h[size:]) if len(h) > size else h[:0]
            size *= 2
    count = len(points) - n + 1
    out = np.zeros(max(0, count), np.uint64)
    for h, at, _ in parts:
        out = _scramble(out * _MIX + h[at:at + count]) if count > 0 else out
    return out


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the closed syncmers of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(points) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inner, width = _rolling(points, s), k - s + 1
    least, size = inner, 1
    while size < width:  # least of each run of ``width`` s-mers
        step = min(size, width - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    n = len(points) - k + 1
    at = np.nonzero((inner[:n] == least[:n]) | (inner[width - 1:width - 1 + n] == least[:n]))[0]
    return _rolling(points, k)[at], at


def text_anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a text, short ones included: those too short for any anchor have one, the hash of the whole;
    an empty text has none."""
    h, at = anchors(text, k, s)
    if len(text) < SHORT:
        few, their = anchors(text, SHORT_K, SHORT_S)
        h, at = np.concatenate((h, few)), np.concatenate((at, their))
    if not len(h) and text:
        h = np.array([int.from_bytes(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:8], "little")], np.uint64)
        at = np.zeros(1, np.int64)
    return h, at


def sketch(text: str, bins: int = BINS, k: int = K, s: int = S) -> np.ndarray:
    """16 bits for each range of hashes, as int32; -1 where there is no anchor."""
    return sketch_of(text_anchors(text, k, s)[0], bins)


def sketch_of(h: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The sketch of a text's anchors."""
    out = np.full(bins, -1, np.int32)
    h = np.sort(h)
    low = np.searchsorted(h, np.arange(bins, dtype=np.uint64) * np.uint64(2 ** 64 // bins))
    full = low < np.append(low[1:], len(h))
    out[full] = (h[low[full]] & np.uint64(0xFFFF)).astype(np.int32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of anchors in common, 0 to 1, from two sketches; 1 for two empty texts."""
    used = (a >= 0) | (b >= 0)
    if not used.any():
        return 1.0
    j = float((used & (a == b)).sum() / used.sum())
    return 2 * j / (1 + j)


def to_text(sketch_: np.ndarray) -> str:
    """Four hex digits for each bin, four dots for an empty one; an empty text's is empty."""
    return "".join("...." if v < 0 else f"{v:04x}" for v in sketch_.tolist()) if (sketch_ >= 0).any() else ""


def from_text(fingerprint: str, bins: int = BINS) -> np.ndarray:
    """The sketch that ``to_text`` wrote."""
    if not fingerprint:
        return np.full(bins, -1, np.int32)
    return np.array([-1 if fingerprint[i] == "." else int(fingerprint[i:i + 4], 16) for i in range(0, 4 * bins, 4)], np.int32)


def aligned(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of a's anchors whose first place in b lies at the most common shift; 1 for two texts without anchors."""
    (ha, pa_), (hb, pb) = a, b
    if not len(ha) or not len(hb):
        return float(len(ha) == len(hb))
    known, first = np.unique(hb, return_index=True)  # positions ascend within a size, so the first one of a hash is its least
    at = np.minimum(np.searchsorted(known, ha), len(known) - 1)
    found = known[at] == ha
    shift = pb[first[at[found]]] - pa_[found]
    return float(np.unique(shift, return_counts=True)[1].max() / len(ha)) if len(shift) else 0.0


def aligned_share(a: str, b: str, k: int = K, s: int = S) -> float:
    """Positional matching of two texts."""
    return aligned(text_anchors(a, k, s), text_anchors(b, k, s))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, k: int = K, s: int = S) -> DataFrame:
    """(doc_id, n_chars, fingerprint) per row, in one narrow pass. A null text is empty; repeated rows give equal rows."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    schema = StructType([narrow.schema["doc_id"], StructField("n_chars", LongType()), StructField("fingerprint", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(len(t.as_py()), to_text(sketch(t.as_py(), bins, k, s))) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.string())], schema.names)

    return narrow.mapInArrow(run, schema)


def ranges(rows: DataFrame, per_range: int) -> tuple[DataFrame, int]:
    """Rows (doc_id, t) with their key (id, text hash) and part, a range of keys with about ``per_range`` rows, and the number of ranges."""
    rows = rows.withColumn("key", F.struct("doc_id", F.xxhash64("t").alias("h")))
    n = rows.count()
    parts = min(MAX_RANGES, -(-n // per_range))
    # a cut of the hashes: about 20 keys a range arrive in all, however many partitions there are
    share = min(1 << 30, 20 * parts * (1 << 30) // n) if parts > 1 else 0
    some = rows.select("key").where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share).distinct()
    some = [r[0] for r in some.orderBy("key").select(F.to_json("key")).collect()] if share else []
    cuts = list(dict.fromkeys(some[len(some) * i // parts] for i in range(1, parts))) if len(some) >= parts else []
    kind = f"array<{rows.schema['key'].dataType.simpleString()}>"
    fixed = lambda values: F.from_json(F.lit(f"[{','.join(values)}]"), kind)
    below = lambda a: F.size(F.filter(a, lambda c: c < F.col("key")))
    coarse = below(fixed(cuts[STRIDE - 1::STRIDE])) * STRIDE
    # numbered downwards: range 0 has the largest keys, the last one the smallest and the null ids
    part = len(cuts) - coarse - below(F.slice(fixed(cuts), coarse + 1, STRIDE)) if cuts else F.lit(0)
    rows = rows.withColumn("part", part.cast("int"))
    return rows, len(cuts) + 1


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to that and to the next document.

    The next document is the one of the next smaller id, after the smallest the largest. The edited text has
    its last third of code points replaced by the first as many of the next document.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (likeness of the
    fingerprints), aligned_edited, aligned_next (share of its anchors that lie at one shift in the other text).

    Defined cases: a null text is empty; a null id comes after all others; rows
    that repeat an id are ordered by the xxhash64 of their texts, downwards; a single document is its own next one. An empty
    table gives an empty result. Ids may be of any type that can be ordered. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    rows, _ = ranges(rows, PER_RANGE)
    # the first document of a range also goes to the range before as its guest, that of the first range to the last
    line = Window.orderBy("part")  # a row for each range
    heads = rows.groupBy("part").agg(F.max("key").alias("head"))
    heads = heads.select("part", "head", F.coalesce(F.lag("part").over(line), F.max("part").over(
        line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    to = F.when(F.col("key") == F.col("head"), F.col("before"))
    dealt = rows.join(F.broadcast(heads), "part").select("key", "t", F.explode(F.array(
        F.struct(F.col("part"), F.lit(0).alias("guest")), F.struct(to.alias("part"), F.lit(1).alias("guest")))).alias("x"))
    dealt = dealt.select("x.part", "x.guest", "key.doc_id", "t", "key").where("part is not null")
    dealt = dealt.repartition("part").sortWithinPartitions("part", "guest", F.desc("key"), "t").drop("key")
    schema = StructType([
        rows.schema["doc_id"], StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
        StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()),
        *(StructField(c, DoubleType()) for c in _SHARES[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the document that waits for its successor: part, id, text, anchors, sketch
        closed = None  # the range whose guest has come
        for b in batches:
            out = []
            for part, guest, doc_id, t in zip(*(b.column(i) for i in range(4))):
                part, guest, text = part.as_py(), guest.as_py(), t.as_py()
                if guest and closed == part:
                    continue
                at = text_anchors(text)
                mine = sketch_of(at[0])
                if last is not None and last[0] == part:
                    _, its_id, its_text, its_at, its = last
                    m = len(its_text) // 3
                    edited = its_text[:len(its_text) - m] + text[:m]
                    new_at = text_anchors(edited)
                    changed = sketch_of(new_at[0])
                    out.append((its_id, len(its_text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(its),
                                to_text(changed), likeness(its, changed), likeness(its, mine), aligned(its_at, new_at), aligned(its_at, at)))
                last = None if guest else (part, doc_id.as_py(), text, at, mine)
                closed = part if guest else closed
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(form(b))], schema=form(b))

    def form(b: pa.RecordBatch) -> pa.Schema:
        return pa.schema([("doc_id", b.schema.field(2).type), ("n_chars", pa.int64()), *((c, pa.string()) for c in schema.names[2:5]),
                          *((c, pa.float64()) for c in _SHARES)])

    return dealt.mapInArrow(run, schema)
