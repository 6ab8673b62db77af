"""Phrase collocations from word suffixes, counted by vertical partitioning (after ERA).

A suffix is an occurrence of a word with up to four words after it in its piece. All
counts f(phrase) are sums over the suffixes that begin with the phrase, the leaf totals of a suffix
tree truncated at five words. The tree is never built whole:

1. Word prefixes are counted, one word first. A prefix with more suffixes than the memory budget is
   extended by a word and counted again, until none is above it or its depth is reached. Each round is
   one narrow pass; prefixes are told apart by 64-bit hashes, which only decide where a suffix goes.
2. Prefixes within the budget are put into groups of consecutive hashes with at most two budgets of
   suffixes. A group is known by its least hash.
3. A pass deals the suffixes to their groups, in compressed blocks with equal suffixes of a block combined.
   Each group sorts its suffixes and reads the counts of all its nodes from runs of the sorted rows.
   Nodes above a group's prefix get a part from each group and are summed at the end. Four-word prefixes that are
   still above the budget need no tree: their suffixes, combined, are summed by Spark as they are.

What reaches the driver and each task is a hash for each group and for each prefix above the budget, both at most
the words of the corpus divided by the budget (plus one a level): as many as there are tasks, by which
Spark's own range partitioning is bounded too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import running_sum
from .common import materialize

DEPTH = 5
#: Suffixes of a prefix that a group takes whole; a group holds up to twice as many.
BUDGET = 1_000_000
#: Bytes of text that a pass works on at once.
CHUNK = 8_000_000

# Kinds of bytes: of a word, between words, between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of many texts: codes into ``vocabulary``, language of each, and up to four codes after it (-1: none)."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        langs = pc.fill_null(langs.cast(pa.large_string()), "und").dictionary_encode()
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        kind, edge = KIND[raw], np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        word = kind == 0
        joined = np.concatenate(([False], word, [False]))
        start = np.flatnonzero(word & (~joined[:-2] | edge[:-1]))
        end = np.flatnonzero(word & (~joined[2:] | edge[1:])) + 1
        at = np.concatenate(([0], np.cumsum(end - start)))
        values = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(at), pa.py_buffer(LOWER[raw[word]])]).dictionary_encode()
        self.vocabulary: pa.Array = values.dictionary
        self.codes = values.indices.to_numpy().astype(np.int64)
        row = np.searchsorted(offsets, start, "right") - 1
        self.languages: list[str] = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy()[row]
        piece = np.cumsum(kind == 2, dtype=np.int64)[start] if len(start) else np.empty(0, np.int64)
        n = len(start)
        on = np.zeros(n, bool)
        if n:
            on[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
        self.after = [self.codes]
        reach = np.ones(n, bool)
        for k in range(1, DEPTH):
            reach = reach & np.concatenate((on[k - 1:], np.zeros(min(k - 1, n), bool)))
            follow = np.full(n, -1, np.int64)
            follow[:max(n - k, 0)] = self.codes[k:]
            self.after.append(np.where(reach, follow, -1))
        self._hash = np.array([xxhash.xxh64_intdigest(w.as_buffer()) for w in self.vocabulary], np.uint64)

    def hashes(self) -> Iterator[np.ndarray]:
        """Hash of the first 1, 2, ... words of each suffix, its language included; a missing word counts as zero."""
        h = np.array([xxhash.xxh64_intdigest(x.encode(), seed=1) for x in self.languages], np.uint64)[self.lang]
        for codes in self.after:
            nxt = np.where(codes >= 0, self._hash[codes], np.uint64(0)) if len(self._hash) else h
            h = (h ^ nxt) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            h = h ^ (h >> np.uint64(32))
            yield h.view(np.int64)

    def counts(self) -> pa.Table:
        """(lang, word, h, c) of the single words."""
        size = max(len(self.vocabulary), 1)
        key, first, c = np.unique(self.lang * size + self.codes, return_index=True, return_counts=True)
        h = next(self.hashes())[first]
        return pa.table({"lang": pa.array(self.languages, pa.string()).take(pa.array(key // size)),
                         "word": self.vocabulary.take(pa.array(key % size)).cast(pa.string()), "h": h, "c": c})


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= CHUNK:
            yield _words(held)
            held, size = [], 0
    if held:
        yield _words(held)


def _words(batches: list[pa.RecordBatch]) -> Words:
    t = pa.Table.from_batches(batches).combine_chunks()
    one = lambda c: t[c].chunk(0) if t[c].num_chunks else pa.array([], pa.string())
    return Words(one("text"), one("lang"))


def _within(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Is each value in the sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    i = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[i] == values


def _packed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Five columns of codes from 0 in three sort keys."""
    a, b, c, d, e = columns
    return [a << 31 | b, c << 31 | d, e]


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    """First rows of the runs of equal keys."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _phrases(codes: np.ndarray, vocabulary: pa.Array) -> pa.Array:
    """Space-joined words of rows of codes from 1 (0: none, at the end only)."""
    flat = codes[codes > 0] - 1
    at = np.concatenate(([0], np.cumsum((codes > 0).sum(axis=1))))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), vocabulary.take(pa.array(flat))), pa.scalar(" ", pa.large_string()))


def _pack(texts: pa.Array, counts: np.ndarray) -> bytes:
    """Strings and counts as one compressed block."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    head = np.concatenate(([len(texts)], np.diff(offsets), counts)).astype(np.uint32)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + data.tobytes())


def _unpack(blocks: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    lengths, counts, data, z = [], [], [], zstandard.ZstdDecompressor()
    for b in blocks:
        raw = z.decompress(b)
        n = int(np.frombuffer(raw, np.uint32, 1)[0])
        head = np.frombuffer(raw, np.uint32, 2 * n, 4)
        lengths.append(head[:n])
        counts.append(head[n:])
        data.append(raw[4 + 8 * n:])
    at = np.concatenate(([0], np.cumsum(np.concatenate(lengths), dtype=np.int64)))
    return (pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(b"".join(data))]),
            np.concatenate(counts).astype(np.int64))


def subtree(suffixes: pa.Array, counts: np.ndarray, level: int, least: int) -> tuple[pa.Array, np.ndarray]:
    """(phrases, counts) of the nodes at depths 2 to 5 of the suffixes' tree: all above ``level``, else those of ``least``."""
    lists = pc.split_pattern(suffixes, " ")
    words = lists.flatten().dictionary_encode()
    length = pc.list_value_length(lists).to_numpy().astype(np.int64)
    at = np.cumsum(length) - length
    codes = np.zeros((len(suffixes), DEPTH), np.int64)
    codes[np.repeat(np.arange(len(length)), length), np.arange(int(length.sum())) - np.repeat(at, length)] = words.indices.to_numpy() + 1
    keys = _packed(list(codes.T))
    order = np.lexsort(keys[::-1])
    k0, k1, k2 = (k[order] for k in keys)
    codes, counts = codes[order], counts[order]
    texts, totals = [], []
    for depth, key in ((2, [k0]), (3, [k0, k1 >> 31]), (4, [k0, k1]), (5, [k0, k1, k2])):
        first = _runs(key)
        total = np.add.reduceat(counts, first) if len(first) else counts[:0]
        stay = (codes[first, depth - 1] > 0) & ((total >= least) | (depth < level))
        if stay.any():
            rows = codes[first[stay]].copy()
            rows[:, depth:] = 0
            texts.append(_phrases(rows, words.dictionary))
            totals.append(total[stay])
    return (pa.concat_arrays(texts), np.concatenate(totals)) if texts else (pa.array([], pa.large_string()), np.empty(0, np.int64))


class Plan:
    """Where suffixes go: by level, the sorted hashes of prefixes above the budget, and the least hash of each group."""

    def __init__(self):
        self.heavy: list[np.ndarray] = []
        self.bounds: list[np.ndarray] = []

    def deal(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Level of each suffix (from 1; 0: a single word, which needs no tree; DEPTH: summed as it is), and its group."""
        level, group = np.zeros(len(words.codes), np.int64), np.zeros(len(words.codes), np.int64)
        open_, before = words.after[1] >= 0, 0
        for i, (h, heavy, bounds) in enumerate(zip(words.hashes(), self.heavy, self.bounds)):
            here = open_ & ~_within(h, heavy)
            level[here] = i + 1
            group[here] = before + np.maximum(np.searchsorted(bounds, h[here], "right") - 1, 0)
            open_, before = open_ & ~here, before + max(len(bounds), 1)
        level[open_] = DEPTH
        return level, group


def _combined(words: Words, pick: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, str, np.ndarray, np.ndarray]]:
    """(group, language, rows of codes from 1, counts) of the picked suffixes, equal ones combined."""
    for i, lang in enumerate(words.languages):
        own = np.flatnonzero(pick & (words.lang == i))
        if not len(own):
            continue
        columns, g = [c[own] + 1 for c in words.after], group[own]
        keys = [g, *_packed(columns)]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        first = _runs(keys)
        counts, codes = np.diff(np.append(first, len(order))), np.stack([c[order[first]] for c in columns], axis=1)
        cuts = _runs([keys[0][first]])
        for a, b in zip(cuts, np.append(cuts[1:], len(first))):
            yield int(keys[0][first[a]]), lang, codes[a:b], counts[a:b]


def count_prefixes(texts: DataFrame, plan: Plan, budget: int) -> DataFrame:
    """Fills ``plan`` level by level; returns (lang, word, c) of all single words."""
    def single(batches):
        for w in _chunks(batches):
            yield from w.counts().to_batches()

    words = texts.mapInArrow(single, "lang string, word string, h long, c long")
    words = materialize(words.groupBy("lang", "word").agg(F.first("h").alias("h"), F.sum("c").alias("c")), "phrase-words")
    table = words
    for level in range(1, DEPTH):
        if level > 1:
            heavy = list(plan.heavy)

            def longer(batches):
                for w in _chunks(batches):
                    pick = w.after[1] >= 0
                    for h, above in zip(w.hashes(), heavy):  # noqa: B023
                        pick = pick & _within(h, above)
                    *_, h = (x for x, _ in zip(w.hashes(), range(len(heavy) + 1)))  # noqa: B023
                    key, c = np.unique(h[pick], return_counts=True)
                    yield from pa.table({"h": key, "c": c}).to_batches()

            table = texts.mapInArrow(longer, "h long, c long")
        table = materialize(table.groupBy("h").agg(F.sum("c").alias("c")), "phrase-prefixes")
        above = table.where(F.col("c") > budget).select("h").toArrow()["h"].to_numpy()
        run = running_sum(table.where(F.col("c") <= budget), ["h"], ["c"])
        least = run.groupBy(F.floor((F.col("cum_c") - F.col("c")) / budget).alias("g")).agg(F.min("h").alias("h")).select("h").toArrow()["h"].to_numpy()
        plan.heavy.append(np.sort(above))
        plan.bounds.append(np.sort(least))
        if not len(above):
            break
    return words.select("lang", "word", "c")


def phrase_counts(docs: DataFrame, least: int = 100, budget: int = BUDGET, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, word, c) of all words, and (lang, phrase, f) of the phrases of 2 to 5 words with f >= least."""
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    plan = Plan()
    words = count_prefixes(texts, plan, budget)

    def deal(batches):
        for w in _chunks(batches):
            level, group = plan.deal(w)
            blocks = [(g, lang, _pack(_phrases(codes, w.vocabulary), counts)) for g, lang, codes, counts in
                      _combined(w, (level > 0) & (level < DEPTH), group)]
            yield from pa.table(dict(zip(("g", "lang", "block"), zip(*blocks) if blocks else ([], [], []))),
                                schema=pa.schema([("g", pa.int64()), ("lang", pa.string()), ("block", pa.binary())])).to_batches()

    ends = np.cumsum([max(len(b), 1) for b in plan.bounds])

    def count(table: pa.Table) -> pa.Table:
        level = int(np.searchsorted(ends, table["g"][0].as_py(), "right")) + 1
        langs, out = table["lang"].to_pylist(), []
        for lang in dict.fromkeys(langs):
            texts, counts = _unpack([table["block"][i].as_py() for i, x in enumerate(langs) if x == lang])
            phrases, totals = subtree(texts, counts, level, least)
            out.append(pa.table({"lang": pa.array([lang] * len(totals), pa.string()), "phrase": phrases.cast(pa.string()), "f": totals}))
        return pa.concat_tables(out)

    nodes = texts.mapInArrow(deal, "g long, lang string, block binary").groupBy("g").applyInArrow(count, "lang string, phrase string, f long")
    if len(plan.heavy) == DEPTH - 1 and len(plan.heavy[-1]):
        def plain(batches):
            for w in _chunks(batches):
                level, group = plan.deal(w)
                for _, lang, codes, counts in _combined(w, level == DEPTH, np.zeros_like(group)):
                    phrases, totals = subtree(_phrases(codes, w.vocabulary), counts, DEPTH + 1, least)
                    yield from pa.table({"lang": pa.array([lang] * len(totals), pa.string()), "phrase": phrases.cast(pa.string()),
                                         "f": totals}).to_batches()

        nodes = nodes.unionAll(texts.mapInArrow(plain, "lang string, phrase string, f long"))
    if any(map(len, plan.heavy)):  # nodes above a group's prefix come in parts
        nodes = nodes.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return words, materialize(nodes, "phrase-nodes")


def collocations(docs: DataFrame, least: int = 100, share: int = 100, top: int = 2000, budget: int = BUDGET, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to 5 words with a = f(phrase) >= least scores floor(1000 a n / (l r)) at its worst cut, l and r
    being the counts of its two parts (ties: the shortest first part). It goes if a longer phrase around
    it has at least ``share`` percent of its count; a phrase that is one word longer then does too, so
    one step is looked at. Arithmetic is in decimals of 38 digits.

    Defined cases: a null language counts as und; null and empty texts have no words; rows that repeat count each; an empty
    table gives an empty result. Texts of any length are read whole. Other columns are ignored.
    """
    words, nodes = phrase_counts(docs, least, budget, lang_col, text_col)
    f = materialize(nodes.unionAll(words.where(F.col("c") >= least).select("lang", F.col("word").alias("phrase"), F.col("c").alias("f"))), "phrase-f")
    n = words.groupBy("lang").agg(F.sum("c").alias("n"))
    part = lambda a, b: F.array_join(F.slice("w", a, b), " ")
    split = nodes.withColumn("w", F.split("phrase", " ")).withColumn("size", F.size("w"))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left, right = (f.select(F.col("lang").alias(f"{x}_lang"), F.col("phrase").alias(f"{x}_phrase"), F.col("f").alias(x)) for x in "lr")
    cuts = cuts.join(left, (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("l_phrase")))
    cuts = cuts.join(right, (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_phrase"))).join(n, "lang")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumn("score", F.expr("cast(1000 * cast(a as decimal(19,0)) * cast(n as decimal(19,0)) as decimal(38,0)) "
                                           "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    around = split.where(F.col("size") > 2).select(
        "lang", "f", F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("inner"))
    around = around.groupBy(F.col("lang").alias("i_lang"), "inner").agg(F.max("f").alias("longer"))
    scored = scored.join(around, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("inner")), "left").where(
        F.col("longer").isNull() | (big("longer") * 100 < big("a") * share))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                         F.col("cut.score").cast("long").alias("score"))
