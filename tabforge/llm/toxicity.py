"""Toxicity: Levenshtein automata over a learned lexicon trie, and scores of the context of each hit.

1. Lexicon. From a bounded sample of labelled texts, words and word stems that
   mark toxic texts are kept (Dunning's G2 and odds). Near copies of a text with
   the same label count once.
2. Automaton. The terms form a trie; walking the trie with a budget of edits
   gives the states of a Levenshtein automaton over all terms at once, which is
   made deterministic. It reads each word of a text once and ends in the best
   (term, edits) it allows. Stems take any ending.
3. Context. A hit within quotation marks, paired over the whole paragraph, or
   next to a word of reporting, it counts as quoted.
4. Score. A logistic regression over the sample weighs direct and quoted hits.

The scan is one narrow pass without a shuffle; whole batches of texts step
through the automaton together as arrays.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from .common import all_columns, fresh, materialize, text_or_empty

#: Labelled texts that the lexicon and the weights are fitted on, about and at most by hash share.
SAMPLE = 12_000
#: Terms that one automaton reads; a larger lexicon has several, and loses none.
TERMS_PER_AUTOMATON = 256
#: Evidence that a term needs: G2 (about ten times that of a 1 % test) and odds.
MIN_G2, MIN_ODDS = 30.0, 8.0
#: Texts of one label are near copies, for counting, if about this share of their words (Jaccard) is the same, by this many least hashes.
ALIKE, MINIMA = 0.8, 64
#: Stem lengths that are tried, and different words that a stem needs.
STEMS = (4, 5, 6)
#: Characters at either side of a hit in which words of reporting are looked for.
WINDOW = 60
#: Characters of text that step through the automaton together.
SLICE = 1 << 20

# Words of reporting, and quotation marks (opening, closing).
REPORTING = ("said", "says", "called", "calls", "quote", "quoted", "quoting", "wrote", "word", "words", "term", "slur",
             "sagte", "nannte", "zitat", "wort", "dit", "mot", "dijo", "palabra")
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’", "‹": "›"}
_MARKS = re.compile(r'["“”„«»‘’‹›]|\n\s*\n')


def edits_allowed(term: str, stem: bool) -> int:
    """Edit budget: short terms must be exact."""
    n = len(term)
    return (n >= 6) + 0 if stem else (n >= 5) + (n >= 9)


@dataclass
class Automaton:
    """Deterministic Levenshtein automaton over a trie. State 0 rejects all, 1 is the start."""

    letters: str
    step: np.ndarray  # [state, class]; class 0 ends a word, 1 is any letter outside ``letters``
    accept: np.ndarray  # best (term * 3 + edits) of a word that ends here, or -1


def build_automaton(terms: list[tuple[str, bool]]) -> Automaton:
    """terms: (text, is it a stem). Ties go to fewer edits, then the longer term, then the earlier one."""
    letters = "".join(sorted({c for t, _ in terms for c in t}))
    child: list[dict[str, int]] = [{}]
    ends: list[list[int]] = [[]]
    budget = [0]  # most edits that any term below allows
    for i, (t, stem) in enumerate(terms):
        node = 0
        k = edits_allowed(t, stem)
        budget[0] = max(budget[0], k)
        for c in t:
            if c not in child[node]:
                child[node][c] = len(child)
                child.append({})
                ends.append([])
                budget.append(0)
            node = child[node][c]
            budget[node] = max(budget[node], k)
        ends[node].append(i)

    def closed(states: set[tuple[int, int, int]]) -> frozenset:
        """Adds the states reached by leaving out a letter of a term; drops what a state with fewer edits covers."""
        todo = list(states)
        while todo:
            node, e, done = todo.pop()
            if done < 0:
                for nxt in child[node].values():
                    s = (nxt, e + 1, -1)
                    if e + 1 <= budget[nxt] and s not in states:
                        states.add(s)
                        todo.append(s)
                for i in ends[node]:
                    if terms[i][1] and e <= edits_allowed(*terms[i]):
                        states.add((-1, e, i))  # a stem has been read: any ending will do
        least: dict[tuple[int, int], int] = {}
        for node, e, done in states:
            least[node, done] = min(e, least.get((node, done), 9))
        return frozenset((n, e, d) for (n, d), e in least.items())

    def after(states: frozenset, c: str | None) -> frozenset:
        out = set()
        for node, e, done in states:
            if done >= 0:
                out.add((node, e, done))
                continue
            if c in child[node]:
                out.add((child[node][c], e, -1))
            if e < budget[node]:
                out.add((node, e + 1, -1))  # a letter too many
            for nxt in child[node].values():
                if e < budget[nxt]:
                    out.add((nxt, e + 1, -1))  # another letter
        return closed(out) if out else frozenset()

    def best(states: frozenset) -> int:
        found = [(e, -len(terms[i][0]), i) for node, e, done in states
                 for i in ([done] if done >= 0 else ends[node]) if e <= edits_allowed(*terms[i])]
        return min(found)[2] * 3 + min(found)[0] if found else -1

    start = closed({(0, 0, -1)}) if terms else frozenset()
    number = {frozenset(): 0, start: 1} if terms else {frozenset(): 0, None: 1}
    queue = [start] if terms else []
    rows = {0: [0] * (len(letters) + 2), 1: [0] * (len(letters) + 2)}
    accept = {0: -1, 1: -1}
    for s in queue:
        row = [0]
        for c in [None, *letters]:
            t = after(s, c)
            if t not in number:
                number[t] = len(number)
                queue.append(t)
                accept[number[t]] = best(t)
            row.append(number[t])
        rows[number[s]] = row
    return Automaton(letters, np.array([rows[i] for i in range(len(rows))], np.int32),
                     np.array([accept[i] for i in range(len(accept))], np.int32))


def build_automata(terms: list[tuple[str, bool]]) -> list[tuple[np.ndarray, Automaton]]:
    """Automata over neighbours in the alphabet, each with the numbers of its terms."""
    by_text = sorted(range(len(terms)), key=lambda i: terms[i])
    parts = [sorted(by_text[i:i + TERMS_PER_AUTOMATON]) for i in range(0, len(terms), TERMS_PER_AUTOMATON)] or [[]]
    return [(np.array(p, np.int64), build_automaton([terms[i] for i in p])) for p in parts]


_CLASSES: dict[str, np.ndarray] = {}


def _classes(letters: str) -> np.ndarray:
    """Class of each code point; digits count as letters, so that they can stand for one."""
    if letters not in _CLASSES:
        table = np.fromiter((chr(c).isalnum() for c in range(0x110000)), np.uint8, 0x110000)
        for i, c in enumerate(letters):
            table[ord(c)] = i + 2
        _CLASSES[letters] = table
    return _CLASSES[letters]


def find_hits(texts: list[str], auto: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position in it, match) of every word that the automaton accepts, and the words of each text."""
    lower = [t.lower() if len(t.lower()) == len(t) else "".join(c.lower()[:1] for c in t) for t in texts]
    points = np.frombuffer("\n".join(lower).encode("utf-32-le", "surrogatepass"), "<u4")
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in lower])))[:-1] if lower else np.zeros(0, np.int64)
    kind = np.append(_classes(auto.letters)[points], 0)
    word = kind > 0
    first = np.nonzero(word & ~np.concatenate(([False], word[:-1])))[0]
    words = np.bincount(np.searchsorted(begin, first, "right") - 1, minlength=len(texts)) if len(first) else np.zeros(len(texts), int)
    at, state, pos, match = first, np.ones(len(first), np.int32), [], []
    step = 0
    while len(at):
        c = kind[at + step]
        over = c == 0
        found = auto.accept[state]
        hit = over & (found >= 0)
        pos.append(at[hit])
        match.append(found[hit])
        state = auto.step[state, c]
        live = state > 0
        at, state = at[live], state[live]
        step += 1
    pos, match = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (pos, match))
    order = np.argsort(pos, kind="stable")
    pos, match = pos[order], match[order]
    number = np.searchsorted(begin, pos, "right") - 1
    return number, pos - begin[number] if len(number) else pos, match, words


def find_best(texts: list[str], terms: list[tuple[str, bool]], automata: list[tuple[np.ndarray, Automaton]]):
    """``find_hits`` over all automata: of the matches of a word the best stands, by the rule of ``build_automaton``."""
    found = []
    for numbers, auto in automata:
        number, pos, match, words = find_hits(texts, auto)
        found.append((number, pos, numbers[match // 3] * 3 + match % 3 if len(match) else match))
    number, pos, match = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    length = np.array([len(t) for t, _ in terms] or [0], np.int64)
    order = np.lexsort((match // 3, -length[match // 3], match % 3, pos, number))
    number, pos, match = number[order], pos[order], match[order]
    first = np.ones(len(number), bool)
    first[1:] = (number[1:] != number[:-1]) | (pos[1:] != pos[:-1])
    return number[first], pos[first], match[first], words


def quoted_stretches(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of the outermost stretches between paired quotation marks; a pair lies within a paragraph."""
    pairs, stack, depth = [], [], dict.fromkeys(QUOTES.values(), 0)  # open marks by the mark that closes them
    for m in _MARKS.finditer(text):
        c, i = m.group(), m.start()
        if c not in QUOTES and c not in depth:
            stack, depth = [], dict.fromkeys(depth, 0)  # the paragraph ends
        elif c == "’" and text[max(0, i - 1):i].isalpha() and text[i + 1:i + 2].isalpha():
            continue  # an apostrophe
        elif depth.get(c):
            while True:  # marks left open inside are stray
                closing, start = stack.pop()
                depth[closing] -= 1
                if closing == c:
                    break
            pairs.append((start, i))
        elif c in QUOTES:
            stack.append((QUOTES[c], i))
            depth[QUOTES[c]] += 1
    starts, ends = [], []
    for start, end in sorted(pairs):
        if not ends or end > ends[-1]:
            starts.append(start)
            ends.append(end)
    return starts, ends


def is_quoted(text: str, at: int, stretches: tuple[list[int], list[int]] | None = None) -> bool:
    """Context of a hit: inside quotation marks (anywhere in the text), or next to a word of reporting."""
    starts, ends = stretches or quoted_stretches(text)
    i = bisect_right(starts, at)
    if i and at < ends[i - 1]:
        return True
    before, after = text[max(0, at - WINDOW):at], text[at:at + WINDOW]
    near = [w.strip(".,:;!?'\"").lower() for w in before.split()[-3:] + after.split()[1:3]]
    return any(w in REPORTING for w in near)


@dataclass
class ToxicityModel:
    terms: list[tuple[str, bool]]
    automata: list[tuple[np.ndarray, Automaton]]
    weight: np.ndarray  # of each match
    coef: np.ndarray  # constant and features

    def features(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Features of each text, (hits, quoted hits) of each, and matches of each; ``SLICE`` characters at a time."""
        parts, now, size = [self._features([])], [], 0
        for t in texts:
            now.append(t)
            size += len(t)
            if size > SLICE:
                parts.append(self._features(now))
                now, size = [], 0
        parts.append(self._features(now))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), [s for p in parts for s in p[2]]

    def _features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        x, n, seen = np.zeros((len(texts), 4)), np.zeros((len(texts), 2), np.int64), [[] for _ in texts]
        number, pos, match, words = find_best(texts, self.terms, self.automata)
        stretches = {t: quoted_stretches(texts[t]) for t in np.unique(number).tolist()}
        for t, p, m in zip(number.tolist(), pos.tolist(), match.tolist()):
            w, q = self.weight[m], is_quoted(texts[t], p, stretches[t])
            x[t, 1 if q else 0] += w
            x[t, 2] = max(x[t, 2], 0.0 if q else w)
            n[t] += (1, q)
            seen[t].append(m)
        x[:, 3] = 100 * x[:, 0] / np.maximum(words, 20)
        x[:, [0, 1, 3]] = np.log1p(x[:, [0, 1, 3]])
        return x, n, seen

    def score(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        x, n, _ = self.features(texts)
        return 1 / (1 + np.exp(-(self.coef[0] + x @ self.coef[1:]))), n


#: Prior means of the coefficients: what a sample says nothing about (quoted hits, say) keeps them.
PRIOR = np.array([-4.0, 1.5, 0.5, 0.8, 0.5])


def _fit_weights(x: np.ndarray, y: np.ndarray, strength: float = 0.5) -> np.ndarray:
    """Logistic regression by Newton steps, held towards ``PRIOR``."""
    a = np.column_stack([np.ones(len(x)), x])
    w = PRIOR.copy()
    for _ in range(50 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + strength * (w - PRIOR)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + strength * np.eye(len(w)), grad)
        w -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return w


def _g2(t: float, c: float, nt: float, nc: float) -> float:
    """Dunning's log-likelihood ratio of a term's share in toxic and clean texts."""
    h = lambda k, n: (k * np.log(k / n) if k else 0.0) + ((n - k) * np.log((n - k) / n) if n > k else 0.0)
    return 2 * (h(t, nt) + h(c, nc) - h(t + c, nt + nc))


def _g2_column(t: Column, c: Column, nt: int, nc: int) -> Column:
    def h(k: Column, n: int) -> Column:
        part = lambda x: F.when(x > 0, x * F.log(x / F.lit(n))).otherwise(0.0)
        return part(k) + part(F.lit(n) - k)
    return 2 * (h(t, nt) + h(c, nc) - h(t + c, nt + nc))


def choose_terms(counts: list[tuple[str, int, int]], nt: int, nc: int) -> list[tuple[str, bool]]:
    """Terms from (entry, toxic texts, clean texts); an entry that ends in * is a stem.

    A stem stands only if no single word makes up most of it; of nested stems with
    nearly the same texts the longest stands; words under a stem go.
    """
    good = {}
    for e, t, c in counts:
        odds = (t + .5) / (nt + 1) / ((c + .5) / (nc + 1))
        if odds >= MIN_ODDS and (g := _g2(t, c, nt, nc)) >= MIN_G2:
            good[e] = (t, g)
    words = {e: v for e, v in good.items() if not e.endswith("*")}
    stems = {e[:-1]: v for e, v in good.items() if e.endswith("*")}
    for s in sorted(stems, key=len, reverse=True):
        t = stems[s][0]
        if any(w.startswith(s) and v[0] >= .8 * t for w, v in words.items()) or \
                any(o != s and o.startswith(s) and v[0] >= .9 * t for o, v in stems.items()):
            del stems[s]
    stems = {s: v for s, v in stems.items() if not any(o != s and s.startswith(o) for o in stems)}
    words = {w: v for w, v in words.items() if not any(w.startswith(s) for s in stems)}
    ranked = sorted([(-g, w, False) for w, (_, g) in words.items()] + [(-g, s, True) for s, (_, g) in stems.items()])
    return [(w, stem) for _, w, stem in ranked]


def _minima(hashes: np.ndarray) -> np.ndarray:
    """``MINIMA`` least hashes of a set of word hashes; the share that two sets have in common estimates their Jaccard likeness."""
    rng = np.random.default_rng(42)
    odd, shift = rng.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, MINIMA, np.uint64)
    if not len(hashes):
        return np.full(MINIMA, -1, np.int32)
    h = hashes.view(np.uint64)
    return np.array([int((h * a + b).min() >> np.uint64(33)) for a, b in zip(odd, shift)], np.int32)


def first_of_copies(label: np.ndarray, minima: np.ndarray) -> np.ndarray:
    """Which texts stay, in their order: those without an earlier one that stays, of the same label, ``ALIKE`` or more of the minima the same.

    Texts are compared if four minima next to each other agree.
    """
    kept, seen = np.ones(len(label), bool), {}
    for i in range(len(label)):
        places = [(int(label[i]), b, minima[i, b:b + 4].tobytes()) for b in range(0, MINIMA, 4)]
        near = sorted({j for p in places for j in seen.get(p, ())})
        if near and ((minima[near] == minima[i]).mean(axis=1) >= ALIKE).any():
            kept[i] = False
            continue
        for p in places:
            seen.setdefault(p, []).append(i)
    return kept


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic") -> ToxicityModel:
    """Fits lexicon and weights on labelled rows of ``docs`` (those of ``labels`` where ``learn`` holds).

    At most about ``SAMPLE`` labels are used, chosen by a hash of the id. Without any
    toxic or clean text the lexicon is empty and the scores stay at the prior.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (learn if learn is not None else F.lit(True)))
    share = min(1.0, SAMPLE / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t")).join(F.broadcast(chosen), "doc_id")
    sample = materialize(
        texts.withColumn("words", F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit(r"(\p{L}+)"), F.lit(1))))
        .withColumn("row", F.monotonically_increasing_id()), "toxicity-sample")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            minima = [_minima(np.array(h.as_py(), np.int64)) for h in b.column(4)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array([m.tobytes() for m in minima], pa.binary())],
                                             ["doc_id", "key", "row", "toxic", "minima"])

    signed = sample.select("doc_id", F.xxhash64("t").alias("key"), "row", "toxic", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    schema = StructType([*signed.schema.fields[:4], StructField("minima", BinaryType())])
    rows = signed.mapInArrow(sign, schema).orderBy("doc_id", "key", "row").select("row", "toxic", "minima").toPandas()
    minima = np.frombuffer(b"".join(rows["minima"]), np.int32).reshape(-1, MINIMA)
    kept = rows[first_of_copies(rows["toxic"].to_numpy(), minima)]
    once = docs.sparkSession.createDataFrame([(r,) for r in kept["row"].tolist()], "row long")
    sample = sample.join(F.broadcast(once), "row", "left_semi")
    nt = int(kept["toxic"].sum())
    nc = len(kept) - nt
    terms = []
    if nt and nc:
        stem = lambda n: F.transform(F.filter("words", lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))
        entries = F.array_distinct(F.concat("words", *[stem(n) for n in STEMS]))
        counts = (sample.select("toxic", F.explode(entries).alias("entry")).groupBy("entry")
                  .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
                  .where((F.col("t") >= 3) & ((F.col("t") + .5) * (nc + 1) >= MIN_ODDS * (F.col("c") + .5) * (nt + 1)))
                  # what follows can only lower t, and G2 with it: nothing that could pass goes here
                  .where(_g2_column(F.col("t"), F.col("c"), nt, nc) >= MIN_G2 - 1e-6))
        found = {r["entry"]: (r["t"], r["c"]) for r in counts.collect()}
        # a passage that many texts share is no evidence: of a candidate's toxic texts, as many count as it has neighbours there
        words = F.regexp_extract_all(F.lower("t"), F.lit(r"(\p{L}+)"), F.lit(1))
        placed = sample.where("toxic = 1").select(words.alias("w")).select(F.explode(F.transform("w", lambda w, i: F.struct(
            w.alias("word"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("near")))).alias("x"))
        forms = F.array("x.word", *[F.concat(F.substring("x.word", 1, n), F.lit("*")) for n in STEMS])
        names = docs.sparkSession.createDataFrame([(e,) for e in found] or [("",)], "entry string")
        near = placed.select(F.explode(forms).alias("entry"), "x.near").join(F.broadcast(names), "entry")
        near = {r["entry"]: r["n"] for r in near.distinct().groupBy("entry").agg(F.count("*").alias("n")).collect()}
        terms = choose_terms([(e, min(t, near.get(e, 0)), c) for e, (t, c) in found.items()], nt, nc)
    model = ToxicityModel(terms, build_automata(terms), np.ones(3 * len(terms) + 1), PRIOR.copy())
    if not terms:
        return model

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, _, seen = model.features(t.as_py() for t in b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sorted(set(s)) for s in seen], pa.list_(pa.int32()))],
                                             ["toxic", "seen"])

    found = sample.select("toxic", "t").mapInArrow(scan, "toxic int, seen array<int>").where(F.size("seen") > 0).toPandas()
    t, c = np.zeros(3 * len(terms)), np.zeros(3 * len(terms))
    for y, seen in zip(found["toxic"], found["seen"]):
        np.add.at(t if y else c, np.asarray(seen, int), 1)
    weight = np.log((t + .5) / (nt + 1)) - np.log((c + .5) / (nc + 1))
    for m in range(len(weight)):  # a variant never seen counts as its exact term, less with each edit
        if not t[m] + c[m]:
            weight[m] = weight[m - m % 3] * (1 - .3 * (m % 3))
    model.weight = np.append(np.clip(weight, 0, 6), 0)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, _, _ = model.features(t.as_py() for t in b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x[:, i]) for i in range(4))], ["toxic", *"abcd"])

    rows = sample.select("toxic", "t").mapInArrow(measure, "toxic int, a double, b double, c double, d double").toPandas()
    model.coef = _fit_weights(rows[list("abcd")].to_numpy(), rows["toxic"].to_numpy())
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", names: tuple = ("score", "n_hits", "n_quoted"),
                   keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given), and three more called ``names`` (with underscores in front of a
    name that is taken): score (0 to 1), hits and quoted hits. No shuffle, one pass.

    Defined cases: null and empty texts get the score of a text without hits;
    repeated rows get equal scores; other columns pass through unread.
    """
    kept = docs.columns if keep is None else keep
    names = tuple(fresh(docs, *names))
    schema = StructType([docs.schema[c] for c in kept] + [StructField(n, t) for n, t in zip(names, (DoubleType(), LongType(), LongType()))])
    at = docs.columns.index(text_col)
    places = [docs.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score, hits = model.score(t.as_py() or "" for t in b.column(at))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in places), pa.array(score), pa.array(hits[:, 0]), pa.array(hits[:, 1])],
                                             [*kept, *names])

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``limit`` or more, all columns kept."""
    score, _, _ = names = fresh(docs, "score", "n_hits", "n_quoted")
    return score_toxicity(docs, model, text_col, names).where(F.col(score) < limit).select(*all_columns(docs))
