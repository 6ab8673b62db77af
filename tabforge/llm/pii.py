"""Personal data: high-recall candidates, gradient-boosted trees, calibrated thresholds.

Kinds: email, ip, card, phone. Spans of the strict formats (the base) are always
reported. Beyond them, loose generators propose overlapping spans (written-out
addresses, IPv6 groups, cards and phones with other separators or no sign; of a
run of digits every stretch of whole groups, as numbers can stand side by side); boosted trees score them by format and context features; scores are
calibrated on a held-out fold, and each kind's threshold is the lowest that keeps the
wanted precision there. Accepted spans that touch no base span are added, the most likely first.

The trees learn from a bounded sample of the corpus itself: base spans,
also rewritten with other separators in their own context, are the positives; the
same places with digits, octets or separators that break the format, and loose candidates
of the corpus that a first model finds unlikely, are the negatives, and so are
the wrong stretches of two numbers set side by side.

One narrow pass over whole texts, without a shuffle. All patterns are read in
linear time, however long a run of digits or letters is.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Documents that the trees learn from, about and at most by hash share, and candidates of them.
SAMPLE, MAX_CANDIDATES = 40_000, 40_000
#: Precision that a threshold must keep on the held-out fold.
PRECISION = 0.97
#: Characters of context at either side of a candidate.
CONTEXT = 30

_ANY = re.compile(r"[0-9@]| (?:at|AT) |\((?:at|AT)\)|\[(?:at|AT)\]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# loose generators
_WRITTEN = re.compile(r"([A-Za-z0-9._%+-]{1,64})\x20?(?:@|\((?:at|AT)\)|\[(?:at|AT)\]|\x20(?:at|AT)\x20)\x20?"
                      r"([A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\((?:dot|DOT)\)|\[(?:dot|DOT)\]|\x20(?:dot|DOT)\x20)\x20?[A-Za-z0-9-]{1,63}){1,5})")
_HEX_GROUPS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z:])")
_DIGITS = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20()./_-]{0,2}[0-9])*")
_GROUP = re.compile(r"[0-9]+")
_LEFT, _RIGHT = re.compile(r"([0-9]+)[\x20()./_-]{1,2}$"), re.compile(r"[\x20()./_-]{1,2}([0-9]+)")
#: Digits of an address, a card and a phone that loose candidates may have.
_LENGTHS = {1: (7, 25), 2: (13, 19), 3: (7, 15)}
#: Candidates that are scored together.
BLOCK = 4096

# Words that point to a kind, looked for in the context.
CUES = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "addr"),
        "card": ("card", "visa", "credit", "pay"), "phone": ("phone", "tel", "call", "mobile", "fax")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the strict formats, leftmost and non-overlapping within a kind."""
    out, upto, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > upto and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
        upto = m.end() if m else at + 1
        at = text.find("@", upto)
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        groups, at = m.group().split("."), m.start()
        ends, i = [], 0
        for g in groups:
            ends.append(at + len(g))
            at += len(g) + 1
        while i + 3 < len(groups):
            empty = next((j for j in range(i + 3, i - 1, -1) if not groups[j]), None)
            if empty is not None:
                i = empty + 1
                continue
            if all(map(_octet, groups[i:i + 4])):
                out.append((1, ends[i] - len(groups[i]), ends[i + 3]))
            i += 4
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(d := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def digit_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Every stretch of whole groups of a run of digits, for each kind whose digits it can have."""
    most = max(n for _, n in _LENGTHS.values())
    for m in _DIGITS.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, *m.span())]
        if text[m.end():m.end() + 1].isalnum() and text[m.end()].isascii():
            groups.pop()
        for i, (first, _) in enumerate(groups):
            start, n, j = (first - (text[first - 1] == "(") if i else m.start()), 0, i
            while j < len(groups) and (n := n + groups[j][1] - groups[j][0]) <= most:
                end = groups[j][1]
                for kind, (low, high) in _LENGTHS.items():
                    if low <= n <= high and (kind > 1 or text.count(".", start, end) == 3):
                        yield kind, start, end
                j += 1


def loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Overlapping candidates of all kinds; a stretch of digits is a candidate for card, phone and ip at once."""
    yield from ((0, m.start(), m.end()) for m in _WRITTEN.finditer(text))
    yield from ((1, m.start(), m.end()) for m in _HEX_GROUPS.finditer(text))
    yield from digit_spans(text)


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span and its context."""
    s = text[start:end]
    # length and digits say nothing about an address
    digits = "".join(c for c in s if c.isdigit() and c.isascii()) if kind else ""
    groups = [len(g) for g in re.split(r"[^0-9]+", s) if g] if kind else []
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    near = (before + " " + after).lower()
    left, right = (_LEFT.search(before), _RIGHT.match(after)) if kind else (None, None)
    parts = s.split(".")
    side = lambda c: 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalnum() else 3.0
    return [float(kind == k) for k in range(4)] + [
        float(len(s)) if kind else 0.0, float(len(digits)), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(len({c for c in s if not c.isalnum()})), float(s.startswith("+")), float("(" in s), float(s.count(".")), float(s.count("-")),
        float(s.count(" ")), float(s.count(":")), float("@" in s), float(" dot " in s.lower() or "(dot)" in s.lower()), float("(" in s or "[" in s), float(bool(digits) and luhn(digits)),
        float(len(parts) == 4 and all(p.isdigit() and p.isascii() and _octet(p) for p in parts)),
        0.0 if kind else float(len(re.search(r"[A-Za-z]*[^A-Za-z]*$", s).group())), float(len(set(digits))), side(before[-1:]), side(after[:1]),
        float(any(c in near for c in CUES[KINDS[kind]])), float(sum(c.isdigit() for c in before + after)),
        float(len(left[1])) if left else 0.0, float(len(right[1])) if right else 0.0,
        # a run that goes on with a separator of the span's own
        float(bool(left) and before[-1] in s) + float(bool(right) and after[0] in s)]


# --- gradient-boosted trees --------------------------------------------------

@dataclass
class Trees:
    """Boosted regression trees on the logistic loss, over ranks of each feature's quantiles."""

    cuts: list[np.ndarray]
    trees: list[list[tuple[int, int, float]]]  # a node: feature (or -1), cut, value; children at 2i+1, 2i+2
    constant: float
    rate: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        ranks = np.column_stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)])
        out = np.full(len(x), self.constant)
        for tree in self.trees:
            feature, cut, value = (np.array(v) for v in zip(*tree))
            node = np.zeros(len(x), int)
            while (inner := feature[node] >= 0).any():
                right = ranks[np.arange(len(x)), np.maximum(feature[node], 0)] > cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += self.rate * value[node]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15, least: int = 5, l2: float = 1.0) -> Trees:
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
    ranks = np.column_stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)])
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(cuts, [], float(np.log(p0 / (1 - p0))), rate)
    f = np.full(len(y), model.constant)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        tree = [(-1, 0, 0.0)] * (2 ** (depth + 1) - 1)
        todo = [(0, np.arange(len(y)))]
        while todo:
            i, at = todo.pop()
            gs, hs = g[at].sum(), h[at].sum()
            best = (1e-6, -1, 0)
            if i < 2 ** depth - 1 and len(at) >= 2 * least:
                for j in range(x.shape[1]):
                    r = ranks[at, j]
                    n, a, b = (np.bincount(r, weights=w, minlength=len(cuts[j]) + 1)[:-1].cumsum() for w in (None, g[at], h[at]))
                    ok = (n >= least) & (len(at) - n >= least)
                    gain = np.where(ok, a ** 2 / (b + l2) + (gs - a) ** 2 / (hs - b + l2) - gs ** 2 / (hs + l2), 0) if len(n) else np.zeros(0)
                    if len(gain) and gain.max() > best[0]:
                        best = (gain.max(), j, int(gain.argmax()))
            tree[i] = (best[1], best[2], gs / (hs + l2))
            if best[1] >= 0:
                right = ranks[at, best[1]] > best[2]
                todo += [(2 * i + 1, at[~right]), (2 * i + 2, at[right])]
            else:
                f[at] += rate * tree[i][2]
        model.trees.append(tree)
    return model


@dataclass
class PiiModel:
    trees: Trees | None
    slope: float  # calibration of the margin
    shift: float
    threshold: tuple[float, ...]  # of each kind, on the calibrated probability; above 1: nothing is added

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Accepted candidates that touch no base span and no more likely candidate."""
        if self.trees is None:
            return []
        starts = sorted(a for _, a, _ in base)
        reach = list(accumulate((b for _, b in sorted((a, b) for _, a, b in base)), max))
        free = (c for c in loose_spans(text) if not (n := bisect_left(starts, c[2])) or reach[n - 1] <= c[1])
        likely = []
        while found := list(islice(free, BLOCK)):
            p = 1 / (1 + np.exp(-(self.slope * self.trees.margin(np.array([features(text, *c) for c in found])) + self.shift)))
            likely += [(-q, a - b, k, a, b) for q, (k, a, b) in zip(p.tolist(), found) if q >= self.threshold[k]]
        taken, out = [], []
        for _, _, kind, a, b in sorted(likely):  # of equally likely ones the longest
            i = bisect_left(taken, (a, b))
            if (i == len(taken) or taken[i][0] >= b) and (not i or taken[i - 1][1] <= a):
                taken.insert(i, (a, b))
                out.append((kind, a, b))
        return out


def _rewrite(rng: np.random.Generator, kind: int, s: str) -> list[tuple[str, int]]:
    """Variants of a base span: (text, 1 if it still is one). Digits are drawn anew for the broken ones."""
    digits = "".join(c for c in s if c.isdigit())
    swap = lambda d: d[:-1] + str((int(d[-1]) + int(rng.integers(1, 10))) % 10)
    if kind == 0:
        local, _, domain = s.partition("@")
        return [(f"{local} at {domain.replace('.', ' dot ')}", 1), (f"{local}(at){domain.replace('.', '(dot)')}", 1),
                (f"{local}[at]{domain}", 1), (f"{local} at {domain.split('.')[0]}.", 0), (f"{domain.split('.')[0]} at {domain.split('.')[-1]}", 0)]
    if kind == 1:
        big = [str(int(rng.integers(256, 1000))) if i == int(rng.integers(4)) else p for i, p in enumerate(s.split("."))]
        six = ":".join(f"{int(v) >> int(cut):x}" for v, cut in zip(rng.integers(0, 65536, 8), rng.choice([0, 0, 8, 12], 8)))
        clock = ":".join(f"{int(v):02d}" for v in rng.integers(0, 60, 4))
        return [(six, 1), (clock, 0), (".".join(big), int(all(map(_octet, big)))), (".".join(s.split(".")[:3]), 0)]
    if kind == 2:
        four = lambda d, c: c.join(d[i:i + 4] for i in range(0, len(d), 4))
        return [(four(digits, "."), 1), (four(digits, "_"), 1), (four(swap(digits), "."), 0), (swap(digits), 0), (four(swap(digits), " "), 0)]
    plain = digits[-10:]
    day = f"{int(rng.integers(1900, 2100))}-{int(rng.integers(1, 13)):02d}-{int(rng.integers(1, 29)):02d}"
    return [(f"({plain[:3]}) {plain[3:6]}-{plain[6:]}", 1), (f"{plain[:3]}-{plain[3:6]}-{plain[6:]}", 1), (f"{plain[:3]}.{plain[3:6]}.{plain[6:]}", 1),
            (day, 0), (plain, 0), (day.replace("-", "."), 0), (f"{day} {day}", 0), (plain[:8], 0)]


def _side_by_side(rng: np.random.Generator, kind: int, before: str, s: str, after: str) -> Iterator[tuple[int, list[float]]]:
    """(label, features) of a number, or a variant of it, and its neighbour, and of a few stretches that cut them or run across."""
    forms = [s] + [v for v, y in _rewrite(rng, kind, s) if y]
    address = ".".join(str(v) for v in rng.integers(1, 256, 4))
    for other in (forms[int(rng.integers(len(forms)))], address, ""):
        one = forms[int(rng.integers(len(forms)))]
        pair = [(one, kind)] + [(other, 1 if other == address else kind)] * bool(other)
        if rng.integers(2):
            pair.reverse()
        text, at, right = before, len(before), []
        for form, k in pair:
            text += " " * (at < len(text)) + form
            right.append((k, len(text) - len(form), len(text)))
        text, end = text + after, len(text)
        wrong = [c for c in digit_spans(text) if c not in right and at < c[2] and c[1] < end
                 and not (other == address and any(k == 1 and c[1] < y and x < c[2] for k, x, y in right))]
        yield from ((1, features(text, *c)) for c in right if c[0] == kind)
        yield from ((0, features(text, *wrong[int(i)])) for i in rng.permutation(len(wrong))[:4])


def _examples(doc_key: int, text: str) -> list[tuple[int, int, list[float]]]:
    """(fold, label, features) from one text; label -1: a loose candidate of which nothing is known."""
    rng = np.random.default_rng(doc_key & 0xFFFFFFFF)
    base, out, fold = base_spans(text), [], doc_key % 5
    for kind, a, b in base:
        out.append((fold, 1, features(text, kind, a, b)))
        for s, y in _rewrite(rng, kind, text[a:b]):
            window = text[max(0, a - CONTEXT):a]
            out.append((fold, y, features(window + s + text[b:b + CONTEXT], kind, len(window), len(window) + len(s))))
        if kind > 1:
            out += [(fold, y, x) for y, x in _side_by_side(rng, kind, text[max(0, a - CONTEXT):a], text[a:b], text[b:b + CONTEXT])]
    for kind, a, b in loose_spans(text):
        if not any(x < b and a < y for _, x, y in base):
            out.append((fold, -1, features(text, kind, a, b)))
    return out


def fit_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> PiiModel:
    """Trees, calibration and thresholds from a bounded sample; without base spans in it, nothing is ever added."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    key = F.xxhash64(F.lit("pii"), F.col(id_col), text_or_empty(text_col))
    chosen = docs.select(key.alias("k"), text_or_empty(text_col).alias("t")).where(
        F.pmod("k", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, folds, ys, xs = [], [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                for n, (fold, y, x) in enumerate(_examples(k, t.as_py()) if _ANY.search(t.as_py()) else []):
                    keys.append(f"{k & (2 ** 64 - 1):016x}{n:06d}")
                    folds.append(fold)
                    ys.append(y)
                    xs.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(folds, pa.int32()), pa.array(ys, pa.int32()),
                                              pa.array(xs, pa.list_(pa.float64()))], ["k", "fold", "y", "x"])

    rows = chosen.mapInArrow(learn, "k string, fold int, y int, x array<double>").distinct().orderBy("k").limit(MAX_CANDIDATES).toPandas()
    never = (2.0,) * len(KINDS)
    if not len(rows) or rows["y"].nunique() < 2:
        return PiiModel(None, 1.0, 0.0, never)
    x, y, held = np.array(rows["x"].tolist()), rows["y"].to_numpy(float), (rows["fold"] == 0).to_numpy()
    known = y >= 0
    if len({*y[known & ~held]}) < 2 or len({*y[known & held]}) < 2:
        return PiiModel(None, 1.0, 0.0, never)
    # unknown candidates that a first model finds unlikely are negatives; the others are left out
    first = fit_trees(x[known & ~held], y[known & ~held])
    use = known | (first.margin(x) < 0)
    x, y, held = x[use], np.maximum(y[use], 0), held[use]
    trees = fit_trees(x[~held], y[~held])
    m, t = trees.margin(x[held]), y[held]
    w = np.array([1.0, 0.0])
    for _ in range(30):  # calibration: logistic in the margin, held towards the identity
        p = 1 / (1 + np.exp(-np.clip(w[0] * m + w[1], -30, 30)))
        a = np.column_stack([m, np.ones(len(m))])
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.eye(2), a.T @ (p - t) + (w - [1.0, 0.0]))
    p = 1 / (1 + np.exp(-(w[0] * m + w[1])))
    threshold = []
    for k in range(len(KINDS)):
        mine = x[held][:, k] == 1
        order = np.argsort(-p[mine], kind="stable")
        good = np.cumsum(t[mine][order]) / np.arange(1, mine.sum() + 1) >= PRECISION
        threshold.append(max(0.5, float(p[mine][order][np.nonzero(good)[0][-1]])) if mine.sum() >= 20 and good.any() else 2.0)
    return PiiModel(trees, float(w[0]), float(w[1]), tuple(threshold))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_pii(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (base and added), n_added.

    Positions are code points, ends exclusive. Defined cases: null and empty
    texts have no span; repeated rows give equal rows; an empty table gives an empty
    result; other columns are ignored.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    counts = [f"n_{k}" for k in KINDS]
    schema = StructType([narrow.schema["doc_id"], *(StructField(c, LongType()) for c in counts), StructField("base_sha256", StringType()),
                         StructField("spans", StringType()), StructField("n_added", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                text = t.as_py()
                base = base_spans(text) if _ANY.search(text) else []
                more = model.added(text, base) if _ANY.search(text) else []
                rows.append((*(sum(k == i for k, _, _ in base) for i in range(4)),
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + more), len(more)))
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], schema.names)

    return narrow.mapInArrow(run, schema)


def redact(text: str, spans: str) -> str:
    """The text with each span of ``spans`` replaced by its kind in brackets."""
    cut = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for a, b, k in cut:
        if b <= at:
            continue
        out += [text[at:max(a, at)], f"[{k}]"]
        at = b
    return "".join(out) + text[at:]


def redact_pii(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the found spans of its text redacted; all columns kept, a null text stays null."""
    at = docs.columns.index(text_col)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = f.iloc[:, at]
            new = []
            for t in texts:
                if t and _ANY.search(t):
                    base = base_spans(t)
                    t = redact(t, _joined(base + model.added(t, base)))
                new.append(t)
            f.isetitem(at, pd.Series(new, index=f.index, dtype=object))
            yield f

    return docs.mapInPandas(run, docs.schema)
