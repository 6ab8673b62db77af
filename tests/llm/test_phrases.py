"""Phrase counts and collocations against plain counting, at any budget; defined cases."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from edge import edge_docs
from pyspark.sql import functions as F

from tabforge.llm import phrases as W


def pieces(t):
    lower = (t or "").translate({i: i + 32 for i in range(65, 91)})
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute_counts(rows):
    f = Counter()
    for lang, t in rows:
        for w in pieces(t):
            for m in range(1, 6):
                f.update((lang or "und", tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    return f


def brute(rows, least, share, top):
    f = brute_counts(rows)
    n = Counter()
    for (lang, p), c in f.items():
        n[lang] += c if len(p) == 1 else 0
    phrases = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = []
    for lang in n:
        own = {p: c for (x, p), c in phrases.items() if x == lang}
        found = []
        for p, a in own.items():
            if any(len(q) > len(p) and 100 * c >= share * a and inside(p, q) for q, c in own.items()):
                continue
            score, k = min((Fraction(1000 * a * n[lang], f[lang, p[:k]] * f[lang, p[k:]]).__floor__(), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
        out += [(lang, i + 1, x[2].decode(), *x[3:]) for i, x in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus():
    rng = random.Random(3)
    line = "a very common line that All documents share"
    rows = []
    for i in range(120):
        words = [rng.choice(["a", "b", "the", "É", "x1", "of", "rare" + str(rng.randrange(40))]) for _ in range(rng.randrange(0, 60))]
        t = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", " - "]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), t + (line if i % 3 == 0 else "")))
    return [*rows, ("en", None), ("en", ""), (None, ".,;"), ("fr", "one"), ("en", "the the " * 400)]


@pytest.mark.parametrize("budget", [1, 7, 60, 10**6])
def test_counts_are_the_same_at_any_budget(spark, budget):
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    words, nodes = W.phrase_counts(docs, 4, budget)
    want = brute_counts(rows)
    assert {(r.lang, (r.word,)): r.c for r in words.collect()} == {k: c for k, c in want.items() if len(k[1]) == 1}
    got = nodes.collect()
    assert len(got) == len({(r.lang, r.phrase) for r in got})
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in got} == {k: c for k, c in want.items() if len(k[1]) > 1 and c >= 4}


@pytest.mark.parametrize("share, top", [(100, 2000), (60, 5)])
def test_collocations(spark, share, top):
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in W.collocations(docs, 4, share, top, budget=60).collect())
    assert got == brute(rows, 4, share, top)


def test_products_beyond_64_bits(spark):
    score = spark.sql("select cast(1000 * cast(a as decimal(19,0)) * cast(n as decimal(19,0)) as decimal(38,0)) div (cast(l as decimal(19,0)) * "
                      "cast(r as decimal(19,0))) from values (cast(7e14 as bigint), cast(9e15 as bigint), cast(8e14 as bigint), "
                      "cast(9e14 as bigint)) as t(a, n, l, r)").first()[0]
    assert score == 1000 * 7 * 10**14 * 9 * 10**15 // (8 * 10**14 * 9 * 10**14)


def test_defined_cases(spark):
    docs = edge_docs(spark).withColumn("f", F.lit(1)).withColumn("phrase", F.lit("p"))
    got = W.collocations(docs, 2, 100, 10).collect()
    assert "idiot word a1b2 idiot word" in {r.phrase for r in got}
    assert W.collocations(docs.limit(0)).count() == 0
    assert W.collocations(docs.where("text is null")).count() == 0
