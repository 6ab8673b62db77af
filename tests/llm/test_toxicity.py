"""Toxicity: the automaton against edit distances, context, held-out accuracy."""

import random

import numpy as np
from edge import edge_docs
from pyspark.sql import functions as F

from tabforge.llm import toxicity as X

SF01 = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = [("idiot", False), ("idle", False), ("worthless", False), ("scum", False), ("lostra", True), ("lowe", True)]
    auto = X.build_automaton(terms)
    rng = random.Random(1)
    words = [t for t, _ in terms]
    for t, _ in terms:
        for _ in range(300):
            w = list(t)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(w) + 1)
                op = rng.randrange(3)
                if op == 0:
                    w.insert(k, rng.choice("idotzlé1"))
                elif w and op == 1:
                    w.pop(min(k, len(w) - 1))
                elif w:
                    w[min(k, len(w) - 1)] = rng.choice("idotzlé1")
            words.append("".join(w) + rng.choice(["", "", "schaft", "x"]))
    words = [w for w in words if w]
    number, _, match, counts = X.find_hits([" ".join(words)], auto)
    starts = {}
    n, pos, match, _ = X.find_hits(words, auto)
    got = dict(zip(n.tolist(), match.tolist()))
    for i, w in enumerate(words):
        allowed = []
        for k, (t, stem) in enumerate(terms):
            d = min(distance(t, w[:j]) for j in range(len(w) + 1)) if stem else distance(t, w)
            if d <= X.edits_allowed(t, stem):
                allowed.append((d, -len(t), k))
        want = min(allowed)[2] * 3 + min(allowed)[0] if allowed else -1
        assert got.get(i, -1) == want, (w, want, got.get(i, -1))
    assert counts.tolist() == [len(words)]


def test_context():
    assert X.is_quoted('He said "you idiot" to me', 13) and X.is_quoted("the word idiot is rude", 9) and X.is_quoted("„Du idiot“ rief er", 4)
    assert not X.is_quoted("you idiot go away", 4) and not X.is_quoted('"hi" you idiot "bye"', 9)


def test_quotations_longer_than_the_window():
    far = "well " * 30
    quoted = f'He told them "{far}you idiot {far}" and left'
    assert X.is_quoted(quoted, quoted.index("idiot"))
    direct = f'They sang "{far}" and you idiot heard "nothing"'
    assert not X.is_quoted(direct, direct.index("idiot"))
    cut = 'An open " mark\n\nyou idiot go "away"'
    assert not X.is_quoted(cut, cut.index("idiot"))
    text = f"‘{far}don’t be an idiot {far}’ „Du idiot“ “a „b“ idiot” idiot"
    assert [X.is_quoted(text, i) for i in range(len(text)) if text.startswith("idiot", i)] == [True, True, True, False]
    X.quoted_stretches("“" * 200_000 + "\n" * 200_000 + "«”" * 100_000)


def labelled(spark, n=1500):
    rng = random.Random(5)
    syl = ["an", "ter", "on", "li", "ro", "es", "ti", "mo", "ka", "ve"]
    word = lambda: "".join(rng.choice(syl) for _ in range(rng.randrange(1, 5)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(80)]
        y = int(i % 6 == 0)
        for _ in range(3 * y):
            w.insert(rng.randrange(len(w)), rng.choice(["numskull", "blockhead", "wretchful"]))
        docs.append((i, " ".join(w)))
        labels.append((i, y))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_misspellings_and_quotation(spark):
    docs, labels = labelled(spark)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = X.fit_toxicity(docs, labels, learn=~held)
    assert {t for t, _ in model.terms} == {"numskull", "blockhead", "wretchful"}
    got = X.score_toxicity(docs, model).join(labels, "doc_id").where(held).collect()
    assert all((r["score"] >= .5) == (r["toxic"] == 1) for r in got)
    extra = spark.createDataFrame([(1, "on es you numskul ter li"), (2, "ter li on es"), (3, None), (4, ""), (5, 'she said "numskull" was a rude term')],
                                  "doc_id long, text string")
    s = {r["doc_id"]: (r["score"], r["n_quoted"]) for r in X.score_toxicity(extra, model).collect()}
    assert s[1][0] > s[2][0] and s[2][0] == s[3][0] == s[4][0] < .5 and s[5][1] == 1 and s[5][0] < s[1][0]


def test_unlike_texts_that_share_a_long_word_all_count(spark):
    docs, labels = labelled(spark)
    long = docs.select(F.explode(F.split("text", " ")).alias("w")).where(F.length("w") >= 9)
    least = long.orderBy(F.xxhash64("w")).first()["w"]
    shared = docs.withColumn("text", F.concat("text", F.lit(" " + least)))
    model = X.fit_toxicity(shared, labels)
    assert {t for t, _ in model.terms} == {"numskull", "blockhead", "wretchful"}
    got = X.score_toxicity(shared, model).join(labels, "doc_id").collect()
    assert all((r["score"] >= .5) == (r["toxic"] == 1) for r in got)


def test_only_near_copies_of_one_label_count_once():
    rng = np.random.default_rng(3)
    one, other = rng.integers(-1 << 62, 1 << 62, (2, 200))
    near, half = np.append(one[:195], other[:5]), np.append(one[:100], other[:100])
    sets = [one, near, half, other, one, one[:0], one[:0], other[::-1]]
    minima = np.array([X._minima(s) for s in sets])
    label = np.array([0, 0, 0, 0, 1, 1, 1, 0])
    assert X.first_of_copies(label, minima).tolist() == [True, False, True, True, True, True, False, False]


def test_toxicity_of_the_documents(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    model = X.fit_toxicity(docs, labels)
    got = X.score_toxicity(docs, model).join(labels, "doc_id").collect()
    assert sum((r["score"] >= .5) == (r["toxic"] == 1) for r in got) >= .93 * len(got)
    assert all(r["score"] < .5 for r in got if r["toxic"] == 0)


def test_toxicity_edge_rows(spark):
    d = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (5, 0), (5, 1), (99, 1)], "doc_id long, toxic int")
    model = X.fit_toxicity(d, labels)
    out = X.drop_toxic(d, model)
    assert out.columns == d.columns and X.score_toxicity(d, model).count() == d.count()
    assert X.score_toxicity(d.limit(0), X.fit_toxicity(d.limit(0), labels.limit(0))).count() == 0


def test_a_large_lexicon_has_several_automata_and_loses_no_term(monkeypatch):
    rng = random.Random(4)
    make = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 10)))
    terms = [(w, i % 7 == 0 and len(w) >= 4) for i, w in enumerate(dict.fromkeys(make() for _ in range(60)))]
    texts = [" ".join([make() for _ in range(40)] + [t for t, _ in terms[i::5]]) for i in range(5)] + ["", "zz 9"]
    one = X.find_best(texts, terms, X.build_automata(terms))
    monkeypatch.setattr(X, "TERMS_PER_AUTOMATON", 7)
    split = X.build_automata(terms)
    assert len(split) == -(-len(terms) // 7)
    for a, b in zip(one, X.find_best(texts, terms, split)):
        assert a.tolist() == b.tolist()
    counts = [(f"w{i:04d}x", 40, 0) for i in range(700)]
    assert len(X.choose_terms(counts, 100, 900)) == 700


def test_the_filter_of_candidates_equals_the_formula(spark):
    cases = [(t, c) for t in range(1, 101, 9) for c in (0, 1, 7, 400, 900)]
    rows = spark.createDataFrame(cases, "t long, c long").select("t", "c", X._g2_column(F.col("t"), F.col("c"), 100, 900).alias("g")).collect()
    for r in rows:
        assert abs(r["g"] - X._g2(r["t"], r["c"], 100, 900)) < 1e-9
