"""License scans: base places against plain loops, suppression against all pairs of intervals, defined cases."""

import random
import re

from edge import edge_docs
from pyspark.sql import functions as F

from tabforge.llm import licenses as G
from tabforge.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"


PATTERNS = [re.compile(r.pattern) for r in G.signature_rules()]


def words(t):
    lower = (t or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(t):
    w = words(t)
    places = [(i, label) for label, p in G.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def all_matches(t, rules):
    w = words(t)
    padded, out = "".join(f" {x} " for x in w), []
    for no in range(len(rules)):
        for m in PATTERNS[no].finditer(padded):
            start = padded[:m.start()].count(" ") // 2
            out.append((start, start + m.group().count(" ") // 2, no))
    return sorted(out, key=lambda x: (x[0], -x[1], x[2]))


def survivors(found, rules):
    rank = lambda x: (rules[x[2]].tier, x[1] - x[0], -x[2])
    return [not any(o[0] <= x[0] and o[1] >= x[1] and rank(o) > rank(x) for o in found) for x in found]


def texts(n):
    rng = random.Random(5)
    parts = ["under the MIT License", "Apache License, Version 2.0", "CC BY-NC 4.0", "cc by nc cc by nc", "SPDX-License-Identifier: GPL-3.0-or-later",
             "licensed under the terms of the GNU General Public License v3", "GPLv2", "LGPL 2.1", "all rights reserved", "mit", "license", "und", "éK",
             "https://creativecommons.org/licenses/by-sa/4.0/", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
             "3-clause BSD license", "Mozilla Public License 2.0", "mulan permissive software license v2", "x", "1", ".", "\n", "Creative Commons Attribution Share Alike 4.0",
             "neither the name of the owner nor the names of its contributors", "public domain", "released into the public domain"]
    return [" ".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) for _ in range(n)]


def test_every_match_and_every_survivor(spark):
    rows = [(i, t) for i, t in enumerate(texts(200))]
    rules = G.signature_rules()
    got = {r.doc_id: r for r in G.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        found = all_matches(t, rules)
        assert [(x["start"], x["end"], x["no"]) for x in got[i].findings] == found, t
        assert [x["kept"] for x in got[i].findings] == survivors(found, rules), t


def test_rules_are_hundreds_and_their_keywords_are_in_each_match():
    rules = G.signature_rules()
    assert len(rules) > 300
    for t in texts(300):
        padded = "".join(f" {w} " for w in words(t))
        for r, p in zip(rules, PATTERNS):
            for m in p.finditer(padded):
                assert set(r.keywords) <= set(m.group().split()), r


def test_query_on_the_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in QUERIES["op11_license_scan"](spark, SF001).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_defined_cases(spark):
    docs = edge_docs(spark, [(20, "Under the MIT License", "s"), (20, "Under the MIT License", "s"), (21, "cc by nc " * 30_000, "s")])
    out = G.scan_licenses(docs).select("doc_id", "n_words", F.size("findings").alias("n"), G.labels_of(F.filter("findings", lambda x: x["kept"])).alias("labels"),
                                       G.certainty(F.col("findings")).alias("score")).collect()
    assert len(out) == docs.count()
    assert [r.score for r in out if r.doc_id == 20] == [.9, .9]
    assert [(r.n_words, r.labels) for r in out if r.doc_id == 21] == [(90_000, "cc-by-nc")]
    assert {(r.n_words, r.n) for r in out if r.doc_id in (3, 4, 6)} == {(0, 0)}
    assert G.scan_licenses(docs.limit(0)).count() == 0


def test_an_ordered_rule_wins_at_the_same_interval(spark):
    rules = (G.rule("b", G.NAME, "x license", "license"), G.rule("a", G.NAME, "x license", "license"), G.rule("short", G.MENTION, "license", "license"))
    docs = spark.createDataFrame([(1, "X License license")], "doc_id long, text string")
    f = G.scan_licenses(docs, rules).first().findings
    assert [(x["label"], x["kept"]) for x in f] == [("b", True), ("a", False), ("short", False), ("short", True)]
