"""The conversation trie against plain sets of prefixes, at any budget; the decomposition against plain sums."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tabforge.llm import prefix_trie as R

SCHEMA = "conv_id bigint, turn int, role string, text string, conv string, depth string, nid string, comp string"


def test_decompose_equals_plain_sums():
    rng = random.Random(1)
    for n, reach in ((1, 1), (2, 1), (50, 50), (300, 3), (400, 1), (400, 400)):
        parent = [-1] + [-1 if rng.random() < .02 else max(0, i - rng.randrange(1, reach + 1)) for i in range(1, n)]
        mix = list(range(n))
        rng.shuffle(mix)  # children before parents too
        p, v = np.full(n, -1), np.array([rng.randrange(100) for _ in range(n)])
        for i, a in enumerate(parent):
            p[mix[i]] = -1 if a < 0 else mix[a]
        want = v.copy()
        for i in reversed(range(n)):
            if parent[i] >= 0:
                want[mix[parent[i]]] += want[mix[i]]
        got, ones = R.decompose(p, [v, np.ones(n, np.int64)])
        assert got.tolist() == want.tolist() and ones[p < 0].sum() == n


def brute(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = tuple(turns.get(c - int(np.fmod(c, 5)), [])[:h] + own[h:])
    members = {}
    for c, t in full.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    kids, out = {}, []
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        todo = [p]
        for x in todo:
            todo += kids.get(x, [])
        return todo

    for p, m in members.items():
        sub = below(p)
        ends = ",".join(map(str, sorted(c for c in m if len(full[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), sum(x not in kids for x in sub),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talks():
    rng = random.Random(2)
    rows = []
    for c in range(-12, 60):
        n = 70 if c in (20, 21, 23) else rng.randrange(0, 14)
        rows += [(c, None if rng.random() < .05 else i // 2 if c % 7 == 0 else i, rng.choice(["user", "bot", None]), rng.choice(["hi", "é", "", None, "long " * 9]))
                 for i in range(n)]
    rows += [(200 + i, 0, "user", "same") for i in range(5)] + [(300, 1, "user", "twice")] * 3 + [(None, 0, "user", "nobody")]
    rows += [(401 + 5 * i, 0, "user", "no base") for i in range(9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "d", "n", "k") for r in rows], SCHEMA)


@pytest.mark.parametrize("budget", [3, 100_000])
def test_trie(spark, budget):
    rows = talks()
    got = sorted((tuple(r) for r in R.prefix_trie(frame(spark, rows).repartition(5), budget=budget).collect()), key=str)
    assert got == brute(rows)


def test_blocks_of_a_long_list_of_ends(spark):
    ids = spark.range(0, 35_000, numPartitions=4).selectExpr("7 as nid", "id as conv").unionAll(spark.sql("select 9L, 3L"))
    got = {r.nid: r.ends_sha256 for r in R.end_digests(ids).collect()}
    assert got == {7: hashlib.sha256(",".join(map(str, range(35_000))).encode()).hexdigest(), 9: hashlib.sha256(b"3").hexdigest()}


def test_empty_tables_and_a_very_long_text(spark):
    assert R.prefix_trie(frame(spark, [])).count() == 0
    assert R.prefix_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0
    rows = [(3, 0, "user", "x" * 3_000_000), (8, 0, "user", "x" * 3_000_000), (13, 0, "user", "x")] + [(i, 0, "user", "x" * 3_000_000) for i in range(20, 26)]
    got = sorted((tuple(r) for r in R.prefix_trie(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)
