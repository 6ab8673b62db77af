"""Closed syncmers: definition, context freedom, and the neighbour query against brute force."""

import hashlib
import random

import numpy as np
from edge import edge_docs

from tabforge.llm import syncmers as Y
from tabforge.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"


def test_anchors_are_closed_syncmers():
    rng = random.Random(1)
    t = "".join(rng.choice("abcdé😀 ") for _ in range(500))
    h, at = Y.anchors(t)
    s_hash = {}
    points = np.array([ord(c) for c in t], np.uint64)
    inner = Y._rolling(points, Y.S)
    for i in range(len(t) - Y.S + 1):  # equal s-mers have equal hashes
        assert s_hash.setdefault(t[i:i + Y.S], inner[i]) == inner[i]
    want = []
    for i in range(len(t) - Y.K + 1):
        w = [int(s_hash[t[j:j + Y.S]]) for j in range(i, i + Y.K - Y.S + 1)]
        if min(w) in (w[0], w[-1]):
            want.append(i)
    assert at.tolist() == want
    assert max(np.diff(at)) <= Y.K - Y.S  # every window has one
    h2, at2 = Y.anchors("xyz" + t[50:300] + "q")  # context-free: the inner anchors stay
    inside = {int(x) for x, p in zip(h, at) if 50 <= p <= 300 - Y.K}
    assert inside <= set(h2.tolist())
    assert Y.aligned_share(t, "zz" + t) == 1.0


def test_likeness_tracks_the_common_share():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    a, b = " ".join(word() for _ in range(600)), " ".join(word() for _ in range(600))
    half = a[: len(a) // 2] + b[: len(a) // 2]
    assert Y.likeness(Y.sketch(a), Y.sketch(a)) == 1 and Y.likeness(Y.sketch(a), Y.sketch(b)) < .1
    assert .35 < Y.likeness(Y.sketch(a), Y.sketch(half)) < .65
    assert Y.likeness(Y.sketch(""), Y.sketch("")) == 1 and Y.likeness(Y.sketch(""), Y.sketch("a")) == 0
    assert (Y.from_text(Y.to_text(Y.sketch(a))) == Y.sketch(a)).all()


def brute_aligned(a, b):
    (ha, pa), (hb, pb) = (tuple(x.tolist() for x in Y.text_anchors(t)) for t in (a, b))
    if not ha or not hb:
        return float(len(ha) == len(hb))
    shifts = [pb[hb.index(h)] - p for h, p in zip(ha, pa) if h in hb]
    return max((shifts.count(x) for x in set(shifts)), default=0) / len(ha)


def brute(rows):
    """Rows are (id, text, hash of the text)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]), reverse=True)
    out = []
    for k, (i, t, _) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 3
        e = t[:len(t) - m] + nxt[:m]
        f = [Y.sketch(x) for x in (t, e, nxt)]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), Y.to_text(f[0]), Y.to_text(f[1]), Y.likeness(f[0], f[1]), Y.likeness(f[0], f[2]),
                    brute_aligned(t, e) if len(t) < 5000 else Y.aligned_share(t, e), brute_aligned(t, nxt) if len(t) + len(nxt) < 5000 else Y.aligned_share(t, nxt)))
    return sorted(out, key=str)


def hashed(docs):
    return [tuple(r) for r in docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, ''))").collect()]


def test_neighbour_query_matches_brute_force(spark, monkeypatch):
    rows = hashed(spark.read.parquet(f"{SF001}/documents.parquet"))
    for per in (2048, 16):
        monkeypatch.setattr(Y, "PER_RANGE", per)
        monkeypatch.setattr(Y, "STRIDE", 4 if per == 16 else 256)
        got = sorted((tuple(r) for r in QUERIES["op6_syncmers"](spark, SF001).collect()), key=str)
        assert got == brute(rows)


def test_neighbours_of_edge_rows(spark, monkeypatch):
    d = edge_docs(spark)
    rows = hashed(d)
    for per in (2048, 2):
        monkeypatch.setattr(Y, "PER_RANGE", per)
        assert sorted((tuple(r) for r in Y.neighbour_fingerprints(d).collect()), key=str) == brute(rows)
    assert Y.neighbour_fingerprints(d.limit(0)).count() == 0
    one = Y.neighbour_fingerprints(d.where("doc_id = 11")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert Y.fingerprints(d).count() == d.count()


def test_null_and_repeated_ids_are_split(spark, monkeypatch):
    d = spark.range(3000).selectExpr("case when id % 3 = 0 then id when id % 3 = 1 then 7 end as doc_id", "concat('a text of its own, number ', id) as text")
    want = brute(hashed(d))
    for per in (64, 2048):
        monkeypatch.setattr(Y, "PER_RANGE", per)
        assert sorted((tuple(r) for r in Y.neighbour_fingerprints(d).collect()), key=str) == want
    sizes = [r["count"] for r in Y.ranges(d.selectExpr("doc_id", "text as t"), 64)[0].groupBy("part").count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 3 * 64


def test_ids_of_other_types(spark, monkeypatch):
    monkeypatch.setattr(Y, "PER_RANGE", 32)
    for kind in ("date_add(date'2024-01-01', cast(id as int))", "timestamp_micros(id * 1234567)", "cast(id / 7 as decimal(9,3))",
                 "cast(cast(id as string) as binary)", "concat('k', id)"):
        d = spark.range(300).selectExpr(f"{kind} as doc_id", "concat('text number ', id, ' of three hundred') as text")
        got = Y.neighbour_fingerprints(d).select("doc_id", "edited_sha256").collect()
        assert len({bytes(r[0]) if isinstance(r[0], bytearray) else r[0] for r in got}) == len(got) == 300
        monkeypatch.setattr(Y, "PER_RANGE", 2048)  # one range gives the same neighbours
        assert sorted(map(str, got)) == sorted(map(str, Y.neighbour_fingerprints(d).select("doc_id", "edited_sha256").collect()))
        monkeypatch.setattr(Y, "PER_RANGE", 32)


def test_short_texts_keep_some_of_their_anchors():
    for t in ("hello there", "twelve chars", "a short line of text", "x" * 3 + "0123456789"):
        m = len(t) // 3
        e = t[:len(t) - m] + "ZQWVY#!JKLU"[:m]
        assert 0 < Y.likeness(Y.sketch(t), Y.sketch(e)) < 1
        assert .3 < Y.aligned_share(t, e) < 1
    assert Y.aligned_share("", "") == 1 and Y.aligned_share("", "abc") == 0 and Y.aligned_share("ab", "ab") == 1
