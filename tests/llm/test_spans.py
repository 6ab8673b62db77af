"""Personal data and secrets: strict spans against plain regular expressions, added spans, the ledger."""

import hashlib
import random
import re

import numpy as np
from edge import edge_docs
from pyspark.sql import functions as F

from tabforge.llm import pii as P
from tabforge.llm import secrets as L
from tabforge.llm.common import scratch_path
from tabforge.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(t):
    out = [(0, *m.span()) for m in EMAIL.finditer(t)]
    out += [(1, *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(t) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def noise(seed, alphabet, n):
    rng = random.Random(seed)
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_base_spans_equal_the_plain_patterns():
    texts = [noise(i, "0123456789..-- +()", 400) for i in range(150)] + [noise(i, "ab.@-_%1 é", 300) for i in range(150)]
    texts += ["1.2.3.4.5.6.7.8", "1..2.3.4.5", "300.1.1.1 1.2.3.4", "a@b.c@d.e", "@@a@b.c", "4111 1111 1111 1111", "+1 (858) 555-7260", "",
              "0001.2.3.4", "....1.2.3.4....", "٣.1.2.3.4"]
    for t in texts:
        assert sorted(P.base_spans(t)) == brute_pii(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+" * 300_000, "a@" * 150_000, "-" * 300_000):
        P.base_spans(t)
        P.loose_spans(t)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > .3)).astype(float)
    m = P.fit_trees(x[:1500], y[:1500])
    assert ((m.margin(x[1500:]) > 0) == y[1500:]).mean() > .95


def test_pii_query_matches_brute_force_and_keeps_the_base(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op3_pii"](spark, SF01).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        base = brute_pii(docs[r["doc_id"]])
        text = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(k == i for k, _, _ in base) for i in range(4))
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(r["spans"].split(","))
        assert len([s for s in r["spans"].split(",") if s]) == len(base) + r["n_added"]


def test_pii_adds_loose_formats_and_redacts(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        a, b = rng.randrange(100, 999), rng.randrange(1000, 9999)
        rows.append((i, f"please call +1 ({a}) 555-{b} or write to user{a}@mail{b}.example.com from 10.{a % 256}.3.{b % 256} now"))
    rows += [(1000, "please write to jane at example dot com"), (1001, "please call (415) 555-1234 today"), (1002, "version 1.2.3 of 2024-05-06"), (1003, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    model = P.fit_pii(d)
    got = {r["doc_id"]: r for r in P.find_pii(d, model).collect()}
    assert got[1000]["spans"].startswith("email:") and got[1001]["spans"] == "phone:12:26"
    assert got[1002]["n_added"] == 0 and got[1003]["spans"] == ""
    red = {r["doc_id"]: r["text"] for r in P.redact_pii(d, model).collect()}
    assert red[1001] == "please call [phone] today" and red[1003] is None and "@" not in red[3]


def test_numbers_side_by_side_are_candidates():
    for one, other, kind in (("+1 (826) 555-4081", "190.137.223.204", 3), ("4111-1111-1111-1111", "5500-0000-0000-0004", 2),
                             ("555-123-4567", "555-987-6543", 3), ("(415) 555-1234", "(415) 555-4321", 3)):
        text = f"call {one} {other} now"
        got = {(k, text[a:b]) for k, a, b in P.loose_spans(text)}
        assert (kind, one) in got and (kind == 3 and "." in other or (kind, other) in got), text
    many = " ".join(["555-123-4567"] * 40)
    assert {(3, i * 13, i * 13 + 12) for i in range(40)} <= set(P.loose_spans(many))


def test_pii_finds_numbers_side_by_side(spark):
    rng = random.Random(8)
    rows = [(i, f"call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} or pay by "
                f"{rng.choice(['4111 1111 1111 1111', '5500 0000 0000 0004', '4012 8888 8888 1881'])} from 10.{rng.randrange(256)}.3.7 now") for i in range(600)]
    more = {1000: ["+1 (826) 555-4081", "190.137.223.204"], 1001: ["4111-1111-1111-1111", "5500-0000-0000-0004"], 1002: ["555-123-4567", "555-987-6543"]}
    rows += [(i, "send " + " ".join(n) + " today") for i, n in more.items()]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in P.find_pii(d, P.fit_pii(d)).collect()}
    for i, (one, other) in more.items():
        a = 5 + len(one) + 1
        want = {1000: ("phone", "ip"), 1001: ("card", "card"), 1002: ("phone", "phone")}[i]
        assert sorted(got[i].split(",")) == sorted([f"{want[0]}:5:{5 + len(one)}", f"{want[1]}:{a}:{a + len(other)}"])


def test_pii_edge_rows(spark):
    d = edge_docs(spark)
    out = P.find_pii(d, P.fit_pii(d))
    assert out.count() == d.count()
    assert P.find_pii(d.limit(0), P.fit_pii(d.limit(0))).count() == 0
    assert P.redact_pii(d, P.fit_pii(d)).columns == d.columns


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def brute_secrets(t):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16]
    return sorted(out)


def check_base(docs, got):
    for r in got:
        base = brute_secrets(docs[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x[1] == i for x in base) for i in range(3))
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (r, text)
        assert set(text.split(",")) <= set(r["spans"].split(",")) | {""}


def test_secret_query_matches_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op7_secret_scan"](spark, SF01).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    check_base(docs, got)


def test_secret_spans_on_noise(spark, tmp_path):
    parts = ["token", "=", "secret:", " ", "'", "abcdef0123", "AKIA", "XYZ09", "é", "😀", "password", "\n", "api_key", "APIKEY", "-", "deadbeef"]
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(parts) for _ in range(60))) for i in range(400)] + [(1000, "token=secret:abcdefghijklmnop"), (1001, "ſecret=abcdefghijklmnop")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    check_base(dict(rows), QUERIES["op7_secret_scan"](spark, str(tmp_path)).collect())


def test_ledger_scans_only_unseen_pairs(spark):
    path = scratch_path(spark, "test-ledger")
    d = edge_docs(spark)
    first = L.scan_secrets(d, path)
    assert first.count() == d.count()
    n = spark.read.parquet(path).count()
    assert n == d.select(F.coalesce("text", F.lit(""))).distinct().count()
    L.update_ledger(d, path)
    assert spark.read.parquet(path).count() == n  # nothing unseen
    more = edge_docs(spark, [(99, "password=aaaaaaaaaaaaaaaa", "s")])
    again = L.scan_secrets(more, path)
    assert spark.read.parquet(path).count() == n + 1
    assert [x["kind"] for x in again.where("doc_id = 99").first()["findings"]] == ["assign", "hex"]
    rules = (*L.RULES[:2], L.Rule("hex", 2, r"[0-9a-f]{20,}", 0, 20), *L.RULES[3:])
    newer = L.scan_secrets(more, path, rules)  # only hex, in its new version, is scanned again
    added = [r["rules"] for r in spark.read.parquet(path).collect() if r["rules"] == ["hex@2"]]
    assert len(added) == n + 1
    assert [x["kind"] for x in newer.where("doc_id = 99").first()["findings"]] == ["assign"]
    assert [x["kind"] for x in L.scan_secrets(more, path).where("doc_id = 99").first()["findings"]] == ["assign", "hex"]


def test_ledger_with_an_empty_table(spark):
    assert L.scan_secrets(edge_docs(spark).limit(0), scratch_path(spark, "test-ledger")).count() == 0


def test_pairs_that_are_in_the_ledger_twice_count_once(spark):
    docs = edge_docs(spark)
    path = scratch_path(spark, "twice")
    show = lambda df: sorted(map(str, df.select("doc_id", "blob", L.joined(F.col("findings")).alias("f")).collect()))
    want = show(L.scan_secrets(docs, path))
    again = spark.read.schema(L.LEDGER).parquet(path)
    again.union(again.withColumn("rules", F.slice("rules", 1, 2)).withColumn("findings", F.filter("findings", lambda x: x["order"] < 2))).write.mode(
        "append").parquet(path)  # a repeated append, and a run that overlaps in two rules
    assert show(L.scan_secrets(docs, path)) == want and "assign:" in "".join(want)
