"""Mixing, packing, training order and chat repair against brute force and round trips."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from edge import edge_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabforge.llm import chat as C
from tabforge.llm import mixing as M
from tabforge.llm import order as O
from tabforge.llm import packing as K
from tabforge.llm.common import scratch_path
from tabforge.llm.queries import QUERIES
from tabforge.llm.tokens import WordTokens

SF001 = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# --- mixing --------------------------------------------------------------------

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, list(names), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= cap * sizes[s]]
        if not over:
            target.update({s: weight[s] * level for s in free})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def check_mix(rows):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["first_slot"] is None) == (r["taken"] == 0)
    want = brute_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1
    return sizes


def test_mix_reaches_its_targets(spark):
    rows = QUERIES["op9_source_mixing"](spark, SF001).collect()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(rows) == len(docs)
    assert {r["doc_id"]: r["size"] for r in rows} == {r["doc_id"]: len((r["text"] or "").encode().split()) for r in docs}
    check_mix(rows)
    assert sorted(map(str, rows)) == sorted(map(str, QUERIES["op9_source_mixing"](spark, SF001).collect()))


def test_mix_of_edge_rows_and_many_ranges(spark, monkeypatch):
    d = edge_docs(spark)
    for per in (4096, 2):
        monkeypatch.setattr(M, "PER_RANGE", per)
        for block in (1024, 1, 3000):
            rows = M.mix_sources(d, block=block).collect()
            assert len(rows) == d.count()
            check_mix(rows)
    assert M.mix_sources(d.limit(0)).count() == M.apply_mix(d.limit(0)).count() == 0
    assert M.mix_sources(d.where("text is null")).agg(F.sum("taken")).first()[0] == 0


def test_applied_mix_takes_whole_copies_and_first_words(spark):
    d = edge_docs(spark)
    out = M.apply_mix(d)
    assert out.schema.simpleString() == d.schema.simpleString()
    words = lambda df: {r["source"]: r["n"] for r in df.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
    want = {r["source"]: r["taken"] for r in M.mix_sources(d).groupBy("source").agg(F.sum("taken").alias("taken")).collect() if r["taken"]}
    assert words(out) == want


def test_schedule_is_even():
    for k in (1, 2, 10, 97, 5000):
        g = M.golden_step(k)
        points = [i * g % k for i in range(k)]
        assert sorted(points) == list(range(k))
    first = [i * M.golden_step(5000) % 5000 < 1000 for i in range(5000)]  # a source with a fifth of the slots
    at = [i for i, x in enumerate(first) if x]
    assert max(np.diff(at)) <= 13


# --- packing -------------------------------------------------------------------

def check_pack(rows, docs, size=2048):
    """Every id in exactly one piece, sequences gapless and at most ``size``; returns the padding's share."""
    tok = Tokenizer.from_file(WORDS)
    want = sorted((str(i), tuple(tok.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in docs)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[str(r["doc_id"]), r["doc_tokens"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    pad = used = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= size and all(r["sequence_tokens"] == at for r in pieces)
        used += at
        pad += 0 if at & (at - 1) == 0 else size - at
    assert used == sum(len(i) for _, i in want)
    for name, ids in want:  # rows that repeat an id and a length are told apart by their pieces' sums only
        for r in by_doc[name, len(ids)]:
            if sum(n == name for n, _ in want) == 1:
                part = np.asarray(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
                assert zlib.crc32(part) == r["ids_crc32"]
    for (name, n), pieces in by_doc.items():
        copies = sum(x == name and len(i) == n for x, i in want)
        starts = sorted((r["start"], r["length"]) for r in pieces)
        assert sum(length for _, length in starts) == copies * n
        if copies == 1:
            assert [s for s, _ in starts] == [0, *itertools.accumulate(length for _, length in starts)][:-1]
    return pad / max(1, used)


def test_packing_query_round_trip(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert check_pack(QUERIES["op10_packing"](spark, SF001).collect(), docs) < 0.01


def test_packing_with_few_windows_and_edge_rows(spark):
    d = edge_docs(spark).repartition(3)
    docs = [(r["doc_id"], r["text"]) for r in d.collect()]
    check_pack(K.pack(d, WORDS, windows=2).collect(), docs)
    check_pack(K.pack(d, WORDS, size=64, windows=1).collect(), docs, 64)
    assert K.pack(d.limit(0), WORDS).count() == 0


def test_word_cache_equals_the_tokenizer(monkeypatch):
    from tabforge.llm import tokens
    tok = Tokenizer.from_file(WORDS)
    rng = random.Random(4)
    bits = ["Hello", "it's", "don't.", "é", "é", "ΣΑΣ", "İ", " ", " ", "\x1c", "\t", "\r\n", " ", " ", "\n", "a,b", "42.", "...", "x.", "X,", "'s.",
            "<|endoftext|>", "<|EndOfText|>", "ｆ", "́", "日本.", "٣.", "_", "A1.", "ǅ.", "😀", "|a|.", "word", "Ab", "\u1100", "\u1161", "\ud55c"]
    texts = ["".join(rng.choice(bits) for _ in range(40)) for _ in range(500)]
    for cache in (400_000, 50):
        monkeypatch.setattr(tokens, "CACHE", cache)
        mine = WordTokens(WORDS)
        for k in range(0, 500, 7):
            for t, got in zip(texts[k:k + 7], mine.ids(texts[k:k + 7])):
                assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


# --- training order --------------------------------------------------------------

def test_feistel_is_a_permutation_and_can_be_undone():
    for n in (1, 2, 3, 5, 64, 65, 1000, 4097):
        p = O.permute(np.arange(n), n, "k")
        assert sorted(p.tolist()) == list(range(n))
        assert (O.permute(p, n, "k", back=True) == np.arange(n)).all()
    assert (O.permute(np.arange(1000), 1000, "a") != O.permute(np.arange(1000), 1000, "b")).any()
    n = 3_000_000_017
    i = np.array([0, 1, n // 2, n - 1])
    assert (O.permute(O.permute(i, n, "k"), n, "k", back=True) == i).all()


@pytest.mark.parametrize("edge", [False, True])
def test_shards_round_trip(spark, edge):
    docs = edge_docs(spark).repartition(3) if edge else spark.read.parquet(f"{SF001}/documents.parquet")
    path = scratch_path(spark, "test-order")
    per = 16
    manifest = O.write_shards(docs, path, RANKS, size=256, per_shard=per).collect()
    n = len(manifest)
    assert sorted(r["slot"] for r in manifest) == list(range(n))
    assert all(r["shard"] == r["slot"] // per and r["byte_offset"] == r["slot"] % per * (512 + len(O.MARK)) for r in manifest)
    got = {r["slot"]: bytes(r["ids"]) for r in O.read_slots(spark, path, 0, n, size=256, per_shard=per).collect()}
    assert sorted(got) == list(range(n)) and all(zlib.crc32(got[r["slot"]]) == r["ids_crc32"] for r in manifest)
    assert all(np.frombuffer(b, "<u2").max() <= 50256 and len(b) == 512 for b in got.values())
    some = [r["slot"] for r in O.read_slots(spark, path, 5, 30, size=256, per_shard=per).collect()]
    assert sorted(some) == list(range(5, min(35, n)))
    # the ids, in the order of their numbers, are those of the documents
    encoder = O.RankTokens(RANKS)
    want = sorted(tuple(encoder.ids(r["text"] or "")) for r in docs.collect())
    number = O.permute(np.arange(n), n, "epoch-0", back=True)
    parts, now = [], []
    used = {r["slot"]: r["n_tokens"] for r in manifest}
    for s in np.argsort(number):
        ids = np.frombuffer(got[int(s)], "<u2")[:used[int(s)]]
        for i in ids.tolist():
            if i == 50256:
                parts.append(tuple(now))
                now = []
            else:
                now.append(i)
    assert not now and sorted(parts) == want


def test_training_order_of_an_empty_table(spark):
    assert O.write_shards(edge_docs(spark).limit(0), scratch_path(spark, "test-order"), RANKS).count() == 0


# --- chat ------------------------------------------------------------------------

def brute_cost(roles):
    best = {C.START: 0.0}
    for r in roles:
        new = {}
        for s, c in best.items():
            for take in (1, 2, 3):
                label = 0 if take == r else C.UNKNOWN if r == 0 else C.RELABEL
                if s == take:
                    new[take] = min(new.get(take, 99), c + C.MERGE + label)
                for k in range(4):
                    for path in itertools.product((1, 2, 3), repeat=k):
                        x = s
                        ok = True
                        for p in (*path, take):
                            ok, x = ok and p in C.NEXT[x], p
                        if ok:
                            new[take] = min(new.get(take, 99), c + label + C.INSERT * k)
        best = new
    return min(c + C.ENDS[s] for s, c in best.items())


def cost_of(steps, roles):
    total = 0.0
    for (take, action, path), r in zip(steps, roles):
        total += C.INSERT * len(path) + C.MERGE * ("merge" in action) + (0 if take == r else C.UNKNOWN if r == 0 else C.RELABEL)
    return total + C.ENDS[steps[-1][0]]


def test_repair_is_of_least_cost_also_in_segments():
    rng = random.Random(6)
    for roles in [list(p) for k in (1, 2, 3) for p in itertools.product(range(4), repeat=k)] + [[rng.randrange(4) for _ in range(9)] for _ in range(60)]:
        want = brute_cost(roles)
        assert cost_of(C.repair(roles), roles) == want
        cuts = sorted({0, len(roles), *(rng.randrange(len(roles) + 1) for _ in range(3))})
        parts = [roles[a:b] for a, b in zip(cuts, cuts[1:])]
        states = C.border_states([(i, C.transfer(p)) for i, p in enumerate(parts)])
        steps = [s for i, p in enumerate(parts) for s in C.repair(p, *states[i])]
        assert cost_of(steps, roles) == want


def whole(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["place"]):
        out[r["conv_id"]].append(r["rendered"])
    return {k: "".join(v) for k, v in out.items()}


def legal(text):
    roles = [line[2:-2] for line in text.split("\n") if line.startswith("<|") and line != "<|end|>"]
    body = roles[1:] if roles[:1] == ["system"] else roles
    return body and len(body) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def test_chat_query_and_hot_conversation(spark):
    got = QUERIES["op5_chat_roles"](spark, SF001).collect()
    src = spark.read.parquet(f"{SF001}/conversations.parquet")
    assert len(got) == src.count() and all(legal(t) for t in whole(got).values())
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "Human", "assistant", "system", None, "??"]), f"m{t}") for t in range(3000)]
    rows += [(c, t, rng.choice(["user", "bot", "system"]), f"m{t}") for c in range(2, 60) for t in range(rng.randrange(1, 8))]
    rows += [(None, 1, "user", None), (None, None, "user", ""), (None, 1, "user", None), (70, 0, "user", "a"), (70, 0, "user", "a")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1)).withColumn("n", F.lit(2))
    out = C.render(d).collect()
    assert len(out) == len(rows)
    texts = whole(out)
    assert all(legal(t) for t in texts.values())
    number = {"system": 1, "user": 2, "human": 2, "assistant": 3, "bot": 3}
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: r["place"]):
        by[r["conv_id"]].append(r)
    for c, rs in by.items():
        roles = [number.get((r["role"] or "").lower(), 0) for r in rs]
        steps = [(C.ROLES.index(r["new_role"]) + 1, r["action"], [x for x in r["inserted"].split(",") if x]) for r in rs]
        assert cost_of(steps, roles) == cost_of(C.repair(roles), roles), c
    assert C.render(d.limit(0)).count() == 0
    assert texts[70] == "<|user|>\na\na<|end|>\n<|assistant|>\n<|end|>\n"
