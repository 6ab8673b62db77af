"""Registered queries of the corpus operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat as C
from . import exact_dedup as E
from . import licenses as G
from . import mixing as M
from . import order as O
from . import packing as K
from . import phrases as W
from . import pii as P
from . import prefix_trie as R
from . import secrets as L
from . import simhash as S
from . import syncmers as Y
from . import toxicity as X
from .common import prepare, read_table, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return f(spark, sf_dir)

        QUERIES[name] = query
        if sql:
            ORACLE[name] = sql
        return query
    return add


def held_out(id_col: str = "doc_id"):
    """The rows that labels are never learnt from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


@register("op1_training_order")
def op1_training_order(spark, sf):
    from public_tokenizers import path

    return O.write_shards(read_table(spark, sf, "documents"), scratch_path(spark, "training-order"), path("byte_bpe_50k.tiktoken"),
                          size=2048, per_shard=4096, end_id=50256, width=2)


@register("op2_toxicity")
def op2_toxicity(spark, sf):
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    model = X.fit_toxicity(docs, labels, learn=~held_out())
    scored = X.score_toxicity(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "n_hits", "n_quoted")


@register("op3_pii")
def op3_pii(spark, sf):
    docs = read_table(spark, sf, "documents")
    return P.find_pii(docs, P.fit_pii(docs))


@register("op5_chat_roles")
def op5_chat_roles(spark, sf):
    return C.render(read_table(spark, sf, "conversations"))


@register("op6_syncmers")
def op6_syncmers(spark, sf):
    return Y.neighbour_fingerprints(read_table(spark, sf, "documents"))


@register("op7_secret_scan")
def op7_secret_scan(spark, sf):
    docs = read_table(spark, sf, "documents")
    found = L.scan_secrets(docs, scratch_path(spark, "secret-ledger"))
    base = F.filter("findings", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(L.joined(base).cast("binary"), 256).alias("base_sha256"),
                        L.joined(F.col("findings")).alias("spans"), "blob")


@register("op4_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         length(coalesce(text, '')) AS n_points
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)""")
def op4_exact_dedup(spark, sf):
    return E.exact_dedup(read_table(spark, sf, "documents")).drop("n_points")


@register("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark, sf):
    found = S.near_duplicates(read_table(spark, sf, "documents"), words=4, max_bits=4, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source),
w AS (SELECT *, CAST(2 * source_size AS DOUBLE) AS most, CAST([3, 1, 2][CAST(no % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight FROM s),
l AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(most) OVER (ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (
  SELECT source, source_size, no,
         CASE WHEN most <= level * weight THEN most ELSE weight * (SELECT max(level) FROM l AS m WHERE m.most > m.level * m.weight) END AS target
  FROM l),
n AS (SELECT *, CAST(round(target) AS BIGINT) AS line, CAST(ceil(round(target) / 1024) AS BIGINT) AS need FROM t),
f AS (SELECT *, CAST(sum(need) OVER (ORDER BY no) AS BIGINT) - need AS first FROM n),
k AS (SELECT CAST(sum(need) AS BIGINT) AS k FROM n),
g AS (SELECT k, coalesce((SELECT g FROM range(1, (SELECT k FROM k)) AS r(g) WHERE gcd(g, k) = 1
                          ORDER BY abs(g - round(k / CAST((1 + sqrt(5)) / 2 AS DOUBLE))), g LIMIT 1), 1) AS g FROM k),
slots AS (
  SELECT f.no, i AS slot, row_number() OVER (PARTITION BY f.no ORDER BY i) - 1 AS rank
  FROM (SELECT i, CAST(CAST(i AS HUGEINT) * g % k AS BIGINT) AS point FROM g, range(0, (SELECT k FROM k)) AS r(i)) AS p
  ASOF JOIN (SELECT * FROM f WHERE need > 0) AS f ON p.point >= f.first),
c AS (
  SELECT d.doc_id, d.size, f.no, f.line, turn, f.source_size,
         CAST('0x' || substr(md5(concat_ws(':', '17', CAST(turn AS VARCHAR), CAST(d.doc_id AS VARCHAR))), 1, 15) AS BIGINT) AS o
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source, range(0, 2) AS q(turn)
  WHERE d.size > 0 AND turn * f.source_size < f.line),
x AS (SELECT *, turn * source_size + CAST(sum(size) OVER (PARTITION BY no, turn ORDER BY o, doc_id) AS BIGINT) - size AS a FROM c),
y AS (SELECT doc_id, no, a, least(a + size, line) AS b FROM x WHERE a < line),
z AS (SELECT doc_id, no, a, b, unnest(range(a // 1024, (b - 1) // 1024 + 1)) AS rank FROM y),
p AS (
  SELECT doc_id, CAST(sum(least(b, (z.rank + 1) * 1024) - greatest(a, z.rank * 1024)) AS BIGINT) AS taken, min(slot) AS first_slot, count(*) AS blocks
  FROM z JOIN slots ON z.no = slots.no AND z.rank = slots.rank GROUP BY doc_id)
SELECT d.doc_id, d.size, d.source, t.source_size, t.target, coalesce(p.taken, 0) AS taken, p.first_slot, coalesce(p.blocks, 0) AS blocks
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN p ON d.doc_id = p.doc_id"""


@register("op9_source_mixing", OP9_SQL)
def op9_source_mixing(spark, sf):
    return M.mix_sources(read_table(spark, sf, "documents")).drop("row_no", "text_key")


@register("op10_packing")
def op10_packing(spark, sf):
    from public_tokenizers import path

    return K.pack(read_table(spark, sf, "documents"), path("word_bpe_49k.json"), size=2048, end_id=1)


def op11_sql() -> str:
    """The scan in DuckDB: the same rules as values, matches by splitting, suppression by comparing the intervals of a text."""
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    rules = ",\n".join(f"({i},{quote(r.label)},{r.tier},{str(r.base).lower()},{quote(r.pattern)},[{','.join(map(quote, r.keywords))}])"
                       for i, r in enumerate(G.signature_rules()))
    sure = " ".join(f"WHEN {t} THEN {s}" for t, s in G.SURE.items())
    return rf"""
WITH rules(no, label, tier, base, pattern, keywords) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS uid, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
k AS (SELECT DISTINCT unnest(keywords) AS word FROM rules),
p AS (SELECT uid, list(DISTINCT word) AS present FROM (SELECT uid, unnest(words) AS word FROM d) SEMI JOIN k USING (word) GROUP BY uid),
c AS (SELECT d.uid, ' ' || array_to_string(words, '  ') || ' ' AS padded, r.* FROM p JOIN rules AS r ON list_has_all(p.present, r.keywords)
      JOIN d ON d.uid = p.uid),
h AS (SELECT *, string_split_regex(padded, pattern) AS gaps, regexp_extract_all(padded, pattern) AS hits FROM c WHERE regexp_matches(padded, pattern)),
m AS (SELECT uid, no, label, tier, base, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, unnest(range(len(hits))) AS nth FROM h),
w AS (SELECT *, CAST((len(hit) - len(replace(hit, ' ', ''))) / 2 AS BIGINT) AS n_hit, CAST((len(gap) - len(replace(gap, ' ', ''))) / 2 AS BIGINT) AS n_gap FROM m),
f AS (SELECT uid, no, label, tier, base, CAST(sum(n_gap + n_hit) OVER (PARTITION BY uid, no ORDER BY nth) AS BIGINT) AS e, e - n_hit AS s FROM w),
kept AS (SELECT f.*, NOT EXISTS (SELECT 1 FROM f AS g WHERE g.uid = f.uid AND g.s <= f.s AND g.e >= f.e
           AND (g.tier > f.tier OR g.tier = f.tier AND (g.e - g.s > f.e - f.s OR g.e - g.s = f.e - f.s AND g.no < f.no))) AS kept FROM f),
r AS (SELECT uid, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
        array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
        array_to_string(list_sort(list(DISTINCT label) FILTER (base OR kept)), ',') AS labels,
        max(CASE WHEN kept THEN CASE tier {sure} END END) AS score, count(*) FILTER (kept) AS n_kept FROM kept GROUP BY uid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score, coalesce(n_kept, 0) AS n_kept
FROM d LEFT JOIN r USING (uid)"""


@register("op11_license_scan", op11_sql())
def op11_license_scan(spark, sf):
    found = G.scan_licenses(read_table(spark, sf, "documents"))
    base, stay = F.filter("findings", lambda x: x["base"]), F.filter("findings", lambda x: x["base"] | x["kept"])
    starts = F.transform(base, lambda x: x["start"].cast("long"))
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), G.labels_of(base).alias("base_labels"), G.labels_of(stay).alias("labels"),
                        G.certainty(F.col("findings")).alias("score"),
                        F.size(F.filter("findings", lambda x: x["kept"])).cast("long").alias("n_kept"))


OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT row_number() OVER () AS id, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM d),
u AS (SELECT id, lang, unnest(words) AS w1, unnest(range(len(words))) AS i FROM w),
s AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5
      FROM u WINDOW o AS (PARTITION BY id ORDER BY i)),
g AS (SELECT lang, w1 AS phrase, 1 AS m FROM s UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM s WHERE w2 IS NOT NULL
      UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM s WHERE w3 IS NOT NULL
      UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM s WHERE w4 IS NOT NULL
      UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, 5 FROM s WHERE w5 IS NOT NULL),
c AS (SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM g GROUP BY lang, phrase),
n AS (SELECT lang, sum(f) AS n FROM c WHERE m = 1 GROUP BY lang),
p AS (SELECT *, string_split(phrase, ' ') AS words FROM c WHERE m > 1 AND f >= 100),
k AS (SELECT p.lang, p.phrase, p.f AS a, n.n, k, x.f AS l, y.f AS r,
        1000::HUGEINT * p.f * n.n // (x.f::HUGEINT * y.f) AS score
      FROM p, range(1, 5) AS q(k), c AS x, c AS y, n
      WHERE k < p.m AND x.lang = p.lang AND x.phrase = array_to_string(words[1:k], ' ') AND y.lang = p.lang
        AND y.phrase = array_to_string(words[k + 1:], ' ') AND n.lang = p.lang),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(words[i:i + o - 1], ' ') AS phrase, max(f) AS longer
      FROM (SELECT p.*, unnest(range(1, m - o + 2)) AS i, o FROM p, range(2, 5) AS q(o) WHERE o < m) GROUP BY ALL),
z AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score FROM z QUALIFY rank <= 2000"""


@register("op12_phrase_collocations", OP12_SQL)
def op12_phrase_collocations(spark, sf):
    return W.collocations(read_table(spark, sf, "documents"), least=100, share=100, top=2000)


OP13_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT i, i AS v, 0 AS step FROM range(256) AS r(i)
        UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, step + 1 FROM crc WHERE step < 8),
tab AS (SELECT list(v ORDER BY i) AS vs FROM crc WHERE step = 8),
c AS (SELECT conv, conv - conv % 5 AS base, count(*) AS n FROM t GROUP BY conv),
k AS (SELECT conv, CAST(conv AS VARCHAR) AS s, 0 AS i, 4294967295 AS v FROM c
      UNION ALL SELECT conv, s, i + 1, xor(v // 256, vs[xor(v % 256, ascii(s[i + 1])) + 1]) FROM k, tab WHERE i < len(s)),
h AS (SELECT c.conv, c.base, xor(k.v, 4294967295) % 9 AS h, coalesce(b.n, 0) AS base_n
      FROM c JOIN k ON k.conv = c.conv AND k.i = len(k.s) LEFT JOIN c AS b ON b.conv = c.base),
r AS (SELECT h.conv, t.pos AS depth, role, text FROM h JOIN t ON t.conv = h.base AND t.pos <= h.h
      UNION ALL SELECT h.conv, least(h.h, base_n) + pos - h.h, role, text FROM h JOIN t ON t.conv = h.conv AND t.pos > h.h),
p AS (SELECT conv, depth, strlen(text) AS bytes,
        md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY conv ORDER BY depth)) AS node FROM r
      UNION ALL SELECT conv, 0, 0, 'root' FROM c),
n AS (SELECT node, depth, min(conv) AS owner, count(*) AS n_convs, max(bytes) AS bytes FROM p GROUP BY node, depth),
e AS (SELECT n.*, q.node AS up FROM n LEFT JOIN p AS q ON q.conv = n.owner AND q.depth = n.depth - 1),
ch AS (SELECT up, count(*) AS n_children FROM e WHERE up IS NOT NULL GROUP BY up),
v AS (SELECT e.*, coalesce(n_children, 0) AS n_children FROM e LEFT JOIN ch ON ch.up = e.node),
a AS (SELECT p.node, p.depth, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved
      FROM v JOIN p ON p.conv = v.owner AND p.depth <= v.depth GROUP BY p.node, p.depth),
z AS (SELECT arg_max(node, depth) AS node, conv FROM p GROUP BY conv),
x AS (SELECT node, sha256(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv)) AS ends FROM z GROUP BY node)
SELECT v.owner AS conv_id, CAST(v.depth AS BIGINT) AS depth, u.owner AS parent_conv_id, v.n_convs, v.n_children,
       CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, coalesce(x.ends, sha256('')) AS ends_sha256
FROM v JOIN a ON a.node = v.node AND a.depth = v.depth LEFT JOIN n AS u ON u.node = v.up LEFT JOIN x ON x.node = v.node"""


@register("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark, sf):
    return R.prefix_trie(read_table(spark, sf, "conversations"))
