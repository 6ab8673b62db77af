"""Registered queries: cleaning, scalar functions, lookups, encoding (P, F, J, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean as C
from ..operators import encode as EN
from .registry import register
from .tables import DOC_ALL_SQL, DOC_RAW_SQL, doc_all, doc_raw, read, with_

# Our own alias map for the language codes of ``documents`` (stand-in for the scoring maps).
LANG_MAP = {"en": "English", "english": "English", "de": "German", "german": "German", "deutsch": "German",
            "fr": "French", "french": "French", "es": "Spanish", "spanish": "Spanish"}

_WS_SQL = r"[ \t\n\r\f\x0B]"


def _md5_draw_sql(*parts: str, seed: int = 42) -> str:
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5(concat_ws(':', {inner}, '{seed}')), 1, 8)) AS BIGINT)"


@register("p1_rename_positional", "SELECT r_regionkey AS region_key, r_name AS region_name FROM region")
def p1_rename_positional(spark, sf):
    return C.rename_positional(read(spark, sf, "region"), ["region_key", "region_name"])


@register("p2_p3_drop_select", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def p2_p3_drop_select(spark, sf):
    o = C.drop_columns(read(spark, sf, "orders"), ["o_orderstatus", "o_orderdate"])
    return C.select_features(o, ["o_totalprice", "o_orderpriority"], keep=["o_orderkey"])


_STRIP_SQL = "'" + S.STRIP_CHARS + "'"


@register("f1_strip_whitespace", f"SELECT doc_id, trim(text, {_STRIP_SQL}) AS text FROM documents")
def f1_strip_whitespace(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", S.strip_ws("text").alias("text"))


@register("f2_lookup_key", f"SELECT doc_id, lower(regexp_replace(lang, '^{_WS_SQL}+|{_WS_SQL}+$', '', 'g')) AS lang_key "
                           "FROM documents")
def f2_lookup_key(spark, sf):
    return read(spark, sf, "documents").select("doc_id", S.lookup_key("lang").alias("lang_key"))


_NUM_RE_SQL = r"^[+-]?(([0-9]+(\.[0-9]*)?)|(\.[0-9]+))([eE][+-]?[0-9]+)?$"


@register("f3_parse_number", f"""
SELECT event_id,
  CASE WHEN regexp_matches(regexp_replace(props, '^{_WS_SQL}+|{_WS_SQL}+$', '', 'g'), '{_NUM_RE_SQL}')
       THEN TRY_CAST(regexp_replace(props, '^{_WS_SQL}+|{_WS_SQL}+$', '', 'g') AS DOUBLE) END AS props_num,
  CASE WHEN regexp_matches(regexp_extract(props, '[0-9]+'), '{_NUM_RE_SQL}')
       THEN TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) END AS k_num
FROM events""")
def f3_parse_number(spark, sf):
    e = read(spark, sf, "events")
    return e.select("event_id", S.parse_number("props").alias("props_num"),
                    S.parse_number(F.regexp_extract("props", "[0-9]+", 0)).alias("k_num"))


@register("f4_log1p", "SELECT c_custkey, round(CASE WHEN c_acctbal > -1 THEN ln(1 + c_acctbal) END, 6) AS log_acctbal "
                      "FROM customer")
def f4_log1p(spark, sf):
    c = read(spark, sf, "customer")
    return c.select("c_custkey", S.safe_log1p("c_acctbal").alias("log_acctbal"))


@register("f5_encode_target", """
SELECT l_orderkey, l_linenumber, CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 END AS INTEGER) AS flag_code
FROM lineitem""")
def f5_encode_target(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return EN.encode_target(li, "l_returnflag", {"A": 1, "R": 0}, out="flag_code").drop("l_returnflag")


@register("f6_label_encoder_fit", """
SELECT "column", value, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code FROM (
  SELECT DISTINCT 'lang' AS "column", lang AS value FROM documents WHERE lang IS NOT NULL
  UNION ALL SELECT DISTINCT 'source', source FROM documents WHERE source IS NOT NULL)""")
def f6_label_encoder_fit(spark, sf):
    return EN.fit_label_encoder(read(spark, sf, "documents"), ["lang", "source"])


@register("f6_encoder_high_cardinality", """
SELECT 'c_name' AS "column", c_name AS value, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL)""")
def f6_encoder_high_cardinality(spark, sf):
    return EN.fit_label_encoder(read(spark, sf, "customer"), ["c_name"])


@register("f7_encoder_error_mode", """
SELECT c_custkey, CASE WHEN c_name IS NULL OR c_custkey % 7 = 3 THEN NULL ELSE CAST(r AS INTEGER) END AS c_name,
       CASE WHEN c_custkey % 7 = 3 THEN 'invalid:c_name:''nobody'' valid: ' || n || ' known values'
            WHEN c_name IS NULL THEN 'invalid:c_name:''None'' valid: ' || n || ' known values' ELSE '' END AS errors
FROM customer LEFT JOIN (SELECT value, rank() OVER (ORDER BY value) - 1 AS r FROM (SELECT DISTINCT c_name AS value FROM customer
                         WHERE c_name IS NOT NULL)) AS l ON value = c_name,
     (SELECT count(DISTINCT c_name) AS n FROM customer)""")
def f7_encoder_error_mode(spark, sf):
    """F7, scoring path: a category that was not fitted becomes an error entry."""
    c = read(spark, sf, "customer").select("c_custkey", "c_name")
    enc = EN.fit_label_encoder(c, ["c_name"])
    seen = c.withColumn("c_name", F.when(F.col("c_custkey") % 7 == 3, "nobody").otherwise(F.col("c_name")))
    out = EN.apply_label_encoder(seen, enc, ["c_name"], unknown="error")
    return out.withColumn("errors", F.array_join("errors", ";"))


@register("f7_label_encoder_apply", with_(DOC_RAW_SQL) + """,
enc AS (SELECT "column", value, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT 'lang' AS "column", lang AS value FROM doc_raw WHERE lang IS NOT NULL
              UNION ALL SELECT DISTINCT 'source', source FROM doc_raw WHERE source IS NOT NULL))
SELECT d.doc_id, CAST(coalesce(a.code, -1) AS INTEGER) AS lang, CAST(coalesce(b.code, -1) AS INTEGER) AS source
FROM documents d
LEFT JOIN enc a ON a."column" = 'lang' AND a.value = d.lang
LEFT JOIN enc b ON b."column" = 'source' AND b.value = d.source""")
def f7_label_encoder_apply(spark, sf):
    enc = EN.fit_label_encoder(doc_raw(spark, sf), ["lang", "source"])
    d = read(spark, sf, "documents").select("doc_id", "lang", "source")
    return EN.apply_label_encoder(d, enc, ["lang", "source"], unknown="minus_one")


def _fence_sql(src: str, col: str, name: str) -> str:
    return (f"{name} AS (SELECT quantile_cont(CAST({col} AS DOUBLE), 0.25) - 1.5 * (quantile_cont(CAST({col} AS DOUBLE), 0.75)"
            f" - quantile_cont(CAST({col} AS DOUBLE), 0.25)) AS lo, quantile_cont(CAST({col} AS DOUBLE), 0.75) + 1.5 * "
            f"(quantile_cont(CAST({col} AS DOUBLE), 0.75) - quantile_cont(CAST({col} AS DOUBLE), 0.25)) AS hi FROM {src})")


@register("p6_remove_outliers_sequential", with_(
    DOC_ALL_SQL, _fence_sql("doc_all", "n_chars", "f1"),
    "s1 AS (SELECT d.* FROM doc_all d, f1 WHERE CAST(d.n_chars AS DOUBLE) BETWEEN f1.lo AND f1.hi)",
    _fence_sql("s1", "n_words", "f2"),
    "s2 AS (SELECT d.* FROM s1 d, f2 WHERE CAST(d.n_words AS DOUBLE) BETWEEN f2.lo AND f2.hi)",
    _fence_sql("s2", "n_digits", "f3"),
    "s3 AS (SELECT d.* FROM s2 d, f3 WHERE CAST(d.n_digits AS DOUBLE) BETWEEN f3.lo AND f3.hi)")
    + "SELECT doc_id, n_chars, n_words, n_digits, quality FROM s3")
def p6_remove_outliers_sequential(spark, sf):
    d = doc_all(spark, sf).select("doc_id", "n_chars", "n_words", "n_digits", "quality")
    return C.remove_outliers(d, ["n_chars", "n_words", "n_digits"], mode="sequential")


@register("p6_remove_outliers_independent", with_(
    DOC_ALL_SQL, _fence_sql("doc_all", "n_chars", "f1"), _fence_sql("doc_all", "n_words", "f2"),
    _fence_sql("doc_all", "n_digits", "f3"))
    + """SELECT doc_id, n_chars, n_words, n_digits, quality FROM doc_all d, f1, f2, f3
WHERE CAST(d.n_chars AS DOUBLE) BETWEEN f1.lo AND f1.hi AND CAST(d.n_words AS DOUBLE) BETWEEN f2.lo AND f2.hi
  AND CAST(d.n_digits AS DOUBLE) BETWEEN f3.lo AND f3.hi""")
def p6_remove_outliers_independent(spark, sf):
    d = doc_all(spark, sf).select("doc_id", "n_chars", "n_words", "n_digits", "quality")
    return C.remove_outliers(d, ["n_chars", "n_words", "n_digits"], mode="independent")


@register("p7_p11_record_checks", """
SELECT l_orderkey, l_linenumber,
  concat_ws(';', CASE WHEN l_shipdate IS NULL THEN 'missing:l_shipdate' END,
                 CASE WHEN NOT (l_quantity BETWEEN 1 AND 49) THEN 'range:l_quantity' END,
                 CASE WHEN NOT (l_discount BETWEEN 0 AND 0.09) THEN 'range:l_discount' END,
                 CASE WHEN l_discount > l_tax THEN 'cross:l_discount>l_tax' END) AS errors,
  CASE WHEN l_shipdate IS NULL OR NOT (l_quantity BETWEEN 1 AND 49) OR NOT (l_discount BETWEEN 0 AND 0.09)
            OR l_discount > l_tax THEN 'quarantine' ELSE 'accepted' END AS route
FROM lineitem""")
def p7_p11_record_checks(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                                             "l_shipdate")
    x = C.required_check(li, ["l_shipdate"])
    x = C.range_check(x, {"l_quantity": (1, 49), "l_discount": (0, 0.09)})
    x = C.cross_field_check(x, [("l_discount", "l_tax")])
    return x.select("l_orderkey", "l_linenumber", F.array_join("errors", ";").alias("errors"),
                    F.when(F.size("errors") > 0, "quarantine").otherwise("accepted").alias("route"))


@register("p10_sample_rows", f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_md5_draw_sql('o_orderkey')}, o_orderkey LIMIT 100""")
def p10_sample_rows(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return C.sample_rows(o, 100, "o_orderkey", draw=S.hash_draw("o_orderkey"))


_LANG_VALID = ", ".join(sorted(set(LANG_MAP.values())))
_LANG_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_MAP.items())


@register("j1_alias_lookup", f"""
SELECT doc_id, lang_name,
  CASE WHEN lang_name IS NULL THEN 'invalid:lang:''' || coalesce(lang, 'None') || ''' valid: [{_LANG_VALID}]' ELSE '' END
    AS errors
FROM (SELECT doc_id, lang, CASE lower(regexp_replace(lang, '^{_WS_SQL}+|{_WS_SQL}+$', '', 'g')) {_LANG_CASE} END AS lang_name
      FROM documents)""")
def j1_alias_lookup(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "lang")
    r = C.map_lookup(d, "lang", LANG_MAP, out="lang_name")
    return r.select("doc_id", "lang_name", F.array_join("errors", ";").alias("errors"))


@register("j2_outside_domain", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN "
                               "(SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def j2_outside_domain(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_name")
    return C.outside_domain(c, "c_custkey", read(spark, sf, "orders"), "o_custkey")


@register("j3_attach_labels", with_(DOC_RAW_SQL) + "SELECT doc_id, n_chars, quality FROM doc_raw")
def j3_attach_labels(spark, sf):
    return doc_raw(spark, sf).select("doc_id", "n_chars", "quality")


@register("u3_side_by_side", """
SELECT event_id, value, 'reference' AS dataset FROM events WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL SELECT event_id, value, 'current' FROM events WHERE ts >= TIMESTAMP '2024-01-16'""")
def u3_side_by_side(spark, sf):
    e = read(spark, sf, "events").select("event_id", "value", "ts")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return C.side_by_side(e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)).drop("ts")

