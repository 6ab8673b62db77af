"""Registered queries: exact neighbours (J4) and synthetic rebalancing.

The SQL oracle computes the neighbours by brute force (all pairs inside the
minority class); that is fine for DuckDB on the check data, while the Spark
side uses the grid join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.knn import knn_exact
from ..operators.resample import smote
from .registry import register
from .tables import DOC_NUMERIC, DOC_RAW_SQL, doc_raw, with_

FEATS = DOC_NUMERIC


def _dist_sql(a: str, b: str) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in FEATS)


_MINO_SQL = "mino AS (SELECT doc_id AS id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATS) + \
            " FROM doc_raw WHERE quality = 0)"
_NN_SQL = f"""nn AS (SELECT * FROM (SELECT a.id, b.id AS nbr_id, {_dist_sql('a', 'b')} AS dist2,
             row_number() OVER (PARTITION BY a.id ORDER BY {_dist_sql('a', 'b')}, b.id) AS nbr_rank
           FROM mino a JOIN mino b ON a.id <> b.id) WHERE nbr_rank <= 5)"""


def _draw(*parts: str) -> str:
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5(concat_ws(':', {inner}, '42')), 1, 8)) AS BIGINT)"


@register("j4_knn_exact", with_(DOC_RAW_SQL, _MINO_SQL, _NN_SQL) +
          "SELECT id, CAST(nbr_rank AS INTEGER) AS nbr_rank, nbr_id, round(dist2, 6) AS dist2 FROM nn")
def j4_knn_exact(spark, sf):
    d = doc_raw(spark, sf).where(F.col("quality") == 0)
    return knn_exact(d, "doc_id", FEATS, 5)


_SMOTE_SQL = with_(DOC_RAW_SQL, _MINO_SQL, _NN_SQL) + f""",
cnt AS (SELECT (SELECT count(*) FROM doc_raw WHERE quality = 1) - (SELECT count(*) FROM mino) AS m,
               (SELECT count(*) FROM mino) AS n),
rk AS (SELECT *, row_number() OVER (ORDER BY {_draw('id')}, id) - 1 AS r FROM mino),
syn AS (SELECT rk.*, rk.r + t.j * cnt.n AS i FROM rk, cnt, range(0, 100000) t(j) WHERE rk.r + t.j * cnt.n < cnt.m),
pick AS (SELECT syn.*, 1 + ({_draw('syn.id', 'syn.i', "'n'")} % 5) AS nr,
                {_draw('syn.id', 'syn.i', "'u'")} / CAST(4294967296 AS DOUBLE) AS u FROM syn),
gen AS (SELECT -(p.i + 1) AS doc_id, 0 AS quality, """ + ", ".join(
    f"p.{c} + p.u * (b.{c} - p.{c}) AS {c}" for c in FEATS) + f""", true AS is_synthetic
        FROM pick p JOIN nn ON nn.id = p.id AND nn.nbr_rank = p.nr JOIN mino b ON b.id = nn.nbr_id)
SELECT doc_id, CAST(quality AS INTEGER) AS quality, """ + ", ".join(FEATS) + """, false AS is_synthetic FROM doc_raw
UNION ALL SELECT doc_id, CAST(quality AS INTEGER), """ + ", ".join(f"CAST(trunc({c}) AS BIGINT)" for c in FEATS) + ", is_synthetic FROM gen"


@register("m1_u1_smote", _SMOTE_SQL)  # the features are counts, so they come back as integers
def m1_u1_smote(spark, sf):
    return smote(doc_raw(spark, sf), "doc_id", "quality", FEATS, k=5, seed=42)


@register("m1_class_counts_after_smote", with_(DOC_RAW_SQL) + """
SELECT quality, max(n) OVER () AS n FROM (SELECT quality, count(*) AS n FROM doc_raw GROUP BY quality)""")
def m1_class_counts_after_smote(spark, sf):
    s = smote(doc_raw(spark, sf), "doc_id", "quality", FEATS, k=5, seed=42)
    return s.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


def smote_sql(src: str, id_col: str, label: str, feats: list[str], k: int = 5) -> str:
    """CTEs (continuing a WITH list) for the same rebalancing in DuckDB, by brute-force neighbours:
    ends with ``gen`` (synthetic rows: id, label, features, is_synthetic) for the smallest class."""
    dist = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in feats)
    return f""",
cc AS (SELECT {label} AS cls, count(*) AS n FROM {src} WHERE {label} IS NOT NULL GROUP BY {label}),
minor AS (SELECT cls, n FROM cc ORDER BY n, cls LIMIT 1),
smo AS (SELECT {id_col} AS id, {", ".join(feats)} FROM {src} WHERE {label} = (SELECT cls FROM minor)),
snn AS (SELECT * FROM (SELECT a.id, b.id AS nbr_id,
             row_number() OVER (PARTITION BY a.id ORDER BY {dist}, b.id) AS nbr_rank
           FROM smo a JOIN smo b ON a.id <> b.id) WHERE nbr_rank <= {k}),
scnt AS (SELECT (SELECT max(n) FROM cc) - (SELECT n FROM minor) AS m, (SELECT n FROM minor) AS n),
srk AS (SELECT *, row_number() OVER (ORDER BY {_draw('id')}, id) - 1 AS r FROM smo),
ssyn AS (SELECT srk.*, srk.r + t.j * scnt.n AS i FROM srk, scnt, range(0, 100000) t(j) WHERE srk.r + t.j * scnt.n < scnt.m),
spick AS (SELECT ssyn.*, 1 + ({_draw('ssyn.id', 'ssyn.i', "'n'")} % least({k}, (SELECT n FROM minor) - 1)) AS nr,
                 {_draw('ssyn.id', 'ssyn.i', "'u'")} / CAST(4294967296 AS DOUBLE) AS u FROM ssyn),
gen AS (SELECT -(p.i + 1) AS {id_col}, (SELECT cls FROM minor) AS {label}, """ + ", ".join(
        f"p.{c} + p.u * (b.{c} - p.{c}) AS {c}" for c in feats) + f""", true AS is_synthetic
        FROM spick p JOIN snn ON snn.id = p.id AND snn.nbr_rank = p.nr JOIN smo b ON b.id = snn.nbr_id)"""
