"""Registered queries: tables that grow while they are read (S4, ST1, ST2, D5, L5 across jobs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import summaries as SU
from ..session import materialize, scratch_path
from ..sources import io as IO
from ..sources import publish as PB
from ..spec import TrainSpec
from ..streaming import events as EV
from ..streaming import scoring as STR
from . import pipelines as PL
from . import stages as ST
from .q_pipeline import DOC_TRAIN, FIXED_SCORING, _l3_sql, _scored_sql, fixed_model, raw_scoring_input
from .registry import register
from .tables import DOC_NUMERIC, doc_raw, read

CUT = "2024-01-16 00:00:00"

_COUNTS_SQL = f"""WITH early AS (SELECT * FROM events WHERE ts < TIMESTAMP '{CUT}' AND event_id % 11 <> 5),
mark AS (SELECT epoch_ms(max(ts)) - 3 * 86400000 AS ms FROM early),
kept AS (SELECT * FROM early
         UNION ALL SELECT events.* FROM events, mark WHERE ts < TIMESTAMP '{CUT}' AND event_id % 11 = 5 AND epoch_us(ts) > ms * 1000
         UNION ALL SELECT * FROM events WHERE ts >= TIMESTAMP '{CUT}')
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(max(value), 6) AS top_value FROM kept GROUP BY ALL"""


@register("st1_event_counts", _COUNTS_SQL)
def st1_event_counts(spark, sf):
    """Counts by day of a stream in two starts. The second one brings new days, every early event once more (repeats), and
    late events: those of the watermark's three days count, older ones do not."""
    e = read(spark, sf, "events")
    inbox, path = scratch_path(spark, "events-inbox"), scratch_path(spark, "event-counts")
    early = e.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    late = F.col("event_id") % 11 == 5
    for arriving in (early.where(~late), e.unionByName(early.where(~late))):
        arriving.write.mode("append").parquet(inbox)
        counts = EV.run_day_counts(spark, inbox, e.schema, path, "event_id", "ts", ["event_type"], "3 days", {"top_value": F.max("value")})
    return counts


_JS_SQL = """cs AS (SELECT "column", a / sum(a) OVER (PARTITION BY "column") AS p, b / sum(b) OVER (PARTITION BY "column") AS q,
              sum(a) OVER (PARTITION BY "column") AS na, sum(b) OVER (PARTITION BY "column") AS nb FROM cg),
js AS (SELECT "column", max(na) AS na, max(nb) AS nb, sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                                       + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END))) AS js FROM cs GROUP BY "column")"""

_KS_SQL = """g AS (SELECT "column", v, sum(a) AS a, sum(b) AS b FROM lng GROUP BY "column", v),
c AS (SELECT "column", sum(a) OVER w / sum(a) OVER (PARTITION BY "column") AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY "column") AS fb,
             sum(a) OVER (PARTITION BY "column") AS na, sum(b) OVER (PARTITION BY "column") AS nb
      FROM g WINDOW w AS (PARTITION BY "column" ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT "column", max(na) AS na, max(nb) AS nb, max(abs(fa - fb)) AS ks FROM c GROUP BY "column"),
sd AS (SELECT "column", stddev_pop(v) AS s FROM lng WHERE a = 1 GROUP BY "column")"""

_DRIFT_SQL = """SELECT ks."column", 'numeric' AS kind, CAST(na AS BIGINT) AS n_ref, CAST(nb AS BIGINT) AS n_cur, round(ks, 6) AS statistic,
       round(s, 6) AS ref_std, true AS within_bound FROM ks JOIN sd ON ks."column" = sd."column"
UNION ALL SELECT "column", 'categorical', CAST(na AS BIGINT), CAST(nb AS BIGINT), round(js, 6), NULL, true FROM js"""


def _against_rows(ref_summary, cur_summary, ref_rows, cur_rows, numeric):
    """Drift by summaries, its KS held against that of the rows, which is the one returned."""
    exact = D.numeric_drift_stats(ref_rows, cur_rows, numeric).select("column", F.col("ks_stat").alias("exact"))
    num = SU.numeric_drift(ref_summary, cur_summary).join(exact, "column")
    num = num.select("column", F.lit("numeric").alias("kind"), "n_ref", "n_cur", F.col("exact").alias("statistic"), "ref_std",
                     (F.abs(F.col("ks_stat") - F.col("exact")) <= F.col("ks_error")).alias("within_bound"))
    cat = SU.category_drift(ref_summary, cur_summary)
    return num.unionByName(cat.select("column", F.lit("categorical").alias("kind"), "n_ref", "n_cur", F.col("js_distance").alias("statistic"),
                                      F.lit(None).cast("double").alias("ref_std"), F.lit(True).alias("within_bound")))


def _long_sql(numeric: list[str], categorical: list[str]) -> str:
    num = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v, a, b FROM sets WHERE {c} IS NOT NULL" for c in numeric)
    cat = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, sum(a) AS a, sum(b) AS b FROM sets "
                             f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in categorical)
    return f"lng AS ({num}),\ncg AS ({cat}),\n" + _KS_SQL + ",\n" + _JS_SQL + "\n"


_LIVE_CATS = ["lang", "source", "prediction"]


@register("st2_live_drift", _scored_sql() + """,
sets AS (SELECT *, CAST(doc_id % 2 = 0 AS INTEGER) AS a, CAST(doc_id % 2 = 1 AS INTEGER) AS b FROM scored),
""" + _long_sql(DOC_NUMERIC, _LIVE_CATS) + _DRIFT_SQL)
def st2_live_drift(spark, sf):
    """Drift of a filled live table: a stream scores one half of the records in two starts and stores a summary of each
    batch; the monitoring run merges these with the summary of a reference batch and rereads no prediction."""
    src, model = raw_scoring_input(spark, sf), fixed_model(spark)
    inbox, predictions, summaries = (scratch_path(spark, x) for x in ("live-inbox", "live-predictions", "live-summaries"))
    for part in (1, 3):
        src.where(F.col("doc_id") % 4 == part).write.mode("append").parquet(inbox)
        live, _ = STR.run_scoring_stream(spark, inbox, src.schema, model, FIXED_SCORING, "fixed", predictions, scratch_path(spark, "live-quarantine"),
                                         summary_path=summaries, summary_columns=(DOC_NUMERIC, _LIVE_CATS))
    reference = materialize(PL.score_batch(src.where(F.col("doc_id") % 2 == 0), model, FIXED_SCORING, "fixed")[0], "live-reference")
    stored = materialize(SU.summarize(reference, [], DOC_NUMERIC, _LIVE_CATS), "reference-summary")
    return _against_rows(stored, STR.read_days(spark, summaries), reference, live, DOC_NUMERIC)


@register("d5_day_summaries", f"""WITH sets AS (SELECT *, CAST(ts < TIMESTAMP '{CUT}' AS INTEGER) AS a, CAST(ts >= TIMESTAMP '{CUT}' AS INTEGER) AS b FROM events),
""" + _long_sql(["value", "user_id"], ["event_type"]) + _DRIFT_SQL)
def d5_day_summaries(spark, sf):
    """Drift between two ranges of days from the summaries of their days."""
    e = read(spark, sf, "events")
    days = materialize(SU.summarize(e.withColumn("day", F.to_date("ts")), ["day"], ["value", "user_id"], ["event_type"]), "day-summaries")
    before = F.col("day") < F.lit(CUT[:10]).cast("date")
    return _against_rows(days.where(before), days.where(~before), *D.split_by_time(e, "ts", CUT), ["value", "user_id"])


@register("s4_publish_rerun", "SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS run FROM orders")
def s4_publish_rerun(spark, sf):
    """Orders published by a run for each half of the keys; the second run first publishes the wrong half, then runs again,
    and a writer that died has left rows that no version names."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").cast("bigint").alias("run"))
    table, half = scratch_path(spark, "published"), F.col("o_orderkey") % 2
    PB.publish(o.where(half == 0), table, "even")
    PB.publish(o.where(half == 0), table, "odd")
    o.write.parquet(f"{table}/data/died")
    PB.publish(o.where(half == 1), table, "odd")
    return PB.read_published(spark, table)


@register("l5_stage_handover", _l3_sql())
def l5_stage_handover(spark, sf):
    """The transformed table as a job sees it that took over from two others: one ingested, one transformed."""
    spec = TrainSpec(**{**DOC_TRAIN.__dict__, "resample_after_split": False})
    base, store = sf.rstrip("/"), scratch_path(spark, "stage-store")
    version = IO.input_version(spark, f"{base}/documents.parquet", f"{base}/labels.parquet")

    def none():
        raise RuntimeError("the input is read again")

    ST.run_stages(spark, lambda: doc_raw(spark, sf), spec, store, version, ["ingest"])
    ST.run_stages(spark, none, spec, store, version, ["transform"])
    return ST.run_stages(spark, none, spec, store, version, [])[0].prep.table
