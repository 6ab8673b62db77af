"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a file is addressed by the SHA-256 of its content. The ledger,
a Parquet table in shared storage, has a row for each blob and scan: the rule
versions it was scanned by and what they found. A run looks its blobs up,
scans only blob and rule-version pairs that the ledger does not know, each blob once, appends
them, and joins the findings back to every path with that content. A run that is
lost and repeated finds what was appended and does not scan it again.

Rules are patterns with a version; a changed pattern needs a new version and
is then the only one that is scanned anew.

Positions: splitting at a pattern gives the gaps between its matches, and a running
sum of gaps and matches over one blob's rows gives their starts, in linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``pattern`` in Java syntax; a match counts if its group ``group`` has ``least`` characters. ``hint`` is a cheap test of
    the text and its lower-case form that holds wherever the pattern matches."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hint: tuple[str, ...] = ()
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The strict formats first, then well-known key formats.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         ("passw", "secret", "token", "api")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1, ("private key-----",), False),
    Rule("signed_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, ("eyj",), False),
    Rule("host_token", 1, r"gh[pousr]_[A-Za-z0-9]{30,}", 0, 1, ("gh",), False),
    Rule("chat_token", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, ("xox",), False),
)

LEDGER = "blob binary, rules array<string>, findings array<struct<kind:string,order:int,base:boolean,start:int,end:int>>"


def blob_of(text_col: str) -> Column:
    """Content address of a text; null counts as empty."""
    return F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256))


def _matches(rule: Rule, order: int, due: Column) -> Column:
    """Array of (order, nth, gap before the match, its length, does it count) for a rule."""
    t = F.col("t")
    hit = due & t.rlike(rule.pattern)
    if rule.hint:
        low = F.lower("t")
        near = F.lit(False)
        for h in rule.hint:
            near = near | low.contains(h)
        hit = due & near & t.rlike(rule.pattern)
    gaps, found = F.split(t, rule.pattern, -1), F.regexp_extract_all(t, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(t, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    rows = F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("found"), counted.alias("counted")), lambda x, i: F.struct(
        F.lit(order).alias("order"), i.alias("nth"), F.char_length(x["gap"]).alias("gap"), F.char_length(x["found"]).alias("length"),
        (F.char_length(x["counted"]) >= rule.least).alias("ok")))
    kept = F.filter(rows, lambda x: x["length"].isNotNull())  # the gap after the last match has none
    return F.when(hit, kept).otherwise(F.array().cast("array<struct<order:int,nth:int,gap:int,length:int,ok:boolean>>"))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, rules, findings) of ``blobs``: blob, t and due, the rule keys to scan each by."""
    every = F.concat(*[_matches(r, i, F.array_contains("due", r.key)) for i, r in enumerate(rules)])
    each = blobs.select("blob", "due", F.explode_outer(every).alias("m")).select("blob", "due", "m.*")
    upto = F.sum(F.col("gap") + F.col("length")).over(
        Window.partitionBy("blob", "order").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    names = F.array(*[F.lit(r.kind) for r in rules])
    base = F.array(*[F.lit(r.base) for r in rules])
    found = F.struct(F.get(names, F.col("order")).alias("kind"), "order", F.get(base, F.col("order")).alias("base"),
                     (F.col("upto") - F.col("length")).alias("start"), F.col("upto").alias("end"))
    return (each.withColumn("upto", upto).groupBy("blob")
            .agg(F.first("due").alias("rules"), F.collect_list(F.when(F.col("ok"), found)).alias("findings")))


def _ledger(docs: DataFrame, path: str) -> DataFrame | None:
    try:
        return docs.sparkSession.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def update_ledger(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> None:
    """Scans the blob and rule-version pairs of ``versions`` that the ledger lacks, and appends them."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    blobs = versions.select(blob_of(text_col).alias("blob"), text_or_empty(text_col).alias("t"))
    ledger = _ledger(versions, ledger_path)
    if ledger is None:
        blobs = blobs.withColumn("due", keys)
    else:
        known = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("known"))
        blobs = blobs.join(known, "blob", "left").withColumn("due", F.array_except(keys, F.coalesce("known", F.array().cast("array<string>"))))
        blobs = blobs.where(F.size("due") > 0).drop("known")
    blobs = blobs.dropDuplicates(["blob"])
    scan_blobs(blobs, rules).write.mode("append").parquet(ledger_path)


def scan_secrets(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, blob (hex) and findings, sorted by start, then the rules' order.

    Positions are code points, ends exclusive. Defined cases: a null text is the
    empty blob; rows that repeat an id or a text each get the blob's findings; an empty
    table appends nothing and gives an empty result. Other columns are ignored.
    """
    update_ledger(versions, ledger_path, rules, text_col)
    keys = F.array(*[F.lit(r.key) for r in rules])
    now = {r.kind: r.key for r in rules}
    current = F.create_map(*[F.lit(x) for kv in now.items() for x in kv])
    ledger = _ledger(versions, ledger_path)
    # of each scan, the findings by rule version; of scans that repeat a pair (two runs at once, an append done twice) one counts
    each = F.transform(F.array_intersect("rules", keys), lambda k: F.struct(
        k.alias("rule"), F.filter("findings", lambda x: F.try_element_at(current, x["kind"]) == k).alias("f")))
    mine = ledger.select("blob", each.alias("each")).groupBy("blob").agg(F.flatten(F.collect_list("each")).alias("each"))
    mine = mine.select("blob", F.flatten(F.filter(F.transform(keys, lambda k: F.get(F.filter("each", lambda x: x["rule"] == k), 0)["f"]),
                                                  lambda f: f.isNotNull())).alias("findings"))
    ordered = F.array_sort(F.transform("findings", lambda x: F.struct(
        x["start"].alias("start"), x["order"].alias("order"), x["end"].alias("end"), x["kind"].alias("kind"), x["base"].alias("base"))))
    # stored, so that the join below has plain shuffles on both sides and Spark can split the rows of a hot blob
    mine = materialize(mine.select("blob", ordered.alias("findings")), "secret-findings")
    paths = versions.select(F.col(id_col).alias("doc_id"), blob_of(text_col).alias("blob"))
    return paths.join(mine, "blob", "left").select(
        "doc_id", F.lower(F.hex("blob")).alias("blob"), "findings")


def joined(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
