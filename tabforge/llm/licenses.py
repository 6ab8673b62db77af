"""License scans by ordered signature rules, in DataFrame functions only.

A text becomes its words, each between spaces of its own. A rule is a regular
expression over these words with a label, a tier (its priority) and keywords: words that
every match holds. The keyword prefilter intersects a text's words with the keywords of all rules once;
rules are looked up by one of their keywords, the anchor, and only those whose keywords are all there run their expression.

Detections are intervals of words. One is suppressed if it lies within another of a higher tier,
or of its own tier that is longer or, at the same interval, of an earlier rule. Tiers and the order
of rules make this a strict order, so it does not matter in which order pairs are looked at: running
maxima of interval ends over a text's detections decide it in one sort.

Texts stay where they are scanned; only detections of texts that have two or more are shuffled.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The one character beyond ASCII whose lower case is an ASCII letter.
KELVIN = "\u212a"

#: Tiers, and how sure a detection of each is that the text carries the license.
MENTION, NAME, NOTICE, TEXT = 1, 2, 3, 4
SURE = {MENTION: .5, NAME: .7, NOTICE: .9, TEXT: 1.0}

# The phrases that are always reported.
PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

# License families: label, names as words, short names, versions.
FAMILIES = (
    ("afl", ("academic free",), (), ("1 1", "1 2", "2", "2 1", "3")),
    ("agpl", ("gnu affero general public", "affero general public", "gnu agpl"), ("agpl",), ("1", "3")),
    ("apache", ("apache", "apache software"), (), ("1", "1 1", "2")),
    ("apsl", ("apple public source",), ("apsl",), ("1", "1 1", "1 2", "2")),
    ("artistic", ("artistic", "perl artistic"), (), ("1", "2")),
    ("beerware", ("beerware", "beer ware"), (), ()),
    ("blueoak", ("blue oak model",), (), ("1",)),
    ("bsd", ("bsd", "berkeley software distribution"), (), ()),
    ("bsd-0-clause", ("zero clause bsd", "bsd zero clause", "0 clause bsd", "bsd 0 clause"), ("0bsd",), ()),
    ("bsd-2-clause", ("bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd", "two clause bsd"), (), ()),
    ("bsd-3-clause", ("bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd", "three clause bsd"), (), ()),
    ("bsd-4-clause", ("bsd 4 clause", "4 clause bsd", "original bsd", "four clause bsd"), (), ()),
    ("bsl", ("boost software", "boost"), (), ("1",)),
    ("busl", ("business source",), ("busl",), ("1 1",)),
    ("cddl", ("common development and distribution",), ("cddl",), ("1", "1 1")),
    ("cecill", ("cecill", "cea cnrs inria"), ("cecill",), ("1", "2", "2 1")),
    ("cpal", ("common public attribution",), ("cpal",), ("1",)),
    ("cpl", ("common public",), (), ("1",)),
    ("ecl", ("educational community",), (), ("1", "2")),
    ("elastic", ("elastic",), (), ("2",)),
    ("epl", ("eclipse public",), ("epl",), ("1", "2")),
    ("eupl", ("european union public", "european union public licence eupl"), ("eupl",), ("1", "1 1", "1 2")),
    ("fdl", ("gnu free documentation", "free documentation"), ("gfdl",), ("1 1", "1 2", "1 3")),
    ("gpl", ("gnu general public", "general public", "gnu gpl", "gnu public"), ("gpl",), ("1", "2", "3")),
    ("hpnd", ("historical permission notice and disclaimer",), (), ()),
    ("ijg", ("independent jpeg group",), (), ()),
    ("ipl", ("ibm public",), (), ("1",)),
    ("isc", ("isc", "internet systems consortium"), (), ()),
    ("lgpl", ("gnu lesser general public", "gnu library general public", "lesser general public", "gnu lgpl"), ("lgpl",), ("2", "2 1", "3")),
    ("llama-community", ("llama( [0-9]+)* community",), (), ()),
    ("lppl", ("latex project public",), ("lppl",), ("1", "1 3")),
    ("mit", ("mit", "x11", "expat"), (), ()),
    ("mit-0", ("mit no attribution",), (), ()),
    ("mpl", ("mozilla public",), ("mpl",), ("1", "1 1", "2")),
    ("ms-pl", ("microsoft public",), (), ()),
    ("ms-rl", ("microsoft reciprocal",), (), ()),
    ("mulan-psl", ("mulan permissive software",), (), ("1", "2")),
    ("ncsa", ("university of illinois ncsa open source", "ncsa open source"), (), ()),
    ("odbl", ("open database", "open data commons open database"), ("odbl",), ("1",)),
    ("ofl", ("sil open font", "open font"), ("ofl",), ("1", "1 1")),
    ("ogl", ("open government",), (), ("1", "2", "3")),
    ("openssl", ("openssl",), (), ()),
    ("osl", ("open software",), (), ("1", "2", "2 1", "3")),
    ("pddl", ("public domain dedication and", "open data commons public domain dedication and"), ("pddl",), ("1",)),
    ("php", ("php",), (), ("3", "3 1")),
    ("postgresql", ("postgresql",), (), ()),
    ("python", ("python software foundation", "python"), (), ("2",)),
    ("qpl", ("q public",), (), ("1",)),
    ("rail", ("open rail", "responsible ai", "bigscience rail", "bigscience open rail m", "creativeml open rail m"), ("openrail",), ()),
    ("ruby", ("ruby",), (), ()),
    ("sspl", ("server side public",), ("sspl",), ("1",)),
    ("unlicense", ("unlicense", "the unlicense"), (), ()),
    ("upl", ("universal permissive",), (), ("1",)),
    ("vim", ("vim",), (), ()),
    ("w3c", ("w3c software", "w3c software notice and"), (), ()),
    ("wtfpl", ("do what the fuck you want to public",), ("wtfpl",), ("2",)),
    ("zlib", ("zlib", "zlib libpng"), (), ()),
    ("zpl", ("zope public",), ("zpl",), ("1 1", "2", "2 1")),
)

# Parts of the share licenses, in short and in full, and their versions.
SHARE = (("by", "attribution"), ("by-nc", "attribution non ?commercial"), ("by-nc-nd", "attribution non ?commercial no ?deriv(ative)?s"),
         ("by-nc-sa", "attribution non ?commercial share ?alike"), ("by-nd", "attribution no ?deriv(ative)?s"),
         ("by-sa", "attribution share ?alike"))
SHARE_VERSIONS = ("1", "2", "2 5", "3", "4")

# Passages of the licenses' own texts and usual notices: label, expression over words, keywords.
PASSAGES = (
    ("afl", "licensed under the academic free license", "academic"),
    ("agpl", "under the terms of the gnu affero general public license", "affero"),
    ("apache-2", "unless required by applicable law or agreed to in writing( [^ ]+){1,4} distributed under the license", "unless applicable"),
    ("apache-2", "apache org licenses license 2 0", "apache licenses"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", "intent package"),
    ("beerware", "you can buy me a beer in return", "beer"),
    ("bsd", "redistribution and use in source and binary forms with or without modification( are)? permitted", "redistribution binary"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions"),
    ("bsd-2-clause", "opensource org licenses bsd 2 clause", "opensource bsd"),
    ("bsd-3-clause", "opensource org licenses bsd 3 clause", "opensource bsd"),
    ("bsd-3-clause", "neither the name( [^ ]+){1,16} nor the names of( [^ ]+){1,3} contributors", "neither contributors"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising"),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy", "hereby organization"),
    ("cc0", "to the extent possible under law( [^ ]+){1,16} waived all copyright", "extent waived"),
    ("cc0-1", "creativecommons org publicdomain zero 1 0", "publicdomain"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "contents distribution"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse"),
    ("gpl", "this( [^ ]+){1,3} is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general"),
    ("gpl", "you should have received a copy of the gnu general public license", "gnu general"),
    ("gpl-2", "gnu org licenses (old licenses )?gpl 2 0", "gnu gpl"),
    ("gpl-3", "gnu org licenses gpl 3 0", "gnu gpl"),
    ("isc", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted", "hereby fee"),
    ("lgpl", "under the terms of the gnu (lesser|library) general public license", "gnu general"),
    ("lgpl", "you should have received a copy of the gnu (lesser|library) general public license", "gnu general"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby obtaining"),
    ("mit", "the above copyright notice and this permission notice( [^ ]+){0,5} shall be included in all copies", "permission copies"),
    ("mit", "opensource org licenses mit", "opensource mit"),
    ("mpl-1-1", "subject to the mozilla public license version 1 1", "mozilla"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("ofl-1-1", "this font software is licensed under the sil open font license", "font sil"),
    ("ofl", "scripts sil org ofl", "sil ofl"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee", "documentation fee"),
    ("proprietary", "all rights reserved", "rights reserved"),
    ("proprietary", "unauthorized copying of this (file|document|software)", "unauthorized"),
    ("proprietary", "confidential and proprietary", "confidential proprietary"),
    ("public-domain", "(placed|released|dedicated) (in|into|to) the public domain", "public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", "you just do what the fuck you want to", "fuck"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", "damages arising"),
)

_UNDER = "(licen[cs]ed|released|distributed|available|published|provided|covered|issued|offered) under (the )?(terms (and conditions )?of (the )?)?"
_LICENSE = "(software )?(public )?licen[cs]es?"


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs over a text's words, each between two spaces of its own; every word in ``keywords`` is in each match."""

    label: str
    tier: int
    pattern: str
    keywords: tuple[str, ...]
    base: bool = False


def rule(label: str, tier: int, words: str, keywords: str, base: bool = False) -> Rule:
    """A rule of an expression that is written with one space between words."""
    return Rule(label, tier, " (?:" + words.replace(" ", "  ") + ") ", tuple(dict.fromkeys(keywords.split())), base)


def _plain(words: str) -> str:
    """The words of an expression that stand in it as they are."""
    return " ".join(w for w in words.split() if w.isalnum())


def _version(v: str) -> str:
    major = v.split(" ")[0]
    rest = v[len(major):]
    return f"(version |ver |v )?v?{major}{rest}" + ("" if rest else "( 0)?")


@cache
def signature_rules() -> tuple[Rule, ...]:
    """The phrases, then the rules of every family and version in the forms notice, name and mention, then passages."""
    out = [rule(label, NOTICE, words, words, True) for label, words in PHRASES]
    for family, names, shorts, versions in FAMILIES:
        spelled = family.replace("-", " ")
        for v in (None, *versions):
            label = family if v is None else f"{family}-{v.replace(' ', '-')}"
            number, digit = ("", "") if v is None else (f" {_version(v)}", "")
            out.append(rule(label, TEXT, f"spdx licen[cs]e identifier {spelled}{number}( only| or later)?", f"spdx identifier {_plain(spelled)} {digit}"))
            for name in names:
                known = _plain(name)
                out.append(rule(label, NOTICE, f"{_UNDER}{name} {_LICENSE}( agreement)?{number}", f"under {known}"))
                out.append(rule(label, NAME, f"{name} {_LICENSE}( agreement)?{number}", known))
            for short in shorts:
                out.append(rule(label, NOTICE, f"{_UNDER}{short}( licen[cs]e)?{number}", f"under {short}"))
                if v is not None:
                    tight = v.replace(" ", "")
                    out.append(rule(label, MENTION, f"{short}{number}", short))
                    out.append(rule(label, MENTION, f"{short}v?{tight}", f"{short}v{tight}"))
    for part, full in SHARE:
        words = part.replace("-", " ")
        for v in (None, *SHARE_VERSIONS):
            label = f"cc-{part}" if v is None else f"cc-{part}-{v.replace(' ', '-')}"
            number = "" if v is None else f" {_version(v)}"
            out += [rule(label, NOTICE, f"{_UNDER}(a )?cc {words}{number}", f"under cc {words}"),
                    rule(label, NOTICE, f"{_UNDER}(a )?creative commons {full}( international)?( licen[cs]e)?{number}", "under creative commons attribution"),
                    rule(label, NAME, f"creative commons {full}( international)?( licen[cs]e)?{number}", "creative commons attribution"),
                    rule(label, MENTION, f"cc {words}{number}", f"cc {words}")]
            if v is not None:
                out.append(rule(label, TEXT, f"creativecommons org licenses {words} {v}( 0)?", f"creativecommons licenses {words}"))
    out += [rule("cc0-1", NAME, "(creative commons|cc) (zero|0)( licen[cs]e)? (v|version )?1( 0)?", "1"), rule("cc0", MENTION, "cc0", "cc0"),
            rule("cc0-1", NAME, "cc0 (v|version )?1( 0)?", "cc0")]
    out += [rule(label, TEXT, words, keywords) for label, words, keywords in PASSAGES]
    return tuple(out)


# Keywords that are too common to look rules up by, where a rule has another.
COMMON = frozenset("a and any by free general in of open public software source the to under use with".split())
_RULES = "map<string,array<struct<no:int,label:string,tier:int,pattern:string,keywords:array<string>,base:boolean>>>"


def anchor(r: Rule) -> str:
    return max(r.keywords, key=lambda k: (k not in COMMON, len(k)))


def _literal(rules: tuple[Rule, ...]) -> Column:
    """The rules by anchor as a constant: read from JSON when the plan is made, not for each row."""
    by: dict[str, list] = {}
    for i, r in enumerate(rules):
        by.setdefault(anchor(r), []).append({"no": i, **asdict(r)})
    return F.from_json(F.lit(json.dumps(by)), _RULES)


def words_of(text: Column) -> Column:
    """The words of a text in lower case. Words with letters beyond ASCII are in no rule, so only ASCII letters
    matter; the Kelvin sign is kept apart from k."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit(KELVIN), F.lit("\u00e5"))), SEPARATORS), "")


def _places(padded: Column, r: Column) -> Column:
    """(no, label, tier, base, start, end) of each match of a rule: markers around the matches become items among the words."""
    marked = F.regexp_replace(padded, r["pattern"], F.lit("\u0001$0\u0002"))
    items = F.split(F.concat(F.lit(" "), F.replace(F.replace(marked, F.lit("\u0001"), F.lit(" \u0001 ")), F.lit("\u0002"), F.lit(" \u0002 "))), " +")
    marks = F.filter(F.transform(items, lambda w, i: F.when(w.isin("\u0001", "\u0002"), i)), lambda i: i.isNotNull())
    # the first item is empty; before the k-th pair stand 2 k marks
    pairs = lambda ms: F.filter(F.transform(ms, lambda at, m: F.struct(at.alias("at"), m.alias("m"), F.get(ms, m + 1).alias("to"))),
                                lambda x: x["m"] % 2 == 0)
    # the marks as a variable: an expression would run again for each of them
    return F.transform(F.flatten(F.transform(F.array(marks), pairs)), lambda x: F.struct(
        r["no"].alias("no"), r["label"].alias("label"), r["tier"].alias("tier"), r["base"].alias("base"),
        (x["at"] - 1 - x["m"]).alias("start"), (x["to"] - 2 - x["m"]).alias("end")))


def detect(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, found): all matches of all rules, nothing suppressed."""
    keys = sorted({k for r in rules for k in r.keywords})
    rows = docs.select(F.struct(F.col(id_col).alias("id")).alias("row"), words_of(text_or_empty(text_col)).alias("words"))
    rows = rows.select("row", F.size("words").cast("long").alias("n_words"), "words",
                       F.array_intersect("words", F.array(*[F.lit(k) for k in keys])).alias("present"))
    anchors = F.array(*[F.lit(k) for k in sorted({anchor(r) for r in rules})])
    looked_up = F.flatten(F.transform(F.array_intersect("present", anchors), lambda k: F.element_at(_literal(rules), k)))
    rows = rows.withColumn("due", F.filter(looked_up, lambda r: F.size(F.array_except(r["keywords"], F.col("present"))) == 0))
    rows = rows.withColumn("padded", F.when(F.size("due") > 0, F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))))
    hits = F.filter("due", lambda r: F.rlike(F.col("padded"), r["pattern"]))
    found = F.flatten(F.transform(hits, lambda r: _places(F.col("padded"), r)))
    none = F.array().cast("array<struct<no:int,label:string,tier:int,base:boolean,start:int,end:int>>")
    return rows.select("row", "n_words", F.coalesce(found, none).alias("found"))


def suppress(found: DataFrame) -> DataFrame:
    """``found``: (uid, no, label, tier, base, start, end) of many texts; adds kept."""
    order = [F.col("start"), F.col("end").desc(), F.col("no")]
    tiers = sorted(SURE)
    over = Window.partitionBy("uid").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = Window.partitionBy("uid", "tier").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    higher = F.lit(None).cast("int")
    for t in reversed(tiers[:-1]):
        higher = F.when(F.col("tier") == t, F.max(F.when(F.col("tier") > t, F.col("end"))).over(over)).otherwise(higher)
    kept = ~(F.coalesce(higher >= F.col("end"), F.lit(False)) | F.coalesce(F.max("end").over(own) >= F.col("end"), F.lit(False)))
    return found.withColumn("kept", kept)


def scan_licenses(docs: DataFrame, rules: tuple[Rule, ...] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id (named as ``id_col``), n_words, findings (label, rule number, tier, base, start, end
    in words, kept), sorted by start, longest first.

    Defined cases: a null or empty text has no words and no findings; rows that repeat an id
    or a text are rows of their own; an empty table gives an empty result. Texts of any length are scanned whole.
    Other columns are ignored.
    """
    rules = signature_rules() if rules is None else rules
    each = materialize(detect(docs, rules, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "licenses")
    shape = lambda kept: F.struct("start", F.col("end"), "no", "label", "tier", "base", kept.alias("kept"))
    few, many = each.where(F.size("found") < 2), each.where(F.size("found") > 1)
    single = few.select("row", "n_words", F.transform("found", lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["no"].alias("no"), x["label"].alias("label"), x["tier"].alias("tier"),
        x["base"].alias("base"), F.lit(True).alias("kept"))).alias("findings"))
    apart = suppress(many.select("uid", "row", "n_words", F.explode("found").alias("f")).select("uid", "row", "n_words", "f.*"))
    together = apart.groupBy("uid").agg(F.first("row").alias("row"), F.first("n_words").alias("n_words"),
                                        F.collect_list(shape(F.col("kept"))).alias("findings"))
    in_order = F.array_sort("findings", lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).when(
        a["end"] != b["end"], b["end"] - a["end"]).otherwise(a["no"] - b["no"]))
    both = single.unionAll(together.select("row", "n_words", in_order))
    return both.select(F.col("row.id").alias(id_col), "n_words", "findings")


def labels_of(findings: Column) -> Column:
    """Distinct labels, sorted, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(findings, lambda x: x["label"]))), ",")


def certainty(findings: Column) -> Column:
    """0 to 1: of the surest finding that is kept."""
    sure = F.lit(0.0)
    for tier, s in SURE.items():
        sure = F.when(F.exists(findings, lambda x: x["kept"] & (x["tier"] == tier)), F.lit(s)).otherwise(sure)  # noqa: B023
    return sure
