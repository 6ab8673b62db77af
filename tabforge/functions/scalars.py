"""Scalar column functions (F1-F13) and the repeatable hash draw.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The white space that ``str.strip`` removes (Unicode, with the four ASCII separators).
STRIP_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")
# a number: optional sign, digits with optional fraction (or fraction only), optional exponent;
# single underscores between digits are allowed
_D = "[0-9](_?[0-9])*"
_NUMBER_RE = f"^[+-]?(({_D}(\\.({_D})?)?)|(\\.{_D}))([eE][+-]?{_D})?$"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """remove leading and trailing white space of every kind (Spark's plain ``trim`` only strips spaces)."""
    return F.btrim(_c(c), F.lit(STRIP_CHARS))


def strip_string_columns(df: DataFrame) -> DataFrame:
    """F1 on every string column, other columns untouched, order kept."""
    return df.select(*[
        strip_ws(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def lookup_key(c: str | Column) -> Column:
    """``str(v).strip().lower()`` as a lookup key."""
    return F.lower(strip_ws(_c(c).cast("string")))


def parse_number(c: str | Column) -> Column:
    """text to double; null when the text is not a plain number.

    A regex guard runs first: Spark would accept '45d' (Java float suffix) and
    raise on bad casts under ANSI mode.
    """
    s = strip_ws(_c(c).cast("string"))
    return F.when(s.rlike(_NUMBER_RE), F.translate(s, "_", "").try_cast("double"))


def safe_log1p(c: str | Column) -> Column:
    """ln(1 + x), null for x <= -1 (and for null)."""
    x = _c(c).cast("double")
    return F.when(x > -1, F.log1p(x))


def map_values(c: str | Column, mapping: dict) -> Column:
    """map a value through a small literal dict; unknown -> null."""
    if not mapping:
        return F.lit(None)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[_c(c)]


def percent_text(p: str | Column) -> Column:
    """probability in [0,1] -> text like '93.1%'."""
    return F.concat(F.round(_c(p) * 100.0, 2).cast("string"), F.lit("%"))


def parse_percent(c: str | Column) -> Column:
    """F9 inverse: '93.1%' -> 93.1."""
    return F.regexp_extract(_c(c), "(-?[0-9]+(\\.[0-9]+)?)", 1).try_cast("double")


def hash_draw(*parts: str | Column, seed: int = 42) -> Column:
    """Repeatable 32-bit draw from the md5 of ``'p1:p2:...:seed'``.

    Independent of partitioning and task retries (unlike ``rand()``). The same
    value is computable in DuckDB, which makes split and resample results
    checkable by SQL.
    """
    key = F.concat_ws(":", *[_c(p).cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


# --- text features (whole texts, JVM string functions) --------------------
# Counting by length differences avoids materialising an array of matches per
# text (``regexp_count`` is ``size(regexp_extract_all(..))`` in Spark).

WORD_RE = "[^ \\t\\n\\r\\f]+"
_SPACE_RE = "[ \\t\\n\\r\\f]+"


def word_count(c: str | Column) -> Column:
    """Maximal runs of characters other than space, tab, newline, CR, form feed."""
    one_per_word = F.regexp_replace(F.regexp_replace(_c(c), WORD_RE, "w"), _SPACE_RE, "")
    return F.length(one_per_word).cast("bigint")


def line_count(c: str | Column) -> Column:
    """Newline characters + 1."""
    return (F.length(_c(c)) - F.length(F.replace(_c(c), F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def digit_count(c: str | Column) -> Column:
    return (F.length(_c(c)) - F.length(F.regexp_replace(_c(c), "[0-9]", ""))).cast("bigint")


def pearson(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation as an aggregate over the rows where both values are present
    (like ``corr`` and pandas). A column without spread gives null (NaN in pandas) instead of
    the division-by-zero error that ``corr`` raises under ANSI mode."""
    x, y = _c(a).cast("double"), _c(b).cast("double")
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def as_number(c: str | Column) -> Column:
    """The value as a double with NaN read as missing (pandas and numpy-style statistics skip
    NaN, while Spark orders NaN above every number)."""
    x = _c(c).try_cast("double")
    return F.when(~F.isnan(x), x)
