"""Scalar column functions (F1-F17): text cleaning, number and date parsing.

All are built-in Spark expressions (JVM side, whole-stage codegen); nothing
here is a Python UDF. ANSI mode is on in Spark 4, so parsing uses
``try_cast`` / ``try_to_date`` / ``get`` and yields NULL instead of failing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for right results) ----------
# Label prefixes removed from every string column of a formatted ad table.
LABEL_TOKENS = ["Istabas:>", "Platiba:>", "Stavs:>", "/lifts", "Iela:><b>", "Price:>", "Date:>"]
# Street abbreviations and their full forms (matched case-insensitively).
STREET_ABBREVIATIONS = [("pr.", "prospekts"), ("iel.", "iela"), ("blv.", "bulvāris"), ("šos.", "šoseja")]
# Source date format, stored date format, month key format.
SOURCE_DATE_FORMAT = "dd.MM.yyyy"
STORED_DATE_FORMAT = "yyyy.MM.dd"
MONTH_KEY_FORMAT = "MM.yyyy"
# Lift marker inside the floor value ("3/9/lifts").
LIFT_MARKER = "/lifts"
# -------------------------------------------------------------------------

_REGEX_SPECIAL = set("\\^$.|?*+()[]{}")


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in s)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_tokens(c, tokens=LABEL_TOKENS) -> Column:
    """remove all label tokens from a string column. Literal replaces
    (no regex); the tokens cannot combine into new ones in the known format,
    so one pass per token equals the reference's repeated regex replaces."""
    out = col_(c)
    for t in tokens:
        out = F.replace(out, F.lit(t), F.lit(""))
    return out


def strip_tokens_all(df, tokens=LABEL_TOKENS):
    """F1 over every string column of a DataFrame (one projection)."""
    from pyspark.sql.types import StringType
    return df.select([strip_tokens(f.name, tokens).alias(f.name)
                      if isinstance(f.dataType, StringType) else F.col(f.name)
                      for f in df.schema.fields])


def _digits_only(c: Column) -> Column:
    # normal and non-breaking spaces are thousands separators
    return F.regexp_replace(c, "[ \u00a0\u202f]", "")


def parse_size(c) -> Column:
    """F2: '50 m²' -> 50.00 (text before the first space)."""
    first = F.split_part(F.trim(col_(c)), F.lit(" "), F.lit(1))
    return first.try_cast("decimal(10,2)")


def parse_price_total(c) -> Column:
    """'1 200 000 € (…)' -> 1200000; NULL when there is no number."""
    num = F.regexp_extract(col_(c), "^\\s*([0-9][0-9 \u00a0\u202f]*)€", 1)
    return F.nullif(_digits_only(num), F.lit("")).try_cast("bigint")


def parse_price_per_sqm(c) -> Column:
    """'(1 216.67 €/m²)' -> 1216.67; NULL when the bracket is missing."""
    num = F.regexp_extract(col_(c), "\\(\\s*([0-9][0-9 .\u00a0\u202f]*)€", 1)
    return F.nullif(_digits_only(num), F.lit("")).try_cast("decimal(10,2)")


def normalise_street(c, mode: str = "literal") -> Column:
    """trim, then expand the four street abbreviations, case-insensitive,
    with Unicode word boundaries.

    ``literal`` keeps the reference's rule: the abbreviation must be followed
    by a word character (``pr.4`` -> ``prospekts4``, ``pr. 4`` unchanged).
    ``expand`` also expands ``pr. 4`` -> ``prospekts 4``.
    """
    out = F.trim(col_(c))
    for abbr, full in STREET_ABBREVIATIONS:
        if mode == "literal":
            out = F.regexp_replace(out, r"(?iU)\b" + _quote(abbr) + r"\b", full)
        elif mode == "expand":
            out = F.regexp_replace(out, r"(?iU)\b" + _quote(abbr) + r"\s*", full + " ")
        else:
            raise ValueError(f"unknown mode {mode!r}")
    return F.trim(out) if mode == "expand" else out


def url_hash(c) -> Column:
    """last path segment without extension; NULL when the URL has fewer
    than nine slashes."""
    tail = F.get(F.split(col_(c), "/", 10), 9)
    return F.nullif(F.split_part(tail, F.lit("."), F.lit(1)), F.lit(""))


def url_path_part(c, index: int) -> Column:
    """Path segment by position (0-based over split('/')), e.g. 7 = city."""
    return F.get(F.split(col_(c), "/"), index)


def _to_int_rounded(c: Column) -> Column:
    # '1.00' -> 1; values are rounded like an INTEGER column assignment
    return F.round(c.try_cast("double")).try_cast("int")


def apt_floor(c) -> Column:
    """'3/9' -> 3 (also '1.00/3' -> 1)."""
    return _to_int_rounded(F.split_part(col_(c), F.lit("/"), F.lit(1)))


def house_floors(c) -> Column:
    """'3/9' -> 9."""
    return _to_int_rounded(F.split_part(col_(c), F.lit("/"), F.lit(2)))


def has_lift(c) -> Column:
    """F8: the floor value carries the lift marker."""
    return col_(c).contains(LIFT_MARKER)


def parse_source_date(c) -> Column:
    """'dd.MM.yyyy' -> DATE (NULL when invalid)."""
    return F.try_to_date(col_(c), SOURCE_DATE_FORMAT)


def parse_stored_date(c) -> Column:
    """'yyyy.MM.dd' -> DATE."""
    return F.try_to_date(col_(c), STORED_DATE_FORMAT)


def rotate_date(c) -> Column:
    """'01.07.2021' -> '2021.07.01'."""
    return F.date_format(parse_source_date(c), STORED_DATE_FORMAT)


def format_source_date(c) -> Column:
    return F.date_format(col_(c), SOURCE_DATE_FORMAT)


def run_date_lit(run_date) -> Column:
    """the run date is always a parameter, never current_date()."""
    if isinstance(run_date, str):
        run_date = _dt.date.fromisoformat(run_date)
    return F.lit(run_date)


def days_listed(run_date, list_date) -> Column:
    """whole days between the list date and the run date."""
    return F.datediff(run_date_lit(run_date) if not isinstance(run_date, Column) else run_date,
                      col_(list_date))


def month_key(c) -> Column:
    """display key 'MM.yyyy'."""
    return F.date_format(col_(c), MONTH_KEY_FORMAT)


def month_start(c) -> Column:
    """chronological month key."""
    return F.trunc(col_(c), "MM")


def round2(c) -> Column:
    """F16: round half-up to 2 decimals on an exact decimal."""
    return F.round(col_(c), 2)


def money(c) -> Column:
    """Exact decimal for money values coming from doubles."""
    return F.round(col_(c).cast("double"), 2).cast("decimal(18,2)")


def thousands(c) -> Column:
    """Render an integer with spaces as thousands separators: 57000 -> '57 000'."""
    return F.regexp_replace(F.format_number(col_(c).cast("bigint"), 0), ",", " ")


def thousands2(c) -> Column:
    """Render a 2-decimal number: 1216.67 -> '1 216.67'."""
    return F.regexp_replace(F.format_number(col_(c).cast("decimal(20,2)"), 2), ",", " ")
