"""The scalar functions F1-F17 as Spark SQL functions.

They are temporary SQL functions: Spark inlines their bodies, so a query that
calls them is optimised like the DataFrame form. Constants come from
``functions.text``. ``register`` defines them for a session; ``plans.adhoc``
does so for its queries.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import text as X

_SPACES = "[ \u00a0\u202f]"


def _lit(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _strip(arg: str) -> str:
    for token in X.LABEL_TOKENS:
        arg = f"replace({arg}, {_lit(token)}, '')"
    return arg


def _street(arg: str, mode: str) -> str:
    out = f"trim({arg})"
    for abbr, full in X.STREET_ABBREVIATIONS:
        end, tail = (r"\b", full) if mode == "literal" else (r"\s*", full + " ")
        out = f"regexp_replace({out}, {_lit(r'(?iU)' + chr(92) + 'b' + X._quote(abbr) + end)}, {_lit(tail)})"
    return out if mode == "literal" else f"trim({out})"


def _number(arg: str, pattern: str, kind: str) -> str:
    return f"try_cast(nullif(regexp_replace(regexp_extract({arg}, {_lit(pattern)}, 1), {_lit(_SPACES)}, ''), '') AS {kind})"


def _rounded(arg: str, part: int) -> str:
    return f"try_cast(round(try_cast(split_part({arg}, '/', {part}) AS DOUBLE)) AS INT)"


def definitions() -> dict[str, tuple[str, str, str]]:
    """name -> (arguments, result type, body)."""
    source, stored, month = _lit(X.SOURCE_DATE_FORMAT), _lit(X.STORED_DATE_FORMAT), _lit(X.MONTH_KEY_FORMAT)
    return {
        "strip_tokens": ("s STRING", "STRING", _strip("s")),                                                            # F1
        "parse_size": ("s STRING", "DECIMAL(10,2)", "try_cast(split_part(trim(s), ' ', 1) AS DECIMAL(10,2))"),          # F2
        "parse_price": ("s STRING", "BIGINT", _number("s", "^\\s*([0-9][0-9 \u00a0\u202f]*)€", "BIGINT")),             # F3
        "parse_sqm_price": ("s STRING", "DECIMAL(10,2)", _number("s", "\\(\\s*([0-9][0-9 .\u00a0\u202f]*)€", "DECIMAL(10,2)")),   # F4
        "normalise_street": ("s STRING", "STRING", _street("s", "literal")),                                            # F5
        "expand_street": ("s STRING", "STRING", _street("s", "expand")),
        "url_hash": ("s STRING", "STRING", "nullif(split_part(get(split(s, '/', 10), 9), '.', 1), '')"),                # F6
        "url_path_part": ("s STRING, i INT", "STRING", "get(split(s, '/'), i)"),
        "apt_floor": ("s STRING", "INT", _rounded("s", 1)),                                                             # F7
        "house_floors": ("s STRING", "INT", _rounded("s", 2)),
        "has_lift": ("s STRING", "BOOLEAN", f"contains(s, {_lit(X.LIFT_MARKER)})"),                                     # F8
        "rotate_date": ("s STRING", "STRING", f"date_format(try_to_date(s, {source}), {stored})"),                      # F9
        "parse_source_date": ("s STRING", "DATE", f"try_to_date(s, {source})"),                                         # F10
        "parse_stored_date": ("s STRING", "DATE", f"try_to_date(s, {stored})"),
        "format_source_date": ("d DATE", "STRING", f"date_format(d, {source})"),
        "days_listed": ("run DATE, listed DATE", "INT", "datediff(run, listed)"),                                       # F12, F13
        "month_key": ("d DATE", "STRING", f"date_format(d, {month})"),                                                  # F14
        "month_start": ("d DATE", "DATE", "CAST(trunc(d, 'MM') AS DATE)"),
        "thousands": ("n BIGINT", "STRING", "regexp_replace(format_number(n, 0), ',', ' ')"),                           # F17
    }


def register(spark: SparkSession) -> list[str]:
    """Define the functions for this session (again); returns their names."""
    known = definitions()
    for name, (arguments, result, body) in known.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(known)
