"""HTML and report-block extraction expressions.

Pages are a STRING column; extraction is regex-based and therefore sound for
flat cells only (the reference cuts a cell at its first ``</``, so nested
markup is out of scope). All functions return Spark Columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _quote, col_

# --- fixed values ----------------------------------------------------------
# Base prefixed to every link and the pattern a link must contain.
LINK_BASE = "https://ss.lv"
LINK_PATTERN = "msg"
# Cell classes of an ad page: option names, option values, price, footer.
CLASS_OPT_NAME = "ads_opt_name"
CLASS_OPT_VALUE = "ads_opt"
CLASS_PRICE = "ads_price"
CLASS_FOOTER = "msg_footer"
# Footer prefix before the publication date and the main table id.
FOOTER_DATE_PREFIX = "Datums:"
MAIN_TABLE_ID = "page_main"
# Labels of the report lines and their accent-free names in the formatted table.
LABEL_ROOMS = "Istabas"
LABEL_STREET = "Iela"
LABEL_SIZE = "Platība"
LABEL_FLOOR = "Stāvs"
LABEL_PRICE = "Price"
LABEL_DATE = "Date"
LABEL_RENAMES = {"Platība": "Platiba", "Stāvs": "Stavs"}
# ---------------------------------------------------------------------------

# One attribute of a tag: blank, name, and a value in either quote or bare.
_VALUE = r"(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
_NAME = r"[^\s=>\"'/]+"


def _attribute_value(tag: str, name: str, value: str) -> str:
    """Pattern up to the value of a tag's first attribute called ``name``:
    whole attributes are read, so ``data-name`` is another one, and neither
    quotes nor letter case matter. ``value`` is the value's own pattern."""
    other = rf"(?:\s+(?!{name}\s*=){_NAME}(?:\s*=\s*{_VALUE})?)*+"
    return rf"(?is)<{tag}{other}\s+{name}\s*=\s*{value}"


def unquoted(value) -> Column:
    """An attribute value without its quotes, entities decoded."""
    text = F.regexp_replace(col_(value), r"^([\"'])(.*)\1$", "$2")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def links(html) -> Column:
    """H1: every ``<a href>`` value in document order."""
    found = F.regexp_extract_all(col_(html), F.lit(_attribute_value("a", "href", f"({_VALUE})")), 1)
    return F.transform(found, unquoted)


def msg_links(html, base: str = LINK_BASE, pattern: str = LINK_PATTERN) -> Column:
    """H1+H2: prefixed links that contain ``pattern``, first occurrence kept,
    order kept (array_distinct keeps first-occurrence order)."""
    full = F.transform(links(html), lambda h: F.concat(F.lit(base), h))
    return F.array_distinct(F.filter(full, lambda u: u.contains(pattern)))


def cell_regex(tag: str, cls: str) -> str:
    """Inner HTML of ``<tag class="… cls …">`` up to the first ``</``; the
    class must match as a whole token."""
    token = _quote(cls)
    listed = (rf"(?:\"(?:[^\"]*\s)?(?-i:{token})(?:\s[^\"]*)?\"|'(?:[^']*\s)?(?-i:{token})(?:\s[^']*)?'|(?-i:{token})(?=[\s>]))")
    return _attribute_value(tag, "class", listed) + r"[^>]*>(.*?)</"


def main_scope(html) -> Column:
    """Restrict to the content of ``table#page_main`` when present, up to the
    table's own end (tables nested in it are skipped over)."""
    h = col_(html)
    main = rf"(?:\"{MAIN_TABLE_ID}\"|'{MAIN_TABLE_ID}'|{MAIN_TABLE_ID}(?=[\s>]))"
    tail = F.regexp_extract(h, r"(?s)(" + _attribute_value("table", "id", main) + r".*)", 1)
    # split at table tags; the depth after each piece says where the table ends
    pieces = F.regexp_extract_all(tail, F.lit(r"(?is)(</?table\b.*?(?=</?table\b|\z))"), 1)
    step = lambda acc, x: F.struct(
        F.when(acc["done"], acc["depth"]).when(x.rlike(r"(?i)^</"), acc["depth"] - 1).otherwise(acc["depth"] + 1).alias("depth"),
        (acc["done"] | (x.rlike(r"(?i)^</") & (acc["depth"] == 1))).alias("done"),
        F.when(acc["done"] | (x.rlike(r"(?i)^</") & (acc["depth"] == 1)), acc["text"]).otherwise(F.concat(acc["text"], x)).alias("text"))
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("text"))
    inside = F.aggregate(pieces, start, step, lambda acc: acc["text"])
    return F.when(tail == "", h).otherwise(inside)


def strip_controls(c) -> Column:
    """H6: drop TAB, CR and LF."""
    return F.translate(col_(c), "\t\r\n", "")


def cells(html, tag: str, cls: str, scoped: bool = False) -> Column:
    """H4+H6: cleaned cell texts by tag and class, in document order."""
    src = main_scope(html) if scoped else col_(html)
    return F.transform(F.regexp_extract_all(src, F.lit(cell_regex(tag, cls)), 1), strip_controls)


def span_text(html, span_id: str) -> Column:
    """H5: text of ``<span id=…>`` with inner tags removed."""
    own = _quote(span_id)
    value = rf"(?-i:\"{own}\"|'{own}'|{own}(?=[\s>]))"
    inner = F.regexp_extract(col_(html), _attribute_value("span", "id", value) + r"[^>]*>(.*?)</span>", 1)
    return F.nullif(F.regexp_replace(inner, r"<[^>]*>", ""), F.lit(""))


def zip_options(names, values) -> Column:
    """H7: pair option names with values, dropping the last name."""
    n = F.greatest(F.size(col_(names)) - 1, F.lit(0))
    return F.arrays_zip(F.slice(col_(names), 1, n).alias("name"), col_(values).alias("value"))


def first_price(prices) -> Column:
    """H8: first price cell (NULL when absent)."""
    return F.get(col_(prices), 0)


def footer_date(footer) -> Column:
    """H9: third footer cell, minus the date prefix, first token."""
    third = F.trim(F.replace(F.get(col_(footer), 2), F.lit(FOOTER_DATE_PREFIX), F.lit("")))
    return F.nullif(F.split_part(third, F.lit(" "), F.lit(1)), F.lit(""))


# --- report blocks -----------------------------------------------------------

_KEY_RE = r"(?m)^[ \t]*([^\r\n]*?):>"
_VAL_RE = r"(?m)^[ \t]*[^\r\n]*?:>([^\r\n]*)"


def block_url(block) -> Column:
    """The URL line that starts an ad block."""
    return F.nullif(F.regexp_extract(col_(block), r"^\s*(https?://\S+)", 1), F.lit(""))


def block_fields(block) -> Column:
    """Every ``Label:>value`` line of a block as MAP<label, value>; the
    first occurrence of a label wins. Labels are anchored at line start."""
    keys = F.regexp_extract_all(col_(block), F.lit(_KEY_RE), 1)
    vals = F.regexp_extract_all(col_(block), F.lit(_VAL_RE), 1)
    uniq = F.array_distinct(keys)
    return F.map_from_arrays(
        uniq, F.transform(uniq, lambda k: F.element_at(vals, F.array_position(keys, k).cast("int"))))


def field(fields, label: str) -> Column:
    """Value of one label; NULL when the block lacks it."""
    return F.try_element_at(col_(fields), F.lit(label))


def label_value(block, label: str) -> Column:
    """Value of the first ``label:>`` line of a block, NULL when the block has
    none. One anchored regex: cheap enough to be inlined by the optimizer."""
    pattern = r"(?m)^[ \t]*" + _quote(label) + r":>([^\r\n]*)"
    return F.get(F.regexp_extract_all(col_(block), F.lit(pattern), 1), 0)


def label_count(block, label: str) -> Column:
    """How many lines of a block carry ``label`` (for the V1 check)."""
    return F.size(F.regexp_extract_all(col_(block), F.lit(r"(?m)^[ \t]*(" + _quote(label) + r"):>"), 1))
