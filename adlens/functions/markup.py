"""Extraction that sees markup as a parser does (H1, H4, H5, H7).

``functions.html`` reads attributes and cells by pattern. Here a page is first
read tag by tag, so that what stands in comments, scripts and styles is no
markup, quoted ``>`` ends no tag, nested elements end where they were opened,
and character references count as characters. All of it is Spark expressions
over an array of tags and texts; the fold over it carries positions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import html as H
from .text import _quote, col_

_INSIDE = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_TAG = rf"</?[a-zA-Z]{_INSIDE}>"
_RAW = rf"<(?:script|style)\b{_INSIDE}>.*?(?:</(?:script|style)\s*>|\z)"
_COMMENT = r"<!--.*?(?:-->|\z)|<[!?][^>]*>"
# fixed values: character references by name that pages use
REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "nbsp": "\u00a0", "euro": "€", "sup2": "²",
              "laquo": "«", "raquo": "»", "ndash": "–", "mdash": "—", "hellip": "…", "copy": "©", "reg": "®", "deg": "°"}
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
_REPLACED = "\ufffd"


def bind(value, fn) -> Column:
    """``fn`` of a value that is worked out once a row. The optimizer puts an
    expression in place of every mention of its column where it joins
    projections or moves a filter below them; a lambda's variable stays."""
    return F.get(F.transform(F.array(col_(value)), fn), 0)


def visible(html) -> Column:
    """The page without comments, declarations, scripts and styles; tags are
    read whole, so a quoted attribute may hold what looks like either."""
    return F.regexp_replace(col_(html), F.lit(rf"(?is){_RAW}|({_TAG})|{_COMMENT}"), F.lit("$1"))


def _character(code: Column) -> Column:
    """The character of a code point; no character beyond the last one, for
    0 and for surrogates."""
    known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(F.lit(32))), 8, "0")), "UTF-32")).otherwise(F.lit(_REPLACED))


def _reference(piece: Column) -> Column:
    """One piece of ``unescape``: a reference or plain text."""
    number = F.when(piece.rlike(r"^&#[xX][0-9a-fA-F]+;$"), F.conv(F.regexp_extract(piece, r"^&#[xX](.+);$", 1), 16, 10)).when(
        piece.rlike(r"^&#[0-9]+;$"), F.regexp_extract(piece, r"^&#(.+);$", 1)).cast("bigint")
    names = F.create_map(*[F.lit(x) for name, char in REFERENCES.items() for x in (f"&{name};", char)])
    return F.coalesce(F.when(number.isNotNull(), _character(number)), F.try_element_at(names, piece), piece)


def unescape(text) -> Column:
    """Character references as characters, each once (``&amp;lt;`` is ``&lt;``);
    unknown names stay."""
    def read(t):
        pieces = F.regexp_extract_all(t, F.lit(rf"{_REFERENCE}|[^&]++|&"), 0)
        return F.when(t.contains("&"), F.array_join(F.transform(pieces, _reference), "")).otherwise(t)

    return bind(text, read)


def _unquoted(value: Column) -> Column:
    return unescape(F.regexp_replace(value, r"(?s)^([\"'])(.*)\1$", "$2"))


def tokens(html) -> Column:
    """The visible page as tags and stretches of text, in order. The
    functions below take this array and work it out once each; ``bind`` it
    where several of them read the same page."""
    return F.regexp_extract_all(visible(html), F.lit(rf"(?s){_TAG}|[^<]++|<"), 0)


def _starts(token: Column, tag: str) -> Column:
    return token.rlike(rf"(?i)^<{tag}[\s/>]")


def links(page) -> Column:
    """H1: every ``<a href>`` value in document order."""
    anchors = F.filter(col_(page), lambda t: _starts(t, "a"))
    found = F.transform(anchors, lambda t: F.regexp_extract(t, H._attribute_value("a", "href", f"({H._VALUE})"), 1))
    return F.transform(F.filter(found, lambda v: v != ""), _unquoted)


def msg_links(page, base: str = H.LINK_BASE, pattern: str = H.LINK_PATTERN) -> Column:
    """H1+H2: prefixed links that contain ``pattern``, first occurrence kept."""
    full = F.transform(links(page), lambda h: F.concat(F.lit(base), h))
    return F.array_distinct(F.filter(full, lambda u: u.contains(pattern)))


def cells(page, tag: str, cls: str) -> Column:
    """H4+H6: the markup of every ``tag`` with the class (a whole token of the
    attribute) up to the first end tag, character references read."""
    own = _quote(cls)
    listed = rf"(?:\"(?:[^\"]*\s)?(?-i:{own})(?:\s[^\"]*)?\"|'(?:[^']*\s)?(?-i:{own})(?:\s[^']*)?'|(?-i:{own})(?=[\s>]))"
    wanted = H._attribute_value(tag, "class", listed)

    def read(t, ends):
        marks = F.transform(t, lambda x, i: F.when(_starts(x, tag) & x.rlike(wanted), i))

        def inner(i):
            end = F.coalesce(F.get(F.filter(ends, lambda e: e > i), 0), F.size(t))
            return F.array_join(F.slice(t, i + 2, end - i - 1), "")

        return F.transform(F.filter(marks, lambda i: i.isNotNull()), lambda i: unescape(H.strip_controls(inner(i))))

    def end_tags(t):
        return F.filter(F.transform(t, lambda x, i: F.when(x.startswith("</"), i)), lambda i: i.isNotNull())

    return bind(page, lambda t: bind(end_tags(t), lambda ends: read(t, ends)))


def element(page, tag: str, attribute: str, value: str) -> Column:
    """The tokens inside the first element ``tag`` with this attribute value,
    up to the end tag that closes it (elements of the same name inside are
    skipped over; to the end of the page when none does); NULL without it."""
    own = _quote(value)
    wanted = H._attribute_value(tag, attribute, rf"(?-i:\"{own}\"|'{own}'|{own}(?=[\s>]))")
    end = rf"(?i)^</{tag}[\s/>]"

    def step(acc, x):
        depth = acc["depth"] + F.when(x.rlike(end), -1).when(_starts(x, tag) & ~x.endswith("/>"), 1).otherwise(0)
        return bind(depth, lambda after: F.struct(
            F.when(acc["depth"] == 0, 0).otherwise(after).alias("depth"),
            (acc["n"] + F.when((acc["depth"] > 0) & (after > 0), 1).otherwise(0)).alias("n")))

    def inside(t, at):
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
        n = F.aggregate(F.slice(t, at + 1, F.size(t)), start, step, lambda acc: acc["n"])
        return F.when(at > 0, F.slice(t, at + 1, n))

    def place(t):
        return F.array_position(F.transform(t, lambda x: _starts(x, tag) & x.rlike(wanted)), True).cast("int")

    return bind(page, lambda t: bind(place(t), lambda at: inside(t, at)))


def text(page) -> Column:
    """The text of tokens: tags dropped, references read."""
    return unescape(F.array_join(F.filter(col_(page), lambda x: ~x.rlike(rf"(?s)^{_TAG}$")), ""))


def span_text(page, span_id: str) -> Column:
    """H5: the text of ``<span id=…>``, nested spans included; NULL when the
    page has no such span."""
    return text(element(page, "span", "id", span_id))
