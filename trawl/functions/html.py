"""HTML -> (title, clean text) as native regex / array expressions.

Markup is read from left to right by one pattern, so that a construct hides what stands
inside it: comments; script, style and noscript elements with their raw text; tags, whose
quoted attribute values may hold ">"; declarations. An unterminated comment, element or
tag reaches to the end of the page.

Clean text, in this order:
  1. every piece of markup becomes a break (each text node is followed by a space);
  2. character references are decoded in one left-to-right pass, so "&amp;lt;" becomes
     the text "&lt;" and not "<"; all HTML5 names are known, and the old ones also count
     without a semicolon;
  3. leftover "&name;" sequences become a break;
  4. white space runs collapse to one space, ends trimmed.
The title text stays part of the body text.

Title (index title): the last <title> element that has any content, decoded and
trimmed; an empty result (or no title at all) is "No Title". So a blank title after a
real one yields "No Title", while <title></title> is skipped.

Elements that hold text only keep what looks like tags in them: title and textarea (their
references are decoded), iframe, xmp, noembed and noframes (they are not).

Known limits against a full HTML5 tree builder: foster-parented table text, and titles in SVG
that hold tags.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.expr import let
from trawl.functions.text import WS, collapse_ws

NO_TITLE = "No Title"

# Numeric references 0x80-0x9F map through Windows-1252 (HTML5 rule).
_C1 = {c: ord(bytes([c]).decode("cp1252")) for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
# Names without their semicolon: all names, and the old ones that count without it.
_NAMES = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}
_OLD_NAMES = {k: v for k, v in html5.items() if not k.endswith(";")}
_OLD_LENGTHS = range(max(map(len, _OLD_NAMES)), min(map(len, _OLD_NAMES)) - 1, -1)

# What follows a tag's name: attributes, whose values may be quoted. Possessive throughout, so a
# page is read once whatever it holds.
ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))?+)*+"""
_NAME_END = r"(?=[\s/>])"
_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
_RAW_TEXT = (r"<(script|style|noscript)" + _NAME_END + ATTRS
             + r"(?:>.*?(?:</\1" + _NAME_END + r"[^>]*+(?:>|\z)|\z)|\z)")
_TAG = r"</?[a-z]" + ATTRS + r"(?:>|\z)"
_DECLARATION = r"<[!?/][^>]*+(?:>|\z)"
MARKUP = f"(?is){_COMMENT}|{_RAW_TEXT}|{_TAG}|{_DECLARATION}"
_TITLE = (f"(?is){_COMMENT}|{_RAW_TEXT}|<title{_NAME_END}{ATTRS}>(.*?)(?:</title{_NAME_END}[^>]*+(?:>|\\z)|\\z)"
          f"|{_TAG}|{_DECLARATION}")
# Group 2 holds the attributes of an <a> tag that is closed.
A_TAGS = f"(?is){_COMMENT}|{_RAW_TEXT}|<a{_NAME_END}({ATTRS})>|{_TAG}|{_DECLARATION}"

# Elements of text only: group 2 is the name, group 3 the content.
_TEXT_ONLY = (r"<(title|textarea|iframe|xmp|noembed|noframes)" + _NAME_END + ATTRS
              + r">(.*?)(?:</\2" + _NAME_END + r"[^>]*+(?:>|\z)|\z)")
_PIECE = f"(?is){_COMMENT}|{_RAW_TEXT}|{_TEXT_ONLY}|{_TAG}|{_DECLARATION}|[^<]++|<"
_DECODED = r"(?is)^<(?:title|textarea)" + _NAME_END
_HAS_TEXT_ONLY = (r"(?is)<(?:title|textarea)\b[^>]*+>[^<]*+<(?!/(?:title|textarea))|<(?:iframe|xmp|noembed|noframes)" + _NAME_END)
# Noncharacters that stand for "<" and "&" of such text while markup and references are read.
_KEPT_LT, _KEPT_AMP = "\ufdd0", "\ufdd1"

_LEFTOVER_REF = r"&[a-zA-Z]+;"
_REF_TOKEN = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[a-zA-Z][a-zA-Z0-9]*[;=]?|[^&]+|&"
_TRIM_WS = f"^{WS}|{WS}$"


def _constant_map(d: dict[str, str]) -> Column:
    """A map that the optimizer folds to one literal (its entries never enter the plan)."""
    return F.from_json(F.lit(json.dumps(d)), "map<string,string>")


def _code_point_to_str(digits: Column, base: int) -> Column:
    """The digits of a numeric reference -> one-character string, HTML5 rules for bad values."""
    short = F.regexp_replace(digits, "^0+", "")
    # More digits than any code point has are out of range.
    cp = F.when(F.length(short) > 8, F.lit(-1).cast("bigint")).otherwise(
        F.coalesce(F.conv(short, base, 10).cast("bigint"), F.lit(0)))

    def char(v: Column) -> Column:
        c1 = _constant_map({str(k): str(x) for k, x in _C1.items()})
        fixed = (F.when((v >= 0x80) & (v <= 0x9F), F.coalesce(F.try_element_at(c1, v.cast("string")).cast("bigint"), v))
                 .when((v <= 0) | (v > 0x10FFFF) | ((v >= 0xD800) & (v <= 0xDFFF)), F.lit(0xFFFD))
                 .otherwise(v))
        return F.decode(F.unhex(F.lpad(F.hex(fixed), 8, "0")), "UTF-32")

    return let(cp, char)


def decode_entities(c: Column, attribute: bool = False) -> Column:
    """Decode character references in one pass.

    A name without a semicolon counts if it is an old one; in text also as the longest old
    name that it starts with, in an attribute value only whole and not before "=".
    """
    names, old = _constant_map(_NAMES), _constant_map(_OLD_NAMES)

    def without_semicolon(tok: Column, name: Column) -> Column:
        if attribute:
            return F.coalesce(F.when(~F.endswith(tok, F.lit("=")), F.try_element_at(old, name)), tok)
        tries = [F.when(F.length(name) >= k, F.concat(F.try_element_at(old, F.substring(name, 1, k)),
                                                     F.substr(tok, F.lit(k + 2)))) for k in _OLD_LENGTHS]
        return F.coalesce(*tries, tok)

    def one(tok: Column) -> Column:
        dec = F.regexp_extract(tok, r"^&#([0-9]+);?$", 1)
        hx = F.regexp_extract(tok, r"^&#[xX]([0-9a-fA-F]+);?$", 1)
        name = F.regexp_extract(tok, r"^&([a-zA-Z][a-zA-Z0-9]*)[;=]?$", 1)
        named = F.when(F.endswith(tok, F.lit(";")), F.try_element_at(names, name))
        return (F.when(~F.startswith(tok, F.lit("&")), tok)
                .when(dec != "", _code_point_to_str(dec, 10))
                .when(hx != "", _code_point_to_str(hx, 16))
                .when(name != "", F.coalesce(named, without_semicolon(tok, name)))
                .otherwise(tok))

    decoded = F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_REF_TOKEN), 0), one), "")
    return F.when(F.instr(c, "&") > 0, decoded).otherwise(c)


def trim_ws(c: Column) -> Column:
    """Trim Unicode white space at both ends (keeps inner white space)."""
    return F.regexp_replace(c, _TRIM_WS, "")


def _unmarked(html: Column) -> Column:
    """``html`` with every piece of markup as a blank, the text of text-only elements kept under noncharacters."""
    def one(piece: Column) -> Column:
        def kept(inner: Column) -> Column:
            text = F.replace(inner, F.lit("<"), F.lit(_KEPT_LT))
            return F.concat(F.lit(" "), F.when(piece.rlike(_DECODED), text).otherwise(
                F.replace(text, F.lit("&"), F.lit(_KEPT_AMP))), F.lit(" "))

        whole = f"(?is)^{_RAW_TEXT}$|^{_TEXT_ONLY}$"
        return (F.when((piece == "<") | ~F.startswith(piece, F.lit("<")), piece)
                .when(F.regexp_extract(piece, whole, 2) != "", kept(F.regexp_extract(piece, whole, 3)))
                .otherwise(F.lit(" ")))

    pieces = F.array_join(F.transform(F.regexp_extract_all(html, F.lit(_PIECE), F.lit(0)), one), "")
    return F.when(html.rlike(_HAS_TEXT_ONLY), pieces).otherwise(F.regexp_replace(html, MARKUP, " "))


def clean_text(html: Column) -> Column:
    """Visible text of a page, title included, white space collapsed."""
    t = decode_entities(_unmarked(F.coalesce(html, F.lit(""))))
    t = F.translate(t, _KEPT_LT + _KEPT_AMP, "<&")
    return collapse_ws(F.regexp_replace(t, _LEFTOVER_REF, " "))


def _titles(html: Column) -> Column:
    """Raw contents of every <title> element that has a child, in document order."""
    return F.filter(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TITLE), 2), lambda t: t != "")


def page_title(html: Column) -> Column:
    """Index title: last non-childless <title>, decoded and trimmed, else "No Title"."""
    last = F.try_element_at(_titles(html), F.lit(-1))  # null when there is no title
    t = trim_ws(decode_entities(last))
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit(NO_TITLE)).otherwise(t)


def first_title(html: Column) -> Column:
    """First <title> whose trimmed text is not empty, else "No Title"."""
    ts = F.filter(F.transform(_titles(html), lambda t: trim_ws(decode_entities(t))), lambda t: t != "")
    return F.coalesce(F.get(ts, 0), F.lit(NO_TITLE))
