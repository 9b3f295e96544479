"""What the jobs need from a page, as Column expressions over its text.

Comments, scripts and styles are skipped, attribute names are case-blind, the last of several
equal attributes counts, and entities are decoded. Only values that hold an entity visit Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.functions.text import SPACE, blank, let, strip, unescape, unescape_items

# possessive loops throughout: Java runs them without recursion and without going back
_ATTRS = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
_COMMENT = r"!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->)?+"
_SKIPPED = _COMMENT + r"|(?:script|style)\b[^<]*+(?:<(?!/(?:script|style))[^<]*+)*+"
_ATTRIBUTE = r"""([^\s/>=][^\s/>=]*+\s*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']*+))?+)"""


def _tags(html: Column, name: str) -> Column:
    """Attribute text of every ``<name ...>`` outside comments, scripts and styles."""
    pattern = rf"(?i)<(?:{_SKIPPED}|{name}(?=[\s/>])({_ATTRS})>)"
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    opening = F.filter(found, lambda t: t.rlike(rf"(?i)^<{name}(?=[\s/>])"))
    return F.transform(opening, lambda t: F.substring(t, len(name) + 2, 1 << 30))


def _attribute(attrs: Column, name: str) -> Column:
    """Raw value of the last attribute of that name, null when there is none."""
    pairs = F.regexp_extract_all(attrs, F.lit(_ATTRIBUTE), F.lit(1))
    named = F.filter(pairs, lambda p: F.lower(F.regexp_extract(p, r"^([^\s=]+)", 1)) == name)
    value = F.regexp_replace(F.get(named, F.size(named) - 1), r"^[^\s=]+\s*(?:=\s*)?", "")
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")


def hrefs(html: Column) -> Column:
    """Decoded ``href`` values of all anchors, in order."""
    raw = F.transform(_tags(blank(html), "a"), lambda t: _attribute(t, "href"))
    return unescape_items(F.filter(raw, lambda h: h.isNotNull()))


def inner_text(fragment: Column) -> Column:
    """Text pieces of a fragment, each trimmed, joined by one space (entities left as they are)."""
    bare = F.regexp_replace(fragment, rf"(?i)<(?:{_SKIPPED})", "")
    pieces = F.transform(F.split(bare, r"<[/!?a-zA-Z][^>]*+>"), strip)
    return F.array_join(F.filter(pieces, lambda p: p != ""), " ")


def title(html: Column) -> Column:
    """Text of the first title, null when the page has none. Reading stops at the title."""
    before = rf"(?i)\A(?:[^<]++|<(?:{_SKIPPED})|<(?!title[\s/>]))*+"
    found = F.regexp_extract(blank(html), rf"{before}(<title{_ATTRS}>[^<]*+(?:<(?!/title)[^<]*+)*+)", 1)
    text = inner_text(F.regexp_replace(found, rf"(?i)\A<title{_ATTRS}>", ""))
    return F.when(found != "", unescape(text))


def meta_description(html: Column) -> Column:
    """Content of the first ``<meta name="description">``, ``""`` when there is none."""
    metas = F.filter(_tags(blank(html), "meta"),
                     lambda t: unquoted_equals(_attribute(t, "name"), "description"))
    first = F.get(metas, F.lit(0))
    return unescape(blank(let(first, lambda t: _attribute(t, "content"))))


def unquoted_equals(value: Column, word: str) -> Column:
    return F.coalesce(value == word, F.lit(False))


def anchors(html: Column) -> Column:
    """``array<struct<href, text>>`` of the anchors of a short page such as a result list.

    Text runs from an anchor's tag to the next ``</a`` or to the next anchor.
    """
    visible = F.regexp_replace(blank(html), rf"(?i)<(?:{_SKIPPED})", "")
    whole = F.regexp_extract_all(
        visible, F.lit(rf"(?i)(<a(?=[\s/>]){_ATTRS}>[^<]*+(?:<(?!/a[\s>]|a[\s/>])[^<]*+)*+)"), F.lit(1))
    hrefs_raw = F.transform(whole, lambda a: _attribute(F.regexp_extract(a, rf"(?i)^<a({_ATTRS})>", 1), "href"))
    texts_raw = F.transform(whole, lambda a: inner_text(F.regexp_replace(a, rf"(?i)^<a{_ATTRS}>", "")))
    linked = F.transform(hrefs_raw, lambda h: h.isNotNull())
    pairs = F.arrays_zip(
        unescape_items(F.transform(hrefs_raw, blank)).alias("href"),
        unescape_items(texts_raw).alias("text"), linked.alias("linked"))
    return F.transform(F.filter(pairs, lambda p: p["linked"]),
                       lambda p: F.struct(p["href"].alias("href"), p["text"].alias("text")))


def looks_like_html(text: Column, content_type: Column) -> Column:
    """Page test of the page source: type says html, or ``<html`` is among the first 500 characters."""
    return (F.contains(F.lower(blank(content_type)), F.lit("html"))
            | F.contains(F.lower(F.substring(text, 1, 500)), F.lit("<html")))


def is_site_page(text: Column, content_type: Column) -> Column:
    """Page test of the site visit: type says html, or the text opens like a page."""
    return (F.contains(F.lower(blank(content_type)), F.lit("html"))
            | text.rlike(rf"^[{SPACE}]*(?:<html|<!DOCTYPE|<!doctype)"))
