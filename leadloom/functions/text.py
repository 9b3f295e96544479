"""Text helpers: binding, trimming, entities, accent folding, similarity, masking."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.constants import REDACTED, SECRET_STEMS, SECRET_WORDS, UNKNOWN
from leadloom.functions.udfs import fold_unicode, unescape_arrays, unescape_texts

# white space as Unicode sees it, as a Java character class body
SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def strip(value: Column) -> Column:
    """Trim any Unicode white space at both ends."""
    return F.regexp_replace(value, f"^[{SPACE}]+|[{SPACE}]+$", "")


def blank(value: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(value, F.lit(""))


def filled(*values: Column, default: str = UNKNOWN) -> Column:
    """First value that is neither null nor empty, else ``default``."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(default))


def any_of(text: Column, words: Iterable[str]) -> Column:
    """True when ``text`` contains one of ``words`` as a plain substring."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def quote(words: Iterable[str]) -> str:
    """An alternation of literal words for an anchored regular expression."""
    return "|".join(re.sub(r"([^A-Za-z0-9_])", r"\\\1", word) for word in words)


def mask_secrets(text: Column) -> Column:
    """Replace the value after ``<secret word> = `` or ``: `` by a marker."""
    pattern = f"(?i)({SECRET_WORDS})([{SPACE}]*[=:][{SPACE}]*)([^{SPACE},;]+)"
    masked = F.regexp_replace(text, F.lit(pattern), F.lit(f"$1$2{REDACTED}"))
    # a plain search first: most texts hold no such word and skip the pattern
    possible = any_of(F.lower(text), SECRET_STEMS)
    return F.when(possible, masked).otherwise(text)


def title_case(text: Column) -> Column:
    """Upper-case a letter that follows a non-letter, lower-case all others."""
    pieces = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    cased = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                   F.lower(F.substring(p, 2, 1 << 30))))
    return F.array_join(cased, "")


def safe_int(value: Column) -> Column:
    """Whole number, or null when the text is not one."""
    trimmed = F.regexp_replace(strip(value.cast("string")), "_", "")
    return F.when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed.try_cast("bigint"))


def is_json(text: Column) -> Column:
    """True when the whole text is one JSON value.

    The parser stops after the first value. What may follow it inside an array and inside an object
    differs, so text with anything behind the value fails one of the two.
    """
    inside_array = F.concat(F.lit("["), text, F.lit("]"))
    inside_object = F.concat(F.lit('{"v":'), text, F.lit("}"))
    parsed = [F.try_parse_json(x).isNotNull() for x in (text, inside_array, inside_object)]
    return parsed[0] & parsed[1] & parsed[2]


_ENTITY = r"&(#[0-9xX]|[A-Za-z])"


def unescape(text: Column) -> Column:
    """Decode HTML entities; only rows that hold one are sent to Python."""
    return F.coalesce(unescape_texts(F.when(text.rlike(_ENTITY), text)), text)


def unescape_items(items: Column) -> Column:
    """The same for every element of an array."""
    touched = F.exists(items, lambda x: x.rlike(_ENTITY))
    return F.coalesce(unescape_arrays(F.when(touched, items)), items)


def fold_words(text: Column) -> Column:
    """Words without accents, case and punctuation, separated by single spaces."""
    ascii_only = F.regexp_replace(F.lower(text), f"[^a-z0-9{SPACE}]", "")
    one_space = F.regexp_replace(ascii_only, f"[{SPACE}]+", " ")
    foreign = text.rlike(r"[^\x00-\x7F]")
    return F.coalesce(fold_unicode(F.when(foreign, text)), one_space)


def compact(text: Column) -> Column:
    """:func:`fold_words` without the spaces: letters a-z and digits only."""
    return F.replace(fold_words(text), F.lit(" "), F.lit(""))
