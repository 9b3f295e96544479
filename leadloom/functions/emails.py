"""Email rules: normalising, finding, rejecting, ranking, evidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom import constants as k
from leadloom.functions.text import any_of, blank, let, quote, strip, unescape
from leadloom.params import Params

_FULL = rf"(?i)\A{k.EMAIL_LOCAL_CLASS}+@{k.EMAIL_DOMAIN}\z"
_FIND = (rf"(?i)(?<![\p{{L}}\p{{N}}_.+-])({k.EMAIL_LOCAL_CLASS}+@{k.EMAIL_DOMAIN})"
         r"(?![\p{L}\p{N}_.-])")
_WRAPPING = "<>[](){}.,;:'\""


def normalize_email(value: Column) -> Column:
    """Lower-case address without wrapping punctuation; ``""`` when it is not an address."""
    trimmed = F.lower(F.btrim(strip(blank(value)), F.lit(_WRAPPING)))
    return let(trimmed, lambda v: F.when(v.rlike(_FULL), v).otherwise(""))


def local_part(normalized: Column) -> Column:
    return F.regexp_replace(normalized, "@[^@]*$", "")


def email_localpart(value: Column) -> Column:
    return F.substring_index(normalize_email(value), "@", 1)


def is_bad_normalized(email: Column, params: Params) -> Column:
    """Rejects an address that is already normalised (``""`` is bad too)."""
    local = local_part(email)
    endings = quote(k.BAD_EMAIL_ENDINGS)
    return (
        (email == "")
        | F.regexp_replace(email, "^.*@", "").isin(list(params.bad_email_domains))
        | email.rlike(f"^(?:{quote(k.BAD_LOCAL_PREFIXES)})")
        | email.rlike(f"(?:{endings})$")
        | (F.length(local) > 64)
        | F.contains(email, F.lit("..")))


def is_bad_email(value: Column, params: Params) -> Column:
    return let(normalize_email(value), lambda v: is_bad_normalized(v, params))


# what a piece of text holds at least when it holds an address, plain or written with entities
_AT_SIGNS = ["@", "[at]", "(at)", "&#", "&commat", "&lsqb;", "&lbrack;", "&lpar;", "&rsqb;", "&rbrack;", "&rpar;"]


def _address_pieces(text: Column) -> Column:
    """The pieces between spaces, ``<``, ``>`` and quotes that can hold an address.

    None of these separators occurs in an address, in an entity or in what its surroundings are
    tested for, so the pieces give the same addresses as the whole text.
    """
    pieces = F.filter(F.split(text, r'[ \t\r\n\f<>"]+'), lambda t: any_of(t, _AT_SIGNS))
    return F.when(any_of(text, _AT_SIGNS), F.array_join(pieces, " "))


def extract_emails(text: Column, params: Params) -> Column:
    """Good addresses seen verbatim in a text, in order, each once."""
    decoded = F.replace(
        F.replace(unescape(_address_pieces(text)), F.lit("[at]"), F.lit("@")), F.lit("(at)"), F.lit("@"))
    found = let(decoded, lambda d: F.when(
        F.contains(d, F.lit("@")), F.regexp_extract_all(d, F.lit(_FIND), F.lit(1))))
    good = F.filter(F.transform(found, normalize_email), lambda e: ~is_bad_normalized(e, params))
    return F.coalesce(F.array_distinct(good), F.array().cast("array<string>"))


def preference_of_good(email: Column) -> Column:
    """Rank points of an address that passed the checks."""
    local = F.substring_index(email, "@", 1)
    preferred = local.rlike(rf"^(?:{quote(k.PREFERRED_LOCALS)})(?:\.|$)")
    business = local.rlike(quote(k.BUSINESS_LOCAL_TOKENS))
    return F.lit(20) + F.when(preferred, 15).otherwise(0) + F.when(business, 10).otherwise(0)


def email_preference(value: Column, params: Params) -> Column:
    return let(normalize_email(value), lambda v: F.when(
        is_bad_normalized(v, params), -100).otherwise(preference_of_good(v)))


def confidence_of(preference: Column) -> Column:
    above = F.greatest(preference - 20, F.lit(0)) / F.lit(100)
    return F.round(F.least(F.lit(1.0), F.lit(0.85) + above), 2)


def evidence(email: Column, preference: Column, source_url: Column, source_type: Column,
             params: Params) -> Column:
    """Where an address was seen, when, and how far to trust it."""
    now = F.lit(params.as_of)
    return F.struct(
        email.alias("email"),
        source_url.alias("source_url"),
        source_type.alias("source_type"),
        now.alias("first_seen"),
        now.alias("last_checked"),
        F.lit(k.VERIFIED).alias("verification_status"),
        confidence_of(preference).alias("confidence"),
        F.concat(F.lit("exact address observed on public "), source_type, F.lit(" source"))
        .alias("evidence_reason"),
        preference.alias("preference"),
    )


def verified_email(email: Column, status: Column) -> Column:
    return (strip(blank(email)) != "") & (strip(blank(status)) == k.VERIFIED)
