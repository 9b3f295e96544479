"""Social profile addresses and how well a profile fits a lead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom import constants as k
from leadloom.functions.text import any_of, blank, let, quote, strip
from leadloom.functions.urls import host_of, path_of


def normalize_username(value: Column) -> Column:
    return F.lower(strip(F.ltrim(strip(blank(value)), F.lit("@"))))


def unwrap_redirect(href: Column) -> Column:
    """Target of a search engine's redirect link; other links unchanged."""
    def absolute(value: Column) -> Column:
        return F.when(value.startswith("//"), F.concat(F.lit("https:"), value)).otherwise(value)

    def unwrap(value: Column) -> Column:
        netloc = F.lower(F.regexp_extract(value, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
        raw = F.regexp_extract(value, r"^[^#?]*\?(?:[^#]*&)?uddg=([^&#]+)", 1)
        once = F.coalesce(F.try_url_decode(raw), raw)
        # an already decoded address may carry escapes of its own
        plus_kept = F.replace(once, F.lit("+"), F.lit("%2B"))
        target = F.coalesce(F.try_url_decode(plus_kept), once)
        return F.when(netloc.endswith(k.SEARCH_HOST) & (target != ""), target).otherwise(value)

    return let(absolute(strip(blank(href))), unwrap)


def profile_url(url: Column) -> Column:
    """``https://www.instagram.com/<handle>/`` for a profile address, else ``""``."""
    def complete(value: Column) -> Column:
        absolute = F.when(value.startswith("//"), F.concat(F.lit("https:"), value)).otherwise(value)
        return F.when(F.contains(absolute, F.lit("://")), absolute).otherwise(
            F.concat(F.lit("https://"), F.ltrim(absolute, F.lit("/"))))

    def build(value: Column) -> Column:
        first = F.regexp_extract(path_of(value), "^/*([^/]+)", 1)
        handle = strip(F.ltrim(first, F.lit("@")))
        usable = (host_of(value).isin(k.PROFILE_HOSTS) & handle.rlike(r"^[A-Za-z0-9._]{1,30}\z")
                  & ~F.lower(handle).isin(k.PROFILE_RESERVED))
        return F.when(usable, F.concat(F.lit("https://www.instagram.com/"), handle, F.lit("/"))).otherwise("")

    return let(unwrap_redirect(url), lambda v: F.when(v == "", "").otherwise(let(complete(v), build)))


def handle_of(profile: Column) -> Column:
    return F.regexp_extract(profile, "([^/]+)/$", 1)


def is_generic_local(local: Column, local_key: Column) -> Column:
    return F.lower(local).isin(k.GENERIC_LOCALS) | (F.length(local_key) < 4)


def close_enough_to_compare(a: Column, b: Column, ratio: float) -> Column:
    """Upper bound of the matching-blocks ratio by lengths alone."""
    shorter = F.least(F.length(a), F.length(b))
    return F.lit(2.0) * shorter >= F.lit(ratio) * (F.length(a) + F.length(b))


def match_confidence(handle: Column, title: Column, rank: Column, lead: Column,
                     to_username: Column, to_local: Column) -> Column:
    """Confidence 0..1 that a profile belongs to a lead.

    ``handle`` and ``title`` are compact keys; ``lead`` is a struct with ``local_key``,
    ``username_key``, ``name_key``, ``name_words`` and ``generic``; the last two arguments are
    similarity ratios (null counts as too different).
    """
    user, local, name = lead["username_key"], lead["local_key"], lead["name_key"]
    by_rank = F.greatest(F.lit(0.0), F.lit(0.18) - rank.cast("double") * F.lit(0.02))
    by_username = (
        F.when((user != "") & (handle == user), 0.99)
        .when((F.length(user) >= 5) & (to_username >= 0.86), 0.93).otherwise(0.0))
    nested = F.contains(handle, local) | F.contains(local, handle)
    both_long = F.least(F.length(handle), F.length(local)) >= 5
    by_local = (
        F.when(lead["generic"] | (local == ""), 0.0)
        .when(handle == local, 1.0)
        .when(both_long & (to_local >= 0.90), 0.95)
        .when(both_long & ((F.coalesce(to_local, F.lit(0.0)) >= 0.80) | nested), 0.86).otherwise(0.0))
    whole_name = F.contains(title, name) | F.contains(handle, name) | F.contains(name, handle)
    word_seen = F.exists(lead["name_words"], lambda w: (F.length(w) >= 4) & (
        F.contains(handle, w) | F.contains(title, w)))
    by_name = (F.when(F.length(name) < 5, 0.0).when(whole_name, 0.88).when(word_seen, 0.82).otherwise(0.0))
    best = F.greatest(by_rank, by_username, by_local, by_name)
    return F.when(lead["generic"] & (best < 0.82), F.least(best, F.lit(0.45))).otherwise(best)
