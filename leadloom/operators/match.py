"""Matching social profiles from search results to leads by their email's local part.

``results(query, html, failed)`` holds one row per query. A result page is short, so its profiles
stay in an array and are compared inside the row; leads meet results in one equi-join on the query
text, whose result side has one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import constants as k
from leadloom.functions.emails import email_localpart
from leadloom.functions.html import anchors
from leadloom.functions.identity import (
    close_enough_to_compare, handle_of, is_generic_local, match_confidence, normalize_username,
    profile_url,
)
from leadloom.functions.text import SPACE, blank, compact, fold_words, strip
from leadloom.functions.udfs import similarity_to_each
from leadloom.operators.order import first_rows
from leadloom.operators.skew import skewed_join
from leadloom.params import Params


def profiles_in_results(results: DataFrame) -> DataFrame:
    """``(query, failed, found)`` with ``found`` an array of distinct ``(profile, title)`` by rank."""
    linked = results.select(
        "query", F.coalesce("failed", F.col("html").isNull()).alias("failed"),
        F.transform(anchors(F.col("html")), lambda a: F.struct(
            profile_url(a["href"]).alias("profile"), a["text"].alias("title"))).alias("all"))
    real = linked.withColumn("all", F.filter("all", lambda p: p["profile"] != ""))
    names = F.transform("all", lambda p: p["profile"])
    return real.select("query", "failed", F.filter(
        "all", lambda p, i: F.array_position(names, p["profile"]) == i + 1).alias("found"))


def lookup_queries(leads: DataFrame) -> DataFrame:
    """One row per lead and query: local part first; a generic one also with the lead's identity.

    ``leads(lead_id, email, name, username)``; an invalid address gives one row without a query.
    """
    local = leads.withColumn("local", email_localpart(F.col("email")))
    keyed = local.withColumns({
        "local_key": compact(F.col("local")),
        "username_key": compact(normalize_username(F.col("username"))),
        "words": fold_words(blank(F.col("name"))),
    })
    shown_name = F.coalesce(F.nullif(normalize_username(F.col("username")), F.lit("")), strip(blank(F.col("name"))))
    first = F.concat(F.col("local"), F.lit(" instagram"))
    second = F.concat(F.col("local"), F.lit(" "), shown_name, F.lit(" instagram"))
    generic = F.lower("local").isin(k.GENERIC_LOCALS)
    queries = (F.when(F.col("local") == "", F.array(F.lit(None).cast("string")))
               .when(generic & (shown_name != ""), F.array(first, second)).otherwise(F.array(first)))
    facts = F.struct(
        "local_key", "username_key", F.replace("words", F.lit(" "), F.lit("")).alias("name_key"),
        F.split("words", " ").alias("name_words"),
        is_generic_local(F.col("local"), F.col("local_key")).alias("generic"))
    return keyed.select("lead_id", facts.alias("facts"), first.alias("first_query"),
                        F.posexplode(queries).alias("query_no", "query"))


def _ratios(handles: Column, other: Column, floor: float, needed: Column) -> Column:
    """Similarity per handle; pairs that equality or length already settle never reach Python."""
    open_pairs = F.transform(handles, lambda h: F.when(
        (h != other) & close_enough_to_compare(h, other, floor) & needed, h))
    any_open = F.exists(open_pairs, lambda h: h.isNotNull())
    return similarity_to_each(F.when(any_open, open_pairs), F.when(any_open, other))


def score_results(looked_up: DataFrame) -> DataFrame:
    """Best ``(confidence, profile)`` of each lead and query, the first rank on a tie."""
    keyed = looked_up.withColumns({
        "handles": F.transform("found", lambda p: F.regexp_replace(F.lower(handle_of(p["profile"])), "[^a-z0-9]", "")),
        "titles": compact_each(F.transform("found", lambda p: p["title"])),
    })
    user, local = F.col("facts.username_key"), F.col("facts.local_key")
    compared = keyed.withColumns({
        "to_user": _ratios(F.col("handles"), user, 0.86, F.length(user) >= 5),
        "to_local": _ratios(F.col("handles"), local, 0.80, ~F.col("facts.generic") & (F.length(local) >= 5)),
    })

    def confidence(p: Column, i: Column) -> Column:
        return F.struct(
            match_confidence(
                F.get(F.col("handles"), i), F.get(F.col("titles"), i), i, F.col("facts"),
                F.get(F.col("to_user"), i), F.get(F.col("to_local"), i)).alias("confidence"),
            (-i).alias("place"), p["profile"].alias("profile"))

    return compared.withColumn("best", F.array_max(F.transform("found", confidence)))


def compact_each(titles: Column) -> Column:
    """Compact keys of an array of short texts, folded as one text of one word per title."""
    words = F.transform(titles, lambda t: F.concat(F.lit("t"), F.regexp_replace(t, f"[{SPACE}]+", "")))
    folded = F.split(fold_words(F.array_join(words, " ")), " ")
    return F.transform(folded, lambda w: F.substring(w, 2, 1 << 30))


def _answered(queries: DataFrame, found: DataFrame) -> DataFrame:
    """Queries with their result row.

    Very many leads may share a query, the first one of a generic mailbox for example: such queries are measured and their
    leads spread. Leads without a query match nothing and are spread as well.
    """
    keyed = queries.withColumn("_query", F.coalesce("query", F.concat(F.lit("#"), F.col("lead_id"))))
    answers = found.select(F.col("query").alias("_query"), "failed", "found")
    return skewed_join(keyed, answers, "_query", "lead_id").drop("_query")


def find_profiles(leads: DataFrame, results: DataFrame, params: Params) -> DataFrame:
    """``(lead_id, url, status, query, confidence)``: the chosen profile of every lead.

    The second query of a lead counts only when the first one did not reach the wanted confidence.
    """
    scored = score_results(_answered(lookup_queries(leads), profiles_in_results(results)))
    failed = F.coalesce("failed", F.lit(True)) & F.col("query").isNotNull()
    tried = scored.select(
        "lead_id", "query_no", "query", "first_query", failed.alias("failed"),
        F.when(~failed & (F.col("best.confidence") > 0), F.col("best")).alias("best"))
    # at most two rows per lead
    per_lead = tried.groupBy("lead_id").agg(
        F.min("first_query").alias("first_query"),
        F.bool_and(F.col("query").isNull()).alias("skipped"),
        F.max(F.when(F.col("query_no") == 0, F.struct("best.confidence", "best.profile", "query", "failed"))).alias("one"),
        F.max(F.when(F.col("query_no") == 1, F.struct("best.confidence", "best.profile", "query", "failed"))).alias("two"))
    zero = F.lit(0.0)
    one, two = F.coalesce("one.confidence", zero), F.coalesce("two.confidence", zero)
    wanted = F.lit(params.min_match_confidence)
    use_two = (one < wanted) & (two > one)
    best = F.when(use_two, two).otherwise(one)
    chosen = F.when(use_two, F.col("two.profile")).otherwise(F.col("one.profile"))
    query = F.when(use_two, F.col("two.query")).otherwise(F.col("first_query"))
    errors = F.coalesce("one.failed", F.lit(False)) | ((one < wanted) & F.coalesce("two.failed", F.lit(False)))
    found = best >= wanted
    error = errors & chosen.isNull()
    status = (F.when(F.col("skipped"), k.SKIPPED).when(found, k.FOUND)
              .when(error, k.SEARCH_ERROR).otherwise(k.NOT_FOUND))
    return per_lead.select(
        "lead_id", F.when(found, chosen).otherwise("").alias("url"), status.alias("status"),
        F.when(F.col("skipped"), "").when(error, F.col("first_query")).otherwise(query).alias("query"),
        F.round(F.when(F.col("skipped") | error, zero).otherwise(best), 3).alias("confidence"))


def split_by_cache(leads: DataFrame, cache: DataFrame, params: Params, order: str = "ord") -> DataFrame:
    """Leads with ``fresh`` and the cached answer; the cache has one row per email.

    Leads without an address match nothing; a key of their own, from the unique column ``order``,
    spreads them over the tasks.
    """
    from leadloom.functions.dates import within_days

    named = cache.select(
        F.col("email").alias("c_email"), F.col("url").alias("c_url"), F.col("status").alias("c_status"),
        F.col("query").alias("c_query"), "checked_at")
    known = F.col("c_email").isNotNull()
    recent = within_days(F.col("checked_at"), params.cache_ttl_days, params, inclusive=True)
    blank_key = F.concat(F.lit("#"), F.col(order))
    keyed = leads.withColumn("_key", F.when(blank(F.col("email")) == "", blank_key).otherwise(F.col("email")))
    joined = skewed_join(keyed, named.withColumn("_key", F.col("c_email")), "_key", order).drop("_key")
    return joined.withColumn(
        "fresh", known & ((blank(F.col("c_url")) != "") | recent)).drop("c_email", "checked_at")


def backfill_candidates(leads: DataFrame, cache: DataFrame, params: Params, order: str = "row_no") -> DataFrame:
    """Stored leads with ``action``: ``lookup`` for those to search now, ``cached`` for those that
    take a cached profile, null for the rest. Rows after the last lookup of a limited run stay as
    they are."""
    wanted = ((strip(blank(F.col("email"))) != "") & (strip(blank(F.col("email_status"))) == k.VERIFIED)
              & (strip(blank(F.col("instagram_url"))) == ""))
    looked = split_by_cache(leads, cache, params, order)
    action = (F.when(wanted & ~F.col("fresh"), "lookup")
              .when(wanted & (blank(F.col("c_url")) != ""), "cached"))
    marked = looked.withColumn("action", action)
    if params.backfill_limit is None:
        return marked
    chosen = first_rows(marked.filter("action = 'lookup'").select(order), params.backfill_limit, order)
    # where the limited run stops (null when it does not)
    stop = chosen.agg(F.when(F.count(F.lit(1)) >= params.backfill_limit, F.max(order))).scalar()
    stopped = marked.withColumn("_stop", stop)
    inside = F.col("_stop").isNull() | (F.col(order) <= F.col("_stop"))
    return stopped.withColumn("action", F.when(inside, F.col("action"))).drop("_stop")
