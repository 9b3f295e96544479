"""The whole run: candidates -> dedup -> score -> addresses -> profile -> merge -> views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import NOT_CHECKED, NOT_FOUND
from leadloom.functions.ids import stable_id
from leadloom.functions.qualification import score_candidates
from leadloom.functions.text import blank, filled
from leadloom.functions.urls import canonical_domain
from leadloom.operators.best import best_emails
from leadloom.operators.checkpoints import cut, written
from leadloom.operators.counters import Counters
from leadloom.operators.dedup import dedup_candidates
from leadloom.operators.match import find_profiles, split_by_cache
from leadloom.operators.merge import merge_counts, merge_leads, table_order, verified_only
from leadloom.operators.order import first_rows
from leadloom.operators.sites import best_site_email, parse_placed_pages, place_pages, site_emails, visit_sites
from leadloom.params import Params
from leadloom.plans.report import with_ratios, with_run_status
from leadloom.schemas import CACHE_DDL, LEAD_COLUMNS, LEAD_FIELDS


@dataclass(frozen=True)
class Inputs:
    """Stored inputs of a run; pages, search results and cache may be missing.

    Pages that come from a page index know their ``page`` and ``domain``.
    """

    candidates: DataFrame
    pages: DataFrame | None = None
    results: DataFrame | None = None
    cache: DataFrame | None = None


@dataclass(frozen=True)
class Harvest:
    """Results of a run before it is stored."""

    unique: DataFrame
    leads: DataFrame
    answers: DataFrame
    visits: DataFrame | None
    #: the qualified candidates: ``source, provider_id, site_domain, website, email``
    processed: DataFrame
    #: counters that are taken while the plan runs
    counters: list[Counters]


def qualified(unique: DataFrame, params: Params) -> DataFrame:
    """Scored candidates that reach the minimum score (a limited run scores its first rows only)."""
    taken = first_rows(unique, None if params.target_leads is None else params.target_leads * 3, "ord")
    return score_candidates(taken, params).filter(F.col("score") >= params.min_score)


def with_site_domain(scored: DataFrame, params: Params) -> DataFrame:
    """Add ``site_domain`` for candidates whose site is visited in this run, else null."""
    domain = F.when(blank(F.col("website")) != "", F.nullif(canonical_domain(F.col("website")), F.lit("")))
    placed = scored.withColumn("site_domain", domain)
    if params.max_enrichments is None and params.max_websites is None:
        return placed
    limits = [x for x in (params.max_enrichments, params.max_websites) if x is not None]
    first = first_rows(placed.filter("site_domain IS NOT NULL").select("ord"), min(limits), "ord")
    visited = first.withColumn("_visited", F.lit(True))
    return placed.join(visited, "ord", "left").withColumn(
        "site_domain", F.when(F.col("_visited"), F.col("site_domain"))).drop("_visited")


def _no_sites(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "domain STRING, site_email STRING, site_email_url STRING, site_preference INT")


def _answers(leads: DataFrame, inputs: Inputs, params: Params) -> tuple[DataFrame, DataFrame]:
    """Leads with profile columns, and the new cache rows of this run."""
    spark = leads.sparkSession
    cache = inputs.cache if inputs.cache is not None else spark.createDataFrame([], CACHE_DDL)
    # written before the search for frequent addresses, so that what made the leads runs once; texts have been scored by now
    named = written(leads.drop("raw_text", "signals"))
    looked = split_by_cache(named, cache, params)
    open_leads = looked.filter((F.col("email") != "") & ~F.col("fresh"))
    if inputs.results is None:
        found = spark.createDataFrame([], "lead_id STRING, url STRING, status STRING, query STRING, confidence DOUBLE")
    else:
        found = cut(find_profiles(
            open_leads.select(F.col("ord").alias("lead_id"), "email", "name", "username"), inputs.results, params))
    renamed = found.select(F.col("lead_id").alias("_ord"), F.col("url").alias("f_url"),
                           F.col("status").alias("f_status"), F.col("query").alias("f_query"), "confidence")
    joined = looked.join(renamed, looked["ord"] == F.col("_ord"), "left")
    cached = F.col("fresh") & (F.col("email") != "")

    def pick(field: str, default: str) -> Column:
        return F.coalesce(F.when(cached, F.col(f"c_{field}")).otherwise(F.col(f"f_{field}")), F.lit(default))

    status = F.when(cached, F.coalesce("c_status", F.lit(NOT_FOUND))).otherwise(F.coalesce("f_status", F.lit(NOT_CHECKED)))
    done = joined.withColumns({
        "instagram_url": pick("url", ""), "instagram_status": status,
        "instagram_search_query": pick("query", "")})
    new = joined.filter("_ord IS NOT NULL").groupBy("email").agg(
        F.max_by(F.struct("f_url", "f_status", "f_query", "confidence"), "ord").alias("r"))
    answers = new.select(
        "email", F.col("r.f_url").alias("url"), F.col("r.f_status").alias("status"),
        F.col("r.f_query").alias("query"), F.col("r.confidence").alias("confidence"),
        F.lit(params.as_of).alias("checked_at"))
    return done, answers


def harvest(inputs: Inputs, params: Params) -> Harvest:
    """Turn candidates into leads. Only the dedup, the site visits and the cuts run eagerly.

    Counters are observed on the plan itself, so they cost no pass of their own.
    """
    every = F.count(F.lit(1))
    counters = [Counters(candidates_found=every), Counters(unique_candidates=every), Counters(qualified=every)]
    unique = dedup_candidates(inputs.candidates, counters=counters[0])
    scored = qualified(counters[1].of(unique), params)
    placed = with_site_domain(counters[2].of(scored), params)
    visits = None
    site_best = _no_sites(placed)
    if inputs.pages is not None:
        placed = cut(placed)
        known = {"page", "domain"} <= set(inputs.pages.columns)
        sites = placed.filter("site_domain IS NOT NULL").select(F.col("site_domain").alias("domain"))
        pages = inputs.pages if known else place_pages(inputs.pages)
        visits = visit_sites(parse_placed_pages(pages, params, sites), params)
        site_best = best_site_email(site_emails(visits))
    mailed = best_emails(placed, site_best, params).withColumn("website", F.when(
        F.col("site_domain").isNotNull(), F.concat(F.lit("https://"), F.col("site_domain"))).otherwise(F.col("website")))
    done, answers = _answers(mailed, inputs, params)
    now = F.lit(params.as_of)
    values = {
        "lead_id": stable_id(F.col("email")), "discovered_at": now, "last_checked": now,
        "lead_score": F.col("score"), "website": blank(F.col("website")), "profile_url": blank(F.col("profile_url")),
        **{c: filled(F.col(c)) for c in ("name", "username", "platform", "niche", "country", "language", "recent_activity")},
    }
    defaults = {name: default for name, _, default in LEAD_COLUMNS}
    leads = done.select("ord", *[
        (values[c] if c in values else F.col(c) if c in done.columns else F.lit(defaults[c])).alias(c)
        for c in LEAD_FIELDS])
    processed = done.select("source", "provider_id", "site_domain", "website", "email")
    return Harvest(unique, first_rows(leads, params.target_leads, "ord"), answers, visits, processed, counters)


def store(stored: DataFrame, leads: DataFrame, params: Params, path: str) -> DataFrame:
    """Merge leads into the stored table, write the new table to ``path``, return the counts."""
    from leadloom.sources.tables import write_leads

    old, new = (verified_only(stored), verified_only(leads)) if params.email_first else (stored, leads)
    merged = cut(merge_leads(old, new))
    write_leads(merged, table_order(), path)
    return merge_counts(merged)


def run_report(inputs: Inputs, result: Harvest, counts: DataFrame, params: Params, run_id: str,
               errors: int = 0) -> DataFrame:
    """One row of run counters with the ratios.

    Each counter is a scalar of one aggregate, so tables of any size give a single row.
    """
    def total(df: DataFrame | None, condition: Column | None = None):
        if df is None:
            return F.lit(0).cast("bigint")
        return df.agg(F.count(F.lit(1)) if condition is None else F.count_if(condition)).scalar()

    mail = F.col("email") != ""
    row = counts.select(
        F.lit(run_id).alias("run_id"), F.lit(params.as_of).alias("started_at"),
        F.date_format(F.timestamp_micros(F.unix_micros(F.current_timestamp())), "yyyy-MM-dd'T'HH:mm:ss").alias("finished_at"),
        total(inputs.candidates).alias("candidates_found"), total(result.unique).alias("unique_candidates"),
        total(result.leads).alias("qualified"), "new_leads", "updated_leads",
        total(result.leads, mail).alias("emails_found"),
        total(result.leads, F.col("email_status") == "VERIFIED_PUBLIC_SOURCE").alias("verified_emails"),
        total(result.answers).alias("instagram_lookups"),
        total(result.answers, F.col("url") != "").alias("instagram_found"),
        total(None if result.visits is None else result.visits.select("domain").distinct()).alias("websites_crawled"),
        F.lit(0).cast("bigint").alias("youtube_requests"), F.lit(0).cast("bigint").alias("youtube_search_requests"),
        F.lit(errors).cast("bigint").alias("errors"))
    full = row.withColumns({
        "duplicates_prevented": F.col("candidates_found") - F.col("unique_candidates"),
        "duration": F.lit(0.0)})
    rated = with_ratios(full)
    return with_run_status(rated) if params.email_first else rated


def channel_state(stored: DataFrame, unique: DataFrame, params: Params) -> DataFrame:
    """Last-checked time per channel after a run."""
    from leadloom.operators.state import latest_checked

    seen = unique.filter((F.col("source") == "YOUTUBE") & (F.col("provider_id") != "")).select(
        F.col("provider_id").alias("channel_id"), F.lit(params.as_of).alias("checked_at"))
    return latest_checked(stored, seen, "channel_id")
