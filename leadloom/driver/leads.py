"""Queries on scoring, merging, views and statistics."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from leadloom.driver.adapters import (
    MERGED_FIELDS, MERGED_SQL, PARAMS, SCORED_SQL, STORED_SQL, customer_candidates, iso, order_leads, stored_leads,
)
from leadloom.driver.registry import query, table
from leadloom.functions.qualification import SIGNALS, score_candidates
from leadloom.operators.merge import merge_counts, merge_leads, table_order, verified_only
from leadloom.operators.order import first_rows, with_position
from leadloom.plans.harvest import qualified
from leadloom.plans.report import with_ratios, with_run_status
from leadloom.plans.views import counts_by_dimension, hot_view, lead_counts, no_email_view, sorted_hot_view, sorted_no_email_view
from leadloom.sources.tables import from_display, headers, to_display


def _scored(spark, sf_dir):
    return score_candidates(customer_candidates(spark, sf_dir), PARAMS)


@query("lead_score", f"""
WITH {SCORED_SQL}
SELECT c_custkey, CAST(score AS INT) AS score, classification, content_type, caption_opportunity FROM classed""")
def lead_score(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        F.col("ord").alias("c_custkey"), "score", "classification", "content_type", "caption_opportunity")


@query("lead_signals", f"""
WITH {SCORED_SQL}
SELECT c_custkey, s1 AS target_niche, s2 AS target_language, s3 AS target_country, s4 AS audience_fit, s5 AS recent_activity,
       s6 AS content_fit, s7 AS caption_opportunity, s8 AS public_website, s9 AS commercial_creator FROM classed""")
def lead_signals(spark, sf_dir):
    return _scored(spark, sf_dir).select(F.col("ord").alias("c_custkey"), *[
        F.coalesce(F.col("signals")[s], F.lit(0)).alias(s) for s in SIGNALS])


@query("lead_hot", f"""
WITH {SCORED_SQL}
SELECT name, website, niche, CAST(score AS INT) AS score, language, country, 'CUSTOMER' AS source FROM classed
WHERE score >= 55 AND classification = 'HOT'""")
def lead_hot(spark, sf_dir):
    kept = _scored(spark, sf_dir).filter(F.col("score") >= PARAMS.min_score).filter(F.col("classification") == "HOT")
    return kept.select("name", "website", "niche", "score", "language", "country", "source")


@query("lead_reasons", f"""
WITH {SCORED_SQL},
long AS (
  SELECT c_custkey, unnest([s1, s2, s3, s4, s5, s6, s7, s8, s9]) AS v,
         unnest(['target niche', 'target language', 'target country', 'audience fit', 'recent activity', 'content fit',
                 'caption opportunity', 'public website', 'commercial creator']) AS label,
         unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS pos FROM classed),
top AS (
  SELECT c_custkey, string_agg(label, ', ' ORDER BY rn) AS why FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY v DESC, pos) AS rn FROM long WHERE v >= 8) WHERE rn <= 5 GROUP BY 1)
SELECT c.c_custkey, coalesce(why, 'limited public qualification signals') AS why_qualified FROM classed c LEFT JOIN top USING (c_custkey)""")
def lead_reasons(spark, sf_dir):
    return _scored(spark, sf_dir).select(F.col("ord").alias("c_custkey"), "why_qualified")


def _merged(spark, sf_dir):
    return merge_leads(stored_leads(spark, sf_dir), order_leads(spark, sf_dir))


@query("lead_upsert", f"WITH {MERGED_SQL} SELECT {', '.join(MERGED_FIELDS)} FROM merged")
def lead_upsert(spark, sf_dir):
    return _merged(spark, sf_dir).select(*MERGED_FIELDS)


@query("upsert_counts", f"""
WITH {MERGED_SQL}
SELECT count(*) FILTER (row_no IS NULL) AS new_leads,
       CAST(sum(coalesce(n, 0)) AS BIGINT) - count(*) FILTER (row_no IS NULL) AS updated_leads, count(*) AS total_leads FROM merged""")
def upsert_counts(spark, sf_dir):
    return merge_counts(_merged(spark, sf_dir))


@query("upsert_verified_only", f"""
WITH {MERGED_SQL.replace("FROM documents d LEFT JOIN labels USING (doc_id)", "FROM documents d LEFT JOIN labels USING (doc_id) WHERE quality = 1")
      .replace("FROM supplier)", "FROM supplier WHERE false)").replace("FROM orders)", "FROM orders WHERE o_totalprice > 150000)")}
SELECT {', '.join(MERGED_FIELDS)} FROM merged""")
def upsert_verified_only(spark, sf_dir):
    merged = merge_leads(verified_only(stored_leads(spark, sf_dir)), verified_only(order_leads(spark, sf_dir)))
    return merged.select(*MERGED_FIELDS)


@query("lead_order", f"""
WITH {MERGED_SQL}
SELECT lead_id, row_number() OVER (ORDER BY discovered_at DESC, row_no NULLS LAST, first_ord) - 1 AS row_no FROM merged""")
def lead_order(spark, sf_dir):
    return with_position(_merged(spark, sf_dir), table_order(), "row_no").select("lead_id", "row_no")


@query("hot_view", f"""
WITH {STORED_SQL}
SELECT name, email, '' AS profile_url, '' AS website, niche, lead_score, language, country, email_status, source
FROM stored WHERE upper(classification) = 'HOT'""")
def hot_view_query(spark, sf_dir):
    return hot_view(stored_leads(spark, sf_dir))


@query("hot_view_order", f"""
WITH {STORED_SQL}
SELECT name, row_number() OVER (ORDER BY CAST(email_status = 'VERIFIED_PUBLIC_SOURCE' AS INT) DESC, lead_score DESC, row_no) - 1 AS pos
FROM stored WHERE upper(classification) = 'HOT'""")
def hot_view_order(spark, sf_dir):
    hot = sorted_hot_view(stored_leads(spark, sf_dir)).withColumn("line", F.monotonically_increasing_id())  # rises with the sort
    return with_position(hot, [F.col("line")]).select("name", "pos")


@query("no_email_order", f"""
WITH {STORED_SQL}
SELECT name, row_number() OVER (ORDER BY lead_score DESC, row_no) - 1 AS pos FROM stored WHERE trim(email) = ''""")
def no_email_order(spark, sf_dir):
    rows = sorted_no_email_view(stored_leads(spark, sf_dir)).withColumn("line", F.monotonically_increasing_id())
    return with_position(rows, [F.col("line")]).select("name", "pos")


@query("lead_limit", f"""
WITH {SCORED_SQL}, first AS (SELECT * FROM classed ORDER BY c_custkey LIMIT 120)
SELECT c_custkey, CAST(score AS INT) AS score FROM (SELECT * FROM first WHERE score >= 55 ORDER BY c_custkey LIMIT 40)""")
def lead_limit(spark, sf_dir):
    """The leads of a limited run: the first candidates are scored, the first leads kept."""
    limited = replace(PARAMS, target_leads=40)
    taken = qualified(customer_candidates(spark, sf_dir), limited)
    return first_rows(taken, limited.target_leads, "ord").select(F.col("ord").alias("c_custkey"), "score")


@query("no_email_view", f"""
WITH {STORED_SQL}
SELECT name, '' AS profile_url, '' AS website, niche, lead_score, language, country, source, '' AS why_qualified
FROM stored WHERE trim(email) = ''""")
def no_email_view_query(spark, sf_dir):
    return no_email_view(stored_leads(spark, sf_dir))


@query("lead_stats", f"""
WITH {STORED_SQL}, c AS (
  SELECT count(*) AS a, count(*) FILTER (left(discovered_at, 10) = '2001-02-01') AS b, count(*) FILTER (upper(classification) = 'HOT') AS c,
         count(*) FILTER (trim(email) <> '') AS d, count(*) FILTER (email_status = 'VERIFIED_PUBLIC_SOURCE') AS e,
         count(*) FILTER (trim(instagram_url) <> '') AS f, count(*) FILTER (upper(status) = 'CONTACTED') AS g,
         count(*) FILTER (upper(outreach_status) = 'SENT') AS h, count(*) FILTER (trim(email) = '') AS i FROM stored)
SELECT unnest(['TOTAL LEADS', 'NEW TODAY', 'HOT LEADS', 'EMAILS FOUND', 'VERIFIED EMAILS', 'INSTAGRAM FOUND', 'CONTACTED', 'OUTREACH SENT', 'NO EMAIL']) AS metric,
       unnest([a, b, c, d, e, f, g, h, i]) AS value FROM c""")
def lead_stats(spark, sf_dir):
    return lead_counts(stored_leads(spark, sf_dir), "2001-02-01T08:00:00+00:00").select("metric", "value")


@query("lead_stats_by_dim", f"""
WITH {STORED_SQL}, long AS (
  SELECT 'source' AS dimension, coalesce(nullif(source, ''), 'UNKNOWN') AS value, row_no FROM stored
  UNION ALL SELECT 'niche', coalesce(nullif(niche, ''), 'UNKNOWN'), row_no FROM stored
  UNION ALL SELECT 'language', coalesce(nullif(language, ''), 'UNKNOWN'), row_no FROM stored
  UNION ALL SELECT 'country', coalesce(nullif(country, ''), 'UNKNOWN'), row_no FROM stored),
counted AS (SELECT dimension, value, count(*) AS leads, min(row_no) AS first FROM long GROUP BY 1, 2)
SELECT dimension, value, leads, CAST(place AS INT) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY leads DESC, first) AS place FROM counted) WHERE place <= 15""")
def lead_stats_by_dim(spark, sf_dir):
    return counts_by_dimension(stored_leads(spark, sf_dir))


@query("widened_leads", f"""
WITH {STORED_SQL}
SELECT row_no, lead_id, coalesce(CAST(followers AS VARCHAR), '') AS followers_text, followers, lead_score, instagram_status, '' AS outreach_status, 32 AS n_columns FROM stored""")
def widened_leads(spark, sf_dir):
    """Display columns of a table stored before the last six columns existed, widened and typed again."""
    leads = stored_leads(spark, sf_dir)
    shown = to_display(leads, PARAMS)
    short = shown.select(*headers(PARAMS)[:26])
    typed = from_display(short, PARAMS)
    text = shown.select(F.col("`Lead ID`").alias("lead_id"), F.col("`Followers/Subscribers`").alias("followers_text"))
    order = leads.select("lead_id", "row_no")
    return (typed.join(text, "lead_id").join(order, "lead_id")
            .select("row_no", "lead_id", "followers_text", "followers", "lead_score", "instagram_status", "outreach_status",
                    F.lit(len(typed.columns)).alias("n_columns")))


@query("run_report", """
WITH run AS (
  SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'view') AS youtube_search_requests,
         count(*) FILTER (event_type = 'signup') AS qualified, count(*) FILTER (event_type = 'click') AS websites_crawled,
         count(*) FILTER (event_type = 'purchase') AS verified_emails, count(DISTINCT user_id) AS instagram_lookups,
         count(*) FILTER (value > 30) AS instagram_found, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS day, youtube_search_requests, qualified, errors,
       round(qualified / greatest(1, youtube_search_requests), 3) AS qualified_per_youtube_search,
       round(verified_emails / greatest(1, websites_crawled), 3) AS verified_emails_per_website,
       round(instagram_found / greatest(1, instagram_lookups), 3) AS instagram_found_per_lookup,
       'EMAIL_FIRST_VERIFIED_ONLY' AS mode, CASE WHEN errors > 0 THEN 'SUCCESS_WITH_WARNINGS' ELSE 'SUCCESS' END AS run_status FROM run""")
def run_report_query(spark, sf_dir):
    def events_of(kind):
        return F.count_if(F.col("event_type") == kind)

    run = table(spark, sf_dir, "events").groupBy(F.substring(iso(F.col("ts")), 1, 10).alias("day")).agg(
        events_of("view").alias("youtube_search_requests"), events_of("signup").alias("qualified"),
        events_of("click").alias("websites_crawled"), events_of("purchase").alias("verified_emails"),
        F.countDistinct("user_id").alias("instagram_lookups"), F.count_if(F.col("value") > 30).alias("instagram_found"),
        events_of("error").alias("errors"))
    return with_run_status(with_ratios(run)).select(
        "day", "youtube_search_requests", "qualified", "errors", "qualified_per_youtube_search",
        "verified_emails_per_website", "instagram_found_per_lookup", "mode", "run_status")
