"""Queries on profile matching, backfill and the whole run."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.driver.adapters import PARAMS, SCORED_SQL, STORED_SQL, customer_candidates, stored_leads, stored_pages
from leadloom.driver.registry import query, table
from leadloom.driver.text import emails_sql
from leadloom.operators.match import backfill_candidates, find_profiles, lookup_queries
from leadloom.plans.harvest import Inputs, harvest


def _customer_leads(spark, sf_dir):
    """Customers with an address of their own, or a shared ``contact`` address for one segment."""
    local = F.when(F.col("c_mktsegment") == "BUILDING", "contact").otherwise(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("lead_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "none").otherwise(F.concat(local, F.lit("@shop.test"))).alias("email"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") < 5, F.concat(F.lit("@u"), F.col("c_custkey"), F.lit("_own"))).otherwise("UNKNOWN").alias("username"))


@query("lookup_queries", """
WITH base AS (
  SELECT c_custkey AS lead_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'contact' ELSE lower(replace(c_name, '#', '.')) END AS local,
         CASE WHEN c_nationkey < 5 THEN 'u' || c_custkey || '_own' ELSE 'unknown' END AS identity, c_mktsegment FROM customer)
SELECT lead_id, 0 AS query_no, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE local || ' instagram' END AS query FROM base
UNION ALL SELECT lead_id, 1, local || ' ' || identity || ' instagram' FROM base WHERE c_mktsegment = 'BUILDING'""")
def lookup_queries_query(spark, sf_dir):
    return lookup_queries(_customer_leads(spark, sf_dir)).select("lead_id", "query_no", "query")


def _results(spark, sf_dir):
    """Search answers for the customers' queries: their own profile, a stranger's, or a failure.

    Households find their own handle first, machinery is never searched, automobile customers find
    only a stranger, furniture searches fail. The shared ``contact`` query finds a stranger; the
    queries that add a user name find that user.
    """
    customer = table(spark, sf_dir, "customer")
    handle = F.replace(F.lower("c_name"), F.lit("#"), F.lit("."))
    stranger = F.lit('<a href="https://www.instagram.com/zz/">Somebody Else</a>')

    def link(name, title):
        return F.concat(F.lit('<a class="r" href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fwww.instagram.com%2F'), name,
                        F.lit('%2F">'), title, F.lit("</a>"))

    own = customer.filter("c_mktsegment NOT IN ('BUILDING', 'MACHINERY')").select(
        F.concat(handle, F.lit(" instagram")).alias("query"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(None)).when(
            F.col("c_mktsegment") == "AUTOMOBILE", stranger).otherwise(F.concat(stranger, link(handle, F.lit("Other &amp; Title")))).alias("html"))
    named = customer.filter("c_mktsegment = 'BUILDING' AND c_nationkey < 5").select(
        F.concat(F.lit("contact u"), F.col("c_custkey"), F.lit("_own instagram")).alias("query"),
        F.concat(stranger, link(F.concat(F.lit("u"), F.col("c_custkey"), F.lit("_own")), F.lit("Mine"))).alias("html"))
    shared = customer.filter("c_mktsegment = 'BUILDING'").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("contact instagram").alias("query"), stranger.alias("html"))
    return own.unionByName(named).unionByName(shared).withColumn("failed", F.col("html").isNull())


@query("handle_match", """
WITH base AS (
  SELECT c_custkey AS lead_id, lower(replace(c_name, '#', '.')) AS handle, c_mktsegment AS m, c_nationkey < 5 AS named FROM customer)
SELECT lead_id,
  CASE WHEN m = 'MACHINERY' THEN 'SKIPPED_INVALID_EMAIL' WHEN m = 'HOUSEHOLD' THEN 'FOUND_SEARCH_RESULT' WHEN m = 'FURNITURE' THEN 'SEARCH_ERROR'
       WHEN m = 'BUILDING' AND named THEN 'FOUND_SEARCH_RESULT' ELSE 'NOT_FOUND' END AS status,
  CASE WHEN m = 'HOUSEHOLD' THEN 'https://www.instagram.com/' || handle || '/'
       WHEN m = 'BUILDING' AND named THEN 'https://www.instagram.com/u' || lead_id || '_own/' ELSE '' END AS url,
  CASE WHEN m = 'MACHINERY' THEN '' WHEN m = 'BUILDING' AND named THEN 'contact u' || lead_id || '_own instagram'
       WHEN m = 'BUILDING' THEN 'contact instagram' ELSE handle || ' instagram' END AS query,
  CASE WHEN m = 'MACHINERY' OR m = 'FURNITURE' THEN 0.0 WHEN m = 'HOUSEHOLD' THEN 1.0 WHEN m = 'BUILDING' AND named THEN 0.99 ELSE 0.18 END::DOUBLE AS confidence
FROM base""")
def handle_match(spark, sf_dir):
    return find_profiles(_customer_leads(spark, sf_dir), _results(spark, sf_dir), PARAMS)


@query("similar_handles")
def similar_handles(spark, sf_dir):
    """Customers whose search finds misspelt handles; similarity has no SQL form."""
    leads = _customer_leads(spark, sf_dir).filter("email <> 'none'")
    queries = lookup_queries(leads).filter("query_no = 0").select("query").distinct()
    digits = F.regexp_extract("query", "([0-9]+)", 1)
    results = queries.withColumn("html", F.concat(
        F.lit('<a href="https://www.instagram.com/custmer.'), F.substring(digits, 2, 9), F.lit('/">x</a><a href="https://instagram.com/cust'),
        digits, F.lit('/">y</a>'))).withColumn("failed", F.lit(False))
    return find_profiles(leads, results, PARAMS)


@query("backfill_choice", f"""
WITH {STORED_SQL}, cache AS (SELECT DISTINCT 'd' || user_id || '@site.test' AS email, user_id < 40 AS has_url FROM events),
marked AS (
  SELECT s.row_no, CASE WHEN trim(s.email) = '' OR email_status <> 'VERIFIED_PUBLIC_SOURCE' OR instagram_url <> '' THEN NULL
         WHEN c.email IS NULL THEN 'lookup' WHEN has_url THEN 'cached' ELSE NULL END AS action FROM stored s LEFT JOIN cache c USING (email))
SELECT row_no, action FROM marked""")
def backfill_choice(spark, sf_dir):
    cache = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("d"), F.col("user_id"), F.lit("@site.test")).alias("email"),
        F.when(F.col("user_id") < 40, "https://www.instagram.com/known/").otherwise("").alias("url"),
        F.lit("NOT_FOUND").alias("status"), F.lit("q").alias("query"), F.lit(0.9).alias("confidence"), F.lit(PARAMS.as_of).alias("checked_at"))
    return backfill_candidates(stored_leads(spark, sf_dir), cache, PARAMS).select("row_no", "action")


_HARVEST_FIELDS = ["lead_id", "discovered_at", "source", "name", "website", "email", "email_status", "email_source_url", "niche", "country",
                   "language", "followers", "content_type", "caption_opportunity", "lead_score", "classification", "status", "instagram_status"]


@query("harvest_leads", f"""
WITH {SCORED_SQL}, {emails_sql('documents', 'doc_id', 'text')},
best AS (SELECT doc_id, email FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY preference DESC, i) AS rn FROM ranked) WHERE rn = 1),
firsts AS (SELECT *, row_number() OVER (PARTITION BY website ORDER BY c_custkey) AS rn FROM classed)
SELECT substring(sha256('CUSTOMER:' || c_custkey), 1, 24) AS lead_id, '2001-08-01T00:00:00+00:00' AS discovered_at, 'CUSTOMER' AS source, name, website,
       coalesce(email, '') AS email, CASE WHEN email IS NULL THEN 'UNKNOWN' ELSE 'VERIFIED_PUBLIC_SOURCE' END AS email_status,
       CASE WHEN email IS NULL THEN '' ELSE website END AS email_source_url, niche, country, language, followers, content_type, caption_opportunity,
       CAST(score AS INT) AS lead_score, classification, 'NEW' AS status, 'NOT_CHECKED' AS instagram_status
FROM firsts LEFT JOIN best ON doc_id = c_custkey WHERE (website = '' OR rn = 1) AND score >= 55""")
def harvest_leads(spark, sf_dir):
    """The whole run over all customers, with the pages as sites and no search answers."""
    candidates = customer_candidates(spark, sf_dir)
    return harvest(Inputs(candidates, stored_pages(spark, sf_dir)), PARAMS).leads.select(*_HARVEST_FIELDS)
