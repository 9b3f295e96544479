"""Queries on stored tables: the bucketed lead store, committed runs, streams with state, discovery."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from leadloom.driver.adapters import (
    EVENTS_AS_OF, MERGED_FIELDS, MERGED_SQL, PARAMS, SCORED_SQL, customer_candidates, iso, order_leads, stored_leads,
)
from leadloom.driver.registry import query, table
from leadloom.driver.sources import VISIT_PARAMS, _visit_rounds, linked_pages
from leadloom.driver.state import NOW, _cache, _failures_of
from leadloom.operators.checkpoints import checkpoint_dir, written
from leadloom.operators.order import with_position
from leadloom.operators.state import first_seen
from leadloom.params import Params
from leadloom.plans.discovery import discovery_round as next_round
from leadloom.plans.harvest import Inputs, harvest
from leadloom.plans.runs import Runs, run
from leadloom.plans.views import stats_lines
from leadloom.schemas import candidates_from
from leadloom.sources.page_index import add_pages, page_index
from leadloom.sources.store import lead_store, merge_store, newest_first, start_store, store_order
from leadloom.streaming.failures import read_queues, stream_queues
from leadloom.streaming.incremental import read_candidate_stream, stream_leads
from leadloom.streaming.lookups import read_lookups, stream_lookups

BUCKETS = 8  # of the small tables of these queries
SET_FILES = 4  # of a set of candidate files


def _folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _store(spark, sf_dir):
    store = lead_store(_folder(spark, "store"), BUCKETS)
    start_store(store, stored_leads(spark, sf_dir))
    return store


@query("store_merge", f"""
WITH {MERGED_SQL}
SELECT {', '.join(MERGED_FIELDS)}, row_number() OVER (ORDER BY discovered_at DESC, row_no NULLS LAST, first_ord) - 1 AS row_no FROM merged""")
def store_merge(spark, sf_dir):
    """The stored table in buckets after a merge, in its order."""
    store = _store(spark, sf_dir)
    merge_store(spark, store, order_leads(spark, sf_dir), PARAMS)
    return with_position(store.read(spark), store_order(), "row_no").select(*MERGED_FIELDS, "row_no")


@query("store_twice", f"""
WITH {MERGED_SQL}, c AS (
  SELECT count(*) FILTER (row_no IS NULL) AS new, CAST(sum(coalesce(n, 0)) AS BIGINT) AS folded, count(*) AS total FROM merged)
SELECT 1 AS round, new AS new_leads, folded - new AS updated_leads, total AS total_leads FROM c UNION ALL SELECT 2, 0, folded, total FROM c""")
def store_twice(spark, sf_dir):
    """The counts of merging a batch, and of merging it again."""
    store, batch = _store(spark, sf_dir), order_leads(spark, sf_dir)
    counts = [merge_store(spark, store, batch, PARAMS) for _ in range(2)]
    return spark.createDataFrame([(i + 1, *c.values()) for i, c in enumerate(counts)],
                                 "round INT, new_leads BIGINT, updated_leads BIGINT, total_leads BIGINT")


def _own_sites(spark, sf_dir):
    """Customers as candidates, each with a site of its own and a text without addresses."""
    site = F.when(F.col("website") != "", F.concat(F.lit("https://s"), F.col("ord"), F.lit(".example.com"))).otherwise("")
    return customer_candidates(spark, sf_dir).withColumns({
        "website": site, "raw_text": F.translate("raw_text", "@&", "  ")})


_OWN_SITES_SQL = (SCORED_SQL.replace("'https://' || source || '.example.com'", "'https://s' || c_custkey || '.example.com'")
                  .replace("coalesce(text, '') AS raw_text", "translate(coalesce(text, ''), '@&', '  ') AS raw_text"))


@query("stream_leads_query", f"""
WITH {_OWN_SITES_SQL}
SELECT name, website, niche, country, language, followers, CAST(score AS INT) AS lead_score, classification, '' AS email, 'NEW' AS status,
       '{PARAMS.as_of}' AS discovered_at FROM classed WHERE score >= 55""")
def stream_leads_query(spark, sf_dir):
    """Candidate files as batches of a stream, then all of them again by a stream with a fresh checkpoint."""
    work = _folder(spark, "stream-leads")
    candidates = written(_own_sites(spark, sf_dir).withColumn("file", F.col("ord") % 3))
    for k in range(3):  # three sets of files, whose candidates are numbered alike; their number does not depend on the cluster
        (candidates.where(F.col("file") == k).drop("file").withColumn("ord", F.floor(F.col("ord") / 3)).repartition(SET_FILES)
         .write.mode("append").parquet(f"{work}/in"))
    runs, schema = Runs(f"{work}/tables", BUCKETS), candidates.drop("file").schema
    stream_leads(read_candidate_stream(spark, f"{work}/in", schema, 4), runs, f"{work}/first", PARAMS)
    stream_leads(read_candidate_stream(spark, f"{work}/in", schema), runs, f"{work}/second", replace(PARAMS, as_of="2001-08-01T00:00:01+00:00"))
    return runs.read(spark, "leads").select("name", "website", "niche", "country", "language", "followers", "lead_score", "classification",
                                            "email", "status", "discovered_at")


@query("run_counters", f"""
WITH {_OWN_SITES_SQL}, kept AS (SELECT *, score >= 55 AS ok FROM classed)
SELECT count(*) + (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0) AS candidates_found, count(*) AS unique_candidates,
       (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0) AS duplicates_prevented, count(*) FILTER (ok) AS qualified,
       count(*) FILTER (ok) AS new_leads, 0 AS updated_leads, count(*) FILTER (ok) AS total_leads, 0 AS emails_found,
       0 AS verified_emails, 0 AS instagram_lookups, 3 AS errors, round(count(*) FILTER (ok) / 7.0, 3) AS qualified_per_youtube_search FROM kept""")
def run_counters(spark, sf_dir):
    """The counters of a real run, some of whose candidates are found twice."""
    own = _own_sites(spark, sf_dir)
    twice = own.unionByName(own.where("ord % 5 = 0").withColumn("ord", F.col("ord") + (1 << 40)))
    runs = Runs(_folder(spark, "run-counters"), BUCKETS)
    failures = spark.createDataFrame([("provider:WEB", "Timeout", NOW.as_of, i) for i in range(3)], "key STRING, error STRING, seen_at STRING, seq BIGINT")
    run(spark, runs, Inputs(twice), PARAMS, run_id="r", failures=failures, requests={"youtube_search_requests": 7})
    return runs.report(spark, PARAMS).select(
        "candidates_found", "unique_candidates", "duplicates_prevented", "qualified", "new_leads", "updated_leads", "total_leads",
        "emails_found", "verified_emails", "instagram_lookups", "errors", "qualified_per_youtube_search")


@query("stats_full", f"""
WITH {MERGED_SQL}, placed AS (SELECT *, row_number() OVER (ORDER BY discovered_at DESC, row_no NULLS LAST, first_ord) AS r FROM merged),
long AS (
  SELECT 0 AS d, 'SOURCE' AS dimension, coalesce(nullif(source, ''), 'UNKNOWN') AS value, r FROM placed
  UNION ALL SELECT 1, 'NICHE', coalesce(nullif(niche, ''), 'UNKNOWN'), r FROM placed
  UNION ALL SELECT 2, 'LANGUAGE', coalesce(nullif(language, ''), 'UNKNOWN'), r FROM placed
  UNION ALL SELECT 3, 'COUNTRY', coalesce(nullif(country, ''), 'UNKNOWN'), r FROM placed),
counted AS (SELECT d, value, count(*) AS n, min(r) AS first FROM long GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY n DESC, first) AS place FROM counted),
c AS (SELECT count(*) AS a, count(*) FILTER (left(discovered_at, 10) = '2001-02-01') AS b, count(*) FILTER (upper(classification) = 'HOT') AS c,
         count(*) FILTER (trim(email) <> '') AS d, count(*) FILTER (email_status = 'VERIFIED_PUBLIC_SOURCE') AS e,
         count(*) FILTER (trim(instagram_url) <> '') AS f, count(*) FILTER (upper(status) = 'CONTACTED') AS g,
         count(*) FILTER (upper(outreach_status) = 'SENT') AS h, count(*) FILTER (trim(email) = '') AS i FROM merged),
top AS (SELECT unnest(range(9)) AS line, unnest(['TOTAL LEADS', 'NEW TODAY', 'HOT LEADS', 'EMAILS FOUND', 'VERIFIED EMAILS', 'INSTAGRAM FOUND', 'CONTACTED',
         'OUTREACH SENT', 'NO EMAIL']) AS metric, CAST(unnest([a, b, c, d, e, f, g, h, i]) AS VARCHAR) AS value FROM c),
run AS (SELECT 9 + unnest(range(11)) AS line, unnest(['LAST RUN', 'LAST RUN DURATION', 'LEADS DISCOVERED LAST RUN', 'NEW LEADS LAST RUN', 'DUPLICATES PREVENTED',
         'WEBSITES CRAWLED', 'YOUTUBE REQUESTS', 'YOUTUBE SEARCH REQUESTS', 'INSTAGRAM LOOKUPS', 'INSTAGRAM FOUND LAST RUN', 'ERRORS']) AS metric,
         unnest(['now', '2.5', '9', '8', '7', '6', '5', '4', '3', '2', '1']) AS value)
SELECT CAST(line AS INT) AS line, metric, value FROM top UNION ALL SELECT CAST(line AS INT), metric, value FROM run
UNION ALL SELECT DISTINCT CAST(100 + 100 * d AS INT), 'LEADS BY ' || dimension, '' FROM long
UNION ALL SELECT CAST(100 + 100 * d + place AS INT), '  ' || value, CAST(n AS VARCHAR) FROM ranked WHERE place <= 15""")
def stats_full(spark, sf_dir):
    """The whole statistics table of a merged store."""
    store = _store(spark, sf_dir)
    merge_store(spark, store, order_leads(spark, sf_dir), PARAMS)
    last = spark.createDataFrame([("now", "2.5", 9, 8, 7, 6, 5, 4, 3, 2, 1)],
                                 "finished_at STRING, duration STRING, candidates_found BIGINT, new_leads BIGINT, duplicates_prevented BIGINT, "
                                 "websites_crawled BIGINT, youtube_requests BIGINT, youtube_search_requests BIGINT, instagram_lookups BIGINT, "
                                 "instagram_found BIGINT, errors BIGINT")
    return stats_lines(store.read(spark), last, "2001-02-01", newest=newest_first())


@query("harvest_leads", f"""
WITH visits AS ({_visit_rounds(5)}),
roots AS (SELECT *, regexp_replace(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*', 0), '//www[.]', '//'), '^http:', 'https:') AS root FROM pages),
moved AS (SELECT page_id, html, root, root || CASE WHEN page_id = min(page_id) OVER (PARTITION BY root) THEN '/'
                 ELSE regexp_extract(html, '<a href="([^"]*)"', 1) END AS page FROM roots),
texts AS (SELECT page, arg_min(html, page_id) AS html FROM moved GROUP BY 1),
hits AS (SELECT v.domain, visit_no, page, html, unnest(regexp_extract_all(html, '[A-Za-z0-9.]+@mail[0-9]+[.]example[.]com', 0)) AS email
         FROM visits v JOIN texts USING (page)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY visit_no, position(email IN html)) AS rn FROM hits) WHERE rn = 1),
sites AS (SELECT regexp_replace(root, 'https://', '') AS domain, min(page_id) AS ord FROM moved GROUP BY 1)
SELECT domain, coalesce(lower(email), '') AS email, coalesce(page, '') AS email_source_url, 'https://' || domain AS website
FROM sites LEFT JOIN best USING (domain) WHERE ord % 2 = 0""")
def harvest_leads(spark, sf_dir):
    """Every second site of the stored pages as a candidate; its address comes from a visit to its pages in the page index."""
    index = page_index(_folder(spark, "pages"), BUCKETS)
    add_pages(spark, index, linked_pages(spark, sf_dir))
    pages = index.read(spark)
    sites = pages.groupBy("domain").agg(F.min("page_id").alias("ord")).where("ord % 2 = 0")
    candidates = candidates_from(sites, ord=F.col("ord"), source=F.lit("WEB"), platform=F.lit("Web"), provider_id=F.col("domain"),
                                 name=F.col("domain"), website=F.concat(F.lit("https://"), F.col("domain")))
    leads = harvest(Inputs(candidates, pages), replace(VISIT_PARAMS, min_score=0)).leads
    return leads.select(F.replace("website", F.lit("https://"), F.lit("")).alias("domain"), "email", "email_source_url", "website")


@query("stream_queues", """
WITH old AS (SELECT 'user:' || user_id AS key, count(*) AS n FROM events WHERE event_type = 'error' AND value > 30 GROUP BY 1),
new AS (SELECT 'user:' || user_id AS key, count(*) AS n, left(arg_max(props, event_id), 200) AS e FROM events WHERE event_type = 'signup' GROUP BY 1),
places AS (SELECT 'user:' || user_id AS key, event_id + CASE event_type WHEN 'signup' THEN 1099511627776 ELSE 0 END AS seq FROM events
           WHERE event_type = 'signup' OR event_type = 'error' AND value > 30),
entered AS (SELECT key, min(seq) AS retry_at, min(seq) FILTER (rn = 3) AS dead_at FROM (
            SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq) AS rn FROM places) GROUP BY 1)
SELECT key, coalesce(o.n, 0) + coalesce(f.n, 0) AS count, coalesce(f.e, 'old') AS last_error,
       (o.n IS NOT NULL) OR coalesce(o.n, 0) < 2 AS in_retry,
       coalesce(o.n >= 3, false) OR (f.n IS NOT NULL AND coalesce(o.n, 0) + f.n >= 3) AS in_dead, retry_at, dead_at
FROM old o FULL JOIN new f USING (key) JOIN entered USING (key)""")
def stream_queues_query(spark, sf_dir):
    """Failures in two sets of files, counted in keyed state; the later set comes to a restarted stream."""
    work, events = _folder(spark, "stream-queues"), table(spark, sf_dir, "events")
    old = _failures_of(events, "event_type = 'error' AND value > 30", F.lit("old"))
    new = _failures_of(events, "event_type = 'signup'", F.col("props")).withColumn("seq", F.col("seq") + (1 << 40))
    for part in (old, new):
        part.write.mode("append").parquet(f"{work}/in")
        stream_queues(spark.readStream.schema(old.schema).parquet(f"{work}/in"), f"{work}/out", f"{work}/checkpoint")
    return read_queues(spark, f"{work}/out").select("key", "count", "last_error", "in_retry", "in_dead", "retry_at", "dead_at")


@query("stream_cache_ttl", """
WITH cache AS (
  SELECT user_id, CASE WHEN max(value) FILTER (event_type = 'purchase') > 60 THEN 'https://www.instagram.com/u/' ELSE '' END AS url,
         max(ts) FILTER (event_type = 'signup') AS t FROM events GROUP BY 1)
SELECT c_custkey, 'm' || c_custkey || '@x.test' AS email, coalesce(url, '') AS cached_url,
       coalesce(url <> '' OR t >= TIMESTAMP '2024-01-24 00:00:00', false) AS fresh
FROM customer LEFT JOIN cache ON c_custkey = user_id""")
def stream_cache_ttl(spark, sf_dir):
    """Answers in keyed state, whose timers end them as time goes on to the reference time."""
    work, answers = _folder(spark, "stream-lookups"), _cache(table(spark, sf_dir, "events"))
    clock = spark.createDataFrame([("", None, "", "", 0.0, EVENTS_AS_OF)], answers.schema.simpleString()[7:-1].replace(":", " "))
    for part in (answers, clock):
        part.write.mode("append").parquet(f"{work}/in")
        stream_lookups(spark.readStream.schema(answers.schema).parquet(f"{work}/in"), f"{work}/out", f"{work}/checkpoint", NOW)
    live = read_lookups(spark, f"{work}/out").select("email", "url", "live")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("m"), F.col("c_custkey"), F.lit("@x.test")).alias("email"))
    return customers.join(live, "email", "left").select(
        "c_custkey", "email", F.coalesce("url", F.lit("")).alias("cached_url"), F.coalesce("live", F.lit(False)).alias("fresh"))


@query("processed_tail", """
WITH asked AS (SELECT 'q' || (o_orderkey * 7919 % 4001) AS query, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS run, o_orderkey AS ord FROM orders),
seen AS (SELECT query, min(run) AS run FROM asked GROUP BY 1),
place AS (SELECT query, s.run, min(ord) AS ord FROM asked a JOIN seen s USING (query) WHERE a.run = s.run GROUP BY 1, 2)
SELECT query, row_number() OVER (ORDER BY run, ord) - 1 AS pos FROM (SELECT * FROM place ORDER BY run DESC, ord DESC LIMIT 2000)""")
def processed_tail(spark, sf_dir):
    """The last 2,000 of the queries of two runs, in the order they were first asked."""
    asked = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("q"), F.col("o_orderkey") * 7919 % 4001).alias("query"), F.col("o_orderkey").alias("ord"))
    nothing = spark.createDataFrame([], "query STRING, place ARRAY<BIGINT>")
    first = first_seen(nothing, asked.where("ord % 3 <> 0"), "query", 0, None)
    second = first_seen(first, asked.where("ord % 3 = 0"), "query", 1, 2000)
    return with_position(second, [F.col("place")]).select("query", "pos")


@query("discovery_round", f"""
WITH q AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) - 1 AS pos, count(*) OVER () AS total FROM customer),
n AS (SELECT *, total * 3 // 5 AS n, k % 7 <> 0 AS has FROM q),
r AS (SELECT *, pos < n AS r1, pos >= n OR pos < 2 * n - total AS r2, k % 2 = 0 AS even FROM n),
s AS (SELECT *, CASE WHEN has AND even AND (r1 <> r2) THEN 't1' END AS token,
             CASE WHEN NOT has THEN NULL WHEN even AND r1 AND r2 THEN '2024-02-01T00:00:00+00:00' WHEN even THEN NULL
                  WHEN r1 THEN '2024-01-31T00:00:00+00:00' ELSE '2024-02-01T00:00:00+00:00' END AS done_at FROM r),
pages AS (SELECT s.k, o_orderkey, CASE WHEN even AND o_orderkey % 2 = 1 THEN r1 AND r2 ELSE true END AS read
          FROM s JOIN orders ON o_custkey = k WHERE has),
known AS (SELECT count(DISTINCT o_orderkey % 97) AS n_known FROM pages WHERE read)
SELECT 'q' || k AS query, token, done_at, n_known, n_known AS n_leads, (SELECT (2 * max(n)) % max(total) FROM r) AS query_offset
FROM s, known WHERE token IS NOT NULL OR done_at IS NOT NULL""")
def discovery_round(spark, sf_dir):
    """Two runs after one another, each with a round of discovery: the second goes on where the first one stopped."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("q"), F.col("c_custkey")).alias("query"))
    queries = with_position(customers, [F.col("k")])
    item = F.struct(F.struct(F.concat(F.lit("o"), F.col("o_orderkey")).alias("videoId")).alias("id"),
                    F.struct(F.concat(F.lit("u"), F.col("o_orderkey") % 97).alias("channelId"), iso(F.col("o_orderdate")).alias("publishedAt")).alias("snippet"))
    later = (F.col("k") % 2 == 0) & (F.col("o_orderkey") % 2 == 1)
    hits = (table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("k"))
            .groupBy("k", F.when(later, "t1").otherwise("").alias("page_token"))
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", item.alias("item")))), lambda x: x["item"]).alias("items")))
    # a query's first page is there, also without hits; none is of every seventh query
    first = customers.select("k", F.lit("").alias("page_token")).union(customers.where("k % 2 = 0").select("k", F.lit("t1").alias("page_token")))
    searches = (first.where("k % 7 <> 0").join(hits, ["k", "page_token"], "left")
                .select(F.concat(F.lit("q"), F.col("k")).alias("query"), "page_token",
                        F.when((F.col("k") % 2 == 0) & (F.col("page_token") == ""), "t1").alias("nextPageToken"), "items"))
    channels = spark.range(97).select(F.col("id").alias("answer_no"), F.from_json(
        F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("u"), F.col("id")).alias("id"),
                                            F.struct(F.concat(F.lit("channel "), F.col("id")).alias("title")).alias("snippet"))).alias("items"))),
        "items ARRAY<STRUCT<id: STRING, snippet: STRUCT<title: STRING, description: STRING, customUrl: STRING, country: STRING, "
        "defaultLanguage: STRING, defaultAudioLanguage: STRING>, statistics: STRUCT<subscriberCount: STRING>, "
        "brandingSettings: STRUCT<channel: STRUCT<description: STRING, country: STRING>>>>").alias("a")).select("answer_no", "a.items")
    runs = Runs(_folder(spark, "discovery"), BUCKETS)
    for as_of in (EVENTS_AS_OF, "2024-02-01T00:00:00+00:00"):
        params = Params(as_of=as_of, min_score=0, searches_per_run=queries.count() * 3 // 5)
        found = next_round(spark, runs, queries, searches, channels, params)
        run(spark, runs, Inputs(found.candidates), params, run_id=as_of, queries=found.asked.withColumnRenamed("turn", "ord"),
            videos=found.videos, discovery=found)
    counts = [runs.read(spark, name).count() for name in ("known_channels", "leads")]
    state = runs.read(spark, "query_tokens").join(runs.read(spark, "query_done"), "query", "full_outer")
    return state.select("query", "token", "done_at", *[F.lit(n).cast("bigint").alias(c) for n, c in zip((*counts, runs.offset(spark)), ("n_known", "n_leads", "query_offset"))])
