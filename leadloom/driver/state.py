"""Queries on incremental state: failures, caches, rotation, JSON state, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadloom.driver.adapters import EVENTS_AS_OF, iso
from leadloom.driver.registry import query, table
from leadloom.operators.checkpoints import checkpoint_dir
from leadloom.operators.match import split_by_cache
from leadloom.operators.state import (
    done_state, due_queries, failure_totals, known_ids, latest_checked, merge_cache, merge_failures, missing_defaults,
    queue_entries, readable_state, refresh_choice, token_state, with_queues,
)
from leadloom.params import Params
from leadloom.streaming.failures import read_failures, stream_failures

NOW = Params(as_of=EVENTS_AS_OF)


def _failures(events):
    """Error events as failures of a user on a day."""
    return events.filter("event_type = 'error'").select(
        F.concat(F.lit("lead:"), F.col("user_id"), F.lit(":"), F.substring(iso(F.col("ts")), 1, 10)).alias("key"),
        F.concat(F.lit("Error "), F.col("props")).alias("error"), iso(F.col("ts")).alias("seen_at"),
        F.col("event_id").alias("seq"))


def _failures_of(events, condition, error):
    """Some events as failures of their user."""
    return events.filter(condition).select(
        F.concat(F.lit("user:"), F.col("user_id")).alias("key"), error.alias("error"),
        iso(F.col("ts")).alias("seen_at"), F.col("event_id").alias("seq"))


_FAILURE_SQL = """
SELECT 'lead:' || user_id || ':' || left(CAST(ts AS VARCHAR), 10) AS key, count(*) AS count,
       left('Error ' || arg_max(props, event_id), 200) AS last_error,
       replace(CAST(arg_max(ts, event_id) AS VARCHAR), ' ', 'T') AS last_seen, true AS in_retry, count(*) >= 3 AS in_dead
FROM events WHERE event_type = 'error' GROUP BY 1"""


@query("failure_split", _FAILURE_SQL)
def failure_split(spark, sf_dir):
    return with_queues(failure_totals(_failures(table(spark, sf_dir, "events"))))


@query("stream_failures", _FAILURE_SQL)
def stream_failures_query(spark, sf_dir):
    work = f"{checkpoint_dir(spark)}/stream-failures-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    stream_failures(_failures(events), f"{work}/out", f"{work}/checkpoint")
    return read_failures(spark, f"{work}/out")


@query("failure_merge", """
WITH old AS (SELECT 'user:' || user_id AS key, count(*) AS n FROM events WHERE event_type = 'error' AND value > 30 GROUP BY 1),
new AS (SELECT 'user:' || user_id AS key, count(*) AS n, left(arg_max(props, event_id), 200) AS e FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT key, coalesce(o.n, 0) + coalesce(f.n, 0) AS count, coalesce(f.e, 'old') AS last_error,
       (o.n IS NOT NULL) OR coalesce(o.n, 0) < 2 AS in_retry,
       coalesce(o.n >= 3, false) OR (f.n IS NOT NULL AND coalesce(o.n, 0) + f.n >= 3) AS in_dead
FROM old o FULL JOIN new f USING (key)""")
def failure_merge(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    old = with_queues(failure_totals(_failures_of(events, "event_type = 'error' AND value > 30", F.lit("old"))))
    new = failure_totals(_failures_of(events, "event_type = 'signup'", F.col("props")))
    return merge_failures(old, new).select("key", "count", "last_error", "in_retry", "in_dead")


@query("dead_letters", """
SELECT key, event_id AS entered FROM (
  SELECT 'lead:' || user_id || ':' || left(CAST(ts AS VARCHAR), 10) AS key, event_id,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn FROM events WHERE event_type = 'error')
WHERE rn = 3 ORDER BY entered DESC LIMIT 1000""")
def dead_letters(spark, sf_dir):
    return queue_entries(_failures(table(spark, sf_dir, "events")), "dead_letter", keep=1000)


def _user_days(events, condition):
    return events.filter(condition).groupBy(F.concat(F.lit("q"), F.col("user_id")).alias("query")).agg(
        iso(F.max("ts")).alias("done_at"))


@query("ttl_anti", """
SELECT DISTINCT 'q' || user_id AS query FROM events WHERE user_id NOT IN (
  SELECT user_id FROM events WHERE event_type = 'purchase' GROUP BY 1 HAVING max(ts) > TIMESTAMP '2024-01-24 00:00:00')""")
def ttl_anti(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    queries = events.select(F.concat(F.lit("q"), F.col("user_id")).alias("query")).distinct()
    return due_queries(queries, _user_days(events, "event_type = 'purchase'"), NOW)


@query("token_rotation", """
WITH old AS (SELECT 'q' || user_id AS query, 't' || max(event_id) AS token FROM events WHERE event_type = 'view' GROUP BY 1),
done AS (SELECT 'q' || user_id AS query, replace(CAST(max(ts) AS VARCHAR), ' ', 'T') AS done_at FROM events WHERE event_type = 'signup' GROUP BY 1),
new AS (SELECT 'q' || user_id AS query, CASE WHEN max(value) > 60 THEN 'n' || max(event_id) END AS token FROM events WHERE event_type = 'click' GROUP BY 1),
tokens AS (SELECT query, CASE WHEN n.query IS NULL THEN o.token ELSE n.token END AS token FROM old o FULL JOIN new n USING (query)),
dones AS (SELECT query, CASE WHEN n.query IS NULL THEN d.done_at WHEN n.token IS NULL THEN '2024-01-31T00:00:00+00:00' END AS done_at
          FROM done d FULL JOIN new n USING (query))
SELECT query, token, done_at FROM (SELECT * FROM tokens WHERE token IS NOT NULL) FULL JOIN (SELECT * FROM dones WHERE done_at IS NOT NULL) USING (query)""")
def token_rotation(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("query", F.concat(F.lit("q"), F.col("user_id")))
    tokens = events.filter("event_type = 'view'").groupBy("query").agg(F.concat(F.lit("t"), F.max("event_id")).alias("token"))
    answers = events.filter("event_type = 'click'").groupBy("query").agg(
        F.when(F.max("value") > 60, F.concat(F.lit("n"), F.max("event_id"))).alias("token"))
    done = _user_days(events.drop("query"), "event_type = 'signup'")
    return token_state(tokens, answers).join(done_state(done, answers, NOW), "query", "full_outer")


@query("stale_users", """
WITH found AS (SELECT user_id, min(event_id) AS o FROM events WHERE event_type = 'purchase' AND value > 75 GROUP BY 1),
checked AS (SELECT user_id, max(ts) AS t FROM events WHERE event_type = 'signup' GROUP BY 1),
older AS (SELECT u.user_id, coalesce(CAST(t AS VARCHAR), '') AS t FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN checked USING (user_id)
          WHERE u.user_id NOT IN (SELECT user_id FROM found)),
ranked AS (SELECT user_id, 0 AS kind, o, '' AS t FROM found UNION ALL SELECT user_id, 1, 0, t FROM older),
placed AS (SELECT *, row_number() OVER (ORDER BY kind, o, t, lpad(CAST(user_id AS VARCHAR), 12, '0')) AS place FROM ranked)
SELECT lpad(CAST(user_id AS VARCHAR), 12, '0') AS channel_id, CAST(place AS INT) AS place, kind = 0 AS found_now FROM placed
WHERE place <= least(100, greatest(50, (SELECT count(*) FROM found)))""")
def stale_users(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("channel_id", F.lpad(F.col("user_id").cast("string"), 12, "0"))
    found = events.filter("event_type = 'purchase' AND value > 75").groupBy("channel_id").agg(F.min("event_id").alias("found_ord"))
    checked = events.filter("event_type = 'signup'").select("channel_id", iso(F.col("ts")).alias("checked_at"))
    last = latest_checked(checked.limit(0), checked, "channel_id")
    return refresh_choice(found, events.select("channel_id").distinct(), last, NOW)


@query("known_channels", """
SELECT id FROM (SELECT 'u' || user_id AS id FROM events UNION SELECT 'u' || c_custkey FROM customer) ORDER BY id DESC LIMIT 5000""")
def known_channels(spark, sf_dir):
    users = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id")).alias("id"))
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey")).alias("id"))
    return known_ids(users, customers, "id", 5000)


def _cache(events):
    """Users as cached lookups: bought users have a profile, the time is that of their last view."""
    return events.groupBy(F.concat(F.lit("m"), F.col("user_id"), F.lit("@x.test")).alias("email")).agg(
        F.when(F.max(F.when(F.col("event_type") == "purchase", F.col("value"))) > 60, "https://www.instagram.com/u/").otherwise("").alias("url"),
        F.lit("NOT_FOUND").alias("status"), F.lit("q").alias("query"), F.lit(0.5).alias("confidence"),
        F.coalesce(iso(F.max(F.when(F.col("event_type") == "signup", F.col("ts")))), F.lit("never")).alias("checked_at"))


@query("cache_lookup", """
WITH cache AS (
  SELECT user_id, CASE WHEN max(value) FILTER (event_type = 'purchase') > 60 THEN 'https://www.instagram.com/u/' ELSE '' END AS url,
         max(ts) FILTER (event_type = 'signup') AS t FROM events GROUP BY 1)
SELECT c_custkey, 'm' || c_custkey || '@x.test' AS email, coalesce(url, '') AS cached_url,
       coalesce(url <> '' OR t >= TIMESTAMP '2024-01-24 00:00:00', false) AS fresh
FROM customer LEFT JOIN cache ON c_custkey = user_id""")
def cache_lookup(spark, sf_dir):
    leads = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("m"), F.col("c_custkey"), F.lit("@x.test")).alias("email"))
    looked = split_by_cache(leads, _cache(table(spark, sf_dir, "events")), NOW, "c_custkey")
    return looked.select("c_custkey", "email", F.coalesce("c_url", F.lit("")).alias("cached_url"), "fresh")


@query("cache_merge", """
WITH old AS (
  SELECT 'm' || user_id || '@x.test' AS email, CASE WHEN max(value) FILTER (event_type = 'purchase') > 60 THEN 'https://www.instagram.com/u/' ELSE '' END AS url
  FROM events GROUP BY 1),
new AS (SELECT 'm' || c_custkey || '@x.test' AS email, 'https://www.instagram.com/c' || c_custkey || '/' AS url FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT email, coalesce(n.url, o.url) AS url FROM old o FULL JOIN new n USING (email)""")
def cache_merge(spark, sf_dir):
    answers = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("m"), F.col("c_custkey"), F.lit("@x.test")).alias("email"),
        F.concat(F.lit("https://www.instagram.com/c"), F.col("c_custkey"), F.lit("/")).alias("url"),
        F.lit("FOUND_SEARCH_RESULT").alias("status"), F.lit("q").alias("query"), F.lit(0.9).alias("confidence"),
        F.lit(EVENTS_AS_OF).alias("checked_at"))
    return merge_cache(_cache(table(spark, sf_dir, "events")), answers, NOW).select("email", "url")


@query("json_state", """
WITH rows AS (
  SELECT 'user:' || user_id AS key, props AS value, event_id AS row_no FROM events
  UNION ALL SELECT CASE lang WHEN 'fr' THEN '' WHEN 'de' THEN 'query_cursors' ELSE 'doc:' || doc_id END,
                   CASE WHEN lang = 'en' THEN text ELSE '["' || source || '"]' END, 1099511627776 + doc_id FROM documents),
valid AS (SELECT key, arg_max(value, row_no) AS value FROM rows WHERE key <> '' AND json_valid(value) GROUP BY 1),
defaults AS (SELECT unnest(['processed_queries', 'query_cursors', 'channel_checked_at', 'website_checked_at', 'email_checked_at',
  'instagram_lookup_cache', 'processed_video_ids', 'provider_state', 'failed_jobs', 'retry_queue', 'dead_letter_queue',
  'youtube_query_offset', 'youtube_query_tokens', 'youtube_query_done_at', 'youtube_known_channel_ids']) AS key,
  unnest(['[]', '{}', '{}', '{}', '{}', '{}', '[]', '{}', '{}', '[]', '[]', '0', '{}', '{}', '[]']) AS value)
SELECT key, value FROM valid UNION ALL SELECT key, value FROM defaults WHERE key NOT IN (SELECT key FROM valid)""")
def json_state(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user:"), F.col("user_id")).alias("key"), F.col("props").alias("value"), F.col("event_id").alias("row_no"))
    key = F.when(F.col("lang") == "fr", "").when(F.col("lang") == "de", "query_cursors").otherwise(F.concat(F.lit("doc:"), F.col("doc_id")))
    value = F.when(F.col("lang") == "en", F.col("text")).otherwise(F.concat(F.lit('["'), F.col("source"), F.lit('"]')))
    documents = table(spark, sf_dir, "documents").select(
        key.alias("key"), value.alias("value"), (F.lit(1 << 40) + F.col("doc_id")).alias("row_no"))
    return missing_defaults(spark, readable_state(events.unionByName(documents)))


@query("kv_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       '{"event_id":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}' AS text FROM events""")
def kv_json(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k BIGINT").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"), F.to_json(F.struct("event_id", "p.k")).alias("text"))
