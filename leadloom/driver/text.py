"""Queries on texts and addresses: URLs, emails, secrets, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.driver.adapters import PARAMS
from leadloom.driver.registry import query, table
from leadloom.functions.emails import email_preference, extract_emails, is_bad_email, local_part
from leadloom.functions.html import hrefs, meta_description, title
from leadloom.functions.identity import normalize_username, profile_url
from leadloom.functions.text import compact, mask_secrets, title_case
from leadloom.functions.urls import canonical_domain, canonical_url, domain_of_canonical, resolve
from leadloom.operators.best import text_evidence
from leadloom.operators.dedup import first_per_key

# canonical URL in SQL for the well-formed http(s) URLs of the pages table
CANONICAL_SQL = """
parts AS (
  SELECT *, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host0,
         regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path0,
         regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS query0
  FROM pages),
cleaned AS (
  SELECT * EXCLUDE (host0, path0, query0), regexp_replace(host0, '^www[.]', '') AS domain,
         CASE WHEN path0 IN ('', '/') THEN '/' ELSE regexp_replace(regexp_replace(path0, '/+', '/', 'g'), '/+$', '') END AS path,
         array_to_string(list_sort(list_filter(string_split(query0, '&'),
             lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_'))), '&') AS query
  FROM parts),
canon AS (
  SELECT *, 'https://' || domain || path || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical
  FROM cleaned)"""

# RE2 has no look-around, so white space is doubled and the neighbours are matched instead
_NEIGHBOURS = (r"(?i)(?:^|[^\p{L}\p{N}_.+-])([A-Z0-9.!#$%&''*+/=?^_`{|}~-]+@[A-Z0-9.-]+\.[A-Z]{2,63})"
               r"(?:[^\p{L}\p{N}_.-]|$)")


def emails_sql(relation: str, key: str, text: str) -> str:
    return f"""
hits AS (
  SELECT {key}, unnest(list_filter(regexp_extract_all(regexp_replace({text}, '\\s', '  ', 'g'), '{_NEIGHBOURS}', 1),
                                   lambda x: true)) AS raw,
         generate_subscripts(regexp_extract_all(regexp_replace({text}, '\\s', '  ', 'g'), '{_NEIGHBOURS}', 1), 1) AS i
  FROM {relation} WHERE contains({text}, '@')),
normal AS (SELECT {key}, i, lower(trim(raw, '<>[](){{}}.,;:''"')) AS email FROM hits),
good AS (
  SELECT {key}, email, min(i) AS i FROM normal
  WHERE split_part(email, '@', 2) NOT IN ('example.com', 'example.org', 'example.net', 'email.com', 'domain.com', 'sentry.io')
    AND NOT regexp_matches(email, '^(noreply|no-reply|donotreply|do-not-reply|example|test|testing|privacy|abuse|webmaster|postmaster|mailer-daemon|root)')
    AND NOT regexp_matches(email, '[.](png|jpg|jpeg|gif|svg|webp|css|js)$')
    AND length(split_part(email, '@', 1)) <= 64 AND NOT contains(email, '..')
  GROUP BY 1, 2),
ranked AS (
  SELECT *, 20 + CASE WHEN regexp_matches(split_part(email, '@', 1), '^(contact|hello|business|collab|partnership|partnerships|booking|info)([.]|$)') THEN 15 ELSE 0 END
            + CASE WHEN regexp_matches(split_part(email, '@', 1), 'business|collab|partner|booking') THEN 10 ELSE 0 END AS preference
  FROM good)"""


@query("url_canonical", f"WITH {CANONICAL_SQL} SELECT page_id, canonical, domain FROM canon")
def url_canonical(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", canonical_url(F.col("url")).alias("canonical"))
    return pages.withColumn("domain", domain_of_canonical(F.col("canonical")))


@query("domain_of_host", """
SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www[.]', '') AS domain FROM pages""")
def domain_of_host(spark, sf_dir):
    host = F.regexp_extract("url", "^[a-z]+://([^?#]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", canonical_domain(F.upper(host)).alias("domain"))


@query("doc_emails", f"""
WITH {emails_sql('documents', 'doc_id', 'text')}
SELECT doc_id, email, preference, split_part(email, '@', 1) AS local FROM ranked""")
def doc_emails(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(extract_emails(F.col("text"), PARAMS)).alias("email"))
    return found.select("doc_id", "email", email_preference(F.col("email"), PARAMS).alias("preference"),
                        local_part(F.col("email")).alias("local"))


@query("email_rules", """
WITH made AS (
  SELECT doc_id, lang, CASE lang WHEN 'en' THEN 'Business.' WHEN 'fr' THEN 'noreply' WHEN 'de' THEN 'hello' ELSE 'a..b' END
         || CASE WHEN lang = 'de' THEN '' ELSE CAST(doc_id AS VARCHAR) END
         || CASE WHEN source = 'src1' THEN '@example.com' ELSE '@' || source || '.test' END AS email FROM documents)
SELECT doc_id, lower(email) AS email, lang IN ('fr', 'es') OR contains(email, '@example.com') AS bad,
       CASE WHEN lang IN ('fr', 'es') OR contains(email, '@example.com') THEN -100
            WHEN lang = 'en' THEN 45 ELSE 35 END AS preference FROM made""")
def email_rules(spark, sf_dir):
    local = (F.when(F.col("lang") == "en", F.concat(F.lit("Business."), F.col("doc_id")))
             .when(F.col("lang") == "fr", F.concat(F.lit("noreply"), F.col("doc_id")))
             .when(F.col("lang") == "de", "hello").otherwise(F.concat(F.lit("a..b"), F.col("doc_id"))))
    host = F.when(F.col("source") == "src1", "@example.com").otherwise(F.concat(F.lit("@"), F.col("source"), F.lit(".test")))
    made = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit(" <"), local, host, F.lit(">. ")).alias("raw"))
    return made.select(
        "doc_id", F.regexp_replace(F.lower(F.trim("raw")), "[<>]|[.]$", "").alias("email"),
        is_bad_email(F.col("raw"), PARAMS).alias("bad"), email_preference(F.col("raw"), PARAMS).alias("preference"))


@query("best_email_per_source", f"""
WITH {emails_sql('documents', 'doc_id', 'text')},
sourced AS (SELECT r.*, d.source, least(1.0, 0.85 + greatest(0, preference - 20) / 100.0) AS c FROM ranked r JOIN documents d USING (doc_id))
SELECT source, email, doc_id, CAST(round(c, 2) AS DOUBLE) AS confidence, 'VERIFIED_PUBLIC_SOURCE' AS verification_status,
       'exact address observed on public document_public_text source' AS evidence_reason
FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY preference DESC, c DESC, doc_id, i) AS rn FROM sourced)
WHERE rn = 1""")
def best_email_per_source(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("site"), "text", F.concat(F.lit("doc:"), F.col("doc_id")).alias("url"))
    rows = text_evidence(documents, "text", "url", F.lit("document_public_text"), PARAMS)
    order = F.struct(-F.col("preference"), -F.col("confidence"), F.col("doc_id"), F.col("evidence_seq"))
    best = first_per_key(rows, ["site"], order)
    return best.select(F.col("site").alias("source"), "email", "doc_id", "confidence", "verification_status", "evidence_reason")


@query("mask_secrets", """
WITH masked AS (
  SELECT doc_id, regexp_replace(text, '(?i)(api[_-]?key|token|authorization|credential|secret)(\\s*[=:]\\s*)([^\\s,;]+)',
                                '\\1\\2[REDACTED]', 'g') AS m FROM documents)
SELECT doc_id, md5(m) AS masked_md5, contains(m, '[REDACTED]') AS has_secret FROM masked""")
def mask_secrets_query(spark, sf_dir):
    masked = table(spark, sf_dir, "documents").select("doc_id", mask_secrets(F.col("text")).alias("m"))
    return masked.select("doc_id", F.md5("m").alias("masked_md5"), F.contains("m", F.lit("[REDACTED]")).alias("has_secret"))


@query("page_heads", """
WITH raw AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)
SELECT page_id, trim(regexp_replace(replace(t, '&quot;', '"'), '&amp;?', '&', 'g')) AS title, '' AS description FROM raw""")
def page_heads(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", title(F.col("html")).alias("title"), meta_description(F.col("html")).alias("description"))


@query("page_links", """
WITH raw AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS root, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages)
SELECT page_id, i AS link_no, root || hs[i] AS link FROM (SELECT *, unnest(range(1, len(hs) + 1)) AS i FROM raw)""")
def page_links_query(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(hrefs(F.col("html"))).alias("i", "href"))
    return links.select("page_id", (F.col("i") + 1).cast("bigint").alias("link_no"), resolve(F.col("url"), F.col("href")).alias("link"))


@query("profile_addresses", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE 'https://www.instagram.com/' || replace(c_name, '#', '.') || '/' END AS profile,
       lower(replace(c_name, '#', '.')) AS username, 'user' || right(c_name, 9) AS name_key FROM customer""")
def profile_addresses(spark, sf_dir):
    handle = F.replace("c_name", F.lit("#"), F.lit("."))
    wrapped = F.concat(F.lit("//duckduckgo.com/l/?rut=1&uddg="),
                       F.url_encode(F.concat(F.lit("https://m.instagram.com/@"), handle, F.lit("?hl=en"))))
    plain = F.concat(F.lit("instagram.com/"), handle, F.lit("/"))
    reserved = F.concat(F.lit("https://instagram.com/reel/"), handle)
    href = (F.when(F.col("c_mktsegment") == "MACHINERY", reserved)
            .when(F.col("c_mktsegment") == "BUILDING", wrapped).otherwise(plain))
    accented = F.regexp_replace("c_name", "Customer", "Úsér ")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", profile_url(href).alias("profile"),
        normalize_username(F.concat(F.lit(" @"), handle, F.lit(" "))).alias("username"),
        compact(accented).alias("name_key"))


@query("title_words", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
       lambda w: upper(left(w, 1)) || lower(substr(w, 2))), '2') AS titled FROM part""")
def title_words(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", title_case(F.replace(F.upper("p_name"), F.lit(" "), F.lit("2"))).alias("titled"))
