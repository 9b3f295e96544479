"""The driver tables seen as candidates, pages, leads and search answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.driver.registry import table
from leadloom.params import Params
from leadloom.schemas import LEAD_COLUMNS, LEAD_FIELDS, candidates_from

# words that occur in the invented texts, so that most branches of the rules are reached
PARAMS = Params(
    as_of="2001-08-01T00:00:00+00:00",
    target_niches=("building", "household", "furniture"),
    target_languages=("en", "fr"),
    target_countries=tuple(f"NATION_{i}" for i in range(10)),
    talking_head_hints=("that",), podcast_hints=("shthe",), educational_hints=("ung",),
    caption_hints=("worthless",), short_form_hints=("ment",), commercial_words=("with",),
)

EVENTS_AS_OF = "2024-01-31T00:00:00+00:00"


def iso(value: Column) -> Column:
    """A timestamp without zone as ISO text, independent of the session's zone."""
    return F.replace(value.cast("string"), F.lit(" "), F.lit("T"))


def customer_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as candidates: segment as niche, nation as country, document as text."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.col("source").alias("site"))
    nation = table(spark, sf_dir, "nation")
    joined = (table(spark, sf_dir, "customer")
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
              .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
              .join(documents, F.col("c_custkey") == F.col("doc_id"), "left"))
    balance = F.floor("c_acctbal")
    return candidates_from(
        joined, ord=F.col("c_custkey"), source=F.lit("CUSTOMER"), platform=F.lit("Web"),
        provider_id=F.col("c_custkey").cast("string"), name=F.col("c_name"),
        website=F.when(F.col("site").isNull(), "").otherwise(
            F.concat(F.lit("https://"), F.col("site"), F.lit(".example.com"))),
        niche=F.lower("c_mktsegment"),
        country=F.when(F.col("n_regionkey") == 4, "UNKNOWN").otherwise(F.coalesce("n_name", F.lit("UNKNOWN"))),
        language=F.coalesce("lang", F.lit("UNKNOWN")),
        followers=F.when(balance >= -500, balance),
        recent_activity=F.coalesce(iso(F.col("last_order")), F.lit("UNKNOWN")),
        published_at=F.coalesce(iso(F.col("last_order")), F.lit("")),
        raw_text=F.coalesce("text", F.lit("")))


CUSTOMER_CANDIDATES_SQL = """
cand AS (
  SELECT c_custkey, c_name AS name, lower(c_mktsegment) AS niche,
         CASE WHEN n_regionkey = 4 THEN 'UNKNOWN' ELSE coalesce(n_name, 'UNKNOWN') END AS country,
         coalesce(lang, 'UNKNOWN') AS language,
         CASE WHEN floor(c_acctbal) >= -500 THEN CAST(floor(c_acctbal) AS BIGINT) END AS followers,
         last_order, coalesce(text, '') AS raw_text,
         CASE WHEN source IS NULL THEN '' ELSE 'https://' || source || '.example.com' END AS website
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON c_custkey = o_custkey
  LEFT JOIN documents ON c_custkey = doc_id
)"""

SCORED_SQL = CUSTOMER_CANDIDATES_SQL + """,
texts AS (SELECT *, lower(name || '  ' || raw_text) AS t, lower(' ' || raw_text) AS body FROM cand),
kinds AS (
  SELECT *, CASE WHEN contains(t, 'that') THEN 'talking_head' WHEN contains(t, 'shthe') THEN 'podcast'
                 WHEN contains(t, 'ung') THEN 'educational' ELSE 'UNKNOWN' END AS content_type FROM texts),
captions AS (
  SELECT *, CASE WHEN contains(body, 'worthless') OR content_type <> 'UNKNOWN' THEN 'GOOD'
                 WHEN contains(body, 'ment') THEN 'DECENT' ELSE 'UNKNOWN' END AS caption_opportunity FROM kinds),
signals AS (
  SELECT *,
    CASE WHEN niche IN ('building', 'household', 'furniture') OR contains(t, 'building')
           OR contains(t, 'household') OR contains(t, 'furniture') THEN 18 ELSE 0 END AS s1,
    CASE WHEN language = 'UNKNOWN' THEN 2 WHEN language IN ('en', 'fr') THEN 10 ELSE 0 END AS s2,
    CASE WHEN country = 'UNKNOWN' THEN 1 WHEN regexp_full_match(country, 'NATION_[0-9]') THEN 8 ELSE 0 END AS s3,
    CASE WHEN followers BETWEEN 500 AND 500000 THEN 15 WHEN followers > 0 THEN 4 ELSE 0 END AS s4,
    CASE WHEN last_order IS NULL THEN 0 WHEN date_diff('day', last_order::DATE, DATE '2001-08-01') <= 15 THEN 15
         WHEN date_diff('day', last_order::DATE, DATE '2001-08-01') <= 45 THEN 10
         WHEN date_diff('day', last_order::DATE, DATE '2001-08-01') <= 90 THEN 4 ELSE 0 END AS s5,
    CASE WHEN content_type <> 'UNKNOWN' THEN 16 ELSE 0 END AS s6,
    CASE caption_opportunity WHEN 'GOOD' THEN 13 WHEN 'DECENT' THEN 7 ELSE 0 END AS s7,
    CASE WHEN website <> '' THEN 5 ELSE 0 END AS s8,
    CASE WHEN contains(t, 'with') THEN 8 ELSE 0 END AS s9
  FROM captions),
scored AS (
  SELECT *, least(100, s1 + s2 + s3 + s4 + s5 + s6 + s7 + s8 + s9) AS score FROM signals),
classed AS (
  SELECT *, CASE WHEN score >= 80 THEN 'HOT' WHEN score >= 65 THEN 'GOOD' WHEN score >= 50 THEN 'POSSIBLE'
                 ELSE 'LOW' END AS classification FROM scored)"""


def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages table with the content type a fetch would have recorded."""
    return table(spark, sf_dir, "pages").withColumn("content_type", F.lit("text/html"))


def _lead_rows(df: DataFrame, order: Column, order_name: str, **values: Column) -> DataFrame:
    defaults = {column: F.lit(default) for column, _, default in LEAD_COLUMNS}
    chosen = {**defaults, **values}
    return df.select(order.alias(order_name), *[
        chosen[c].try_cast("bigint" if c == "followers" else "int" if c == "lead_score" else "string").alias(c)
        for c in LEAD_FIELDS])


def stored_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored lead table: every document and every supplier, in that order."""
    documents = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    labelled = F.col("quality").isNotNull()
    from_documents = _lead_rows(
        documents, F.col("doc_id"), "row_no",
        lead_id=F.concat(F.lit("c"), F.col("doc_id")),
        discovered_at=F.when(labelled, "2001-01-05T00:00:00+00:00").otherwise(""),
        last_checked=F.lit("2001-01-05T00:00:00+00:00"), source=F.lit("DOCUMENT"),
        name=F.concat(F.lit("doc "), F.col("doc_id")), platform=F.lit("Web"),
        email=F.when(labelled, F.concat(F.lit("d"), F.col("doc_id"), F.lit("@site.test"))).otherwise(" "),
        email_status=F.when(F.col("quality") == 1, "VERIFIED_PUBLIC_SOURCE").otherwise("UNKNOWN"),
        niche=F.col("source"), country=F.lit(""), language=F.col("lang"),
        followers=F.col("n_chars"), lead_score=F.least(F.lit(100), F.floor(F.col("n_chars") / 50)),
        classification=F.when(F.col("n_chars") > 2000, "hot").otherwise("LOW"),
        status=F.when(F.col("toxic") == 1, "CONTACTED").otherwise(""),
        instagram_url=F.when(F.col("lang") == "fr", F.concat(F.lit("https://www.instagram.com/d"), F.col("doc_id"), F.lit("/"))).otherwise(""),
        instagram_status=F.when(F.col("lang") == "de", "").otherwise("NOT_FOUND"),
        outreach_status=F.when(F.col("toxic") == 0, "sent").otherwise(""))
    last_document = F.lit(1 << 40)
    suppliers = table(spark, sf_dir, "supplier")
    from_suppliers = _lead_rows(
        suppliers, last_document + F.col("s_suppkey"), "row_no",
        lead_id=F.concat(F.lit("s"), F.col("s_suppkey")),
        discovered_at=F.lit("2001-02-01T00:00:00+00:00"), last_checked=F.lit("2001-02-01T00:00:00+00:00"),
        source=F.lit("SUPPLIER"), name=F.col("s_name"), platform=F.lit("Web"), niche=F.lit("supply"),
        country=F.concat(F.lit("NATION_"), F.col("s_nationkey")), language=F.lit(""),
        lead_score=F.floor(F.greatest(F.lit(0), F.col("s_acctbal")) / 100),
        classification=F.when(F.col("s_acctbal") > 5000, "HOT").otherwise("GOOD"))
    return from_documents.unionByName(from_suppliers)


def order_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of leads: every order updates the lead of its customer, in order of its key."""
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return _lead_rows(
        orders, F.col("o_orderkey"), "ord",
        lead_id=F.concat(F.lit("c"), F.col("o_custkey")),
        discovered_at=iso(F.col("o_orderdate")), last_checked=F.lit(PARAMS.as_of), source=F.lit("ORDER"),
        name=F.concat(F.lit("order "), F.col("o_orderkey")), platform=F.lit("Web"),
        email=F.when(F.col("o_totalprice") > 150000, F.concat(F.lit("o"), F.col("o_orderkey"), F.lit("@shop.test"))).otherwise(""),
        email_status=F.when(F.col("o_totalprice") > 150000, "VERIFIED_PUBLIC_SOURCE").otherwise("UNKNOWN"),
        niche=F.col("o_orderpriority"), country=F.col("o_orderstatus"), language=F.lit("en"),
        lead_score=F.least(F.lit(100), F.floor(F.col("o_totalprice") / 5000)),
        classification=F.when(F.col("o_totalprice") > 400000, "HOT").otherwise("GOOD"),
        status=F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "O", "NEW").otherwise("REVIEWED"),
        instagram_url=F.when(urgent, F.concat(F.lit("https://www.instagram.com/o"), F.col("o_orderkey"), F.lit("/"))).otherwise(""),
        instagram_status=F.when(urgent & (F.col("o_orderstatus") == "P"), "").when(urgent, "FOUND_SEARCH_RESULT")
        .when(F.col("o_orderstatus") == "F", "").otherwise("NOT_CHECKED"),
        instagram_search_query=F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("q"), F.col("o_orderkey"))).otherwise(""),
        outreach_status=F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("s"), F.col("o_orderkey"))).otherwise(""))


STORED_SQL = """
stored AS (
  SELECT doc_id AS row_no, 'c' || doc_id AS lead_id,
         CASE WHEN quality IS NOT NULL THEN '2001-01-05T00:00:00+00:00' ELSE '' END AS discovered_at,
         'DOCUMENT' AS source, 'doc ' || doc_id AS name,
         CASE WHEN quality IS NOT NULL THEN 'd' || doc_id || '@site.test' ELSE ' ' END AS email,
         CASE WHEN quality = 1 THEN 'VERIFIED_PUBLIC_SOURCE' ELSE 'UNKNOWN' END AS email_status,
         d.source AS niche, '' AS country, lang AS language, n_chars AS followers,
         CAST(least(100, floor(n_chars / 50)) AS INT) AS lead_score,
         CASE WHEN n_chars > 2000 THEN 'hot' ELSE 'LOW' END AS classification,
         CASE WHEN toxic = 1 THEN 'CONTACTED' ELSE '' END AS status,
         CASE WHEN lang = 'fr' THEN 'https://www.instagram.com/d' || doc_id || '/' ELSE '' END AS instagram_url,
         CASE WHEN lang = 'de' THEN '' ELSE 'NOT_FOUND' END AS instagram_status,
         '' AS instagram_search_query,
         CASE WHEN toxic = 0 THEN 'sent' ELSE '' END AS outreach_status
  FROM documents d LEFT JOIN labels USING (doc_id)
  UNION ALL
  SELECT 1099511627776 + s_suppkey, 's' || s_suppkey, '2001-02-01T00:00:00+00:00', 'SUPPLIER', s_name, '', '',
         'supply', 'NATION_' || s_nationkey, '', NULL, CAST(floor(greatest(0, s_acctbal) / 100) AS INT),
         CASE WHEN s_acctbal > 5000 THEN 'HOT' ELSE 'GOOD' END, 'NEW', '', 'NOT_CHECKED', '', ''
  FROM supplier)"""

MERGED_SQL = STORED_SQL + """,
batch AS (
  SELECT o_orderkey AS ord, 'c' || o_custkey AS lead_id,
         replace(CAST(o_orderdate AS VARCHAR), ' ', 'T') AS discovered_at, 'ORDER' AS source,
         'order ' || o_orderkey AS name,
         CASE WHEN o_totalprice > 150000 THEN 'o' || o_orderkey || '@shop.test' ELSE '' END AS email,
         CASE WHEN o_totalprice > 150000 THEN 'VERIFIED_PUBLIC_SOURCE' ELSE 'UNKNOWN' END AS email_status,
         o_orderpriority AS niche, o_orderstatus AS country, 'en' AS language, CAST(NULL AS BIGINT) AS followers,
         CAST(least(100, floor(o_totalprice / 5000)) AS INT) AS lead_score,
         CASE WHEN o_totalprice > 400000 THEN 'HOT' ELSE 'GOOD' END AS classification,
         CASE o_orderstatus WHEN 'P' THEN '' WHEN 'O' THEN 'NEW' ELSE 'REVIEWED' END AS status,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'https://www.instagram.com/o' || o_orderkey || '/' ELSE '' END AS instagram_url,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN ''
              WHEN o_orderpriority = '1-URGENT' THEN 'FOUND_SEARCH_RESULT'
              WHEN o_orderstatus = 'F' THEN '' ELSE 'NOT_CHECKED' END AS instagram_status,
         CASE WHEN o_orderstatus = 'O' THEN 'q' || o_orderkey ELSE '' END AS instagram_search_query,
         CASE WHEN o_orderpriority = '5-LOW' THEN 's' || o_orderkey ELSE '' END AS outreach_status
  FROM orders),
url_at AS (
  SELECT lead_id, max(ord) FILTER (instagram_url <> '') AS url_ord FROM batch GROUP BY 1),
folded AS (
  SELECT lead_id, arg_min(discovered_at, ord) AS discovered_at, arg_max(source, ord) AS source,
         arg_max(name, ord) AS name, arg_max(email, ord) AS email, arg_max(email_status, ord) AS email_status,
         arg_max(niche, ord) AS niche, arg_max(country, ord) AS country, arg_max(language, ord) AS language,
         arg_max(lead_score, ord) AS lead_score, arg_max(classification, ord) AS classification,
         coalesce(arg_min(status, ord) FILTER (status <> ''), '') AS status,
         coalesce(arg_max(instagram_url, ord) FILTER (instagram_url <> ''), '') AS instagram_url,
         arg_max(instagram_status, ord) AS last_ig_status, arg_max(instagram_search_query, ord) AS last_ig_query,
         coalesce(arg_min(instagram_status, ord) FILTER (instagram_status <> '' AND (url_ord IS NULL OR ord >= url_ord)), '') AS since_status,
         coalesce(arg_min(instagram_search_query, ord) FILTER (instagram_search_query <> '' AND (url_ord IS NULL OR ord >= url_ord)), '') AS since_query,
         coalesce(arg_min(outreach_status, ord) FILTER (outreach_status <> ''), '') AS outreach_status,
         max(url_ord) AS url_ord, max(ord) AS last_ord, min(ord) AS first_ord, count(*) AS n
  FROM batch JOIN url_at USING (lead_id) GROUP BY 1),
merged AS (
  SELECT lead_id, coalesce(nullif(s.discovered_at, ''), f.discovered_at, s.discovered_at) AS discovered_at,
         coalesce(f.source, s.source) AS source, coalesce(f.name, s.name) AS name,
         coalesce(f.email, s.email) AS email, coalesce(f.email_status, s.email_status) AS email_status,
         coalesce(f.niche, s.niche) AS niche, coalesce(f.country, s.country) AS country,
         coalesce(f.language, s.language) AS language,
         CASE WHEN f.n IS NULL THEN s.followers END AS followers,
         coalesce(f.lead_score, s.lead_score) AS lead_score,
         coalesce(f.classification, s.classification) AS classification,
         coalesce(nullif(s.status, ''), f.status, s.status) AS status,
         CASE WHEN f.n IS NULL THEN s.instagram_url WHEN f.instagram_url <> '' THEN f.instagram_url
              ELSE coalesce(s.instagram_url, '') END AS instagram_url,
         CASE WHEN f.n IS NULL THEN s.instagram_status
              WHEN f.url_ord = f.last_ord THEN f.last_ig_status
              WHEN f.url_ord IS NOT NULL THEN f.since_status
              WHEN s.instagram_url <> '' THEN coalesce(nullif(s.instagram_status, ''), f.since_status)
              ELSE f.last_ig_status END AS instagram_status,
         CASE WHEN f.n IS NULL THEN s.instagram_search_query
              WHEN f.url_ord = f.last_ord THEN f.last_ig_query
              WHEN f.url_ord IS NOT NULL THEN f.since_query
              WHEN s.instagram_url <> '' THEN coalesce(nullif(s.instagram_search_query, ''), f.since_query)
              ELSE f.last_ig_query END AS instagram_search_query,
         coalesce(nullif(s.outreach_status, ''), f.outreach_status, s.outreach_status) AS outreach_status,
         s.row_no, f.first_ord, f.n
  FROM stored s FULL JOIN folded f USING (lead_id))"""

MERGED_FIELDS = ["lead_id", "discovered_at", "source", "name", "email", "email_status", "niche", "country",
                 "language", "followers", "lead_score", "classification", "status", "instagram_url",
                 "instagram_status", "instagram_search_query", "outreach_status"]
