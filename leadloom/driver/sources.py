"""Queries on sources: API answers, pages, feeds, sitemaps, site visits, the union of sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.constants import WEB_SOCIAL_HOSTS
from leadloom.driver.adapters import PARAMS, iso, stored_pages
from leadloom.driver.registry import query, table
from leadloom.driver.text import CANONICAL_SQL
from leadloom.operators.sites import best_site_email, page_links, parse_site_pages, site_emails, social_links, visit_sites
from leadloom.params import Params
from leadloom.schemas import candidates_from
from leadloom.sources.api import (
    CHANNEL_SCHEMA, SEARCH_SCHEMA, VIDEO_SCHEMA, channel_candidates, channel_rollup, channel_videos, describe_channels, first_videos,
    search_hits,
)
from leadloom.sources.registry import union_sources
from leadloom.sources.web import feed_candidates, page_candidates, seed_candidates, sitemap_candidates


def _answers(df, text, schema, *keep):
    """Parse a column of answer texts the way the readers parse files."""
    parsed = df.select("answer_no", F.from_json(text, schema).alias("a"))
    return parsed.select("answer_no", "a.*")


def _event_search(spark, sf_dir):
    """Every event as an answer with one hit: the user is the channel, its type the query."""
    item = F.struct(
        F.struct(F.when(F.col("event_type") != "error", F.concat(F.lit("v"), F.col("event_id"))).alias("videoId")).alias("id"),
        F.struct(F.when(F.col("value") > 5, F.concat(F.lit("u"), F.col("user_id"))).alias("channelId"),
                 iso(F.col("ts")).alias("publishedAt")).alias("snippet"))
    text = F.to_json(F.struct(F.col("event_type").alias("query"), F.array(item).alias("items")))
    raw = table(spark, sf_dir, "events").select(F.col("event_id").alias("answer_no"), text.alias("text"))
    return search_hits(_answers(raw, "text", SEARCH_SCHEMA))


@query("channel_rollup", """
SELECT 'u' || user_id AS channel_id, replace(CAST(max(ts) AS VARCHAR), ' ', 'T') AS published_at,
       arg_max(event_type, event_id) AS query, count(*) FILTER (event_type <> 'error') AS n_videos
FROM events WHERE value > 5 GROUP BY 1""")
def channel_rollup_query(spark, sf_dir):
    return channel_rollup(_event_search(spark, sf_dir)).select("channel_id", "published_at", "query", "n_videos")


@query("first_videos", """
SELECT 'u' || user_id AS channel_id, string_agg('v' || event_id, ',' ORDER BY event_id) AS videos FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events WHERE value > 5 AND event_type <> 'error')
WHERE rn <= 4 GROUP BY 1""")
def first_videos_query(spark, sf_dir):
    return first_videos(_event_search(spark, sf_dir), 4).select("channel_id", F.array_join("video_ids", ",").alias("videos"))


@query("channel_videos", """
SELECT 'u' || user_id AS channel_id, 'v' || event_id AS video_id, event_id AS answer_no FROM events WHERE value > 5 AND event_type <> 'error'""")
def channel_videos_query(spark, sf_dir):
    """All videos of every channel, as rows."""
    return channel_videos(_event_search(spark, sf_dir)).select("channel_id", "video_id", F.col("hit_ord.answer_no").alias("answer_no"))


def _customer_channels(spark, sf_dir):
    """Customers as channel answers with one item; their document is the description."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    joined = table(spark, sf_dir, "customer").join(documents, F.col("c_custkey") == F.col("doc_id"), "left")
    site = F.concat(F.lit(" see https://www.youtube.com/c and HTTP://Www."), F.col("source"), F.lit(".test/Shop/?utm_source=a)."))
    country = F.when(F.col("c_nationkey") < 5, "BE").when(F.col("c_nationkey") < 10, "US")
    item = F.struct(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("id"),
        F.struct(F.col("c_name").alias("title"), F.concat("text", site).alias("description"),
                 F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("@"), F.col("c_name"))).alias("customUrl"),
                 F.when(F.col("lang") == "es", F.col("lang")).alias("defaultLanguage")).alias("snippet"),
        F.struct(F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal").cast("string")).otherwise("hidden").alias("subscriberCount")).alias("statistics"),
        F.struct(F.struct(F.lit("from branding").alias("description"), country.alias("country")).alias("channel")).alias("brandingSettings"))
    raw = joined.select(F.col("c_custkey").alias("answer_no"), F.to_json(F.struct(F.array(item).alias("items"))).alias("text"))
    return _answers(raw, "text", CHANNEL_SCHEMA)


def _order_hits(spark, sf_dir):
    item = F.struct(F.struct(F.concat(F.lit("o"), F.col("o_orderkey")).alias("videoId")).alias("id"),
                    F.struct(F.concat(F.lit("c"), F.col("o_custkey")).alias("channelId"), iso(F.col("o_orderdate")).alias("publishedAt")).alias("snippet"))
    recent = table(spark, sf_dir, "orders").filter("o_totalprice > 100000")
    raw = recent.select(F.col("o_orderkey").alias("answer_no"),
                        F.to_json(F.struct(F.col("o_orderpriority").alias("query"), F.array(item).alias("items"))).alias("text"))
    return search_hits(_answers(raw, "text", SEARCH_SCHEMA))


@query("channel_candidates", """
WITH hits AS (SELECT o_custkey, replace(CAST(max(o_orderdate) AS VARCHAR), ' ', 'T') AS published_at, arg_max(o_orderpriority, o_orderkey) AS niche
              FROM orders WHERE o_totalprice > 100000 GROUP BY 1)
SELECT 'c' || c_custkey AS provider_id, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN '@' || c_name ELSE 'UNKNOWN' END AS username,
       CASE WHEN text IS NULL THEN '' ELSE 'https://' || source || '.test/Shop' END AS website,
       CASE WHEN text IS NULL THEN '' ELSE 'https://youtube.com/c,https://' || source || '.test/Shop' END AS links,
       coalesce(niche, 'UNKNOWN') AS niche, CASE WHEN c_nationkey < 5 THEN 'BE' WHEN c_nationkey < 10 THEN 'US' ELSE 'UNKNOWN' END AS country,
       CASE WHEN lang = 'es' THEN 'es' WHEN c_nationkey < 5 THEN 'fr' WHEN c_nationkey < 10 THEN 'en' ELSE 'UNKNOWN' END AS language,
       CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS followers, coalesce(published_at, '') AS published_at,
       coalesce(published_at, 'UNKNOWN') AS recent_activity,
       md5(CASE WHEN text IS NULL THEN 'from branding' ELSE text || ' see https://www.youtube.com/c and HTTP://Www.' || source || '.test/Shop/?utm_source=a).' END) AS text_md5
FROM customer LEFT JOIN documents ON c_custkey = doc_id LEFT JOIN hits ON c_custkey = o_custkey""")
def channel_candidates_query(spark, sf_dir):
    found = channel_candidates(_customer_channels(spark, sf_dir), _order_hits(spark, sf_dir), PARAMS)
    return found.select("provider_id", "name", "username", "website", F.array_join("raw_links", ",").alias("links"), "niche", "country",
                        "language", "followers", "published_at", "recent_activity", F.md5("raw_text").alias("text_md5"))


@query("video_text_merge", """
WITH early AS (
  SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
texts AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS more, count(*) AS n FROM early
          WHERE rn <= 4 AND turn % 3 <> 1 AND text <> '' GROUP BY 1)
SELECT doc_id, md5(CASE WHEN more IS NULL THEN text ELSE text || chr(10) || chr(10) || more END) AS text_md5, CAST(n AS INT) AS video_descriptions_checked
FROM documents LEFT JOIN texts ON doc_id = conv_id""")
def video_text_merge(spark, sf_dir):
    """Every turn as a video of its conversation, some without a description: the first four found are wanted."""
    video, channel = F.concat(F.lit("v"), F.col("conv_id"), F.lit("-"), F.col("turn")), F.col("conv_id").cast("string")
    described = F.struct(video.alias("id"), F.struct(
        channel.alias("channelId"), F.when(F.col("turn") % 3 != 1, F.col("text")).otherwise("").alias("description")).alias("snippet"))
    hit = F.struct(F.struct(video.alias("videoId")).alias("id"), F.struct(channel.alias("channelId")).alias("snippet"))
    raw = table(spark, sf_dir, "conversations").select(F.col("turn").alias("answer_no"), *[
        F.to_json(F.struct(F.array(item).alias("items"))).alias(name) for name, item in (("video", described), ("hit", hit))])
    videos, hits = _answers(raw, "video", VIDEO_SCHEMA), search_hits(_answers(raw, "hit", SEARCH_SCHEMA))
    documents = table(spark, sf_dir, "documents")
    candidates = candidates_from(documents, ord=F.col("doc_id"), source=F.lit("YOUTUBE"), platform=F.lit("YouTube"),
                                 provider_id=F.col("doc_id").cast("string"), raw_text=F.col("text"))
    merged = describe_channels(candidates, videos, hits, PARAMS.videos_per_channel)
    return merged.select(F.col("ord").alias("doc_id"), F.md5("raw_text").alias("text_md5"), "video_descriptions_checked")


@query("seed_candidates", f"""
WITH {CANONICAL_SQL}
SELECT page_id, domain AS provider_id, canonical AS profile_url,
       array_to_string(list_transform(string_split(split_part(domain, '.', 1), '-'), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS name FROM canon""")
def seed_candidates_query(spark, sf_dir):
    seeds = table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("pos"))
    return seed_candidates(seeds, provider_rank=0).select(F.col("ord").alias("page_id"), "provider_id", "profile_url", "name")


@query("web_candidates", f"""
WITH {CANONICAL_SQL},
heads AS (SELECT page_id, trim(regexp_replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&quot;', '"'), '&amp;?', '&', 'g')) AS t FROM pages)
SELECT page_id, domain AS provider_id, url AS profile_url, 'https://' || domain AS website, CASE WHEN t = '' THEN domain ELSE t END AS name, t || ' ' AS raw_text
FROM canon JOIN heads USING (page_id)""")
def web_candidates(spark, sf_dir):
    found = page_candidates(stored_pages(spark, sf_dir), PARAMS, provider_rank=0)
    return found.select(F.col("ord").alias("page_id"), "provider_id", "profile_url", "website", "name", "raw_text")


@query("web_readable", f"""
WITH {CANONICAL_SQL}
SELECT page_id, domain AS provider_id FROM canon
WHERE page_id % 4 IN (0, 1) OR contains(lower(left(CASE page_id % 4 WHEN 2 THEN html ELSE 'no page ' || repeat('-', 500) || html END, 500)), '<html')""")
def web_readable(spark, sf_dir):
    """Pages whose type says nothing are told by how they open; a page far behind other text is none."""
    by_four = F.col("page_id") % 4
    pages = table(spark, sf_dir, "pages").withColumns({
        "content_type": F.when(by_four == 0, "text/html; charset=utf-8").when(by_four == 1, "Application/XHTML+xml").when(by_four == 2, "text/plain"),
        "html": F.when(by_four == 3, F.concat(F.lit("no page "), F.repeat(F.lit("-"), 500), F.col("html"))).otherwise(F.col("html"))})
    found = page_candidates(pages, PARAMS, provider_rank=0)
    return found.select(F.col("ord").alias("page_id"), "provider_id")


@query("web_socials", """
SELECT page_id, 'https://instagram.com/u' || page_id || ',https://linkedin.com/in/u' || page_id AS links FROM pages""")
def web_socials(spark, sf_dir):
    """Social links of every page, behind links of its own."""
    added = F.concat(F.lit('<a href="HTTP://www.Instagram.com/u'), F.col("page_id"), F.lit('/?utm_source=p">i</a><a href="https://linkedin.com/in/u'),
                     F.col("page_id"), F.lit('">l</a><a href="https://instagram.com/u'), F.col("page_id"), F.lit('">again</a>'))
    pages = stored_pages(spark, sf_dir).withColumn("html", F.concat("html", added))
    links = social_links(page_links(F.col("html"), F.col("url")), WEB_SOCIAL_HOSTS)
    return pages.select("page_id", F.array_join(links, ",").alias("links"))


def _xml(text):
    safe = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.regexp_replace(safe, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


@query("feed_candidates", """
WITH early AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 2 THEN '' ELSE trim(text, chr(10) || ' ') END AS t,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)
SELECT conv_id, 'conv' || conv_id || '.test' AS provider_id, 'Feed ' || conv_id AS name, md5(string_agg(t, ' ' ORDER BY turn)) AS summary_md5,
       'day ' || min(turn) AS published_at FROM early WHERE rn <= 5 GROUP BY conv_id""")
def feed_candidates_query(spark, sf_dir):
    """Every conversation as a feed of all its turns: some without a title, some in sections of character data."""
    turns = table(spark, sf_dir, "conversations")
    plain = F.replace(F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), F.lit("]]>"), F.lit("]]]]><![CDATA[>"))
    title = (F.when(F.col("turn") % 5 == 2, "")
             .when(F.col("turn") % 5 == 3, F.concat(F.lit("<title><![CDATA["), plain, F.lit("]]></title>")))
             .otherwise(F.concat(F.lit("<title>"), _xml(F.col("text")), F.lit("</title>"))))
    entry = F.concat(F.lit("<item>"), title, F.lit("<pubDate>day "), F.col("turn"), F.lit("</pubDate></item>"))
    feeds = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", entry.alias("x")))).alias("v")).select(
        F.col("conv_id").alias("pos"), F.lit("https://feeds.test/all.xml").alias("url"),
        F.concat(F.lit("<rss version='2.0'><channel><title>Feed "), F.col("conv_id"), F.lit("</title><link>http://www.Conv"), F.col("conv_id"),
                 F.lit(".test</link>"), F.array_join(F.transform("v", lambda e: e["x"]), ""), F.lit("</channel></rss>")).alias("xml"))
    found = feed_candidates(feeds, PARAMS, provider_rank=0)
    return found.select(F.col("ord").alias("conv_id"), "provider_id", "name", F.md5("raw_text").alias("summary_md5"), "published_at")


@query("sitemap_first_per_domain", f"""
WITH {CANONICAL_SQL},
locs AS (SELECT page_id, 0 AS place, domain, canonical AS url FROM canon WHERE len(html) > 0
         UNION ALL SELECT page_id, 1, 'map.' || domain, 'https://map.' || domain || '/first' FROM canon
         UNION ALL SELECT page_id, 2, 'map.' || domain, 'https://map.' || domain || '/second' FROM canon
         UNION ALL SELECT page_id, 3, domain, 'https://' || domain || '/again' FROM canon)
SELECT page_id, domain, arg_min(url, place) AS url FROM locs GROUP BY 1, 2""")
def sitemap_first_per_domain(spark, sf_dir):
    """Every page as a map of four locations on two domains."""
    host = F.regexp_replace(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), r"^www\.", "")

    def loc(text):
        return F.concat(F.lit("<url><loc> "), text, F.lit(" </loc></url>"))

    xml = F.concat(F.lit("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>"), loc(_xml(F.col("url"))),
                   loc(F.concat(F.lit("http://MAP."), host, F.lit("/first/"))), loc(F.concat(F.lit("https://map."), host, F.lit("/second"))),
                   loc(F.concat(F.lit("https://"), host, F.lit("/again"))), F.lit("</urlset>"))
    maps = table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), xml.alias("xml"))
    found = sitemap_candidates(maps, PARAMS, provider_rank=0)
    return found.select(F.shiftright("ord", 10).alias("page_id"), F.col("provider_id").alias("domain"), F.col("profile_url").alias("url"))


@query("source_union", f"""
WITH {CANONICAL_SQL}, found AS (
  SELECT 'SEED' AS source, domain FROM canon UNION ALL SELECT 'WEB', domain FROM canon)
SELECT source, count(*) AS candidates, count(DISTINCT domain) AS domains, 1 AS failed_sources FROM found GROUP BY 1""")
def source_union(spark, sf_dir):
    sources = {
        "SITEMAP": lambda s, p: s.read.parquet(f"{sf_dir}/no-such-table.parquet"),
        "WEB": lambda s, p: page_candidates(stored_pages(s, sf_dir), p),
        "SEED": lambda s, p: seed_candidates(table(s, sf_dir, "pages").select("url", F.col("page_id").alias("pos"))),
    }
    found, failures = union_sources(spark, sources, PARAMS)
    failed = failures.agg(F.count(F.lit(1))).scalar()
    return (found.groupBy("source").agg(F.count(F.lit(1)).alias("candidates"), F.countDistinct("provider_id").alias("domains"))
            .withColumn("failed_sources", failed))


# every page can be visited: all paths of the pages table start with a language
_ALL_PAGES = Params(as_of=PARAMS.as_of, contact_link_tokens=("/",))


@query("site_emails", f"""
WITH {CANONICAL_SQL},
firsts AS (SELECT canonical, min(page_id) AS page_id FROM canon GROUP BY 1),
hits AS (SELECT c.domain, c.url, c.page_id, unnest(regexp_extract_all(c.html, '[A-Za-z0-9.]+@mail[0-9]+[.]example[.]com', 0)) AS email FROM canon c JOIN firsts USING (page_id))
SELECT domain, lower(email) AS email, arg_min(url, page_id) AS source_url FROM hits GROUP BY 1, 2""")
def site_emails_query(spark, sf_dir):
    parsed = parse_site_pages(stored_pages(spark, sf_dir), _ALL_PAGES)
    visits = parsed.select("domain", F.col("page_id").alias("visit_no"), "page", "url", "emails", "socials")
    return site_emails(visits).select("domain", "email", "source_url")


@query("best_site_email", f"""
WITH {CANONICAL_SQL},
firsts AS (SELECT canonical, min(page_id) AS page_id FROM canon GROUP BY 1),
hits AS (SELECT c.domain, c.url, c.page_id, unnest(regexp_extract_all(c.html, '[A-Za-z0-9.]+@mail[0-9]+[.]example[.]com', 0)) AS email FROM canon c JOIN firsts USING (page_id)),
ranked AS (SELECT domain, lower(email) AS email, url, page_id, position(email IN html) AS place FROM hits JOIN canon USING (page_id, domain, url))
SELECT domain, email AS site_email, url AS site_email_url, CAST(20 AS INT) AS site_preference FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY page_id, place) AS rn FROM ranked) WHERE rn = 1""")
def best_site_email_query(spark, sf_dir):
    parsed = parse_site_pages(stored_pages(spark, sf_dir), _ALL_PAGES)
    visits = parsed.select("domain", F.col("page_id").alias("visit_no"), "page", "url", "emails", "socials")
    return best_site_email(site_emails(visits))


@query("in_domain_links", f"""
WITH {CANONICAL_SQL}, links AS (
  SELECT page_id, domain, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM canon),
each AS (SELECT page_id, domain, unnest(hs) AS h FROM links)
SELECT page_id, count(*) AS links, count(*) FILTER (contains(lower(h), 'th')) AS th_links,
       count(DISTINCT h) AS distinct_links FROM each GROUP BY 1""")
def in_domain_links(spark, sf_dir):
    from leadloom.operators.sites import contact_links

    pages = table(spark, sf_dir, "pages")
    linked = pages.select("page_id", page_links(F.col("html"), F.col("url")).alias("links"),
                          F.regexp_replace(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), r"^www\.", "").alias("domain"))
    wanted = Params(as_of=PARAMS.as_of, contact_link_tokens=("th",))
    return linked.filter(F.size("links") > 0).select(
        "page_id", F.size("links").cast("bigint").alias("links"),
        F.size(contact_links(F.col("links"), F.col("domain"), wanted)).cast("bigint").alias("th_links"),
        F.size(F.array_distinct("links")).cast("bigint").alias("distinct_links"))


def linked_pages(spark, sf_dir):
    """Pages moved to the address of their own first link, so that links lead to stored pages; the
    first page of a domain is moved to its root, where every visit starts."""
    root = F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0)
    pages = stored_pages(spark, sf_dir).withColumn("root", F.regexp_replace(root, r"//www\.", "//"))
    pages = pages.withColumn("root", F.regexp_replace("root", "^http:", "https:"))
    first = pages.groupBy("root").agg(F.min("page_id").alias("first_id"))
    path = F.when(F.col("page_id") == F.col("first_id"), "/").otherwise(F.regexp_extract("html", '<a href="([^"]*)"', 1))
    return pages.join(first, "root").withColumn("url", F.concat("root", path)).drop("root", "first_id")


VISIT_PARAMS = Params(as_of=PARAMS.as_of, contact_link_tokens=("/",))


def _visit_rounds(rounds: int) -> str:
    """Visiting order written out: every round follows the links of the pages of the round before."""
    steps = ["""
roots AS (SELECT *, regexp_replace(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*', 0), '//www[.]', '//'), '^http:', 'https:') AS root FROM pages),
moved AS (SELECT page_id, html, root, root || CASE WHEN page_id = min(page_id) OVER (PARTITION BY root) THEN '/'
                 ELSE regexp_extract(html, '<a href="([^"]*)"', 1) END AS page FROM roots),
stored AS (SELECT page, arg_min(root, page_id) AS root, list_transform(regexp_extract_all(arg_min(html, page_id), '<a href="([^"]*)"', 1),
                  lambda h: arg_min(root, page_id) || h) AS links FROM moved GROUP BY page)""",
             "v0 AS (SELECT root, 1 AS visit_no, page, links FROM stored WHERE page = root || '/')"]
    for i in range(rounds):
        seen = " UNION ALL ".join(f"SELECT * FROM v{j}" for j in range(i + 1))
        steps.append(f"seen{i} AS ({seen})")
        steps.append(f"""link{i} AS (SELECT root, page, min(place) AS place FROM (
            SELECT root, unnest(links) AS page, visit_no * 100000 + generate_subscripts(links, 1) AS place FROM v{i}) GROUP BY 1, 2)""")
        steps.append(f"""v{i + 1} AS (SELECT root, used + rn AS visit_no, page, links FROM (
            SELECT l.root, u.used, l.page, s.links, row_number() OVER (PARTITION BY l.root ORDER BY place) AS rn
            FROM link{i} l JOIN stored s USING (page) JOIN (SELECT root, max(visit_no) AS used FROM seen{i} GROUP BY 1) u ON u.root = l.root
            WHERE l.page NOT IN (SELECT page FROM seen{i})) WHERE used + rn <= 5)""")
    everything = " UNION ALL ".join(f"SELECT * FROM v{j}" for j in range(rounds + 1))
    return f"WITH {', '.join(steps)} SELECT regexp_replace(root, 'https://', '') AS domain, CAST(visit_no AS INT) AS visit_no, page FROM ({everything})"


@query("site_visits", _visit_rounds(5))
def site_visits(spark, sf_dir):
    visits = visit_sites(parse_site_pages(linked_pages(spark, sf_dir), VISIT_PARAMS), VISIT_PARAMS)
    return visits.select("domain", "visit_no", "page")
