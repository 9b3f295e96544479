"""Seeds, web pages, feeds and sitemaps as candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.constants import WEB_SOCIAL_HOSTS
from leadloom.functions.html import hrefs, looks_like_html, meta_description, title
from leadloom.functions.text import blank, filled, strip, title_case
from leadloom.functions.urls import canonical_url, domain_of_canonical, resolve
from leadloom.operators.order import arrival, file_position, first_rows
from leadloom.operators.sites import social_links
from leadloom.params import Params
from leadloom.schemas import candidates_from


def name_from_domain(domain: Column) -> Column:
    return title_case(F.replace(F.substring_index(domain, ".", 1), F.lit("-"), F.lit(" ")))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line; ``pos`` is the position in the files."""
    lines = file_position(spark.read.text(path), "pos")
    return lines.select(strip(F.col("value")).alias("url"), "pos").filter("url != ''")


def seed_candidates(seeds: DataFrame, provider_rank: int = 1) -> DataFrame:
    """Candidates from ``seeds(url, pos)``; a seed without a domain is dropped."""
    known = (seeds.withColumn("url", canonical_url(F.col("url")))
             .withColumn("domain", domain_of_canonical(F.col("url"))).filter("domain != ''"))
    return candidates_from(
        known, ord=arrival(provider_rank, F.col("pos")), source=F.lit("SEED"), platform=F.lit("Web"),
        provider_id=F.col("domain"), name=name_from_domain(F.col("domain")), profile_url=F.col("url"),
        website=F.col("url"), raw_links=F.array("url"), raw_text=F.col("domain"))


def page_candidates(pages: DataFrame, params: Params, provider_rank: int = 2) -> DataFrame:
    """Candidates from ``pages(page_id, url, html, content_type)``, one per readable page."""
    first = first_rows(pages, params.max_seed_pages, "page_id")
    read = first.filter(looks_like_html(F.col("html"), F.col("content_type"))).withColumn(
        "domain", domain_of_canonical(canonical_url(F.col("url")))).filter("domain != ''")
    all_links = F.transform(hrefs(F.col("html")), lambda h: canonical_url(resolve(F.col("url"), h)))
    parsed = read.select(
        "page_id", "url", "domain", title(F.col("html")).alias("title"),
        meta_description(F.col("html")).alias("description"),
        social_links(all_links, WEB_SOCIAL_HOSTS).alias("links"))
    shown = F.coalesce("title", "domain")
    return candidates_from(
        parsed, ord=arrival(provider_rank, F.col("page_id")), source=F.lit("WEB"), platform=F.lit("Web"),
        provider_id=F.col("domain"), name=filled(F.col("title"), F.col("domain")), profile_url=F.col("url"),
        website=F.concat(F.lit("https://"), F.col("domain")), description=F.col("description"),
        raw_links=F.col("links"), raw_text=F.concat(shown, F.lit(" "), F.col("description")),
        social_links=F.col("links"))


_WELL_FORMED = "STRUCT<_corrupt_record: STRING>"


def well_formed(xml: Column) -> Column:
    """True when the text parses as XML."""
    parsed = F.from_xml(xml, _WELL_FORMED, {"mode": "PERMISSIVE"})
    return blank(xml).rlike(r"^\s*<") & parsed["_corrupt_record"].isNull()


def _texts(xml: Column, path: str) -> Column:
    return F.xpath(xml, F.lit(path))


_ENTRY = "STRUCT<title: ARRAY<STRING>, pubDate: ARRAY<STRING>, published: ARRAY<STRING>>"
_HEAD = ("title: ARRAY<STRING>, description: ARRAY<STRING>, subtitle: ARRAY<STRING>, "
         "link: ARRAY<STRUCT<_VALUE: STRING, _href: STRING, _rel: STRING>>")
#: a feed of either kind: a channel with its items in or behind it, or a feed with entries
FEED_SCHEMA = f"STRUCT<channel: STRUCT<{_HEAD}, item: ARRAY<{_ENTRY}>>, item: ARRAY<{_ENTRY}>, {_HEAD}, entry: ARRAY<{_ENTRY}>, _corrupt_record: STRING>"


def feed_candidates(feeds: DataFrame, params: Params, provider_rank: int = 3) -> DataFrame:
    """One candidate per feed from ``feeds(pos, url, xml)``; RSS ``item`` and Atom ``entry`` alike.

    The first ten entries count: the first one dates the feed, the titles of the first five are its summary; an entry
    without a title counts with an empty one. A feed is parsed once, by its schema.
    """
    parsed = feeds.withColumn("f", F.from_xml("xml", FEED_SCHEMA, {"mode": "PERMISSIVE", "ignoreNamespace": "true"}))
    readable = parsed.filter(blank(F.col("xml")).rlike(r"^\s*<") & F.col("f._corrupt_record").isNull())

    def first(texts: Column) -> Column:
        return F.get(texts, F.lit(0))

    def head(name: str) -> Column:
        return F.coalesce(first(F.col(f"f.channel.{name}")), first(F.col(f"f.{name}")))

    def text_link(links: Column) -> Column:
        return first(F.filter(links, lambda x: blank(x["_VALUE"]) != ""))["_VALUE"]

    pointed = F.filter("f.link", lambda x: x["_href"].isNotNull() & F.coalesce(x["_rel"] == "alternate", F.lit(True)))
    entries = F.slice(F.coalesce("f.channel.item", "f.item", "f.entry", F.array().cast(f"ARRAY<{_ENTRY}>")), 1, params.feed_entries)
    read = readable.select("pos", "url", "f", entries.alias("entries")).select(
        "pos", "url",
        strip(blank(F.coalesce(text_link(F.col("f.channel.link")), text_link(F.col("f.link")), first(pointed)["_href"]))).alias("link"),
        strip(blank(head("title"))).alias("title"),
        strip(blank(F.coalesce(head("description"), head("subtitle")))).alias("subtitle"),
        F.transform(F.slice("entries", 1, params.feed_summary_titles), lambda e: strip(blank(first(e["title"])))).alias("titles"),
        strip(blank(F.coalesce(first(first(F.col("entries"))["pubDate"]), first(first(F.col("entries"))["published"])))).alias("published"))
    placed = (read.withColumn("site", filled(canonical_url(F.col("link")), canonical_url(F.col("url")), default=""))
              .withColumn("domain", domain_of_canonical(F.col("site"))).filter("domain != ''")
              .withColumn("summary", F.array_join("titles", " ")))
    return candidates_from(
        placed, ord=arrival(provider_rank, F.col("pos")), source=F.lit("RSS"), platform=F.lit("Web"),
        provider_id=F.col("domain"), name=filled(F.col("title"), F.col("domain")), profile_url=F.col("site"),
        website=F.col("site"), description=filled(F.col("subtitle"), F.col("summary"), default=""),
        published_at=F.col("published"), raw_links=F.array("site", "url"), raw_text=F.col("summary"))


def sitemap_urls(xml: Column, params: Params) -> Column:
    """The first locations of a map: text of every element whose name ends in ``loc``."""
    ends_in_loc = "substring(translate(local-name(),'LOC','loc'),string-length(local-name())-2)='loc'"
    found = F.when(well_formed(xml), _texts(xml, f"//*[{ends_in_loc}]/node()[1][self::text()]"))
    return F.transform(F.slice(found, 1, params.sitemap_locs), strip)


def first_per_domain(urls: Column) -> Column:
    """``array<struct<place, domain, url>>``: the first URL of every domain in an array.

    The array is short (the limit of a map), so the whole step stays inside the row.
    """
    listed = F.transform(urls, lambda u, i: F.struct(
        i.alias("place"), domain_of_canonical(u).alias("domain"), u.alias("url")))
    domains = F.transform(urls, domain_of_canonical)
    return F.filter(listed, lambda x: (x["domain"] != "") & (
        F.array_position(domains, x["domain"]) == x["place"] + 1))


def sitemap_candidates(maps: DataFrame, params: Params, provider_rank: int = 4) -> DataFrame:
    """Candidates from ``maps(pos, xml)``; unreadable maps are skipped."""
    if params.sitemap_locs > 1024:
        raise ValueError("at most 1024 locations of a map keep their order")
    located = maps.select("pos", F.transform(sitemap_urls(F.col("xml"), params), canonical_url).alias("urls"))
    firsts = located.select("pos", F.explode(first_per_domain(F.col("urls"))).alias("f")).select("pos", "f.*")
    position = F.col("pos") * F.lit(1024) + F.col("place")
    return candidates_from(
        firsts, ord=arrival(provider_rank, position), source=F.lit("SITEMAP"), platform=F.lit("Web"),
        provider_id=F.col("domain"), name=name_from_domain(F.col("domain")), profile_url=F.col("url"),
        website=F.concat(F.lit("https://"), F.col("domain")), raw_links=F.array("url"),
        raw_text=F.lit("sitemap public source"))
