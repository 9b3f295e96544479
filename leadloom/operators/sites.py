"""Site visits over stored pages: visiting order, page limit, emails and social links per site.

A visit starts with the priority paths and goes on with contact-like links of the visited pages,
in the order found, until a site has ``max_pages_per_domain`` pages. Pages are parsed once, where
they lie; everything after works on URLs, addresses and links only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.constants import SITE_SOCIAL_HOSTS
from leadloom.functions.emails import confidence_of, extract_emails, preference_of_good
from leadloom.functions.html import hrefs, is_site_page
from leadloom.functions.text import any_of, strip
from leadloom.functions.urls import (
    canonical_url, domain_of_canonical, host_contains, path_of, resolve,
)
from leadloom.operators.checkpoints import cut
from leadloom.operators.dedup import first_per_key
from leadloom.params import Params


def _priority(url: Column, domain: Column, params: Params) -> Column:
    """1-based rank of a priority path, 0 for other pages."""
    rest = F.substring(url, F.length(domain) + F.lit(9), F.lit(1 << 30))
    listed = F.array(*[F.lit(p) for p in params.priority_paths])
    return F.when(url.startswith("https://"), F.array_position(listed, rest)).otherwise(0)


def page_links(html: Column, page_url: Column) -> Column:
    """Canonical targets of the anchors of a page, in order, script and fragment links left out."""
    usable = F.filter(F.transform(hrefs(html), strip),
                      lambda h: (h != "") & ~h.startswith("javascript:") & ~h.startswith("#"))
    return F.filter(F.transform(usable, lambda h: canonical_url(resolve(page_url, h))), lambda u: u != "")


def contact_links(links: Column, domain: Column, params: Params) -> Column:
    """Links inside the domain whose path looks like a contact page."""
    return F.filter(links, lambda u: (domain_of_canonical(u) == domain) & any_of(
        F.lower(path_of(u)), params.contact_link_tokens))


def social_links(links: Column, hosts=SITE_SOCIAL_HOSTS) -> Column:
    return F.array_distinct(F.filter(links, lambda u: host_contains(u, hosts)))


def place_pages(pages: DataFrame) -> DataFrame:
    """Add ``page``, the canonical address, and ``domain`` to ``pages(page_id, url, html, content_type)``; no text is read."""
    keyed = pages.withColumn("page", canonical_url(F.col("url")))
    return keyed.withColumn("domain", domain_of_canonical(F.col("page"))).filter("domain != ''")


def parse_site_pages(pages: DataFrame, params: Params, sites: DataFrame | None = None) -> DataFrame:
    """One narrow row per page a visit could reach, from pages as in :func:`place_pages`, of the domains in ``sites`` only."""
    return parse_placed_pages(place_pages(pages), params, sites)


def parse_placed_pages(placed: DataFrame, params: Params, sites: DataFrame | None = None) -> DataFrame:
    """As :func:`parse_site_pages`, for pages that know their ``page`` and ``domain``, and maybe whether they are ``readable``.

    Sites and addresses decide before any text is read; the earliest copy of an address counts.
    """
    ranked = placed.withColumn("priority", _priority(F.col("page"), F.col("domain"), params))
    reachable = ranked.filter(
        (F.col("priority") > 0) | any_of(F.lower(path_of(F.col("page"))), params.contact_link_tokens))
    if sites is not None:
        reachable = reachable.join(sites.select("domain").distinct(), "domain", "left_semi")
    told = F.col("readable") if "readable" in placed.columns else is_site_page(F.col("html"), F.col("content_type"))
    readable = reachable.filter(told)
    linked = readable.select(
        "page", "domain", "priority", "page_id", "url",
        extract_emails(F.col("html"), params).alias("emails"),
        page_links(F.col("html"), F.col("url")).alias("links"))
    narrow = linked.select(
        "page", "domain", "priority", "page_id", "url", "emails",
        social_links(F.col("links")).alias("socials"),
        F.array_distinct(contact_links(F.col("links"), F.col("domain"), params)).alias("next_pages"))
    return first_per_key(narrow, ["page"], F.col("page_id"))


def visit_sites(parsed: DataFrame, params: Params) -> DataFrame:
    """Visited pages as ``(domain, visit_no, page, url, emails, socials)``, numbered from 1.

    A site takes at most ``max_pages_per_domain`` pages, so
    a round handles few rows per site however large the site is; there are at most that many rounds.
    """
    limit = params.max_pages_per_domain
    pages = cut(parsed)
    turn = F.row_number().over(Window.partitionBy("domain").orderBy("queue"))
    first = pages.filter("priority > 0").withColumn("queue", F.struct("priority", F.lit(0)))
    level = cut(first.withColumn("visit_no", turn).filter(F.col("visit_no") <= limit).drop("queue"))
    visited = level
    while not level.isEmpty():
        used = visited.groupBy("domain").agg(F.max("visit_no").alias("used")).filter(F.col("used") < limit)
        links = level.select("domain", "visit_no", F.posexplode("next_pages").alias("i", "page"))
        fresh = (links.groupBy("domain", "page").agg(F.min(F.struct("visit_no", "i")).alias("queue"))
                 .join(visited.select("page"), "page", "left_anti"))
        found = fresh.join(used, "domain").join(pages.drop("domain"), "page")
        # the first filter also cuts each task's links before they meet in one place
        level = cut(
            found.withColumn("turn", turn).filter(F.col("turn") <= limit)
            .withColumn("visit_no", F.col("used") + F.col("turn"))
            .filter(F.col("visit_no") <= limit).select(*visited.columns))
        visited = visited.unionByName(level)
    return visited.select("domain", "visit_no", "page", "url", "emails", "socials")


def site_emails(visits: DataFrame) -> DataFrame:
    """Distinct addresses per site; the first page that shows an address is its source."""
    seen = visits.select("domain", "visit_no", "url", F.posexplode("emails").alias("i", "email"))
    return seen.groupBy("domain", "email").agg(
        F.min_by(F.struct("url", "visit_no", "i"), F.struct("visit_no", "i")).alias("first")
    ).select("domain", "email", F.col("first.url").alias("source_url"),
             F.col("first.visit_no").alias("visit_no"), F.col("first.i").alias("i"))


def best_site_email(emails: DataFrame) -> DataFrame:
    """Best address per site: preference, then confidence, then the order of the visit."""
    ranked = emails.withColumn("preference", preference_of_good(F.col("email")))
    order = F.struct("preference", confidence_of(F.col("preference")).alias("c"),
                     (-F.col("visit_no")).alias("v"), (-F.col("i")).alias("i"))
    best = F.max_by(F.struct("email", "source_url", "preference"), order).alias("best")
    return ranked.groupBy("domain").agg(best).select(
        "domain", F.col("best.email").alias("site_email"),
        F.col("best.source_url").alias("site_email_url"),
        F.col("best.preference").alias("site_preference"))


def site_socials(visits: DataFrame) -> DataFrame:
    """Distinct social links per site with the order of their first sighting."""
    seen = visits.select("domain", "visit_no", F.posexplode("socials").alias("i", "link"))
    return seen.groupBy("domain", "link").agg(F.min(F.struct("visit_no", "i")).alias("seen_at"))
