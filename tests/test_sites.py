import random
import re

from pyspark.sql import functions as F

from leadloom import Params
from leadloom.operators.sites import best_site_email, parse_site_pages, site_emails, site_socials, visit_sites

P = Params(as_of="2026-08-17T12:00:00+00:00")
PRIORITY = ["/", "/contact", "/contact-us", "/about", "/about-us", "/team", "/legal", "/mentions-legales"]


def visit_one_by_one(pages, domain, limit):
    """A queue over the stored pages of one domain: ``pages`` maps an address to (links, is page)."""
    queue, seen, visited = [f"https://{domain}{p}" for p in PRIORITY], set(), []
    while queue and len(visited) < limit:
        page = queue.pop(0)
        if page in seen:
            continue
        seen.add(page)
        if page not in pages or not pages[page][1]:
            continue
        visited.append(page)
        for link in pages[page][0]:
            path = link.split(domain, 1)[-1]
            if link.startswith(f"https://{domain}/") and re.search("contact|about|team|legal|mention", path) and link not in seen:
                queue.append(link)
    return visited


def test_visits_same_as_queue(spark):
    rng = random.Random(9)
    pages, rows = {}, []
    for d in range(25):
        domain = f"d{d}.org"
        paths = PRIORITY[:rng.randint(0, 3)] + [f"/{rng.choice(['contact', 'team', 'x'])}/{i}" for i in range(rng.randint(0, 12))]
        for path in dict.fromkeys(paths):
            links = [f"https://{domain}{rng.choice(paths)}" for _ in range(rng.randint(0, 5))] + ["https://elsewhere.org/contact"]
            ok = rng.random() < 0.85
            pages[f"https://{domain}{path}"] = (links, ok)
            anchors = "".join(f"<a href='{x if rng.random() < .5 else x.split(domain)[-1] if domain in x else x}'>l</a>" for x in links)
            rows.append((len(rows), f"https://{'www.' if rng.random() < .3 else ''}{domain}{path}", f"<!DOCTYPE html>{anchors}" if ok else "%PDF", "text/html" if ok else "application/pdf"))
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, content_type STRING")
    for limit in (5, 2):
        params = Params(as_of=P.as_of, max_pages_per_domain=limit)
        found = visit_sites(parse_site_pages(df, params), params).orderBy("domain", "visit_no").collect()
        got = {}
        for r in found:
            got.setdefault(r.domain, []).append(r.page)
        expected = {f"d{d}.org": visit_one_by_one(pages, f"d{d}.org", limit) for d in range(25)}
        assert got == {k: v for k, v in expected.items() if v}


def test_emails_and_links_of_a_site(spark):
    rows = [(1, "https://a.org/contact", "<html> joe@a.org <a href='https://www.instagram.com/a/'>i</a> contact@a.org", ""),
            (2, "http://www.a.org/", "<html> joe@a.org info@a.org <a href='//tiktok.com/@a'>t</a><a href='https://instagram.com/a'>i</a>", "text/html"),
            (3, "https://a.org/contact", "<html> later@a.org", "text/html"), (4, "https://a.org/secret", "<html> hidden@a.org", "text/html")]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, content_type STRING")
    visits = visit_sites(parse_site_pages(df, P), P)
    assert [(r.visit_no, r.page) for r in visits.orderBy("visit_no").collect()] == [(1, "https://a.org/"), (2, "https://a.org/contact")]
    emails = {r.email: r.source_url for r in site_emails(visits).collect()}
    assert emails == {"joe@a.org": "http://www.a.org/", "info@a.org": "http://www.a.org/", "contact@a.org": "https://a.org/contact"}
    best = best_site_email(site_emails(visits)).first()
    assert (best.site_email, best.site_preference) == ("info@a.org", 35)
    links = [r.link for r in site_socials(visits).orderBy("seen_at").collect()]
    assert links == ["https://tiktok.com/@a", "https://instagram.com/a"]
    assert visit_sites(parse_site_pages(df, P, spark.createDataFrame([("b.org",)], "domain STRING")), P).count() == 0
