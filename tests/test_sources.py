import json

from pyspark.sql import functions as F

from leadloom import Params
from leadloom.operators.dedup import dedup_candidates
from leadloom.sources import api
from leadloom.sources.registry import union_sources
from leadloom.sources.web import (
    feed_candidates, page_candidates, read_seeds, seed_candidates, sitemap_candidates, sitemap_urls,
)

P = Params(as_of="2026-08-17T12:00:00+00:00")


def write_lines(path, answers):
    path.write_text("\n".join(json.dumps(a) for a in answers))
    return str(path)


def hit(channel, published, video):
    return {"id": {"videoId": video} if video else {}, "snippet": {"channelId": channel, "publishedAt": published}}


def search(spark, tmp_path):
    answers = [{"query": "coach", "nextPageToken": "T1", "items": [hit("UC1", "2026-08-01T00:00:00Z", "v1"), hit(None, "x", "v2"), hit("UC2", "", "v3")]},
               {"query": "mentor", "items": [hit("UC1", "2026-07-01T00:00:00Z", "v4"), hit("UC1", "2026-09-01T00:00:00Z", None)]}]
    return api.read_answers(spark, write_lines(tmp_path / "search.json", answers), api.SEARCH_SCHEMA)


def test_search_and_channels(spark, tmp_path):
    answers = search(spark, tmp_path)
    hits = api.search_hits(answers)
    assert hits.count() == 4
    assert {r["query"]: r.token for r in api.next_tokens(answers).collect()} == {"coach": "T1", "mentor": None}
    rolled = {r.channel_id: r for r in api.channel_rollup(hits).collect()}
    assert (rolled["UC1"].published_at, rolled["UC1"]["query"], rolled["UC1"].n_videos) == ("2026-09-01T00:00:00Z", "mentor", 2)
    assert rolled["UC2"].published_at == ""
    items = [{"id": "UC1", "snippet": {"title": "T", "description": "Mail joe@a.org https://instagram.com/a https://a.org/home.", "customUrl": "@t", "country": "FR"},
              "statistics": {"subscriberCount": "1200"}, "brandingSettings": {"channel": {"description": "no", "country": "US"}}},
             {"id": "UC3", "snippet": {"title": "", "description": ""}, "statistics": {"subscriberCount": "many"},
              "brandingSettings": {"channel": {"description": "brand", "country": "NL"}}}, {"id": "UC4", "snippet": {"defaultAudioLanguage": "xx"}}]
    channels = api.read_answers(spark, write_lines(tmp_path / "channels.json", [{"items": items}]), api.CHANNEL_SCHEMA)
    one, three, four = api.channel_candidates(channels, hits, P).orderBy("ord").collect()
    assert (one.name, one.username, one.website, one.niche, one.country, one.language, one.followers) == ("T", "@t", "https://a.org/home", "mentor", "FR", "fr", 1200)
    assert one.video_ids == ["v1", "v4"] and one.recent_activity == one.published_at == "2026-09-01T00:00:00Z"
    assert one.profile_url == "https://www.youtube.com/channel/UC1" and one.raw_links == ["https://instagram.com/a", "https://a.org/home"]
    assert (three.name, three.description, three.country, three.language, three.followers, three.niche, three.recent_activity) == (
        "UNKNOWN", "brand", "NL", "nl", None, "UNKNOWN", "UNKNOWN")
    assert (four.language, four.country, four.website, four.video_ids) == ("xx", "UNKNOWN", "", [])


def test_video_texts(spark, tmp_path):
    videos = api.read_answers(spark, write_lines(tmp_path / "videos.json", [{"items": [
        {"id": f"v{i}", "snippet": {"channelId": "UC1", "description": d}} for i, d in enumerate(["one https://site.org", "", "two", "three", "four", "five"])]}]), api.VIDEO_SCHEMA)
    from leadloom.schemas import candidates_from

    base = candidates_from(spark.range(2), ord=F.col("id"), source=F.lit("YOUTUBE"), platform=F.lit("YouTube"),
                           provider_id=F.when(F.col("id") == 0, "UC1").otherwise("UC2"), description=F.lit("base"), raw_links=F.array(F.lit("https://netflix.com/a")))
    one, two = api.with_video_texts(base, api.video_descriptions(videos).where("video_id <> 'v5'")).orderBy("ord").collect()
    assert one.raw_text == "base\n\none https://site.org\n\ntwo\n\nthree\n\nfour" and one.video_descriptions_checked == 4
    assert one.raw_links == ["https://netflix.com/a", "https://site.org/"] and one.website == "https://site.org/"
    assert (two.raw_text, two.website, two.video_descriptions_checked) == ("", "", None)
    hits = api.search_hits(search(spark, tmp_path))
    assert [r.video_id for r in api.wanted_videos(api.video_descriptions(videos), hits, 4).orderBy("video_id").collect()] == ["v3", "v4"]


def test_seeds(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("http://www.Example.com/path/?utm_source=x#frag\n\n tel:+3 \nhttps://my-shop.org\n")
    first, second = seed_candidates(read_seeds(spark, str(tmp_path / "seeds.txt"))).orderBy("ord").collect()
    assert (first.provider_id, first.profile_url, first.name) == ("example.com", "https://example.com/path", "Example")
    assert (second.name, second.raw_text, second.raw_links) == ("My Shop", "my-shop.org", ["https://my-shop.org/"])


def test_pages(spark):
    rows = [(1, "https://www.a.org/x", "<html><title>A &amp; B</title><meta name='description' content='Best'><a href='//www.YouTube.com/@a'>y</a><a href='/in'>i</a><a href='//youtube.com/@a'>y</a>", None),
            (2, "https://b.org/", "plain", "text/plain"), (3, "https://c.org/", "x", "text/HTML"), (4, "tel:+3", "<html>", ""), (5, "https://d.org", "<html><title></title>", "")]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, content_type STRING")
    a, c, d = page_candidates(df, P).orderBy("ord").collect()
    assert (a.name, a.description, a.raw_text, a.website, a.provider_id) == ("A & B", "Best", "A & B Best", "https://a.org", "a.org")
    assert a.social_links == a.raw_links == ["https://youtube.com/@a"]
    assert (c.name, c.raw_text) == ("c.org", "c.org ") and (d.name, d.raw_text) == ("d.org", " ")
    assert page_candidates(df, Params(as_of=P.as_of, max_seed_pages=2)).count() == 1


RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>My &amp; Feed</title><atom:link href="https://x.org/self"/>
<link>http://www.Site.org/blog/</link><description>{d}</description>{items}</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>At</title><link rel="self" href="https://no.org/"/><link href="https://atom.org/"/><subtitle>sub</subtitle>
<entry><title>E1</title><published>2026-08-01T00:00:00Z</published></entry><entry><title>E2</title></entry></feed>"""


def test_feeds(spark):
    items = "".join(f"<item><title>t{i}</title><pubDate>d{i}</pubDate></item>" for i in range(12))
    rows = [(1, "https://f.org/rss", RSS.format(d="", items=items)), (2, "https://f.org/atom", ATOM), (3, "https://f.org/bad", "<rss><channel>"),
            (4, "https://own.org/feed", "<rss><channel><title/></channel></rss>"), (5, "x", "not xml")]
    df = spark.createDataFrame(rows, "pos BIGINT, url STRING, xml STRING")
    rss, atom, bare = feed_candidates(df, P).orderBy("ord").collect()
    assert (rss.name, rss.website, rss.provider_id, rss.published_at, rss.raw_text) == ("My & Feed", "https://site.org/blog", "site.org", "d0", "t0 t1 t2 t3 t4")
    assert rss.description == rss.raw_text and rss.raw_links == ["https://site.org/blog", "https://f.org/rss"]
    assert (atom.name, atom.website, atom.description, atom.raw_text, atom.published_at) == ("At", "https://atom.org/", "sub", "E1 E2", "2026-08-01T00:00:00Z")
    assert (bare.name, bare.website) == ("own.org", "https://own.org/feed")


def test_sitemaps(spark):
    good = ("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9' xmlns:image='http://i'><url><loc> https://www.a.org/1 </loc><image:LOC>https://b.org/i</image:LOC></url>"
            "<url><loc>https://a.org/2</loc></url><url><loc/></url><url><loc><![CDATA[https://c.org/?x=1&y=2]]></loc></url></urlset>")
    df = spark.createDataFrame([(0, good), (1, "<urlset><loc>https://bad.org</loc>"), (2, "<sitemapindex><sitemap><loc>https://a.org/map.xml</loc></sitemap></sitemapindex>")], "pos BIGINT, xml STRING")
    found = [(r.provider_id, r.profile_url, r.website, r.name) for r in sitemap_candidates(df, P).orderBy("ord").collect()]
    assert found == [("a.org", "https://a.org/1", "https://a.org", "A"), ("b.org", "https://b.org/i", "https://b.org", "B"),
                     ("c.org", "https://c.org/?x=1&y=2", "https://c.org", "C"), ("a.org", "https://a.org/map.xml", "https://a.org", "A")]
    many = "<urlset>" + "".join(f"<url><loc>https://s{i}.org/</loc></url>" for i in range(600)) + "</urlset>"
    assert spark.createDataFrame([(many,)], "xml STRING").select(F.size(sitemap_urls(F.col("xml"), P))).first()[0] == 500


def test_union_of_sources(spark, tmp_path):
    seeds = spark.createDataFrame([("https://a.org", 0)], "url STRING, pos BIGINT")
    pages = spark.createDataFrame([(0, "https://a.org", "<html>", "")], "page_id BIGINT, url STRING, html STRING, content_type STRING")
    found, failures = union_sources(spark, {"WEB": lambda s, p: page_candidates(pages, p), "SEED": lambda s, p: seed_candidates(seeds),
                                            "RSS": lambda s, p: s.read.parquet(str(tmp_path / "none"))}, P)
    assert [r.source for r in found.orderBy("ord").collect()] == ["SEED", "WEB"]
    assert [(r.key, r.error) for r in failures.collect()] == [("provider:RSS", "AnalysisException")]


def test_sources_with_equal_positions_keep_their_rows(spark):
    def numbered(host):
        return lambda s, p: seed_candidates(s.createDataFrame([(f"https://{host}{i}.org", i) for i in range(2)], "url STRING, pos BIGINT"))

    found, _ = union_sources(spark, {"B": numbered("b"), "A": numbered("a")}, P)
    kept = dedup_candidates(found)
    assert [r.provider_id for r in kept.orderBy("ord").collect()] == ["b0.org", "b1.org", "a0.org", "a1.org"]


def test_a_source_that_cannot_be_read_is_a_failure(spark, tmp_path):
    seeds = spark.createDataFrame([("https://a.org", 0)], "url STRING, pos BIGINT")
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 not a table PAR1")
    broken = lambda s, p: seed_candidates(s.read.schema("url STRING, pos BIGINT").parquet(str(tmp_path / "broken.parquet")))
    found, failures = union_sources(spark, {"SEED": lambda s, p: seed_candidates(seeds), "X": broken}, P)
    assert found.count() == 1 and [r.key for r in failures.collect()] == ["provider:X"]


def test_seeds_are_in_file_order(spark, tmp_path):
    (tmp_path / "part-0").write_text("https://a.org\n")
    (tmp_path / "part-1").write_text("".join(f"https://b{i}.org\n" for i in range(5)))
    assert [r.url for r in read_seeds(spark, str(tmp_path)).orderBy("pos").collect()] == ["https://a.org", *[f"https://b{i}.org" for i in range(5)]]


def test_answers_with_many_items_keep_their_order(spark, tmp_path):
    items = lambda a, n: ",".join('{"id": "%s%03d", "snippet": {"title": "t"}}' % (a, i) for i in range(n))
    (tmp_path / "a.json").write_text('{"items": [%s]}\n{"items": [%s]}\n' % (items("a", 70), items("b", 2)))
    answers = api.read_answers(spark, str(tmp_path), api.CHANNEL_SCHEMA)
    hits = api.search_hits(spark.createDataFrame([], api.SEARCH_SCHEMA + ", answer_no BIGINT"))
    found = api.channel_candidates(answers, hits, P)
    assert [r.provider_id for r in found.orderBy("ord").collect()] == [f"a{i:03d}" for i in range(70)] + ["b000", "b001"]
    assert dedup_candidates(found).count() == 72
