import html as html_lib
import random
import re
from html.parser import HTMLParser
from urllib.parse import parse_qsl, quote_plus, urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from leadloom import Params
from leadloom.functions import dates, emails, html, identity, ids, qualification, text, urls

P = Params(as_of="2026-08-17T12:00:00+00:00")


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING").repartition(1)
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_url_examples(spark):
    given = ["http://www.Example.com/path/?utm_source=x&b=2&a=1#section", "", None, "   ", "tel:+33123", "http://x:80"]
    assert column(spark, given, urls.canonical_url) == ["https://example.com/path?a=1&b=2", "", "", "", "", "https://x:80/"]
    assert column(spark, given[:1], urls.canonical_domain) == ["example.com"]


def plain_canonical(raw):
    """The rule in plain Python for well-formed http addresses."""
    parts = urlsplit(raw.strip() if "://" in raw else "https://" + raw.strip())
    host = (parts.hostname or "").removeprefix("www.")
    port = f":{parts.port}" if parts.port not in (None, 0, 443) else ""
    path = re.sub("/+", "/", parts.path or "/")
    path = path if path == "/" else path.rstrip("/")
    dropped = {"fbclid", "gclid", "dclid", "mc_cid", "mc_eid"}
    pairs = sorted((k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True)
                   if k.lower() not in dropped and not k.lower().startswith("utm_"))
    query = "&".join(f"{quote_plus(k)}={quote_plus(v)}" for k, v in pairs)
    return f"https://{host}{port}{path}" + (f"?{query}" if query else "")


def test_url_random(spark):
    rng = random.Random(7)
    bits = ["a", "B", "é", "%20", "%zz", "+", "~", "*", "-", "_", ".", "ü", "%C3%A9", "%FF", ";", ":", "@", "!", "(", "%41"]

    def word(n=4):
        return "".join(rng.choice(bits) for _ in range(rng.randint(0, n)))

    given = []
    for _ in range(600):
        host = rng.choice(["Ex-ample.com", "www.a_b.org", "WWW.x.y", "h"]) + rng.choice(["", ":8080", ":443", ":0", ":00081"])
        path = "".join("/" + word().replace("?", "") for _ in range(rng.randint(0, 3))) + rng.choice(["", "/", "//"])
        query = "&".join(rng.choice(["utm_x", "UTM_", "gclid", "k", "", word(2)]) + rng.choice(["", "=", "=" + word()]) for _ in range(rng.randint(0, 4)))
        given.append(rng.choice(["http://", "https://", "HTTPS://", ""]) + rng.choice(["", "u:p@", "u@v@"]) + host + path
                     + ("?" + query if query else "") + rng.choice(["", "#f?x"]))
    # a "://" further inside stands for a scheme of its own; the helper above does not cover that
    given = [g for g in given if g.lower().startswith("http") or "://" not in g]
    found = column(spark, given, urls.canonical_url)
    assert [(g, f) for g, f in zip(given, found)] == [(g, plain_canonical(g)) for g in given]
    again = column(spark, found, urls.canonical_url)
    assert [a for a in again] == [plain_canonical(f) for f in found]


def test_resolve_matches_urljoin(spark):
    base = "https://Host.example/a/b/c.html?q=1"
    hrefs = ["x", "../x", "../../../x", "./", "..", "/abs/../y?z#f", "//other/p", "?only", "#frag", "", "https://o.org/p", "mailto:a@b", "x/./y/", "a/b/../../c"]
    df = spark.createDataFrame([(i, base, h) for i, h in enumerate(hrefs)], "i INT, b STRING, h STRING").orderBy("i")
    found = [r[0] for r in df.select(urls.resolve(F.col("b"), F.col("h"))).collect()]
    assert found == [urljoin(base, h) for h in hrefs]


def test_links_and_website(spark):
    source = "See https://www.youtube.com/c, (HTTP://Shop.Example.org/x/). https://netflix.com/a https://shop.example.org/x!"
    links = column(spark, [source], urls.links_in_text)[0]
    assert links == ["https://youtube.com/c", "https://shop.example.org/x", "https://netflix.com/a"]
    assert column(spark, [source], lambda c: urls.official_website(urls.links_in_text(c))) == ["https://shop.example.org/x"]
    only_blocked = "https://netflix.com/a https://x.com/b"
    assert column(spark, [only_blocked], lambda c: urls.official_website(urls.links_in_text(c))) == [""]


def test_email_examples(spark):
    assert column(spark, ["  Hello@Example.COM. ", "not-an-email", None], emails.normalize_email) == ["hello@example.com", "", ""]
    assert column(spark, ["Business: hello@creator.com and duplicate HELLO@CREATOR.COM"],
                  lambda c: emails.extract_emails(c, P)) == [["hello@creator.com"]]
    bad = ["noreply@example.org", "test@real-domain.com", "privacy@real-domain.com", "business@creator.com",
           "testimonial@x.org", "a..b@x.org", "logo@2x.png", "a" * 65 + "@x.org", "x"]
    assert column(spark, bad, lambda c: emails.is_bad_email(c, P)) == [True, True, True, False, True, True, True, True, True]
    ranked = ["business@creator.com", "info.desk@x.org", "joe@x.org", "bookings@x.org", "test@x.org"]
    assert column(spark, ranked, lambda c: emails.email_preference(c, P)) == [45, 35, 20, 30, -100]
    assert column(spark, ["John.Smith@example.com", "not-an-email"], emails.email_localpart) == ["john.smith", ""]


def plain_emails(source):
    decoded = html_lib.unescape(source).replace("[at]", "@").replace("(at)", "@")
    pattern = r"(?<![\w.+-])([a-zA-Z0-9.!#$%&'*+/=?^_`{|}~-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,63})(?![\w.-])"
    found = [m.lower().strip("<>[](){}.,;:'\"") for m in re.findall(pattern, decoded)]
    return list(dict.fromkeys(found))


def test_email_extraction_random(spark):
    rng = random.Random(3)
    bits = ["joe", "ann.b", "@", "@", "[at]", "(at)", "&#64;", "&commat;", "&amp;", "&lbrack;at]", "site.org", "x.io", ".", " ", "\n", "é", "<", ">", '"',
            ",", "&copy", "&nbsp;", "a@b.com", "&lpar;at&rpar;", "²", "-", "+", "&#x40;", "?m=", "_"]
    given = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    good = Params(as_of=P.as_of, bad_email_domains=())
    found = column(spark, given, lambda c: emails.extract_emails(c, good))
    bad = re.compile(r"^(noreply|no-reply|donotreply|do-not-reply|example|test|testing|privacy|abuse|webmaster|postmaster|mailer-daemon|root)")
    expected = [[e for e in plain_emails(g) if ".." not in e and not bad.match(e) and re.fullmatch(r"[^@]+@[^@]+", e)] for g in given]
    assert sum(map(len, expected)) > 200
    assert [(g, f) for g, f in zip(given, found)] == [(g, e) for g, e in zip(given, expected)]


def test_evidence(spark):
    df = spark.createDataFrame([("business@creator.com",), ("joe@x.org",)], "email STRING")
    proof = emails.evidence(F.col("email"), emails.preference_of_good(F.col("email")), F.lit("https://creator.com/contact"), F.lit("website"), P)
    first, second = [r[0] for r in df.select(proof).collect()]
    assert first.verification_status == "VERIFIED_PUBLIC_SOURCE" and first.confidence == 1.0 and second.confidence == 0.85
    assert first.evidence_reason == "exact address observed on public website source" and first.first_seen == P.as_of


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        if tag == "a" and "href" in named:
            self.hrefs.append(named["href"] or "")

    handle_startendtag = handle_starttag


def test_hrefs_match_parser(spark):
    rng = random.Random(5)
    bits = ['<a href="x">', "<A HREF='y&amp;z'>", "<a href=plain class=c>", "<a title='<b href=no>' href=\"t\">", "</a>", "text", "<!-- <a href=c> -->",
            "<script>var a='<a href=s>'</script>", "<style>a{}</style>", "<abbr href=n>", "<a\nhref = 'sp'>", "<a data-href=d>", "<a href>", "<p>", "a > b", "<br/>",
            '<a href="a" href="b">', "<a href=&eacute;/x/>", "<img alt='a>b'>", "--", "<a href=q/ >"]
    given = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(800)]
    expected = []
    for source in given:
        parser = Plain()
        parser.feed(source)
        parser.close()
        expected.append(parser.hrefs)
    found = column(spark, given, html.hrefs)
    assert [(g, f) for g, f in zip(given, found)] == [(g, e) for g, e in zip(given, expected)]


def test_long_page_does_not_overflow(spark):
    filler = "x" * 300_000
    page = f"<html><!--{'-a' * 200_000}--><script>{'<b ' * 100_000}</script><title>T</title>{'<p>' * 100_000}<a {'k=v ' * 5_000} href='{filler}'>{filler}</a>"
    df = spark.createDataFrame([(page,)], "v STRING")
    row = df.select(html.hrefs(F.col("v")), html.title(F.col("v")), html.meta_description(F.col("v")),
                    emails.extract_emails(F.col("v"), P), html.anchors(F.col("v"))).first()
    assert row[0] == [filler] and row[1] == "T" and row[2] == "" and row[3] == [] and row[4][0].text == filler


def test_page_heads(spark):
    pages = ["<html><head><title> A <b>&amp;</b> B</title><meta NAME='description' content='d &lt; e'><meta name=description content=second>",
             "<p>none</p>", "<!-- <title>no</title> --><title></title>"]
    assert column(spark, pages, html.title) == ["A & B", None, ""]
    assert column(spark, pages, html.meta_description) == ["d < e", "", ""]


def test_secrets(spark):
    given = ["API_KEY=abc, x", "my Token : s3cr3t; rest", "secretary", "authorization: x y"]
    assert column(spark, given, text.mask_secrets) == ["API_KEY=[REDACTED], x", "my Token : [REDACTED]; rest", "secretary", "authorization: [REDACTED] y"]


def test_small_texts(spark):
    assert column(spark, [" @Creator ", "@@ x"], identity.normalize_username) == ["creator", "x"]
    assert column(spark, ["Élan-Vital 2go's", "ABC"], text.compact) == ["elanvital2gos", "abc"]
    assert column(spark, ["my-SHOP 2go o'neil"], text.title_case) == ["my-SHOP 2go o'neil".title()]
    assert column(spark, ["12", " -7 ", "1.5", "x", None, "1_000"], text.safe_int) == [12, -7, None, None, None, 1000]


def test_profiles(spark):
    given = ["https://www.instagram.com/john.smith/?hl=en", "https://instagram.com/p/ABC123/", "https://example.com/john.smith",
             "//duckduckgo.com/l/?uddg=https%3A%2F%2Fwww.instagram.com%2Fjohn.smith%2F&rut=1", "m.instagram.com/@a_b", "", "https://instagram.com/" + "a" * 31]
    own = "https://www.instagram.com/john.smith/"
    assert column(spark, given, identity.profile_url) == [own, "", "", own, "https://www.instagram.com/a_b/", "", ""]


def test_search_anchor(spark):
    page = '<html><body>\n<a class="result__a" href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fwww.instagram.com%2Fjohn.smith%2F">John Smith (@john.smith) Instagram</a></body>'
    found = column(spark, [page], html.anchors)[0]
    assert [a.text for a in found] == ["John Smith (@john.smith) Instagram"]


@pytest.mark.parametrize("published, points", [
    ("2026-08-02T12:00:00Z", 15), ("2026-08-02T11:59:59Z", 15), ("2026-08-01T11:59:59+00:00", 10), ("2026-07-03T12:00:00", 10),
    ("2026-07-02", 4), ("2026-05-19T12:00:00Z", 4), ("2026-05-18T11:00:00Z", 0), ("2027-01-01", 15), ("soon", 0), ("", 0),
    ("Mon, 17 Aug 2026 10:00:00 GMT", 0)])
def test_recency(spark, published, points):
    assert column(spark, [published], lambda c: qualification.recency_points(c, P)) == [points]


def test_time_to_live_edges(spark):
    edge = ["2026-08-10T12:00:00+00:00", "2026-08-10T11:59:59+00:00", "bad"]
    assert column(spark, edge, lambda c: dates.within_days(c, 7, P, inclusive=True)) == [True, False, False]
    assert column(spark, edge, lambda c: dates.within_days(c, 7, P, inclusive=False)) == [False, False, False]


def test_ids(spark):
    rows = [("YOUTUBE", " UC1 ", "", ""), ("SEED", "", "https://www.a.org/x", ""), ("X", "", "", "http://b.org/?utm_a=1"), ("X", "", "", "")]
    df = spark.createDataFrame(rows, "source STRING, provider_id STRING, website STRING, profile_url STRING").withColumns(
        {"name": F.lit("N"), "username": F.lit("U"), "description": F.lit("d" * 200)})
    keys = [r[0] for r in df.select(ids.id_key()).collect()]
    assert keys == ["YOUTUBE:uc1", "domain:a.org", "profile:https://b.org/", "fallback:x|n|u|" + "d" * 120]
    assert [r[0] for r in df.select(ids.id_key(F.lit("Me@x.org"))).collect()][1] == "email:me@x.org"
    assert len(df.select(ids.stable_id()).first()[0]) == 24
