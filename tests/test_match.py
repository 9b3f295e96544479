import random
import unicodedata
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from leadloom import Params
from leadloom.constants import GENERIC_LOCALS
from leadloom.operators.match import backfill_candidates, find_profiles, lookup_queries, split_by_cache
from leadloom.plans.backfill import backfill
from leadloom.schemas import CACHE_DDL

P = Params(as_of="2026-08-17T12:00:00+00:00")


def key(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text).lower() if c.isascii() and c.isalnum())


def expected_confidence(handle, local, name, username, title, rank):
    """The rule table, taken as the largest of its independent parts."""
    h, l, u, n, t = key(handle), key(local), key(username), key(name), key(title)
    generic = local in GENERIC_LOCALS or len(l) < 4
    parts = [0.0, 0.18 - rank * 0.02]
    if u:
        close = len(u) >= 5 and SequenceMatcher(None, h, u).ratio() >= 0.86
        parts.append(0.99 if h == u else 0.93 if close else 0)
    if l and not generic:
        if h == l:
            parts.append(1.0)
        elif min(len(h), len(l)) >= 5:
            r = SequenceMatcher(None, h, l).ratio()
            parts.append(0.95 if r >= 0.9 else 0.86 if r >= 0.8 or l in h or h in l else 0)
    if len(n) >= 5:
        words = [w for w in map(key, name.split()) if len(w) >= 4]
        parts.append(0.88 if n in t or n in h or h in n else 0.82 if any(w in h or w in t for w in words) else 0)
    best = max(parts)
    return min(best, 0.45) if generic and best < 0.82 else best


def result(links, failed=False):
    return None if failed else "".join(f'<a href="https://www.instagram.com/{h}/?x=1">{t}</a>' for h, t in links)


def run(spark, leads, results, params=P):
    a = spark.createDataFrame(leads, "lead_id BIGINT, email STRING, name STRING, username STRING")
    b = spark.createDataFrame([(q, h, h is None) for q, h in results], "query STRING, html STRING, failed BOOLEAN")
    return {r.lead_id: r for r in find_profiles(a, b, params).collect()}


def test_examples(spark):
    leads = [(1, "john.smith@x.org", "John Smith", "johnsmith"), (2, "contact@x.org", "Creator Brand", "creatorbrand"), (3, "nope", "", "")]
    found = run(spark, leads, [("john.smith instagram", result([("john.smith", "John Smith Instagram")])),
                               ("contact instagram", result([("randomperson", "Random Person Instagram")])),
                               ("contact creatorbrand instagram", result([("creatorbrand", "Creator Brand Instagram")]))])
    assert found[1].confidence >= 0.95 and found[1].status == "FOUND_SEARCH_RESULT" and found[1].url.endswith("/john.smith/")
    assert found[2].confidence >= 0.95 and found[2].query == "contact creatorbrand instagram"
    assert (found[3].status, found[3].url, found[3].query) == ("SKIPPED_INVALID_EMAIL", "", "")
    alone = run(spark, leads[1:2], [("contact instagram", result([("randomperson", "Random Person Instagram")])), ("contact creatorbrand instagram", "")])
    assert alone[2].status == "NOT_FOUND" and alone[2].confidence < 0.78 and alone[2].url == ""


def test_random_against_rule(spark):
    rng = random.Random(31)
    stems = ["maria", "lopez", "fit", "ana.b", "über", "studio", "jo", "coach", "x1", "Élan", "delmar"]
    leads, results, expected = [], [], {}
    for i in range(400):
        local = f"{rng.choice(stems)}{rng.choice(['', '.', '-'])}{rng.choice(stems)}{i}".lower().replace("ü", "u").replace("é", "e")
        name = " ".join(rng.choice(stems) for _ in range(rng.randint(0, 3)))
        username = rng.choice(["", "UNKNOWN", "@" + rng.choice(stems) + rng.choice(stems)])
        links = []
        for _ in range(rng.randint(0, 5)):
            near = local if rng.random() < .4 else rng.choice(stems) + rng.choice(stems)
            near = "".join(c for c in near if c.isascii() and (c.isalnum() or c in "._"))
            if rng.random() < .6 and len(near) > 3:
                cut = rng.randrange(len(near))
                near = near[:cut] + rng.choice(["", "z", "_"]) + near[cut + 1:]
            links.append((near or "zz", rng.choice(["", "Über " + name, "nobody here", name.upper()])))
        links = list({h: (h, t) for h, t in reversed(links)}.values())[::-1]
        links = [x for x in links if x[0].lower() not in ("p", "tv")]
        leads.append((i, f"{local}@x.org", name, username))
        results.append((f"{local} instagram", result(links)))
        scores = [expected_confidence(h, local, name, username.lstrip("@").lower(), t, r) for r, (h, t) in enumerate(links)]
        best = max(scores, default=0.0)
        expected[i] = (round(best, 3), f"https://www.instagram.com/{links[scores.index(best)][0]}/" if best >= 0.78 else "")
    found = run(spark, leads, results)
    assert {i: (r.confidence, r.url) for i, r in found.items()} == expected
    assert len({c for c, _ in expected.values()}) >= 6


def test_empty_handle_counts_as_contained(spark):
    found = run(spark, [(1, "someone@x.org", "Maria Lopez", "")], [("someone instagram", result([("._.", "t")]))])
    assert found[1].confidence == 0.88


def test_second_query_rules(spark):
    lead = [(1, "contact@x.org", "Maria Lopez", "")]
    second = "contact Maria Lopez instagram"
    failed = run(spark, lead, [("contact instagram", None), (second, None)])[1]
    assert (failed.status, failed.query, failed.confidence) == ("SEARCH_ERROR", "contact instagram", 0.0)
    weak = run(spark, lead, [("contact instagram", result([("zzz", "t")])), (second, None)])[1]
    assert (weak.status, weak.query, weak.confidence) == ("NOT_FOUND", "contact instagram", 0.18)
    late = run(spark, lead, [("contact instagram", None), (second, result([("maria.lopez", "t")]))])[1]
    assert (late.status, late.query, late.confidence) == ("FOUND_SEARCH_RESULT", second, 0.88)
    early = run(spark, lead, [("contact instagram", result([("m.lopez", "Maria Lopez")])), (second, result([("marialopez", "Maria Lopez")]))])[1]
    assert early.url.endswith("/m.lopez/")


def test_query_texts(spark):
    leads = spark.createDataFrame([(1, "Info@x.org", " The Name ", ""), (2, "joe.b@x.org", "", "@J"), (3, "info@x.org", "", "@Me")],
                                  "lead_id BIGINT, email STRING, name STRING, username STRING")
    got = [(r.lead_id, r.query) for r in lookup_queries(leads).orderBy("lead_id", "query_no").collect()]
    assert got == [(1, "info instagram"), (1, "info The Name instagram"), (2, "joe.b instagram"), (3, "info instagram"), (3, "info me instagram")]


def cache_frame(spark, rows):
    return spark.createDataFrame(rows, CACHE_DDL)


def test_cache(spark):
    cache = cache_frame(spark, [("a@x.org", "u", "F", "q", 1.0, "long ago"), ("b@x.org", "", "NOT_FOUND", "q", 0.1, "2026-08-10T12:00:00+00:00"),
                                ("c@x.org", "", "NOT_FOUND", "q", 0.1, "2026-08-10T11:59:59+00:00")])
    leads = spark.createDataFrame(list(enumerate(("a@x.org", "b@x.org", "c@x.org", "d@x.org", ""))), "ord BIGINT, email STRING")
    assert {r.email: r.fresh for r in split_by_cache(leads, cache, P).collect()} == {"a@x.org": True, "b@x.org": True, "c@x.org": False, "d@x.org": False, "": False}


def test_backfill(spark):
    from tests.test_merge import frame, lead

    ok = dict(email_status="VERIFIED_PUBLIC_SOURCE")
    rows = [lead(email="john.smith@x.org", name="John", **ok), lead(email="a@x.org", **ok), lead(email="b@x.org", **ok), lead(email="", **ok),
            lead(email="q@x.org", instagram_url="have", **ok), lead(email="ann.lee@x.org", instagram_status="OLD", **ok), lead(email="a@x.org", **ok)]
    leads = frame(spark, rows, "row_no")
    cache = cache_frame(spark, [("a@x.org", "u", "F", "cq", 1.0, ""), ("b@x.org", "", "NOT_FOUND", "q", 0.1, P.as_of)])
    results = spark.createDataFrame([("john.smith instagram", result([("john.smith", "x")]), False)], "query STRING, html STRING, failed BOOLEAN")
    filled, answers = backfill(leads, cache, results, P)
    got = {r.row_no: (r.instagram_url, r.instagram_status) for r in filled.collect()}
    assert got == {0: ("https://www.instagram.com/john.smith/", "FOUND_SEARCH_RESULT"), 1: ("u", "F"), 2: ("", ""), 3: ("", ""), 4: ("have", ""), 5: ("", "SEARCH_ERROR"), 6: ("u", "F")}
    assert sorted(r.email for r in answers.collect()) == ["ann.lee@x.org", "john.smith@x.org"]
    limited = backfill_candidates(leads, cache, Params(as_of=P.as_of, backfill_limit=1))
    assert {r.row_no: r.action for r in limited.collect()} == {0: "lookup", 1: None, 2: None, 3: None, 4: None, 5: None, 6: None}
    both = backfill_candidates(leads, cache, Params(as_of=P.as_of, backfill_limit=2))
    assert {r.row_no: r.action for r in both.collect()} == {0: "lookup", 1: "cached", 2: None, 3: None, 4: None, 5: "lookup", 6: None}


def test_hot_keys_are_measured_and_spread(spark):
    """A third of the leads share one address, which no list names: no task gets many more rows than others."""
    from leadloom.operators.skew import hot_values, skewed_join

    leads = spark.range(30_000, numPartitions=6).select(
        "id", F.when(F.col("id") % 3 == 0, "shared@x.org").otherwise(F.concat(F.col("id"), F.lit("@x.org"))).alias("email"))
    cache = spark.range(0, 30_000, 2).select(F.concat(F.col("id"), F.lit("@x.org")).alias("email"), F.col("id").alias("hit")).union(
        spark.createDataFrame([("shared@x.org", -1)], "email STRING, hit BIGINT"))
    assert hot_values(leads, "email") == ["shared@x.org"] and hot_values(cache, "email") == []
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = skewed_join(leads, cache, "email", "id")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sizes[-1] <= 3 * sizes[len(sizes) // 2] and sum(sizes) == 30_000
        rows = joined.agg(F.count("*"), F.count_if(F.col("hit") == -1), F.count("hit")).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tuple(rows) == (30_000, 10_000, 10_000 + sum(1 for i in range(0, 30_000, 2) if i % 3))
