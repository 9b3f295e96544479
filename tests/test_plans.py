import json
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from leadloom import Params
from leadloom.operators.sites import parse_placed_pages
from leadloom.plans.harvest import Inputs, channel_state, harvest, run_report, store
from leadloom.plans.runs import Runs, run
from leadloom.schemas import CACHE_DDL, candidates_from
from leadloom.sources.page_index import add_pages, page_index
from leadloom.sources.store import store_order
from leadloom.sources.tables import append_report, empty_leads, read_leads
from leadloom.streaming.failures import read_failures, stream_failures
from leadloom.streaming.incremental import read_candidate_stream, stream_leads

P = Params(as_of="2026-08-17T12:00:00+00:00", target_niches=("shop",), min_score=20)
FAILURES = "key STRING, error STRING, seen_at STRING, seq BIGINT"
CAND = "i BIGINT, source STRING, pid STRING, name STRING, username STRING, website STRING, text STRING, niche STRING"


def candidates(spark, rows):
    df = spark.createDataFrame(rows, CAND)
    return candidates_from(df, ord=F.col("i"), source=F.col("source"), platform=F.lit("Web"), provider_id=F.col("pid"), name=F.col("name"), username=F.col("username"),
                           website=F.col("website"), raw_text=F.col("text"), niche=F.col("niche"), profile_url=F.concat(F.lit("https://p.org/"), F.col("pid")))


def inputs(spark):
    rows = [(0, "YOUTUBE", "UC1", "Ann", "annlee", "https://www.a.org/x", "joe@a.org", "shop"), (1, "SEED", "a.org", "Dup", "", "https://a.org", "", "shop"),
            (2, "SEED", "b.org", "Bob", "", "https://b.org", "text info@b.org", "shop"), (3, "SEED", "c.org", "Cleo", "", "", "", "shop"),
            (4, "SEED", "d.org", "Low", "", "", "x@d.org", "none")]
    pages = [(0, "https://a.org/contact", "<html>contact@a.org", "text/html"), (1, "https://b.org/", "<html>hello@b.org", "text/html")]
    results = [("contact instagram", "<a href='https://instagram.com/zz'>no</a>", False), ("contact annlee instagram", "<a href='https://instagram.com/annlee'>Ann</a>", False)]
    cache = [("info@b.org", "", "NOT_FOUND", "cached query", 0.1, "2026-08-16T00:00:00+00:00")]
    return Inputs(candidates(spark, rows), spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING, content_type STRING"),
                  spark.createDataFrame(results, "query STRING, html STRING, failed BOOLEAN"), spark.createDataFrame(cache, CACHE_DDL))


@pytest.fixture(scope="module")
def finished(spark):
    given = inputs(spark)
    return given, harvest(given, P)


def test_whole_run(spark, tmp_path, finished):
    given, result = finished
    leads = {r.name: r for r in result.leads.collect()}
    assert set(leads) == {"Ann", "Bob", "Cleo"}
    ann, bob, cleo = leads["Ann"], leads["Bob"], leads["Cleo"]
    # the site's preferred address beats the one in the text; on a tie the text wins
    assert (ann.email, ann.email_source_url, ann.website) == ("contact@a.org", "https://a.org/contact", "https://a.org")
    assert (ann.instagram_url, ann.instagram_status, ann.instagram_search_query) == ("https://www.instagram.com/annlee/", "FOUND_SEARCH_RESULT", "contact annlee instagram")
    assert (bob.email, bob.email_source_url, bob.instagram_status, bob.instagram_search_query) == ("info@b.org", "https://p.org/b.org", "NOT_FOUND", "cached query")
    assert (cleo.email, cleo.email_status, cleo.instagram_status, cleo.status) == ("", "UNKNOWN", "NOT_CHECKED", "NEW")
    assert [r.email for r in result.answers.collect()] == ["contact@a.org"]
    counts = store(empty_leads(spark), result.leads, P, str(tmp_path / "v1"))
    report = run_report(given, result, counts, P, "run").first()
    assert (report.candidates_found, report.unique_candidates, report.duplicates_prevented, report.qualified, report.new_leads) == (5, 4, 1, 3, 3)
    assert (report.emails_found, report.instagram_lookups, report.instagram_found, report.websites_crawled) == (2, 1, 1, 2)
    assert report.instagram_found_per_lookup == 1.0 and report.verified_emails_per_website == 1.0
    append_report(run_report(given, result, counts, P, "run"), str(tmp_path / "reports"))
    assert spark.read.json(str(tmp_path / "reports")).count() == 1
    # the same leads again: nothing new, the same table
    stored = read_leads(spark, str(tmp_path / "v1"))
    again = store(stored, result.leads, P, str(tmp_path / "v2")).first()
    assert (again.new_leads, again.updated_leads) == (0, 3)
    assert read_leads(spark, str(tmp_path / "v2")).orderBy("row_no").collect() == stored.orderBy("row_no").collect()
    state = channel_state(spark.createDataFrame([], "channel_id STRING, checked_at STRING"), result.unique, P)
    assert [tuple(r) for r in state.collect()] == [("UC1", P.as_of)]


def test_limits(spark):
    limited = harvest(inputs(spark), Params(as_of=P.as_of, target_niches=("shop",), min_score=20, target_leads=1, max_enrichments=0))
    assert [(r.name, r.email, r.website) for r in limited.leads.collect()] == [("Ann", "joe@a.org", "https://www.a.org/x")]


def test_email_first(spark, tmp_path, finished):
    given, result = finished
    first = Params(as_of=P.as_of, email_first=True)
    counts = store(empty_leads(spark), result.leads, first, str(tmp_path / "v"))
    assert counts.first().new_leads == 2 and {r.name for r in read_leads(spark, str(tmp_path / "v")).collect()} == {"Ann", "Bob"}
    report = run_report(given, result, counts, first, "r", errors=1).first()
    assert (report.mode, report.run_status) == ("EMAIL_FIRST_VERIFIED_ONLY", "SUCCESS_WITH_WARNINGS")


def test_stream_of_candidates(spark, tmp_path):
    source, runs = str(tmp_path / "in"), Runs(str(tmp_path / "tables"), 4)
    given = inputs(spark)
    given.candidates.filter("ord < 2").coalesce(1).write.parquet(source)
    seen = []

    def stream(checkpoint="ck"):
        files = read_candidate_stream(spark, source, given.candidates.schema)
        stream_leads(files, runs, str(tmp_path / checkpoint), P, given.pages, given.results, seen.append)

    stream()
    # files of another run: their candidates are numbered alike, and one order occurs twice
    more = given.candidates.filter("ord >= 1").withColumn("ord", F.greatest(F.col("ord"), F.lit(2)))
    more.coalesce(1).write.mode("append").parquet(source)
    stream()
    assert [(r["batch"], r["new_leads"]) for r in seen] == [(0, 1), (1, 3)]
    assert [r.name for r in runs.read(spark, "leads").orderBy(*store_order()).collect()] == ["Ann", "Dup", "Bob", "Cleo"]
    assert {r.email for r in runs.read(spark, "lookup_cache").collect()} == {"contact@a.org", "info@b.org"}
    stream()
    assert len(seen) == 2
    # a fresh checkpoint meets all files again: leads that are there are updated, and the cache answers
    stream("fresh")
    assert seen[2]["new_leads"] == 0 and seen[2]["instagram_lookups"] == 0 and runs.newest(spark) == 2
    # a batch whose commit was written, but which the stream does not know as done, is not run again
    for name in ("commits", "offsets"):
        for f in (tmp_path / "fresh" / name).glob("*0*"):
            if name == "commits":
                f.unlink()
    stream("fresh")
    assert runs.newest(spark) == 2 and len(seen) == 3


def test_runs_on_stored_tables(spark, tmp_path):
    given, runs = inputs(spark), Runs(str(tmp_path), 4)
    videos = spark.createDataFrame([("UC1", "v2"), ("UC1", "v1"), ("gone", "v9")], "channel_id STRING, video_id STRING")
    asked = [spark.createDataFrame(rows, "query STRING, ord BIGINT") for rows in ([("b", 0), ("a", 1), ("b", 2)], [("c", 0), ("a", 1)])]
    failures = spark.createDataFrame([("provider:WEB", "Timeout", P.as_of, 1), ("provider:WEB", "Refused", P.as_of, 2)], FAILURES)
    limited = Params(**{**P.__dict__, "videos_kept": 1, "queries_kept": 2})
    first = run(spark, runs, given, limited, run_id="one", queries=asked[0], videos=videos, failures=failures, requests={"youtube_requests": 4})
    assert {k: first[k] for k in ("candidates_found", "unique_candidates", "duplicates_prevented", "qualified", "new_leads", "updated_leads", "emails_found",
                                  "instagram_lookups", "instagram_found", "websites_crawled", "youtube_requests", "errors")} == {
        "candidates_found": 5, "unique_candidates": 4, "duplicates_prevented": 1, "qualified": 3, "new_leads": 3, "updated_leads": 0, "emails_found": 2,
        "instagram_lookups": 1, "instagram_found": 1, "websites_crawled": 2, "youtube_requests": 4, "errors": 2}

    def rows(name, *columns):
        return sorted(tuple(r) for r in runs.read(spark, name).select(*columns).collect())

    assert rows("sites_checked", "site", "checked_at") == [("https://a.org", P.as_of), ("https://b.org", P.as_of)]
    assert rows("emails_checked", "email") == [("contact@a.org",), ("info@b.org",)] and rows("channels_checked", "channel_id") == [("UC1",)]
    assert rows("processed_videos", "video_id") == [("v2",)] and rows("provider_state", "key", "value") == [("last_run", "one")]
    assert rows("failures", "key", "count", "last_error", "in_dead") == [("provider:WEB", 2, "Refused", False)]
    later = Params(**{**limited.__dict__, "as_of": "2026-08-18T12:00:00+00:00"})
    second = run(spark, runs, replace(given, cache=None), later, run_id="two", queries=asked[1], failures=failures.limit(1))
    # the cache of the first run answers one lookup; the given one is no longer there
    assert (second["new_leads"], second["updated_leads"], second["total_leads"], second["instagram_lookups"], second["version"]) == (0, 3, 3, 1, 1)
    assert [r.query for r in runs.read(spark, "processed_queries").orderBy("place").collect()] == ["a", "c"]
    assert rows("failures", "count", "in_retry", "in_dead") == [(3, True, True)] and rows("channels_checked", "checked_at") == [(later.as_of,)]
    assert [(r.version, r.run_id) for r in runs.reports(spark).orderBy("version").collect()] == [(0, "one"), (1, "two")]
    assert runs.report(spark, later).first().verified_emails_per_website == 1.0
    stats = {r.metric: r.value for r in runs.view(spark, "stats").collect()}
    assert (stats["TOTAL LEADS"], stats["EMAILS FOUND"], stats["NEW LEADS LAST RUN"], stats["NEW TODAY"]) == ("3", "2", "0", "0")
    assert [r.name for r in runs.view(spark, "no_email").orderBy("line").collect()] == ["Cleo"]
    assert runs.view(spark, "hot").columns[-1] == "line"
    # a run that was lost before its commit leaves the tables as they were
    before = rows("leads", "lead_id", "last_checked")
    (tmp_path / "runs" / "version=1").rename(tmp_path / "lost")
    assert runs.newest(spark) == 0 and rows("emails_checked", "checked_at") == [(P.as_of,), (P.as_of,)]
    again = run(spark, runs, replace(given, cache=None), later, run_id="two", queries=asked[1], failures=failures.limit(1))
    assert again["version"] == 1 and again["total_leads"] == 3 and rows("leads", "lead_id", "last_checked") == before
    assert rows("failures", "count") == [(3,)]


def test_no_candidates(spark, tmp_path):
    runs = Runs(str(tmp_path), 4)
    counters = run(spark, runs, replace(inputs(spark), candidates=inputs(spark).candidates.limit(0)), P, run_id="none")
    assert counters["candidates_found"] == counters["qualified"] == counters["total_leads"] == counters["websites_crawled"] == 0
    assert runs.read(spark, "leads").isEmpty() and runs.view(spark, "hot").isEmpty()


def test_sites_are_joined_before_pages_are_parsed(spark, tmp_path):
    index = page_index(str(tmp_path), 4)
    pages = inputs(spark).pages
    assert add_pages(spark, index, pages) == 2
    more = spark.createDataFrame([(2, "https://A.org/about", "<html>z@a.org", "text/html"), (3, "", "<html>", "text/html")], pages.schema)
    assert add_pages(spark, index, more) == 3
    sites = spark.createDataFrame([("a.org",)], "domain STRING")
    parsed = parse_placed_pages(index.read(spark), P, sites)
    assert sorted((r.page, list(r.emails)) for r in parsed.collect()) == [("https://a.org/about", ["z@a.org"]), ("https://a.org/contact", ["contact@a.org"])]
    plan = parsed._jdf.queryExecution().sparkPlan().toString()
    below = plan[plan.index("LeftSemi"):]  # what feeds the join of the sites
    assert "html" in below and "Arrow" not in below and "RLIKE" not in below
    assert not re.search(r"(regexp\w*|lower|substring|contains|transform)\(html#", below, re.I)


def test_stream_of_failures(spark, tmp_path):
    def add(name, rows):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(("key", "error", "seen_at", "seq"), r))) for r in rows))

    def run():
        stream = spark.readStream.schema("key STRING, error STRING, seen_at STRING, seq BIGINT").json(str(tmp_path / "in"))
        stream_failures(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
        return {r.key: (r["count"], r.last_error, r.in_dead) for r in read_failures(spark, str(tmp_path / "out")).collect()}

    add("1.json", [("a", "e1", "t1", 1), ("a", "e2", "t2", 2), ("b", "f", "t3", 3)])
    assert run() == {"a": (2, "e2", False), "b": (1, "f", False)}
    add("2.json", [("a", "e3", "t4", 4)])
    assert run() == {"a": (3, "e3", True), "b": (1, "f", False)}


def _customers(spark, base, n):
    """Tables of the run queries with ``n`` customers."""
    ids = spark.range(n)
    ids.select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"), F.lit(1).alias("c_nationkey"),
               F.lit(900.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")).write.parquet(f"{base}/customer.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'NATION_1' AS n_name, 1 AS n_regionkey").write.parquet(f"{base}/nation.parquet")
    ids.select(F.col("id").alias("o_custkey"), F.lit("2001-07-30").cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{base}/orders.parquet")
    ids.select(F.col("id").alias("doc_id"), F.lit("that with").alias("text"), F.lit("en").alias("lang"),
               F.lit("web").alias("source")).write.parquet(f"{base}/documents.parquet")


def test_batches_do_not_grow_with_the_partitions(spark, tmp_path, monkeypatch):
    from leadloom.driver import runs as queries

    _customers(spark, tmp_path, 60)
    batches, read = [], queries.stream_leads
    monkeypatch.setattr(queries, "stream_leads", lambda *given: read(*given, after=lambda row: batches.append(row["candidates_found"])))
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(held, ("9", "false", "-1")):
            spark.conf.set(k, v)
        assert queries.stream_leads_query(spark, str(tmp_path)).count() == 60
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(batches) == 4 and sum(batches[:3]) == batches[3] == 60


def test_candidates_are_made_and_read_for_addresses_once(spark, monkeypatch):
    from leadloom.plans import harvest as plan

    made, read, best = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), plan.best_emails

    def seen(counter):
        def count_row(text):
            counter.add(1)
            return text
        return F.udf(count_row)

    monkeypatch.setattr(plan, "best_emails", lambda *given: best(*given).withColumn("email", seen(read)("email")))
    given = inputs(spark)
    n = given.candidates.count()
    result = plan.harvest(plan.Inputs(given.candidates.withColumn("raw_text", seen(made)("raw_text"))), P)
    assert result.leads.count() == result.processed.count() == read.value > 0 and made.value == n
