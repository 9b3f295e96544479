"""Runs on stored tables: leads, state and views of a run are committed under one version, and the next run reads them.

Every run has a version. Its tables (``base/<table>``, see :class:`Keyed`) and its views (``base/views/<view>/version=V``) are
written first, the row of ``base/runs/version=V`` last: it is the report of the run, and its commit. A run that was lost before
that left nothing that is read: the next one takes the same version, starts from the one before, and writes it anew.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.constants import VERIFIED
from leadloom.operators.checkpoints import cut, written
from leadloom.operators.counters import Counters
from leadloom.operators.order import last_rows
from leadloom.operators.state import FAILURE_DDL, failure_totals, first_seen, merge_failures
from leadloom.params import Params
from leadloom.plans.harvest import Inputs, harvest
from leadloom.plans.report import with_ratios, with_run_status
from leadloom.plans.views import sorted_hot_view, sorted_no_email_view, stats_lines
from leadloom.schemas import CACHE_DDL
from leadloom.sources.buckets import Keyed, versions
from leadloom.sources.store import lead_store, merge_store, newest_first, store_order

STATE = {
    "lookup_cache": (CACHE_DDL, "email"),
    "sites_checked": ("site STRING, checked_at STRING", "site"),
    "emails_checked": ("email STRING, checked_at STRING", "email"),
    "channels_checked": ("channel_id STRING, checked_at STRING", "channel_id"),
    "processed_videos": ("video_id STRING", "video_id"),
    "processed_queries": ("query STRING, place ARRAY<BIGINT>", "query"),
    "failures": (FAILURE_DDL, "key"),
    "provider_state": ("key STRING, value STRING", "key"),
    # of discovery, see leadloom.plans.discovery
    "query_tokens": ("query STRING, token STRING", "query"),
    "query_done": ("query STRING, done_at STRING", "query"),
    "known_channels": ("channel_id STRING", "channel_id"),
}
COUNTERS = ["candidates_found", "unique_candidates", "duplicates_prevented", "qualified", "emails_found", "verified_emails",
            "instagram_lookups", "instagram_found", "websites_crawled", "youtube_requests", "youtube_search_requests", "errors",
            "new_leads", "updated_leads", "total_leads"]
RUN_DDL = ("run_id STRING, stream STRING, batch BIGINT, started_at STRING, query_offset BIGINT, tables MAP<STRING, BIGINT>, "
           + ", ".join(f"{c} BIGINT" for c in COUNTERS))


@dataclass(frozen=True)
class Runs:
    """The stored tables below ``base``; ``buckets`` is their number for new tables."""

    base: str
    buckets: int = 64

    @property
    def leads(self) -> Keyed:
        return lead_store(f"{self.base}/leads", self.buckets)

    def state(self, name: str) -> Keyed:
        ddl, key = STATE[name]
        return Keyed(f"{self.base}/{name}", ddl, key, self.buckets)

    def newest(self, spark: SparkSession) -> int | None:
        known = versions(spark, f"{self.base}/runs")
        return known[-1] if known else None

    def reports(self, spark: SparkSession) -> DataFrame:
        """A row for each finished run, with its counters and ratios."""
        if self.newest(spark) is None:
            return spark.createDataFrame([], f"{RUN_DDL}, version INT")
        return spark.read.schema(f"{RUN_DDL}, version INT").parquet(f"{self.base}/runs")

    def report(self, spark: SparkSession, params: Params) -> DataFrame:
        """The newest report with its ratios, one row."""
        last = self.reports(spark).where(F.col("version") == self.newest(spark))
        return with_run_status(with_ratios(last)) if params.email_first else with_ratios(last)

    def tables(self, spark: SparkSession) -> dict[str, int]:
        """The versions of the tables that the newest finished run left: one of its own for those it changed."""
        newest = self.newest(spark)
        return {} if newest is None else self.reports(spark).where(F.col("version") == newest).first().tables

    def read(self, spark: SparkSession, name: str, tables: dict[str, int] | None = None) -> DataFrame:
        """A state table, or ``leads``, as the newest finished run left it."""
        held = self.tables(spark) if tables is None else tables
        return (self.leads if name == "leads" else self.state(name)).read(spark, held.get(name, -1))

    def offset(self, spark: SparkSession) -> int:
        """Where the next round of discovery goes on."""
        newest = self.newest(spark)
        return 0 if newest is None else self.reports(spark).where(F.col("version") == newest).first().query_offset

    def view(self, spark: SparkSession, name: str) -> DataFrame:
        """``hot``, ``no_email`` (in their order by ``line``) or ``stats`` of the newest finished run."""
        return spark.read.parquet(f"{self.base}/views/{name}/version={self.newest(spark)}")

    def done(self, spark: SparkSession, stream: str, batch: int) -> bool:
        """Whether a batch of a stream is already part of the tables."""
        return not self.reports(spark).where((F.col("stream") == stream) & (F.col("batch") >= batch)).isEmpty()


def _write_views(spark: SparkSession, runs: Runs, version: int, row: DataFrame, params: Params) -> None:
    """The views of the lead table of a version; sorted ones number their lines by the sort's ranges."""
    leads = runs.leads.read(spark, version)
    views = {"hot": sorted_hot_view(leads, *store_order()), "no_email": sorted_no_email_view(leads, *store_order())}
    for name, view in views.items():
        (view.withColumn("line", F.monotonically_increasing_id())  # rises with the order of the sort
         .write.mode("overwrite").parquet(f"{runs.base}/views/{name}/version={version}"))
    shown = row.withColumns({"finished_at": F.col("started_at"), "duration": F.lit("")})
    # of equal counts the value goes first whose first lead does: the largest by ``newest_first``
    lines = stats_lines(leads, shown, params.as_of, newest=newest_first())
    lines.coalesce(1).write.mode("overwrite").parquet(f"{runs.base}/views/stats/version={version}")  # of fixed size


def run(spark: SparkSession, runs: Runs, inputs: Inputs, params: Params, *, run_id: str, queries: DataFrame | None = None,
        videos: DataFrame | None = None, failures: DataFrame | None = None, discovery=None, stream: str = "", batch: int = -1,
        requests: dict[str, int] | None = None) -> dict:
    """One run from candidates to committed tables and views; returns its counters.

    ``queries(query, ord)`` were searched, ``videos(channel_id, video_id)`` found, ``failures(key, error, seen_at, seq)`` met in
    this run; ``requests`` are counts of calls made for it. ``discovery`` is the round that found the candidates, whose state
    becomes part of the commit. Lookups use the cache that the last run left, unless ``inputs`` brings one.
    """
    newest, before = runs.newest(spark), runs.tables(spark)
    version, tables = 0 if newest is None else newest + 1, dict(before)
    cache = inputs.cache if inputs.cache is not None else runs.read(spark, "lookup_cache", before)
    result = harvest(replace(inputs, cache=cache), params)
    in_leads = Counters(emails_found=F.count_if(F.col("email") != ""), verified_emails=F.count_if(F.col("email_status") == VERIFIED))
    looked = Counters(instagram_lookups=F.count(F.lit(1)), instagram_found=F.count_if(F.col("url") != ""))
    counts = merge_store(spark, runs.leads, in_leads.of(result.leads), params, version, before.get("leads", -1))
    tables["leads"] = version
    answers = written(looked.of(result.answers))
    processed = written(result.processed)

    def changed(name: str, rows: DataFrame) -> None:
        runs.state(name).upsert(spark, rows, version, before.get(name, -1))
        tables[name] = version

    def whole(name: str, rows: DataFrame) -> None:
        runs.state(name).replace(spark, rows, version)
        tables[name] = version

    def checked(name: str, rows: DataFrame, column: str) -> None:
        own = rows.select(column).where(F.col(column) != "").distinct()
        changed(name, own.select(column, F.lit(params.as_of).alias("checked_at")))

    changed("lookup_cache", answers if params.cache_search_errors else answers.where("status <> 'SEARCH_ERROR'"))
    checked("sites_checked", processed.where("site_domain IS NOT NULL").select(F.col("website").alias("site")), "site")
    checked("emails_checked", processed, "email")
    channels = processed.where("source = 'YOUTUBE'").select(F.col("provider_id").alias("channel_id"))
    checked("channels_checked", channels, "channel_id")
    changed("provider_state", spark.createDataFrame([("last_run", run_id)], "key STRING, value STRING"))
    if videos is not None:
        own = videos.join(channels.distinct(), "channel_id", "left_semi").select("video_id").distinct()
        if params.videos_kept is None:
            changed("processed_videos", own)
        else:  # of so many rows at most
            held = runs.read(spark, "processed_videos", before).union(own).distinct()
            whole("processed_videos", last_rows(held, params.videos_kept, "video_id"))
    if queries is not None:
        whole("processed_queries", first_seen(runs.read(spark, "processed_queries", before), queries, "query", version, params.queries_kept))
    if failures is not None:
        totals = cut(failure_totals(failures))
        known = runs.read(spark, "failures", before).join(totals.select("key"), "key", "left_semi")
        changed("failures", merge_failures(known, totals))
    if discovery is not None:
        for name, rows in (("query_tokens", discovery.tokens), ("query_done", discovery.done), ("known_channels", discovery.known)):
            whole(name, rows)

    totals = {name: n for counters in (*result.counters, in_leads, looked) for name, n in counters.get().items()}
    crawled = 0 if result.visits is None else result.visits.where("visit_no = 1").count()  # every visited site has a first page
    row = {"run_id": run_id, "stream": stream, "batch": batch, "started_at": params.as_of,
           "query_offset": runs.offset(spark) if discovery is None else discovery.offset, "tables": tables, "youtube_requests": 0, "youtube_search_requests": 0,
           "errors": 0 if failures is None else failures.count(), **totals,
           "websites_crawled": crawled, **counts, **(requests or {})}
    row["duplicates_prevented"] = row["candidates_found"] - row["unique_candidates"]
    one = spark.createDataFrame([row], RUN_DDL)
    _write_views(spark, runs, version, one, params)
    one.coalesce(1).write.mode("overwrite").parquet(f"{runs.base}/runs/version={version}")
    return row | {"version": version}
