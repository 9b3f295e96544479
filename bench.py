"""Times the headline queries: one warm-up each, then the wall time of a full evaluation.

Prints one JSON line. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (comma separated)
choose tables, cores and queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "url_canonical", "doc_emails", "mask_secrets", "page_links", "web_candidates", "page_dedup", "multi_key_dedup",
    "lead_score", "lead_hot", "lead_reasons", "stable_ids", "lead_upsert", "hot_view", "lead_stats", "lead_stats_by_dim",
    "failure_split", "stream_failures", "channel_rollup", "channel_candidates", "video_text_merge", "handle_match", "site_emails",
    "site_visits", "sitemap_first_per_domain", "run_report", "ttl_anti", "feed_candidates", "store_merge", "harvest_leads", "stream_queues",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from leadloom.driver import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",") if n]
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("leadloom-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - started
        times[name] = round(elapsed, 3)
        print(f"{name}: {elapsed:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total wall time of headline queries after one warm-up", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
