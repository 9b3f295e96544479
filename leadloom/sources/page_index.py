"""Stored pages in hash buckets of their domain: a run reads the pages of its sites, and parses no others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.functions.html import is_site_page
from leadloom.operators.checkpoints import cut
from leadloom.operators.sites import place_pages
from leadloom.sources.buckets import Keyed

PAGES_DDL = "page_id BIGINT, url STRING, html STRING, content_type STRING, page STRING, domain STRING, readable BOOLEAN"


def page_index(base: str, buckets: int = 64) -> Keyed:
    """Pages as :func:`place_pages` gives them, and whether they read like one; a run takes ``page_index(base).read(spark)`` as its pages.

    Sites are joined on the domain without shuffling a page, and before its text is read.
    """
    return Keyed(base, PAGES_DDL, "domain", buckets)


def add_pages(spark: SparkSession, index: Keyed, pages: DataFrame, version: int | None = None) -> int:
    """Add ``pages(page_id, url, html, content_type)``; those without a domain are left out, repeated ones kept.

    Only the buckets of their domains are written. A repeated change names its version again.
    """
    version, held = index.start(spark, version)
    placed = place_pages(pages).withColumn("readable", is_site_page(F.col("html"), F.col("content_type")))
    new = cut(placed.select(*index.columns(spark)))
    touched = index.touched_by(new, held)
    old = index.read_held(spark, held, touched).drop("bucket")
    dealt = new.repartition(held[0].n_buckets if held else index.buckets, "domain")
    return index.write(old.unionByName(dealt), version, held, touched)
