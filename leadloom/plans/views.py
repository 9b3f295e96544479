"""Derived tables of the lead table: hot leads, leads without an address, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.constants import UNKNOWN, VERIFIED
from leadloom.functions.text import blank, strip
from leadloom.schemas import HOT_FIELDS, NO_EMAIL_FIELDS

DIMENSIONS = ["source", "niche", "language", "country"]
TOP_PER_DIMENSION = 15

RUN_METRICS = [
    ("LAST RUN", "finished_at"), ("LAST RUN DURATION", "duration"),
    ("LEADS DISCOVERED LAST RUN", "candidates_found"), ("NEW LEADS LAST RUN", "new_leads"),
    ("DUPLICATES PREVENTED", "duplicates_prevented"), ("WEBSITES CRAWLED", "websites_crawled"),
    ("YOUTUBE REQUESTS", "youtube_requests"), ("YOUTUBE SEARCH REQUESTS", "youtube_search_requests"),
    ("INSTAGRAM LOOKUPS", "instagram_lookups"), ("INSTAGRAM FOUND LAST RUN", "instagram_found"),
    ("ERRORS", "errors"),
]


def is_hot(classification: Column) -> Column:
    return F.upper(blank(classification)) == "HOT"


def has_email(email: Column) -> Column:
    return strip(blank(email)) != ""


def hot_view(leads: DataFrame) -> DataFrame:
    return leads.filter(is_hot(F.col("classification"))).select(*HOT_FIELDS)


def sorted_hot_view(leads: DataFrame, *order: str | Column) -> DataFrame:
    """Verified leads first, then by score; equal ones in table order (``row_no`` if no other is given)."""
    hot = leads.filter(is_hot(F.col("classification")))
    verified = (blank(F.col("email_status")) == VERIFIED).cast("int")
    return hot.orderBy(verified.desc(), F.coalesce("lead_score", F.lit(0)).desc(), *(order or ("row_no",))).select(*HOT_FIELDS)


def no_email_view(leads: DataFrame) -> DataFrame:
    return leads.filter(~has_email(F.col("email"))).select(*NO_EMAIL_FIELDS)


def sorted_no_email_view(leads: DataFrame, *order: str | Column) -> DataFrame:
    blank_mail = leads.filter(~has_email(F.col("email")))
    return blank_mail.orderBy(F.coalesce("lead_score", F.lit(0)).desc(), *(order or ("row_no",))).select(*NO_EMAIL_FIELDS)


def lead_counts(leads: DataFrame, today: str) -> DataFrame:
    """``(metric, value)``: the global counts, one pass, one row combined per task."""
    filled_mail = has_email(F.col("email"))
    counts = {
        "TOTAL LEADS": F.count(F.lit(1)),
        "NEW TODAY": F.count_if(F.substring("discovered_at", 1, 10) == today[:10]),
        "HOT LEADS": F.count_if(is_hot(F.col("classification"))),
        "EMAILS FOUND": F.count_if(filled_mail),
        "VERIFIED EMAILS": F.count_if(blank(F.col("email_status")) == VERIFIED),
        "INSTAGRAM FOUND": F.count_if(strip(blank(F.col("instagram_url"))) != ""),
        "CONTACTED": F.count_if(F.upper("status") == "CONTACTED"),
        "OUTREACH SENT": F.count_if(F.upper("outreach_status") == "SENT"),
        "NO EMAIL": F.count_if(~filled_mail),
    }
    row = leads.agg(*[c.alias(f"m{i}") for i, c in enumerate(counts.values())])
    pairs = F.array(*[F.struct(F.lit(i).alias("line"), F.lit(name).alias("metric"), F.col(f"m{i}").alias("value"))
                      for i, name in enumerate(counts)])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def counts_by_dimension(leads: DataFrame, order: str = "row_no", top: int = TOP_PER_DIMENSION,
                        newest: Column | None = None) -> DataFrame:
    """``(dimension, value, leads, place)``: the most common values per dimension in one pass.

    Ties go to the value that appears first, that is at the least ``order``, or the largest ``newest``. The rank filter runs before the shuffle as well, so a
    dimension with very many values sends only its best ones.
    """
    shown = leads.select((F.col(order) if newest is None else newest).alias("_ord"), *[
        F.coalesce(F.nullif(F.col(d), F.lit("")), F.lit(UNKNOWN)).alias(d) for d in DIMENSIONS])
    sets = [[F.col(d)] for d in DIMENSIONS]
    grouped = shown.groupingSets(sets, *DIMENSIONS).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("leads"), (F.min if newest is None else F.max)("_ord").alias("_first"))
    # grouping_id has a 0 bit for the grouped column, first column in the highest bit
    masks = {(1 << len(DIMENSIONS)) - 1 - (1 << (len(DIMENSIONS) - 1 - i)): d for i, d in enumerate(DIMENSIONS)}
    dimension, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for mask, name in masks.items():
        here = F.col("_set") == mask
        dimension = F.when(here, name).otherwise(dimension)
        value = F.when(here, F.col(name)).otherwise(value)
    named = grouped.select(dimension.alias("dimension"), value.alias("value"), "leads", "_first")
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("leads"), F.asc("_first") if newest is None else F.desc("_first")))
    return named.withColumn("place", place).filter(F.col("place") <= top).drop("_first")


def run_metric_rows(run: DataFrame) -> DataFrame:
    """``(line, metric, value)`` of the last run for the statistics table."""
    pairs = F.array(*[
        F.struct(F.lit(i + 9).alias("line"), F.lit(shown).alias("metric"),
                 F.coalesce(F.col(name).cast("string"), F.lit("")).alias("value"))
        for i, (shown, name) in enumerate(RUN_METRICS)])
    return run.select(F.explode(pairs).alias("p")).select("p.*")


def stats_lines(leads: DataFrame, run: DataFrame, today: str, order: str = "row_no", newest: Column | None = None) -> DataFrame:
    """The whole statistics table as ``(line, metric, value)`` text rows.

    Its size is fixed by the counts and the top lists, whatever the size of the lead table.
    """
    counts = lead_counts(leads, today).select("line", "metric", F.col("value").cast("string").alias("value"))
    ranked = counts_by_dimension(leads, order, newest=newest)
    start = {d: 100 + 100 * i for i, d in enumerate(DIMENSIONS)}
    base = F.create_map(*[F.lit(x) for pair in start.items() for x in pair])
    lines = ranked.select(
        (F.element_at(base, F.col("dimension")) + F.col("place")).cast("int").alias("line"),
        F.concat(F.lit("  "), F.col("value")).alias("metric"), F.col("leads").cast("string").alias("value"))
    titles = leads.sparkSession.createDataFrame(
        [(start[d], f"LEADS BY {d.upper()}", "") for d in DIMENSIONS], "line INT, metric STRING, value STRING")
    return counts.unionByName(run_metric_rows(run)).unionByName(titles).unionByName(lines)


def stats_table(leads: DataFrame, run: DataFrame, today: str, order: str = "row_no") -> DataFrame:
    """The statistics as ``(metric, value)`` rows in their order."""
    return stats_lines(leads, run, today, order).orderBy("line").select("metric", "value")
