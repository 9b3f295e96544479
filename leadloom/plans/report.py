"""Run counters and ratios as a one-row report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIOS = {
    "qualified_per_youtube_search": ("qualified", "youtube_search_requests"),
    "verified_emails_per_website": ("verified_emails", "websites_crawled"),
    "instagram_found_per_lookup": ("instagram_found", "instagram_lookups"),
}


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient with a denominator of at least one, to three digits, exact ties to even."""
    return F.bround(top / F.greatest(F.lit(1), bottom), 3)


def with_ratios(run: DataFrame) -> DataFrame:
    """Add the ratios to a table of runs that has the counters."""
    return run.withColumns({name: ratio(F.col(a), F.col(b)) for name, (a, b) in RATIOS.items()})


def with_run_status(run: DataFrame) -> DataFrame:
    """Mode and status of an email-first run."""
    return run.withColumns({
        "mode": F.lit("EMAIL_FIRST_VERIFIED_ONLY"),
        "run_status": F.when(F.col("errors") > 0, "SUCCESS_WITH_WARNINGS").otherwise("SUCCESS"),
    })
