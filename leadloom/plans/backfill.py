"""Filling in missing profiles of stored leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import strip
from leadloom.operators.checkpoints import cut
from leadloom.operators.match import backfill_candidates, find_profiles
from leadloom.params import Params
from leadloom.schemas import LEAD_FIELDS


def backfill(leads: DataFrame, cache: DataFrame, results: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """The lead table with profiles filled in, and the new cache rows (one per address)."""
    marked = cut(backfill_candidates(leads, cache, params))
    wanted = marked.filter("action = 'lookup'").select(
        F.col("row_no").alias("lead_id"), strip(F.col("email")).alias("email"), strip(F.col("name")).alias("name"),
        strip(F.col("username")).alias("username"))
    found = cut(find_profiles(wanted, results, params))
    renamed = found.select(F.col("lead_id").alias("_row"), F.col("url").alias("f_url"),
                           F.col("status").alias("f_status"), F.col("query").alias("f_query"), "confidence")
    joined = marked.join(renamed, marked["row_no"] == F.col("_row"), "left")

    def value(column: str, field: str) -> Column:
        return (F.when(F.col("action") == "lookup", F.col(f"f_{field}"))
                .when(F.col("action") == "cached", F.col(f"c_{field}")).otherwise(F.col(column)))

    filled = joined.withColumns({
        "instagram_url": value("instagram_url", "url"), "instagram_status": value("instagram_status", "status"),
        "instagram_search_query": value("instagram_search_query", "query")})
    answers = (joined.filter("action = 'lookup'").groupBy(strip(F.col("email")).alias("email"))
               .agg(F.max_by(F.struct("f_url", "f_status", "f_query", "confidence"), "row_no").alias("r"))
               .select("email", F.col("r.f_url").alias("url"), F.col("r.f_status").alias("status"),
                       F.col("r.f_query").alias("query"), F.col("r.confidence").alias("confidence"),
                       F.lit(params.as_of).alias("checked_at")))
    return filled.select(*LEAD_FIELDS, "row_no"), answers


def backfill_report(marked: DataFrame, filled: DataFrame) -> DataFrame:
    """One row: eligible rows, rows with a profile now, all rows, mode."""
    eligible = marked.agg(F.count_if(F.col("action") == "lookup")).scalar()
    return filled.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("instagram_url") != "").alias("rows_with_profile"),
    ).select(eligible.alias("eligible_rows"), "total_rows", "rows_with_profile",
             F.lit("INSTAGRAM_EMAIL_LOCALPART_SEARCH_BACKFILL").alias("mode"))
