"""Merging a batch of leads into the stored table, with a rule per column.

Stored discovery time, status and outreach columns win where filled; a found profile is never
blanked; everything else takes the newer value, even an empty one. When an id occurs several times
in a batch, the later row is merged onto the earlier one; that fold is done by aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.emails import verified_email
from leadloom.schemas import LEAD_FIELDS, OUTREACH_FIELDS

KEEP_FIRST = ["discovered_at", "status", *OUTREACH_FIELDS]
PROFILE = ["instagram_url", "instagram_status", "instagram_search_query"]
KEEP_LAST = [c for c in LEAD_FIELDS if c not in KEEP_FIRST + PROFILE and c != "lead_id"]


def _filled(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit(""))


def unique_stored(stored: DataFrame, order: str) -> DataFrame:
    """Stored rows with an id, one per id: the last one, at the place of the first one."""
    rest = [c for c in LEAD_FIELDS if c != "lead_id"]
    named = stored.filter(F.coalesce("lead_id", F.lit("")) != "")
    last = named.groupBy("lead_id").agg(
        F.max_by(F.struct(*rest), order).alias("_row"), F.min(order).alias("stored_ord"))
    return last.select("lead_id", "_row.*", "stored_ord")


def fold_batch(batch: DataFrame, order: str) -> DataFrame:
    """One row per id: filled-first for kept columns, last for others, and the profile rule.

    Adds ``first_ord``, ``rows_folded`` and, for the profile columns, ``first_<column>``, the first
    filled value of the batch, which a stored profile needs.
    """
    o = F.col(order)

    def first_filled(name: str, start: Column | None = None) -> Column:
        usable = _filled(F.col(name)).isNotNull()
        at = F.when(usable if start is None else usable & (o >= start), o)
        return F.coalesce(F.min_by(name, at), F.lit(""))

    grouped = batch.groupBy("lead_id").agg(
        F.max_by(F.struct(*KEEP_LAST, *PROFILE), o).alias("_last"),
        *[first_filled(c).alias(c) for c in KEEP_FIRST],
        *[first_filled(c).alias(f"first_{c}") for c in PROFILE[1:]],
        F.max_by("instagram_url", F.when(_filled(F.col("instagram_url")).isNotNull(), o)).alias("_url"),
        F.max(F.when(_filled(F.col("instagram_url")).isNotNull(), o)).alias("_url_at"),
        F.max(o).alias("_last_at"), F.min(o).alias("first_ord"),
        F.count(F.lit(1)).alias("rows_folded"))
    # only ids whose profile was found by an earlier row of the same batch need a second look
    earlier = grouped.filter("_url_at < _last_at").select("lead_id", "_url_at")
    since = (batch.select("lead_id", order, *PROFILE[1:]).join(earlier, "lead_id")
             .groupBy("lead_id").agg(*[first_filled(c, F.col("_url_at")).alias(f"since_{c}") for c in PROFILE[1:]]))
    folded = grouped.join(since, "lead_id", "left")
    is_earlier = F.col("_url_at") < F.col("_last_at")
    return folded.select(
        "lead_id", *[F.col(f"_last.{c}").alias(c) for c in KEEP_LAST], *KEEP_FIRST,
        F.when(is_earlier, F.col("_url")).otherwise(F.col("_last.instagram_url")).alias("instagram_url"),
        *[F.when(is_earlier, F.col(f"since_{c}")).otherwise(F.col(f"_last.{c}")).alias(c) for c in PROFILE[1:]],
        *[f"first_{c}" for c in PROFILE[1:]], "first_ord", "rows_folded")


def merge_leads(stored: DataFrame, batch: DataFrame, *, stored_order: str = "row_no",
                batch_order: str = "ord", stored_is_unique: bool = False) -> DataFrame:
    """All leads after the merge, with ``stored_ord``, ``batch_ord`` and ``rows_folded``.

    Both sides are hashed by ``lead_id`` once; the aggregates that make ids unique and the join
    share that partitioning. A stored table bucketed by ``lead_id`` is not shuffled at all.
    """
    if stored_is_unique:
        kept = stored.select(*LEAD_FIELDS, F.col(stored_order).alias("stored_ord"))
    else:
        kept = unique_stored(stored, stored_order)
    old = kept.select("lead_id", F.struct(*[c for c in kept.columns if c != "lead_id"]).alias("old"))
    folded = fold_batch(batch, batch_order)
    new = folded.select("lead_id", F.struct(*[c for c in folded.columns if c != "lead_id"]).alias("new"))
    both = old.join(new, "lead_id", "full_outer")

    def kept_first(name: str) -> Column:
        return F.coalesce(_filled(F.col(f"old.{name}")), F.col(f"new.{name}"), F.col(f"old.{name}"))

    absent = F.col("new").isNull()
    restore = _filled(F.col("old.instagram_url")).isNotNull() & _filled(F.col("new.instagram_url")).isNull()

    def profile(name: str) -> Column:
        first = F.col("new.instagram_url" if name == "instagram_url" else f"new.first_{name}")
        kept_value = F.coalesce(_filled(F.col(f"old.{name}")), first)
        return (F.when(absent, F.col(f"old.{name}")).when(restore, kept_value)
                .otherwise(F.col(f"new.{name}")).alias(name))

    columns = {c: F.when(absent, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in KEEP_LAST}
    columns |= {c: kept_first(c).alias(c) for c in KEEP_FIRST}
    columns |= {c: profile(c) for c in PROFILE}
    columns["lead_id"] = F.col("lead_id")
    return both.select(
        *[columns[c] for c in LEAD_FIELDS], F.col("old.stored_ord").alias("stored_ord"),
        F.col("new.first_ord").alias("batch_ord"), F.col("new.rows_folded").alias("rows_folded"))


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: ids new to the table, rows that updated an id, ids in the table."""
    is_new = F.col("stored_ord").isNull()
    new = F.count_if(is_new)
    return merged.agg(
        new.alias("new_leads"),
        (F.coalesce(F.sum("rows_folded"), F.lit(0)) - new).alias("updated_leads"),
        F.count(F.lit(1)).alias("total_leads"))


def table_order() -> list[Column]:
    """Newest discovery first; equal times keep stored rows before new ones, each in their order."""
    return [F.desc("discovered_at"), F.asc_nulls_last("stored_ord"), F.asc("batch_ord")]


def verified_only(leads: DataFrame) -> DataFrame:
    """Leads with a verified address (used on both sides of the merge in email-first mode)."""
    return leads.filter(verified_email(F.col("email"), F.col("email_status")))
