"""Best published address of a candidate: its own text first, then its site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.emails import confidence_of, extract_emails, preference_of_good
from leadloom.params import Params


def best_of_array(emails: Column) -> Column:
    """``struct<preference, email>`` of the best address of an array, the first one on a tie."""
    ranked = F.transform(emails, lambda e, i: F.struct(
        preference_of_good(e).alias("preference"), (-i).alias("place"), e.alias("email")))
    return F.array_max(ranked)


def best_emails(candidates: DataFrame, site_best: DataFrame, params: Params) -> DataFrame:
    """Add ``email``, ``email_status``, ``email_source_url`` and ``email_confidence``.

    ``candidates`` carries ``site_domain`` (null when the site was not visited); ``site_best`` has
    one row per domain. Text evidence wins a tie, as it comes first.
    """
    own = candidates.withColumn(
        "_text_best", best_of_array(extract_emails(F.coalesce("raw_text", F.lit("")), params)))
    # candidates without a site match nothing; a key of their own spreads them over the tasks
    spread = own.withColumn("_site", F.coalesce("site_domain", F.concat(F.lit("#"), F.col("ord"))))
    both = spread.join(site_best.withColumnRenamed("domain", "_site"), "_site", "left").drop("_site")
    from_text = F.coalesce(F.col("_text_best.preference") >= F.coalesce("site_preference", F.lit(-1)), F.lit(False))
    source = F.when(F.coalesce("profile_url", F.lit("")) != "", F.col("profile_url")).otherwise(F.col("website"))
    email = F.when(from_text, F.col("_text_best.email")).otherwise(F.col("site_email"))
    preference = F.when(from_text, F.col("_text_best.preference")).otherwise(F.col("site_preference"))
    return both.withColumns({
        "email": F.coalesce(email, F.lit("")),
        "email_status": F.when(email.isNotNull(), "VERIFIED_PUBLIC_SOURCE").otherwise("UNKNOWN"),
        "email_source_url": F.coalesce(F.when(from_text, source).otherwise(F.col("site_email_url")), F.lit("")),
        "email_confidence": confidence_of(preference),
    }).drop("_text_best", "site_email", "site_email_url", "site_preference")


def text_evidence(df: DataFrame, text: str, source_url: str, source_type: Column, params: Params) -> DataFrame:
    """One evidence row per address found in a text column, numbered in order of appearance."""
    from leadloom.functions.emails import evidence

    found = df.withColumn("_emails", extract_emails(F.coalesce(text, F.lit("")), params)).filter(F.size("_emails") > 0)
    rows = found.select(*df.drop(text).columns, F.posexplode("_emails").alias("evidence_seq", "_email"))
    proof = evidence(F.col("_email"), preference_of_good(F.col("_email")), F.col(source_url), source_type, params)
    return rows.select(*df.drop(text).columns, "evidence_seq", proof.alias("_e")).select(
        *df.drop(text).columns, "evidence_seq", "_e.*")
