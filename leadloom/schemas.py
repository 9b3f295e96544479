"""Row shapes. Internally snake_case columns and real nulls; display names only at the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import NOT_CHECKED, UNKNOWN

CANDIDATE_DDL = """
    ord BIGINT, source STRING, platform STRING, provider_id STRING, name STRING, username STRING,
    profile_url STRING, website STRING, niche STRING, country STRING, language STRING,
    followers BIGINT, recent_activity STRING, content_type STRING, caption_opportunity STRING,
    description STRING, published_at STRING, raw_links ARRAY<STRING>, raw_text STRING,
    video_ids ARRAY<STRING>, social_links ARRAY<STRING>, video_descriptions_checked INT
"""

# column, display name, default when a lead carries no value
LEAD_COLUMNS: list[tuple[str, str, str]] = [
    ("lead_id", "Lead ID", ""),
    ("discovered_at", "Discovered At", ""),
    ("last_checked", "Last Checked", ""),
    ("source", "Source", ""),
    ("name", "Name", ""),
    ("username", "Username", ""),
    ("platform", "Platform", ""),
    ("profile_url", "Profile URL", ""),
    ("website", "Website", ""),
    ("email", "Email", ""),
    ("email_status", "Email Status", ""),
    ("email_source_url", "Email Source URL", ""),
    ("niche", "Niche", ""),
    ("country", "Country", ""),
    ("language", "Language", ""),
    ("followers", "Followers/Subscribers", ""),
    ("recent_activity", "Recent Activity", ""),
    ("content_type", "Content Type", ""),
    ("caption_opportunity", "Caption Opportunity", ""),
    ("lead_score", "Lead Score", ""),
    ("classification", "Classification", ""),
    ("why_qualified", "Why Qualified", ""),
    ("status", "Status", "NEW"),
    ("instagram_url", "Instagram URL", ""),
    ("instagram_status", "Instagram Status", NOT_CHECKED),
    ("instagram_search_query", "Instagram Search Query", ""),
    ("outreach_status", "Outreach Status", ""),
    ("email_subject", "Email Subject", ""),
    ("sent_at", "Sent At", ""),
    ("gmail_message_id", "Gmail Message ID", ""),
    ("outreach_error", "Outreach Error", ""),
    ("outreach_attempts", "Outreach Attempts", ""),
]
LEAD_FIELDS = [name for name, _, _ in LEAD_COLUMNS]
OUTREACH_FIELDS = LEAD_FIELDS[26:]
HOT_FIELDS = ["name", "email", "profile_url", "website", "niche", "lead_score", "language",
              "country", "email_status", "source"]
NO_EMAIL_FIELDS = ["name", "profile_url", "website", "niche", "lead_score", "language", "country",
                   "source", "why_qualified"]
STATE_DDL = "key STRING, value STRING"
CACHE_DDL = ("email STRING, url STRING, status STRING, query STRING, confidence DOUBLE, "
             "checked_at STRING")


class SchemaMismatch(ValueError):
    """The stored table does not fit the expected columns; nothing was changed."""


def candidates_from(df: DataFrame, **columns: Column) -> DataFrame:
    """Project to the candidate shape; columns not given take their default."""
    text, blank = F.lit(UNKNOWN), F.lit("")
    empty_links = F.array().cast("array<string>")
    defaults = {
        "provider_id": blank, "name": text, "username": text, "profile_url": blank,
        "website": blank, "niche": text, "country": text, "language": text,
        "followers": F.lit(None).cast("bigint"), "recent_activity": text, "content_type": text,
        "caption_opportunity": text, "description": blank, "published_at": blank,
        "raw_links": empty_links, "raw_text": blank, "video_ids": empty_links,
        "social_links": empty_links, "video_descriptions_checked": F.lit(None).cast("int"),
    }
    values = {**defaults, **columns}
    fields = [part.split() for part in CANDIDATE_DDL.replace("\n", " ").split(",")]
    return df.select(*[values[name].cast(kind).alias(name) for name, kind in fields])
