"""Parameters of a run: word lists, thresholds, row limits and the reference time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from leadloom import constants as k


def _utc_now() -> str:
    return datetime.now(timezone.utc).replace(microsecond=0).isoformat()


@dataclass(frozen=True)
class Params:
    """Immutable settings, passed to operators and turned into literals in the plan.

    Row limits are ``None`` (no limit) unless asked for; :meth:`hourly` gives the limits of a
    small hourly run.
    """

    as_of: str = ""
    target_niches: tuple[str, ...] = tuple(k.TARGET_NICHES)
    target_languages: tuple[str, ...] = tuple(k.TARGET_LANGUAGES)
    target_countries: tuple[str, ...] = tuple(k.TARGET_COUNTRIES)
    creator_types: tuple[str, ...] = tuple(k.CREATOR_TYPES)
    min_subscribers: int = 500
    max_subscribers: int = 500_000
    recent_days: int = 45
    min_score: int = 55
    hot_score: int = 80
    good_score: int = 65
    possible_score: int = 50

    talking_head_hints: tuple[str, ...] = tuple(k.TALKING_HEAD_HINTS)
    podcast_hints: tuple[str, ...] = tuple(k.PODCAST_HINTS)
    educational_hints: tuple[str, ...] = tuple(k.EDUCATIONAL_HINTS)
    short_form_hints: tuple[str, ...] = tuple(k.SHORT_FORM_HINTS)
    caption_hints: tuple[str, ...] = tuple(k.CAPTION_HINTS)
    commercial_words: tuple[str, ...] = tuple(k.COMMERCIAL_WORDS)

    bad_email_domains: tuple[str, ...] = tuple(k.BAD_EMAIL_DOMAINS)
    priority_paths: tuple[str, ...] = tuple(k.PRIORITY_PATHS)
    contact_link_tokens: tuple[str, ...] = tuple(k.CONTACT_LINK_TOKENS)
    min_match_confidence: float = 0.78
    cache_ttl_days: int = 7
    query_ttl_days: int = 7
    cache_search_errors: bool = True

    email_first: bool = False
    videos_per_channel: int = 4
    sitemap_locs: int = 500
    feed_entries: int = 10
    feed_summary_titles: int = 5
    max_pages_per_domain: int = 5

    target_leads: int | None = None
    max_enrichments: int | None = None
    max_websites: int | None = None
    max_seed_pages: int | None = None
    backfill_limit: int | None = None
    searches_per_run: int = 3
    channels_refreshed: int = 100
    channels_refresh_floor: int = 50
    known_channels_kept: int | None = None
    videos_kept: int | None = None
    queries_kept: int | None = None
    score_header: str = "Lead Score"

    def __post_init__(self) -> None:
        if not self.as_of:
            object.__setattr__(self, "as_of", _utc_now())
        self.validate()

    @classmethod
    def hourly(cls, **changes) -> "Params":
        """The row limits of a small hourly run."""
        limits = dict(target_leads=500, max_enrichments=120, max_websites=120, max_seed_pages=50,
                      backfill_limit=100, known_channels_kept=5000, videos_kept=10_000, queries_kept=2_000)
        return cls(**{**limits, **changes})

    def validate(self) -> None:
        for name in ("min_score", "hot_score"):
            if not 0 <= getattr(self, name) <= 100:
                raise ValueError(f"{name} must lie in 0..100")
        if not 0 <= self.min_subscribers <= self.max_subscribers:
            raise ValueError("subscriber range is empty or negative")
        limits = ("target_leads", "max_enrichments", "max_websites", "max_seed_pages",
                  "backfill_limit", "max_pages_per_domain", "searches_per_run", "channels_refreshed")
        for name in limits:
            value = getattr(self, name)
            if value is not None and value < 0:
                raise ValueError(f"{name} must not be negative")
        datetime.fromisoformat(self.as_of)

    @property
    def as_of_micros(self) -> int:
        moment = datetime.fromisoformat(self.as_of)
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=timezone.utc)
        epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
        delta = moment - epoch
        return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
