"""Word lists, tokens and formats that results depend on.

They are plain data. Every list that a user may want to change is also a field of
:class:`leadloom.params.Params`, whose defaults point here.
"""

# --- fixed values: markers and status texts -------------------------------------------
UNKNOWN = "UNKNOWN"
VERIFIED = "VERIFIED_PUBLIC_SOURCE"
NOT_CHECKED = "NOT_CHECKED"
FOUND = "FOUND_SEARCH_RESULT"
NOT_FOUND = "NOT_FOUND"
SEARCH_ERROR = "SEARCH_ERROR"
SKIPPED = "SKIPPED_INVALID_EMAIL"
NO_REASON = "limited public qualification signals"
REDACTED = "[REDACTED]"

# --- fixed values: URL tokens ------------------------------------------------------------
CLICK_IDS = ["fbclid", "gclid", "dclid", "mc_cid", "mc_eid"]
WEBSITE_BLOCKED_HOSTS = [
    "youtube.com", "youtu.be", "instagram.com", "tiktok.com",
    "facebook.com", "twitter.com", "x.com", "linkedin.com",
]
WEB_SOCIAL_HOSTS = ["youtube.com", "instagram.com", "tiktok.com", "linkedin.com"]
SITE_SOCIAL_HOSTS = ["instagram.com", "tiktok.com", "youtube.com", "youtu.be", "linkedin.com"]
PRIORITY_PATHS = [
    "/", "/contact", "/contact-us", "/about", "/about-us", "/team", "/legal", "/mentions-legales",
]
CONTACT_LINK_TOKENS = ["contact", "about", "team", "legal", "mention"]

# --- fixed values: email rules -------------------------------------------------------------
EMAIL_LOCAL_CLASS = "[A-Z0-9.!#$%&'*+/=?^_`{|}~-]"
EMAIL_DOMAIN = r"[A-Z0-9.-]+\.[A-Z]{2,63}"
BAD_LOCAL_PREFIXES = [
    "noreply", "no-reply", "donotreply", "do-not-reply", "example", "test", "testing",
    "privacy", "abuse", "webmaster", "postmaster", "mailer-daemon", "root",
]
BAD_EMAIL_DOMAINS = [
    "example.com", "example.org", "example.net", "email.com", "domain.com", "sentry.io",
]
BAD_EMAIL_ENDINGS = [".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".css", ".js"]
PREFERRED_LOCALS = [
    "contact", "hello", "business", "collab", "partnership", "partnerships", "booking", "info",
]
BUSINESS_LOCAL_TOKENS = ["business", "collab", "partner", "booking"]

# --- fixed values: secret masking ------------------------------------------------------------
SECRET_WORDS = "api[_-]?key|token|authorization|credential|secret"
SECRET_STEMS = ["api", "token", "authorization", "credential", "secret"]

# --- fixed values: qualification ----------------------------------------------------------------
TARGET_NICHES = ["business", "fitness", "marketing", "coaching", "real_estate", "finance"]
TARGET_LANGUAGES = ["fr"]
TARGET_COUNTRIES = ["BE", "FR", "CA", "CH"]
CREATOR_TYPES = ["coach", "consultant", "formateur", "entrepreneur", "creator", "podcast"]
TALKING_HEAD_HINTS = [
    "face cam", "talking head", "conseil", "tips", "explique", "how to", "tuto", "tutorial", "coach",
]
PODCAST_HINTS = ["podcast", "interview", "episode"]
EDUCATIONAL_HINTS = ["formation", "learn", "education", "conseil", "tips", "guide", "cours"]
SHORT_FORM_HINTS = ["shorts", "short", "reel", "tiktok", "vertical", "clip"]
CAPTION_HINTS = ["subtitle", "subtitles", "caption", "captions", "sous-titre", "sous titres"]
COMMERCIAL_WORDS = ["coach", "consultant", "formateur", "entrepreneur", "business", "podcast"]

# --- fixed values: query expansion and language by country -----------------------------------------
NICHE_TERMS = {
    "fitness": ["coach fitness", "personal trainer", "fitness tips", "online coach",
                "nutrition coach", "musculation", "perte de poids"],
    "business": ["business coach", "entrepreneur", "business tips", "personal brand",
                 "fondateur", "solopreneur"],
    "marketing": ["marketing coach", "content marketing", "growth marketing",
                  "social media tips", "copywriting"],
    "coaching": ["coach en ligne", "consultant", "formateur", "mentor", "coaching business"],
    "real_estate": ["agent immobilier", "real estate coach", "immobilier conseils", "realtor tips"],
    "finance": ["finance creator", "personal finance", "investissement", "finance tips",
                "educateur financier"],
}
LANGUAGE_HINTS = {
    "fr": ["français", "france", "belgique", "quebec"],
    "en": ["english"],
    "nl": ["nederlands", "belgie"],
}
COUNTRY_LANGUAGE = {
    "FR": "fr", "BE": "fr", "CA": "fr", "CH": "fr", "GB": "en", "US": "en", "NL": "nl",
}

# --- fixed values: social profile matching -----------------------------------------------------------
PROFILE_HOSTS = ["instagram.com", "www.instagram.com", "m.instagram.com"]
PROFILE_RESERVED = [
    "p", "reel", "reels", "stories", "explore", "accounts", "direct", "about",
    "developer", "developers", "privacy", "legal", "terms", "challenge", "tv",
]
GENERIC_LOCALS = [
    "contact", "hello", "hi", "info", "support", "admin", "team", "sales", "business",
    "collab", "collabs", "collaboration", "booking", "bookings", "marketing", "media",
    "press", "partnership", "partnerships", "partner", "enquiry", "enquiries", "help",
    "orders", "office", "service", "customer", "customerservice",
]
SEARCH_HOST = "duckduckgo.com"

# --- fixed values: state keys and their empty values ------------------------------------------------
STATE_DEFAULTS = {
    "processed_queries": "[]", "query_cursors": "{}", "channel_checked_at": "{}",
    "website_checked_at": "{}", "email_checked_at": "{}", "instagram_lookup_cache": "{}",
    "processed_video_ids": "[]", "provider_state": "{}", "failed_jobs": "{}",
    "retry_queue": "[]", "dead_letter_queue": "[]", "youtube_query_offset": "0",
    "youtube_query_tokens": "{}", "youtube_query_done_at": "{}", "youtube_known_channel_ids": "[]",
}
