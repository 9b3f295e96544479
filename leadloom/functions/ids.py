"""Stable lead ids and the keys that make two candidates the same entity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.functions.emails import normalize_email
from leadloom.functions.text import blank, strip
from leadloom.functions.urls import canonical_domain, canonical_url


def _present(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def id_key(email: Column | None = None) -> Column:
    """The text behind the id: the first of provider id, email, domain, profile, description."""
    given = F.lit("") if email is None else email
    c = F.col
    described = F.concat_ws("|", blank(c("source")), blank(c("name")), blank(c("username")),
                            F.substring(blank(c("description")), 1, 120))
    own_id = F.when(_present(c("provider_id")).isNotNull(),
                    F.concat(c("source"), F.lit(":"), F.lower(strip(c("provider_id")))))
    return F.coalesce(
        own_id,
        F.concat(F.lit("email:"), _present(normalize_email(given))),
        F.concat(F.lit("domain:"), _present(canonical_domain(c("website")))),
        F.concat(F.lit("profile:"), _present(canonical_url(c("profile_url")))),
        F.concat(F.lit("fallback:"), F.lower(described)))


def stable_id(email: Column | None = None) -> Column:
    return F.substring(F.sha2(id_key(email), 256), 1, 24)


def candidate_keys(*, provider: bool = True, domain: bool = True, profile: bool = True) -> Column:
    """Distinct non-null keys of a candidate row; each kind can be switched off."""
    c = F.col
    kinds = []
    if provider:
        kinds.append(F.concat(F.lit("provider:"), F.lower(c("source")), F.lit(":"),
                              F.lower(_present(c("provider_id")))))
    if domain:
        kinds.append(F.concat(F.lit("domain:"), _present(canonical_domain(c("website")))))
    if profile:
        kinds.append(F.concat(F.lit("profile:"), _present(canonical_url(c("profile_url")))))
    return F.array_compact(F.array(*kinds))
