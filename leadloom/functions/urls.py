"""Canonical URLs and domains, link extraction, relative links. Column expressions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.constants import CLICK_IDS, WEBSITE_BLOCKED_HOSTS
from leadloom.functions.sqltext import apply, apply2, bind, q, q_list
from leadloom.functions.text import SPACE, any_of, blank

# the generic URI split of RFC 3986: scheme, authority, path, query, fragment
_URI = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_HOST = r"^([^:\[\]]*)(?::([0-9]*))?$"
_HOST6 = r"^\[([0-9A-Fa-f:.]+)\](?::([0-9]*))?$"


_DECODED = "try_url_decode(regexp_replace({0}, '%(?![0-9A-Fa-f]{{2}})', '%25'))"
_ENCODED = "replace(replace(url_encode({0}), '%7E', '~'), '*', '%2A')"


def _query_sql(query: str) -> str:
    """Sorted, re-encoded pairs without tracking parameters."""
    name = _DECODED.format("substring_index(p, '=', 1)")
    value = _DECODED.format("CASE WHEN contains(p, '=') THEN regexp_replace(p, '(?s)^[^=]*=', '') ELSE '' END")
    pieces = f"filter(split({query}, '&'), p -> p <> '')"
    pairs = f"transform({pieces}, p -> struct({name} AS name, {value} AS value))"
    wanted = f"filter({pairs}, p -> NOT (lower(p.name) LIKE 'utm\\\\_%' OR lower(p.name) IN ({q_list(CLICK_IDS)})))"
    shown = f"concat({_ENCODED.format('p.name')}, '=', {_ENCODED.format('p.value')})"
    return f"CASE WHEN {query} = '' THEN '' ELSE array_join(transform(array_sort({wanted}), p -> {shown}), '&') END"


def _parts_sql(url: str) -> str:
    """Scheme, authority without user, path and query of a trimmed address."""
    group = f"regexp_extract({url}, {q(_URI)}, "
    return (f"struct(lower({group}1)) AS scheme, regexp_replace({group}2), '(?s)^.*@', '') AS hostport, "
            f"{group}3) AS path, {group}4) AS query)")


def _host_sql(p: str) -> str:
    """Scheme, host, port and cleaned path and query from the parts."""
    def group(i: int) -> str:
        return (f"CASE WHEN startswith({p}.hostport, '[') THEN regexp_extract({p}.hostport, {q(_HOST6)}, {i}) "
                f"ELSE regexp_extract({p}.hostport, {q(_HOST)}, {i}) END")

    return f"""struct(
        CASE WHEN {p}.scheme IN ('http', 'https') THEN 'https' ELSE {p}.scheme END AS scheme,
        regexp_replace(lower({group(1)}), {q(r"^www\.")}, '') AS host,
        CASE WHEN {group(2)} = '' THEN 0 ELSE coalesce(try_cast({group(2)} AS INT), -1) END AS port,
        {p}.hostport RLIKE {q(_HOST)} OR {p}.hostport RLIKE {q(_HOST6)} AS well_formed,
        regexp_replace(CASE WHEN {p}.path = '' THEN '/' ELSE {p}.path END, '/{{2,}}', '/') AS path,
        {_query_sql(p + '.query')} AS query)"""


def _assembled_sql(u: str) -> str:
    port = f"CASE WHEN {u}.port > 0 AND NOT ({u}.scheme = 'https' AND {u}.port = 443) THEN concat(':', {u}.port) ELSE '' END"
    scheme = f"CASE WHEN {u}.scheme = '' THEN '' ELSE concat({u}.scheme, ':') END"
    path = f"CASE WHEN {u}.path = '/' THEN '/' ELSE regexp_replace({u}.path, '/+$', '') END"
    front = f"""CASE
        WHEN {u}.host <> '' THEN concat({scheme}, '//', {u}.host, {port},
            CASE WHEN path = '' OR startswith(path, '/') THEN path ELSE concat('/', path) END)
        WHEN {u}.scheme = 'https' AND startswith(path, '/') THEN concat({scheme}, '//', path)
        ELSE concat({scheme}, path) END"""
    query = f"CASE WHEN {u}.query = '' THEN '' ELSE concat('?', {u}.query) END"
    whole = bind("path", path, f"concat({front}, {query})")
    return f"CASE WHEN {u}.well_formed AND {u}.port BETWEEN 0 AND 65535 THEN {whole} ELSE '' END"


def _canonical_sql() -> str:
    absolute = "CASE WHEN startswith(t, '//') THEN concat('https:', t) ELSE t END"
    complete = bind("a", absolute, "translate(CASE WHEN contains(a, '://') THEN a ELSE concat('https://', a) END, '\t\r\n', '')")
    parsed = bind("v", complete, bind("p", _parts_sql("v"), bind("u", _host_sql("p"), _assembled_sql("u"))))
    edges = q(f"^[{SPACE}]+|[{SPACE}]+$")
    return bind("t", f"regexp_replace(coalesce(url, ''), {edges}, '')", f"CASE WHEN t = '' THEN '' ELSE {parsed} END")


_CANONICAL = _canonical_sql()


def canonical_url(url: Column) -> Column:
    """One spelling per address; text that is no URL at all (bad port, blanks) becomes ``""``."""
    return apply("url", _CANONICAL, url)


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user and port, else ``""``."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/:?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _URI, 3)


def domain_of_canonical(url: Column) -> Column:
    """Domain of an address that already went through :func:`canonical_url`."""
    return F.regexp_replace(host_of(url), r"^(?:www\.){1,2}", "")


def canonical_domain(value: Column) -> Column:
    """Host of the canonical form, without a leading ``www.``."""
    return F.regexp_replace(host_of(canonical_url(value)), r"^www\.", "")


def links_in_text(text: Column) -> Column:
    """Canonical http(s) links of a text, in order, each once."""
    found = F.regexp_extract_all(
        blank(text), F.lit(r"(?i)(https?://[^\s\x0b\x1c-\x1f\x85\p{Z}<>()\[\]{}\"']+)"), F.lit(1))
    canonical = F.transform(found, lambda u: canonical_url(F.regexp_replace(u, "[.,;!]+$", "")))
    return F.array_distinct(F.filter(canonical, lambda u: u != ""))


def host_contains(url: Column, tokens: Iterable[str]) -> Column:
    return any_of(host_of(url), tokens)


def official_website(links: Column) -> Column:
    """First link on a host outside the blocked ones (plain substring test), else ``""``."""
    own = F.filter(links, lambda u: (host_of(u) != "") & ~host_contains(u, WEBSITE_BLOCKED_HOSTS))
    return F.coalesce(F.get(own, F.lit(0)), F.lit(""))


def _merged_dots_sql(path: str) -> str:
    """Remove ``.`` and ``..`` segments as RFC 3986 section 5.2.4 asks."""
    segments = f"slice(split({path}, '/'), 2, {1 << 30})"
    kept = f"""aggregate({segments}, cast(array() AS ARRAY<STRING>), (done, part) -> CASE
        WHEN part = '.' THEN done
        WHEN part = '..' THEN slice(done, 1, greatest(size(done) - 1, 0))
        ELSE concat(done, array(part)) END)"""
    open_end = f"CASE WHEN {path} RLIKE '/[.][.]?$' THEN '/' ELSE '' END"
    merged = bind("m", f"concat('/', array_join({kept}, '/'))", f"CASE WHEN endswith(m, '/') THEN m ELSE concat(m, {open_end}) END")
    return f"CASE WHEN {path} RLIKE '(^|/)[.][.]?(/|$)' THEN {merged} ELSE {path} END"


def _resolved_sql() -> str:
    root = f"regexp_extract(base, {q(r'^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)')}, 1)"
    folder = f"CASE WHEN regexp_extract(base, {q(_URI)}, 3) = '' THEN '/' ELSE regexp_replace(regexp_extract(base, {q(_URI)}, 3), '[^/]*$', '') END"
    tail = f"substring(href, length(hpath) + 1, {1 << 30})"
    full = f"CASE WHEN startswith(href, '/') THEN hpath ELSE concat({folder}, hpath) END"
    by_path = bind("hpath", f"regexp_extract(href, {q(_URI)}, 3)",
                   f"concat({root}, {bind('full', full, _merged_dots_sql('full'))}, {tail})")
    return f"""CASE WHEN href = '' THEN base
        WHEN href RLIKE {q(r'^[A-Za-z][A-Za-z0-9+.-]*:')} THEN href
        WHEN startswith(href, '//') THEN concat(substring_index(base, ':', 1), ':', href)
        WHEN startswith(href, '#') THEN concat(regexp_replace(base, '(?s)#.*$', ''), href)
        WHEN startswith(href, '?') THEN concat(regexp_replace(base, '(?s)[?#].*$', ''), href)
        ELSE {by_path} END"""


_RESOLVED = _resolved_sql()


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on page ``base`` (an absolute http(s) URL)."""
    return apply2("base", "href", _RESOLVED, base, href)
