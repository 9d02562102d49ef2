"""URL algebra: Column -> Column, by regular expressions, as the built-in URL parser rejects many real URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions.text import text, words

_AUTHORITY = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]]*\]|[^:/?#]*)"


def any_of(c: Column, parts: tuple[str, ...]) -> Column:
    """Contains one of the parts."""
    return c.rlike("|".join(re.escape(p) for p in parts))


def host_of(u: Column | str) -> Column:
    """Lower-case host without port, user and trailing dots; empty if there is none."""
    return F.regexp_replace(F.regexp_extract(F.lower(text(u)), _AUTHORITY, 1), r"\.+$|^\[|\]$", "")


def scheme_of(u: Column | str) -> Column:
    return F.lower(F.regexp_extract(text(u), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def path_of(u: Column | str) -> Column:
    return F.regexp_extract(text(u), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query_of(u: Column | str) -> Column:
    return F.regexp_extract(text(u), r"^[^?#]*\?([^#]*)", 1)


def decoded(c: Column) -> Column:
    """Percent-decoding that leaves '+' alone and what it can't decode as it was."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def in_domains(host: Column, domains: tuple[str, ...]) -> Column:
    """The host is one of the domains or below it."""
    return host.rlike(r"(^|\.)(" + "|".join(map(re.escape, domains)) + ")$")


def is_blocked_domain(u: Column | str, domains: tuple[str, ...] = K.BLOCKED_DOMAINS) -> Column:
    return in_domains(host_of(u), domains)


def is_non_media(u: Column | str, exts: tuple[str, ...] = K.NON_MEDIA_EXTS) -> Column:
    return F.lower(decoded(path_of(u))).rlike(r"\.(" + "|".join(exts) + ")$")


def is_raw_file(u: Column | str) -> Column:
    host, path = host_of(u), F.lower(path_of(u))
    forge = host.isin(*K.FORGE_HOSTS) & (path.contains("/raw/") | path.contains("/blob/"))
    return in_domains(host, K.RAW_FILE_HOSTS) | ((host == "cdn.jsdelivr.net") & path.startswith("/gh/")) | forge


def is_placeholder_token(u: Column | str) -> Column:
    """A credential parameter holds a dummy word, a dummy word with digits, or (not for accounts) four digits at most."""
    q = query_of(u)
    rx = r"(?i)(?:^|[?&])(" + K.CREDENTIAL_PARAMS + r")=([^&#]*)"
    pairs = F.arrays_zip(F.regexp_extract_all(q, F.lit(rx), F.lit(1)).alias("n"), F.regexp_extract_all(q, F.lit(rx), F.lit(2)).alias("v"))

    def junk(p: Column) -> Column:
        v = F.lower(F.trim(decoded(p["v"])))
        dummy = v.isin(*K.PLACEHOLDER_VALUES) | v.rlike("^(?:" + K.PLACEHOLDER_STEMS + r")\d*$")
        return dummy | (v.rlike(r"^\d{1,4}$") & ~F.lower(p["n"]).isin(*K.ACCOUNT_PARAMS))

    return F.exists(pairs, junk)


def is_bare_id(u: Column | str) -> Column:
    """/user/token/number without a live, movie or series part."""
    p = path_of(u)
    return ~p.rlike("/(?:live|movie|series)/") & p.rlike(r"^/\d{3,}/[0-9a-zA-Z]{6,}/\d{2,10}/?$")


def is_http(u: Column | str) -> Column:
    return text(u).rlike("^https?://")


def has_direct_hint(u: Column | str) -> Column:
    return any_of(F.lower(text(u)), K.DIRECT_HINTS)


def has_player_word(u: Column | str) -> Column:
    pq = F.lower(F.concat(path_of(u), F.lit("?"), query_of(u)))
    return pq.rlike(r"(?:^|[/\-_.?=&%])(?:" + "|".join(K.PLAYER_WORDS) + r")(?:$|[/\-_.?=&%])")


def is_probe_worthy(u: Column | str) -> Column:
    rejected = is_blocked_domain(u) | is_non_media(u) | is_placeholder_token(u) | is_bare_id(u)
    return is_http(u) & ~rejected & (has_direct_hint(u) | has_player_word(u) | in_domains(host_of(u), K.LIST_HOSTS))


def is_player_page(u: Column | str) -> Column:
    return is_http(u) & ~F.lower(path_of(u)).rlike(r"\.(" + "|".join(K.PLAYER_PAGE_FILES) + ")$") & has_player_word(u)


def probe_priority(u: Column | str) -> Column:
    """0: direct; 1: a page."""
    return F.when(has_direct_hint(u), 0).otherwise(1)


def parameter(u: Column, name: str) -> Column:
    """The first value of a query parameter, as it stands; empty if there is none."""
    return F.regexp_extract(query_of(u), rf"(?:^|&){name}=([^&]*)", 1)


def unwrap_result(u: Column | str) -> Column:
    """The target of a search engine's redirect."""
    u = text(u)
    u = F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(u)
    host, path = host_of(u), path_of(u)
    raw = F.regexp_replace(decoded(parameter(u, "u")), "^a1", "")
    raw = F.translate(raw, "-_", "+/")
    raw = F.rpad(raw, (F.ceil(F.length(raw) / 4) * 4).cast("int"), "=")
    b64 = F.try_to_binary(raw, F.lit("base64")).cast("string")
    uddg = decoded(parameter(u, "uddg"))
    return F.when(host.contains("bing.com") & path.startswith("/ck/"), F.coalesce(b64, u)).when(host.contains("duckduckgo.com") & path.startswith("/l/") & (uddg != ""), uddg).otherwise(u)


def is_result(u: Column | str) -> Column:
    """A search result to keep: http, no engine, not blocked."""
    t = unwrap_result(u)
    return is_http(t) & ~in_domains(host_of(t), K.ENGINE_HOSTS) & ~is_blocked_domain(t)


def page_key(u: Column | str) -> Column:
    """scheme://host/path without query, fragment, port and final slash."""
    p = F.when(path_of(u) == "", "/").otherwise(path_of(u))
    p = F.when(F.length(p) > 1, F.regexp_replace(p, "/$", "")).otherwise(p)
    return F.concat(F.when(scheme_of(u) == "", "https").otherwise(scheme_of(u)), F.lit("://"), host_of(u), p)


def page_priority(u: Column | str) -> Column:
    return F.when(any_of(F.lower(path_of(u)), K.LIVE_PATH_HINTS), 0).otherwise(1)


def url_key(u: Column | str) -> Column:
    """The merge key: case and final slashes are not identity."""
    return F.lower(F.regexp_replace(F.trim(text(u)), "/+$", ""))


def source_name(u: Column | str) -> Column:
    host = host_of(u)
    out = F.when(F.lit(False), F.lit(""))
    for name, rx in K.SOURCE_PATTERNS:
        out = out.when(host.rlike(rx), name)
    parts = F.split(F.replace(host, F.lit("www."), F.lit("")), r"\.")
    label = F.try_element_at(parts, F.lit(-2))
    return out.when((F.length(label) > 3) & ~label.isin(*K.GENERIC_LABELS), label).otherwise("other")


def stream_root(u: Column | str) -> Column:
    """The folder of a segment; empty at the root or on raw-file hosts."""
    root = F.regexp_replace(F.regexp_replace(text(u), r"[?#].*$", ""), "/[^/]*$", "")
    return F.when((path_of(root) == "") | is_raw_file(root), "").otherwise(root)


def is_fixture(path: Column | str) -> Column:
    p = F.lower(text(path))
    return F.arrays_overlap(F.split(p, "/"), F.array(*map(F.lit, ("test", "tests", "example", "examples")))) | p.contains("fixture")


def joined(base: Column | str, ref: Column | str) -> Column:
    """A reference resolved against a base: absolute, protocol-relative, root-relative and relative paths with dot segments."""
    b, r = text(base), F.trim(text(ref))
    site = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(path_of(b), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    path, tail = F.regexp_extract(r, r"^([^?#]*)", 1), F.regexp_extract(r, r"^[^?#]*(.*)$", 1)
    full = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    parts = F.split(full, "/")
    # dot segments: a fold that drops "." and lets ".." take one part away
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda s, x: F.when(x == ".", s).when(x == "..", F.when(F.size(s) > 1, F.slice(s, F.lit(1), F.size(s) - 1)).otherwise(s)).otherwise(F.concat(s, F.array(x))))
    ends_in_folder = F.element_at(parts, -1).isin(".", "..")
    flat = F.concat(F.array_join(kept, "/"), F.when(ends_in_folder, "/").otherwise(""))
    return (
        F.when(r == "", b)
        .when(r.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), r)
        .when(r.startswith("//"), F.concat(scheme_of(b), F.lit(":"), r))
        .when(r.startswith("?"), F.concat(F.regexp_replace(b, r"[?#].*$", ""), r))
        .when(r.startswith("#"), F.concat(F.regexp_replace(b, r"#.*$", ""), r))
        .otherwise(F.concat(site, flat, tail))
    )


def url_tokens(u: Column | str) -> Column:
    """Decoded words of host and path, two characters or more, less stop words; in order."""
    blob = F.regexp_replace(F.lower(decoded(F.concat(host_of(u), F.lit(" "), path_of(u)))), "[^a-z0-9]+", " ")
    return F.filter(words(F.trim(blob)), lambda t: (F.length(t) >= 2) & ~t.isin(*K.URL_STOP))


def url_slug(u: Column | str) -> Column:
    """The first word of the path, else of the host, that could be a name."""

    def usable(c: Column) -> Column:
        segs = words(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")))
        bad = lambda t: t.isin(*K.SLUG_STOP) | (F.length(t) < 4) | t.rlike("^[0-9a-f]{8,}$") | (t.rlike("^[a-z0-9]{12,}$") & ~t.rlike("^.[^aeiouy]*[aeiouy]")) | ~t.rlike("[aeiouy]")
        return F.get(F.filter(segs, lambda t: ~bad(t)), 0)

    return F.coalesce(usable(decoded(path_of(u))), usable(host_of(u)), F.lit(""))
