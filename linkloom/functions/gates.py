"""Admission gates over names and URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions.text import norm_name, text
from linkloom.functions.urls import is_bare_id

_PHRASES = r"(?i)(?<![a-z0-9])(?:" + "|".join(map(re.escape, K.BRAND_PHRASES)) + ")"
_WORDS = r"(?iU)(?<![\w])(?:" + "|".join(map(re.escape, K.BRAND_WORDS)) + r")(?![\w])"
_NAMES = K.BRAND_NAMES.replace("(?i)", "(?iU)", 1)


def is_regional(c: Column | str) -> Column:
    """A brand, network or language name of the region, as it stands or with URL separators read as blanks."""
    t = text(c)
    squashed = F.regexp_replace(t, "[-_./]+", " ")
    raw = t.rlike(_NAMES) | t.rlike(_PHRASES) | t.rlike(_WORDS) | t.rlike(K.REPUBLIC_TV)
    return raw | squashed.rlike(_WORDS) | squashed.rlike(_NAMES) | squashed.rlike(K.REPUBLIC_TV)


def is_geo_blocked(name: Column | str) -> Column:
    return text(name).rlike(K.GEO_BLOCKED)


def is_foreign(name: Column | str) -> Column:
    return text(name).rlike(K.FOREIGN_NAME)


def is_nsfw(name: Column | str) -> Column:
    return text(name).rlike(K.NSFW_NAME)


def is_live_candidate(url: Column | str, name: Column | str = "name") -> Column:
    u, n = text(url), text(name)
    return ~(n.rlike(K.NON_LIVE) | u.rlike(K.NON_LIVE) | u.rlike(K.NON_LIVE_PATH) | is_bare_id(u))


def is_challenge(body: Column | str, status: Column | str) -> Column:
    """A bot-challenge page: a marker near its start, or an empty 403 or 503."""
    b = text(body)
    marked = F.lower(F.substring(b, 1, 8000)).rlike("|".join(map(re.escape, K.CHALLENGE_MARKERS)))
    s = F.col(status) if isinstance(status, str) else status
    return F.when(b == "", s.isin(403, 503)).otherwise(marked)


def drop_reason(url: Column, name: Column) -> Column:
    """Why a stored row goes, or null."""
    from linkloom.functions.urls import is_placeholder_token, is_raw_file

    return F.when(is_placeholder_token(url), "placeholder").when(is_raw_file(url), "raw_file").when(is_bare_id(url), "bare_id").when(~is_live_candidate(url, name), "non_live").when(is_nsfw(name), "nsfw")


def matches_language(name: Column, url: Column, extinf: Column, *, strict: Column, known: Column, url_known: Column, proven: Column, language: str = "All", any_list: Column | None = None) -> Column:
    """The ordered admission gate.  strict, known, url_known, proven: booleans from the name and URL joins."""
    lang = "" if language == "All" else language.lower()
    told = F.lower(F.concat_ws(" ", name, url, extinf)).contains(lang) if lang else F.lit(False)
    probe = F.lower(F.concat_ws(" ", url, extinf)).contains(lang) if lang else F.lit(False)
    elsewhere = is_regional(url) | is_regional(extinf)
    return (
        F.when((name != "") & is_regional(name), True)
        .when(is_geo_blocked(name), elsewhere | told | strict)
        .when(told, True)
        .when((name != "") & is_foreign(name), strict)
        .when(norm_name(name) == "", elsewhere | url_known | proven | probe)
        .when(is_regional(url), True)
        .when(~(F.lit(True) if any_list is None else any_list), is_regional(extinf) | told)
        .otherwise(known)
    )
