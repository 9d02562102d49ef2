"""Parsers of playlists, manifests and pages, as array expressions; a row per entry comes from explode."""

from __future__ import annotations

import html
import re
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions.text import let, text
from linkloom.functions.urls import any_of, decoded, is_blocked_domain, joined

_SCHEME = "(?:" + "|".join(K.URL_SCHEMES) + ")://"


def lines(doc: Column | str) -> Column:
    """Lines without their line ends."""
    return F.split(text(doc), r"\r\n|\r|\n")


def last_wins(keys: Column, values: Column) -> Column:
    """A map of lower-cased keys in which later entries win, without changing session settings."""
    pairs = F.arrays_zip(F.transform(keys, F.lower).alias("k"), values.alias("v"))
    ordered = F.array_sort(F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), i.alias("i"), p["v"].alias("v"))))
    last = let(ordered, lambda s: F.filter(s, lambda p, i: ~F.coalesce(F.get(s, i + 1)["k"] == p["k"], F.lit(False))))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"].alias("k"), p["v"].alias("v"))))


def parse_attrs(line: Column | str) -> Column:
    """key=value or key="value" pairs as a map: keys in lower case, later ones win."""
    c, rx = text(line), r'([\w-]+)=("([^"]*)"|[^,]*)'
    values = F.transform(F.regexp_extract_all(c, F.lit(rx), F.lit(2)), lambda v: F.when(v.rlike('^".*"$'), F.regexp_replace(v, '^"|"$', "")).otherwise(v))
    return last_wins(F.regexp_extract_all(c, F.lit(rx), F.lit(1)), values)


def parse_extinf(line: Column | str) -> Column:
    """attrs and the display name: what follows the first comma after the info part."""
    c = text(line)
    info, name = (F.regexp_extract(c, r"#EXTINF:(.*?),(.*)$", g) for g in (1, 2))
    rx = r'(\w[\w-]*)="([^"]*)"'
    attrs = last_wins(F.regexp_extract_all(info, F.lit(rx), F.lit(1)), F.regexp_extract_all(info, F.lit(rx), F.lit(2)))
    return F.struct(attrs.alias("attrs"), F.trim(name).alias("name"))


def extinf_entries(doc: Column | str) -> Column:
    """array of (pos, extinf, url): a #EXTINF line and the line right after it, if that is a URL.  A URL given twice keeps its
    first place and its last info.  One sort by URL and place finds both."""
    trimmed = F.transform(lines(doc), lambda x: F.trim(x))
    numbered = let(trimmed, lambda ls: F.transform(ls, lambda x, i: F.struct(F.coalesce(F.get(ls, i + 1), F.lit("")).alias("url"), i.alias("pos"), x.alias("extinf"))))
    hits = F.filter(numbered, lambda e: e["extinf"].startswith("#EXTINF:") & e["url"].rlike("^(?i)" + _SCHEME))
    other = lambda s, e, i: ~F.coalesce(F.get(s, i)["url"] == e["url"], F.lit(False))
    first = lambda s: F.filter(s, lambda e, i: F.when(i == 0, True).otherwise(other(s, e, i - 1)))
    last = lambda s: F.filter(s, lambda e, i: other(s, e, i + 1))
    both = let(F.array_sort(hits), lambda s: F.arrays_zip(first(s).alias("f"), last(s).alias("l")))
    return F.array_sort(F.transform(both, lambda b: F.struct(b["f"]["pos"].alias("pos"), b["l"]["extinf"].alias("extinf"), b["f"]["url"].alias("url"))))


def is_m3u(doc: Column | str) -> Column:
    """Looks like a playlist of some kind within its first 8000 characters."""
    head = F.substring(text(doc), 1, 8000)
    low = F.lower(head)
    xtream = r"(?i)get\.php|player_api\.php|xmltv\.php|/portal\.php|stalker_portal|panel_api|enigma22_script|auth_username|auth_password|device_mac|output=ts|output=m3u8"
    return (
        head.contains("#EXTM3U") | head.contains("#EXTINF") | head.contains("#EXT-X-") | low.contains("<mpd") | low.rlike("<asx|<playlist")
        | low.startswith("[playlist]") | head.rlike(xtream) | F.trim(head).rlike("^(?i)(?:" + "|".join(re.escape(s) for s in K.STREAM_SCHEMES) + ")")
    )


def is_master(doc: Column | str) -> Column:
    return text(doc).contains("#EXT-X-STREAM-INF")


def is_hls_media(doc: Column | str) -> Column:
    return text(doc).rlike("(?i)#EXT-X-TARGETDURATION:") | text(doc).contains("#EXT-X-MEDIA-SEQUENCE:")


def is_playlist_body(doc: Column | str) -> Column:
    head = F.substring(text(doc), 1, 4000)
    return head.contains("#EXTM3U") | head.contains("#EXTINF")


def is_list_feed(doc: Column | str) -> Column:
    """A channel list rather than a stream manifest."""
    head = F.upper(F.substring(text(doc), 1, 2048))
    return text(doc).contains("#EXTINF") & ~(head.contains("#EXT-X-TARGETDURATION") | head.contains("#EXT-X-STREAM-INF"))


def extract_links(doc: Column | str) -> Column:
    """Distinct URLs of 14 schemes, trailing marks off, eight characters or more, in order."""
    rx = rf"(?i)({_SCHEME}[^\s\"'<>]+)"
    found = F.transform(F.regexp_extract_all(text(doc), F.lit(rx), F.lit(1)), lambda u: F.regexp_replace(u, r"[.,;:!?)]+$", ""))
    return F.array_distinct(F.filter(found, lambda u: F.length(u) >= 8))


def page_links(doc: Column | str, base: Column | str) -> Column:
    """Absolute link targets of href and src, and the URLs in the text."""
    rx = r"(?i)(?:href|src)\s*=\s*[\"']([^\"']+)[\"']"
    raw = F.transform(F.regexp_extract_all(text(doc), F.lit(rx), F.lit(1)), lambda x: F.replace(F.trim(x), F.lit("&amp;"), F.lit("&")))
    refs = F.filter(raw, lambda x: (x != "") & ~x.rlike("^(?:#|javascript:|mailto:|tel:|data:)"))
    urls = F.filter(F.transform(refs, lambda x: joined(base, x)), lambda u: u.rlike("^https?://"))
    return F.array_distinct(F.concat(urls, F.filter(extract_links(doc), lambda u: u.rlike("^https?://"))))


def is_stream_link(u: Column) -> Column:
    """A playlist, stream or API link; generic file types need a word of context."""
    low = F.lower(u)
    hint = any_of(low, K.STREAM_HINTS) & ~(any_of(low, K.GENERIC_EXTS) & ~low.rlike(K.STREAM_CONTEXT))
    return (hint | any_of(low, K.STREAM_SCHEMES)) & (F.length(u) >= 8) & ~is_blocked_domain(u)


def harvest_links(doc: Column | str, base: Column | str, limit: int = 40) -> Column:
    """Stream links of a page, relative declarations resolved, in order of URL, `limit` at most."""
    rel = r"(?i)[\"']([^\"'<> \t]+\.(?:m3u8|m3u|mpd|ts)(?:\?[^\"'<>]*)?)[\"']"
    own = F.filter(F.regexp_extract_all(text(doc), F.lit(rel), F.lit(1)), lambda x: ~(x.contains("://") | x.startswith("//")))
    found = F.concat(extract_links(doc), F.transform(own, lambda x: joined(base, x)))
    clean = F.transform(found, unwrap_simple)
    return F.slice(F.array_sort(F.array_distinct(F.filter(clean, is_stream_link))), 1, limit)


def extract_embeds(doc: Column | str, base: Column | str) -> Column:
    """Absolute URLs of embedded players: frames first, then script declarations; distinct, in order."""
    frames = r"(?i)<(?:iframe|embed|frame|player|video|audio)\b[^>]*?\b(?:src|data-src|data-url)\s*=\s*[\"']([^\"']+)[\"']"
    script = r"(?i)(?:src|file|url|source)\s*[:=]\s*[\"']([^\"']+\.(?:m3u8|m3u|mpd)[^\"']*)[\"']"
    raw = F.concat(*[F.regexp_extract_all(text(doc), F.lit(rx), F.lit(1)) for rx in (frames, script)])
    raw = F.transform(raw, lambda x: F.trim(F.replace(x, F.lit("&amp;"), F.lit("&"))))
    ok = F.filter(raw, lambda x: (x != "") & ~x.rlike("^(?:data:|javascript:|#)"))
    return F.array_distinct(F.filter(F.transform(ok, lambda x: joined(base, x)), lambda u: u.rlike("^https?://") & ~is_blocked_domain(u)))


def script_sources(doc: Column | str, base: Column | str, cap: int = 5) -> Column:
    """Script URLs of a page, those of its own site first."""
    rx = r"(?i)<script\b[^>]*?\bsrc\s*=\s*[\"']([^\"']+)[\"']"
    urls = F.array_distinct(F.transform(F.regexp_extract_all(text(doc), F.lit(rx), F.lit(1)), lambda x: joined(base, x)))
    site = F.regexp_extract(text(base), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return F.slice(F.concat(F.filter(urls, lambda u: u.startswith(site)), F.filter(urls, lambda u: ~u.startswith(site))), 1, cap)


def script_endpoints(body: Column | str, cap: int = 8) -> Column:
    """API-like endpoints named in a script."""
    rx = r"[\"'`]((?:https?://[^\"'`\s]+)?/(?:api|v\d+|channels?|live|streams?|playlist)/[^\"'`\s<>]*)[\"'`]"
    return F.slice(F.array_distinct(F.regexp_extract_all(text(body), F.lit(rx), F.lit(1))), 1, cap)


def master_variants(doc: Column | str) -> Column:
    """array of (pos, bandwidth, resolution, uri): each STREAM-INF and the next line that is no comment."""
    ls = F.filter(F.transform(lines(doc), lambda x: F.trim(x)), lambda x: (x != "") & (~x.startswith("#") | x.startswith("#EXT-X-STREAM-INF:")))
    pairs = let(ls, lambda v: F.transform(v, lambda x, i: F.struct(i.alias("pos"), x.alias("inf"), F.coalesce(F.get(v, i + 1), F.lit("#")).alias("uri"))))
    hits = F.filter(pairs, lambda p: p["inf"].startswith("#EXT-X-STREAM-INF:") & ~p["uri"].startswith("#"))

    def out(p: Column) -> Column:
        attrs = parse_attrs(F.regexp_replace(p["inf"], "^[^:]*:", ""))
        rate = F.coalesce(F.try_element_at(attrs, F.lit("bandwidth")).try_cast("long"), F.lit(0))
        return F.struct(p["pos"].alias("pos"), rate.alias("bandwidth"), F.coalesce(F.try_element_at(attrs, F.lit("resolution")), F.lit("")).alias("resolution"), p["uri"].alias("uri"))

    return F.transform(hits, out)


def best_variant(variants: Column) -> Column:
    """The variant of most bandwidth, the first of equals; null if there is none."""
    top = F.array_max(F.transform(variants, lambda v: F.struct(v["bandwidth"].alias("b"), (-v["pos"]).alias("n"), v.alias("v"))))
    return top["v"]


def media_segments(doc: Column | str, base: Column | str, cap: int = 4) -> Column:
    """The first segments (and init maps) of a media playlist, resolved."""
    ls = F.filter(F.transform(lines(doc), lambda x: F.trim(x)), lambda x: x != "")
    refs = F.transform(ls, lambda x: F.when(x.startswith("#EXT-X-MAP:"), F.coalesce(F.try_element_at(parse_attrs(F.regexp_replace(x, "^[^:]*:", "")), F.lit("uri")), F.lit(""))).when(x.startswith("#"), F.lit(None)).otherwise(x))
    return F.slice(F.transform(F.filter(refs, lambda x: x.isNotNull()), lambda x: joined(base, x)), 1, cap)


def dash_variants(doc: Column | str, base: Column | str) -> Column:
    """array of (pos, bandwidth, resolution, uri) of the representations of an MPD."""
    c = text(doc)
    rx = r"(?is)<Representation\b((?:[^>/]|/(?!>))*)(?:/>|>(.*?)</Representation>)"
    attrs, inner = (F.regexp_extract_all(c, F.lit(rx), F.lit(g)) for g in (1, 2))
    url = r"(?i)<BaseURL>\s*([^<]+?)\s*</BaseURL>"
    outer, media = F.regexp_extract(c, url, 1), F.regexp_extract(c, r'(?i)<SegmentTemplate[^>]*\smedia="([^"]+)"', 1)

    def out(p: Column, i: Column) -> Column:
        at = lambda k: F.regexp_extract(p["a"], rf'(?i)\b{k}="([^"]*)"', 1)
        own = F.regexp_extract(p["b"], url, 1)
        uri = F.when(own != "", own).when(outer != "", outer).otherwise(media)
        size = F.when((at("width") != "") & (at("height") != ""), F.concat(at("width"), F.lit("x"), at("height"))).otherwise("")
        rate = F.coalesce(at("bandwidth").try_cast("long"), F.lit(0))
        return F.struct(i.alias("pos"), rate.alias("bandwidth"), size.alias("resolution"), F.when(uri != "", joined(base, uri)).otherwise("").alias("uri"))

    return F.filter(F.transform(F.arrays_zip(attrs.alias("a"), inner.alias("b")), out), lambda v: v["uri"] != "")


def unwrap_simple(u: Column) -> Column:
    """unwrap_link for links without escapes beyond &amp; : JVM-side."""
    t = F.replace(u, F.lit("&amp;"), F.lit("&"))
    inner = F.regexp_extract(t, r"(?i)(?:https?://[^/]+)?/url\?(?:q|url)=([^&]+)", 1)
    t = F.when(inner != "", decoded(inner)).otherwise(t)
    return F.regexp_replace(F.regexp_extract(F.replace(t, F.lit("\\/"), F.lit("/")), r"^([^<>\s\"'\\]*)", 1), r"[.,;:!?)\]}]+$", "")


def unwrap_one(link: str | None) -> str:
    """The exact form: all entities, redirects and escapes."""
    s = html.unescape(link or "")
    if m := re.search(r"(?:https?://[^/]+)?/url\?(?:q|url)=([^&]+)", s, re.IGNORECASE):
        s = unquote(m[1])
    if any(x in s for x in ("\\u003c", "\\u0026", "\\/", "\\r", "\\n")):
        try:
            s = s.encode("utf-8").decode("unicode_escape")
        except UnicodeDecodeError:
            pass
    return re.split(r"[<>\s\"'\\]", s, maxsplit=1)[0].rstrip(".,;:!?)]}")


def unwrap_link(link: Column | str) -> Column:
    """The exact form as an Arrow-batched function."""
    return F.pandas_udf(_unwrap_all, "string")(text(link))


def html_unescape(c: Column | str) -> Column:
    return F.pandas_udf(_unescape_all, "string")(text(c))


def _unwrap_all(links: pd.Series) -> pd.Series:
    return links.map(unwrap_one)


def _unescape_all(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x or ""))
