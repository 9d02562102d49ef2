"""Scalar functions over names, URLs and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions import gates as G
from linkloom.functions import parse as P
from linkloom.functions import score as S
from linkloom.functions import text as T
from linkloom.functions import urls as U
from linkloom.queries.base import query

HOST = r"rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]]*\]|[^:/?#]*)', 1), '.')"
PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
QUERY = r"regexp_extract(url, '^[^?#]*\?([^#]*)', 1)"
NORM = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({c}), '\([^)]*\)', ' ', 'g'), '\[[^\]]*\]', ' ', 'g'), '\b\d{{3,4}}[pi]\b', ' ', 'g'), '[|_/\\-]+', ' ', 'g'), '\s+', ' ', 'g'))"
NAMES = "p_name || CASE p_size % 6 WHEN 0 THEN ' (1080p)' WHEN 1 THEN ' [Blocked] HD' WHEN 2 THEN ' 720p TV' WHEN 3 THEN ' (Canada)' WHEN 4 THEN '_4K/live' ELSE '' END"


def _names(read):
    m = F.col("p_size") % 6
    tail = F.when(m == 0, " (1080p)").when(m == 1, " [Blocked] HD").when(m == 2, " 720p TV").when(m == 3, " (Canada)").when(m == 4, "_4K/live").otherwise("")
    return read("part").select(F.col("p_partkey").alias("id"), F.concat("p_name", tail).alias("name"))


@query(f"SELECT p_partkey AS id, {NORM.format(c=NAMES)} AS norm FROM part")
def q_norm_name(read, spark):
    """F1."""
    return _names(read).select("id", T.norm_name("name").alias("norm"))


@query(f"""
SELECT id, coalesce(array_to_string(list_filter(string_split(n, ' '), lambda t: t NOT IN ('', 'hd', 'fhd', 'sd', 'uhd', '4k', 'p', 'i')), ' '), '') AS key
FROM (SELECT p_partkey AS id, {NORM.format(c=NAMES)} AS n FROM part)
""")
def q_coverage_key(read, spark):
    """F3, A11."""
    return _names(read).select("id", T.coverage_key("name").alias("key"))


@query(rf"""
WITH t AS (
  SELECT id, list_filter(string_split(n, ' '), lambda t: t <> '') AS w FROM (SELECT p_partkey AS id, {NORM.format(c=NAMES)} AS n FROM part)
)
SELECT id, array_to_string(list_sort(list_distinct(list_filter(w, lambda t: t NOT IN ('hd', '4k', 'live', 'tv')))), ' ') AS core,
       CASE WHEN length(array_to_string(w, '')) >= 4 THEN array_to_string(w, '') ELSE '' END AS compact
FROM t
""")
def q_tokens_core_key(read, spark):
    """Core token sets and compact forms."""
    t = T.tokens("name")
    return _names(read).select("id", T.core_key(t).alias("core"), T.compact(t).alias("compact"))


@query(rf"""
WITH a AS (SELECT p_partkey AS id, lower({NAMES}) AS n FROM part),
b AS (SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(n, '\(1080p\)', ' '), '\(canada\)', ' canada '), '\[[^\]]*\]', ' ', 'g'), '\b\d{{3,4}}[pi]\b', ' ', 'g'), '[|_/\\-]+', ' ', 'g'), '\s+', ' ', 'g')) AS n FROM a)
SELECT id, array_to_string(list_filter(string_split(n, ' '), lambda t: t NOT IN ('', 'hd', '4k', 'live', 'tv')), ' ') AS strict FROM b
""")
def q_norm_strict(read, spark):
    """quality goes, country words stay."""
    return _names(read).select("id", T.norm_strict("name").alias("strict"))


@query(rf"SELECT p_partkey AS id, CASE WHEN regexp_extract({NAMES}, '(?i)\b(\d{{3,4}})\s*[pi]\b', 1) <> '' THEN regexp_extract({NAMES}, '(?i)\b(\d{{3,4}})\s*[pi]\b', 1) || 'p' ELSE '' END AS quality FROM part")
def q_quality_of_name(read, spark):
    """F8."""
    return _names(read).select("id", T.quality_of_name("name").alias("quality"))


@query(f"SELECT page_id, {HOST} AS host, {PATH} AS path, {QUERY} AS query FROM pages")
def q_host_path(read, spark):
    """U1."""
    return read("pages").select("page_id", U.host_of("url").alias("host"), U.path_of("url").alias("path"), U.query_of("url").alias("query"))


@query("SELECT lower(regexp_replace(trim(url), '/+$', '')) AS key, count(*)::BIGINT AS n FROM pages GROUP BY 1")
def q_url_key(read, spark):
    """U13."""
    return read("pages").groupBy(U.url_key("url").alias("key")).agg(F.count("*").alias("n"))


@query(rf"""
SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || {HOST} ||
       CASE WHEN {PATH} IN ('', '/') THEN '/' ELSE regexp_replace({PATH}, '/$', '') END AS page FROM pages
""")
def q_norm_page_url(read, spark):
    """U11."""
    return read("pages").select("page_id", U.page_key("url").alias("page"))


@query(rf"""
SELECT page_id, CASE WHEN host LIKE '%github.com%' OR host LIKE '%githubusercontent%' THEN 'github' WHEN host LIKE '%akamai%' THEN 'akamai' WHEN host LIKE '%amagi%' THEN 'amagi' WHEN host LIKE '%b4u%' THEN 'b4u'
  WHEN len(x) >= 2 AND length(x[-2]) > 3 AND x[-2] NOT IN ('com', 'net', 'org', 'tv', 'in', 'io') THEN x[-2] ELSE 'other' END AS source
FROM (SELECT page_id, host, string_split(replace(host, 'www.', ''), '.') AS x FROM (SELECT page_id, {HOST} AS host FROM pages))
""")
def q_source_name(read, spark):
    """U14."""
    return read("pages").select("page_id", U.source_name("url").alias("source"))


@query(f"SELECT page_id, regexp_matches({HOST}, '(^|\\.)(example\\.org|example\\.net)$') AS blocked FROM pages")
def q_blocked_domain(read, spark):
    """U2 with a list of its own."""
    return read("pages").select("page_id", U.is_blocked_domain("url", ("example.org", "example.net")).alias("blocked"))


@query(rf"SELECT page_id, regexp_matches(lower({PATH}), '\.(html|pdf)$') AS non_media FROM pages")
def q_non_media(read, spark):
    """U3 with a list of its own."""
    return read("pages").select("page_id", U.is_non_media("url", ("html", "pdf")).alias("non_media"))


_EDGE = (
    "http://a.example/x.m3u8?token=test", "http://a.example/x.m3u8?token=1234", "http://a.example/x.m3u8?user=1234", "http://a.example/x.m3u8?sessionid=12",
    "http://a.example/x.m3u8?token=long-opaque-value&key=demo77", "http://a.example/x.m3u8?token=", "https://a.example/4241/f206abc/53373", "https://a.example/live/4241/f206abc/53373",
    "https://a.example/setup%2Eexe", "https://cdn.jsdelivr.net/gh/o/r/x.m3u8", "https://github.com/o/r/raw/main/x.m3u8", "https://github.com/o/r", "https://raw.githubusercontent.com/o/r/x.m3u8",
    "https://www.youtube.com/live/1", "https://a.example/deliver/now", "https://a.example/watch?v=1", "https://pastebin.com/abc", "ftp://a.example/live/x", "https://a.example/tv", "https://u:p@A.Example.:8080/Live/",
)
_URLS = "(VALUES " + ", ".join(f"('{u}')" for u in _EDGE) + ") AS x(url)"
_HINT = "regexp_matches(lower(url), '\\.m3u8|\\.m3u|\\.mpd|\\.flv|/live/|/hls/|/stream/|get\\.php|player_api|xmltv\\.php|output=m3u8|output=ts|\\?token=|auth_username|auth_password|device_mac|panel_api|stalker_portal|portal\\.php')"
_TOKEN = "regexp_matches(url, '[?&](token|key|user|sessionid)=(test|demo)[0-9]*(&|$)') OR regexp_matches(url, '[?&](token|key|sessionid)=[0-9]{1,4}(&|$)')"
_BARE = f"NOT regexp_matches({PATH}, '/(live|movie|series)/') AND regexp_matches({PATH}, '^/\\d{{3,}}/[0-9a-zA-Z]{{6,}}/\\d{{2,10}}/?$')"


@query(rf"""
SELECT url, ({_TOKEN}) AS placeholder, ({_BARE}) AS bare, regexp_matches({HOST}, '(^|\.)raw\.githubusercontent\.com$') OR ({HOST} = 'cdn.jsdelivr.net' AND {PATH} LIKE '/gh/%') OR ({HOST} = 'github.com' AND ({PATH} LIKE '%/raw/%' OR {PATH} LIKE '%/blob/%')) AS raw_file,
       regexp_matches(url, '^https?://') AND NOT (regexp_matches({HOST}, '(^|\.)youtube\.com$') OR regexp_matches(lower(url), '%2eexe$') OR ({_TOKEN}) OR ({_BARE})) AND
       ({_HINT} OR regexp_matches(lower({PATH} || '?' || {QUERY}), '(^|[/\-_.?=&%])(watch|live|stream|streams|player|players|channel|channels|play|tv|iptv|playlist|playlists|broadcast|hls|embed|video|videos|show|shows|episode|episodes|movie|movies)($|[/\-_.?=&%])') OR {HOST} = 'pastebin.com') AS worthy,
       CASE WHEN {_HINT} THEN 0 ELSE 1 END::BIGINT AS priority
FROM {_URLS}
""")
def q_probe_worthy(read, spark):
    """U4-U8 over edge cases."""
    u = spark.createDataFrame([(x,) for x in _EDGE], "url string")
    return u.select("url", U.is_placeholder_token("url").alias("placeholder"), U.is_bare_id("url").alias("bare"), U.is_raw_file("url").alias("raw_file"), U.is_probe_worthy("url").alias("worthy"), U.probe_priority("url").cast("long").alias("priority"))


@query(f"SELECT CASE WHEN {_HINT} THEN 0 ELSE 1 END::BIGINT AS priority, count(*)::BIGINT AS n FROM pages GROUP BY 1")
def q_probe_priority(read, spark):
    """U8, T2."""
    return read("pages").groupBy(U.probe_priority("url").cast("long").alias("priority")).agg(F.count("*").alias("n"))


@query("""
SELECT * FROM (VALUES ('https://www.bing.com/ck/a?u=a1aHR0cHM6Ly9hLmV4YW1wbGUveA', 'https://a.example/x', true), ('//duckduckgo.com/l/?uddg=https%3A%2F%2Fb.example%2Fy', 'https://b.example/y', true),
 ('https://www.google.com/search', 'https://www.google.com/search', false), ('https://youtu.be/x', 'https://youtu.be/x', false), ('mailto:x', 'mailto:x', false)) AS x(url, target, keep)
""")
def q_unwrap_result(read, spark):
    """U9, S20."""
    rows = ["https://www.bing.com/ck/a?u=a1aHR0cHM6Ly9hLmV4YW1wbGUveA", "//duckduckgo.com/l/?uddg=https%3A%2F%2Fb.example%2Fy", "https://www.google.com/search", "https://youtu.be/x", "mailto:x"]
    return spark.createDataFrame([(x,) for x in rows], "url string").select("url", U.unwrap_result("url").alias("target"), U.is_result("url").alias("keep"))


@query(rf"""
WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)(?:href|src)\s*=\s*["'']([^"'']+)["'']', 1)) AS raw FROM pages)
SELECT DISTINCT page_id, CASE WHEN regexp_matches(r, '^https?://') THEN r ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || r END AS link
FROM (SELECT page_id, url, replace(trim(raw), '&amp;', '&') AS r FROM l) WHERE regexp_matches(r, '^(https?://|/)')
""")
def q_page_links(read, spark):
    """Link targets, root-relative ones resolved."""
    return read("pages").select("page_id", F.explode(P.page_links("html", "url")).alias("link"))


@query(r"""
SELECT doc_id, len(list_distinct(list_filter(list_transform(regexp_extract_all(text, '(?i)((?:https?|rtsp|rtmps?|srt|udp|rtp|p2p|acestream|webrtc|wss?|mms|rist)://[^\s"''<>]+)', 1), lambda u: regexp_replace(u, '[.,;:!?)]+$', '')), lambda u: length(u) >= 8)))::BIGINT AS n,
       contains(substr(text, 1, 4000), '#EXTM3U') OR contains(substr(text, 1, 4000), '#EXTINF') AS playlist FROM documents
""")
def q_links_in_text(read, spark):
    """X4, X9."""
    return read("documents").select("doc_id", F.size(P.extract_links("text")).cast("long").alias("n"), P.is_playlist_body("text").alias("playlist"))


@query(r"""
SELECT page_id, contains(lower(html), '<mpd') OR contains(html, '#EXTM3U') AS m3u, contains(html, '#EXT-X-STREAM-INF') AS master FROM pages
""")
def q_sniff_format(read, spark):
    """X3, X9."""
    return read("pages").select("page_id", P.is_m3u("html").alias("m3u"), P.is_master("html").alias("master"))


@query(r"""
SELECT page_id, lower(regexp_extract(html, '<html[^>]*\blang="([^"]*)"', 1)) AS lang FROM pages
""")
def q_attr_map(read, spark):
    """Attributes of the first tag as a map."""
    attrs = P.parse_attrs(F.regexp_replace(F.regexp_extract("html", "<html([^>]*)>", 1), " ", ","))
    return read("pages").select("page_id", F.lower(F.coalesce(F.try_element_at(attrs, F.lit("lang")), F.lit(""))).alias("lang"))


_SCORE = ("parsed", "segs", "quality", "bw", "latency", "ua", "entries")


@query("""
WITH x AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag = 'R' AS parsed, (l_quantity::INT % 4) AS segs, CASE l_linenumber % 4 WHEN 0 THEN '1080p' WHEN 1 THEN '240p' WHEN 2 THEN '480p' ELSE '' END AS quality,
         (l_extendedprice * 100)::BIGINT AS bw, l_discount * 30000 AS latency, l_linestatus = 'F' AS ua, (l_partkey % 40)::INT AS entries FROM lineitem
)
SELECT l_orderkey AS k, l_linenumber::BIGINT AS n, l_partkey AS p, greatest(0, least(100, 20 + CASE WHEN parsed THEN 20 ELSE 0 END + CASE WHEN segs >= 2 THEN 15 WHEN segs = 1 THEN 8 ELSE 0 END
  + CASE WHEN quality = '1080p' THEN 20 WHEN quality = '480p' THEN 7 WHEN parsed THEN 8 ELSE 0 END
  + CASE WHEN bw > 0 THEN CASE WHEN bw >= 4000000 THEN 15 WHEN bw >= 2000000 THEN 11 WHEN bw >= 1000000 THEN 7 ELSE 4 END WHEN parsed THEN 8 ELSE 0 END
  + CASE WHEN latency > 0 THEN CASE WHEN latency < 300 THEN 10 WHEN latency < 800 THEN 7 WHEN latency < 2000 THEN 4 ELSE 1 END WHEN parsed THEN 6 ELSE 0 END
  + CASE WHEN entries > 0 THEN least(30, 5 + entries // 5 * 5) ELSE 0 END - CASE WHEN ua THEN 10 ELSE 0 END))::BIGINT AS score
FROM x
""")
def q_score_parts(read, spark):
    """X11, F14, D15."""
    n = F.col("l_linenumber") % 4
    x = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") == "R").alias("parsed"), (F.col("l_quantity").cast("int") % 4).alias("segs"), F.when(n == 0, "1080p").when(n == 1, "240p").when(n == 2, "480p").otherwise("").alias("quality"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("bw"), (F.col("l_discount") * 30000).alias("latency"), (F.col("l_linestatus") == "F").alias("ua"), (F.col("l_partkey") % 40).cast("int").alias("entries"))
    c = {k: F.col(v) for k, v in zip(("parsed", "segments_ok", "quality", "bandwidth", "latency_ms", "needs_ua", "entries"), _SCORE, strict=True)}
    return x.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("n"), F.col("l_partkey").alias("p"), S.score_parts(**c, verified=F.lit(False)).cast("long").alias("score"))


@query("""
SELECT l_orderkey AS k, l_linenumber::BIGINT AS n, l_partkey AS p, CASE WHEN l_linenumber = 1 AND (l_partkey % 1000) >= 200 THEN (l_partkey % 1000) || 'p'
  WHEN bw >= 6000000 THEN '1080p' WHEN bw >= 3500000 THEN '720p' WHEN bw >= 1800000 THEN '576p' WHEN bw >= 1000000 THEN '480p' WHEN bw >= 1 THEN '360p' ELSE '' END AS quality
FROM (SELECT *, round(l_extendedprice * 100)::BIGINT AS bw FROM lineitem)
""")
def q_quality_from_resolution(read, spark):
    """F9, F10."""
    res = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("1x"), F.col("l_partkey") % 1000)).otherwise("bad")
    return read("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("n"), F.col("l_partkey").alias("p"), S.quality_from_resolution(res, F.round(F.col("l_extendedprice") * 100).cast("long")).alias("quality"))


@query(r"""
WITH s AS (
  SELECT doc_id, regexp_matches(t, 'news')::INT + regexp_matches(t, 'abp')::INT AS a, regexp_matches(t, 'the')::INT + regexp_matches(t, 'tion ')::INT AS b, regexp_matches(t, ' la ')::INT + regexp_matches(t, ' les ')::INT AS c
  FROM (SELECT doc_id, lower(text) AS t FROM documents)
)
SELECT doc_id, CASE WHEN greatest(a, b, c) = 0 THEN 'Other' WHEN a = greatest(a, b, c) THEN 'News' WHEN b = greatest(a, b, c) THEN 'En' ELSE 'Fr' END AS category FROM s
""")
def q_category_classifier(read, spark):
    """Most matching patterns, the first of equals."""
    rules = (("News", ("news", "abp")), ("En", ("the", "tion ")), ("Fr", (" la ", " les ")))
    return read("documents").select("doc_id", S.category_of(F.col("text"), rules=rules).alias("category"))


_NAMED = ("Zee TV UK", "Star Plus", "haberturk tv", "cctv9hd", "Dominican Republic TV", "Republic TV", "zee-tv.m3u8", "Colorado News", "DDF NETWORK", "Discovery Channel (Russia)", "Mercy TV (US)", "Sex Education", "essex life", "18+ club", "geo-blocked X", "Show Trailer", "contest winners", "S01E02 pilot", "", "Mega TV")


@query("""
SELECT * FROM (VALUES ('Zee TV UK', true, true, false, true, false), ('Star Plus', true, false, false, true, false), ('haberturk tv', false, false, false, true, false), ('cctv9hd', false, false, false, true, false),
 ('Dominican Republic TV', false, false, false, true, false), ('Republic TV', true, false, false, true, false), ('zee-tv.m3u8', true, false, false, true, false), ('Colorado News', false, false, false, true, false),
 ('DDF NETWORK', false, false, false, true, false), ('Discovery Channel (Russia)', false, true, false, true, false), ('Mercy TV (US)', false, true, false, true, false), ('Sex Education', false, false, true, true, false),
 ('essex life', false, false, false, true, false), ('18+ club', false, false, true, false, false), ('geo-blocked X', false, false, false, true, true), ('Show Trailer', false, false, false, false, false),
 ('contest winners', false, false, false, true, false), ('S01E02 pilot', false, false, false, false, false), ('', false, false, false, true, false), ('Mega TV', false, false, false, true, false)) AS x(name, regional, foreign_name, nsfw, live, geo)
""")
def q_name_gates(read, spark):
    """U15-U17, U19, U20 over names with known answers."""
    n = spark.createDataFrame([(x,) for x in _NAMED], "name string")
    return n.select("name", G.is_regional("name").alias("regional"), G.is_foreign("name").alias("foreign_name"), G.is_nsfw("name").alias("nsfw"), G.is_live_candidate(F.lit("http://h.example/a/b"), "name").alias("live"), G.is_geo_blocked("name").alias("geo"))


@query("SELECT page_id, regexp_matches(lower(substr(html, 1, 8000)), 'just a moment|turnstile|g-recaptcha|attention required') OR html = '' AS challenge FROM pages")
def q_challenge(read, spark):
    """U18."""
    return read("pages").select("page_id", G.is_challenge("html", F.lit(503)).alias("challenge"))


@query("SELECT * FROM (VALUES ('eng;hin', 'Hindi'), ('eng', 'English'), ('tam;tel', 'Tamil'), ('xxx', NULL), ('', NULL), ('bod;eng', 'Bhojpuri')) AS x(codes, language)")
def q_primary_language(read, spark):
    """W9, A6, D13."""
    c = spark.createDataFrame([(x,) for x in ("eng;hin", "eng", "tam;tel", "xxx", "", "bod;eng")], "codes string")
    return c.select("codes", T.primary_language("codes").alias("language"))


@query("""
SELECT raw, languages, category, name FROM (VALUES ('All Indian Scheduled langauge, English, Hindi', 'English,Hindi', 'News', 'AAJ TAK'), ('Oriya,oriya, Gujrati', 'Odia,Gujarati', 'Entertainment', NULL), ('NA', '', '', 'X Y'), ('', '', 'Entertainment', NULL)) AS x(raw, languages, category, name)
""")
def q_list_fields(read, spark):
    """List cells."""
    rows = [("All Indian Scheduled langauge, English, Hindi", "News and Current Affairs", " AAJ   TAK"), ("Oriya,oriya, Gujrati", "Non-News and Current Affairs", "123"), ("NA", "Sports", "X Y"), ("", "non- news and current affairs", "A")]
    r = spark.createDataFrame(rows, "raw string, cat string, n string")
    return r.select("raw", F.array_join(T.list_languages("raw"), ",").alias("languages"), F.array_join(T.list_category("cat"), ",").alias("category"), T.clean_name("n").alias("name"))


@query("SELECT * FROM (VALUES ('&amp;a https', '&a'), ('https://www.google.com/url?q=https%3A%2F%2Fx.example%2Fa&x=1', 'https://x.example/a'), ('http://y.example/b\\u0026c=1', 'http://y.example/b&c=1'), ('http://z.example/c).', 'http://z.example/c')) AS x(link, target)")
def q_unwrap_link(read, spark):
    """Entities, redirects and escapes."""
    rows = ["&amp;a https", "https://www.google.com/url?q=https%3A%2F%2Fx.example%2Fa&x=1", "http://y.example/b\\u0026c=1", "http://z.example/c)."]
    return spark.createDataFrame([(x,) for x in rows], "link string").select("link", P.unwrap_link("link").alias("target"))


@query(rf"""
SELECT page_id, array_to_string(list_filter(string_split(trim(regexp_replace(lower({HOST} || ' ' || {PATH}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: length(t) >= 2 AND t NOT IN {K.URL_STOP}), ' ') AS tokens FROM pages
""")
def q_url_tokens(read, spark):
    """F5, F12."""
    return read("pages").select("page_id", F.array_join(U.url_tokens("url"), " ").alias("tokens"))


@query("""
SELECT * FROM (VALUES ('http://a.example/x/y.m3u8', 'seg1.ts', 'http://a.example/x/seg1.ts'), ('http://a.example/x/y.m3u8', '/r.ts?x=1', 'http://a.example/r.ts?x=1'), ('http://a.example/x/y.m3u8', '//cdn.example/z', 'http://cdn.example/z'),
 ('http://a.example/x/y/z', '../q.ts', 'http://a.example/x/q.ts'), ('http://a.example', 'q.ts', 'http://a.example/q.ts'), ('http://a.example/x', 'https://b.example/', 'https://b.example/'), ('http://a.example/x?y=1', '?z=2', 'http://a.example/x?z=2'), ('http://a.example/x/', './a/../b', 'http://a.example/x/b')) AS x(base, ref, url)
""")
def q_url_join(read, spark):
    """References resolved against a base."""
    rows = [("http://a.example/x/y.m3u8", "seg1.ts"), ("http://a.example/x/y.m3u8", "/r.ts?x=1"), ("http://a.example/x/y.m3u8", "//cdn.example/z"), ("http://a.example/x/y/z", "../q.ts"), ("http://a.example", "q.ts"), ("http://a.example/x", "https://b.example/"), ("http://a.example/x?y=1", "?z=2"), ("http://a.example/x/", "./a/../b")]
    return spark.createDataFrame(rows, "base string, ref string").select("base", "ref", U.joined("base", "ref").alias("url"))
