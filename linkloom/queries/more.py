"""Readers, parsers, gates and schedules over captured fixtures with known answers."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from linkloom.config import Config
from linkloom.functions import gates as G
from linkloom.functions import parse as P
from linkloom.functions import score as S
from linkloom.functions import text as T
from linkloom.functions import urls as U
from linkloom.operators import aggregate as A
from linkloom.operators import enrich as E
from linkloom.operators import match as M
from linkloom.operators import rank as R
from linkloom.operators import state as St
from linkloom.plans import pipeline as Pl
from linkloom.queries.base import query
from linkloom.queries.states import HLS, LIST
from linkloom.sources import readers as Rd
from linkloom.sources import sinks


@query("SELECT * FROM (VALUES ('list', true), ('master', false), ('live', false), ('plain', false)) AS x(doc, feed)")
def q_list_feed(read, spark):
    """Channel lists, not stream manifests."""
    d = spark.createDataFrame([("list", LIST), ("master", HLS[0][1]), ("live", HLS[1][1]), ("plain", "text")], "doc string, t string")
    return d.select("doc", P.is_list_feed("t").alias("feed"))


@query("SELECT * FROM (VALUES ('http://a.example/own.js', 0::BIGINT), ('http://a.example/p/b.js', 1), ('https://cdn.example/x.js', 2)) AS x(script, pos)")
def q_page_scripts(read, spark):
    """Scripts of the own site first."""
    page = '<script src="https://cdn.example/x.js"></script><script src="/own.js"></script><script async src="b.js"></script>'
    d = spark.createDataFrame([(page,)], "html string")
    return d.select(F.posexplode(P.script_sources("html", F.lit("http://a.example/p/q"))).alias("pos", "script")).select("script", F.col("pos").cast("long").alias("pos"))


@query("SELECT * FROM (VALUES ('/api/channels?x=1'), ('https://b.example/v2/live'), ('/stream/7')) AS x(endpoint)")
def q_script_endpoints(read, spark):
    """Endpoints named in a script."""
    js = "fetch('/api/channels?x=1');var u=\"https://b.example/v2/live\";go(`/stream/7`);x='/about'"
    return spark.createDataFrame([(js,)], "t string").select(F.explode(P.script_endpoints("t")).alias("endpoint"))


@query("SELECT 'c_missing' AS missing, count(*)::BIGINT AS rows, false AS ok FROM customer")
def q_validate_columns(read, spark):
    """Columns and row counts."""
    return Rd.check_columns(read("customer"), ["c_custkey", "c_missing"], 1)


@query("SELECT event_id, 1706659200.0 - floor(epoch(ts)) < 86400 AS fresh FROM events")
def q_fresh_lists(read, spark):
    """Time stamps younger than a day."""
    e = read("events").select("event_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("s"))
    return e.select("event_id", Rd.is_fresh("s", 1706659200.0).alias("fresh"))


@query("SELECT t, count(*)::BIGINT AS n FROM (SELECT 'probe' AS t FROM events UNION ALL SELECT 'channel' FROM customer) GROUP BY 1")
def q_state_lines(read, spark):
    """A tagged line per verdict and channel, read back."""
    v = read("events").select(F.concat(F.lit("u"), "user_id").alias("url"), F.col("event_type").alias("status"))
    c = read("customer").select(F.col("c_mktsegment").alias("lang"), F.col("c_name").alias("url"))
    return sinks.state_lines(v, c).select(F.get_json_object("value", "$.t").alias("t")).groupBy("t").agg(F.count("*").alias("n"))


@query("""
SELECT k, v FROM (SELECT o_custkey AS k, o_orderpriority AS v, epoch(o_orderdate) AS t, 0 AS n, o_orderkey AS o FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL SELECT o_custkey, o_orderpriority, epoch(o_orderdate), 1, o_orderkey FROM orders WHERE o_orderkey % 2 = 1)
QUALIFY row_number() OVER (PARTITION BY k ORDER BY o DESC) = 1
""")
def q_upsert(read, spark):
    """K5: the newer row of a key stays."""
    o = read("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v"), F.col("o_orderkey").alias("t"))
    return St.upsert(o.where("t % 2 = 0"), o.where("t % 2 = 1"), ["k"], "t").select("k", "v")


_PAGES = [("http://a.example/live/tv", 0, True), ("http://a.example/about", 1, False), ("http://a.example/epg", 0, False), ("http://a.example/watch/x.m3u8", 0, False), ("http://live.example/news", 1, False), ("http://a.example/play?id=1", 1, True)]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{u}', {p}::BIGINT, {str(w).lower()})" for u, p, w in _PAGES) + ") AS x(url, priority, player)")
def q_page_priority(read, spark):
    """Paths to visit first, and player pages."""
    d = spark.createDataFrame([(u,) for u, *_ in _PAGES], "url string")
    return d.select("url", U.page_priority("url").cast("long").alias("priority"), U.is_player_page("url").alias("player"))


@query("SELECT * FROM (VALUES ('a/test/x.m3u', true), ('a/Fixtures/x.m3u', true), ('latest/x.m3u', false), ('example/x', true)) AS x(path, fixture)")
def q_fixture_paths(read, spark):
    """U22, S17."""
    d = spark.createDataFrame([(x,) for x in ("a/test/x.m3u", "a/Fixtures/x.m3u", "latest/x.m3u", "example/x")], "path string")
    return d.select("path", U.is_fixture("path").alias("fixture"))


_STORED = [("http://a/x?token=test", "A", "placeholder"), ("https://raw.githubusercontent.com/o/x.m3u8", "B", "raw_file"), ("http://a.example/4241/f206abc/53373", "C", "bare_id"), ("http://a.example/vod/x.m3u8", "D", "non_live"), ("http://a.example/x.m3u8", "XXX night", "non_live"), ("http://a.example/y.m3u8", "Blue Film", "nsfw"), ("http://a.example/z.m3u8", "Good", None)]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{u}', {'NULL' if r is None else repr(r)})" for u, _, r in _STORED) + ") AS x(url, reason)")
def q_drop_reason(read, spark):
    """Why a stored row goes."""
    d = spark.createDataFrame([(u, n) for u, n, _ in _STORED], "url string, name string")
    return d.select("url", G.drop_reason(F.col("url"), F.col("name")).alias("reason"))


@query("SELECT * FROM (VALUES ('u1'), ('u3'), ('http://h/mega-tv/x.m3u8'), ('u5')) AS x(url)")
def q_admission_gate(read, spark):
    """Seven ordered gates over name and URL matches."""
    rows = [("Zee TV UK", "u1"), ("Mega TV (Paraguay)", "u2"), ("Mega TV", "u3"), ("Geo-blocked Thing", "u4"), ("", "http://h/mega-tv/x.m3u8"), ("", "http://h/zzz"), ("NHK World (Japan)", "u5")]
    names = spark.createDataFrame([("Mega TV",), ("NHK World Japan",)], "name string")
    return Pl.admit(spark.createDataFrame([(*r, "") for r in rows], "name string, url string, extinf string"), names, Config()).select("url")


@query("SELECT * FROM (VALUES ('http://s.example/1.m3u8', 'Again', 's.example'), ('wss://s.example/4', 'Sock', 's.example')) AS x(url, name, host)")
def q_accept_playlist(read, spark):
    """Entries of an accepted list that are not yet known."""
    resp = Rd.responses(spark.createDataFrame([("http://h/x.m3u", "", 200, {}, LIST.encode(), 1.0)], "url string, final_url string, status int, headers map<string,string>, body binary, latency_ms double"))
    c = Pl.classify(spark.createDataFrame([("http://h/x.m3u", False)], "url string, needs_ua boolean"), resp, Config())
    out = Pl.accept_playlists(c, spark.createDataFrame([("rtmp://s.example/3",)], "url string"))
    return out.select("url", "name", U.host_of("url").alias("host"))


@query("""SELECT * FROM (VALUES ('"Zee TV" m3u8', 'Zee TV'), ('aaj tak iptv', 'aaj tak'), ('"A" "B" live', 'A|B|A" "B" live'), ('', '')) AS x(query, names)""")
def q_query_names(read, spark):
    """Names that a query names."""
    d = spark.createDataFrame([(x,) for x in ('"Zee TV" m3u8', "aaj tak iptv", '"A" "B" live', "")], "query string")
    return d.select("query", F.array_join(M.query_names(F.col("query")), "|").alias("names"))


@query("SELECT * FROM (VALUES ('http://a.example/p', 'http://a.example/live/x.m3u8'), ('http://b.example/p', 'https://p.example/e')) AS x(url, link)")
def q_mined_links(read, spark):
    """Stream links of a page, else its embedded players."""
    rows = [("http://a.example/p", "<a href='x'> 'live/x.m3u8' \"/live/x.m3u8\" https://youtu.be/y.m3u8".replace("'live/x.m3u8' ", "")), ("http://b.example/p", '<iframe src="https://p.example/e"></iframe>')]
    return Pl.mined_links(spark.createDataFrame(rows, "url string, html string"), Config())


@query("SELECT 'high.m3u8' AS uri, 4500000::BIGINT AS bandwidth")
def q_best_variant(read, spark):
    """T4: most bandwidth, the first of equals."""
    d = spark.createDataFrame([(HLS[0][1],)], "t string").select(P.best_variant(P.master_variants("t")).alias("v"))
    return d.select("v.uri", "v.bandwidth")


@query("SELECT * FROM (VALUES ('http://b/x/1.ts'), ('http://b/x/init.mp4'), ('http://c/2.ts'), ('http://b/3.ts')) AS x(segment)")
def q_media_segments(read, spark):
    """Four segments and init maps, resolved."""
    doc = '#EXTM3U\n#EXT-X-MAP:URI="init.mp4"\n#EXTINF:4,\n1.ts\n#EXTINF:4,\n//c/2.ts\n/3.ts\n4.ts'
    return spark.createDataFrame([(doc,)], "t string").select(F.explode(P.media_segments("t", F.lit("http://b/x/y.m3u8"))).alias("segment"))


_MAGIC = [("mp4", "00000018667479706d703432", True, True), ("webm", "1A45DFA3", True, True), ("wav", "524946460000000057415645", True, True), ("ogg", "4F676753", True, True), ("id3", "494433", True, True), ("mpeg", "FFFB", True, True), ("exe", "4D5A", False, False)]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', {str(a).lower()}, {str(b).lower()})" for n, _, a, b in _MAGIC) + ", ('ts', true, false)) AS x(name, media, finished)")
def q_media_magic(read, spark):
    """Magic bytes."""
    ts = bytearray(400)
    ts[0] = ts[188] = 0x47
    rows = [(n, bytes.fromhex(h).ljust(80, b"\0")) for n, h, *_ in _MAGIC] + [("ts", bytes(ts))]
    d = spark.createDataFrame(rows, "name string, b binary")
    return d.select("name", S.looks_media(F.col("b")).alias("media"), S.is_finished_file(F.col("b")).alias("finished"))


@query("""SELECT * FROM (VALUES ('Zee', 10::BIGINT, '"Zee" m3u8', 'Zee jio m3u8'), ('Star', 15, '"Star" m3u8', 'Star jio m3u8')) AS x(channel, n, first, last)""")
def q_channel_queries(read, spark):
    """The queries of a channel in order."""
    c = spark.createDataFrame([("Zee", "", "", ""), ("Star", "https://www.star.example/x", "S1;", "Net")], "name string, website string, alt_names string, network string")
    q = R.channel_queries(c, ["jio"])
    return q.select("channel", F.size("queries").cast("long").alias("n"), F.element_at("queries", 1).alias("first"), F.element_at("queries", -1).alias("last"))


@query("SELECT p_brand AS grp, string_agg(p_name, '|' ORDER BY p_name) AS missing FROM (SELECT * FROM (SELECT DISTINCT p_brand, p_name FROM part) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_name) <= 15) GROUP BY 1")
def q_missing_names(read, spark):
    """The first missing names of a group."""
    m = read("part").select(F.col("p_brand").alias("grp"), F.col("p_name").alias("name"), F.lit(False).alias("found")).distinct()
    return M.missing_names(m, "grp", "name", 15).select("grp", F.array_join("missing", "|").alias("missing"))


@query("SELECT DISTINCT p_name AS name, replace(p_name, ' ', '') AS compact FROM part")
def q_match_index(read, spark):
    """Distinct names with their keys."""
    c = read("part").select(F.upper("p_name").alias("name"), F.col("p_name").alias("canonical_name"), F.concat(F.lit(" "), "p_name", F.lit(";")).alias("alt_names"))
    return Rd.match_index(c).select("name", "compact")


@query("SELECT * FROM (VALUES ('a', 'English,Hindi,Tamil'), ('b', 'Urdu')) AS x(channel, languages)")
def q_all_languages(read, spark):
    """All languages of a channel's feeds."""
    f = spark.createDataFrame([("a", "tam;eng"), ("a", "hin;eng;zzz"), ("b", "urd"), ("c", "zzz")], "channel string, languages string")
    return A.all_languages(f).select("channel", F.array_join("languages", ",").alias("languages"))


@query("SELECT 'n' || n_nationkey || '.in' AS key, n_name AS value FROM nation UNION ALL SELECT 'n' || n_nationkey, n_name FROM nation UNION ALL SELECT lower(n_name), n_name FROM nation")
def q_id_maps(read, spark):
    """Long and short ids and names to a value."""
    c = read("nation").select(F.concat(F.lit("n"), "n_nationkey", F.lit(".in")).alias("id"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("_ord"))
    return A.id_maps(c, c.select("id", F.col("name").alias("v")), "v")


@query("SELECT * FROM (VALUES ('p', 'N', 'hi', 'i'), ('q', 'M', '', '')) AS x(path, name, lang_code, logo)")
def q_catalog(read, spark):
    """Entries at any depth of a catalogue, the first of each path."""
    j = json.dumps({"a": [{"detailPagePath": "p", "channelName": "N", "langCode": "hi", "icon": "i", "x": {"detailPagePath": "q", "channelName": "M"}}, {"channelName": "no path"}]})
    return Rd.catalog(spark.createDataFrame([(j,)], "json string"))


@query("""
WITH u AS (SELECT 'p' || p_partkey AS path, i, CASE WHEN (i + p_partkey) % 2 = 0 THEN 'http://h/' ELSE 'udp://' END || i || '/' || p_partkey AS url
           FROM (SELECT p_partkey, p_size, unnest(range(0, p_size % 7 + 1)) AS i FROM part WHERE p_size % 3 <> 0))
SELECT path, url, (row_number() OVER (PARTITION BY path ORDER BY i) - 1)::BIGINT AS place FROM u WHERE url LIKE 'http%' QUALIFY place < 2
""")
def q_stream_urls(read, spark):
    """Two stream URLs of each entry; none where access is denied."""
    p = read("part").select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") % 3 == 0, False).otherwise(True).alias("ok"), F.transform(F.sequence(F.lit(0), F.col("p_size") % 7), lambda i: F.struct(F.concat(F.when((i + F.col("p_partkey")) % 2 == 0, "http://h/").otherwise("udp://"), i.cast("string"), F.lit("/"), F.col("p_partkey").cast("string")).alias("url"))).alias("streams"))
    answer = F.to_json(F.struct(F.struct(F.struct(F.col("ok").alias("hasAccess")).alias("streamStatus"), "streams").alias("response")))
    return Rd.stream_urls(p.select(F.concat(F.lit("p"), "k").alias("path"), answer.alias("json"))).select("path", "url", F.col("place").cast("long").alias("place"))


@query("SELECT * FROM (VALUES ('c2 &', 'c6 &', 'c9 &')) AS x(name, category_raw, remarks)")
def q_html_table(read, spark):
    """Rows of a table of a page."""
    tr = "<tr>" + "".join(f"<td>c{i} &amp;</td>" for i in range(10)) + "</tr>"
    d = spark.createDataFrame([(f"<table><tr><td>x</td></tr></table><table id='satellite'><tr><th>h</th></tr>{tr}</table>",)], "html string")
    return Rd.satellite_rows(d).select("name", "category_raw", "remarks")


@query("SELECT c_mktsegment AS seg, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS category FROM customer GROUP BY 1")
def q_first_category(read, spark):
    """The first of a list, in title case."""
    return read("customer").select(F.col("c_mktsegment").alias("seg")).distinct().select("seg", T.first_category(F.concat(F.lit(" "), "seg", F.lit(";other"))).alias("category"))


@query("SELECT * FROM (VALUES ('A', 'Hindi', 'used2', 'News'), ('B', NULL, NULL, '')) AS x(name, language, logo, category)")
def q_metadata(read, spark):
    """What the database knows of a channel."""
    c = spark.createDataFrame([("a", "A", "news;x", "", "", 0), ("b", "B", "", "", "", 1)], "id string, name string, categories string, network string, website string, _ord long")
    f = spark.createDataFrame([("a", "FALSE", "tam", 0), ("a", "TRUE", "eng;hin", 1)], "channel string, is_main string, languages string, _ord long")
    lg = spark.createDataFrame([("a", "big", "900", "900", "FALSE", 0), ("a", "used", "bad", "10", "TRUE", 1), ("a", "used2", "5", "10", "TRUE", 2)], "channel string, url string, width string, height string, in_use string, _ord long")
    m = E.metadata(c, f, lg)
    return m.select(F.col("canonical_name").alias("name"), F.col("db_language").alias("language"), F.col("db_logo").alias("logo"), F.col("db_category").alias("category"))


@query("SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 0")
def q_drop_split(read, spark):
    """Rows that stay when others go with a reason."""
    c = read("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("url"))
    keep, _ = St.drop_keys(c, F.when(F.col("k") % 3 == 0, "three").when(F.col("k") % 5 == 0, "five"))
    return keep.select("k")


@query("SELECT CASE WHEN c_custkey % 3 = 0 THEN 'three' ELSE 'five' END AS reason, count(*)::BIGINT AS n FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0 GROUP BY 1")
def q_drop_counts(read, spark):
    """Reasons of what goes."""
    c = read("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("url"))
    _, gone = St.drop_keys(c, F.when(F.col("k") % 3 == 0, "three").when(F.col("k") % 5 == 0, "five"))
    return gone.groupBy("reason").agg(F.count("*").alias("n"))


@query("""
WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN lower(n_name) ELSE lower(n_name) || ' plus' END AS name FROM customer JOIN nation ON c_nationkey = n_nationkey),
ch AS (SELECT 'n' || n_nationkey AS id, lower(n_name) AS r FROM nation)
SELECT k, id AS channel_id FROM c, ch WHERE r = name UNION ALL
SELECT k, id FROM c, ch WHERE NOT EXISTS (SELECT 1 FROM ch x WHERE x.r = name) AND (contains(r, name) OR contains(name, r))
""")
def q_channel_ids(read, spark):
    """The exact id alone, else all by containment."""
    c = read("customer").join(F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    q = c.select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 == 0, F.col("n_name")).otherwise(F.concat("n_name", F.lit(" Plus"))).alias("name"))
    ch = read("nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("").alias("alt_names"), F.col("n_nationkey").alias("_ord"))
    return M.channel_ids(q, ch).select("k", "channel_id")


@query("SELECT event_type, CAST(date_trunc('day', ts) AS DATE)::VARCHAR AS day, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def q_daily_windows(read, spark):
    """ST2 extension: tumbling windows, the batch side of the stream."""
    e = read("events").select("event_type", F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"))
    return e.groupBy("event_type", F.date_format("w.start", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query("""SELECT * FROM (VALUES ('"Zee TV" m3u8'), ('mega tv iptv'), ('"x" hindi stream')) AS x(query)""")
def q_proven_queries(read, spark):
    """Queries that themselves name a channel."""
    q = spark.createDataFrame([(x,) for x in ('"Zee TV" m3u8', "mega tv iptv", '"x" hindi stream', "cooking news m3u8", "")], "query string")
    return Pl.proven_queries(q, spark.createDataFrame([("Mega TV HD",)], "name string"), Config())


@query("SELECT * FROM (VALUES ('http://a', 'N'), ('http://b', 'N')) AS x(url, name)")
def q_catalog_candidates(read, spark):
    """Two unseen stream URLs of each entry."""
    cat = spark.createDataFrame([("p", "N", "hi", ""), ("q", "M", "hi", "")], "path string, name string, lang_code string, logo string")
    st = spark.createDataFrame([("p", "http://a", 0), ("p", "http://b", 1), ("p", "http://c", 2), ("q", "http://seen", 0)], "path string, url string, place int")
    return Pl.catalog_candidates(cat, st, spark.createDataFrame([("http://seen",)], "url string")).select("url", "name")


@query("SELECT * FROM (VALUES ('http://s.example/watch', 0::BIGINT, 'page'), ('http://s.example/live/a.m3u8', 1, 'stream'), ('http://s.example/live/none.m3u8', 1, 'dead')) AS x(url, depth, kind)")
def q_validate_levels(read, spark):
    """Seeds, then what their pages lead to."""
    page = '<html><a href="/live/a.m3u8"> "/live/a.m3u8" "/live/none.m3u8"</html>'
    rows = [("http://s.example/watch", page, "text/html"), ("http://s.example/live/a.m3u8", HLS[1][1], "")]
    r = Rd.responses(spark.createDataFrame([(u, "", 200, {"content-type": c}, b.encode(), 9.0) for u, b, c in rows], "url string, final_url string, status int, headers map<string,string>, body binary, latency_ms double"))
    out = Pl.validate(spark.createDataFrame([("http://s.example/watch",)], "url string"), r, Config())
    return out.select("url", F.col("depth").cast("long").alias("depth"), "probe.kind")


@query("SELECT 'u' || user_id AS url FROM events WHERE event_type = 'error' AND 1706659200.0 - floor(epoch(ts)) < 604800 UNION SELECT c_name FROM customer WHERE c_acctbal < 0")
def q_shared_dead(read, spark):
    """Listed dead URLs and live dead verdicts."""
    from linkloom.queries.base import NOW, verdicts

    listed = read("customer").where("c_acctbal < 0").select(F.col("c_name").alias("url"))
    return St.shared_dead(verdicts(read("events")), listed, Config(now=NOW))


@query("SELECT c_mktsegment AS lang, c_name AS url FROM customer WHERE c_mktsegment = 'BUILDING'")
def q_stored_channels(read, spark):
    """Stored rows of one language."""
    c = read("customer").select(F.col("c_mktsegment").alias("lang"), F.col("c_name").alias("url"), F.col("c_custkey").alias("updated_at"))
    return St.stored_channels(St.clear_language(c, "MACHINERY"), "BUILDING").select("lang", "url")


@query("SELECT o_orderkey AS k, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END, o_orderkey)::BIGINT AS place FROM orders QUALIFY place <= 50")
def q_probe_queue(read, spark):
    """Direct links first, then in order of URL; 50 of them."""
    from pyspark.sql import Window

    o = read("orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("http://h.example/"), F.when(F.col("o_orderkey") % 4 == 0, "live/").otherwise("a/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("url"))
    top = R.probe_order(o, "url", 50)
    return top.select("k", F.row_number().over(Window.orderBy(U.probe_priority("url"), "url")).cast("long").alias("place"))
