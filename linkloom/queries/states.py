"""Verdict state, breakers and throttles, streams and whole plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.config import Config
from linkloom.functions import parse as P
from linkloom.functions import score as S
from linkloom.operators import aggregate as A
from linkloom.operators import graph as Gr
from linkloom.operators import state as St
from linkloom.plans import pipeline as Pl
from linkloom.queries.base import NOW, VERDICTS, query, verdicts
from linkloom.sources.readers import playlists, responses

CFG = Config(now=NOW)
TTL = "CASE status WHEN 'ok' THEN 259200 WHEN 'blocked' THEN 86400 WHEN 'vod' THEN 2592000 ELSE 604800 END"


@query("SELECT event_type AS status, count(*)::BIGINT AS n FROM events GROUP BY 1")
def q_status_counts(read, spark):
    """A1."""
    return A.counts(read("events").withColumnRenamed("event_type", "status"), "status")


@query(f"WITH {VERDICTS} SELECT event_id, {NOW} - checked_at < {TTL} AS alive FROM v")
def q_ttl_alive(read, spark):
    """ST1."""
    return verdicts(read("events")).select("event_id", St.is_alive(F.col("status"), F.col("checked_at"), CFG).alias("alive"))


@query(f"WITH {VERDICTS} SELECT event_id FROM v WHERE {NOW} - checked_at < {TTL}")
def q_prune(read, spark):
    """ST5, K6."""
    return St.prune(verdicts(read("events")), CFG).select("event_id")


@query(f"WITH {VERDICTS} SELECT url, status, event_id FROM v QUALIFY row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, event_id DESC) = 1")
def q_latest_verdict(read, spark):
    """ST2, ST3, K5: the newest verdict of each URL."""
    return St.latest(verdicts(read("events")), "event_id").select("url", "status", "event_id")


@query(f"""
WITH {VERDICTS}, s AS (SELECT * FROM v WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, event_id DESC) = 1),
i AS (SELECT * FROM (SELECT * FROM v WHERE event_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, event_id DESC) = 1) WHERE {NOW} - checked_at < {TTL})
SELECT url, status, checked_at FROM (SELECT *, 1 AS n FROM s UNION ALL SELECT *, 0 FROM i) QUALIFY row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, n DESC) = 1
""")
def q_merge_import(read, spark):
    """ST4, S24, D4: live and strictly newer imports win and keep their time."""
    v = verdicts(read("events"))
    store, new = (St.latest(v.where(F.col("event_id") % 2 == k), "event_id") for k in (0, 1))
    return St.merge_import(store, new, CFG).select("url", "status", "checked_at")


@query(f"""
WITH {VERDICTS}, h AS (SELECT *, lag(status) OVER w AS ps, lag(checked_at) OVER w AS pt FROM v WINDOW w AS (PARTITION BY url ORDER BY checked_at, event_id))
SELECT event_id, ps AS prev_status, coalesce(status = 'dead' AND ps = 'dead' AND checked_at - pt >= 14400, false) AS second_strike FROM h
""")
def q_two_strikes(read, spark):
    """ST6, W10."""
    return St.strikes(verdicts(read("events")), CFG, "event_id").select("event_id", "prev_status", "second_strike")


@query(f"""
WITH {VERDICTS}, h AS (SELECT *, lag(status) OVER w AS ps, checked_at - lag(checked_at) OVER w AS age FROM v WINDOW w AS (PARTITION BY url ORDER BY checked_at, event_id))
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'drop_definitive' WHEN status = 'vod' AND ps = 'vod' AND age >= 14400 THEN 'drop_clip' WHEN status = 'ok' THEN 'keep_ok' WHEN status = 'blocked' THEN 'keep_blocked'
  WHEN ps = 'dead' AND age >= 14400 THEN 'drop_second' ELSE 'keep_first_failure' END AS action FROM h
""")
def q_recheck_outcome(read, spark):
    """ST7: the ordered outcome table."""
    h = St.strikes(verdicts(read("events")), CFG, "event_id")
    s = F.col("status")
    act = St.outcome(definitive=F.col("event_id") % 50 == 0, vod_inferred=s == "vod", ok=s == "ok", blocked=s == "blocked", prev_status=F.col("prev_status"), prev_age_s=F.col("checked_at") - F.col("prev_at"), cfg=CFG)
    return h.select("event_id", act.alias("action"))


@query(f"""
WITH {VERDICTS}, s AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, event_id DESC) = 1)
SELECT c_custkey AS k FROM customer LEFT JOIN s ON url = 'u' || c_custkey WHERE status IS NULL OR NOT ({NOW} - checked_at < {TTL}) OR status IN ('dead', 'vod') OR (status = 'ok' AND {NOW} - checked_at > 86400)
""")
def q_suspects(read, spark):
    """Stored rows to check again."""
    rows = read("customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("u"), "c_custkey").alias("url"))
    return St.suspects(rows, St.latest(verdicts(read("events")), "event_id"), CFG).select("k")


@query(f"WITH {VERDICTS} SELECT event_id FROM v WHERE status = 'dead' AND checked_at > {NOW} - 86400")
def q_recent_dead(read, spark):
    """ST8."""
    return St.recent_dead(verdicts(read("events")), CFG).select("event_id")


@query("""
WITH c AS (SELECT event_id, user_id, ts, (event_type = 'purchase')::INT AS hit FROM events),
i AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM c),
r AS (SELECT *, sum(1 - hit) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS misses FROM i)
SELECT event_id, misses::BIGINT AS misses, misses = 3 AND hit = 0 AS trips FROM r
""")
def q_breaker_trips(read, spark):
    """ST9, W11: runs of misses."""
    return St.breaker_runs(read("events"), "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", CFG).select("event_id", F.col("misses").cast("long").alias("misses"), "trips")


@query()
def q_breaker_exact(read, spark):
    """ST9: with the cooldown, in which calls are skipped."""
    e = read("events").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), "event_id", (F.col("event_type") == "purchase").alias("hit"))
    return St.breaker_exact(e, "user_id", "t", "event_id", "hit", Config(breaker_cooldown_s=86400.0))


@query("""
WITH c AS (SELECT event_id, user_id, floor(epoch(ts))::DOUBLE AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events)
SELECT event_id, max(t - 3600.0 * n) OVER (PARTITION BY user_id ORDER BY n) + 3600.0 * n AS slot FROM c
""")
def q_throttle_slots(read, spark):
    """ST10: starts an hour apart per key."""
    e = read("events").withColumn("t", F.unix_seconds(F.col("ts").cast("timestamp")).cast("double"))
    return St.throttled(e, "user_id", F.col("t"), ["ts", "event_id"], 3600.0).select("event_id", "slot")


@query("SELECT event_type AS engine, count(*)::BIGINT AS calls, sum((value > 50)::INT)::BIGINT AS hits, sum((NOT (value > 50))::INT)::BIGINT AS misses, round_even(100.0 * sum((value > 50)::INT)::DOUBLE / count(*), 1) AS hit_pct FROM events GROUP BY 1")
def q_engine_summary(read, spark):
    """A10."""
    return St.engine_summary(read("events").select(F.col("event_type").alias("engine"), (F.col("value") > 50).alias("hit")))


@query("SELECT user_id AS k, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 4")
def q_budget(read, spark):
    """ST11, ST13: the first few of each key."""
    return St.within_budget(read("events"), "user_id", ["ts", "event_id"], 4).select(F.col("user_id").alias("k"), "event_id")


@query("SELECT * FROM (VALUES ('a', 1), ('b', 1), ('c', 3), ('d', 0)) AS x(lang, exit_code)")
def q_exit_code(read, spark):
    """ST14."""
    rows = [("a", ["e"], 5, False), ("b", [], 0, False), ("c", [], 5, True), ("d", [], 5, False)]
    return St.exit_code(spark.createDataFrame(rows, "lang string, errors array<string>, urls_valid int, incomplete boolean")).select("lang", "exit_code")


HLS = [
    ("master", "#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=800000,RESOLUTION=640x360\n# note\n\nlow.m3u8\n#EXT-X-STREAM-INF:BANDWIDTH=4500000,CODECS=\"a,b\",RESOLUTION=1920x1080\nhigh.m3u8\n#EXT-X-STREAM-INF:RESOLUTION=1x1\nnone.m3u8"),
    ("live", "#EXTM3U\n#EXT-X-TARGETDURATION:6\n#EXT-X-MEDIA-SEQUENCE:77\n#EXTINF:6,\na.ts\n#EXTINF:6,\nb.ts"),
    ("ended", "#EXTM3U\n#EXT-X-TARGETDURATION:6\n#EXTINF:6,\na.ts\n#EXT-X-ENDLIST"),
    ("short", "#EXTM3U\n#EXT-X-TARGETDURATION:6\n#EXT-X-MEDIA-SEQUENCE:0\n#EXTINF:6,\na.ts"),
    ("event", "#EXTM3U\n#EXT-X-PLAYLIST-TYPE:EVENT\n#EXT-X-MEDIA-SEQUENCE:0\n#EXT-X-ENDLIST"),
]


@query("SELECT * FROM (VALUES ('master', 0::BIGINT, 800000::BIGINT, '640x360', 'low.m3u8'), ('master', 2, 4500000, '1920x1080', 'high.m3u8'), ('master', 4, 0, '1x1', 'none.m3u8')) AS x(doc, pos, bandwidth, resolution, uri)")
def q_hls_variants(read, spark):
    """Each STREAM-INF with the next line that is no comment."""
    d = spark.createDataFrame(HLS, "doc string, text string")
    return d.select("doc", F.explode(P.master_variants("text")).alias("v")).select("doc", F.col("v.pos").cast("long").alias("pos"), "v.bandwidth", "v.resolution", "v.uri")


@query("SELECT * FROM (VALUES ('master', false, false), ('live', false, false), ('ended', true, true), ('short', true, false), ('event', false, true)) AS x(doc, vod, told)")
def q_vod_heuristic(read, spark):
    """X10, A9."""
    d = spark.createDataFrame(HLS, "doc string, text string")
    return d.select("doc", S.looks_like_vod("text").alias("vod"), S.vod_is_told("text").alias("told"))


MPD = '<MPD><BaseURL>http://c.example/</BaseURL><Representation bandwidth="100" width="640" height="360"/><Representation bandwidth="900"><BaseURL>hi.mp4</BaseURL></Representation></MPD>'


@query("SELECT * FROM (VALUES (100::BIGINT, '640x360', 'http://c.example/'), (900, '', 'http://m.example/d/hi.mp4')) AS x(bandwidth, resolution, uri)")
def q_dash_variants(read, spark):
    """Representations with inner and outer base URLs."""
    d = spark.createDataFrame([(MPD,)], "t string")
    return d.select(F.explode(P.dash_variants("t", F.lit("http://m.example/d/x.mpd"))).alias("v")).select("v.bandwidth", "v.resolution", "v.uri")


LIST = "#EXTM3U\r\n#EXTINF:-1 tvg-id=\"a\" group-title=\"News, World\",Zee TV\r\nhttp://s.example/1.m3u8\r\n#EXTINF:-1,Two\r\n#EXTVLCOPT:x\r\nhttp://s.example/2.m3u8\r\n#EXTINF:-1 tvg-logo=\"l\",Three\r\nrtmp://s.example/3\r\n#EXTINF:-1,Again\r\nhttp://s.example/1.m3u8\r\n#EXTINF:-1,Sock\r\nwss://s.example/4"


@query("SELECT * FROM (VALUES ('http://s.example/1.m3u8', 'Again', NULL), ('rtmp://s.example/3', 'Three', 'l'), ('wss://s.example/4', 'Sock', NULL)) AS x(url, name, logo)")
def q_m3u_entries(read, spark):
    """An entry needs its URL on the next line; a URL given twice keeps its last info."""
    rows = playlists(spark.createDataFrame([(LIST,)], "doc string"))
    return rows.select("url", "name", F.try_element_at("attrs", F.lit("tvg-logo")).alias("logo"))


_PAD = "0" * 1100
_RESP = [
    ("http://a.example/live/m.m3u8", 200, HLS[0][1], ""), ("http://a.example/live/high.m3u8", 200, HLS[1][1], ""), ("http://a.example/live/a.ts", 200, _PAD, ""), ("http://a.example/live/b.ts", 200, _PAD, ""),
    ("http://a.example/live/clip.m3u8", 200, HLS[3][1], ""), ("http://a.example/live/gone.m3u8", 404, "", ""), ("http://a.example/live/wall.m3u8", 503, "", ""), ("http://a.example/page", 200, "<html>x</html>", "text/html"),
    ("http://a.example/x.m3u", 200, LIST, ""), ("http://s.example/1.m3u8", 200, HLS[1][1], ""), ("http://a.example/d.mpd", 200, MPD, ""), ("http://a.example/live/odd", 200, "hello", "text/plain"), ("http://a.example/v.mp4", 200, _PAD, "video/mp4"),
    ("http://a.example/live/lost.m3u8", 200, "#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1\nmissing.m3u8", ""), ("http://a.example/live/api", 200, '{"u": "http://q.example/live/z.m3u8"}', "application/json"),
]


@query("""
SELECT * FROM (VALUES ('http://a.example/live/m.m3u8', 'stream', 'hls_master', 100::BIGINT, 'variants=3 seg_ok=2'), ('http://a.example/live/clip.m3u8', 'dead', 'vod_clip', 0, 'finite vod clip, not live'), ('http://a.example/live/gone.m3u8', 'dead', '', 0, 'http404'),
 ('http://a.example/live/wall.m3u8', 'dead', '', 0, 'challenge'), ('http://a.example/page', 'page', 'html', 0, ''), ('http://a.example/x.m3u', 'playlist', 'playlist_m3u', 76, 'entries=3 sample_ok=1'), ('http://a.example/d.mpd', 'stream', 'dash', 58, ''),
 ('http://a.example/live/odd', 'dead', 'unclassified:text/plain', 0, ''), ('http://a.example/v.mp4', 'stream', 'direct', 74, ''), ('http://a.example/live/lost.m3u8', 'dead', 'hls_master', 0, 'variant_unreachable'), ('http://a.example/live/api', 'page', 'json', 0, ''),
 ('http://a.example/none', 'dead', '', 0, 'unreachable'), ('http://a.example/setup.exe', 'dead', '', 0, 'non_media_ext'), ('udp://x', 'dead', '', 0, 'blocked')) AS x(url, kind, detail, score, note)
""")
def q_decision_list(read, spark):
    """One answer of each kind."""
    rows = [(u, u, s, {"content-type": ct}, b.encode(), 100.0) for u, s, b, ct in _RESP]
    r = responses(spark.createDataFrame(rows, "url string, final_url string, status int, headers map<string,string>, body binary, latency_ms double"))
    own = [u for u, *_ in _RESP if u not in ("http://a.example/live/high.m3u8", "http://a.example/live/a.ts", "http://a.example/live/b.ts", "http://s.example/1.m3u8")]
    q = spark.createDataFrame([(u, False) for u in [*own, "http://a.example/none", "http://a.example/setup.exe", "udp://x"]], "url string, needs_ua boolean")
    out = Pl.classify(q, r, CFG)
    return out.select("url", "probe.kind", "probe.detail", F.col("probe.score").cast("long").alias("score"), "probe.note")


@query("SELECT * FROM (VALUES ('https://raw.githubusercontent.com/o/r/a.m3u8', 'http://cdn.example/x/hi.m3u8', 2::BIGINT), ('https://raw.githubusercontent.com/o/r/loop.m3u8', '', 2), ('http://cdn.example/y', 'http://cdn.example/y', 0)) AS x(url, resolved, hops)")
def q_resolve_chain(read, spark):
    """Manifests on raw-file hosts, followed; a cycle resolves to nothing."""
    raw = "https://raw.githubusercontent.com/o/r/"
    r = spark.createDataFrame([(raw + "a.m3u8", "#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1\nb.m3u8"), (raw + "b.m3u8", "#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1\nhttp://cdn.example/x/hi.m3u8"), (raw + "loop.m3u8", "#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1\nloop.m3u8")], "url string, text string")
    s = spark.createDataFrame([(raw + "a.m3u8",), (raw + "loop.m3u8",), ("http://cdn.example/y",)], "url string")
    return Gr.resolve_chain(s, r).select("url", "resolved", F.when(F.col("resolved") == "", 2).otherwise(F.col("hops")).cast("long").alias("hops"))


@query()
def q_state_stream(read, spark):
    """ST2, ST6 as a stream: each verdict with its predecessor, over all events available now."""
    import tempfile
    import uuid

    from linkloom.streaming.verdicts import strikes

    v = verdicts(read("events")).select("url", "status", "checked_at")
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    folder = f"{base}/linkloom-stream-{uuid.uuid4().hex}"
    v.write.parquet(f"{folder}/in")
    s = spark.readStream.schema("url string, status string, checked_at double").parquet(f"{folder}/in")
    q = strikes(s, CFG).writeStream.format("parquet").option("checkpointLocation", f"{folder}/at").option("path", f"{folder}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out")
