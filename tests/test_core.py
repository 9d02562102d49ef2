"""Readers, writers, gates, state and streams on small fixtures."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.config import Config
from linkloom.functions import gates as G
from linkloom.functions import parse as P
from linkloom.functions import text as T
from linkloom.functions import urls as U
from linkloom.operators import aggregate as A
from linkloom.operators import match as M
from linkloom.operators import rank as R
from linkloom.operators import state as St
from linkloom.plans import pipeline as Pl
from linkloom.sources import readers as Rd
from linkloom.sources import sinks

CHANNEL = "_ord long, name string, url string, language string, category string, source string, logo string, extinf string, tvg_id string, group_title string, score int, quality string"


def channels(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], CHANNEL)


def row(name, url, score=10, quality="", category="", language="", source="s", logo=""):
    return (name, url, language, category, source, logo, "", "", "", score, quality)


def test_best_per_channel_keeps_first_place_and_first_of_equals(spark):
    c = channels(spark, row("a", "http://h/x"), row("b", "http://h/y"), row("c", "HTTP://H/X/", 20), row("d", ""), row("e", "http://h/y/"))
    got = R.best_per_channel(c).orderBy("_ord").select("_ord", "name").collect()
    assert [tuple(r) for r in got] == [(0, "c"), (1, "b")]


def test_cap_per_name_prefers_tiers_and_keeps_unnamed(spark):
    q = ["1080p", "1080p", "720p", "480p", "240p", "", "720p"]
    c = channels(spark, *[row("Zee (x)", f"http://h/{i}", 100 - i, x) for i, x in enumerate(q)], *[row("", f"http://u/{i}") for i in range(7)])
    got = [r["url"] for r in R.cap_per_name(c, 5).collect()]
    assert {u for u in got if "/h/" in u} == {f"http://h/{i}" for i in (0, 2, 3, 4, 5)}
    assert sum("/u/" in u for u in got) == 7


def test_m3u_round_trip_and_publish(spark, tmp_path):
    c = channels(spark, row("Zee, Two", "http://h/1", 5, category="News", language="Hindi", logo="l"), row("Abc", "http://h/2", 9, category="News"), row('A "q"', "http://h/3", 9, category="Kids", source=""))
    sinks.write_m3u(c, str(tmp_path / "m"))
    text = "".join(p.read_text() for p in (tmp_path / "m").glob("part*"))
    lines = text.strip().split("\n")
    assert lines[0] == K.M3U_HEADER
    assert [x for x in lines if x.startswith("http")] == ["http://h/3", "http://h/2", "http://h/1"]
    back = {r["url"]: r["name"] for r in Rd.read_m3u(spark, str(tmp_path / "m")).collect()}
    assert back == {"http://h/1": "Zee, Two", "http://h/2": "Abc", "http://h/3": 'A "q"'}
    sinks.publish(c, str(tmp_path / "p"))
    parts = lambda sub: sorted(p.name for p in (tmp_path / "p" / sub).iterdir() if p.is_dir())
    assert parts("language") == ["language=hindi", "language=other"] and parts("source") == ["source=other", "source=s"]
    sinks.publish(c.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_state_round_trip(spark, tmp_path):
    v = spark.createDataFrame([("u1", "ok", "stream", 50, "d", 5.0)], "url string, status string, kind string, score int, detail string, checked_at double")
    c = spark.createDataFrame([("Hindi", "u2", "n", 7)], "lang string, url string, name string, score int")
    sinks.state_lines(v, c).coalesce(1).write.text(str(tmp_path / "s"))
    (tmp_path / "in").mkdir()
    text = "".join(p.read_text() for p in (tmp_path / "s").glob("part*")) + json.dumps({"url": "u3", "status": "dead", "checked_at": 1.0}) + "\n"
    (tmp_path / "in" / "a.jsonl").write_text(text)
    (tmp_path / "in" / "b.txt").write_text("http://dead.example/x\nnote\n")
    verdicts, chans = Rd.state_lines(spark, str(tmp_path / "in"))
    assert {r["url"] for r in verdicts.collect()} == {"u1", "u3"} and [r["name"] for r in chans.collect()] == ["n"]
    assert [r["url"] for r in Rd.dead_urls(spark, str(tmp_path / "in")).collect()] == ["http://dead.example/x"]


def test_csv_database(spark, tmp_path):
    (tmp_path / "channels.csv").write_text("id,name,alt_names,network,owners,country,categories,is_nsfw,launched,closed,website\nA.in,Zee TV,Zee;Z,,,IN,news;xxx,FALSE,,,\nB.us,Other,,,,US,,FALSE,,,\nC.in,\"Quo, ted\",,,,IN,kids's,TRUE,,,http://c\n")
    (tmp_path / "feeds.csv").write_text("channel,id,name,is_main,broadcast_area,timezones,languages,format\nA.in,1,x,FALSE,,,tam,\nA.in,2,y,TRUE,,,eng;hin,\n")
    (tmp_path / "logos.csv").write_text("channel,url,width,height,format,in_use\nA.in,big,900,900,,FALSE\nA.in,used,bad,10,,TRUE\nA.in,used2,5,10,,TRUE\n")
    db = Rd.database(spark, str(tmp_path))
    assert {r["id"] for r in db["channels"].collect()} == {"A.in", "C.in"} and db["blocklist"].count() == 0
    assert {r["id"] for r in Rd.blocklist(db["channels"], db["blocklist"]).collect()} == {"A.in", "C.in"}
    from linkloom.operators.enrich import metadata

    m = {r["id"]: r for r in metadata(db["channels"], db["feeds"], db["logos"]).collect()}
    assert (m["A.in"]["db_language"], m["A.in"]["db_logo"], m["A.in"]["db_category"]) == ("Hindi", "used2", "News")
    assert A.all_languages(db["feeds"]).first()["languages"] == ["English", "Hindi", "Tamil"]


def test_html_tables_and_catalogues(spark):
    tr = "<tr>" + "".join(f"<td>c{i} &amp;</td>" for i in range(10)) + "</tr>"
    page = f"<table><tr><td>1</td><td>n</td><td>e</td></tr></table><table id='satellite'><tr><th>x</th></tr>{tr}</table>"
    d = spark.createDataFrame([(page,)], "html string")
    assert Rd.satellite_rows(d).first()["name"] == "c2 &"
    assert [tuple(r) for r in Rd.platform_rows(d).collect()] == [(1, "n", "e")]
    j = json.dumps({"a": [{"detailPagePath": "p", "channelName": "N", "langCode": "hi", "icon": "i", "x": {"detailPagePath": "q", "channelName": "M"}}]})
    assert [tuple(r) for r in Rd.catalog(spark.createDataFrame([(j,)], "json string"), lang_code="hi").collect()] == [("p", "N", "hi", "i")]
    s = spark.createDataFrame([("p", '{"response":{"streams":[{"url":"http://a"},{"url":"x"},{"url":"http://b"},{"url":"http://c"}]}}'), ("q", '{"response":{"streamStatus":{"hasAccess":false},"streams":[{"url":"http://c"}]}}')], "path string, json string")
    assert sorted(tuple(r) for r in Rd.stream_urls(s).collect()) == [("p", "http://a", 0), ("p", "http://b", 1)]


def test_data_source(spark):
    from linkloom.sources import datasource as D

    D.register(spark, {"one": lambda lang: [{"url": "http://a", "name": lang}, {"name": "no url"}]})
    got = spark.read.format("candidates").option("sources", "one").option("language", "Hindi").load().collect()
    assert [(r["url"], r["name"], r["source"]) for r in got] == [("http://a", "Hindi", "one")]


def test_admission_gate(spark):
    rows = spark.createDataFrame([("Zee TV UK", "u1", ""), ("Mega TV (Paraguay)", "u2", ""), ("Mega TV", "u3", ""), ("Geo-blocked Thing", "u4", ""), ("", "http://h/mega-tv/x.m3u8", ""), ("", "http://h/zzz", ""), ("NHK World (Japan)", "u5", "")], "name string, url string, extinf string")
    names = spark.createDataFrame([("Mega TV",), ("NHK World Japan",)], "name string")
    got = {(r["name"], r["url"]) for r in Pl.admit(rows, names, Config()).collect()}
    assert got == {("Zee TV UK", "u1"), ("Mega TV", "u3"), ("", "http://h/mega-tv/x.m3u8"), ("NHK World (Japan)", "u5")}


def test_accept(spark):
    from linkloom.queries.states import LIST

    resp = Rd.responses(spark.createDataFrame([("http://h/x.m3u", "", 200, {}, LIST.encode(), 1.0)], "url string, final_url string, status int, headers map<string,string>, body binary, latency_ms double"))
    c = Pl.classify(spark.createDataFrame([("http://h/x.m3u", False)], "url string, needs_ua boolean"), resp, Config())
    seen = spark.createDataFrame([("rtmp://s.example/3",)], "url string")
    got = {r["url"]: r["name"] for r in Pl.accept_playlists(c, seen).collect()}
    assert got == {"http://s.example/1.m3u8": "Again", "wss://s.example/4": "Sock"}


@pytest.mark.parametrize(("gap", "strike"), [(4 * 3600 - 1, False), (4 * 3600, True)])
def test_two_strikes_at_the_gap(spark, gap, strike):
    h = spark.createDataFrame([("u", "dead", 0.0), ("u", "dead", float(gap))], "url string, status string, checked_at double")
    assert [r["second_strike"] for r in St.strikes(h, Config()).orderBy("checked_at").collect()] == [False, strike]


def test_ttl_just_inside_and_outside(spark):
    cfg = Config(now=1e9)
    v = [(s, 1e9 - t + d) for s, t in (("ok", cfg.ttl_ok_s), ("dead", cfg.ttl_dead_s), ("blocked", cfg.ttl_blocked_s), ("vod", cfg.ttl_vod_s)) for d in (0, 1)]
    got = spark.createDataFrame(v, "status string, checked_at double").select(St.is_alive(F.col("status"), F.col("checked_at"), cfg).alias("a")).collect()
    assert [r["a"] for r in got] == [False, True] * 4


def test_breaker_skips_calls_in_cooldown(spark):
    calls = spark.createDataFrame([("e", float(t), i, h) for i, (t, h) in enumerate([(0, False), (1, False), (2, False), (3, True), (400, False), (401, True)])], "k string, t double, o long, hit boolean")
    got = St.breaker_exact(calls, "k", "t", "o", "hit", Config()).orderBy("o").collect()
    assert [(r["skipped"], r["misses"]) for r in got] == [(False, 1), (False, 2), (False, 0), (True, 0), (False, 1), (False, 0)]


def test_stream_equals_batch(spark, tmp_path):
    from linkloom.streaming.verdicts import closed_windows, store_writer, strikes

    rows = [("u", "dead", 0.0), ("v", "ok", 5.0), ("u", "dead", 20000.0), ("u", "ok", 30000.0)]
    df = spark.createDataFrame(rows, "url string, status string, checked_at double")
    df.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = strikes(s, Config()).writeStream.format("memory").queryName("strikes").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    batch = St.strikes(df, Config()).select("url", "checked_at", "second_strike")
    assert sorted(map(tuple, spark.table("strikes").select("url", "checked_at", "second_strike").collect())) == sorted(map(tuple, batch.collect()))
    q = s.writeStream.foreachBatch(store_writer(str(tmp_path / "store"), spark)).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = sorted((tmp_path / "store").iterdir())[-1]
    assert sorted(map(tuple, spark.read.parquet(str(last)).collect())) == [("u", "ok", 30000.0), ("v", "ok", 5.0)]
    assert "TimeWindow" not in closed_windows(df.select(F.timestamp_seconds("checked_at").alias("ts"), "status"), "ts", "status").columns


def test_harvest_and_embeds(spark):
    page = """<a href="/live/x.m3u8">a</a> file: "rel/y.m3u8" <iframe src="//p.example/e?a=1&amp;b=2"></iframe> https://z.example/data.json https://z.example/iptv.json udp://1.1.1.1:5 https://youtu.be/x.m3u8"""
    got = spark.createDataFrame([(page,)], "t string").select(P.harvest_links("t", F.lit("http://b.example/d/p")).alias("h"), P.extract_embeds("t", F.lit("http://b.example/d/p")).alias("e")).first()
    assert got["h"] == ["http://b.example/d/rel/y.m3u8", "http://b.example/live/x.m3u8", "https://z.example/iptv.json", "udp://1.1.1.1:5"]
    assert got["e"] == ["http://p.example/e?a=1&b=2", "http://b.example/d/rel/y.m3u8"]


def test_config_from_env(monkeypatch):
    monkeypatch.setenv("LINKLOOM_NAME_URL_CAP", "7")
    monkeypatch.setenv("LINKLOOM_SAFE_ATTRIBUTES", "true")
    cfg = Config.from_env(now=5.0)
    assert (cfg.name_url_cap, cfg.safe_attributes, cfg.now) == (7, True, 5.0)


def test_misc_columns(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(U.stream_root(F.lit("http://a.example/x/y/seg.ts?q"))) == "http://a.example/x/y"
    assert one(U.stream_root(F.lit("https://raw.githubusercontent.com/o/r/x.ts"))) == ""
    assert one(U.url_slug(F.lit("http://cdn.example.com/aaj-tak/index.m3u8"))) == "example"
    assert one(T.norm_name(F.lit("Zee TV  (HD) x_720p"))) == "zee tv x 720p"
    assert one(G.is_challenge(F.lit(""), F.lit(403))) is True and one(G.is_challenge(F.lit("x"), F.lit(403))) is False
    assert one(F.array_join(M.query_names(F.lit('"Zee TV" m3u8')), ",")) == "Zee TV"
    fresh = spark.createDataFrame([("2001-09-08T12:00:00",), ("2001-09-01T00:00:00",), ("bad",)], "d string").select(Rd.is_fresh("d", 1e9).alias("x")).collect()
    assert [r["x"] for r in fresh] == [True, False, False]


def test_validation_and_files(spark):
    d = spark.createDataFrame([("r1", f"a{i}.m3u8") for i in range(9)] + [("r2", "tests/fixture.m3u"), ("r2", "b.txt")], "repo string, path string")
    assert Rd.capped_files(d).count() == 6
    bad = Rd.check_columns(d, ["repo", "size"], 1).first()
    assert (bad["missing"], bad["rows"], bad["ok"]) == ("size", 11, False)


def test_reference_tables_are_not_needed():
    assert not (Path(__file__).resolve().parents[1] / "data").exists()


def test_target_lists(spark, tmp_path):
    ch = lambda *rows: {"timestamp": "2024", "language": "x", "total": len(rows), "channels": [{"name": n, "languages": ls, "categories": []} for n, ls in rows]}
    (tmp_path / "hindi_channels.json").write_text(json.dumps(ch(("A", ["Hindi"])), indent=1))
    (tmp_path / "all_channels.json").write_text(json.dumps(ch(("A", ["Hindi"]), ("B", ["Tamil", "Hindi"]), ("C", []))))
    names = lambda lang: [r["name"] for r in Rd.targets(spark, str(tmp_path), lang).orderBy("name").collect()]
    assert (names("Hindi"), names("Tamil"), names("All")) == (["A"], ["B"], ["A", "B", "C"])
    (tmp_path / "ott.json").write_text(json.dumps({"platforms": [{"s_no": 1, "name": " Jio "}, {"s_no": 2, "name": "JIO"}, {"s_no": 3, "name": ""}, {"s_no": 4, "name": "Voot"}]}))
    assert [r["name"] for r in Rd.platforms(spark, str(tmp_path / "ott.json")).orderBy("_ord").collect()] == ["Jio", "Voot"]
    feed = [{"channel": "A.in", "url": "http://a"}, {"channel": "A.in", "url": "udp://a"}, {"channel": "B.us", "url": "http://b"}, {"channel": "X.in", "url": "http://x"}]
    (tmp_path / "streams.json").write_text(json.dumps(feed))
    bad = spark.createDataFrame([("X.in",)], "id string")
    assert [r["url"] for r in Rd.stream_rows(spark, str(tmp_path / "streams.json"), bad).collect()] == ["http://a"]


def test_replace_language(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame([*x], "url string, lang string")
    sinks.replace_language(rows(("a", "Hindi"), ("b", "Tamil")), str(tmp_path / "c"))
    sinks.replace_language(rows(("z", "Hindi")), str(tmp_path / "c"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "c")).select("url", "lang").collect()} == {("z", "Hindi"), ("b", "Tamil")}
    lists = spark.createDataFrame([("N", ["Hindi", "Klingon"], [])], "name string, languages array<string>, categories array<string>")
    sinks.write_language_lists(lists, str(tmp_path / "l"), "2024-01-01")
    assert [p.name for p in (tmp_path / "l").iterdir() if p.is_dir()] == ["file=hindi"]


def test_coverage_markdown(spark):
    r = spark.createDataFrame([("g", 8, 1)], "g string, total long, found long").withColumn("missing", F.col("total") - F.col("found")).withColumn("pct", F.lit(12.5))
    assert sinks.coverage_markdown(r, "g").first()["value"] == "| g | 1 / 8 | 12.5% |"


def test_channel_id_shuffles_names(spark, tmp_path):
    """No side of names goes through the driver, and rows without a name don't meet in one task."""
    ch = spark.createDataFrame([("a", "Mega", "big;", 0), ("b", " Mega News", None, 1), ("c", "", "", 2), ("d", "MEGA", "", 3)], "id string, name string, alt_names string, _ord long")
    q = spark.createDataFrame([(0, "mega "), (1, "BIG"), (2, "Mega News HD"), (3, "news"), (4, None), (5, "  "), (6, "x"), *((i, "") for i in range(7, 400))], "k long, name string")
    ch.write.parquet(str(tmp_path / "ch"))
    q.write.parquet(str(tmp_path / "q"))
    ch, q = spark.read.parquet(str(tmp_path / "ch")), spark.read.parquet(str(tmp_path / "q"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = M.channel_id(q, ch)
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        rows = got.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert {r["k"]: r["channel_id"] for r in rows if r["channel_id"]} == {0: "d", 1: "a", 2: "a", 3: "b"}
    assert sorted(r["k"] for r in rows) == list(range(400))
    assert len({r["task"] for r in rows if r["k"] >= 7}) > 1
