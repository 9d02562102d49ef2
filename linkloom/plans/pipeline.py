"""Whole plans: preparing channels for publishing, classifying captured responses, accepting what they hold."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.config import Config
from linkloom.functions import gates as G
from linkloom.functions import parse as P
from linkloom.functions import score as Sc
from linkloom.functions import text as T
from linkloom.functions import urls as U
from linkloom.operators import enrich as E
from linkloom.operators import match as M
from linkloom.operators import rank as R


def prepare_channels(channels: DataFrame, cfg: Config, database: dict[str, DataFrame] | None = None, lists: DataFrame | None = None, blocked: DataFrame | None = None) -> DataFrame:
    """Rows to publish: no raw files, best per URL, few per name, none unfit, enriched, classified.  The order matters."""
    c = channels.where(~U.is_raw_file("url"))
    c = R.cap_per_name(R.best_per_channel(c), cfg.name_url_cap)
    if database is not None:
        c = E.drop_unfit(c, database["channels"], blocked)
        c = E.enrich_by_id(c, database["channels"], database["feeds"], database["logos"])
    else:
        c = c.where(~G.is_nsfw("name"))
    if lists is not None:
        c = E.enrich_language(c, lists)
    blob = F.concat_ws(" ", T.text("name"), T.text("extinf"), T.text("group_title"))
    return c.withColumn("category", Sc.category_of(blob, F.col("category")))


def _probe(kind: str, detail: str | Column = "", note: str | Column = "", **more) -> Column:
    base = {
        "kind": F.lit(kind), "detail": F.lit(detail) if isinstance(detail, str) else detail, "note": F.lit(note) if isinstance(note, str) else note,
        "score": F.lit(0), "quality": F.lit(""), "bandwidth": F.lit(0).cast("long"), "vod": F.lit(False), "vod_inferred": F.lit(False), "blocked": F.lit(False),
    }
    return F.struct(*[v.alias(k) for k, v in (base | more).items()])


def classify(requests: DataFrame, responses: DataFrame, cfg: Config) -> DataFrame:
    """requests: url, needs_ua; responses: from readers.responses() -> url and the verdict struct `probe`, `entries`, `harvested`.

    One ordered decision list.  Follow-up fetches (a master's best variant, first segments, a list's first entries) are
    joins with the captured responses by URL.
    """
    r = responses.select("url", "final_url", "status", "text", "content_type", "latency_ms", "body", "reachable").dropDuplicates(["url"])
    q = requests.join(r, "url", "left").withColumn("text", T.text("text")).withColumn("final_url", T.fallback(F.col("final_url"), F.col("url")))
    variants = F.when(P.is_master("text"), P.master_variants("text"))
    dash = F.when(F.lower(F.substring("text", 1, 2000)).contains("<mpd") | F.col("content_type").contains("application/dash"), P.dash_variants("text", "final_url"))
    q = q.withColumns({"best": P.best_variant(variants), "n_variants": F.size(variants), "dash": P.best_variant(dash), "is_dash": dash.isNotNull()})
    q = q.withColumn("follow", F.when(F.col("best").isNotNull(), U.joined("final_url", "best.uri")))
    media = r.select(F.col("url").alias("follow"), F.col("final_url").alias("m_url"), F.col("text").alias("media"), F.col("reachable").alias("m_ok"), F.col("status").alias("m_status"))
    q = q.join(media, "follow", "left")
    dead_variant = ~F.coalesce(F.col("m_ok") & (F.col("m_status") < 400) & P.is_playlist_body("media"), F.lit(False))
    own = F.when(F.col("best").isNotNull(), P.media_segments("media", T.fallback(F.col("m_url"), F.col("follow")))).otherwise(P.media_segments("text", "final_url"))
    segs = F.when(F.col("is_dash"), F.when(F.col("dash").isNotNull(), F.array("dash.uri"))).otherwise(F.when(F.col("best").isNotNull() | P.is_hls_media("text"), F.slice(own, 1, 2)))
    q = q.withColumn("entries", F.when(P.is_playlist_body("text") & ~P.is_hls_media("text") & ~P.is_master("text"), P.extinf_entries("text")))
    sized = r.select(F.col("url").alias("to"), (F.col("reachable") & (F.octet_length("body") >= 512)).alias("good"))
    checks = q.select("url", F.explode(F.array_distinct(segs)).alias("to")).join(sized, "to").groupBy("url").agg(F.sum(F.col("good").cast("int")).alias("seg_ok"))
    q = q.join(checks, "url", "left")
    children = q.select("url", F.explode(F.slice("entries", 1, cfg.sample_cap)).alias("e")).select("url", F.col("e.url").alias("to"))
    alive = r.where(F.col("reachable") & (P.is_playlist_body("text") | Sc.looks_media(F.col("body")))).select(F.col("url").alias("to"))
    q = q.join(children.join(alive, "to", "left_semi").groupBy("url").agg(F.count("*").alias("sample_ok")), "url", "left")
    seg_ok, sample_ok = (F.coalesce(c, F.lit(0)) for c in ("seg_ok", "sample_ok"))
    ua, wait = F.coalesce("needs_ua", F.lit(False)), F.coalesce("latency_ms", F.lit(0.0))
    rate = F.coalesce("best.bandwidth", F.lit(0)).cast("long")
    named = F.regexp_extract("media", r"(?i)RESOLUTION=(\d+x\d+)", 1)
    quality = T.fallback(Sc.quality_from_resolution(F.col("best.resolution"), rate), Sc.quality_from_resolution(named, rate))

    def points(**given) -> Column:
        base = {"parsed": F.lit(True), "segments_ok": seg_ok, "quality": F.lit(""), "bandwidth": F.lit(0), "latency_ms": wait, "verified": F.lit(False), "needs_ua": ua, "entries": F.lit(0)}
        return Sc.score_parts(**(base | given))

    n_entries = F.size("entries")
    listed = points(segments_ok=F.lit(0), entries=n_entries)
    ct, path, asked = F.col("content_type"), F.lower(U.path_of("final_url")), F.lower(U.path_of("url"))
    by_ext = path.rlike(r"\.(?:ts|mp4|m4s|f4f|flv|mkv|mp3|aac)$")
    direct = by_ext | ct.rlike("^(?:video|audio)/") | ct.startswith("application/octet-stream")
    file_for_list = (asked.rlike(r"\.(?:m3u8|m3u|mpd)$") | F.lower("url").contains("output=m3u8")) & Sc.is_finished_file(F.substring("body", 1, 4096))
    readable = (F.octet_length("body") >= 512) & (by_ext | ct.rlike("^(?:video|audio)/") | Sc.looks_media(F.col("body")))
    page = ct.rlike("text/html|application/xhtml") | F.lower(F.ltrim(F.substring("text", 1, 64))).rlike("^(?:<!doctype|<html|<head)")
    vod = Sc.looks_like_vod("media") & (U.host_of("follow") == U.host_of("final_url"))
    d_rate = F.coalesce("dash.bandwidth", F.lit(0)).cast("long")
    d_quality = Sc.quality_from_resolution(F.col("dash.resolution"), d_rate)
    walled = F.col("reachable") & G.is_challenge("text", "status")
    harvested = P.harvest_links("text", "final_url", 60)
    json_like = F.trim("text").rlike(r"^[{\[]")
    empty_list = ~F.exists(P.lines("text"), lambda x: (F.trim(x) != "") & ~F.trim(x).startswith("#"))
    probe = (
        F.when(~U.is_http("url") | U.is_blocked_domain("url"), _probe("dead", note="blocked"))
        .when(U.is_non_media("url"), _probe("dead", note="non_media_ext"))
        .when(F.col("status").isin(404, 410) & F.lit(cfg.honour_gone_status), _probe("dead", note=F.concat(F.lit("http"), F.col("status").cast("string"))))
        .when(~F.coalesce("reachable", F.lit(False)), _probe("dead", note="unreachable"))
        .when(walled & ~U.is_probe_worthy("url"), _probe("dead", note="challenge_junk"))
        .when(walled, _probe("dead", note="challenge", blocked=F.lit(True)))
        .when(F.col("status") >= 400, _probe("dead", note=F.concat(F.lit("http"), F.col("status").cast("string"))))
        .when(page, _probe("page", "html"))
        .when(F.col("best").isNotNull() & dead_variant, _probe("dead", "hls_master", "variant_unreachable"))
        .when(F.col("best").isNotNull(), _probe("stream", "hls_master", F.concat(F.lit("variants="), F.col("n_variants").cast("string"), F.lit(" seg_ok="), seg_ok.cast("string")), score=points(quality=quality, bandwidth=rate), quality=quality, bandwidth=rate, vod=vod, vod_inferred=vod & ~Sc.vod_is_told("media")))
        .when(P.is_hls_media("text") & Sc.looks_like_vod("text"), _probe("dead", "vod_clip", "finite vod clip, not live", vod=F.lit(True), vod_inferred=~Sc.vod_is_told("text")))
        .when(P.is_hls_media("text") & empty_list, _probe("dead", "empty_playlist", "playlist has no segments"))
        .when(P.is_hls_media("text"), _probe("stream", "hls", F.concat(F.lit("seg_ok="), seg_ok.cast("string")), score=points()))
        .when(F.col("is_dash"), _probe("stream", "dash", score=points(parsed=F.col("dash").isNotNull(), segments_ok=F.least(seg_ok, F.lit(1)), quality=d_quality, bandwidth=d_rate), quality=d_quality, bandwidth=d_rate))
        .when(P.is_playlist_body("text") & (n_entries > 0), _probe("playlist", "playlist_m3u", F.concat(F.lit("entries="), n_entries.cast("string"), F.lit(" sample_ok="), sample_ok.cast("string")), score=F.when(sample_ok > 0, F.least(F.lit(100), listed + 5)).otherwise(F.greatest(F.lit(0), listed - 20)).cast("int")))
        .when(P.is_playlist_body("text"), _probe("dead", "empty_playlist"))
        .when(direct & file_for_list, _probe("dead", "playlist_serves_file", "playlist_serves_file"))
        .when(direct & readable, _probe("stream", "direct", score=points(segments_ok=F.lit(1))))
        .when(direct, _probe("dead", "direct_unreadable"))
        .when(json_like & (F.size(harvested) > 0), _probe("page", "json"))
        .otherwise(_probe("dead", F.concat(F.lit("unclassified:"), F.substring(T.text("content_type"), 1, 40))))
    )
    out = q.withColumn("probe", probe)
    return out.select("url", "final_url", "probe", F.when(F.col("probe.kind") == "playlist", F.col("entries")).alias("entries"), F.when(F.col("probe.kind") == "page", harvested).alias("harvested"))


def accept_streams(classified: DataFrame, candidates: DataFrame, seen: DataFrame, cfg: Config) -> DataFrame:
    """Channel rows of single streams: live-looking, score above zero, not seen; the name falls back on the URL."""
    c = classified.where("probe.kind = 'stream' AND NOT probe.vod").join(candidates, "url", "left").join(seen.select("url"), "url", "left_anti")
    name = T.fallback(F.col("name"), U.url_slug("url"), F.element_at(F.split(F.regexp_replace(U.path_of("url"), "/+$", ""), "/"), -1))
    c = c.withColumn("name", name).where(G.is_live_candidate("url") & ~U.is_raw_file("url") & ~U.is_placeholder_token("url"))
    return c.select("url", "name", F.lit("" if cfg.language == "All" else cfg.language).alias("language"), U.source_name("url").alias("source"), F.col("probe.score").alias("score"), F.col("probe.quality").alias("quality"))


def accept_playlists(classified: DataFrame, seen: DataFrame) -> DataFrame:
    """Channel rows of lists' entries: live-looking, not seen, score 0 until they are probed."""
    e = classified.where("probe.kind = 'playlist'").select(F.col("url").alias("list_url"), F.explode("entries").alias("e"))
    e = e.select("list_url", "e.url", "e.extinf", P.parse_extinf(F.col("e.extinf")).alias("x")).join(seen.select("url"), "url", "left_anti")
    e = e.withColumn("name", T.fallback(F.col("x.name"), U.url_slug("url")))
    ok = e.where(G.is_live_candidate("url") & ~U.is_blocked_domain("url") & ~U.is_raw_file("url") & ~U.is_placeholder_token("url"))
    first = R.first_per_key(ok, ["url"], ["list_url", "extinf"])
    tag = lambda k: F.coalesce(F.try_element_at("x.attrs", F.lit(k)), F.lit("")).alias
    return first.select("url", "name", "extinf", tag("tvg-id")("tvg_id"), tag("tvg-logo")("logo"), tag("group-title")("group_title"), U.source_name("url").alias("source"), T.quality_of_name("name").alias("quality"), F.lit(0).alias("score"))


def admit(rows: DataFrame, names: DataFrame, cfg: Config, proven: DataFrame | None = None) -> DataFrame:
    """Rows that the language gate lets in; name and URL matches are joins."""
    q = M.strict_match(M.token_set_match(rows, names), names)
    q = M.url_name_match(q, names)
    if proven is not None:
        q = q.join(proven.select("url").distinct().withColumn("__p", F.lit(True)), "url", "left")
    has_proof = F.coalesce(F.col("__p"), F.lit(False)) if proven is not None else F.lit(False)
    gate = G.matches_language(T.text("name"), T.text("url"), T.text("extinf"), strict=F.col("strict_known"), known=F.col("known"), url_known=F.col("best_name") != "", proven=has_proof, language=cfg.language, any_list=F.lit(not names.isEmpty()))
    return q.where(gate).select(*rows.columns)


def mined_links(pages: DataFrame, cfg: Config, captured: DataFrame | None = None) -> DataFrame:
    """url, link: stream links of captured pages; else those in the answers of endpoints that their scripts name; else embedded
    players (three at most); few per page.  captured: url, html of scripts and answers."""
    p = pages.withColumns({"own": P.harvest_links("html", "url", cfg.harvest_per_page), "inner": F.slice(P.extract_embeds("html", "url"), 1, 3)})
    if captured is not None:
        p = p.join(script_links(pages, captured, cfg), "url", "left")
        p = p.withColumn("own", F.when(F.size("own") > 0, F.col("own")).otherwise(F.coalesce("told", F.array().cast("array<string>"))))
    return p.select("url", F.explode(F.when(F.size("own") > 0, F.col("own")).otherwise(F.col("inner"))).alias("link"))


def script_links(pages: DataFrame, captured: DataFrame, cfg: Config) -> DataFrame:
    """url, told: stream links in what the endpoints of a page's own scripts (inline, and `bundle_cap` files) answer."""
    at = captured.select(F.col("url").alias("at"), F.col("html").alias("body")).dropDuplicates(["at"])
    files = pages.select("url", F.explode(P.script_sources("html", "url", cfg.bundle_cap)).alias("at")).join(at, "at").select("url", "body")
    code = files.unionByName(pages.select("url", F.col("html").alias("body")))
    asked = code.select("url", F.explode(P.script_endpoints("body", cfg.endpoint_cap)).alias("e")).select("url", U.joined("url", "e").alias("at")).distinct()
    links = asked.join(at, "at").select("url", F.explode(P.harvest_links("body", "at", cfg.harvest_per_page)).alias("link"))
    return links.groupBy("url").agg(F.slice(F.sort_array(F.collect_set("link")), 1, cfg.harvest_per_page).alias("told"))


def proven_queries(queries: DataFrame, names: DataFrame, cfg: Config) -> DataFrame:
    """query of each search query that names a channel of the language: a quoted name, or the query less its ending, is known,
    regional, geo-blocked or let in by the gate."""
    each = queries.select("query", F.explode(M.query_names(T.text("query"))).alias("name")).withColumns({"url": F.lit(""), "extinf": F.lit("")})
    known = M.strict_match(M.token_set_match(each, names), names)
    gate = G.matches_language(F.col("name"), F.lit(""), F.lit(""), strict=F.col("strict_known"), known=F.col("known"), url_known=F.lit(False), proven=F.lit(False), language=cfg.language)
    return known.where(F.col("known") | G.is_regional("name") | G.is_geo_blocked("name") | gate).select("query").distinct()


def catalog_candidates(catalog: DataFrame, streams: DataFrame, seen: DataFrame, cap: int = 2) -> DataFrame:
    """Candidate rows of a catalogue: at most `cap` stream URLs of each entry, not seen and not blocked."""
    few = R.per_group(streams, ["path"], ["place"], cap)
    rows = catalog.join(few, "path").join(seen.select("url"), "url", "left_anti").where(~U.is_blocked_domain("url"))
    return rows.select("url", "name", F.lit("").alias("referer"), F.lit("").alias("user_agent"), F.lit("").alias("quality"), F.lit("catalog").alias("source"), F.lit("").alias("extinf"), "logo", F.col("lang_code").alias("language"))


def validate(seeds: DataFrame, responses: DataFrame, cfg: Config) -> DataFrame:
    """url, depth, probe, entries: seeds and what their pages lead to, level by level until nothing new comes; a URL is judged once,
    at its first level, and of each level the `backlog_cap` URLs of best probe order.

    Each level is written to the shared folder, and the driver sees only whether it is empty.
    """
    from linkloom.operators.graph import durable

    frontier, out, seen = seeds.select("url").distinct(), None, None
    for depth in itertools.count():
        got = classify(frontier.withColumn("needs_ua", F.lit(False)), responses, cfg)
        got = durable(got.withColumn("depth", F.lit(depth)).select("url", "depth", "probe", "entries", "harvested"))
        out = got if out is None else out.unionByName(got)
        seen = frontier if seen is None else seen.unionByName(frontier)
        links = got.where("probe.kind = 'page'").select(F.explode("harvested").alias("url")).where(U.is_probe_worthy("url")).distinct()
        frontier = durable(R.probe_order(links.join(seen, "url", "left_anti"), "url", cfg.backlog_cap))
        if frontier.isEmpty():
            return out.select("url", "depth", "probe", "entries")
