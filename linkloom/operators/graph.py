"""Level-synchronous walks over captured pages, and redirect chains.  Each level is a join; the driver sees counts only."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import parse as P
from linkloom.functions.urls import host_of, is_blocked_domain, is_raw_file, joined, page_key, page_priority


def durable(df: DataFrame) -> DataFrame:
    """Checkpoints to the shared folder; to a folder of our own only where none is set."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or "/tmp/checkpoints")
    return df.checkpoint()


def crawl(pages: DataFrame, seeds: DataFrame, max_pages: int = 30) -> DataFrame:
    """pages: url, html; seeds: site, url -> site, url, depth of visited pages: the site's host or below it, live-looking
    paths first within a level, `max_pages` a site.  It goes on until a level brings no new page."""
    p = pages.select(page_key("url").alias("key"), "url", "html").dropDuplicates(["key"])
    links = p.select("key", F.explode(P.page_links("html", "url")).alias("to")).select("key", page_key("to").alias("to"), host_of("to").alias("host")).where("key <> to").distinct()
    start = seeds.select("site", host_of("url").alias("home"), page_key("url").alias("key")).join(p.select("key"), "key", "left_semi")
    seen = start.select("site", "home", "key", F.lit(0).alias("depth")).distinct()
    frontier = seen
    for depth in itertools.count(1):
        nxt = frontier.join(links, "key").where((F.col("host") == F.col("home")) | F.col("host").endswith(F.concat(F.lit("."), "home")))
        nxt = nxt.select("site", "home", F.col("to").alias("key")).distinct().join(p.select("key"), "key", "left_semi")
        nxt = durable(nxt.join(seen.select("site", "key"), ["site", "key"], "left_anti").withColumn("depth", F.lit(depth)).select("site", "home", "key", "depth"))
        if nxt.isEmpty():
            break
        w = Window.partitionBy("site").orderBy("depth", page_priority("key"), "key")
        seen = durable(seen.unionByName(nxt).withColumn("r", F.row_number().over(w)).where(F.col("r") <= max_pages).drop("r"))
        frontier = nxt.join(seen.select("site", "key"), ["site", "key"], "left_semi")
    return seen.select("site", F.col("key").alias("url"), "depth")


def crawl_candidates(pages: DataFrame, visited: DataFrame, per_site: int = 300) -> DataFrame:
    """site, url: stream links on the visited pages, and visited pages that are themselves playlists; `per_site` at most, in order."""
    p = pages.select(page_key("url").alias("key"), "url", "html").dropDuplicates(["key"])
    v = visited.select("site", F.col("url").alias("key")).join(p, "key")
    hint = F.lower("link").rlike(r"\.m3u8|\.m3u|playlist\.m3u|index\.m3u8|get\.php|player_api")
    links = v.select("site", F.explode(P.page_links("html", "url")).alias("link")).where(hint & ~is_blocked_domain("link"))
    own = v.where(P.is_playlist_body("html") | F.lower("key").contains(".m3u8")).select("site", F.col("key").alias("link"))
    w = Window.partitionBy("site").orderBy("link")
    rows = links.unionByName(own).distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_site)
    return rows.select("site", F.col("link").alias("url"))


def resolve_chain(start: DataFrame, responses: DataFrame, max_hops: int = 8) -> DataFrame:
    """start: url -> url, resolved, hops: manifests on raw-file hosts followed to the first target elsewhere.

    Cycles and dead ends resolve to empty.
    """
    nxt = responses.select(F.col("url").alias("at"), F.coalesce(F.get(P.media_segments("text", "url", 1), 0), F.lit("")).alias("seg"), P.best_variant(P.master_variants("text"))["uri"].alias("var"))
    nxt = nxt.select("at", F.when(F.col("var").isNotNull(), joined("at", "var")).otherwise(F.col("seg")).alias("to")).dropDuplicates(["at"])
    cur = start.select("url", F.col("url").alias("at"), F.lit(0).alias("hops"), F.array("url").alias("trail"))
    for _ in range(max_hops):
        step = cur.join(nxt, "at", "left")
        go = is_raw_file("at")
        to = F.coalesce("to", F.lit(""))
        loop = F.array_contains("trail", to)
        cur = step.select("url", F.when(~go, F.col("at")).when(loop, "").otherwise(to).alias("at"), (F.col("hops") + go.cast("int")).alias("hops"), F.when(go, F.concat("trail", F.array(to))).otherwise(F.col("trail")).alias("trail"))
    return cur.select("url", F.when(is_raw_file("at"), "").otherwise(F.col("at")).alias("resolved"), "hops")
