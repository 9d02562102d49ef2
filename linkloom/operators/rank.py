"""Best per key, quality-diverse top-k, picks and schedules.  Every order is total: it ends in `_ord` or a natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.score import quality_rank, quality_tier
from linkloom.functions.text import norm_name, text
from linkloom.functions.urls import has_direct_hint, url_key


def first_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key.  The window keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def rank_struct(score: Column, quality: Column, logo: Column, tvg_id: Column) -> Column:
    """The order of competing rows, best last."""
    return F.struct(
        F.coalesce(score.cast("int"), F.lit(0)).alias("s"), quality_rank(quality).alias("q"),
        (text(logo) != "").cast("int").alias("l"), (text(tvg_id) != "").cast("int").alias("t"),
    )


def _rank(df: DataFrame) -> Column:
    return rank_struct(*[F.col(c) for c in ("score", "quality", "logo", "tvg_id")])


def best_per_channel(channels: DataFrame) -> DataFrame:
    """One row per URL key, the best, at the place of the first; rows without a URL go."""
    c = channels.withColumns({"__k": url_key("url"), "__rank": _rank(channels)}).where("__k <> ''")
    # one aggregation, partial before the shuffle: a hot URL is a row a task
    best = c.groupBy("__k").agg(F.max_by(F.struct(*channels.columns), F.struct("__rank", -F.col("_ord"))).alias("__b"), F.min("_ord").alias("__first"))
    return best.select(*[F.col("__first" if x == "_ord" else f"__b.{x}").alias(x) for x in channels.columns])


def diverse_top_k(df: DataFrame, keys: list, tier: Column, order: list, cap: int) -> DataFrame:
    """Per key, the best row of each tier in order, then the rest in order, `cap` at most."""
    d = df.withColumn("__tier", tier)
    d = d.withColumn("__t", F.row_number().over(Window.partitionBy(*keys, "__tier").orderBy(*order)))
    d = d.withColumn("__s", F.row_number().over(Window.partitionBy(*keys).orderBy((F.col("__t") > 1).cast("int"), *order)))
    return d.where(F.col("__s") <= cap).drop("__tier", "__t", "__s")


def cap_per_name(channels: DataFrame, cap: int = 5) -> DataFrame:
    """At most `cap` rows of a normalised name, of different qualities first; rows without a name all stay."""
    c = channels.withColumns({"__name": norm_name("name"), "__rank": _rank(channels)})
    # rows without a name are given a key of their own, so that they neither meet nor pile up in one task
    c = c.withColumn("__key", F.when(F.col("__name") != "", F.concat(F.lit("n"), "__name")).otherwise(F.concat(F.lit("o"), F.col("_ord").cast("string"))))
    return diverse_top_k(c, ["__key"], quality_tier("quality"), [F.col("__rank").desc(), F.col("_ord")], cap).drop("__name", "__rank", "__key")


def best_logo(logos: DataFrame) -> DataFrame:
    """Per channel, of those in use, if any, else of all, the largest; the first of equals."""
    side = lambda c: F.coalesce(F.col(c).try_cast("int"), F.lit(0))
    return first_per_key(logos, ["channel"], [(F.col("in_use") == "TRUE").desc(), (side("width") * side("height")).desc(), "_ord"])


def main_feed(feeds: DataFrame) -> DataFrame:
    """Per channel, the first main feed, else the first."""
    return first_per_key(feeds, ["channel"], [(F.col("is_main") == "TRUE").desc(), "_ord"])


def playlist_order() -> list[Column]:
    """Category, score downwards, name."""
    return [F.lower(text("category")), F.col("score").desc(), F.lower(text("name")), F.col("_ord")]


def probe_order(df: DataFrame, url: str = "url", cap: int | None = None) -> DataFrame:
    out = df.orderBy(F.when(has_direct_hint(url), 0).otherwise(1), url)
    return out if cap is None else out.limit(cap)


def seed_order(rows: DataFrame, language: str, cap: int) -> DataFrame:
    """Streams of a language first, then by quality, rows of the channel and URL; `cap` at most."""
    r = with_group_size(rows, "channel")
    return r.orderBy((F.col("language") == language).cast("int").desc(), quality_rank("quality", empty=2).desc(), F.col("entries").desc(), "url").limit(cap)


def with_group_size(df: DataFrame, key: str, name: str = "entries") -> DataFrame:
    """The number of rows of the same key (nulls are one key), by a join on the counts."""
    n = df.groupBy(F.col(key).alias("__g")).agg(F.count("*").alias(name))
    return df.join(n, F.col(key).eqNullSafe(F.col("__g"))).drop("__g")


def per_group(df: DataFrame, keys: list, order: list, cap: int) -> DataFrame:
    """The first `cap` rows of each group."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__r") <= cap).drop("__r")


def round_robin(queries: DataFrame, key: str, items: str, seed: int = 0) -> DataFrame:
    """key, pos, query, turn: round r has every key's r-th query; a seeded hash orders the keys within a round; an equal
    query stays only where it comes first."""
    q = queries.select(key, F.posexplode(items).alias("pos", "query")).withColumn("turn", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    return first_per_key(q, ["query"], ["pos", "turn", key])


def channel_queries(channels: DataFrame, platforms: list[str] = ()) -> DataFrame:
    """channel, queries: base forms, site, other names, network, then deeper ones; platform forms last."""
    name = F.col("name")
    base = [F.concat(F.lit('"'), name, F.lit(f'"{s}')) for s in (" m3u8", " m3u playlist", " iptv", " stream", " filetype:m3u")]
    site = F.when(text("website") != "", F.array(*[F.concat(F.lit("site:"), F.regexp_replace("website", r"^https?://(?:www\.)?([^/]+).*$", "$1"), F.lit(s)) for s in (" live", " m3u8")])).otherwise(F.array().cast("array<string>"))
    alt = F.transform(F.slice(F.filter(F.split(text("alt_names"), ";"), lambda x: F.trim(x) != ""), 1, 4), lambda x: F.concat(F.lit('"'), F.trim(x), F.lit('" m3u8')))
    net = F.when(text("network") != "", F.array(F.concat(F.lit('"'), F.col("network"), F.lit('" m3u8')))).otherwise(F.array().cast("array<string>"))
    deep = [F.concat(name, F.lit(s)) for s in (" live hls", " m3u8 github", " playlist raw")]
    deep_alt = F.slice(F.transform(alt, lambda x: F.concat(x, F.lit(" github"))), 1, 1)
    ott = [F.concat(name, F.lit(f" {p}{s}")) for p in platforms for s in (" live", " m3u8")]
    return channels.select(name.alias("channel"), F.array_distinct(F.concat(F.array(*base), site, alt, net, F.array(*deep), deep_alt, F.array(*ott).cast("array<string>"))).alias("queries"))


def rotating_window(names: DataFrame, offset: int, cap: int, order: list) -> DataFrame:
    """The `cap` names from an offset on, wrapping round, each once; pos is the place in the window.

    The row number needs one order over all; it is taken over names alone.
    """
    n = names.withColumn("__n", F.row_number().over(Window.orderBy(*order)) - 1).withColumn("__all", F.count("*").over(Window.partitionBy()))
    return n.withColumn("pos", F.pmod(F.col("__n") - offset, F.col("__all")).cast("long")).where(F.col("pos") < cap).drop("__n", "__all")
