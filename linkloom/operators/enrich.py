"""Lookup enrichment with explicit fallbacks, and set filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions import text as T
from linkloom.functions.gates import is_nsfw
from linkloom.operators.match import channel_id
from linkloom.operators.rank import best_logo, first_per_key, main_feed


def metadata(channels: DataFrame, feeds: DataFrame, logos: DataFrame) -> DataFrame:
    """id -> category, language, logo, network, website, canonical name."""
    lang = main_feed(feeds).select(F.col("channel").alias("id"), T.primary_language("languages").alias("db_language"))
    logo = best_logo(logos).select(F.col("channel").alias("id"), F.col("url").alias("db_logo"))
    base = channels.select("id", F.col("name").alias("canonical_name"), T.first_category("categories").alias("db_category"), F.coalesce("network", F.lit("")).alias("network"), F.coalesce("website", F.lit("")).alias("website"))
    return base.join(lang, "id", "left").join(logo, "id", "left")


def enrich_by_id(rows: DataFrame, channels: DataFrame, feeds: DataFrame, logos: DataFrame) -> DataFrame:
    """Category and logo where missing, language where missing or Other, from the database."""
    q = channel_id(rows, channels).join(metadata(channels, feeds, logos).withColumnRenamed("id", "channel_id"), "channel_id", "left")
    known = F.when(F.col("language") == "Other", "").otherwise(F.col("language"))
    return q.withColumns({
        "category": T.fallback(F.col("category"), F.col("db_category")), "logo": T.fallback(F.col("logo"), F.col("db_logo")),
        "language": T.fallback(known, F.col("db_language"), F.col("language")),
    }).select(*rows.columns)


def enrich_language(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Language where missing or Other, from the first list in alphabetical order that has the name."""
    known = lists.select(F.lower(F.trim("name")).alias("__k"), F.col("language").alias("__l")).where("__k <> ''").groupBy("__k").agg(F.min("__l").alias("__l"))
    q = rows.withColumn("__k", F.lower(F.trim(T.text("name")))).join(known, "__k", "left")
    return q.withColumn("language", F.when(F.col("language").isin("", "Other"), T.fallback(F.col("__l"), F.col("language"))).otherwise(F.col("language"))).select(*rows.columns)


def language_map(targets: DataFrame) -> DataFrame:
    """key -> language of the first target row with that name; rows without a real language don't count."""
    lang = T.fallback(F.get(F.filter(F.transform("languages", lambda x: F.trim(x)), lambda x: x != ""), 0), F.trim(F.get(F.split(T.text("language_raw"), ";"), 0)))
    rows = targets.withColumn("lang", lang).where((F.col("lang") != "") & ~F.lower("lang").contains("all indian scheduled") & ~F.lower("lang").isin(*K.NO_LANGUAGE))
    every = F.concat(F.array(T.text("name"), T.text("canonical_name")), F.coalesce("alt_names", F.array().cast("array<string>")))
    keys = rows.select("lang", "_ord", F.posexplode(every).alias("p", "n")).withColumn("key", T.coverage_key("n")).where("key <> ''")
    return first_per_key(keys, ["key"], ["_ord", "p"]).select("key", "lang")


def tag_language(rows: DataFrame, by_key: DataFrame) -> DataFrame:
    q = rows.withColumn("key", T.coverage_key("name")).join(by_key, "key", "left")
    return q.withColumn("language", F.coalesce("lang", F.lit("Other"))).select(*rows.columns, *([] if "language" in rows.columns else ["language"]))


def drop_unfit(rows: DataFrame, channels: DataFrame, blocked: DataFrame) -> DataFrame:
    """Rows whose name is that of a blocked channel (exact or other name, never by containment) or matches the pattern go."""
    ids = blocked.select(F.col("id").alias("channel_id"))
    own = channel_id(rows.withColumn("__row", F.lower(F.trim(T.text("name")))), channels, contains=False)
    return own.join(ids, "channel_id", "left_anti").where(~is_nsfw("name")).select(*rows.columns)


def fill_missing(rows: DataFrame, other: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Empty fields from the other side."""
    o = other.select(on, *[F.col(c).alias(f"__{c}") for c in columns])
    return rows.join(o, on, "left").withColumns({c: T.fallback(F.col(c), F.col(f"__{c}")) for c in columns}).select(*rows.columns)


def without(rows: DataFrame, *others: DataFrame, on: str = "url") -> DataFrame:
    """Rows whose key is in none of the others."""
    for o in others:
        rows = rows.join(o.select(on), on, "left_anti")
    return rows


def only_in(rows: DataFrame, other: DataFrame, on: str = "url") -> DataFrame:
    return rows.join(other.select(on), on, "left_semi")
