"""Group counts, explode counts and last-wins maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.operators.rank import with_group_size  # noqa: F401


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def breakdown(df: DataFrame, items: Column, order: str = "_ord") -> DataFrame:
    """item, n, first: counts of array items, most first, then by first place."""
    e = df.select(F.col(order).alias("o"), F.posexplode(items).alias("p", "item"))
    return e.groupBy("item").agg(F.count("*").alias("n"), F.min(F.struct("o", "p")).alias("first")).orderBy(F.col("n").desc(), "first")


def last_wins(df: DataFrame, key: Column, value: Column, order: str = "_ord") -> DataFrame:
    """key -> the value of its last row."""
    return df.groupBy(key.alias("key")).agg(F.max_by(value, F.col(order)).alias("value"))


def id_maps(channels: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Long and short ids and lower-case names -> value of the channel."""
    v = channels.join(values, "id")
    keys = F.array(F.col("id"), F.replace("id", F.lit(".in"), F.lit("")), F.lower("name"))
    return last_wins(v.select("_ord", value, F.explode(F.array_distinct(keys)).alias("k")), F.col("k"), F.col(value))


def all_languages(feeds: DataFrame) -> DataFrame:
    """channel -> sorted set of the languages of all its feeds."""
    e = feeds.select("channel", F.explode(F.split(T.text("languages"), ";")).alias("c")).select("channel", T.language_of_code(F.trim("c")).alias("language"))
    return e.where("language IS NOT NULL").groupBy("channel").agg(F.sort_array(F.collect_set("language")).alias("languages"))


def websites(channels: DataFrame) -> DataFrame:
    return channels.where(T.text("website") != "").select("website").distinct().orderBy("website")


def sampled_ok(entries: DataFrame, key: str, order: str, ok: str, first: int) -> DataFrame:
    """Per key, how many of the first few entries are good."""
    w = Window.partitionBy(key).orderBy(order)
    return entries.withColumn("r", F.row_number().over(w)).where(F.col("r") <= first).groupBy(key).agg(F.sum(F.col(ok).cast("long")).alias("ok"), F.count("*").alias("sampled"))


def source_keys(channels: DataFrame) -> DataFrame:
    """Distinct quality-free keys of the names."""
    return channels.select(T.coverage_key("name").alias("key")).where("key <> ''").distinct()
