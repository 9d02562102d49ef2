"""Registration of queries, and the tables they use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (read, spark), where read(name) is a table, under its own name."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

        run.__doc__, run.__name__ = f.__doc__, f.__name__
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def channels(part: DataFrame) -> DataFrame:
    """Parts read as channel rows."""
    price = F.col("p_retailprice")
    return part.select(
        F.col("p_partkey").alias("_ord"), F.col("p_name").alias("name"),
        F.concat(F.lit("http://h"), F.col("p_partkey") % 40, F.lit(".example.com/live/"), F.replace(F.lower("p_type"), F.lit(" "), F.lit("-")), F.lit("/"), F.col("p_size") % 5, F.when(F.col("p_partkey") % 2 == 0, "/").otherwise("")).alias("url"),
        F.col("p_type").alias("extinf"), F.col("p_brand").alias("group_title"), F.col("p_size").alias("score"),
        F.when(price >= 1500, "1080p").when(price >= 1200, "720p").when(price >= 1000, "480p").when(price >= 950, "240p").otherwise("").alias("quality"),
        F.when(F.col("p_partkey") % 3 == 0, "logo").otherwise("").alias("logo"), F.when(F.col("p_partkey") % 5 == 0, "id").otherwise("").alias("tvg_id"),
        F.when(F.col("p_partkey") % 11 == 0, "Given").otherwise("").alias("category"), F.lit("").alias("language"),
    )


CHANNELS = """
channels AS (
  SELECT p_partkey AS _ord, p_name AS name,
         'http://h' || (p_partkey % 40) || '.example.com/live/' || replace(lower(p_type), ' ', '-') || '/' || (p_size % 5) || CASE WHEN p_partkey % 2 = 0 THEN '/' ELSE '' END AS url,
         p_type AS extinf, p_brand AS group_title, p_size AS score,
         CASE WHEN p_retailprice >= 1500 THEN '1080p' WHEN p_retailprice >= 1200 THEN '720p' WHEN p_retailprice >= 1000 THEN '480p' WHEN p_retailprice >= 950 THEN '240p' ELSE '' END AS quality,
         CASE WHEN p_partkey % 3 = 0 THEN 'logo' ELSE '' END AS logo, CASE WHEN p_partkey % 5 = 0 THEN 'id' ELSE '' END AS tvg_id,
         CASE WHEN p_partkey % 11 = 0 THEN 'Given' ELSE '' END AS category
  FROM part
), ranked AS (
  SELECT *, CASE quality WHEN '1080p' THEN 4 WHEN '720p' THEN 3 WHEN '480p' THEN 1 ELSE 0 END AS q, (logo <> '')::INT AS l, (tvg_id <> '')::INT AS t,
         CASE quality WHEN '1080p' THEN 'fhd' WHEN '720p' THEN 'hd' WHEN '480p' THEN 'sd' WHEN '240p' THEN 'low' ELSE 'unknown' END AS tier,
         lower(regexp_replace(trim(url), '/+$', '')) AS k
  FROM channels
)"""


def verdicts(events: DataFrame) -> DataFrame:
    """Events read as verdicts: a user is a URL, a type is a status."""
    status = F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type") == "error", "dead").when(F.col("event_type") == "signup", "vod").when(F.col("event_type") == "click", "blocked").otherwise("ok")
    return events.select("event_id", F.concat(F.lit("u"), F.col("user_id")).alias("url"), status.alias("status"), F.unix_seconds(F.col("ts").cast("timestamp")).cast("double").alias("checked_at"))


VERDICTS = """
v AS (
  SELECT event_id, 'u' || user_id AS url,
         CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'dead' WHEN 'signup' THEN 'vod' WHEN 'click' THEN 'blocked' ELSE 'ok' END AS status,
         floor(epoch(ts))::DOUBLE AS checked_at
  FROM events
)"""
#: The end of the events' time, as seconds.
NOW = 1706659200.0
