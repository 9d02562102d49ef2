"""Writers: ordered playlists, partitioned publishing, state lines, lists and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions.text import file_name, text
from linkloom.operators.rank import playlist_order


def m3u_entry(safe: bool = False) -> Column:
    """The two lines of a row.  safe: quotes in attributes become apostrophes and commas in names stay readable."""
    fix = (lambda c: F.replace(text(c), F.lit('"'), F.lit("'"))) if safe else text
    logo = F.when(text("logo") != "", F.concat(F.lit(' tvg-logo="'), fix("logo"), F.lit('"'))).otherwise("")
    return F.concat(F.lit('#EXTINF:-1 tvg-name="'), fix("name"), F.lit('"'), logo, F.lit(' group-title="'), fix("category"), F.lit('",'), text("name"), F.lit("\n"), text("url"))


def write_m3u(channels: DataFrame, path: str, safe: bool = False) -> None:
    """One ordered text file with a header.  The format is one file, so one task sorts (spilling if need be) and writes."""
    spark = channels.sparkSession
    order = playlist_order()
    keys = [f"k{i}" for i in range(len(order))]
    plain = [F.lower(text("category")), -F.col("score").cast("long"), F.lower(text("name")), F.col("_ord").cast("long")]
    body = channels.select(F.lit(1).alias("part"), *[c.alias(k) for c, k in zip(plain, keys, strict=True)], m3u_entry(safe).alias("value"))
    head = spark.createDataFrame([(0, K.M3U_HEADER)], "part int, value string")
    both = head.unionByName(body, allowMissingColumns=True).repartition(1).sortWithinPartitions("part", *keys)
    both.select("value").write.mode("overwrite").text(path)


def with_files(channels: DataFrame) -> DataFrame:
    """language_file and source_file: the partition each row is published in."""
    lang, src = (F.when(text(c) == "", d).otherwise(text(c)) for c, d in (("language", "Other"), ("source", "other")))
    return channels.withColumns({"language_file": file_name(lang), "source_file": file_name(src)})


def publish(channels: DataFrame, folder: str, language: str = "All", safe: bool = False) -> None:
    """All: the combined list, and partitions by language and by source, each ordered.  One language: its list only."""
    if channels.isEmpty():
        return
    if language != "All":
        write_m3u(channels, f"{folder}/{language.lower().replace(' ', '_')}", safe)
        return
    write_m3u(channels, f"{folder}/all", safe)
    rows = with_files(channels)
    for column, sub in (("language_file", "language"), ("source_file", "source")):
        # a hot language is split over several files; each is in order, and names of files keep the order of ranges
        dealt = rows.repartitionByRange(F.col(column), *playlist_order()).sortWithinPartitions(column, *playlist_order())
        dealt.select(m3u_entry(safe).alias("value"), F.col(column).alias(sub)).write.mode("overwrite").partitionBy(sub).text(f"{folder}/{sub}")


def state_lines(verdicts: DataFrame, channels: DataFrame) -> DataFrame:
    """JSON lines of live verdicts and of a language's channels."""
    v = verdicts.select(F.to_json(F.struct(F.lit("probe").alias("t"), *verdicts.columns)).alias("value"))
    c = channels.select(F.to_json(F.struct(F.lit("channel").alias("t"), *channels.columns)).alias("value"))
    return v.unionByName(c)


def replace_language(channels: DataFrame, path: str) -> None:
    """Replaces only the languages that occur in the rows."""
    channels.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lang").parquet(path)


def language_lists(rows: DataFrame) -> DataFrame:
    """language, total, channels: one record per pipeline language, names in order."""
    e = rows.select("*", F.explode("languages").alias("language")).where(F.col("language").isin(*K.PIPELINE_LANGUAGES))
    item = F.struct("name", "languages", "categories")
    return e.groupBy("language").agg(F.count("*").alias("total"), F.sort_array(F.collect_list(item)).alias("channels"))


def write_language_lists(rows: DataFrame, folder: str, timestamp: str) -> None:
    lists = language_lists(rows).withColumn("timestamp", F.lit(timestamp)).withColumn("file", file_name("language"))
    lists.select("timestamp", "language", "total", "channels", "file").write.mode("overwrite").partitionBy("file").json(folder)


def coverage_markdown(report: DataFrame, group: str) -> DataFrame:
    line = F.concat(F.lit("| "), F.col(group), F.lit(" | "), F.col("found"), F.lit(" / "), F.col("total"), F.lit(" | "), F.format_number("pct", 1), F.lit("% |"))
    return report.orderBy(group).select(line.alias("value"))


def coverage_json(report: DataFrame, missing: DataFrame, group: str, least: float = 50.0, names: int = 100) -> DataFrame:
    """One JSON line: totals, percentages by group, groups under the limit, and the first missing names.  The report has a row a group."""
    per = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(group), F.struct("found", "missing", "total", "pct")))))
    low = F.sort_array(F.collect_list(F.when(F.col("pct") < least, F.col(group))))
    pct = F.when(F.sum("total") > 0, F.bround(100.0 * F.sum("found") / F.sum("total"), 1)).otherwise(0.0)
    total = report.agg(F.coalesce(F.sum("found"), F.lit(0)).alias("found"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"), pct.alias("pct"), per.alias("languages"), low.alias("low"))
    first = missing.select(F.explode("missing").alias("n")).distinct().orderBy("n").limit(names).agg(F.sort_array(F.collect_list("n")).alias("missing_names"))
    return total.join(F.broadcast(first)).select(F.to_json(F.struct("found", "missing", "total", "pct", "languages", "low", "missing_names")).alias("value"))


def total_coverage(report: DataFrame, least: float = 50.0) -> DataFrame:
    """Overall percentage from the sums, and whether it is under the limit."""
    pct = F.bround(100.0 * F.sum("found") / F.sum("total"), 1)
    return report.agg(F.sum("total").alias("total"), F.sum("found").alias("found"), pct.alias("pct"), (pct < least).alias("warn"))
