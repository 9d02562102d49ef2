"""Readers of captured files.  Each keeps a deterministic order column `_ord` where order decides ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom import schemas as S
from linkloom.functions import parse as P
from linkloom.functions.gates import is_regional
from linkloom.functions.text import coverage_key, fallback, norm_name, text
from linkloom.functions.urls import is_blocked_domain, is_http
from linkloom.operators.rank import first_per_key


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def csv_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A CSV with header, every column a string, missing text empty, in file order; empty if the file is absent."""
    schema = S.CSV[name]
    path = f"{folder.rstrip('/')}/{name}.csv"
    if not exists(spark, path):
        return spark.createDataFrame([], schema + ", _ord long")
    df = spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"', mode="PERMISSIVE")
    # one file is one partition here (multiLine), so ids follow the lines
    return df.fillna("").withColumn("_ord", F.monotonically_increasing_id())


def database(spark: SparkSession, folder: str, suffix: str = ".in") -> dict[str, DataFrame]:
    """All tables of the reference data; channels, feeds and logos only of the country suffix, filtered at the scan."""
    out = {n: csv_table(spark, folder, n) for n in S.CSV}
    out["channels"] = out["channels"].where(F.col("id").endswith(suffix)).withColumn("is_nsfw", F.col("is_nsfw") == "TRUE")
    for n in ("feeds", "logos"):
        out[n] = out[n].where(F.col("channel").endswith(suffix))
    return out


def blocklist(channels: DataFrame, listed: DataFrame) -> DataFrame:
    """Ids that are listed as unfit, marked so, or of the adult category."""
    by_list = listed.where(F.lower(F.trim("reason")) == "nsfw").select(F.col("channel").alias("id"))
    own = channels.where(F.col("is_nsfw") | F.array_contains(F.split(F.lower("categories"), ";"), "xxx")).select("id")
    return by_list.unionByName(own).distinct()


def target_list(spark: SparkSession, path: str, language: str | None = None) -> DataFrame:
    """Rows of a target list; of the merged one, those of a language."""
    raw = spark.read.schema(S.TARGETS).json(path, multiLine=True)
    rows = raw.select("language", F.posexplode("channels").alias("_ord", "c")).select("_ord", "language", "c.name", "c.languages", "c.categories")
    return rows if language in (None, "All") else rows.where(F.array_contains("languages", language))


def targets(spark: SparkSession, folder: str, language: str = "All", merged: str = "all_channels.json") -> DataFrame:
    """The language's own list, else the rows of the merged list that name the language."""
    own = f"{folder.rstrip('/')}/{language.lower()}_channels.json"
    if language != "All" and exists(spark, own):
        return target_list(spark, own)
    return target_list(spark, f"{folder.rstrip('/')}/{merged}", language)


def platforms(spark: SparkSession, path: str) -> DataFrame:
    """Distinct platform names, the first spelling of each, in order."""
    raw = spark.read.schema(S.PLATFORMS).json(path, multiLine=True)
    rows = raw.select(F.posexplode("platforms").alias("_ord", "p")).select("_ord", F.trim("p.name").alias("name"), "p.entity").where("name <> ''")
    return first_per_key(rows, [F.lower("name")], ["_ord"])


def stream_rows(spark: SparkSession, path: str, blocked: DataFrame | None = None, suffix: str = ".in") -> DataFrame:
    """Rows of a streams feed: http, of the suffix, not blocked."""
    rows = spark.read.schema(S.STREAM_ROWS).json(path, multiLine=True).fillna("")
    rows = rows.where(is_http("url") & F.col("channel").endswith(suffix))
    return rows if blocked is None else rows.join(blocked.select(F.col("id").alias("channel")), "channel", "left_anti")


def playlists(docs: DataFrame, doc: str = "doc", drop_blocked: bool = True) -> DataFrame:
    """Entries of captured playlists: docs' columns, pos, url, name, extinf, attrs."""
    rows = docs.where(P.is_list_feed(doc)).withColumn("e", F.explode(P.extinf_entries(doc)))
    rows = rows.withColumn("x", P.parse_extinf(F.col("e.extinf"))).select(*[c for c in docs.columns if c != doc], "e.pos", "e.url", "x.name", "e.extinf", "x.attrs")
    return rows.where(~is_blocked_domain("url")) if drop_blocked else rows


def read_m3u(spark: SparkSession, path: str) -> DataFrame:
    """Published playlists, one row an entry."""
    docs = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("doc"))
    return docs.withColumn("e", F.explode(P.extinf_entries("doc"))).select("file", "e.pos", "e.url", "e.extinf", _name_of("e.extinf").alias("name"))


def _name_of(extinf: str):
    """The writer's inverse: the name after the comma for which the line also starts with that tvg-name."""
    line = F.col(extinf)
    tail = F.regexp_extract(line, r'^#EXTINF:-1 tvg-name="(.*?)"(?: tvg-logo="[^"]*")? group-title="[^"]*".*,\1$', 1)
    return F.when(tail != "", tail).otherwise(P.parse_extinf(line)["name"])


def relevant(candidates: DataFrame, names: DataFrame) -> DataFrame:
    """Candidates whose name is known, or whose name, info or URL is of the region."""
    keys = names.select(coverage_key("name").alias("k")).where("k <> ''").distinct()
    c = candidates.withColumn("k", coverage_key("name"))
    hit = c.join(keys.withColumn("known", F.lit(True)), "k", "left")
    return hit.where(F.coalesce("known", F.lit(False)) | is_regional("name") | is_regional("extinf") | is_regional("url")).drop("k", "known")


def capped_files(files: DataFrame, per_repo: int = 6, repos: int = 14, total: int = 40) -> DataFrame:
    """repo, path -> playlist files, without test fixtures, few of each repository."""
    p = F.lower("path")
    ok = files.where(p.rlike(r"\.m3u8?$") & ~(p.contains("test") & p.contains("fixture")))
    ok = ok.withColumn("r", F.row_number().over(Window.partitionBy("repo").orderBy("path"))).where(F.col("r") <= per_repo)
    first = ok.select("repo").distinct().orderBy("repo").limit(repos)
    return ok.join(F.broadcast(first), "repo", "left_semi").orderBy("repo", "path").limit(total).drop("r")


TABLE_SCHEMA = "pos int, cells array<string>"


def html_rows(markup: str, table_id: str | None = None, least: int = 1) -> list[tuple[int, list[str]]]:
    """Rows of a table (by id, else the first) with `least` data cells or more."""
    import re
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.rows, self.cell, self.depth, self.done = [], None, 0, False

        def handle_starttag(self, tag, attrs):
            if tag == "table" and not self.done:
                if self.depth or table_id is None or dict(attrs).get("id") == table_id:
                    self.depth += 1
            elif self.depth and tag == "tr":
                self.rows.append([])
            elif self.depth and tag == "td" and self.rows:
                self.cell = []

        def handle_data(self, data):
            if self.cell is not None:
                self.cell.append(data)

        def handle_endtag(self, tag):
            if tag == "td" and self.cell is not None:
                self.rows[-1].append(re.sub(r"\s+", " ", "".join(self.cell)).strip())
                self.cell = None
            elif tag == "table" and self.depth:
                self.depth -= 1
                self.done = self.depth == 0

    r = Reader()
    r.feed(markup or "")
    return [(i, c) for i, c in enumerate(r.rows) if len(c) >= least]


def html_table(docs: DataFrame, column: str, table_id: str | None = None, least: int = 1) -> DataFrame:
    """docs' other columns, pos and cells, by an Arrow-batched parser."""
    f = F.pandas_udf(lambda s: s.map(lambda x: [{"pos": p, "cells": c} for p, c in html_rows(x, table_id, least)]), f"array<struct<{TABLE_SCHEMA.replace(' int', ': int').replace('cells ', 'cells: ')}>>")
    return docs.withColumn("r", F.explode(f(column))).select(*[c for c in docs.columns if c != column], "r.pos", "r.cells")


def satellite_rows(docs: DataFrame, column: str = "html") -> DataFrame:
    """The permitted-channels table: rows of ten cells or more, named columns."""
    rows = html_table(docs, column, "satellite", 10)
    names = {"company": 1, "name": 2, "language_raw": 3, "category_raw": 6, "satellite_type": 7, "permission_type": 8, "remarks": 9}
    return rows.select("pos", *[F.get("cells", i).alias(n) for n, i in names.items()])


def platform_rows(docs: DataFrame, column: str = "html") -> DataFrame:
    """The platforms table: three cells or more, a serial number first."""
    rows = html_table(docs, column, None, 3).where(F.get("cells", 0).rlike(r"^\d+$"))
    return rows.select(F.get("cells", 0).cast("bigint").alias("s_no"), F.get("cells", 1).alias("name"), F.get("cells", 2).alias("entity"))


LOGO_KEYS = ("channelLogo", "logo", "logoUrl", "imageUrl", "posterUrl", "icon")


def catalog_entries(payload: str) -> list[dict]:
    """Every object at any depth that has a detail path and a channel name; the first of each path."""
    import json

    try:
        root = json.loads(payload or "null")
    except ValueError:
        return []
    out, stack = {}, [root]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            if x.get("detailPagePath") and x.get("channelName"):
                logo = next((str(x[k]) for k in LOGO_KEYS if x.get(k)), "")
                out.setdefault(str(x["detailPagePath"]), {"path": str(x["detailPagePath"]), "name": str(x["channelName"]), "lang_code": str(x.get("langCode") or ""), "logo": logo})
            stack += reversed(list(x.values()))
        elif isinstance(x, list):
            stack += reversed(x)
    return list(out.values())


def catalog(payloads: DataFrame, column: str = "json", lang_code: str | None = None) -> DataFrame:
    """path, name, lang_code, logo of a catalogue of unknown depth."""
    f = F.pandas_udf(lambda s: s.map(catalog_entries), "array<struct<path: string, name: string, lang_code: string, logo: string>>")
    order = F.col("_ord") if "_ord" in payloads.columns else F.md5(column)  # without an order of payloads, one that reruns repeat
    rows = payloads.select(order.alias("o"), F.posexplode(f(column)).alias("p", "e")).select("o", "p", "e.*")
    rows = rows if lang_code is None else rows.where(F.col("lang_code") == lang_code)
    return first_per_key(rows, ["path"], ["o", "p"]).drop("o", "p")


def stream_urls(payloads: DataFrame, column: str = "json", cap: int = 2) -> DataFrame:
    """path, url, place of captured stream answers: the first `cap` http URLs of each; none where access is denied."""
    s = F.from_json(F.col(column), "response struct<streamStatus: struct<hasAccess: boolean>, streams: array<struct<url: string>>>")
    rows = payloads.withColumn("s", s).where(F.coalesce(F.col("s.response.streamStatus.hasAccess"), F.lit(True)))
    http = F.filter(F.transform("s.response.streams", lambda x: x["url"]), lambda u: is_http(u))
    return rows.select("path", F.posexplode(F.slice(http, 1, cap)).alias("place", "url")).select("path", "url", "place")


def state_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Verdicts and channels of exported state: a line without a tag is a verdict."""
    rows = spark.read.schema(S.STATE_LINE).option("recursiveFileLookup", "true").json(path, pathGlobFilter="*.jsonl")
    tag = F.coalesce("t", F.lit("probe"))
    verdicts = rows.where(tag == "probe").select(*[c.split()[0] for c in S.VERDICT.split(", ")])
    channels = rows.where(tag == "channel").select("lang", *[c.split()[0] for c in S.CHANNEL.split(", ")], "updated_at")
    return verdicts, channels


def dead_urls(spark: SparkSession, path: str) -> DataFrame:
    """URLs of plain-text dead lists."""
    rows = spark.read.option("recursiveFileLookup", "true").text(path, pathGlobFilter="*.txt")
    return rows.select(F.trim("value").alias("url")).where(is_http("url")).distinct()


def responses(df: DataFrame, cap: int = 2_000_000) -> DataFrame:
    """Captured responses ready for classification: body cut, text decoded, transport errors and statuses from 400 on
    (but 403 and 503) marked unreachable."""
    body = F.substring("body", 1, cap)
    ok = F.col("status").isNotNull() & ((F.col("status") < 400) | F.col("status").isin(403, 503))
    ct = F.lower(fallback(F.col("headers")["content-type"], F.col("headers")["Content-Type"]))
    return df.withColumns({"body": body, "text": F.decode(body, "UTF-8"), "content_type": ct, "reachable": ok, "final_url": fallback(F.col("final_url"), F.col("url"))})


def check_columns(df: DataFrame, expected: list[str], least_rows: int = 1) -> DataFrame:
    """One row: missing columns, number of rows, and whether both are as they should be."""
    missing = [c for c in expected if c not in df.columns]
    ok = F.lit(not missing) & (F.count("*") >= least_rows)
    return df.agg(F.lit(",".join(missing)).alias("missing"), F.count("*").alias("rows"), ok.alias("ok"))


def is_fresh(stamp: str, now: float, ttl_s: float = 86400.0):
    """A cached list's ISO time stamp is younger than the limit."""
    return F.coalesce(F.lit(now) - F.unix_seconds(F.try_to_timestamp(F.col(stamp))) < ttl_s, F.lit(False))


def match_index(channels: DataFrame) -> DataFrame:
    """Distinct names, canonical and other names of a list with their match keys."""
    from linkloom.operators.match import with_keys

    cols = [c for c in ("name", "canonical_name") if c in channels.columns]
    every = F.concat(F.array(*[F.col(c) for c in cols]), F.split(text("alt_names"), ";") if "alt_names" in channels.columns else F.array().cast("array<string>"))
    rows = channels.select(F.explode(every).alias("n")).select(F.lower(F.trim("n")).alias("name")).where("name <> ''").distinct()
    return with_keys(rows.where(norm_name("name") != ""), "name")
