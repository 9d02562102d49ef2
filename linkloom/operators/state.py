"""The verdict store: time to live, upserts, merges, strikes and outcomes; breakers and throttles as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.config import Config
from linkloom.functions.text import text
from linkloom.operators.rank import first_per_key


def ttl(status: Column, cfg: Config) -> Column:
    return F.when(status == "ok", cfg.ttl_ok_s).when(status == "blocked", cfg.ttl_blocked_s).when(status == "vod", cfg.ttl_vod_s).otherwise(cfg.ttl_dead_s)


def is_alive(status: Column, checked_at: Column, cfg: Config) -> Column:
    return F.lit(cfg.now) - checked_at < ttl(status, cfg)


def status_of(ok: Column, blocked: Column, vod: Column) -> Column:
    return F.when(vod, "vod").when(ok, "ok").when(blocked, "blocked").otherwise("dead")


def latest(verdicts: DataFrame, *tie: str) -> DataFrame:
    """The newest verdict of each URL; equal times by the tie columns, highest last."""
    return first_per_key(verdicts, ["url"], [F.col("checked_at").desc(), *[F.col(c).desc() for c in tie]])


def upsert(store: DataFrame, new: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """Newer rows replace older ones of the same key; of equal age the new side wins."""
    both = store.withColumn("__n", F.lit(0)).unionByName(new.withColumn("__n", F.lit(1)))
    return first_per_key(both, keys, [F.col(stamp).desc(), F.col("__n").desc()]).drop("__n")


def merge_import(store: DataFrame, imported: DataFrame, cfg: Config, statuses: tuple[str, ...] = ("ok", "dead", "blocked", "vod")) -> DataFrame:
    """Imported verdicts of known status that are alive replace strictly older ones and keep their own time."""
    new = imported.where(F.col("status").isin(*statuses) & is_alive(F.col("status"), F.col("checked_at"), cfg))
    both = store.withColumn("__n", F.lit(1)).unionByName(new.withColumn("__n", F.lit(0)))
    return first_per_key(both, ["url"], [F.col("checked_at").desc(), F.col("__n").desc()]).drop("__n")


def prune(store: DataFrame, cfg: Config) -> DataFrame:
    return store.where(is_alive(F.col("status"), F.col("checked_at"), cfg))


def recent_dead(store: DataFrame, cfg: Config) -> DataFrame:
    return store.where((F.col("status") == "dead") & (F.col("checked_at") > cfg.now - cfg.recent_dead_s))


def suspects(stored: DataFrame, store: DataFrame, cfg: Config) -> DataFrame:
    """Stored rows to check again: no live verdict, or dead or vod, or ok for over a day."""
    v = store.select("url", F.col("status").alias("__s"), F.col("checked_at").alias("__t"))
    q = stored.join(v, "url", "left")
    due = F.col("__s").isNull() | ~is_alive(F.col("__s"), F.col("__t"), cfg) | F.col("__s").isin("dead", "vod") | ((F.col("__s") == "ok") & (F.lit(cfg.now) - F.col("__t") > 86400.0))
    return q.where(due).select(*stored.columns)


def strikes(history: DataFrame, cfg: Config, *tie: str) -> DataFrame:
    """Verdict history with prev_status, prev_at and `second_strike`: dead again, the strike gap or more after a dead one."""
    w = Window.partitionBy("url").orderBy("checked_at", *tie)
    h = history.withColumns({"prev_status": F.lag("status").over(w), "prev_at": F.lag("checked_at").over(w)})
    hit = (F.col("status") == "dead") & (F.col("prev_status") == "dead") & (F.col("checked_at") - F.col("prev_at") >= cfg.strike_gap_s)
    return h.withColumn("second_strike", F.coalesce(hit, F.lit(False)))


def outcome(*, definitive: Column, vod_inferred: Column, ok: Column, blocked: Column, prev_status: Column, prev_age_s: Column, cfg: Config, final: bool = False) -> Column:
    """What a second look at a stored row leads to: drop or keep.  final: unverified rows go too, walled ones stay."""
    again = prev_age_s >= cfg.strike_gap_s
    clip = vod_inferred & (prev_status == "vod") & again
    twice = (prev_status == "dead") & again
    last = F.lit("drop_unverified" if final else "keep_first_failure")
    return F.when(definitive, "drop_definitive").when(F.coalesce(clip, F.lit(False)), "drop_clip").when(ok, "keep_ok").when(blocked, "keep_blocked").when(F.coalesce(twice, F.lit(False)), "drop_second").otherwise(last)


def breaker_runs(calls: DataFrame, key: str, order: list[str], hit: Column, cfg: Config) -> DataFrame:
    """Runs of misses per key: gaps and islands.  `trips`: the run reaches the limit at this call."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    c = calls.withColumn("__hit", F.coalesce(hit.cast("int"), F.lit(0))).withColumn("__island", F.sum("__hit").over(w))
    run = F.sum(1 - F.col("__hit")).over(Window.partitionBy(key, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return c.withColumn("misses", run).withColumn("trips", (F.col("misses") == cfg.breaker_misses) & (F.col("__hit") == 0)).drop("__hit", "__island")


def breaker_exact(calls: DataFrame, key: str, ts: str, order: str, hit: str, cfg: Config) -> DataFrame:
    """The sequential form with cooldown: calls within it are skipped and not counted.  key, ts, order, skipped, misses.

    A fold over each key's calls, row by row, as each depends on what went before; rows stream in time order and only the
    state of the current key is held.
    """
    import pyarrow as pa

    limit, rest = cfg.breaker_misses, cfg.breaker_cooldown_s
    rows = calls.select(F.col(key).cast("string").alias("k"), F.col(ts).cast("double").alias("t"), F.col(order).cast("long").alias("o"), F.col(hit).cast("boolean").alias("h"))

    def run(batches):
        at, misses, until = None, 0, 0.0
        for b in batches:
            skipped, count = [], []
            for k, t, h in zip(*(b.column(c).to_pylist() for c in ("k", "t", "h")), strict=True):
                if k != at:
                    at, misses, until = k, 0, float("-inf")
                skip = t < until
                if not skip:
                    misses = 0 if h else misses + 1
                    if misses >= limit:
                        misses, until = 0, t + rest
                skipped.append(skip)
                count.append(misses)
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("t"), b.column("o"), pa.array(skipped, pa.bool_()), pa.array(count, pa.int64())], ["k", "t", "o", "skipped", "misses"])

    out = rows.repartition("k").sortWithinPartitions("k", "t", "o").mapInArrow(run, "k string, t double, o long, skipped boolean, misses long")
    return out.toDF(key, ts, order, "skipped", "misses")


def throttled(calls: DataFrame, key: str, ts: Column, order: list[str], gap_s: float) -> DataFrame:
    """When each call may start, `gap_s` apart per key: a running maximum instead of a sequential fold."""
    w = Window.partitionBy(key).orderBy(*order)
    n = F.row_number().over(w) - 1
    return calls.withColumn("slot", F.max(ts - F.lit(gap_s) * n).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.lit(gap_s) * n)


def within_budget(rows: DataFrame, key: str | None, order: list, cap: int) -> DataFrame:
    """The first `cap` rows, of each key or of all."""
    if not key:
        return rows.orderBy(*order).limit(cap)
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= cap).drop("__r")


def pending(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work that an interrupted run has left."""
    return items.select(*keys).distinct().join(done.select(*keys).distinct(), keys, "left_anti")


def exit_code(run: DataFrame) -> DataFrame:
    code = F.when(F.size("errors") > 0, 1).when(F.col("urls_valid") == 0, 1).when(F.col("incomplete"), 3).otherwise(0)
    return run.withColumn("exit_code", code)


def engine_summary(calls: DataFrame) -> DataFrame:
    """Per engine: calls, hits, misses and hit rate."""
    h = F.sum(F.col("hit").cast("long"))
    return calls.groupBy("engine").agg(F.count("*").alias("calls"), h.alias("hits"), (F.count("*") - h).alias("misses"), F.bround(100.0 * h / F.count("*"), 1).alias("hit_pct"))


def drop_keys(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that stay, and (url, reason) of those that go."""
    r = rows.withColumn("__why", reason)
    return r.where(F.col("__why").isNull()).drop("__why"), r.where(F.col("__why").isNotNull()).select(text("url").alias("url"), F.col("__why").alias("reason"))


def stored_channels(store: DataFrame, lang: str | None = None) -> DataFrame:
    """Stored rows in the order they were kept, of one language or by language."""
    return store.orderBy("lang", "updated_at", "url") if lang is None else store.where(F.col("lang") == lang).orderBy("updated_at", "url")


def clear_language(store: DataFrame, lang: str) -> DataFrame:
    return store.where(F.col("lang") != lang)


def shared_dead(verdicts: DataFrame, listed: DataFrame, cfg: Config) -> DataFrame:
    """URLs that sibling runs know to be dead: listed ones, and live dead verdicts."""
    own = verdicts.where((F.col("status") == "dead") & is_alive(F.col("status"), F.col("checked_at"), cfg)).select("url")
    return listed.select("url").unionByName(own).distinct()
