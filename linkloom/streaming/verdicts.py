"""Structured Streaming forms of the verdict store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from linkloom.config import Config
from linkloom.operators.state import upsert

VERDICTS = "url string, status string, checked_at double"


def _strike(cfg: Config):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values("checked_at", kind="stable")
        status, at = state.get if state.exists else (None, None)
        out = []
        for s, t in zip(rows["status"], rows["checked_at"], strict=True):
            if at is not None and t < at:  # late: the newer verdict stands
                out.append((key[0], s, t, None, None, False))
                continue
            out.append((key[0], s, t, status, at, s == "dead" and status == "dead" and t - at >= cfg.strike_gap_s))
            status, at = s, t
        state.update((status, at))
        yield pd.DataFrame(out, columns=["url", "status", "checked_at", "prev_status", "prev_at", "second_strike"]).astype({"prev_at": "float64"})

    return step


def strikes(stream: DataFrame, cfg: Config) -> DataFrame:
    """Each verdict with the one before it and whether it is a second strike; state is one verdict per URL."""
    schema = "url string, status string, checked_at double, prev_status string, prev_at double, second_strike boolean"
    return stream.groupBy("url").applyInPandasWithState(_strike(cfg), schema, "status string, checked_at double", "append", GroupStateTimeout.NoTimeout)


def closed_windows(events: DataFrame, ts: str, key: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts of tumbling windows that the watermark has closed."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def store_writer(path: str, spark):
    """A foreachBatch function that keeps the newest verdict of each URL in a two-version table: a batch replayed after a
    failure writes the same rows again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fs = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        old = fs.Path(f"{path}/v{batch_id - 1}")
        new = batch.select(*[c.split()[0] for c in VERDICTS.split(", ")])
        from linkloom.operators.state import latest

        new = latest(new, "status")
        if old.getFileSystem(conf).exists(old):
            new = upsert(spark.read.schema(VERDICTS).parquet(old.toString()), new, ["url"], "checked_at")
        new.write.mode("overwrite").parquet(f"{path}/v{batch_id}")
        older = fs.Path(f"{path}/v{batch_id - 2}")
        older.getFileSystem(conf).delete(older, True)

    return write
