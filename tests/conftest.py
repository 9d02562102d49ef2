import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("rdd")))
    yield s
    s.stop()


DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = DATA / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p / '*.parquet' if p.is_dir() else p}'")
    return con


def rows(frame):
    """Order-free rows of a pandas frame, columns by name."""
    cols = sorted(frame.columns)
    f = frame[cols].astype(object)
    f = f.where(f.notna(), None)
    return cols, sorted(map(repr, f.values.tolist()))
