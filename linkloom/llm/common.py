"""What the operators of this subpackage share: column picking, shared-folder tables, Arrow text access,
and the sampled range router that deals hash records out with a secondary order."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.ship import ship

#: Stands for a null doc_id in internal keys, so that null ids sort last.
NO_ID = 2**63 - 1
#: Rows a sampling job may bring to the driver to place range splitters.  It only affects balance, never results.
SAMPLE_DOCS = 1500
SAMPLE_PER_DOC = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under new names.

    Columns are taken by position, so other columns may have any name: dots, other case, repeats or the names used inside
    an operator.  An exact match wins over one that differs in case; the first of equal names wins.
    """
    ship(df.sparkSession)
    names = df.columns
    lower = [c.lower() for c in names]
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    at = {}
    for new, old in cols.items():
        if old in names:
            at[new] = names.index(old)
        elif old.lower() in lower:
            at[new] = lower.index(old.lower())
        else:
            raise ValueError(f"no column {old!r} among {names}")
    return flat.select(*[F.col(f"c{i}").alias(new) for new, i in at.items()])


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (null: empty) and the row key: doc (the id, null last) and th (a hash of the text).

    Rows that agree in id and text are the same document given twice; they get the same result.
    """
    d = pick(docs, doc_id=id_col, text=text_col)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return d.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("th"))


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """docs with its columns renamed c0, c1, ... plus doc and th, and a function that gives a result its own columns back."""
    ship(docs.sparkSession)
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {k: f"c{names.index(k)}" for k in (id_col, text_col)}
    text = F.coalesce(F.col(at[text_col]).cast("string"), F.lit(""))
    wide = flat.withColumns({"doc": F.coalesce(F.col(at[id_col]).cast("long"), F.lit(NO_ID)), "th": F.xxhash64(text)})
    return wide, lambda out: out.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a folder of our own only where none is set, as in tests."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not (own := spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir("/tmp/checkpoints")
        own = spark.sparkContext.getCheckpointDir()
    return own.rstrip("/")


def stored(df: DataFrame, label: str = "part") -> DataFrame:
    """Writes to the shared folder and reads back: cuts lineage and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/linkloom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._linkloom_path = path
    return out


#: Fewer documents than these, or rows of a few numbers, are not worth a task and a file of their own.
DOCS_A_TASK, ROWS_A_TASK = 2048, 20_000


def sized(df: DataFrame, rows: int, a_task: int = DOCS_A_TASK) -> DataFrame:
    """df in no more tasks than so many rows need, but two for each core: for small data in many partitions.  Each file and folder
    costs requests to the store; for plain folders Hadoop starts a process for each, and a child of the JVM counts with all of
    its memory until it has begun."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // a_task)))


def packed(df: DataFrame, rows: int, a_task: int = DOCS_A_TASK) -> DataFrame:
    """df, of small rows, shuffled once more by no key into partitions of the advised size, as many as sized() allows: for little
    that comes out of many tasks, which keep their number.  All rows stay."""
    return sized(df.hint("rebalance"), rows, a_task)


def drop_stored(df: DataFrame | None) -> None:
    """Deletes what stored() wrote, once nothing will read it again."""
    path = getattr(df, "_linkloom_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


#: Spark's switch for the files of a query's shuffles to go as the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go with the query that wrote them; else they stay until the driver happens to collect its garbage.  A
    query that is run again shuffles again."""
    known = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if known is None else spark.conf.set(CLEANUP, known)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


# ---- Arrow access -------------------------------------------------------------------------------------------------


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column without nulls, and the offsets of its rows in them, without a copy."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


# ---- ordered dealing ----------------------------------------------------------------------------------------------

KEYS = ("k1", "k2", "doc", "th", "pos")


class Splitters:
    """Range bounds over (k1, k2, doc, th, pos) rows, found in a bounded sample.  Equal k1 may span several ranges, so one
    hot key doesn't land in one task.  weight: how many rows each sampled one stands for."""

    def __init__(self, rows: np.ndarray, n: int, weight: np.ndarray | None = None):
        if not len(rows):
            self.rows = np.zeros((0, len(KEYS)), np.int64)
            return
        order = np.lexsort(rows.T[::-1])
        total = np.cumsum(np.ones(len(rows)) if weight is None else weight[order])
        at = np.searchsorted(total, total[-1] * np.arange(1, n) / n)
        self.rows = rows[order][np.unique(np.minimum(at, len(rows) - 1))]

    def of(self, cols: list[np.ndarray]) -> np.ndarray:
        first = self.rows[:, 0]
        lo, hi = (np.searchsorted(first, cols[0], side=s) for s in ("left", "right"))
        out = lo.astype(np.int32)
        tied = np.flatnonzero(hi > lo)
        if len(tied):  # the key is that of some splitters: a binary search among them by the rest
            own, lo, hi = [c[tied] for c in cols], lo[tied], hi[tied]
            while (open_ := lo < hi).any():
                mid = np.minimum((lo + hi) // 2, len(first) - 1)
                more, equal = np.zeros(len(tied), bool), np.ones(len(tied), bool)
                for c, v in zip(own[1:], self.rows[mid, 1:].T, strict=True):
                    more |= equal & (c > v)
                    equal = equal & (c == v)
                reached = open_ & (more | equal)
                lo, hi = np.where(reached, mid + 1, lo), np.where(open_ & ~reached, mid, hi)
            out[tied] = lo
        return out


def sampled(cols: list[np.ndarray], most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """At most so many of the records, at random by the whole record (so that a hot key has its share), and what each stands for."""
    h = np.zeros(len(cols[0]), np.uint64)
    for c in cols:
        h = (h ^ c.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    keep = h.argsort(kind="stable")[:most]
    return [c[keep] for c in cols], np.full(len(keep), len(h) / max(1, len(keep)))


def splitters(docs: DataFrame, rows_of, per_doc: int = SAMPLE_PER_DOC) -> Splitters:
    """Splitters for as many ranges as there are partitions, from the records of about SAMPLE_DOCS documents (half the number of
    partitions, if that is more), `per_doc` of each on average.  The sample is taken where the documents are read; only its
    keys reach the driver.

    rows_of(batch) returns the five arrays of one Arrow batch.
    """
    n = partitions(docs.sparkSession)
    total, most = docs.count(), max(SAMPLE_DOCS, n // 2)
    few = docs.sample(fraction=min(1.0, most / max(1, total)), seed=11)

    def run(batches):
        for b in batches:
            cols, weight = sampled([c.astype(np.int64) for c in rows_of(b)], per_doc * max(1, b.num_rows))
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(weight)], [*KEYS, "weight"])

    got = few.mapInArrow(run, ", ".join(f"{k} long" for k in KEYS) + ", weight double").toPandas()
    return Splitters(got[list(KEYS)].to_numpy(np.int64), n, got["weight"].to_numpy())


class Runs:
    """Reads the batches of a sorted partition and tells, for each row, whether its (k1, k2) or its k1 is that of the row
    before, over batch borders too."""

    def __init__(self):
        self.last: tuple | None = None

    def read(self, cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """same k1, same (k1, k2), same whole row."""
        out, eq = [], np.ones(len(cols[0]), bool)
        for i, c in enumerate(cols):
            prev = np.empty_like(c)
            prev[1:] = c[:-1]
            prev[0] = self.last[i] if self.last else 0
            eq = eq & (c == prev)
            if not self.last:
                eq[0] = False
            out.append(eq)
        self.last = tuple(c[-1] for c in cols)
        return out[0], out[1], out[-1]
