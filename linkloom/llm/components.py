"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a minimum per node with partial aggregation and an equi-join on the node, so a hub's edges are split by
adaptive skew handling and never gathered.  Each round is written to the shared folder; the driver sees counts only.  First
every task reduces its edges to a spanning forest; once `FEW` edges or fewer are left in all, one task finishes them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common as C

#: Rows of an edge table for each task that writes it.
ROWS_A_FILE = 20_000
#: So many edges are solved by one task, in a few MB of memory.
FEW = 200_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: a > b.  large: every larger neighbour of a node joins the node's least neighbour; small: every smaller one."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        j = edges.join(least, "a")
        out = j.where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """node and root (the least node of its component) of every node of the edges."""
    ids, flat = np.unique(np.r_[a, b], return_inverse=True)
    root = np.arange(len(ids))
    x, y = flat[: len(a)], flat[len(a) :]
    while True:  # the least neighbour's root, then shortcuts, until nothing moves
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return ids, ids[root]
        root = new


def _reduced(batches):
    """The edges of a task as stars, each at most as many as its nodes."""
    held, rows = [], 0
    for batch in batches:
        held.append((C.longs(batch, "a"), C.longs(batch, "b")))
        rows += batch.num_rows
        if rows >= 2 * FEW:
            held = [_stars(held)]
            if len(held[0][0]) > FEW:
                yield pa.RecordBatch.from_arrays([*map(pa.array, held[0])], ["a", "b"])
                held = []
            rows = sum(len(x[0]) for x in held)
    if held:
        yield pa.RecordBatch.from_arrays([*map(pa.array, _stars(held))], ["a", "b"])


def _stars(held):
    node, root = forest(*(np.concatenate(x) for x in zip(*held, strict=True)))
    return node[node != root], root[node != root]


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of its component, for every node of an edge (a, b)."""
    e, mark, n = C.stored(edges.select("a", "b").where("a <> b").mapInArrow(_reduced, "a long, b long"), "edges"), None, None
    if e.count() <= FEW:
        new = C.stored(e.coalesce(1).mapInArrow(_reduced, "a long, b long"), "edges")
        C.drop_stored(e)
        return _nodes(new)
    most = C.partitions(edges.sparkSession)
    while True:  # rounds grow with the logarithm of the number of nodes
        step = _star(_star(e, True), False)
        if n is not None:  # few edges need few tasks and files
            step = step.coalesce(max(1, min(most, -(-n // ROWS_A_FILE))))
        new = C.stored(step, "edges")
        # a fixed point is a set of stars; the sums differ while anything moves
        now = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        C.drop_stored(e)
        e, n = new, now[0]
        if now == mark:
            break
        mark = now
    return _nodes(e)


def _nodes(stars: DataFrame) -> DataFrame:
    own = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(own)
