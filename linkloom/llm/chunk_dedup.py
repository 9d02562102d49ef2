"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 32 bytes sets chunk bounds where its top bits are zero, at least `min_size` and at most
`max_size` bytes apart, so bounds move with the content and resist insertions.  Chunks are deduplicated by a 128-bit digest:
records are range-partitioned by digest, with sampled bounds that may cut through a hot digest, sorted by (digest, document,
position) and streamed.  Every chunk but the first with its digest is a repeat; a repeat goes if it stands in an unbroken run
of repeats of `min_run` bytes or more, which leaves short chance repeats in clean text alone, or in one that is its whole
document, so that an exact copy goes however short it is.

Defined results: null is empty text, which has no chunks.  Earlier means a smaller doc_id (null last), then text hash, then
position.  A document given twice (same id and text) is one document.  Other columns are ignored; empty tables work.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm import common as C

MIN_SIZE, MAX_SIZE, MASK_BITS, MIN_RUN = 24, 192, 4, 96
GEAR = np.random.default_rng(20240607).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: the sum of GEAR[byte j back] << j over the last 32 bytes."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        g = h.copy()
        g[step:] += h[:-step] << np.uint32(step)
        h = g
    return h


def bounds(data: np.ndarray, min_size: int = MIN_SIZE, max_size: int = MAX_SIZE, bits: int = MASK_BITS, block: int = 1 << 20) -> list[int]:
    """Ends of the chunks of one text.  Long texts are hashed in blocks that overlap by 32 bytes."""
    n, out, last = len(data), [], 0
    for at in range(0, n, block):
        lo = max(0, at - 32)
        h = gear(data[lo : at + block])[at - lo :]
        for c in (np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + at + 1).tolist():
            while c - last > max_size:
                last += max_size
                out.append(last)
            if c - last >= min_size:
                out.append(c)
                last = c
    while n - last > max_size:
        last += max_size
        out.append(last)
    if last < n:
        out.append(n)
    return out


def _records(batch: pa.RecordBatch, low: int = 0, high: int | None = None) -> list[np.ndarray]:
    part = batch.slice(low, (high or batch.num_rows) - low)
    data, off = C.text_bytes(part.column("text"))
    docs, ths = C.longs(part, "doc"), C.longs(part, "th")
    digest, count, start = [], [], []
    for i in range(part.num_rows):
        own = data[off[i] : off[i + 1]]
        ends, raw, s = bounds(own), own.tobytes(), 0
        for e in ends:
            digest.append(xxhash.xxh3_128_digest(raw[s:e]))
            start.append(s)
            s = e
        count.append(len(ends))
    two = np.frombuffer(b"".join(digest), ">u8").astype(np.uint64).view(np.int64).reshape(-1, 2)
    return [two[:, 0].copy(), two[:, 1].copy(), np.repeat(docs, count), np.repeat(ths, count), np.array(start, np.int64)]


def chunk_records(docs: DataFrame) -> DataFrame:
    """k1, k2 (the digest), doc, th, pos (the start), range by range in order."""
    n, ranges = C.partitions(docs.sparkSession), C.splitters(docs, _records)
    names = [*C.KEYS, "pid"]

    def run(batches):
        for b in batches:
            _, off = C.text_bytes(b.column("text"))
            for i, j in C.pieces(off, 1 << 20):
                cols = _records(b, i, j)
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(ranges.of(cols))], names)

    out = docs.select("text", "doc", "th").mapInArrow(run, "k1 long, k2 long, doc long, th long, pos long, pid int")
    return out.repartitionById(n, F.col("pid")).sortWithinPartitions(*C.KEYS)


def _repeats(batches):
    """Per sorted range: kind 0: a repeat; 1: the first record of the range; 2: the range's last key."""
    runs, begun, names = C.Runs(), False, ["kind", *C.KEYS, "pid"]
    kinds = pa.int32()
    for b in batches:
        cols = [C.longs(b, k) for k in C.KEYS]
        if not len(cols[0]):
            continue
        _, same, whole = runs.read(cols)
        at = np.flatnonzero(same & ~whole)
        kind = np.zeros(len(at), np.int32)
        if not begun:
            at, kind, begun = np.r_[0, at], np.r_[1, kind], True
        pid = int(b.column("pid")[0].as_py())
        yield pa.RecordBatch.from_arrays([pa.array(kind, kinds), *[pa.array(c[at]) for c in cols], pa.array(np.full(len(at), pid), pa.int32())], names)
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([2], kinds), *[pa.array([int(v)]) for v in runs.last], pa.array([pid], pa.int32())], names)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc, th, pos of every chunk whose digest an earlier chunk has."""
    seen = C.stored(chunk_records(docs).mapInArrow(_repeats, "kind int, k1 long, k2 long, doc long, th long, pos long, pid int"), "chunks")
    # a range's first record repeats if the range before ends on its digest: one first and one last row a range
    edges = seen.where("kind > 0").withColumn("prev1", F.lag("k1").over(w := Window.orderBy("pid", "kind"))).withColumn("prev2", F.lag("k2").over(w))
    firsts = edges.where("kind = 1 AND k1 = prev1 AND k2 = prev2")
    return seen.where("kind = 0").select("doc", "th", "pos").unionByName(firsts.select("doc", "th", "pos"))


def apply_repeats(data: bytes, starts: list[int], min_run: int) -> tuple[int, int, list[tuple[int, int]]]:
    """Numbers of chunks and of those that go, and the byte spans that go: runs of repeats of min_run bytes or more, or of the
    whole text."""
    ends = bounds(np.frombuffer(data, np.uint8))
    gone, spans, s = set(starts), [], 0
    for e in ends:
        if s in gone:
            if spans and spans[-1][1] == s:
                spans[-1] = (spans[-1][0], e, spans[-1][2] + 1)
            else:
                spans.append((s, e, 1))
        s = e
    spans = [x for x in spans if x[1] - x[0] >= min_run or x[:2] == (0, len(data))]
    return len(ends), sum(n for _, _, n in spans), [x[:2] for x in spans]


def dedup_chunks(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept (the bytes that stay), n_bytes, n_chunks, n_repeats (those that go), n_removed (bytes), spans (byte start and end)."""
    d = C.keyed(docs, id_col, text_col)
    by_doc = repeated_chunks(d).groupBy("doc", "th").agg(F.collect_set("pos").alias("starts"))
    both = d.join(by_doc, ["doc", "th"], "left").select("doc_id", "text", "starts")
    kind = dict(d.dtypes)["doc_id"]
    names = ["doc_id", "kept", "n_bytes", "n_chunks", "n_repeats", "n_removed", "spans"]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                data, off = C.text_bytes(part.column("text"))
                out = []
                for j, starts in enumerate(part.column("starts").to_pylist()):
                    raw = data[off[j] : off[j + 1]].tobytes()
                    chunks, repeats, spans = apply_repeats(raw, starts or [], min_run)
                    kept, at = [], 0
                    for s, e in spans:
                        kept.append(raw[at:s])
                        at = e
                    kept = b"".join([*kept, raw[at:]])
                    out.append((kept, len(raw), chunks, repeats, len(raw) - len(kept), [{"start": s, "end": e} for s, e in spans]))
                kept, *counts, spans = zip(*out, strict=True)
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(kept, pa.binary()), *[pa.array(c, pa.int64()) for c in counts], pa.array(spans, span)], names)

    return both.mapInArrow(run, f"doc_id {kind}, kept binary, n_bytes long, n_chunks long, n_repeats long, n_removed long, spans array<struct<start: long, end: long>>")


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_chunks, n_repeats, n_removed, kept_sha256 of every document."""
    out = dedup_chunks(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_chunks", "n_repeats", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute(rows: list[tuple], min_run: int = MIN_RUN) -> dict:
    """The same in plain Python for tests: {(doc_id, text): (n_chunks, n_repeats, n_removed, sha256 of what stays)}."""
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        raw, s, starts = (t or "").encode(), 0, []
        ends = bounds(np.frombuffer(raw, np.uint8))
        for e in ends:
            if raw[s:e] in seen:
                starts.append(s)
            seen.add(raw[s:e])
            s = e
        _, repeats, spans = apply_repeats(raw, starts, min_run)
        kept = bytearray(raw)
        for s, e in reversed(spans):
            del kept[s:e]
        out[(i, t)] = (len(ends), repeats, len(raw) - len(kept), hashlib.sha256(kept).hexdigest())
    return out
