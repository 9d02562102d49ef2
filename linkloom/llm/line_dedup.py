"""Line dedup: lines that many documents share go, everywhere.

Each document gives one record per distinct line key: the 128-bit hash of the key and the line's positions.  Records are
range-partitioned by hash, with sampled bounds that may cut through a hot key, and sorted by (hash, document, position).  A
task streams its range: it holds a key's records only until the key has been seen in `min_docs` documents, then passes the
rest through.  Keys that touch a range border are settled by a table of at most two counts a range.  What comes back to a
document is a compressed bitmap of the lines that stay, not text.

Defined results: null or empty text is one empty line, which has no key and stays.  A document given twice (same id and
text) counts once; rows of the same id count as one document.  Rows of a null id count as one document.  Input columns other
than id and text are ignored, whatever their names.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm import common as C

SPACE = b" \t\n\x0b\x0c\r"


def line_keys(text: str) -> list[bytes]:
    """The key of each line: A-Z lower-cased, white space stripped at both ends."""
    return [x.strip(SPACE) for x in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]


def _records(batch: pa.RecordBatch) -> tuple[list, list, list, list, list]:
    docs, ths = C.longs(batch, "doc").tolist(), C.longs(batch, "th").tolist()
    k1, k2, doc, th, pos = [], [], [], [], []
    for t, d, h in zip(batch.column("text").to_pylist(), docs, ths, strict=True):
        at: dict[bytes, list[int]] = {}
        for i, key in enumerate(line_keys(t)):
            if key:
                at.setdefault(key, []).append(i)
        for key, where in at.items():
            x = xxhash.xxh3_128_intdigest(key)
            k1.append((x >> 64) - (1 << 63))
            k2.append((x & (2**64 - 1)) - (1 << 63))
            doc.append(d)
            th.append(h)
            pos.append(where)
    return k1, k2, doc, th, pos


def _sample(batch: pa.RecordBatch) -> list[np.ndarray]:
    *keys, pos = _records(batch)
    return [np.array(c, np.int64) for c in (*keys, [p[0] for p in pos])]


def line_records(docs: DataFrame) -> DataFrame:
    """k1, k2, doc, th, first, at (all positions, 4 bytes each), pid: the range."""
    n, ranges = C.partitions(docs.sparkSession), C.splitters(docs, _sample)

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 512):
                k1, k2, doc, th, pos = _records(b.slice(i, 512))
                cols = [np.array(c, np.int64) for c in (k1, k2, doc, th, [p[0] for p in pos])]
                at = pa.array([np.array(p, "<i4").tobytes() for p in pos], pa.binary())
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), at, pa.array(ranges.of(cols))], ["k1", "k2", "doc", "th", "first", "at", "pid"])

    out = docs.select("text", "doc", "th").mapInArrow(run, "k1 long, k2 long, doc long, th long, first long, at binary, pid int")
    return out.repartitionById(n, F.col("pid")).sortWithinPartitions("k1", "k2", "doc", "th", "first")


def _stream(min_docs: int):
    """One pass over a sorted range: kind 0: lines to drop; 1: lines of a key that may go on in another range; 2: such a key's
    count of documents here, with its first and last document."""
    names = ["kind", "k1", "k2", "doc", "th", "at", "pid", "n", "lo", "hi"]

    def rows(kind, recs, n=0, lo=0, hi=0):
        return [(kind, *r[:4], r[4], r[5], n, lo, hi) for r in recs]

    def run(batches):
        key, held, n, first_doc, last_doc, is_open, pid = None, [], 0, 0, None, True, 0  # the range's first key is open
        for b in batches:
            out: list[tuple] = []
            k1, k2, doc = (C.longs(b, k) for k in ("k1", "k2", "doc"))
            pid = b.column("pid")[0].as_py()
            cut = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            ends = np.r_[cut[1:], len(k1)]
            for s, e in zip(cut.tolist(), ends.tolist(), strict=True):
                mine = (int(k1[s]), int(k2[s]))
                if mine != key:
                    if key is not None and is_open:
                        out += rows(1, held) + rows(2, [(*key, 0, 0, b"", pid)], n, first_doc, last_doc)
                    key, held, n, first_doc, last_doc, is_open = mine, [], 0, int(doc[s]), None, key is None
                if min_docs > 1 and e - s == 1 and e < len(k1) and not is_open and n == 0:
                    n, last_doc = 1, int(doc[s])  # a key of one record, the usual case
                    continue
                part = b.slice(s, e - s)
                recs = list(zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "doc", "th", "at", "pid")), strict=True))
                d = doc[s:e]
                n += int((d[1:] != d[:-1]).sum()) + (last_doc is None or int(d[0]) != last_doc)
                last_doc = int(d[-1])
                held += recs
                if n >= min_docs:
                    out += rows(0, held)
                    held = []
                elif len(held) > 100_000:  # one document given very many times
                    out += rows(1, held)
                    held, is_open = [], True
            if out:
                yield _batch(out, names)
        if key is not None:  # the range's last key
            yield _batch(rows(1, held) + rows(2, [(*key, 0, 0, b"", pid)], n, first_doc, last_doc), names)

    return run, "kind int, k1 long, k2 long, doc long, th long, at binary, pid int, n long, lo long, hi long"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.int32(), *[pa.int64()] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def dropped_lines(docs: DataFrame, min_docs: int) -> DataFrame:
    """doc, th, at: positions of lines whose key at least `min_docs` documents have.  docs: from keyed()."""
    run, schema = _stream(min_docs)
    seen = C.stored(C.packed(line_records(docs).mapInArrow(run, schema), docs.count()), "lines")
    by_range = Window.partitionBy("k1", "k2").orderBy("pid")
    again = (F.lag("hi").over(by_range) == F.col("lo")).cast("int")  # a document that both sides of a border count
    total = seen.where("kind = 2").withColumn("n", F.col("n") - F.coalesce(again, F.lit(0))).groupBy("k1", "k2").agg(F.sum("n").alias("n"))
    hot = total.where(F.col("n") >= min_docs).select("k1", "k2")  # at most two rows a range
    at_borders = seen.where("kind = 1").join(F.broadcast(hot), ["k1", "k2"], "left_semi")
    return seen.where("kind = 0").select("doc", "th", "at").unionByName(at_borders.select("doc", "th", "at"))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """doc, th, drop: zlib of the packed bits of dropped lines, for documents that lose any."""

    def pack(parts: list[bytes]) -> bytes:
        at = np.frombuffer(b"".join(parts), "<i4")
        bits = np.zeros(int(at.max()) + 1, bool)
        bits[at] = True
        return zlib.compress(np.packbits(bits).tobytes())

    def run(batches):
        for b in batches:
            bits = pa.array([pack(x) for x in b.column("parts").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("th"), bits], ["doc", "th", "drop"])

    parts = dropped_lines(docs, min_docs).groupBy("doc", "th").agg(F.collect_list("at").alias("parts"))
    return parts.mapInArrow(run, "doc long, th long, drop binary")


def dedup_lines(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (without the shared lines), n_lines (before), n_dropped, keep_bitmap (zlib of packed bits)."""
    d = C.keyed(docs, id_col, text_col)
    bits = keep_bitmaps(d, min_docs)
    both = d.join(bits, ["doc", "th"], "left").select("doc_id", "text", "drop")

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                out: list[tuple] = []
                for t, drop in zip(part.column("text").to_pylist(), part.column("drop").to_pylist(), strict=True):
                    lines = t.split("\n")
                    keep = np.ones(len(lines), bool)
                    if drop:
                        gone = np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(drop), np.uint8)))
                        keep[gone] = False
                        t = "\n".join([lines[j] for j in np.flatnonzero(keep).tolist()])
                    out.append((t, len(lines), int(len(lines) - keep.sum()), zlib.compress(np.packbits(keep).tobytes())))
                t, n, gone, bitmap = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(t, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(bitmap, pa.binary())], ["doc_id", "text", "n_lines", "n_dropped", "keep_bitmap"])

    kind = dict(d.dtypes)["doc_id"]
    return both.mapInArrow(run, f"doc_id {kind}, text string, n_lines long, n_dropped long, keep_bitmap binary")


def drop_lines(docs: DataFrame, min_docs: int = 10, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """docs without the shared lines, all other columns as they were; n_chars, where there is one, is counted anew for texts
    that lose lines.  Null texts stay null."""
    bits = keep_bitmaps(C.keyed(docs), min_docs)
    wide, back = C.with_key(docs)
    names = docs.columns
    text = f"c{names.index(text_col)}"
    both = wide.join(bits, ["doc", "th"], "left").select(*[f"c{i}" for i in range(len(names))], "drop")

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                at = part.schema.get_field_index(text)
                out = []
                for t, drop in zip(part.column(at).to_pylist(), part.column("drop").to_pylist(), strict=True):
                    if drop and t is not None:
                        gone = set(np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(drop), np.uint8))).tolist())
                        t = "\n".join([x for j, x in enumerate(t.split("\n")) if j not in gone])
                    out.append(t)
                yield part.set_column(at, part.schema.field(at), pa.array(out, part.schema.field(at).type))

    out = both.mapInArrow(run, both.schema)
    if chars_col in names:
        c = f"c{names.index(chars_col)}"
        out = out.withColumn(c, F.when(F.col("drop").isNull(), F.col(c)).otherwise(F.length(text)).cast(dict(wide.dtypes)[c]))
    return back(out)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: keys of one code point or more, found in 10 documents or more, lose all their lines."""
    docs = C.table(spark, sf_dir, "documents")
    out = dedup_lines(docs, min_docs=10)
    out = out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    return C.packed(out, docs.count(), C.ROWS_A_TASK)


def brute(rows: list[tuple], min_docs: int = 10) -> dict:
    """The same by plain Python, for tests: {(doc_id, text): (n_lines, n_dropped, sha256)}."""
    docs: dict[bytes, set] = {}
    for i, t in rows:
        for k in line_keys(t or ""):
            docs.setdefault(k, set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, line_keys(t or ""), strict=True) if not k or len(docs[k]) < min_docs]
        out[(i, t)] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


SQL = {
    "op2_line_dedup": """
WITH lines AS (
  SELECT doc_id, t.i AS i, t.line AS line,
         translate(trim(t.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(list_transform(range(len(x)), lambda i: {'i': i, 'line': x[i + 1]})) AS t
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))
), hot AS (
  SELECT k FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(h.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN h.k IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM lines l LEFT JOIN hot h USING (k)
GROUP BY doc_id
"""
}
