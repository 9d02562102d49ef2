"""Suffix-array dedup: bytes covered by a 100-byte string that starts earlier go.

A record for every suffix would not fit on disk, so suffixes are taken at anchors: positions whose 24-byte hash is the least
in some 100-byte window.  Equal windows have equal anchors, so a string of 100 bytes that occurs twice has an anchor in
both places, at the same offset.  An anchor's context is all bytes that a window around it can reach: 76 on each side.

1. Anchors are range-partitioned by (leading bytes, the rest of the anchor, context, document, position) with sampled splitters,
   which may cut through a hot anchor, and sorted; of all but the first three bytes hashes are kept.  A task streams its range: an anchor whose whole context stood earlier is covered to
   the full; the first one of each context goes on if its anchor has other contexts, or if it touches a range border, so
   that what lies on two sides of a border is compared too.
2. Those go on with their context bytes, dealt by the same splitters.  Each bucket of equal anchors is sorted by multikey quicksort, once by the bytes to
   the right and once by those to the left: two local suffix arrays with common-prefix lengths, from which equal windows
   follow at every offset.  All but the first (document, position) of equal windows are covered.
   Anchors with over `hot` contexts go by the digest of each window instead: a minimum with partial aggregation.
3. Covered spans are merged in each document.

Defined results: null is empty text; texts of under 100 bytes lose nothing.  Earlier means a smaller doc_id (null last), then
text hash, then start.  A document given twice (same id and text) is one document.  Other columns are ignored; empty tables
work.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import common as C

LENGTH, GRAM = 100, 24
SIDE = LENGTH - GRAM
_RNG = np.random.default_rng(977)
CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
BLOCK = 1 << 18
#: Contexts of one anchor beyond which windows are compared by digest.
HOT = 50_000


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(BASE, BLOCK + 4096), _powers(INVERSE, BLOCK + 4096)


def _sliding(a: np.ndarray, width: int, f) -> np.ndarray:
    """f over every run of `width` values, by doubling."""
    size = 1
    while size * 2 <= width:
        a = f(a[:-size], a[size:])
        size *= 2
    return f(a[: len(a) - (width - size)], a[width - size :]) if width > size else a


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie one after another: text number, position in it, order key and context hash of each anchor.  The order key is
    three leading bytes and 40 bits of the hash of all 24."""
    n = int(off[-1])
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    power, inverse = (_POW[:n], _INV[: n + 1]) if n <= BLOCK else (_powers(BASE, n), _powers(INVERSE, n + 1))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(CODE[data[:n]] * power, out=sums[1:])
    gram = (sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1]
    h = ((gram * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(h, SIDE + 1, np.minimum)
    sizes = np.diff(off)
    for i in range(len(sizes)):  # windows that would cross a text's end
        least[max(off[i], off[i + 1] - LENGTH + 1) : off[i + 1]] = 0
    pad = np.zeros(SIDE, np.uint32)
    at = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), SIDE + 1, np.maximum)[: len(h)] == h)
    text = np.searchsorted(off, at, side="right") - 1
    lo, hi = np.maximum(at - SIDE, off[text]), np.minimum(at + LENGTH, off[text + 1])
    context = (sums[hi] - sums[lo]) * inverse[lo]
    context ^= ((at - lo) * 211 + (hi - at)).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    lead = (data[at].astype(np.uint64) << np.uint64(16)) | (data[at + 1].astype(np.uint64) << np.uint64(8)) | data[at + 2].astype(np.uint64)
    low = (gram[at] * np.uint64(0xA24BAED4963EE407)) >> np.uint64(24)
    return text, at - off[text], ((lead << np.uint64(40)) | low) ^ np.uint64(1 << 63), context  # the sign bit keeps the order of bytes


def _records(batch: pa.RecordBatch, low: int = 0, high: int | None = None) -> list[np.ndarray]:
    part = batch.slice(low, (high or batch.num_rows) - low)
    data, off = C.text_bytes(part.column("text"))
    docs, ths = C.longs(part, "doc"), C.longs(part, "th")
    cols: list[list[np.ndarray]] = []
    for i, j in C.pieces(off, BLOCK - 4096):
        if off[j] - off[i] > BLOCK:  # one long text, in blocks that overlap by a window's reach on either side
            found, start, end, step = [], int(off[i]), int(off[j]), BLOCK - 4096
            for at in range(start, end, step):
                lo, hi = max(start, at - 2 * LENGTH), min(end, at + step + 2 * LENGTH)
                _, pos, gram, context = anchors(data[lo:hi], np.array([0, hi - lo]))
                mine = (pos + lo >= at) & (pos + lo < at + step)
                found.append((np.full(int(mine.sum()), i), pos[mine] + lo - start, gram[mine], context[mine]))
            text, pos, gram, context = (np.concatenate(x) for x in zip(*found, strict=True))
        else:
            text, pos, gram, context = anchors(data[off[i] : off[j]], off[i : j + 1] - off[i])
            text = text + i
        cols.append([C.signed(gram), C.signed(context), docs[text], ths[text], pos])
    return [np.concatenate(x) for x in zip(*cols, strict=True)] if cols else [np.zeros(0, np.int64)] * 5


def anchor_records(docs: DataFrame, ranges: C.Splitters) -> DataFrame:
    n = C.partitions(docs.sparkSession)

    def run(batches):
        for b in batches:
            _, off = C.text_bytes(b.column("text"))
            for i, j in C.pieces(off, 1 << 20):
                cols = _records(b, i, j)
                pid = ranges.of(cols)
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols[:4]), pa.array(cols[4].astype(np.int32)), pa.array(pid)], [*C.KEYS, "pid"])

    out = docs.select("text", "doc", "th").mapInArrow(run, "k1 long, k2 long, doc long, th long, pos int, pid int")
    return out.repartitionById(n, F.col("pid")).drop("pid").sortWithinPartitions(*C.KEYS)


def _stream(batches):
    """Per sorted range: whole: an anchor whose context stood earlier; else the first one of its context, to be compared."""
    names = ["whole", "k1", "doc", "th", "pos"]

    def emit(whole, cols, at):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), whole)), *[pa.array(cols[i][at]) for i in (0, 2, 3, 4)]], names)

    runs, kept, sent, begun = C.Runs(), None, True, False
    for b in batches:
        cols = [C.longs(b, k).astype(np.int64) for k in C.KEYS]
        if not len(cols[0]):
            continue
        _, same, whole = runs.read(cols)
        if len(at := np.flatnonzero(same & ~whole)):
            yield emit(True, cols, at)
        first = np.flatnonzero(~same)
        if not len(first):
            continue
        own = cols[0][first]
        near = np.zeros(len(first), bool)
        near[1:] |= own[1:] == own[:-1]
        near[:-1] |= own[1:] == own[:-1]
        if not begun:
            near[0], begun = True, True
        elif kept is not None and kept[0] == own[0]:
            near[0] = True
            if not sent:
                yield emit(False, [np.array([v]) for v in kept], [0])
        yield emit(False, cols, first[near])
        kept, sent = [c[first[-1]] for c in cols], bool(near[-1])
    if kept is not None and not sent:
        yield emit(False, [np.array([v]) for v in kept], [0])


def _context_rows(batches, first: np.ndarray):
    """The context bytes of the anchors to be compared: left reversed, so that both sides read away from the anchor; pid: the range of
    the anchor, given the splitters' order keys."""
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            data, off = C.text_bytes(part.column("text"))
            docs, ths = C.longs(part, "doc").tolist(), C.longs(part, "th").tolist()
            cols: list[list] = [[] for _ in range(6)]
            for j, marks in enumerate(part.column("marks").to_pylist()):
                raw = data[off[j] : off[j + 1]].tobytes()
                for m in marks:
                    p = m["pos"]
                    for c, v in zip(cols, (m["k1"], docs[j], ths[j], p, raw[max(0, p - SIDE) : p][::-1], raw[p : p + LENGTH]), strict=True):
                        c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            pid = pa.array(np.searchsorted(first, np.array(cols[0], np.int64)), pa.int32())
            yield pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], pid], ["k1", "doc", "th", "pos", "left", "right", "pid"])


def multikey_sort(group: np.ndarray, digits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order by (group, digits, size): multikey quicksort with 8-byte digits.  Each level sorts only what is still tied."""
    order = np.argsort(group, kind="stable")
    tie = np.zeros(len(order), np.int64)  # the run of rows that are equal so far
    tie[1:] = np.cumsum(group[order][1:] != group[order][:-1])
    live = np.arange(len(order))
    for key in [*digits.T, size]:
        counts = np.bincount(tie)
        live = live[counts[tie[live]] > 1]
        if not len(live):
            break
        rows = order[live]
        by = np.lexsort((key[rows], tie[live]))
        order[live] = rows[by]
        t, k = tie[live][by], key[rows][by]
        new = np.zeros(len(live), bool)
        new[1:] = (t[1:] == t[:-1]) & (k[1:] != k[:-1])
        step = np.zeros(len(order), np.int64)
        step[live] = new
        tie = tie + np.cumsum(step)
    return order


def _side(group: np.ndarray, texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A local suffix array: order, common prefix with the row before, and sizes."""
    size = np.array([min(len(t), width) for t in texts], np.int64)
    wide = -(-width // 8) * 8
    flat = np.frombuffer(b"".join(t[:width].ljust(wide, b"\0") for t in texts), np.uint8).reshape(len(texts), wide)
    order = multikey_sort(group, flat.view(">u8").astype(np.uint64), size)
    a, b = flat[order[1:]], flat[order[:-1]]
    diff = a != b
    common = np.where(diff.any(1), diff.argmax(1), wide)
    common = np.minimum(common, np.minimum(size[order[1:]], size[order[:-1]]))
    common[group[order[1:]] != group[order[:-1]]] = -1
    return order, np.r_[-1, common], size


def covered(group: np.ndarray, lefts: list[bytes], rights: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of anchors in (group, document, position) order: the least and most left reach of windows that an earlier anchor of
    the group has too (most < 0: none)."""
    m = len(group)
    lo, hi = np.full(m, LENGTH), np.full(m, -1)
    if m < 2:
        return lo, hi
    l_order, l_common, l_size = _side(group, lefts, SIDE)
    r_order, r_common, r_size = _side(group, [r[GRAM:] for r in rights], SIDE)
    for reach in range(SIDE + 1):
        left, right = np.empty(m, np.int64), np.empty(m, np.int64)
        left[l_order] = np.cumsum(l_common < reach)
        right[r_order] = np.cumsum(r_common < SIDE - reach)
        may = np.flatnonzero((l_size >= reach) & (r_size >= SIDE - reach))
        key = left[may] * (m + 1) + right[may]
        by = np.argsort(key, kind="stable")
        again = may[by[1:][key[by[1:]] == key[by[:-1]]]]
        hi[again] = reach
        lo[again] = np.minimum(lo[again], reach)
    return lo, hi


def _solve(batches):
    names = ["doc", "th", "s", "e"]
    kinds = [pa.int64()] * 4
    held: list[tuple] = []

    def done(rows):
        rows = [r for i, r in enumerate(rows) if not i or r[:4] != rows[i - 1][:4]]  # a document given twice
        k1, doc, th, pos, left, right = zip(*rows, strict=True)
        grams: dict = {}  # an order key and all bytes of the anchor
        lo, hi = covered(np.array([grams.setdefault((k, r[:GRAM]), len(grams)) for k, r in zip(k1, right, strict=True)], np.int64), list(left), list(right))
        at = np.flatnonzero(hi >= 0)
        pos = np.array(pos)[at]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((np.array(doc)[at], np.array(th)[at], pos - hi[at], pos - lo[at] + LENGTH), kinds, strict=True)], names)

    for b in batches:
        held += zip(*(b.column(c).to_pylist() for c in ("k1", "doc", "th", "pos", "left", "right")), strict=True)
        if len(held) >= 20_000:
            cut = len(held)
            while cut and held[cut - 1][0] == held[-1][0]:  # the last anchor may go on
                cut -= 1
            if cut:
                yield done(held[:cut])
                held = held[cut:]
    if held:
        yield done(held)


def _windows(batches):
    """Of hot anchors: a digest of every window around each."""
    for b in batches:
        out = []
        for k, d, t, p, left, right in zip(*(b.column(c).to_pylist() for c in ("k1", "doc", "th", "pos", "left", "right")), strict=True):
            both = left[::-1] + right
            for s in range(len(both) - LENGTH + 1):
                x = xxhash.xxh3_128_intdigest(both[s : s + LENGTH], seed=k & 0xFFFF)
                out.append(((x >> 64) - (1 << 63), (x & (2**64 - 1)) - (1 << 63), d, t, p - len(left) + s))
            if len(out) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["w1", "w2", "doc", "th", "s"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["w1", "w2", "doc", "th", "s"])


def covered_spans(docs: DataFrame, texts: DataFrame, hot: int = HOT) -> DataFrame:
    """doc, th, s, e: spans of bytes to remove, not merged.  texts: docs dealt by (doc, th)."""
    ranges = C.splitters(docs, _records)
    seen = C.stored(anchor_records(docs, ranges).mapInArrow(_stream, "whole boolean, k1 long, doc long, th long, pos long"), "anchors")
    whole = seen.where("whole").select("doc", "th", (F.col("pos") - SIDE).alias("s"), (F.col("pos") + LENGTH).alias("e"))
    rest = seen.where("NOT whole")
    many = C.stored(rest.groupBy("k1").count().where(F.col("count") > hot).select("k1"), "hot")
    n, first = C.partitions(docs.sparkSession), ranges.rows[:, 0].copy()

    def contexts(rows: DataFrame) -> DataFrame:
        marks = rows.groupBy("doc", "th").agg(F.collect_list(F.struct("k1", "pos")).alias("marks"))
        both = texts.join(marks, ["doc", "th"]).select("text", "doc", "th", "marks")
        return both.mapInArrow(lambda batches: _context_rows(batches, first), "k1 long, doc long, th long, pos long, left binary, right binary, pid int")

    any_hot = not many.isEmpty()
    some = rest.join(many, "k1", "left_anti") if any_hot else rest
    by_anchor = contexts(some).repartitionById(n, F.col("pid")).sortWithinPartitions("k1", "doc", "th", "pos")
    parts = [whole, by_anchor.mapInArrow(_solve, "doc long, th long, s long, e long")]
    if any_hot:
        hits = rest.join(many, "k1", "left_semi")
        win = C.stored(contexts(hits).mapInArrow(_windows, "w1 long, w2 long, doc long, th long, s long"), "windows")
        least = win.groupBy("w1", "w2").agg(F.min(F.struct("doc", "th", "s")).alias("f"))
        late = win.join(least, ["w1", "w2"]).where(F.struct("doc", "th", "s") != F.col("f"))
        parts.append(late.select("doc", "th", "s", (F.col("s") + LENGTH).alias("e")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merged(s: np.ndarray, e: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Sorted, disjoint, non-touching spans within 0..n."""
    if not len(s):
        return []
    s, e = np.maximum(s, 0), np.minimum(e, n)
    by = np.argsort(s, kind="stable")
    s, top = s[by], np.maximum.accumulate(e[by])
    new = np.r_[True, s[1:] > top[:-1]]
    return list(zip(s[new].tolist(), top[np.r_[np.flatnonzero(new)[1:] - 1, len(s) - 1]].tolist(), strict=True))


def dedup_suffixes(docs: DataFrame, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, spans (maximal removed runs: byte start and end)."""
    d = C.keyed(docs, id_col, text_col)
    # dealt once, used for contexts and for removal: both read the same columns, so that the exchange is reused
    texts = d.select("doc", "th", "text").repartition(C.partitions(d.sparkSession), "doc", "th")
    by_doc = covered_spans(d, texts, hot).groupBy("doc", "th").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))
    kind = dict(d.dtypes)["doc_id"]
    doc_id = F.when(F.col("doc") != C.NO_ID, F.col("doc")).cast(kind).alias("doc_id")
    both = texts.join(by_doc, ["doc", "th"], "left").select(doc_id, "text", "s", "e")
    names = ["doc_id", "kept", "n_bytes", "n_removed", "spans"]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                data, off = C.text_bytes(part.column("text"))
                out = []
                for j, (s, e) in enumerate(zip(part.column("s").to_pylist(), part.column("e").to_pylist(), strict=True)):
                    own = data[off[j] : off[j + 1]]
                    spans = merged(np.array(s or [], np.int64), np.array(e or [], np.int64), len(own))
                    keep = np.ones(len(own), bool)
                    for x, y in spans:
                        keep[x:y] = False
                    kept = own[keep].tobytes()
                    out.append((kept, len(own), len(own) - len(kept), [{"start": x, "end": y} for x, y in spans]))
                kept, n, gone, spans = zip(*out, strict=True)
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(kept, pa.binary()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span)], names)

    return both.mapInArrow(run, f"doc_id {kind}, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: 100-byte strings over whole documents."""
    out = dedup_suffixes(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute(rows: list[tuple]) -> dict:
    """The same in plain Python, for tests: {(doc_id, text): (n_bytes, n_removed, n_spans, sha256)}."""
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - LENGTH + 1):
            x = raw[s : s + LENGTH]
            if x in seen:
                gone[s : s + LENGTH] = True
            seen.add(x)
        edges = np.diff(np.r_[0, gone.astype(int), 0])
        out[(i, t)] = (len(raw), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
    return out


SQL = {
    "op7_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS x FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - 99, 0))) AS s FROM d)),
f AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, s) > 1),
i AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k
      FROM (SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 1 ELSE 0 END AS new FROM f)),
r AS (SELECT doc_id, k, min(s) AS s, max(s) + 100 AS e FROM i GROUP BY 1, 2),
p AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY k), 0) AS b FROM r),
a AS (SELECT doc_id, sum(e - s)::BIGINT AS gone, count(*)::BIGINT AS spans, max(e) AS last, string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY k) AS kept
      FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN gone IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)
"""
}
