"""SimHash near-dedup with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each read as a word of the perfect binary Golay code
(23, 12): every word lies within 3 bits of just one codeword, whose 12-bit index is its hash.  A segment's neighbours at one
bit decode to at most 5 further codewords, so a segment has 1 to 6 indices.  If two fingerprints differ in at most 4 bits,
then in some pair of segments they differ in at most 2 (the two least of three counts that sum to 4), and a word one bit from
both has the same pair of indices for both.  So the keys of a fingerprint are, for each of the 3 segment pairs, the index
pairs of the words within one bit: about 29 keys of 24 bits.  Distinct fingerprints are dealt by key; those that meet
are verified by their bits.  A small bucket is compared at every offset at once.  In a large one a breadth-first search
compares what is left with each front and so gives a spanning forest, not all pairs; beyond `WIDE` members it is first split
by the five exact segments of which 4 errors must leave one whole.  No link is lost: each linked pair ends in one component.

Defined results: null or blank text has fingerprint zero, which links like any other.  component_id is the least non-null
doc_id of the component, null if it has none.  Other columns are ignored; repeated rows all appear; empty tables work.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm import common as C
from linkloom.llm.components import components

SPACE = b" \t\n\x0b\x0c\r"
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the code.
GENERATOR = 0b110001110101
SMALL, WIDE, CACHE = 24, 4096, 500_000
#: (place, bits) of the exact segments; fingerprints sampled to find hot keys.
EXACT, SAMPLED = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12)), 200_000


def _remainder(words: np.ndarray) -> np.ndarray:
    """The 11-bit syndrome of 23-bit words."""
    r = words.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where((r >> bit) & 1, r ^ (GENERATOR << (bit - 11)), r)
    return r


def _decoder() -> np.ndarray:
    """Syndrome -> error pattern of weight 3 at most; perfect, so all 2048 syndromes are met once."""
    one = 1 << np.arange(23)
    i, j, k = np.meshgrid(one, one, one, indexing="ij")
    errors = np.unique(np.concatenate([[0], (i | j | k).ravel()]))
    table = np.zeros(2048, np.int64)
    table[_remainder(errors)] = errors
    return table


_ERRORS = _decoder()
#: The syndrome of each single bit: syndromes are linear.
_UNITS = _remainder(1 << np.arange(23))


def indices(words: np.ndarray) -> np.ndarray:
    """(n, 24): the codeword index of each 23-bit word and of its 23 neighbours at one bit, repeats included."""
    syndrome = _remainder(words)
    near = np.concatenate([words[:, None], words[:, None] ^ (1 << np.arange(23))], axis=1)
    s = np.concatenate([syndrome[:, None], syndrome[:, None] ^ _UNITS], axis=1)
    return (near ^ _ERRORS[s]) >> 11


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of 64-bit fingerprints; a key is 2 bits of segment pair and two 12-bit indices."""
    parts = [indices(((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)) for at, n in SEGMENTS]
    rows, keys = [], []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        a, b = parts[i], parts[j]
        k = np.concatenate([(a << 12) | b[:, :1], (a[:, :1] << 12) | b[:, 1:]], axis=1) | (pair << 24)
        k.sort(axis=1)
        new = np.ones(k.shape, bool)
        new[:, 1:] = k[:, 1:] != k[:, :-1]
        r, c = np.nonzero(new)
        rows.append(r)
        keys.append(k[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def majority(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes.  Counts stay in bytes, eight to a word, for 255 rows at a time."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 255 * 256):
        part = hashes[i : i + 255 * 256]
        lanes = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        sums = np.add.reduceat(lanes, np.arange(0, len(part), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def remixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Other hashes of the same things."""
    b = (hashes ^ np.uint64(seed)) * np.uint64(0x9FB21C651E98DF25)
    b ^= b >> np.uint64(29)
    b *= np.uint64(0xBF58476D1CE4E5B9)
    return b ^ (b >> np.uint64(32))


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle, repeats included; of the whole sequence if it has fewer words; none for no words."""
    w = text.lower().split()  # bytes: ASCII white space, A-Z only
    if not w:
        return np.zeros(0, np.uint64)
    joined = b" ".join(w)
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([h(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    return np.array([h(joined[s:e], 42) for s, e in zip(starts.tolist(), ends[words - 1 :].tolist(), strict=False)], np.uint64)


def fingerprint(text: bytes, words: int) -> int:
    """The majority of the shingles' hashes; zero for no words."""
    return majority(shingle_hashes(text, words))


def forest(prints: np.ndarray, near: int) -> list[tuple[int, int]]:
    """Edges (row, row) of a spanning forest of the links among fingerprints."""
    if len(prints) <= WIDE:
        return _search(prints, near)
    out: list[tuple[int, int]] = []
    for which in range(len(EXACT)):
        part = exact_segment(prints, which)
        order = np.argsort(part, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            if len(rows) > 1:
                out += [(int(rows[a]), int(rows[b])) for a, b in _search(prints[rows], near)]
    return out


def exact_segment(prints: np.ndarray, which: int) -> np.ndarray:
    """One of the five segments of which 4 differing bits must leave one whole."""
    at, n = EXACT[which]
    return ((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)


def _search(prints: np.ndarray, near: int) -> list[tuple[int, int]]:
    out = []
    left = np.arange(len(prints))
    while len(left) > 1:
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            x = front.pop()
            hit = np.bitwise_count(prints[left] ^ prints[x]) <= near
            if hit.any():
                got = left[hit].tolist()
                out += [(x, y) for y in got]
                front += got
                left = left[~hit]
    return out


def _links(near: int):
    """Over partitions sorted by key: (a, b) ids of linked fingerprints that share a key.  A small bucket gives its pairs, a large one
    a spanning forest."""

    def pairs(key, ids, prints):
        found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[cut, len(key)])
        small = np.repeat(sizes, sizes) <= SMALL
        for d in range(1, min(SMALL, len(key))):
            at = np.flatnonzero((key[d:] == key[:-d]) & small[d:])
            if not len(at):
                break
            at = at[np.bitwise_count(prints[at] ^ prints[at + d]) <= near]
            found.append(np.stack([at, at + d], 1))
        for i in np.flatnonzero(sizes > SMALL).tolist():
            found.append(np.array(forest(prints[cut[i] : cut[i] + sizes[i]], near), np.int64).reshape(-1, 2) + cut[i])
        e = np.unique(np.sort(ids[np.concatenate(found)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["a", "b"])

    def run(batches):
        held: list[list[np.ndarray]] = []
        rows = 0
        for b in batches:
            held.append([C.longs(b, c) for c in ("key", "id", "print")])
            rows += b.num_rows
            if rows >= 200_000:
                key, ids, prints = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
                if cut:
                    yield pairs(key[:cut], ids[:cut], prints[:cut].view(np.uint64))
                held, rows = [[key[cut:], ids[cut:], prints[cut:]]], len(key) - cut
        if rows:
            key, ids, prints = (np.concatenate(x) for x in zip(*held, strict=True))
            yield pairs(key, ids, prints.view(np.uint64))

    return run


def _split_keys(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of keys that are cut further by each of the five exact segments."""
    rows = np.tile(np.arange(len(keys)), len(EXACT))
    cut = [(keys << 17) | (which << 14) | exact_segment(prints, which) | (1 << 62) for which in range(len(EXACT))]
    return rows, np.concatenate(cut)


def hot_keys(nodes: DataFrame) -> np.ndarray | None:
    """Keys that more than WIDE fingerprints are likely to have, judged by a sample of them; None: take all keys for hot, as even
    evenly spread fingerprints would fill them.  It only affects the work, never results."""
    total = nodes.count()
    if 30 * total / (3 << 24) > WIDE / 4:
        return None
    share = min(1.0, SAMPLED / max(1, total))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                yield pa.RecordBatch.from_arrays([pa.array(keys_of(C.longs(b.slice(at, 4096), "print").view(np.uint64))[1])], ["key"])

    seen = nodes.select("print").sample(fraction=share, seed=5).mapInArrow(run, "key long").groupBy("key").count()
    got = seen.where(F.col("count") >= max(16, WIDE * share / 2)).select("key").collect()  # at most 30 x SAMPLED / 16 keys
    return np.sort(np.array([r["key"] for r in got], np.int64))


def linked(nodes: DataFrame, near: int = 4) -> DataFrame:
    """nodes: id, print (distinct fingerprints, at most some of them repeated) -> edges (a, b) that join every pair of at most 4
    differing bits.  A hot key is cut by the five exact segments before it is dealt, so that it goes to many tasks."""
    n, hot = C.partitions(nodes.sparkSession), hot_keys(nodes)
    names = ["key", "id", "print"]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                ids, own = C.longs(part, "id"), C.longs(part, "print")
                rows, keys = keys_of(own.view(np.uint64))
                wide = np.ones(len(keys), bool) if hot is None else C.among(keys, hot)
                more, cut = _split_keys(keys[wide], own[rows[wide]].view(np.uint64))
                rows, keys = np.r_[rows[~wide], rows[wide][more]], np.r_[keys[~wide], cut]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids[rows]), pa.array(own[rows])], names)

    dealt = nodes.select("id", "print").mapInArrow(run, "key long, id long, print long").repartition(n, "key").sortWithinPartitions("key", "id")
    return dealt.mapInArrow(_links(near), "a long, b long")


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""
    d = C.keyed(docs, id_col, text_col).select("doc_id", "text")

    def run(batches):
        for b in batches:
            data, off = C.text_bytes(b.column("text"))
            fp = np.array([fingerprint(data[off[i] : off[i + 1]].tobytes(), words) for i in range(b.num_rows)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, fp long")


def near_duplicates(docs: DataFrame, words: int = 4, near: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id.  Copies share a fingerprint and are never compared."""
    fps = C.stored(fingerprints(docs, words, id_col, text_col), "prints")
    nodes = C.stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    edges = linked(nodes.select(F.col("fp").alias("id"), F.col("fp").alias("print")), near)
    roots = components(edges)
    # root null: a fingerprint that links to no other
    of = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = of.groupBy("root").agg(F.min("low").alias("component_id"))
    named = of.join(least, "root").select("fp", "component_id")
    out = fps.join(named, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Seed of the second half of the check.
SEED = 0x243F6A8885A308D3


def bits_apart(jaccard: float, bits: int, sigmas: float = 0.0) -> int:
    """How many of so many SimHash bits differ at that Jaccard similarity: on average, and so many standard deviations more."""
    p = math.acos(2 * jaccard / (1 + jaccard)) / math.pi
    return int(bits * p + sigmas * math.sqrt(bits * p * (1 - p)))


class WordHashes(dict):
    """Word -> 64-bit hash; forgets all when full, so its memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, words: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of the whole sequence if it has fewer words."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    each, n = np.fromiter(map(cache.__getitem__, w), np.uint64, len(w)), min(words, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h = (h ^ each[j : len(w) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return np.unique(h)


def prefix_size(n: int, similarity: float) -> int:
    """Two sets of that Jaccard similarity share one of so many first members, in any order that is the same for both."""
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def common_shingles(d: DataFrame, total: int, words: int) -> np.ndarray:
    """Hashes of shingles that three or more of the sampled documents hold.  They come last in the order of shingles, so that a
    passage of many documents makes no candidates.  It only affects the work, never results."""

    def run(batches):
        cache = WordHashes()
        for b in batches:
            data, off = C.text_bytes(b.column("text"))
            for i in range(b.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(data[off[i] : off[i + 1]].tobytes(), words, cache).view(np.int64))], ["h"])

    few = d.select("text").sample(fraction=min(1.0, C.SAMPLE_DOCS / max(1, total)), seed=11).mapInArrow(run, "h long")
    got = few.groupBy("h").agg(F.count("*").alias("n")).where("n >= 3").orderBy(F.col("n").desc(), "h").limit(100_000).collect()
    return np.sort(np.array([r["h"] for r in got], np.int64).view(np.uint64))


#: Sets of fewer shingles carry a bitmap of their hashes instead of a SimHash.
FEW_SHINGLES = 64


def checks(s: np.ndarray) -> list[int]:
    """128 bits to tell unlike sets apart: two SimHashes, or for a small set the bits at its hashes modulo 128."""
    if len(s) >= FEW_SHINGLES:
        return [majority(s), majority(remixed(s, SEED))]
    bits = np.zeros(128, bool)
    bits[s & np.uint64(127)] = True
    return [int(x) for x in np.packbits(bits, bitorder="little").view("<u8")]


def _may_reach(similarity: float):
    """Whether pairs of records of one shingle can be of the similarity: bounds by size and by the place of their first common shingle;
    for two small sets, bitmaps that differ in no more bits than the sets may differ in members; these are exact.  For two
    others a 128-bit SimHash at four standard deviations."""
    apart, share = bits_apart(similarity, 128, 4.0), similarity / (1 + similarity)

    def test(x, y):
        n, m, i, j = x[2] >> 32, y[2] >> 32, x[2] & 0xFFFFFFFF, y[2] & 0xFFFFFFFF
        low, high = np.minimum(n, m), np.maximum(n, m)
        ok = (low >= similarity * high - 1e-6) & (np.minimum(n - i, m - j) >= share * (n + m) - 1e-6)
        differ = np.bitwise_count(x[0] ^ y[0]).astype(np.int64) + np.bitwise_count(x[1] ^ y[1])
        most = np.where(high < FEW_SHINGLES, (1 - 2 * share) * (n + m) + 1e-6, apart)
        return ok & ((differ <= most) | ((low < FEW_SHINGLES) & (high >= FEW_SHINGLES)))

    return test


#: A large bucket's centre is its first member in one of eight orders, by the key, so that a document meets some twenty centres.
ORDERS = np.random.default_rng(41).integers(-(2**63), 2**63, 8, dtype=np.int64)


def _candidates(similarity: float):
    """Over partitions sorted by (key, o), where o is the id in the key's order - kind 0: all candidate pairs (a, b) of small buckets; 2:
    those of large ones with their first member a; 1: the records of large buckets, whose other pairs wait for the
    components of these.  A bucket of any size is streamed; only its first member is kept."""
    may = _may_reach(similarity)
    names = ["kind", "a", "b", "key", "c0", "c1", "at"]

    def rows(cols, carried: bool, goes_on: bool):
        key, o, c0, c1, at = cols
        ids, u = o ^ ORDERS[key & 7], [c0.view(np.uint64), c1.view(np.uint64), at]
        take = lambda rows: [c[rows] for c in u]
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[cut, len(key)])
        wide = sizes > SMALL
        wide[0] |= carried
        wide[-1] |= goes_on
        small = ~np.repeat(wide, sizes)
        found = [np.zeros((0, 2), np.int64)]
        for d in range(1, min(SMALL, len(key))):
            near = np.flatnonzero((key[d:] == key[:-d]) & small[d:])
            if not len(near):
                break
            near = near[may(take(near), take(near + d))]
            found.append(np.stack([ids[near], ids[near + d]], 1))
        pairs = np.unique(np.sort(np.concatenate(found), 1), axis=0)
        large = np.flatnonzero(~small)
        centre = np.repeat(cut, sizes)[large]
        hit = may(take(large), take(centre)) & (ids[large] != ids[centre])
        stars = np.unique(np.stack([ids[centre[hit]], ids[large[hit]]], 1), axis=0)
        large = large[large > 0] if carried else large
        none = np.zeros(len(pairs) + len(stars), np.int64)
        ends = [np.r_[pairs[:, i], stars[:, i], ids[large]] for i in (0, 1)]
        kind = np.repeat(np.array([0, 2, 1], np.int32), [len(pairs), len(stars), len(large)])
        return pa.RecordBatch.from_arrays([pa.array(kind), *map(pa.array, ends), *[pa.array(np.r_[none, c[large]]) for c in (key, c0, c1, at)]], names)

    def run(batches):
        held: list[list[np.ndarray]] = []
        first, n = None, 0  # the first member of a bucket of which a part is done

        def done(cols, goes_on):
            carried = first is not None and bool(cols[0][0] == first[0][0])
            return rows([np.r_[f, c] for f, c in zip(first, cols, strict=True)] if carried else cols, carried, goes_on)

        for b in batches:
            held.append([C.longs(b, c) for c in ("key", "o", "c0", "c1", "at")])
            n += b.num_rows
            if n >= 200_000:
                cols = [np.concatenate(x) for x in zip(*held, strict=True)]
                cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last key may go on
                if cut:
                    yield done([c[:cut] for c in cols], False)
                    first = None
                if n - cut >= 200_000:
                    rest = [c[cut:] for c in cols]
                    yield done(rest, True)
                    first = first if first is not None and first[0][0] == rest[0][0] else [c[:1] for c in rest]
                    held, n = [], 0
                else:
                    held, n = [[c[cut:] for c in cols]], n - cut
        if n:
            yield done([np.concatenate(x) for x in zip(*held, strict=True)], False)

    return run


#: Shingles just before its own that a record of a block carries.
BEFORE = 8


def _earlier(columns: list[pa.Array]) -> np.ndarray:
    """The shingles of each record's `before`, one row of BEFORE and whether there is one, as a structured array."""
    out = np.zeros((sum(map(len, columns)), BEFORE), [("h", np.int64), ("is", bool)])
    at = 0
    for c in columns:
        data, off = C.text_bytes(c)
        count = np.diff(off) // 8
        own = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        out["h"][at + own, place] = np.frombuffer(data[off[0] : off[-1]].tobytes(), np.int64)
        out["is"][at + own, place] = True
        at += len(c)
    return out


def _apart(similarity: float):
    """Over blocks of large buckets, sorted by (key, block): pairs (a, b) of different roots, of two sides if the block has two, that
    may be of the similarity.  A pair that shares one of the shingles just before this bucket's is left to that one's bucket: both
    records come earlier there, so their bounds are no tighter, and the first bucket of a pair always gives it."""
    may = _may_reach(similarity)

    def block(before, ids, root, c0, c1, at, side):
        u = [c0.view(np.uint64), c1.view(np.uint64), at]
        _, comp = np.unique(root, return_inverse=True)
        found, two = [], bool(side.any()) and not bool(side.all())
        rare = np.flatnonzero(comp != np.bincount(comp).argmax())  # of two members, one at least is of another root than most
        for i in range(0, len(rare), 64):
            x = rare[i : i + 64, None]
            ok = (comp[x] != comp) & may([c[x] for c in u], u)
            if two:
                ok &= side[x] != side
            p, q = np.nonzero(ok)
            p = x[p, 0]
            for j in range(0, len(p), 4096):
                f, t = before[p[j : j + 4096], :, None], before[q[j : j + 4096], None, :]
                new = ~((f["h"] == t["h"]) & f["is"] & t["is"]).any((1, 2))
                found.append(np.stack([ids[p[j : j + 4096][new]], ids[q[j : j + 4096][new]]], 1))
        return np.unique(np.sort(np.concatenate(found), 1), axis=0) if found else np.zeros((0, 2), np.int64)

    def run(batches):
        now, held = None, []

        def solved():
            pairs = block(_earlier([p.column("before") for p in held]), *[np.concatenate([C.longs(p, c) for p in held]) for c in ("id", "root", "c0", "c1", "at", "side")])
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for b in batches:
            keys, blocks = C.longs(b, "key"), C.longs(b, "block")
            cut = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1])][: b.num_rows]).tolist()
            for s, e in zip(cut, [*cut[1:], b.num_rows], strict=True) if cut else ():
                mine = (int(keys[s]), int(blocks[s]))
                if held and mine != now:
                    yield solved()
                    held = []
                now = mine
                held.append(b.slice(s, e - s))
        if held:
            yield solved()

    return run


def _verified(similarity: float, words: int):
    """Over rows sorted by group and kind - kind 0: the texts of a group, 1: its pairs (a, b) -: those pairs of the similarity that
    are not joined by earlier ones, a spanning forest of all that are."""

    def run(batches):
        now, sets, up, cache = None, {}, {}, WordHashes()

        def find(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for b in batches:
            out = []
            for g, a, z, text in zip(*(b.column(c).to_pylist() for c in ("g", "a", "b", "text")), strict=True):
                if g != now:
                    now, sets, up = g, {}, {}
                if text is not None:
                    if a not in sets:  # a document given twice
                        sets[a] = shingle_set(text.encode("utf-8", "surrogatepass"), words, cache)
                elif (i := find(a)) != (j := find(z)):
                    s, t = sets[a], sets[z]
                    low, high = sorted((len(s), len(t)))
                    both = int(C.among(s, t).sum()) if low >= similarity * high - 1e-9 else 0
                    if both >= similarity * (low + high - both) - 1e-9:
                        up[i] = j
                        out.append((a, z))
            pairs = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


#: Members of a large bucket that one task compares with as many others; shingles whose sets one task holds to verify pairs.
BLOCK, GROUP = 4096, 250_000
#: First members of large buckets that a document is compared with in the first round; the second one compares all that are still apart.
CENTRES = 4


class _Sets:
    """The distinct shingle sets of documents, and the verification of candidate pairs of them."""

    def __init__(self, d: DataFrame, words: int, similarity: float):
        self.d, self.words, self.similarity, self.n = d, words, similarity, C.partitions(d.sparkSession)
        self.docs = d.count()
        hot = common_shingles(d, self.docs, words)

        def prints(batches):
            cache = WordHashes()
            for b in batches:
                data, off = C.text_bytes(b.column("text"))
                ids, at, first = np.zeros(b.num_rows, np.uint64), np.zeros((3, b.num_rows), np.int64), []
                for i in range(b.num_rows):
                    s = shingle_set(data[off[i] : off[i + 1]].tobytes(), words, cache)
                    late = C.among(s, hot)
                    ids[i] = xxhash.xxh3_64_intdigest(s.tobytes())
                    at[:, i] = len(s), *np.array(checks(s), np.uint64).view(np.int64)
                    first.append(np.concatenate([s[~late], s[late]])[: prefix_size(len(s), similarity)].tobytes())
                yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("th"), pa.array(ids.view(np.int64)), *map(pa.array, at), pa.array(first, pa.binary())], ["doc", "th", "id", "n", "c0", "c1", "first"])

        every = C.stored(d.mapInArrow(prints, "doc long, th long, id long, n long, c0 long, c1 long, first binary"), "prints")
        self.nodes = self.stored(every.groupBy("id").agg(F.min(F.struct("doc", "th", "n", "c0", "c1", "first")).alias("x")).select("id", "x.*"), "nodes")
        self.keys = self.stored(every.select("doc", "th", "id"), "keys")
        C.drop_stored(every)  # the prefixes are in nodes

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        """In as many files as the documents need."""
        return C.stored(C.sized(df, self.docs), label)

    def postings(self) -> DataFrame:
        """key (a shingle of the prefix), o, c0, c1, at (size and place), in order."""

        def deal(batches):
            for b in batches:
                for i in range(0, b.num_rows, 2048):
                    part = b.slice(i, 2048)
                    data, off = C.text_bytes(part.column("first"))
                    count = np.diff(off) // 8
                    own = np.repeat(np.arange(len(count)), count)
                    place = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
                    ids, size, c0, c1 = (C.longs(part, c)[own] for c in ("id", "n", "c0", "c1"))
                    key = np.frombuffer(data[off[0] : off[-1]].tobytes(), np.int64)
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (key, ids ^ ORDERS[key & 7], c0, c1, (size << 32) | place))], ["key", "o", "c0", "c1", "at"])

        rows = self.nodes.select("id", "n", "c0", "c1", "first").mapInArrow(deal, "key long, o long, c0 long, c1 long, at long")
        return rows.repartition(self.n, "key").sortWithinPartitions("key", "o")

    def check(self, asked: DataFrame) -> DataFrame:
        """asked: g, a, b -> links (a, b).  Each text goes once to each group that asks for it."""
        need = self.stored(asked.select("g", F.col("a").alias("id")).unionByName(asked.select("g", F.col("b").alias("id"))).distinct(), "need")
        own = need.join(self.nodes.select("id", "doc", "th"), "id")
        few = need.count() <= 100_000  # rows of five numbers
        text = self.d.join(F.broadcast(own) if few else own, ["doc", "th"])
        members = text.select("g", F.lit(0).alias("kind"), F.col("id").alias("a"), F.lit(0).cast("long").alias("b"), "text")
        both = members.unionByName(asked.select("g", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("string").alias("text")))
        dealt = both.repartition(self.n, "g").sortWithinPartitions("g", "kind", "a", "b")
        return self.stored(dealt.mapInArrow(_verified(self.similarity, self.words), "a long, b long"), "links")

    def stars(self, pairs: DataFrame) -> DataFrame:
        """Groups of bounded size: pairs of one a, cut by b.  Pairs and groups are read several times."""
        pairs = self.stored(pairs, "wide")
        load = pairs.join(self.nodes.select(F.col("id").alias("b"), "n"), "b").groupBy("a").agg(F.ceil(F.sum("n") / GROUP).alias("cuts"))
        return self.stored(pairs.join(load, "a").select(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("cuts"))).alias("g"), "a", "b"), "stars")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The links (a, b) among candidate pairs, a spanning forest of them.  A task verifies all pairs of one component of
        candidates; a component of over GROUP shingles goes by stars, first with one pair a document, then with those of
        documents that are still apart."""
        near = components(pairs)
        asked = self.stored(pairs.join(near.withColumnRenamed("node", "a"), "a"), "asked")  # read several times
        load = near.join(self.nodes.select(F.col("id").alias("node"), "n"), "node").groupBy("root").agg(F.sum("n").alias("n"))
        heavy = C.stored(load.where(F.col("n") > GROUP).select("root"), "heavy")
        if heavy.isEmpty():
            return self.check(asked.select(F.col("root").alias("g"), "a", "b"))
        wide = self.stored(asked.join(heavy, "root", "left_semi").select("a", "b"), "wide")
        some = wide.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        plain = asked.join(heavy, "root", "left_anti").select(F.col("root").alias("g"), "a", "b")
        out = self.check(plain.unionByName(self.stars(some)))
        return out.unionByName(self.check(self.stars(still_apart(wide, components(out)))))


def still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends have different roots."""
    one = pairs.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
    two = one.join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    return two.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def similar_classes(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc, th, id) of every document and (id, root) of every distinct shingle set: the connected components of all pairs of
    documents whose sets of five-word shingles (a text of fewer words is one) have that Jaccard similarity.

    Pairs come from the Golay keys of the sets' SimHashes, and, for those more than 4 bits apart, from a prefix join: in an order of
    all shingles, by hash and the common ones last, two such sets share one of their first fifth.  Every link is verified on
    the whole sets before components are taken.  Large buckets take two rounds, so that a large class needs no comparison of
    all its pairs: first those with one member, then those of members that are still apart, in blocks.
    """
    with C.shuffles_freed(docs.sparkSession):  # else those of several steps, each up to the size of the texts, are on disk at once
        return _classes(_Sets(C.keyed(docs, id_col, text_col).select("doc", "th", "text"), words, similarity))


def _classes(s: _Sets) -> tuple[DataFrame, DataFrame]:
    by_print = linked(s.nodes.where(F.col("n") >= FEW_SHINGLES).select("id", F.col("c0").alias("print")))
    found = s.stored(s.postings().mapInArrow(_candidates(s.similarity), "kind int, a long, b long, key long, c0 long, c1 long, at long"), "candidates")
    some = Window.partitionBy("b").orderBy(F.xxhash64("a"), "a")
    stars = found.where("kind = 2").select("a", "b").distinct().withColumn("r", F.row_number().over(some)).where(F.col("r") <= CENTRES)
    pairs = found.where("kind = 0").select("a", "b").unionByName(by_print).unionByName(stars.select("a", "b"))
    edges = s.links(s.stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs"))
    roots = components(edges)
    large = found.where("kind = 1").select(F.col("a").alias("id"), "key", "c0", "c1", "at")
    if not large.isEmpty():
        place = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
        start = F.greatest(place - BEFORE, F.lit(0))
        before = F.substr("first", (8 * start + 1).cast("int"), (8 * (place - start)).cast("int"))
        ranked = large.join(s.nodes.select("id", "first"), "id").withColumn("before", before).drop("first")
        rooted = ranked.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        open_ = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count("*") / BLOCK).cast("int").alias("m")).where("lo < hi").select("key", "m")
        cut = rooted.join(open_, "key").withColumn("sub", F.pmod(F.xxhash64("id"), F.col("m")).cast("int"))
        cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        block = (F.least("sub", "with") * F.col("m") + F.greatest("sub", "with")).cast("long")
        cut = cut.select("key", block.alias("block"), "id", "root", "c0", "c1", "at", "before", (F.col("sub") > F.col("with")).cast("long").alias("side"))
        more = cut.repartition(s.n, "key", "block").sortWithinPartitions("key", "block").mapInArrow(_apart(s.similarity), "a long, b long")
        more = s.stored(more.distinct(), "pairs")
        if not more.isEmpty():
            roots = components(edges.unionByName(s.links(more)))
    of = s.nodes.select("id").join(roots.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    return s.keys.select("doc", "th", "id"), of


def similar_documents(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc, th, root of every document."""
    keys, of = similar_classes(docs, words, similarity)
    return keys.join(of, "id").select("doc", "th", "root")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each near-duplicate class stays: the one of the least id.  A document given twice stays once."""
    keys, of = similar_classes(docs, words, similarity)
    # the first copy of each shingle set before the join, so that a large group of copies is one row there
    first = keys.groupBy("id").agg(F.min(F.struct("doc", "th")).alias("b"))
    best = first.join(of, "id").groupBy("root").agg(F.min("b").alias("b")).select("b.doc", "b.th")
    wide, back = C.with_key(docs)
    kept = wide.join(best, ["doc", "th"], "left_semi").dropDuplicates(["doc", "th"])
    return back(kept)


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: four words, 4 bits."""
    return near_duplicates(C.table(spark, sf_dir, "documents"), words=4, near=4)


def brute(rows: list[tuple], words: int = 4, near: int = 4) -> dict:
    """All pairs, for tests: {(doc_id, text): (hex, component_id)}."""
    fps = np.array([fingerprint((t or "").encode(), words) for _, t in rows], np.uint64)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= near).tolist():
            a, b = find(i), find(i + 1 + j)
            root[max(a, b)] = min(a, b)
    least: dict[int, int | None] = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (least.get(r) is None or d < least[r]):
            least[r] = d
    return {r: (f"{fps[i]:016x}", least.get(find(i))) for i, r in enumerate(rows)}
