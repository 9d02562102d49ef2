"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every word falls into one of 4,096 word buckets, and its shape (runs of upper and lower case, digits and each other mark)
into one of 512 more; two more stand for a word that repeats the one before it, or the one before that.  A bucket has a sparse random index vector; its word vector is the sum of the index vectors of the
words within two places of it in the sample, scaled to unit length.  A document is the mean of its words' index and word
vectors.  A network of one tanh layer and one logistic output, in numpy, is fitted on a bounded sample of labelled documents;
a temperature fitted on a fifth of them set aside calibrates its probabilities.

Defined results: null or blank text has the zero vector and so gets the network's score of it; without any labelled rows the
score is 0.5.  Labels of null id or null quality are ignored; of several labels of one id the least counts.  Repeated rows all
appear; other columns are ignored; empty tables work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import common as C
from linkloom.llm.language_id import crc_mod

WORDS, SHAPES, DIM, HIDDEN = 4096, 512, 64, 48
BUCKETS = WORDS + SHAPES + 2
#: The classifier is fitted on at most so many labelled documents.
SAMPLE = 4000
CACHE = 200_000
_KIND = bytes.maketrans(bytes(range(256)), bytes(ord("A") if 65 <= i <= 90 else ord("a") if 97 <= i <= 122 or i >= 128 else ord("0") if 48 <= i <= 57 else i for i in range(256)))


def shape(word: bytes) -> bytes:
    """Runs of upper case, lower case, digits and equal marks, each as one sign."""
    k = word.translate(_KIND)
    return bytes(c for i, c in enumerate(k) if not i or c != k[i - 1])


class Buckets(dict):
    """Word -> (word bucket, shape bucket) as one number; forgets all when full, so its memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        w = xxhash.xxh32_intdigest(word.lower()) % WORDS
        s = xxhash.xxh32_intdigest(shape(word)) % SHAPES
        self[word] = w * SHAPES + s
        return self[word]


def codes(raw: bytes, cache: Buckets) -> np.ndarray:
    words = raw.split()
    return np.fromiter(map(cache.__getitem__, words), np.int64, len(words))


def counts(code: np.ndarray) -> np.ndarray:
    """How often each bucket occurs, over the number of words."""
    again = [np.count_nonzero(code[d:] == code[:-d]) for d in (1, 2)]
    out = np.concatenate([np.bincount(code // SHAPES, minlength=WORDS), np.bincount(code % SHAPES, minlength=SHAPES), again]).astype(np.float32)
    return out / max(1, len(code))


def index_vectors() -> np.ndarray:
    """(BUCKETS, DIM): six signs at random places of each."""
    rng = np.random.default_rng(31)
    out = np.zeros((BUCKETS, DIM), np.float32)
    for i in range(BUCKETS):
        out[i, rng.choice(DIM, 6, replace=False)] = rng.choice([-1.0, 1.0], 6)
    return out / np.sqrt(6)


INDEX = index_vectors()


def contexts(code: np.ndarray, total: np.ndarray, window: int = 2) -> None:
    """Adds to each word's and shape's row the index vectors of the words near it."""
    w, s = code // SHAPES, code % SHAPES + WORDS
    for d in range(1, window + 1):
        if len(code) > d:
            for near, at in ((slice(d, None), slice(None, -d)), (slice(None, -d), slice(d, None))):
                v = INDEX[w[near]] + INDEX[s[near]]
                np.add.at(total, w[at], v)
                np.add.at(total, s[at], v)


class Network:
    """Two layers, weighted logistic loss, Adam; then a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, vectors: np.ndarray, steps: int = 500):
        self.vectors = vectors
        rng = np.random.default_rng(17)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-4
        z = (x - self.mean) / self.std
        aside = rng.permutation(len(y)) % 5 == 0
        fit = ~aside if (~aside).sum() > 4 and len(np.unique(y[~aside])) > 1 else np.ones(len(y), bool)
        p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        zf, yf = z[fit], y[fit]
        for t in range(1, steps + 1):
            rows = rng.choice(len(yf), min(512, len(yf)), replace=False)
            a, b = zf[rows], yf[rows]
            h = np.tanh(a @ p[0] + p[1])
            e = (1 / (1 + np.exp(-(h @ p[2] + p[3][0]))) - b) / len(b)
            back = np.outer(e, p[2]) * (1 - h * h)
            g = [a.T @ back + 1e-3 * p[0], back.sum(0), h.T @ e + 1e-3 * p[2], np.array([e.sum()])]
            for i in range(4):
                m[i] = 0.9 * m[i] + 0.1 * g[i]
                v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                p[i] = p[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.p, self.heat = p, 1.0
        if aside.any():
            s, b = self.logit(x[aside]), y[aside]
            loss = lambda t: np.logaddexp(0, -np.where(b > 0, s, -s) / t).mean()
            self.heat = float(min(np.geomspace(0.3, 10, 60), key=loss))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.std) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def score(self, freq: np.ndarray) -> np.ndarray:
        """Probabilities of label 1, from bucket frequencies."""
        return 1 / (1 + np.exp(-self.logit(freq @ self.vectors) / self.heat))


def fit(docs: DataFrame, labels: DataFrame, target: str, most: int = SAMPLE) -> Network | None:
    """docs: doc_id, text.  The `most` labelled documents of the least id hash; their frequencies and the sums of context vectors,
    one table a task, reach the driver."""
    ids = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(target).cast("int").alias("y"))
    few = C.stored(ids.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(most), "sample")  # bounded: at most `most` ids
    # all tasks scan; the bounded sample alone is dealt to a few, as each of those sends one table of context sums
    chosen = docs.join(F.broadcast(few), "doc_id").select("doc_id", "text", "y").repartition(8)
    names = ["doc_id", "y", "data"]

    def run(batches):
        cache, total, any_row = Buckets(), np.zeros((BUCKETS, DIM), np.float32), False
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part, out = b.slice(i, 64), []
                for t in part.column("text").to_pylist():
                    code = codes(t.encode("utf-8", "replace"), cache)
                    contexts(code, total)
                    f = counts(code)
                    at = np.flatnonzero(f)
                    out.append(at.astype("<u2").tobytes() + f[at].astype("<f4").tobytes())
                any_row = True
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("y"), pa.array(out, pa.binary())], names)
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([-1], pa.int32()), pa.array([total.tobytes()], pa.binary())], names)

    got = sorted(chosen.mapInArrow(run, "doc_id long, y int, data binary").collect(), key=lambda r: (r["doc_id"], r["y"], len(r["data"])))
    rows = [r for r in got if r["y"] >= 0]
    if len(rows) < 4:
        return None
    total = np.sum([np.frombuffer(r["data"], np.float32).reshape(BUCKETS, DIM).astype(np.float64) for r in got if r["y"] < 0], axis=0)
    context = total / np.maximum(1e-9, np.linalg.norm(total, axis=1, keepdims=True))
    vectors = np.concatenate([INDEX, context.astype(np.float32)], axis=1)
    freq = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        n = len(r["data"]) // 6
        freq[i, np.frombuffer(r["data"][: 2 * n], "<u2")] = np.frombuffer(r["data"][2 * n :], "<f4")
    return Network((freq @ vectors).astype(np.float64), np.array([float(r["y"] > 0) for r in rows]), vectors)


def grade(docs: DataFrame, model: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every document."""
    d = C.pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        cache = Buckets()
        for b in batches:
            data, off = C.text_bytes(b.column("text"))
            for i in range(0, b.num_rows, 128):
                n = min(128, b.num_rows - i)
                freq = np.stack([counts(codes(data[off[j] : off[j + 1]].tobytes(), cache)) for j in range(i, i + n)])
                s = model.score(freq) if model else np.full(n, 0.5)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, n), pa.array(s.astype(np.float64))], ["doc_id", "score"])

    return d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, score double")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: learns from labels whose crc32 modulo 5 is not 0; predicted from 0.3 on."""
    docs = C.table(spark, sf_dir, "documents")
    labels = C.pick(C.table(spark, sf_dir, "labels"), doc_id="doc_id", quality="quality")
    texts = C.pick(docs, doc_id="doc_id", text="text").where("text IS NOT NULL")
    model = fit(texts, labels.where(crc_mod(F.col("doc_id"), 5) != 0), "quality")
    out = grade(docs, model)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
