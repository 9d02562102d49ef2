"""Language ID by a string kernel.

The blended-spectrum presence kernel of two texts is the number of byte n-grams (n = 1 to 4, lower-cased UTF-8, hashed to
32,768 features) that both contain, over the root of the product of their numbers.  A bounded sample of labelled texts gives
the Nystroem landmarks and the training set of one-versus-rest kernel ridge regression.  Texts are scored in batches by two
matrix products: presence against landmarks, then kernel values against the weights.

Defined results: null text, or text without letters, is `und` with score 0; so is every text if there is no labelled one.  The
score is the softmax of the one-versus-rest outputs.  Repeated rows all appear; other columns are ignored; empty tables
work.  Long texts are read whole, in blocks.
"""

from __future__ import annotations

import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm import common as C

FEATURES, GRAMS = 1 << 15, 4
#: The classifier is fitted on at most SAMPLE_PER_LANG texts of each language, and SAMPLE in all; with more languages fewer of each,
#: but one at least.  There are LANDMARKS landmarks, or one of each language, if that is more.
SAMPLE_PER_LANG, SAMPLE, LANDMARKS = 400, 25_600, 192
RIDGE, SHARP = 1e-3, 6.0
#: A text is of no learned language if fewer than LEAST of its features occur in 3 % of the training texts of the one it is taken for.
LEAST, COMMON, ENOUGH, TEXTS = 0.35, 0.03, 100, 30
_MUL = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x27D4EB2F), np.uint32(0x165667B1))


def _mark(flags: np.ndarray, row: int, raw: np.ndarray) -> None:
    """Sets the features of one block of bytes."""
    g = np.zeros(len(raw), np.uint32)
    b = raw.astype(np.uint32)
    for n in range(GRAMS):
        if len(raw) <= n:
            return
        g = (g[:-1] if n else g) * np.uint32(257) + b[n:] + np.uint32(1)
        flags[row, ((g * _MUL[n]) ^ (g >> np.uint32(15))) * np.uint32(0x9E3779B1) >> np.uint32(17)] = True


def presence(texts: list[str]) -> np.ndarray:
    """(n, FEATURES) booleans."""
    flags = np.zeros((len(texts), FEATURES), bool)
    for i, t in enumerate(texts):
        raw = np.frombuffer(b"\n" + t.lower().encode("utf-8", "replace") + b"\n", np.uint8)
        for at in range(0, len(raw), 1 << 18):
            _mark(flags, i, raw[at : at + (1 << 18) + GRAMS - 1])
    return flags


def has_letters(t: str | None) -> bool:
    return bool(t) and any(map(str.isalpha, t))


def scaled(flags: np.ndarray) -> np.ndarray:
    x = flags.astype(np.float32)
    return x / np.sqrt(np.maximum(1.0, x.sum(1, keepdims=True)))


def opened(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, axis=1).view(bool)


class Kernel:
    """Nystroem features and ridge weights.  Texts come and landmarks are kept as packed bits, and are opened a few at a time."""

    def __init__(self, bits: np.ndarray, langs: np.ndarray, landmarks: int = LANDMARKS):
        self.langs = np.unique(langs)
        landmarks = max(landmarks, len(self.langs))
        order = np.random.default_rng(5).permutation(len(langs))  # landmarks take turns over the languages
        turn = np.zeros(len(order))
        for c in self.langs:
            turn[langs[order] == c] = np.arange((langs == c).sum())
        self.mark_bits = bits[order[np.argsort(turn, kind="stable")][:landmarks]]
        of = np.searchsorted(self.langs, langs)
        k, seen = [], np.zeros((len(self.langs), FEATURES), np.float32)
        for i in range(0, len(bits), 256):
            flags = opened(bits[i : i + 256])
            k.append(scaled(flags) @ self.marks)
            for c in np.unique(of[i : i + 256]).tolist():
                seen[c] += flags[of[i : i + 256] == c].sum(0)
        k, count = np.concatenate(k), np.bincount(of, minlength=len(self.langs))
        values, vectors = np.linalg.eigh((self.marks.T @ self.marks).astype(np.float64))
        keep = values > 1e-6 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])
        z = np.c_[k @ root, np.ones(len(k))]
        y = np.where(langs[:, None] == self.langs, 1.0, -1.0)
        zw = z * (len(langs) / (len(self.langs) * count))[of][:, None]
        a = np.linalg.solve(zw.T @ z + RIDGE * len(k) * np.eye(z.shape[1]), zw.T @ y)
        self.common_bits = np.packbits(seen >= COMMON * count[:, None], axis=1)
        self.judged = count >= TEXTS
        self.weights, self.bias = (root @ a[:-1]).astype(np.float32), a[-1].astype(np.float32)

    @cached_property
    def marks(self) -> np.ndarray:
        return scaled(opened(self.mark_bits)).T.copy()

    @cached_property
    def common(self) -> np.ndarray:
        return opened(self.common_bits).astype(np.float32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("marks", "common")}

    def outputs(self, flags: np.ndarray) -> np.ndarray:
        """(n, languages): near 1 for the own language, -1 for others."""
        return (scaled(flags) @ self.marks) @ self.weights + self.bias

    def learned(self, flags: np.ndarray, outputs: np.ndarray) -> np.ndarray:
        """Whether LEAST of the text's features are common in the language it is taken for.  Texts of under ENOUGH features, and
        languages of under TEXTS training texts, can't be judged so and pass."""
        best, size = outputs.argmax(1), flags.sum(1)
        common = (flags.astype(np.float32) @ self.common.T)[np.arange(len(flags)), best]
        return (common >= LEAST * size) | (size < ENOUGH) | ~self.judged[best]

    def score(self, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = SHARP * outputs
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return self.langs[best], p[np.arange(len(p)), best].astype(np.float64)


def crc_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % m


def fit(docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str, per_lang: int = SAMPLE_PER_LANG, most: int = SAMPLE) -> Kernel | None:
    """Fitted on the `per_lang` documents of each language (fewer, if there are so many languages that they would be more than `most`
    in all) with the least hash of id and text; only their features reach the driver."""
    d = C.pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    able = d.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    able = able.withColumn("h", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"))
    size = C.stored(able.groupBy("lang").agg(F.approx_count_distinct("h").alias("kinds")), "languages")
    n = size.count()
    if not n:
        return None
    per_lang = max(1, min(per_lang, most // n))
    # a bound of the hash leaves about three times the rows wanted of each language, so no task ranks many
    part = F.least(F.lit(1.0), (3.0 * per_lang + 100) / F.greatest("kinds", F.lit(1)))
    ids = able.select("h", "lang").join(size, "lang").where(F.pmod("h", F.lit(1 << 20)) < part * (1 << 20)).select("h", "lang").distinct()
    first = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 20)), "h")
    ids = ids.withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_lang)
    few = C.stored(ids.select("h", "lang"), "sample")

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 128):
                part = b.slice(i, 128)
                texts = part.column("text").to_pylist()
                at = [j for j, t in enumerate(texts) if has_letters(t)]
                bits = np.packbits(presence([texts[j] for j in at]), axis=1)
                yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(at, pa.int32())), pa.array([x.tobytes() for x in bits], pa.binary())], ["lang", "bits"])

    # the sample holds at most `most` hashes, or one of each language
    chosen = able.join(F.broadcast(few), ["h", "lang"]).dropDuplicates(["h", "lang"])
    got = chosen.select("text", "lang").mapInArrow(run, "lang string, bits binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["lang"], bytes(r["bits"])))
    return Kernel(np.frombuffer(b"".join(bytes(r["bits"]) for r in got), np.uint8).reshape(len(got), -1), np.array([r["lang"] for r in got]))


def identify(docs: DataFrame, model: Kernel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    d = C.pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 128):
                part = b.slice(i, 128)
                lang, score, _ = predict(part.column("text").to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, lang_pred string, score double")


def predict(texts: list[str | None], model: Kernel | None) -> tuple[list[str], list[float], np.ndarray]:
    """Language, score, and whether the text is of a learned language."""
    lang, score, known = ["und"] * len(texts), [0.0] * len(texts), np.zeros(len(texts), bool)
    at = [j for j, t in enumerate(texts) if has_letters(t)] if model else []
    if at:
        flags = presence([texts[j] for j in at])
        outputs = model.outputs(flags)
        names, p = model.score(outputs)
        known[at] = model.learned(flags, outputs)
        for j, n, x in zip(at, names.tolist(), p.tolist(), strict=True):
            lang[j], score[j] = n, min(1.0, max(0.0, x))
    return lang, score, known


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents of a learned language; all columns as they were.  Null texts and those without letters go, and longer ones with
    too few n-grams that are common in the language they are taken for.  If no language is labelled, all go.

    Fitted on the documents' own lang column (all labelled rows, by the same bounded sample).  Null ids, repeated rows and ties
    need no care here, as each row is judged by its text alone; an empty table stays empty.
    """
    model = fit(docs, F.lit(True), "doc_id", "text", "lang")
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 128):
                part = b.slice(i, 128)
                yield part.filter(pa.array(predict(part.column(text).to_pylist(), model)[2]))

    return flat.mapInArrow(run, flat.schema).toDF(*names)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: learns from documents whose crc32 modulo 4 is not 2."""
    docs = C.table(spark, sf_dir, "documents")
    model = fit(docs, crc_mod(F.col("doc_id"), 4) != 2, "doc_id", "text", "lang")
    return identify(docs, model).select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def held_out(doc_id: object, m: int, r: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m == r
