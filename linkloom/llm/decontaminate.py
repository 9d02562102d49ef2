"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

A window is `size` consecutive words of a benchmark item; a shorter item is one window.  A document contains a window only if
it contains each of its shingles (up to three words), so one necessary shingle per window is enough to join on: the rarest,
by its count over all documents.  Two scans of the texts:

1. counts of the benchmark's shingles in the documents (partial aggregation);
2. the join on each window's rarest shingle, with a positional bound (the shingle's place in the window must fit before
   and after it) and an exact check of the words.

The search never shuffles the documents: the benchmark's shingles are broadcast where their measured number stays under
`broadcast_rows`; beyond that the shingles of the documents are joined by key, with the words around each.  Covered words
are counted per document from the sorted starts of its windows.  `clean_documents` broadcasts the keys of the documents that
go, if they are no more than `BROADCAST_DOCS`; else it shuffles the texts too.

Defined results: null text has no words; an item without words has no window; items that are equal count as several items;
null item ids count as an item of no name (not listed).  A document given twice (same id and text) gets the same row twice.
Other columns are ignored; empty tables work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm import common as C

WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shingles of up to so many words are joined on.
GRAM = 3
#: All windows together must have at most so many characters to be broadcast.
BROADCAST_CHARS = 64_000_000
#: So many documents with a window, rows of two numbers, are broadcast to the others.
BROADCAST_DOCS = 500_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def windows(items: DataFrame, size: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(item_id, win) of every window, and its distinct windows: win (the words joined), ws, n."""
    i = C.pick(items, item_id=id_col, text=text_col).select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    w = i.select(F.col("item_id").cast("string").alias("item_id"), "w", F.explode(starts).alias("s"))
    w = w.select("item_id", F.array_join(F.slice("w", F.col("s") + 1, F.lit(size)), " ").alias("win"))
    d = w.select("win").distinct().withColumn("ws", F.split("win", " ")).withColumn("n", F.size("ws"))
    return w, d


def shingle(ws: Column, at: Column, k: int) -> Column:
    """The hash of k words from the 0-based place on."""
    return F.xxhash64(F.lit(k), *[F.get(ws, at + j) for j in range(k)])


def spots(docs: DataFrame, k: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every k-word shingle of the documents with its place."""
    d = docs.select(*keep, "ws", F.posexplode("ws").alias("at", "word"))
    return d.where(F.col("at") + k <= F.size("ws")).withColumn("g", shingle(F.col("ws"), F.col("at"), k))


def hits(docs: DataFrame, items: DataFrame, size: int, broadcast_rows: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc, th, s, n, win) of every occurrence of a window, and (item_id, win)."""
    every, wins = windows(items, size, id_col, text_col)
    every = C.stored(every, "items")
    wins = C.stored(C.sized(wins, every.count(), C.ROWS_A_TASK), "windows")
    k = F.least(F.col("n"), F.lit(GRAM))
    grams = wins.select("win", "ws", "n", k.alias("k"), F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("off"))
    one = F.coalesce(*[F.when(F.col("k") == j, shingle(F.col("ws"), F.col("off"), j)) for j in range(1, GRAM + 1)])
    grams = C.stored(grams.withColumn("g", one), "grams")
    # what is sent has at most one row per shingle and, in the second scan, the text of each window once
    rows, chars = grams.count(), wins.agg(F.coalesce(F.sum(F.length("win")), F.lit(0))).first()[0]
    small = rows <= broadcast_rows and chars <= BROADCAST_CHARS
    sent = F.broadcast if small else (lambda x: x)
    texts = docs.select("doc", "th", words(F.col("text")).alias("ws"))
    used = [r["k"] for r in grams.select("k").distinct().collect()]  # at most GRAM values
    counts = None
    for j in used:
        seen = spots(texts, j).select("g").join(sent(grams.where(F.col("k") == j).select("g").distinct()), "g").groupBy("g").count()
        counts = seen if counts is None else counts.unionByName(seen)
    if counts is None:
        return None, every
    few = (lambda x: C.sized(x, rows, C.ROWS_A_TASK)) if small else (lambda x: x)
    rarity = C.stored(few(counts), "rarity")
    first = Window.partitionBy("win").orderBy(F.col("count").asc(), "g", "off")
    # a window with a shingle that no document has can't occur: the inner join drops that shingle, so it is kept at 0 here
    ranked = grams.join(rarity, "g", "left").fillna(0, ["count"]).withColumn("r", F.row_number().over(first)).where("r = 1 AND count > 0")
    prefix = C.stored(few(ranked.select("g", "win", "n", "k", "off")), "prefix")
    out = None
    for j in used:
        own = prefix.where(F.col("k") == j).select("g", "win", "n", "off")
        if small:
            met = spots(texts, j, ("doc", "th")).join(F.broadcast(own), "g")
            got = F.array_join(F.slice("ws", F.col("at") - F.col("off") + 1, F.col("n")), " ")
            fits = (F.col("at") >= F.col("off")) & (F.col("at") - F.col("off") + F.col("n") <= F.size("ws"))
            met = met.where(F.when(fits, got == F.col("win")).otherwise(False)).withColumn("s", F.col("at") - F.col("off"))
        else:
            lo = F.greatest(F.col("at") - (size - 1), F.lit(0))
            near = spots(texts, j, ("doc", "th")).select("doc", "th", "g", "at", lo.alias("lo"), F.slice("ws", lo + 1, F.lit(2 * size)).alias("near"))
            s = F.col("at") - F.col("off") - F.col("lo")
            met = near.join(own, "g").withColumn("s0", s).where("s0 >= 0")
            met = met.where(F.array_join(F.slice("near", F.col("s0") + 1, F.col("n")), " ") == F.col("win")).withColumn("s", F.col("at") - F.col("off"))
        met = met.select("doc", "th", "s", "n", "win")
        out = met if out is None else out.unionByName(met)
    return C.stored(C.packed(out, docs.count()), "hits"), every


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, broadcast_rows: int = 300_000, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc, th, doc_id, n_words, n_hit, item_ids (as strings, sorted) of every document."""
    d = C.keyed(docs, id_col, text_col)
    found, every = hits(d, items, size, broadcast_rows, item_id, item_text)
    n_words = F.regexp_count(F.col("text"), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")).cast("long")
    skinny = d.select("doc_id", "doc", "th", n_words.alias("n_words"))
    if found is None:
        return skinny.select("doc", "th", "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"))
    ends = Window.partitionBy("doc", "th").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("doc", "th", "s").agg(F.max("n").alias("n"))
    reach = F.coalesce(F.max(F.col("s") + F.col("n")).over(ends), F.lit(0))
    hit = spans.withColumn("new", F.greatest(F.lit(0), F.col("s") + F.col("n") - F.greatest(F.col("s"), reach))).groupBy("doc", "th").agg(F.sum("new").cast("long").alias("n_hit"))
    names = found.select("doc", "th", "win").distinct().join(every, "win").select("doc", "th", "item_id").distinct()
    listed = names.groupBy("doc", "th").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    facts = hit.join(listed, ["doc", "th"])
    out = skinny.join(facts, ["doc", "th"], "left")
    return out.select("doc", "th", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def clean_documents(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The documents without any occurrence of a window, all columns as they were."""
    found, _ = hits(C.keyed(docs), items, size, 300_000, "item_id", "text")
    wide, back = C.with_key(docs)
    if found is not None:
        hit = found.select("doc", "th").distinct()
        # Spark judges them by the files of hits, which hold the windows too, and would shuffle all texts
        wide = wide.join(F.broadcast(hit) if hit.count() <= BROADCAST_DOCS else hit, ["doc", "th"], "left_anti")
    return back(wide)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: 10 words."""
    docs = C.table(spark, sf_dir, "documents")
    out = C.sized(decontaminate(docs, C.table(spark, sf_dir, "benchmark")), docs.count(), C.ROWS_A_TASK)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = {
    "op1_decontaminate": f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT item_id, len(w[s + 1:s + 10]) AS n, array_to_string(w[s + 1:s + 10], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)
), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT doc_id, n, s, array_to_string(w[s + 1:s + n], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS s FROM d CROSS JOIN sizes)
), hit AS (
  SELECT doc_id, s, n, item_id FROM pos JOIN win USING (n, win)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
}
