"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key; within its source the keys are cut into ranges of about `per_range` documents, so a hot
source has many.  Words are summed per (source, range), the few sums are accumulated per source, and a window inside each range
gives every document the number of words of its source before it.  A source's budget is some whole epochs and a rest; the
last epoch takes documents in key order up to the rest and cuts the document that crosses it, so the words taken equal the
budget to within one.

Targets: weights 1, 2, 3, repeating over the sources in code-point order (null last), share all words; a target stops at
`max_epochs` times its source's words, and the excess is shared again by weight (water-filling, in closed form).

Defined results: null text has size 0, a null source is a source, a null id is keyed by its text.  Repeated
rows are documents of their own.  Other columns are ignored; an empty table gives an empty table.  Integer arithmetic up to
one final division makes reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm import common as C

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """sizes: source, source_size -> also target.  One row per source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * max_epochs)
    # by cap per weight: a source is capped while its share of what the earlier ones leave exceeds its cap
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))).cast("double"))
    return s.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("w") * F.max("level").over(every)).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, per_range: int = 4_000, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words, repeats counted), epochs (whole ones), rest (words of the last, partial one)."""
    d = pick_sizes(docs, seed, id_col, text_col, source_col)
    d = C.stored(d, "sizes")  # the text is read once
    by_source = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goal = targets(by_source.select("source", "source_size"), weights, max_epochs)
    goal = goal.join(by_source.select(F.col("source").alias("s2"), "n"), C.same(F.col("source"), F.col("s2"))).drop("s2")
    goal = goal.withColumn("ranges", F.ceil(F.col("n") / per_range)).withColumn("budget", F.round("target").cast("long"))

    def source_of(rows: DataFrame, facts: DataFrame) -> DataFrame:
        return rows.join(facts.withColumnRenamed("source", "s2"), C.same(F.col("source"), F.col("s2"))).drop("s2")

    ranged = source_of(d, goal).withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("ranges") / F.lit(2**32)))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"))
    offset = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(F.col("source").alias("s2"), F.col("range").alias("r2"), offset.alias("offset"))
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, C.same(F.col("source"), F.col("s2")) & (F.col("range") == F.col("r2")))
    placed = placed.withColumn("before", F.col("before") + F.col("offset"))
    full = F.when(F.col("source_size") > 0, F.expr("budget DIV source_size")).otherwise(0)
    placed = placed.withColumn("epochs", full.cast("long"))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")))
    placed = placed.withColumn("rest", rest.cast("long"))
    return placed.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("rest")).alias("taken"), "epochs", "rest")


def pick_sizes(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    d = C.pick(docs, doc_id=id_col, source=source_col, text=text_col)
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))  # null ids are spread by their texts
    return d.select("doc_id", "source", size.alias("size"), F.md5(F.concat_ws(":", F.lit(str(seed)), own).cast("binary")).alias("key"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: weights 1, 2, 3; at most three epochs."""
    return mix(C.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = {
    "op5_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', '0', coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))))) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM d GROUP BY source
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER p, 0))::DOUBLE AS level
  FROM s WINDOW p AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, w * max(level) OVER ()) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size
          + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM p
"""
}
