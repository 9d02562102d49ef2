"""Ranking, selection and schedules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from linkloom.config import Config
from linkloom.operators import aggregate as A
from linkloom.operators import rank as R
from linkloom.plans.pipeline import prepare_channels
from linkloom.queries.base import CHANNELS, channels, query

BEST = """
best AS (
  SELECT * REPLACE (min(_ord) OVER (PARTITION BY k) AS _ord) FROM ranked
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, q DESC, l DESC, t DESC, _ord) = 1
)"""


@query(f"WITH {CHANNELS}, {BEST} SELECT _ord::BIGINT AS first_ord, name, url, score::BIGINT AS score, quality FROM best")
def q_rank_best_per_key(read, spark):
    """One row per URL key, the best, at the place of the first."""
    return R.best_per_channel(channels(read("part"))).select(F.col("_ord").alias("first_ord"), "name", "url", F.col("score").cast("long").alias("score"), "quality")


CAPPED = """
t AS (SELECT *, row_number() OVER (PARTITION BY nm, tier ORDER BY score DESC, q DESC, l DESC, t DESC, _ord) AS tr
      FROM (SELECT *, trim(regexp_replace(regexp_replace(lower(name), '[|_/\\\\-]+', ' ', 'g'), '\\s+', ' ', 'g')) AS nm FROM {src})),
capped AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY nm ORDER BY (tr > 1)::INT, score DESC, q DESC, l DESC, t DESC, _ord) <= 5)"""


@query(f"WITH {CHANNELS}, {CAPPED.format(src='ranked')} SELECT _ord::BIGINT AS part_key, name, tier FROM capped")
def q_diverse_topk(read, spark):
    """Five rows of a name at most, different qualities first."""
    from linkloom.functions.score import quality_tier

    return R.cap_per_name(channels(read("part")), 5).select(F.col("_ord").alias("part_key"), "name", quality_tier("quality").alias("tier"))


@query(f"""
WITH {CHANNELS}, {BEST}, {CAPPED.format(src='best')},
c AS (
  SELECT *, lower(name || ' ' || extinf || ' ' || group_title) AS blob FROM capped
), s AS (
  SELECT *, regexp_matches(blob, 'steel')::INT + regexp_matches(blob, 'polished')::INT AS a,
         regexp_matches(blob, 'copper')::INT + regexp_matches(blob, 'large|economy')::INT AS b, regexp_matches(blob, 'red|blue|green')::INT AS d FROM c
)
SELECT _ord::BIGINT AS first_ord, name, url, score::BIGINT AS score,
       CASE WHEN category <> '' THEN category WHEN greatest(a, b, d) = 0 THEN 'Other' WHEN a = greatest(a, b, d) THEN 'Steel' WHEN b = greatest(a, b, d) THEN 'Copper' ELSE 'Colour' END AS category
FROM s
""")  # fmt: skip
def q_prepare_pipeline(read, spark):
    """Best per URL, few per name, classified, in playlist order."""
    from linkloom.functions.score import category_of

    rules = (("Steel", ("steel", "polished")), ("Copper", ("copper", "large|economy")), ("Colour", ("red|blue|green",)))
    c = R.cap_per_name(R.best_per_channel(channels(read("part"))), 5)
    c = c.withColumn("category", category_of(F.concat_ws(" ", "name", "extinf", "group_title"), F.col("category"), rules))
    return c.orderBy(*R.playlist_order()).select(F.col("_ord").alias("first_ord"), "name", "url", F.col("score").cast("long").alias("score"), "category")


@query(f"""
WITH {CHANNELS}, {BEST}, {CAPPED.format(src='best')}
SELECT count(*)::BIGINT AS n, sum(score)::BIGINT AS score FROM capped
""")  # fmt: skip
def q_prepare_totals(read, spark):
    """X20 with the stock rules: number and score of what is published."""
    return prepare_channels(channels(read("part")), Config()).agg(F.count("*").alias("n"), F.sum("score").alias("score"))


@query("""
SELECT o_custkey AS channel, o_orderkey AS feed FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderpriority = '1-URGENT') DESC, o_orderkey) = 1
""")
def q_main_feed_pick(read, spark):
    """The first main row, else the first."""
    o = read("orders").select(F.col("o_custkey").alias("channel"), F.when(F.col("o_orderpriority") == "1-URGENT", "TRUE").otherwise("").alias("is_main"), F.col("o_orderkey").alias("_ord"))
    return R.main_feed(o).select("channel", F.col("_ord").alias("feed"))


@query("""
SELECT l_orderkey AS channel, l_linenumber::BIGINT AS line FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_returnflag = 'N') DESC, (l_quantity::INT * (l_partkey % 100)) DESC, l_linenumber, l_partkey, l_suppkey) = 1
""")
def q_best_logo(read, spark):
    """Of those in use, if any, the largest."""
    rows = read("lineitem").withColumn("__n", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")))
    rows = rows.select(F.col("l_orderkey").alias("channel"), F.when(F.col("l_returnflag") == "N", "TRUE").otherwise("").alias("in_use"), F.col("l_quantity").cast("int").cast("string").alias("width"), (F.col("l_partkey") % 100).cast("string").alias("height"), F.col("__n").alias("_ord"), "l_linenumber")
    return R.best_logo(rows).select("channel", F.col("l_linenumber").cast("long").alias("line"))


@query("""
SELECT s_suppkey AS supp, s_name AS name FROM (
  SELECT s.*, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier s)
ORDER BY (s_nationkey = 3)::INT DESC, (CASE WHEN s_acctbal >= 8000 THEN 4 WHEN s_acctbal >= 5000 THEN 3 WHEN s_acctbal >= 2000 THEN 1 ELSE 2 END) DESC, n DESC, s_name LIMIT 40
""")
def q_seed_order_cap(read, spark):
    """Language first, then quality (none and unknown alike), entries, name; 40 rows."""
    bal = F.col("s_acctbal")
    q = F.when(bal >= 8000, "1080p").when(bal >= 5000, "720p").when(bal >= 2000, "480p").otherwise("")
    rows = read("supplier").select("s_suppkey", F.col("s_name").alias("url"), F.col("s_nationkey").alias("channel"), F.when(F.col("s_nationkey") == 3, "x").otherwise("y").alias("language"), q.alias("quality"))
    return R.seed_order(rows, "x", 40).select(F.col("s_suppkey").alias("supp"), F.col("url").alias("name"))


@query("""
WITH q AS (
  SELECT p_name AS key, min(p_partkey) AS id, list_distinct(list_concat(string_split(p_name, ' '), [p_name || ' live'])) AS x, string_split(p_name, ' ') AS w FROM part GROUP BY p_name
), e AS (
  SELECT key, (i - 1)::BIGINT AS pos, CASE WHEN i <= len(w) THEN w[i] ELSE key || ' live' END AS query, md5('7:' || key) AS turn
  FROM (SELECT key, w, unnest(range(1, len(w) + 2)) AS i FROM q)
)
SELECT key, pos, query FROM e QUALIFY row_number() OVER (PARTITION BY query ORDER BY pos, turn, key) = 1
""")
def q_round_robin_schedule(read, spark):
    """Round r has every key's r-th query; the first of equal queries stays."""
    q = read("part").select(F.col("p_name").alias("key")).distinct().withColumn("items", F.concat(F.split("key", " "), F.array(F.concat("key", F.lit(" live")))))
    return R.round_robin(q, "key", "items", 7).select("key", F.col("pos").cast("long").alias("pos"), "query")


@query("""
WITH n AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_name) - 1 AS rn, count(*) OVER () AS n FROM customer)
SELECT id, ((rn - 17 + n) % n)::BIGINT AS pos FROM n WHERE (rn - 17 + n) % n < 100
""")
def q_rotating_window(read, spark):
    """100 names from an offset on, wrapping round."""
    return R.rotating_window(read("customer").select(F.col("c_custkey").alias("id"), "c_name"), 17, 100, ["c_name"]).select("id", "pos")


@query("""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lower(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1
""")
def q_first_wins_dedup(read, spark):
    """The first of equal keys."""
    return R.first_per_key(read("documents").select("doc_id", F.lower("text").alias("k")), ["k"], ["doc_id"]).select("doc_id")


@query("SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 6")
def q_per_group_cap(read, spark):
    """T5, S16, ST11: the first six of each group."""
    return R.per_group(read("documents").select("source", "doc_id", "n_chars"), ["source"], [F.col("n_chars").desc(), "doc_id"], 6).select("source", "doc_id")


@query("SELECT item, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS item FROM part) GROUP BY item")
def q_breakdown_explode(read, spark):
    """A3, K9: explode and count, most first."""
    p = read("part").select(F.col("p_partkey").alias("_ord"), "p_name")
    return A.breakdown(p, F.split("p_name", " ")).select("item", "n")


@query("SELECT p_partkey AS part_key, count(*) OVER (PARTITION BY p_brand)::BIGINT AS entries FROM part")
def q_entries_per_key(read, spark):
    """A2: rows of the same key."""
    return A.with_group_size(read("part").select("p_partkey", "p_brand"), "p_brand").select(F.col("p_partkey").alias("part_key"), "entries")


@query("SELECT l_orderkey AS k, sum((l_returnflag = 'R')::BIGINT)::BIGINT AS ok, count(*)::BIGINT AS sampled FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r <= 3 GROUP BY 1")
def q_sampled_ok(read, spark):
    """How many of the first three entries are good."""
    rows = read("lineitem").select(F.col("l_orderkey").alias("k"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("o"), (F.col("l_returnflag") == "R").alias("ok"))
    return A.sampled_ok(rows, "k", "o", "ok", 3)


@query("SELECT c_mktsegment AS key, max_by(c_name, c_custkey) AS value FROM customer GROUP BY 1")
def q_last_wins_map(read, spark):
    """The value of the last row of a key."""
    return A.last_wins(read("customer"), F.col("c_mktsegment"), F.col("c_name"), "c_custkey")


@query("SELECT DISTINCT p_brand AS website FROM part WHERE p_brand <> '' ORDER BY 1")
def q_distinct_sites(read, spark):
    """A5: distinct non-empty values in order."""
    return A.websites(read("part").select(F.col("p_brand").alias("website")))
