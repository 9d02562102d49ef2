"""Joins, set operations and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions import text as T
from linkloom.operators import enrich as E
from linkloom.operators import graph as Gr
from linkloom.operators import match as M
from linkloom.operators import state as St
from linkloom.queries.base import query
from linkloom.sources import sinks
from linkloom.sources.readers import blocklist


def _db(read):
    """Customers as channels: market segment as category, nation as network."""
    c = read("customer")
    return c.select(
        F.concat(F.lit("c"), "c_custkey", F.lit(".in")).alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("alt "), "c_custkey", F.lit(";")).alias("alt_names"), F.lower("c_mktsegment").alias("categories"),
        (F.col("c_acctbal") < 0).alias("is_nsfw"), F.when(F.col("c_custkey") % 4 == 0, "http://site").otherwise("").alias("website"), F.lit("").alias("network"), F.col("c_custkey").alias("_ord"),
    )


@query("""
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'Own' ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS category,
       CASE WHEN o_orderkey % 5 = 0 THEN n_name ELSE 'Other' END AS language
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def q_enrich_cascade(read, spark):
    """Category of the channel where there is none; the language tag survives where nothing is known."""
    rows = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("o_orderkey").alias("k"), F.col("c_name").alias("name"), F.when(F.col("o_orderkey") % 3 == 0, "Own").otherwise("").alias("category"), F.when(F.col("o_orderkey") % 5 == 0, F.col("n_name")).otherwise("Other").alias("language"), F.lit("").alias("logo"))
    feeds = spark.createDataFrame([], "channel string, is_main string, languages string, _ord long")
    logos = spark.createDataFrame([], "channel string, url string, width string, height string, in_use string, _ord long")
    return E.enrich_by_id(rows, _db(read), feeds, logos).select("k", "category", "language")


@query("""
WITH n AS (SELECT DISTINCT p_name AS name FROM part),
q AS (
  SELECT p_partkey AS id, p_name || CASE p_partkey % 4 WHEN 0 THEN ' HD' WHEN 1 THEN ' news' WHEN 2 THEN ' azerbaijan' ELSE '' END AS name, p_name, p_partkey % 4 AS m FROM part
)
SELECT id, m <> 2 AS known FROM q
""")
def q_token_set_match(read, spark):
    """Extras and quality may differ, other words may not."""
    p = read("part")
    m = F.col("p_partkey") % 4
    q = p.select(F.col("p_partkey").alias("id"), F.concat("p_name", F.when(m == 0, " HD").when(m == 1, " news").when(m == 2, " azerbaijan").otherwise("")).alias("name"))
    return M.token_set_match(q, p.select(F.col("p_name").alias("name")).distinct()).select("id", "known")


@query("SELECT p_partkey AS id, p_partkey % 3 <> 1 AS known FROM part")
def q_strict_match(read, spark):
    """Quality goes, the country stays."""
    p = read("part")
    m = F.col("p_partkey") % 3
    q = p.select(F.col("p_partkey").alias("id"), F.concat("p_name", F.when(m == 0, " (1080p HD)").when(m == 1, " (Russia)").otherwise("")).alias("name"))
    return M.strict_match(q, p.select(F.col("p_name").alias("name")).distinct()).select("id", F.col("strict_known").alias("known"))


@query("""
WITH l AS (SELECT DISTINCT p_name AS l FROM part), r AS (SELECT DISTINCT lower(n_name) AS r FROM nation UNION SELECT DISTINCT split_part(p_name, ' ', 1) FROM part)
SELECT l, r FROM l, r WHERE contains(l, r) OR contains(r, l)
""")
def q_contains_match(read, spark):
    """Containment either way, by shared pieces instead of a nested loop."""
    p = read("part").select(F.col("p_name").alias("l")).distinct()
    r = read("nation").select(F.lower("n_name").alias("r")).union(read("part").select(F.split_part("p_name", F.lit(" "), F.lit(1)))).distinct()
    return M.contains_pairs(p, r)


@query("""
WITH ch AS (SELECT c_custkey AS o, 'c' || c_custkey || '.in' AS id, lower(c_name) AS name FROM customer WHERE c_acctbal >= 0),
q AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN lower(c_name) WHEN 1 THEN lower(c_name) || ' plus' ELSE '' END AS name FROM customer)
SELECT k, coalesce(e.id, n.id) AS channel_id FROM q LEFT JOIN (SELECT name AS en, max_by(id, o) AS id FROM ch GROUP BY 1) e ON name = en
LEFT JOIN (SELECT q.k AS nk, min_by(ch.id, ch.o) AS id FROM q, ch WHERE q.name <> '' AND (contains(q.name, ch.name) OR contains(ch.name, q.name)) GROUP BY 1) n ON k = nk
""")
def q_channel_id(read, spark):
    """Exact, other name, containment; an empty name matches nothing."""
    ch = _db(read).where(~F.col("is_nsfw"))
    m = F.col("c_custkey") % 3
    q = read("customer").select(F.col("c_custkey").alias("k"), F.when(m == 0, F.col("c_name")).when(m == 1, F.concat("c_name", F.lit(" plus"))).otherwise("").alias("name"))
    return M.channel_id(q, ch).select("k", "channel_id")


@query("""
WITH t AS (SELECT DISTINCT p_type AS grp, p_name AS name FROM part), s AS (SELECT DISTINCT p_name AS name FROM part WHERE p_brand = 'Brand#11'),
f AS (
  SELECT grp, t.name, bool_or(s.name = t.name OR len(list_filter(string_split(t.name, ' '), lambda x: NOT list_contains(string_split(s.name, ' '), x))) = 0 OR len(list_filter(string_split(s.name, ' '), lambda x: NOT list_contains(string_split(t.name, ' '), x))) = 0
    OR contains(replace(t.name, ' ', ''), replace(s.name, ' ', '')) OR contains(replace(s.name, ' ', ''), replace(t.name, ' ', ''))) AS found FROM t, s GROUP BY 1, 2
)
SELECT grp, count(*)::BIGINT AS total, sum(found::INT)::BIGINT AS found, (count(*) - sum(found::INT))::BIGINT AS missing, round_even(100.0 * sum(found::INT)::DOUBLE / count(*), 1) AS pct FROM f GROUP BY grp
""")
def q_coverage(read, spark):
    """Found, missing and percentage per list, rounded half to even."""
    t = read("part").select(F.col("p_type").alias("grp"), F.col("p_name").alias("name")).distinct()
    s = read("part").where("p_brand = 'Brand#11'").select(F.col("p_name").alias("name")).distinct()
    return M.coverage_report(M.coverage_match(t, s), "grp")


@query("""
SELECT sum(total)::BIGINT AS total, sum(found)::BIGINT AS found, round_even(100.0 * sum(found)::DOUBLE / sum(total)::DOUBLE, 1) AS pct, 100.0 * sum(found) / sum(total) < 50 AS warn
FROM (SELECT o_orderpriority, count(*) AS total, sum((o_orderstatus = 'F')::INT) AS found FROM orders GROUP BY 1)
""")
def q_coverage_total(read, spark):
    """A4: from the sums, not the mean of percentages."""
    m = read("orders").select("o_orderpriority", (F.col("o_orderstatus") == "F").alias("found"))
    return sinks.total_coverage(M.coverage_report(m, "o_orderpriority"))


_U = [("http://h.example/zee-classic/x.m3u8",), ("http://h.example/zeetvhdlive/1.m3u8",), ("http://h.example/qq/1.m3u8",), ("http://goldmines.example/live/aajtak/i.m3u8",), ("http://h.example/star/plus/index.m3u8",)]


@query("""
SELECT * FROM (VALUES ('http://h.example/zee-classic/x.m3u8', 'zee classic'), ('http://h.example/zeetvhdlive/1.m3u8', 'zee tv'), ('http://h.example/qq/1.m3u8', ''),
  ('http://goldmines.example/live/aajtak/i.m3u8', 'goldmines'), ('http://h.example/star/plus/index.m3u8', 'star plus')) AS x(url, best_name)
""")
def q_url_name_match(read, spark):
    """The longest name in the URL, else one that a word spells."""
    names = spark.createDataFrame([(x,) for x in ("Zee Classic", "Zee TV", "Goldmines", "Star Plus", "Zee")], "name string")
    return M.url_name_match(spark.createDataFrame(_U, "url string"), names)


@query("SELECT o_orderkey AS k FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def q_anti_seen(read, spark):
    """Seeds that neither are accepted nor recently failed."""
    dead = read("events").where("event_type = 'error'").select(F.col("user_id").alias("o_custkey"))
    seen = read("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return E.without(E.without(read("orders"), dead, on="o_custkey"), seen, on="o_orderkey").select(F.col("o_orderkey").alias("k"))


@query("SELECT c_custkey AS k FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')")
def q_semi_shared_dead(read, spark):
    """What a shared list names."""
    dead = read("events").where("event_type = 'error'").select(F.col("user_id").alias("c_custkey"))
    return E.only_in(read("customer"), dead, on="c_custkey").select(F.col("c_custkey").alias("k"))


@query("""
SELECT DISTINCT 'c' || c_custkey || '.in' AS id FROM customer WHERE c_acctbal < 0 OR lower(c_mktsegment) = 'xxx' OR c_mktsegment = 'FURNITURE'
""")
def q_blocklist(read, spark):
    """Union of listed, marked and categorised ids."""
    listed = read("customer").where("c_mktsegment = 'FURNITURE'").select(F.concat(F.lit("c"), "c_custkey", F.lit(".in")).alias("channel"), F.lit(" NSFW ").alias("reason"))
    return blocklist(_db(read), listed)


@query("""
SELECT o_orderkey AS k FROM orders JOIN customer ON o_custkey = c_custkey WHERE NOT (c_acctbal < 0) AND o_orderkey % 13 <> 0
""")
def q_blocklist_anti(read, spark):
    """Blocked names and the name pattern go."""
    rows = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select(F.col("o_orderkey").alias("k"), F.concat("c_name", F.when(F.col("o_orderkey") % 13 == 0, " xxx").otherwise("")).alias("name"))
    db = _db(read)
    empty = spark.createDataFrame([], "channel string, reason string")
    return E.drop_unfit(rows, db, blocklist(db, empty)).select("k")


@query("SELECT c_custkey AS k, coalesce(n.n_name, 'Other') AS language FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON c_nationkey = n_nationkey")
def q_language_tag(read, spark):
    """The first language of a key, else Other."""
    t = read("nation").where("n_regionkey < 3").select(F.concat(F.lit("n"), "n_nationkey").alias("name"), F.lit("").alias("canonical_name"), F.array("n_name").alias("languages"), F.lit("").alias("language_raw"), F.array().cast("array<string>").alias("alt_names"), F.col("n_nationkey").alias("_ord"))
    rows = read("customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("N"), "c_nationkey", F.lit(" (1080p)")).alias("name"))
    return E.tag_language(rows, E.language_map(t)).select("k", "language")


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'own' END AS v FROM part")
def q_fill_missing(read, spark):
    """Only what is missing."""
    p = read("part")
    a = p.select(F.col("p_partkey").alias("k"), F.when(F.col("p_partkey") % 2 == 0, "").otherwise("own").alias("v"))
    return E.fill_missing(a, p.select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("v")), "k", ["v"])


@query("""
SELECT c_custkey AS k, coalesce(CASE WHEN c_custkey % 2 = 0 THEN 'Other' ELSE 'Own' END, '') AS was, CASE WHEN c_custkey % 2 = 0 THEN min(n_name) ELSE 'Own' END AS language
FROM customer JOIN nation ON n_regionkey = c_custkey % 5 GROUP BY c_custkey
""")
def q_enrich_language(read, spark):
    """The first list in alphabetical order."""
    lists = read("nation").select(F.concat(F.lit("r"), "n_regionkey").alias("name"), F.col("n_name").alias("language"))
    was = F.when(F.col("c_custkey") % 2 == 0, "Other").otherwise("Own")
    rows = read("customer").select(F.col("c_custkey").alias("k"), was.alias("was"), F.concat(F.lit(" R"), F.col("c_custkey") % 5).alias("name"), was.alias("language"))
    return E.enrich_language(rows, lists).select("k", "was", "language")


@query("SELECT coalesce(nullif(lang, ''), 'Other') AS part, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1 UNION ALL SELECT 'all', count(*)::BIGINT, sum(n_chars)::BIGINT FROM documents")
def q_lang_partition(read, spark):
    """The combined list is the sum of its parts."""
    d = read("documents").withColumn("part", T.fallback(F.col("lang"), F.lit("Other")))
    per = d.groupBy("part").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    return per.unionByName(d.agg(F.lit("all").alias("part"), F.count("*").alias("n"), F.sum("n_chars").alias("chars")))


@query("SELECT replace(lower(source), ' ', '_') AS source_file, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def q_source_partition(read, spark):
    """File names of sources."""
    d = sinks.with_files(read("documents").select(F.col("lang").alias("language"), "source"))
    return d.groupBy("source_file").agg(F.count("*").alias("n"))


@query("""
SELECT '#EXTINF:-1 tvg-name="' || p_name || '"' || CASE WHEN p_partkey % 3 = 0 THEN ' tvg-logo="logo"' ELSE '' END || ' group-title="' || p_brand || '",' || p_name || chr(10) || 'http://h/' || p_partkey AS value FROM part
""")
def q_m3u_lines(read, spark):
    """K1: the two lines of an entry."""
    rows = read("part").select(F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 3 == 0, "logo").otherwise("").alias("logo"), F.col("p_brand").alias("category"), F.concat(F.lit("http://h/"), "p_partkey").alias("url"))
    return rows.select(sinks.m3u_entry().alias("value"))


@query(f"""
SELECT language, count(*)::BIGINT AS total, string_agg(name, ',' ORDER BY name) AS names FROM (
  SELECT n_name AS name, unnest([CASE n_regionkey WHEN 0 THEN 'Hindi' WHEN 1 THEN 'Tamil' WHEN 2 THEN 'Klingon' ELSE 'English' END, 'Telugu']) AS language FROM nation) WHERE language IN {K.PIPELINE_LANGUAGES} GROUP BY 1
""")
def q_language_lists(read, spark):
    """K7: one list per pipeline language, names in order."""
    r = F.col("n_regionkey")
    lang = F.when(r == 0, "Hindi").when(r == 1, "Tamil").when(r == 2, "Klingon").otherwise("English")
    rows = read("nation").select(F.col("n_name").alias("name"), F.array(lang, F.lit("Telugu")).alias("languages"), F.array().cast("array<string>").alias("categories"))
    return sinks.language_lists(rows).select("language", "total", F.array_join(F.transform("channels", lambda c: c["name"]), ",").alias("names"))


@query("SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def q_resume_pending(read, spark):
    """ST12, J11, O2: what an interrupted run has left."""
    items = read("lineitem").select(F.col("l_orderkey").alias("k"))
    return St.pending(items, read("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k")), ["k"])


@query("SELECT n_name AS a, 'n' AS src FROM nation UNION ALL SELECT r_name, 'r' FROM region")
def q_union_seeds(read, spark):
    """O1."""
    return read("nation").select(F.col("n_name").alias("a"), F.lit("n").alias("src")).unionByName(read("region").select(F.col("r_name").alias("a"), F.lit("r").alias("src")))


@query()
def q_crawl_bfs(read, spark):
    """Pages within reach of each host's first page."""
    from linkloom.functions.urls import host_of

    p = read("pages")
    seeds = p.groupBy(host_of("url").alias("site")).agg(F.min("url").alias("url"))
    return Gr.crawl(p, seeds, 30)
