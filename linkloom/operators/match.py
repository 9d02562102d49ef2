"""Entity matching by names, token sets and URLs.

Set matching is an equi-join on a canonical key with a residual subset test.  Subsets and substrings are found by an equi-join
on the rarest token or 4-gram, so no step is a nested loop over both sides and a frequent token pairs little.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions import text as T
from linkloom.functions import urls as U
from linkloom.operators.rank import first_per_key


def with_keys(df: DataFrame, name: str) -> DataFrame:
    """Adds norm, strict, tokens (a set), set_key, core_key, compact and coverage keys of a name column."""
    d = df.withColumn("norm", T.norm_name(name)).withColumn("tokens", T.words(F.col("norm")))
    return d.withColumns({
        "strict": T.norm_strict(name), "set_key": T.token_set_key(F.col("tokens")), "core_key": T.core_key(F.col("tokens")),
        "compact": T.compact(F.col("tokens")), "coverage": F.array_join(T.without(F.col("tokens"), K.QUALITY_TOKENS), " "),
    })


def _sided(df: DataFrame) -> DataFrame:
    """A join side that may be as long as a table of names: it is shuffled and merged, which spills.  Spark would judge it by its
    share of the compressed files, and texts that grow in memory would be broadcast by way of the driver."""
    return df.hint("merge")


def _flag(df: DataFrame, keys: DataFrame, on: str, flag: str) -> DataFrame:
    """A boolean column: the key occurs on the other side."""
    k = keys.select(on).where(F.col(on) != "").distinct().withColumn(flag, F.lit(True))
    return df.join(k, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def token_set_match(queries: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """queries with `known`: the name, less quality, equals a listed one, or has its token set, or differs from one only by
    extras: equal core, one token set within the other, and no more than eight extras on the query's side."""
    q = with_keys(queries.withColumn("__q", F.monotonically_increasing_id() if "_ord" not in queries.columns else F.col("_ord")), name)
    a = with_keys(names.select(F.lower(F.trim(F.col(name))).alias("raw")).where("raw <> ''").distinct(), "raw")
    q = q.withColumn("qset", F.array_distinct(T.without(F.col("tokens"), K.QUALITY_TOKENS))).withColumn("qkey", T.token_set_key(F.col("qset"))).withColumn("qcore", T.core_key(F.col("qset")))
    raw = a.select(F.col("raw").alias("norm")).unionByName(a.select("norm"))
    q = _flag(q, raw, "norm", "by_name")
    q = _flag(q, a.select(F.col("set_key").alias("qkey")), "qkey", "by_set")
    # candidates of equal core: a distinct token set each
    sets = a.select("core_key", F.col("set_key").alias("akey"), F.array_distinct("tokens").alias("aset")).dropDuplicates(["core_key", "akey"])
    pairs = q.where((F.size("qset") >= 2) & ~F.col("by_name") & ~F.col("by_set")).select("qcore", "qkey", "qset").dropDuplicates(["qkey"]).join(sets, F.col("qcore") == F.col("core_key"))
    inside = F.size(F.array_except("aset", "qset")) == 0
    around = (F.size(F.array_except("qset", "aset")) == 0) & (F.size(F.filter("qset", lambda t: t.isin(*K.SAFE_EXTRAS))) <= 8)
    by_core = pairs.where(inside | around).select("qkey").distinct()
    q = _flag(q, by_core, "qkey", "by_core")
    return q.withColumn("known", (F.col("norm") != "") & (F.col("by_name") | F.col("by_set") | F.col("by_core"))).select(*queries.columns, "known")


def strict_match(queries: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """queries with `strict_known`: an equal key that keeps country words; a single word must also be a listed name."""
    q, a = with_keys(queries, name), with_keys(names.select(F.col(name).alias("n")), "n")
    q = _flag(_flag(q, a, "strict", "s"), a, "norm", "n1")
    one = ~F.col("strict").contains(" ")
    return q.withColumn("strict_known", (F.col("strict") != "") & F.col("s") & (~one | F.col("n1"))).select(*queries.columns, "strict_known")


def grams(c: Column, n: int = 4) -> Column:
    """Distinct n-character pieces."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(c, i, F.lit(n))))


def subset_pairs(small: DataFrame, big: DataFrame) -> DataFrame:
    """small: a, ts; big: b, us (sets, distinct rows) -> a, b, ts, us where ts is within us.

    One element of ts is enough to join on, so it is the one that fewest of the big sets have: a frequent element pairs
    nothing unless a set has no other.
    """
    posted = big.select("b", F.explode("us").alias("g"))
    met = by_rarest(small.select("a", F.explode("ts").alias("g")), posted).join(small, "a").join(big, "b")
    return met.where(F.size(F.array_except("ts", "us")) == 0).select("a", "b", "ts", "us")


def by_rarest(asked: DataFrame, posted: DataFrame) -> DataFrame:
    """asked: a, g; posted: b, g -> (a, b) that share the g of a that fewest b have.  Only ids and pieces are shuffled."""
    known = posted.join(_sided(asked.select("g").distinct()), "g", "left_semi").groupBy("g").agg(F.count("*").alias("n"))
    rare = asked.join(_sided(known), "g", "left").groupBy("a").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("x"))
    return rare.where("x.n > 0").select("a", F.col("x.g").alias("g")).join(_sided(posted), "g").select("a", "b")


def contained(inner: DataFrame, outer: DataFrame, n: int = 4) -> DataFrame:
    """inner.a, outer.b (distinct texts) -> (a, b) where b contains a, by pieces of n characters, or of a's length if it is less."""
    size = F.least(F.length("a"), F.lit(n))
    # pieces of different lengths differ as texts, so one join serves all lengths; only the lengths that are asked for are cut
    lengths = sorted(r["k"] for r in inner.where(F.length("a") > 0).select(size.alias("k")).distinct().collect())  # n values at most
    if not lengths:
        return inner.select("a").join(outer.select("b"), F.lit(False))
    asked = inner.where(F.length("a") > 0).select("a", F.explode(F.coalesce(*[F.when(size == k, grams(F.col("a"), k)) for k in lengths])).alias("g"))
    none = F.array().cast("array<string>")
    posted = outer.select("b", F.explode(F.array_distinct(F.concat(*[F.when(F.length("b") >= k, grams(F.col("b"), k)).otherwise(none) for k in lengths]))).alias("g"))
    return by_rarest(asked, posted).where(F.col("b").contains(F.col("a")))


def contains_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """left.l, right.r (distinct texts) -> (l, r) where either contains the other."""
    l_in_r = contained(left.select(F.col("l").alias("a")), right.select(F.col("r").alias("b"))).select(F.col("a").alias("l"), F.col("b").alias("r"))
    r_in_l = contained(right.select(F.col("r").alias("a")), left.select(F.col("l").alias("b"))).select(F.col("b").alias("l"), F.col("a").alias("r"))
    return l_in_r.unionByName(r_in_l).distinct()


def channel_id(queries: DataFrame, channels: DataFrame, name: str = "name", contains: bool = True) -> DataFrame:
    """queries with `channel_id`: by exact name, else by other name, else by the first listed name that contains it or that it
    contains.  Empty names match nothing."""
    key = F.lower(F.trim(T.text(name)))
    # rows without a name get a key of their own, so that they never meet in one task; no trimmed name begins with a blank
    q = queries.withColumn("__k", F.when(key != "", key).otherwise(F.concat(F.lit(" "), F.monotonically_increasing_id())))
    exact = channels.select(F.lower(F.trim("name")).alias("__k"), "id", "_ord").where("__k <> ''").groupBy("__k").agg(F.max_by("id", "_ord").alias("id1"))
    alts = channels.select(F.explode(F.split(T.text("alt_names"), ";")).alias("a"), "id", "_ord").select(F.lower(F.trim("a")).alias("__k"), "id", "_ord")
    other = alts.where("__k <> ''").groupBy("__k").agg(F.max_by("id", "_ord").alias("id2"))
    q = q.join(_sided(exact), "__k", "left").join(_sided(other), "__k", "left")
    if contains:
        rest = q.where("id1 IS NULL AND id2 IS NULL AND __k NOT LIKE ' %'").select(F.col("__k").alias("l")).distinct()
        names = channels.select(F.lower(F.trim("name")).alias("r"), "id", "_ord").where("r <> ''")
        near = contains_pairs(rest, names.select("r").distinct()).join(_sided(names), "r").groupBy("l").agg(F.min_by("id", "_ord").alias("id3"))
        q = q.join(_sided(near.withColumnRenamed("l", "__k")), "__k", "left")
    else:
        q = q.withColumn("id3", F.lit(None).cast("string"))
    return q.withColumn("channel_id", F.coalesce("id1", "id2", "id3")).select(*queries.columns, "channel_id")


def channel_ids(queries: DataFrame, channels: DataFrame, name: str = "name") -> DataFrame:
    """Every id that a name matches: the exact one alone, else all by containment."""
    got = channel_id(queries, channels, name, contains=False)
    names = channels.select(F.lower(F.trim("name")).alias("r"), "id").where("r <> ''")
    rest = got.where(F.col("channel_id").isNull()).withColumn("l", F.lower(F.trim(T.text(name)))).where("l <> ''")
    near = contains_pairs(rest.select("l").distinct(), names.select("r").distinct()).join(names, "r")
    return got.where(F.col("channel_id").isNotNull()).unionByName(rest.drop("channel_id").join(near.select("l", F.col("id").alias("channel_id")), "l").select(*got.columns))


def url_name_match(urls: DataFrame, names: DataFrame, url: str = "url", name: str = "name") -> DataFrame:
    """urls with `best_name`: the longest listed name whose tokens are in the URL, or whose compact form is; else one that a
    single URL word spells, after up to three common endings.  Equal lengths: the first in order."""
    u = urls.select(F.col(url).alias("u")).distinct().withColumn("ts", U.url_tokens("u")).where(F.size("ts") > 0)
    n = names.select(T.norm_name(name).alias("n")).where("n <> ''").distinct().withColumn("at", T.without(T.words(F.col("n")), K.URL_DROP)).where(F.size("at") > 0)
    within = subset_pairs(n.select(F.col("n").alias("a"), F.array_distinct("at").alias("ts")), u.select(F.col("u").alias("b"), F.array_distinct("ts").alias("us")))
    within = within.select(F.col("b").alias("u"), F.col("a").alias("n"))
    # the compact form in that of the URL counts if they share a token
    cn, cu = n.select("n", "at", F.array_join("at", "").alias("a")).where(F.length("a") >= 4), u.select("u", "ts", F.array_join("ts", "").alias("b"))
    spelt = contained(cn.select("a").distinct(), cu.select("b").distinct()).join(cn, "a").join(cu, "b").where(F.arrays_overlap("at", "ts")).select("u", "n")
    first = within.unionByName(spelt).distinct().withColumn("step", F.lit(1))
    spelled = n.select("n", F.explode(F.array_distinct(F.array(T.compact(T.words(F.col("n"))), T.compact(F.col("at"))))).alias("t")).where("t <> ''")
    words = u.select("u", F.explode(F.filter("ts", lambda t: F.length(t) >= 4)).alias("t"))
    forms = words.withColumn("p0", F.col("t"))
    for i in range(3):
        forms = forms.withColumn(f"p{i + 1}", _peeled(F.col(f"p{i}")))
    forms = forms.select("u", F.explode(F.array_distinct(F.array("p0", "p1", "p2", "p3"))).alias("t"))
    second = forms.join(spelled, "t").select("u", "n").distinct().withColumn("step", F.lit(2))
    best = first_per_key(first.unionByName(second), ["u"], ["step", F.length("n").desc(), "n"]).select(F.col("u").alias(url), F.col("n").alias("best_name"))
    return urls.join(best, url, "left").withColumn("best_name", F.coalesce("best_name", F.lit("")))


def _peeled(c: Column) -> Column:
    """One common ending off, if four characters stay."""
    out = F.when(F.lit(False), c)
    for s in K.URL_SUFFIXES:
        out = out.when(c.endswith(s) & (F.length(c) - len(s) >= 4), F.substring(c, F.lit(1), F.length(c) - len(s)))
    return out.otherwise(c)


def coverage_match(targets: DataFrame, stored: DataFrame, name: str = "name") -> DataFrame:
    """targets with `found`: some stored name matches by token set, or its core contains or is in the target's, or one compact
    form (four characters or more) contains the other."""
    t = targets.withColumn("__n", F.lower(F.trim(T.text(name))))
    names = t.select("__n").where("__n <> ''").distinct()
    have = stored.select(F.lower(F.trim(T.text(name))).alias("s")).where("s <> ''").distinct()
    known = token_set_match(names.select(F.col("__n").alias("name")), have.select(F.col("s").alias("name"))).where("known").select(F.col("name").alias("__n"))
    key = lambda c: F.array_distinct(T.without(T.tokens(c), K.QUALITY_TOKENS))
    a, b = names.withColumn("x", key("__n")).where(F.size("x") > 0), have.withColumn("y", key("s")).where(F.size("y") > 0)
    one = lambda d, i, x, name, kind: d.select(F.col(i).alias(name), F.col(x).alias(kind)).distinct()
    sub = subset_pairs(one(a, "__n", "x", "a", "ts"), one(b, "s", "y", "b", "us")).select(F.col("a").alias("__n"))
    sup = subset_pairs(one(b, "s", "y", "a", "ts"), one(a, "__n", "x", "b", "us")).select(F.col("b").alias("__n"))
    core = sub.unionByName(sup)
    ca = names.select("__n", T.compact(T.tokens("__n")).alias("l")).where("l <> ''")
    cb = have.select(T.compact(T.tokens("s")).alias("r")).where("r <> ''").distinct()
    spelt = ca.join(contains_pairs(ca.select("l").distinct(), cb), "l").select("__n")
    hit = known.unionByName(core).unionByName(spelt).distinct().withColumn("found", F.lit(True))
    return t.join(hit, "__n", "left").withColumn("found", F.coalesce("found", F.lit(False))).drop("__n")


def coverage_report(matched: DataFrame, group: str) -> DataFrame:
    """Per group: total, found, missing, pct; percentages rounded half to even."""
    g = matched.groupBy(group).agg(F.count("*").alias("total"), F.sum(F.col("found").cast("long")).alias("found"))
    return g.select(group, "total", "found", (F.col("total") - F.col("found")).alias("missing"), F.bround(100.0 * F.col("found") / F.col("total"), 1).alias("pct"))


def missing_names(matched: DataFrame, group: str, name: str = "name", most: int = 50) -> DataFrame:
    """Per group, the first missing names in order."""
    return matched.where(~F.col("found")).withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy(name))).where(F.col("r") <= most).groupBy(group).agg(F.sort_array(F.collect_list(name)).alias("missing"))


def query_names(q: Column) -> Column:
    """Names that a search query names: the quoted ones, and the query without a known ending."""
    base = F.when(F.lit(False), q)
    for s in K.QUERY_SUFFIXES:
        base = base.when(F.lower(q).endswith(s), F.substring(q, F.lit(1), F.length(q) - len(s)))
    base = F.regexp_replace(F.trim(base.otherwise(q)), '^"+|"+$', "")
    return F.array_distinct(F.filter(F.concat(F.regexp_extract_all(q, F.lit('"([^"]+)"'), F.lit(1)), F.array(base)), lambda x: x != ""))
