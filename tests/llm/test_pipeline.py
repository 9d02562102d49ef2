"""The pipeline stage by stage: columns, decisions, and near-duplicates against exact Jaccard similarity."""

import time
from collections import defaultdict
from pathlib import Path

import pytest
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline as P
from linkloom.llm import common, decontaminate, line_dedup, simhash_dedup


@pytest.fixture(scope="module")
def stages(spark):
    docs = common.table(spark, str(DATA), "documents")
    out = {"documents": docs}
    for name, f in P.STAGES:
        out[name] = docs = common.stored(f(spark, docs, str(DATA)), name)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns(stages):
    for name, _ in P.STAGES[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix_sources"]


def test_clean_documents_stay(stages):
    assert ids(stages["language_id"]) == ids(stages["documents"])
    assert ids(stages["line_dedup"]) == ids(stages["language_id"])


def test_lines(stages):
    before = [(r["doc_id"], r["text"]) for r in stages["language_id"].collect()]
    want = line_dedup.brute(before)
    text = dict(before)
    import hashlib

    for r in stages["line_dedup"].collect():
        assert hashlib.sha256((r["text"] or "").encode()).hexdigest() == want[(r["doc_id"], text[r["doc_id"]])][2]
        assert r["n_chars"] == len(r["text"])


def test_near_duplicates(stages):
    rows = {r["doc_id"]: r["text"].lower().split() for r in stages["line_dedup"].collect()}
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, w in rows.items()}
    near = defaultdict(float)
    for a in sets:
        for b in sets:
            if a < b:
                j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
                near[b] = max(near[b], j)
    kept = ids(stages["near_dedup"])
    missed = [i for i, j in near.items() if j >= 0.9 and i in kept]
    wrong = [i for i in rows if i not in kept and near[i] < 0.5]
    assert not missed and not wrong


def test_decontaminated(spark, stages):
    bench = common.table(spark, str(DATA), "benchmark")
    left = decontaminate.decontaminate(stages["decontaminate"], bench)
    gone = ids(stages["near_dedup"]) - ids(stages["decontaminate"])
    hit = {r["doc_id"] for r in decontaminate.decontaminate(stages["near_dedup"], bench).where("n_hit > 0").collect()}
    assert left.where("n_hit > 0").count() == 0 and gone == hit


def test_mix(stages):
    m = stages["mix_sources"].toPandas()
    assert ids(stages["mix_sources"]) <= ids(stages["decontaminate"]) and (m.taken > 0).all()
    for _, part in m.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 1


def test_run(spark, stages):
    got = sorted(map(repr, P.run(spark, str(DATA)).collect()))
    assert got == sorted(map(repr, stages["mix_sources"].collect()))


def test_small_tables_go_in_few_files(spark):
    """A few documents in many partitions: no stage writes a file for each partition."""
    known = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    docs = common.table(spark, str(DATA), "documents").limit(200).repartition(3)
    docs = common.stored(docs.unionByName(docs.withColumn("doc_id", docs["doc_id"] + 10_000)), "documents")
    folder = Path(common.shared_dir(spark).removeprefix("file:"))
    old = {*folder.iterdir()}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, f in P.STAGES[1:4]:
            common.stored(f(spark, docs, str(DATA)), name)
    finally:
        for k, v in known.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = {p.name.split("-")[1]: len([*p.glob("*.parquet")]) for p in {*folder.iterdir()} - old}
    most = 2 * spark.sparkContext.defaultParallelism
    assert {"lines", "line_dedup", "nodes", "candidates", "need", "links", "near_dedup", "windows", "rarity", "prefix", "decontaminate"} <= set(files)
    assert {k: n for k, n in files.items() if n > most} == {}


def files_of(spark, label, run, merge="false"):
    """run()'s result in 64 partitions, which Spark may merge or not, and how many files each new table of the label has in the shared folder."""
    folder = Path(common.shared_dir(spark).removeprefix("file:"))
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": merge}
    known, old = {k: spark.conf.get(k, None) for k in conf}, {*folder.iterdir()}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = run()
    finally:
        for k, v in known.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return out, [len([*p.glob("*.parquet")]) for p in {*folder.iterdir()} - old if p.name.split("-")[1] == label]


def test_hits_go_in_few_files(spark):
    """Documents in many partitions: op1's hits and its result are packed, and none is lost."""
    docs, items = (common.table(spark, str(DATA), t) for t in ("documents", "benchmark"))
    docs = docs.unionByName(items.select(*[(F.col("text") if c == "text" else F.lit(None).cast(k)).alias(c) for c, k in docs.dtypes]))
    run = lambda d: sorted(map(repr, decontaminate.decontaminate(d, items).collect()))
    got, files = files_of(spark, "hits", lambda: run(docs.repartition(40)))
    most = 2 * spark.sparkContext.defaultParallelism
    assert len(files) == 1 and files[0] <= most
    assert got == run(docs.coalesce(1)) and sum("n_hit=0" not in r for r in got) >= items.count()
    _, files = files_of(spark, "result", lambda: common.stored(decontaminate.op1_decontaminate(spark, str(DATA)), "result"))
    assert len(files) == 1 and files[0] <= most


def test_lines_go_in_few_files(spark):
    """Ranges of lines in many partitions: op2's table of lines and its result are packed, and no row is lost."""
    run = lambda: common.stored(line_dedup.op2_line_dedup(spark, str(DATA)), "result")
    got, files = files_of(spark, "result", run)
    assert len(files) == 1 and files[0] <= 2 * spark.sparkContext.defaultParallelism
    merged, files = files_of(spark, "lines", run, merge="true")
    assert files == [1]
    assert len({repr(sorted(map(repr, x.collect()))) for x in (got, merged, run())}) == 1


def test_near_dedup_frees_what_it_no_longer_reads(spark, monkeypatch):
    """Shuffle files go with the query that wrote them, and the first table of prefixes with the second."""
    folder, disk = Path(common.shared_dir(spark).removeprefix("file:")), spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}
    old, left, stored, switch = {*folder.iterdir()}, {}, common.stored, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def watched(df, label="part"):
        before, out = shuffled(), stored(df, label)
        for _ in range(50):  # they are removed a moment later
            if label not in ("nodes", "candidates") or not shuffled() - before:
                break
            time.sleep(0.1)
        left[label] = shuffled() - before
        return out

    monkeypatch.setattr(common, "stored", watched)
    known, docs = spark.conf.get(switch, None), common.table(spark, str(DATA), "documents")
    keys, of = simhash_dedup.similar_classes(docs)
    assert not left["nodes"] and not left["candidates"] and spark.conf.get(switch, None) == known
    tables = {p.name.split("-")[1] for p in {*folder.iterdir()} - old}
    assert {"keys", "nodes"} <= tables and "prints" not in tables
    assert keys.join(of, "id").count() == docs.count()


def test_clean_documents_sends_keys_and_not_texts(spark, monkeypatch):
    """Whatever Spark makes of the files of hits, the texts aren't shuffled for a few documents; for more they are, with one result."""
    docs, items = (common.table(spark, str(DATA), t) for t in ("documents", "benchmark"))
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = decontaminate.clean_documents(docs, items)
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(repr, out.collect()))
        monkeypatch.setattr(decontaminate, "BROADCAST_DOCS", 0)
        more = decontaminate.clean_documents(docs, items)
        assert "SortMergeJoin" in more._jdf.queryExecution().executedPlan().toString()
        assert got == sorted(map(repr, more.collect())) and len(got) < docs.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)
