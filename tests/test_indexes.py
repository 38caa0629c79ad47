"""Stored keyword and vector indexes: what they leave unopened changes no hit."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.operators import postings, vectorindex
from millrace.operators.keywords import KeywordIndex
from millrace.operators.vectorindex import VectorIndex
from millrace.operators.vectorsearch import cosine_top_k
from millrace.session import Tables


def hits(frame, places=6):
    return sorted((r.query_id, r.id, round(r.score, places), r["rank"]) for r in frame.collect())


def asked_of(index, queries, k):
    """The search that ``KeywordIndex.search`` makes."""
    asked = queries.select(F.col("item_id").alias("query_id"), F.explode(tokens(F.col("text"))).alias("term"))
    asked = asked.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))
    weighed = asked.join(index.terms(only=asked.select("term")), "term")
    return postings.Search(index.blocks, weighed, index.documents.agg(F.avg("doc_len").alias("a")).scalar(), k, 1.5, 0.75)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """Documents of several languages, with a rare word in a few long runs of ids."""
    rows = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return rows.withColumn("text", F.when(F.col("doc_id") % 50 < 2, F.concat("text", F.lit(" quixotic quixotic zebra"))).otherwise(F.col("text")))


@pytest.mark.parametrize("settings", [{}, {"RANGE": 4, "FIRST": 2}, {"RANGE": 1, "FIRST": 1, "SPLITS": 3, "SLOTS": 7}])
def test_keyword_blocks_leave_no_hit_out(spark, sf_dir, docs, tmp_path, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(postings, name, value)
    queries = Tables(spark, sf_dir).benchmark.select("item_id", "text").unionByName(
        spark.createDataFrame([(9001, "quixotic zebra zebra"), (9002, "nobodyhasthis"), (9003, ""), (9004, None)], "item_id long, text string"))
    index = KeywordIndex.create(docs, "doc_id", "text", str(tmp_path))
    assert index.blocks is not None
    got = index.search(queries, "item_id", "text", 7)
    want = KeywordIndex(index.entries, index.frequencies).search(queries, "item_id", "text", 7)
    assert hits(got) == hits(want) and got.columns == want.columns
    assert sorted((r.query_id, r.id, r.matched) for r in got.collect()) == sorted((r.query_id, r.id, r.matched) for r in want.collect())


def test_blocks_that_cannot_enter_stay_closed(spark, sf_dir, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "RANGE", 2)
    queries = Tables(spark, sf_dir).benchmark
    search = asked_of(KeywordIndex.create(docs, "doc_id", "text", str(tmp_path)), queries, 3)
    bounds, first, rest = search.opened()
    known = {(r.query_id, r.part, r["range"]): r.bound for r in bounds.collect()}
    left = {(r.query_id, r.part, r["range"]) for r in rest.collect()}
    assert len(left) + first.select("query_id").distinct().count() * postings.FIRST < 0.8 * len(known)
    # No document scores more than its range's bound, opened or not.
    everything = search.scores(bounds)
    place = search.blocks.select("part", "range", F.explode("postings.doc").alias("id")).distinct()
    over = everything.join(place, "id").join(bounds, ["query_id", "part", "range"]).filter(F.col("score") > F.col("bound") + 1e-6)
    assert over.count() == 0


def test_a_search_reads_its_own_terms_folders(spark, docs, tmp_path):
    queries = spark.createDataFrame([(1, "quixotic zebra")], "item_id long, text string")
    search = asked_of(KeywordIndex.create(docs, "doc_id", "text", str(tmp_path)), queries, 3)
    slots = {r[0] for r in spark.createDataFrame([("quixotic",), ("zebra",)], "t string").select(postings.slot_of(F.col("t"))).collect()}
    plan = search.bounds()._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[slot#\d+ IN \({','.join(map(str, sorted(slots)))}\)", plan)
    assert "postings" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_appended_documents_are_found(spark, sf_dir, docs, tmp_path):
    queries = Tables(spark, sf_dir).benchmark
    index = KeywordIndex.create(docs.filter("doc_id % 3 <> 0"), "doc_id", "text", f"{tmp_path}/a", 0)
    both = index.append(docs.filter("doc_id % 3 = 0"), "doc_id", "text", f"{tmp_path}/a", 1)
    whole = KeywordIndex.create(docs, "doc_id", "text", f"{tmp_path}/b")
    assert hits(both.search(queries, "item_id", "text", 5)) == hits(whole.search(queries, "item_id", "text", 5))
    # A part without blocks: the index is searched by its entries.
    assert index.append(docs.limit(3).withColumn("doc_id", F.col("doc_id") + 10**6), "doc_id", "text", f"{tmp_path}/a", 2, searchable=False).blocks is None


def clustered(spark, rows, seed=1, text_ids=False):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(12, 16))
    data = centres[pick.integers(0, 12, rows)] + 0.25 * pick.normal(size=(rows, 16))
    data[rows // 3 : 2 * rows // 3] = data[0]
    data[5] = 0
    out = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(data)] + [(rows, None), (rows + 1, [1.0])]
    df = spark.createDataFrame(out, "chunk_id long, vector array<float>")
    return df.withColumn("chunk_id", F.col("chunk_id").cast("string")) if text_ids else df


@pytest.mark.parametrize("text_ids", [False, True])
@pytest.mark.parametrize("settings", [{}, {"CELL": 32, "FIRST": 1, "QUERIES": 3, "ROWS_OF_TASK": 2}])
def test_vector_cells_leave_no_hit_out(spark, tmp_path, monkeypatch, settings, text_ids):
    for name, value in settings.items():
        monkeypatch.setattr(vectorindex, name, value)
    chunks = clustered(spark, 900, text_ids=text_ids)
    queries = clustered(spark, 30, seed=2).select(F.col("chunk_id").alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
    index = VectorIndex.create(chunks, "chunk_id", "vector", str(tmp_path), lists=9)
    assert index.cells.agg(F.sum("n")).first()[0] == 900
    assert hits(index.search(queries, 6), 9) == hits(cosine_top_k(queries, chunks, 6, dimensions=16), 9)


def test_cells_are_skipped_and_a_busy_list_is_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vectorindex, "CELL", 50)
    chunks = clustered(spark, 1800)
    index = VectorIndex.create(chunks, "chunk_id", "vector", str(tmp_path), lists=12)
    assert index.cells.agg(F.max("n")).first()[0] <= 50
    queries = chunks.filter("chunk_id < 40 AND chunk_id <> 5").withColumnRenamed("chunk_id", "query_id")
    pairs, _ = index.opened(queries, 5)
    assert pairs.count() == pairs.distinct().count() < 0.7 * 39 * index.cells.count()


def test_empty_vector_tables(spark, tmp_path):
    chunks = clustered(spark, 40)
    none = chunks.filter("chunk_id < 0")
    assert VectorIndex.create(none, "chunk_id", "vector", f"{tmp_path}/a", dimensions=16).search(chunks.withColumnRenamed("chunk_id", "query_id")).collect() == []
    index = VectorIndex.create(chunks, "chunk_id", "vector", f"{tmp_path}/b")
    assert index.search(none.withColumnRenamed("chunk_id", "query_id")).collect() == []
    with pytest.raises(TypeError):
        VectorIndex.create(chunks.withColumn("chunk_id", F.lit(1.5)), "chunk_id", "vector", f"{tmp_path}/c")


@pytest.mark.parametrize("searchable", [False, True])
def test_scores_are_summed_where_a_document_lies(spark, tmp_path, searchable):
    docs = spark.createDataFrame([(i, f"word{i % 7} common word{i % 11} other") for i in range(700)], "d long, text string")
    asked = spark.createDataFrame([(1, "common word3 word5"), (2, "word3 word3 nothing")], "q long, text string")
    stored = KeywordIndex.create(docs, "d", "text", str(tmp_path / "index"), searchable=searchable)
    found = stored.search(asked, "q", "text", 5)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, KeywordIndex.build(docs, "d", "text").search(asked, "q", "text", 5).collect()))
    moved = re.findall(r"hashpartitioning\(([^)]*)\)", found._jdf.queryExecution().executedPlan().toString())
    assert not [m for m in moved if "query_id" in m and re.search(r"\b(doc|id|_groupingexpression)#", m)]
