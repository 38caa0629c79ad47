"""Queries over vectors, keywords, fusion and retrieval quality."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import vectors as vec
from millrace.operators import chunking as ch
from millrace.operators import evaluate as ev
from millrace.operators import relate as rel
from millrace.operators import usercode as uc
from millrace.operators import vectorsearch as vs
from millrace.operators.keywords import KeywordIndex, reciprocal_rank_fusion, tfidf_vectors, weighted_fusion
from millrace.operators.vectorindex import VectorIndex
from millrace.plans.registry import query
from millrace.plans.texting import TOKENS
from millrace.session import cut_lineage, scratch, spread
from millrace.sources.state import KeyedState


def centroids(t):
    """One query per label: the mean of its vectors."""
    cells = t.embeddings.select(F.col("label").alias("query_id"), F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("query_id", "i").agg(F.avg(F.col("x").cast("double")).alias("a"))
    return means.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "a"))), lambda p: p["a"]).alias("vector"))


def chunk_vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("vector"), "label")


CENTROIDS = """centroids AS (SELECT query_id, list(a ORDER BY i) AS q FROM (SELECT label AS query_id, i, avg(x) AS a FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1),
 scored AS (SELECT query_id, vec_id AS id, label, list_cosine_similarity(q, embedding::DOUBLE[]) AS score FROM centroids, embeddings)"""


def vector_hits(k, name="hits"):
    return f"{CENTROIDS}, {name} AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored QUALIFY rank <= {k})"


def hits(t, k):
    return vs.cosine_top_k(centroids(t), chunk_vectors(t), k)


def shown(df, *columns):
    return df.select(*[F.col(c).cast("long").alias(c) for c in ("query_id", "id")], *columns)


ROUNDED = "SELECT query_id::BIGINT AS query_id, id, round(score, 6) AS score, rank FROM hits"


def ranked(df):
    return shown(df, F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("v01_unit_vectors", "V1", sql="""SELECT vec_id, i::BIGINT AS i, round(x / n, 6) AS x FROM (SELECT vec_id, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)""")
def _(t):
    return t.embeddings.select("vec_id", F.posexplode(vec.normalise(F.col("embedding"))).alias("i", "x")).select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@query("v02_cosine_top_k", "V2", sql=f"WITH {vector_hits(5)} {ROUNDED}")
def _(t):
    return ranked(hits(t, 5))


@query("v02_cosine_top_k_blocks", "V2", sql=f"WITH {vector_hits(5)} {ROUNDED}")
def _(t):
    """The path for query tables too large to send to every task."""
    return ranked(vs.cosine_top_k(centroids(t), chunk_vectors(t), 5, dimensions=64, blocks=3))


def vector_index_of(t, chunks):
    """The vector index of the given chunks, written once and read back."""
    return VectorIndex.create(chunks, "chunk_id", "vector", scratch(t.spark, "vectors"), dimensions=64)


@query("v02_indexed_top_k", "V2", sql=f"WITH {vector_hits(5)} {ROUNDED}")
def _(t):
    """The same from a stored index, which opens only the cells that may hold a hit."""
    return ranked(vector_index_of(t, chunk_vectors(t)).search(centroids(t), 5))


@query("v02_filtered_top_k", "V2", "P12", sql=f"""WITH {CENTROIDS} SELECT query_id::BIGINT AS query_id, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored WHERE label = 3 QUALIFY rank <= 5""")
def _(t):
    return ranked(vs.cosine_top_k(centroids(t), chunk_vectors(t).filter("label = 3"), 5))


@query("v03_upsert", "V3", sql="""SELECT vec_id, CASE WHEN label IN (2, 3) THEN 2 ELSE 1 END AS load_no, CASE WHEN label IN (2, 3) THEN 'new' ELSE 'old' END AS origin FROM embeddings WHERE label <> 4 OR label IN (2, 3)""")
def _(t):
    rows = lambda df, n, name: df.select("vec_id", F.when(F.col("label") != 4, F.col("embedding")).alias("vector"), F.lit(n).alias("load_no"), F.lit(name).alias("origin"))
    first, second = rows(t.embeddings, 1, "old"), rows(t.embeddings.filter("label in (2, 3, 4)"), 2, "new")
    store = KeyedState(t.spark, scratch(t.spark, "chunks"), first.schema, "vec_id", ["load_no"])
    vs.upsert_chunks(store, first, "vector", 1)
    vs.upsert_chunks(store, second, "vector", 2)
    return store.current().select("vec_id", "load_no", "origin")


@query("v04_delete_document", "V4", sql="SELECT doc_id, lang FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE lang = 'es' GROUP BY 1 HAVING count(*) > 5)")
def _(t):
    gone = t.documents.filter("lang = 'es'").groupBy("source").count().filter("count > 5")
    return vs.delete_document(t.documents, gone, "source").select("doc_id", "lang")


INDEX = f"""tok AS (SELECT doc_id AS doc, {TOKENS} AS ts FROM documents), lens AS (SELECT doc, len(ts) AS doc_len FROM tok),
 postings AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(ts) AS term FROM tok) GROUP BY 1, 2),
 terms AS (SELECT term, count(*) AS df, greatest(ln(((SELECT count(*) FROM lens) - count(*) + 0.5) / (count(*) + 0.5) + 1), 0.25) AS idf FROM postings GROUP BY 1),
 asked AS (SELECT query_id, term, count(*) AS times FROM (SELECT item_id AS query_id, unnest({TOKENS}) AS term FROM benchmark) GROUP BY 1, 2),
 bm AS (SELECT query_id, p.doc AS id, sum(times * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * doc_len / (SELECT avg(doc_len) FROM lens)))) AS score, sum(times)::BIGINT AS matched
  FROM asked JOIN terms USING (term) JOIN postings p USING (term) JOIN lens USING (doc) GROUP BY 1, 2)"""


def keyword_hits(k, name="hits"):
    return f"{INDEX}, {name} AS (SELECT query_id, id, round(score, 9) AS score, matched, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM bm QUALIFY rank <= {k})"


def index_of(t, searchable=False):
    """The keyword index of all documents, written once and read back."""
    return KeywordIndex.create(spread(t.documents.select("doc_id", "text")), "doc_id", "text", scratch(t.spark, "index"), searchable=searchable)


@query("v07_keyword_index", "V7", sql=f"WITH {INDEX} SELECT term, df, round(idf, 9) AS idf FROM terms")
def _(t):
    return index_of(t).terms().withColumn("idf", F.round("idf", 9))


@query("v08_keyword_search", "V8", sql=f"WITH {keyword_hits(10)} SELECT query_id, id, round(score, 6) AS score, matched, rank FROM hits")
def _(t):
    found = index_of(t).search(t.benchmark, "item_id", "text", 10)
    return found.select("query_id", "id", F.round("score", 6).alias("score"), "matched", F.col("rank").cast("long").alias("rank"))


@query("v08_block_search", "V8", sql=f"WITH {keyword_hits(10)} SELECT query_id, id, round(score, 6) AS score, matched, rank FROM hits")
def _(t):
    """The same from postings in blocks, of which only those that may hold a hit are opened."""
    found = index_of(t, searchable=True).search(t.benchmark, "item_id", "text", 10)
    return found.select("query_id", "id", F.round("score", 6).alias("score"), "matched", F.col("rank").cast("long").alias("rank"))


@query("v09_index_append", "V9", sql=f"WITH {INDEX} SELECT term, df, round(idf, 9) AS idf FROM terms")
def _(t):
    """Three languages first, the fourth appended: every idf must equal that of the whole."""
    root = scratch(t.spark, "index")
    first = KeywordIndex.create(t.documents.filter("lang <> 'en'"), "doc_id", "text", root, 0, searchable=False)
    return first.append(t.documents.filter("lang = 'en'"), "doc_id", "text", root, 1, searchable=False).terms().withColumn("idf", F.round("idf", 9))


# A corpus with both: document i has the text of documents and the vector of embeddings with that id;
# a benchmark question has the centroid of the label equal to its number modulo ten.
BOTH = f"""{INDEX}, {CENTROIDS}, q AS (SELECT item_id AS query_id, item_id % 10 AS label FROM benchmark),
 vh AS (SELECT q.query_id, s.id, s.score, row_number() OVER (PARTITION BY q.query_id ORDER BY s.score DESC, s.id) AS rank FROM q JOIN scored s ON s.query_id = q.label WHERE s.id IN (SELECT doc_id FROM documents) QUALIFY rank <= 20),
 kh AS (SELECT query_id, id, round(score, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM bm QUALIFY rank <= 20)"""


def question_vectors(t):
    return t.benchmark.select("item_id", "text", (F.col("item_id") % 10).alias("label")).join(
        centroids(t).withColumnRenamed("query_id", "label"), "label"
    ).select(F.col("item_id").alias("query_id"), "text", "vector")


def both_lists(t, k=20, indexed=False):
    """Hits by vector and by word; ``indexed`` takes both from stored indexes that skip what cannot hold a hit."""
    vectors = chunk_vectors(t).join(t.documents.select(F.col("doc_id").alias("chunk_id")), "chunk_id", "left_semi")
    if indexed:
        dense = vector_index_of(t, vectors).search(question_vectors(t), k)
    else:
        dense = vs.cosine_top_k(question_vectors(t), vectors, k, dimensions=64)
    return {"vector": dense, "keyword": index_of(t, searchable=indexed).search(t.benchmark, "item_id", "text", k)}


RRF = """fused AS (SELECT query_id, id, sum(1.0 / (60 + rank)) AS score, count(*) AS lists FROM (SELECT query_id, id, rank FROM vh UNION ALL SELECT query_id, id, rank FROM kh) GROUP BY 1, 2)"""


@query("v10_rank_fusion", "V10", "V12", sql=f"""WITH {BOTH}, {RRF} SELECT query_id, id, round(score, 9) AS score, lists, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM fused QUALIFY rank <= 10""")
def _(t):
    out = reciprocal_rank_fusion(both_lists(t))
    return out.select("query_id", "id", F.round("score", 9).alias("score"), F.size("sources").cast("long").alias("lists"), F.col("rank").cast("long").alias("rank"))


@query("v11_weighted_fusion", "V11", sql=f"""WITH {BOTH}, a AS (SELECT 'v' AS src, query_id, id, score FROM vh UNION ALL SELECT 'k', query_id, id, score FROM kh),
 n AS (SELECT src, query_id, id, (score - min(score) OVER p) / CASE WHEN max(score) OVER p > min(score) OVER p THEN max(score) OVER p - min(score) OVER p ELSE 1 END AS s FROM a WINDOW p AS (PARTITION BY src, query_id)),
 w AS (SELECT query_id, id, round(sum(0.5 * s), 6) AS score FROM n GROUP BY 1, 2) SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM w QUALIFY rank <= 10""")
def _(t):
    return ranked(weighted_fusion(both_lists(t)))


JACCARD = f"""toks AS (SELECT doc_id AS id, list_distinct({TOKENS}) AS d FROM documents), asks AS (SELECT item_id AS query_id, list_distinct({TOKENS}) AS a FROM benchmark),
 rescored AS (SELECT h.query_id, h.id, CASE WHEN len(list_distinct(list_concat(a, d))) > 0 THEN len(list_intersect(a, d)) / len(list_distinct(list_concat(a, d))) ELSE 0.0 END AS score FROM cand h JOIN toks USING (id) JOIN asks USING (query_id)),
 hits AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM rescored QUALIFY rank <= 5)"""


def candidates(t, k=10):
    found = cut_lineage(index_of(t).search(t.benchmark, "item_id", "text", k), "hits")
    return found.join(t.documents.select(F.col("doc_id").alias("id"), "text"), "id").join(
        t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("question")), "query_id"
    )


@query("v05_rerank", "V5", sql=f"WITH {keyword_hits(10, 'cand')}, {JACCARD} {ROUNDED}")
def _(t):
    return ranked(vs.rerank(candidates(t), uc.lexical_scorer, 5))


@query("k01_batch_scorer", "K1", "V5", sql=f"WITH {keyword_hits(10, 'cand')}, {JACCARD} {ROUNDED}")
def _(t):
    from millrace.functions.text import STOP_WORDS

    stop = frozenset(STOP_WORDS)

    def overlap(question: pd.Series, text: pd.Series) -> pd.Series:
        import re

        def words(x):
            return {w for w in re.sub(r"[^\w\s]", " ", x.lower()).split() if len(w) > 1 and w not in stop}

        pairs = [(words(a), words(b)) for a, b in zip(question, text, strict=True)]
        return pd.Series([len(a & b) / len(a | b) if a | b else 0.0 for a, b in pairs])

    return ranked(vs.rerank(candidates(t), uc.batch_scorer(overlap), 5))


def _mmr_sql(steps: int = 5, weight: float = 0.7) -> str:
    """The greedy choice written out step by step: at each, the candidate with the best mix of closeness
    to the query and distance from the nearest one picked."""
    picks = [f"p1 AS (SELECT query_id, arg_max(id, {{'s': {weight} * rel + {1 - weight}, 'r': -rank}}) AS id, max({weight} * rel + {1 - weight}) AS mmr, 1 AS pick FROM c GROUP BY 1)"]
    for i in range(2, steps + 1):
        before = " UNION ALL ".join(f"SELECT * FROM p{j}" for j in range(1, i))
        picks.append(f"""b{i} AS ({before}), n{i} AS (SELECT c.query_id, c.id, c.rank, any_value(c.rel) AS rel, max(list_dot_product(c.v, o.v)) AS near FROM c JOIN b{i} b ON b.query_id = c.query_id JOIN c o ON o.query_id = b.query_id AND o.id = b.id
 WHERE (c.query_id, c.id) NOT IN (SELECT (query_id, id) FROM b{i}) GROUP BY 1, 2, 3),
 p{i} AS (SELECT query_id, arg_max(id, {{'s': {weight} * rel + {1 - weight} * (1 - near), 'r': -rank}}) AS id, max({weight} * rel + {1 - weight} * (1 - near)) AS mmr, {i} AS pick FROM n{i} GROUP BY 1)""")
    return ",\n ".join(picks) + " " + " UNION ALL ".join(f"SELECT query_id::BIGINT AS query_id, id, pick::BIGINT AS pick, round(mmr, 6) AS mmr FROM p{i}" for i in range(1, steps + 1))


@query("v06_diverse_rerank", "V6", "K7", sql=f"""WITH {vector_hits(20)}, unit AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v FROM embeddings),
 c AS (SELECT query_id, id, rank, score AS rel, v FROM hits JOIN unit ON vec_id = id), {_mmr_sql()}""")
def _(t):
    vectors = chunk_vectors(t).select(F.col("chunk_id").alias("id"), "vector")
    out = vs.mmr(hits(t, 20), centroids(t), vectors, 5, 0.7)
    return out.select("query_id", "id", "pick", F.round("mmr", 6).alias("mmr"))


@query("v12_hybrid_rerank", "V12", sql=f"""WITH {BOTH}, {RRF}, cand AS (SELECT query_id, id FROM fused QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 10), {JACCARD} {ROUNDED}""")
def _(t):
    fused = cut_lineage(reciprocal_rank_fusion(both_lists(t, indexed=True), 10), "fused")
    found = fused.join(t.documents.select(F.col("doc_id").alias("id"), "text"), "id").join(
        t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("question")), "query_id"
    )
    return ranked(vs.rerank(found, uc.lexical_scorer, 5))


@query("v13_multi_query", "V13", sql=f"""WITH {vector_hits(10)}, merged AS (SELECT query_id % 5 AS query_id, id, max(score) AS score FROM hits GROUP BY 1, 2)
SELECT query_id::BIGINT AS query_id, id, round(score, 6) AS score FROM merged QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 10""")
def _(t):
    """Labels five apart are variants of one question."""
    per_variant = hits(t, 10).select((F.col("query_id") % 5).alias("query_id"), "id", "score")
    return shown(rel.best_per_id(per_variant, "query_id", "id", "score", 10), F.round("score", 6).alias("score"))


@query("v14_tfidf_vectors", "V14", sql=f"""WITH {INDEX}, voc AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index, ln((1 + (SELECT count(*) FROM lens)) / (1 + df)) + 1 AS i FROM terms),
 w AS (SELECT doc, term, term_index, tf * i AS w FROM postings JOIN voc USING (term)) SELECT doc, term, term_index, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc)), 9) AS value FROM w""")
def _(t):
    return tfidf_vectors(index_of(t)).withColumn("value", F.round("value", 9))


@query("v15_missing_document", "V15", sql=f"""WITH {vector_hits(100)}, wanted AS (SELECT c.query_id, e.vec_id % 7 AS doc, e.vec_id AS id FROM centroids c, embeddings e WHERE e.label = c.query_id)
SELECT w.query_id::BIGINT AS query_id, doc, count(*) AS chunks, round(max(score), 6) AS best_score, min(rank) AS best_rank, coalesce(min(rank) > 10, true) AS missing FROM wanted w LEFT JOIN hits h ON h.query_id = w.query_id AND h.id = w.id GROUP BY 1, 2""")
def _(t):
    wanted = t.embeddings.select(F.col("label").cast("long").alias("query_id"), (F.col("vec_id") % 7).alias("doc"), F.col("vec_id").alias("id"))
    out = vs.missing_document_probe(hits(t, 100), wanted, "query_id", "id", "doc")
    return out.withColumn("best_score", F.round("best_score", 6))


@query("v16_collection_stats", "V16", sql="SELECT count(*) AS points, count(DISTINCT label) AS documents, min(len(embedding)) AS min_dimensions, max(len(embedding)) AS max_dimensions FROM embeddings")
def _(t):
    return vs.collection_stats(t.embeddings, "label", "embedding")


@query("v17_batch_encode", "V17", "K2", sql=r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower('passage: ' || text), '\S+')) AS token FROM documents WHERE text IS NOT NULL),
 h AS (SELECT doc_id, ('0x' || substr(md5(token), 1, 8))::BIGINT AS h FROM w),
 d AS (SELECT doc_id, h % 64 AS d, sum(CASE WHEN (h >> 16) & 1 = 1 THEN 1.0 ELSE -1.0 END) AS x FROM h GROUP BY 1, 2)
SELECT doc_id, 64 AS dimensions, round(sqrt(sum(x * x)), 6) AS norm FROM d GROUP BY 1""")
def _(t):
    coded = uc.encode(t.documents.select("doc_id", "text"), "text", uc.hashing_encoder(64), prefix="passage: ")
    return coded.select("doc_id", F.size("vector").alias("dimensions"), F.round(vec.l2_norm(F.col("vector")), 6).alias("norm"))


@query("v18_skip_rerank", "V18", sql=rf"""WITH {vector_hits(1)} SELECT conv_id, turn, NOT (coalesce(score, 0) > 0.9 OR len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) < 5) AS should_rerank FROM conversations LEFT JOIN hits ON query_id = conv_id % 10""")
def _(t):
    top = hits(t, 1).select(F.col("query_id").alias("__q"), "score")
    rows = t.conversations.join(top, F.col("conv_id") % 10 == F.col("__q"), "left")
    return vs.skip_rerank(rows, "text", "score").select("conv_id", "turn", "should_rerank")


# --- contexts --------------------------------------------------------------

CONTEXT = f"""{keyword_hits(5)}, h AS (SELECT query_id, rank, source, text, score FROM hits JOIN documents ON doc_id = id)"""


def context_rows(t, k=5):
    found = cut_lineage(index_of(t).search(t.benchmark, "item_id", "text", k), "hits")
    return found.join(t.documents.select(F.col("doc_id").alias("id"), "source", "text"), "id").select("query_id", F.col("rank").cast("long").alias("rank"), "source", "text", "score")


@query("w09_context_budget", "W9", sql=f"""WITH {CONTEXT} SELECT query_id, rank FROM (SELECT *, sum(length(text) // 4) OVER (PARTITION BY query_id ORDER BY rank) AS used FROM h) WHERE used <= 2000""")
def _(t):
    return ch.within_budget(context_rows(t), ["query_id"], "rank", F.floor(F.length("text") / 4), 2000).select("query_id", "rank")


@query("t12_context_assembly", "T12", sql=f"""WITH {CONTEXT} SELECT query_id, md5(string_agg('[Source: ' || source || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank)) AS plain,
 string_agg('[Source ' || rank || ': ' || source || printf(' (relevance: %.2f)]', score), '|' ORDER BY rank) AS headers FROM h GROUP BY 1""")
def _(t):
    rows = context_rows(t)
    plain = ch.assemble_context(rows, ["query_id"], "rank", "source", "text").select("query_id", F.md5("context").alias("plain"))
    scored = ch.assemble_context(rows.withColumn("text", F.lit("")), ["query_id"], "rank", "source", "text", "score")
    return plain.join(scored.select("query_id", F.rtrim(F.replace("context", F.lit("\n\n\n"), F.lit("|")), F.lit("\n")).alias("headers")), "query_id")


@query("t16_group_by_source", "T16", sql=f"WITH {CONTEXT} SELECT query_id, source, min(rank) AS first_rank, md5(string_agg(text, chr(10) ORDER BY rank)) AS texts FROM h GROUP BY 1, 2")
def _(t):
    return ch.group_by_source(context_rows(t), ["query_id"], "rank", "source", "text").withColumn("texts", F.md5("texts"))


# --- quality of retrieval --------------------------------------------------

JUDGED = f"""{vector_hits(10)}, rel AS (SELECT label AS query_id, vec_id AS id FROM embeddings), j AS (SELECT h.query_id, h.id, h.rank, r.id IS NOT NULL AS hit FROM hits h LEFT JOIN rel r ON r.query_id = h.query_id AND r.id = h.id),
 totals AS (SELECT query_id, count(*) AS n FROM rel GROUP BY 1),
 metrics AS (SELECT query_id, count(*) FILTER (WHERE hit AND rank <= 3) / max(n) AS recall_3, count(*) FILTER (WHERE hit AND rank <= 5) / max(n) AS recall_5, count(*) FILTER (WHERE hit AND rank <= 3) / 3 AS precision_3,
  coalesce(1 / min(rank) FILTER (WHERE hit), 0.0) AS reciprocal_rank, coalesce(sum(1 / log2(rank + 1)) FILTER (WHERE hit AND rank <= 5), 0.0) / list_sum(list_transform(range(1, least(max(n), 5) + 1), lambda i: 1 / log2(i + 1))) AS ndcg_5 FROM j JOIN totals USING (query_id) GROUP BY 1)"""


def judged(t):
    relevant = t.embeddings.select(F.col("label").cast("long").alias("query_id"), F.col("vec_id").alias("id"))
    return ev.retrieval_metrics(hits(t, 10), relevant, centroids(t).select(F.col("query_id").cast("long").alias("query_id")))


METRICS = ["recall_3", "recall_5", "precision_3", "reciprocal_rank", "ndcg_5"]


@query("e01_e02_retrieval_metrics", "E1", "E2", sql=f"WITH {JUDGED} SELECT query_id::BIGINT AS query_id, {', '.join(f'round({m}, 9) AS {m}' for m in METRICS)} FROM metrics")
def _(t):
    return judged(t).select("query_id", *[F.round(m, 9).alias(m) for m in METRICS])


@query("e01_mean_metrics", "E1", "E2", sql=f"WITH {JUDGED} SELECT {', '.join(f'round(avg({m}), 9) AS {m}' for m in METRICS)} FROM metrics")
def _(t):
    return ev.mean_metrics(judged(t)).select(*[F.round(m, 9).alias(m) for m in METRICS])


@query("e03_redundant_neighbours", "E3", sql=f"""WITH {vector_hits(10)}, p AS (SELECT h.query_id, rank, list_cosine_similarity(lag(embedding::DOUBLE[]) OVER (PARTITION BY h.query_id ORDER BY rank), embedding::DOUBLE[]) AS s FROM hits h JOIN embeddings ON vec_id = id)
SELECT query_id::BIGINT AS query_id, rank, round(s, 6) AS similarity, s < 0.95 AS diverse FROM p WHERE rank > 1""")
def _(t):
    vectors = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    out = ev.redundant_neighbours(hits(t, 10), vectors)
    return out.select("query_id", F.col("rank").cast("long").alias("rank"), F.round("similarity", 6).alias("similarity"), "diverse")


@query("e16_expected_coverage", "E16", "U2", sql=f"""WITH {vector_hits(10)}, rel AS (SELECT label AS query_id, vec_id AS id FROM embeddings)
SELECT r.query_id::BIGINT AS query_id, round(count(h.id) / count(*), 9) AS coverage, count(h.id) / count(*) >= 0.5 AS passed FROM rel r LEFT JOIN hits h ON h.query_id = r.query_id AND h.id = r.id GROUP BY 1""")
def _(t):
    expected = t.embeddings.select(F.col("label").cast("long").alias("query_id"), F.col("vec_id").alias("id"))
    return ev.coverage(hits(t, 10), expected).withColumn("coverage", F.round("coverage", 9))
