"""Queries of the training-data operators: name -> (spark, directory) -> DataFrame, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import chat, decontaminate, fingerprints, huffman, jaccard, language, lexical, packing, pitmanyor, simhash, spans, spelling, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": corpus_pipeline.run}
SQL: dict[str, str] = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{table}.parquet")


def registered(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return wrap


@registered("op5_fingerprints")
def op5(spark: SparkSession, directory: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read(spark, directory, "documents"))


@registered("op8_perspectives", sql="""WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS content FROM conversations),
 p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role IS NOT NULL AND role <> 'system'),
 r AS (SELECT t.conv_id, perspective, turn, content,
   CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user' END AS speaker,
   CASE WHEN role IS DISTINCT FROM perspective AND role IS DISTINCT FROM 'system' THEN coalesce(role, '') END AS name
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
 h AS (SELECT *, '<|' || speaker || CASE WHEN name <> '' THEN ' name=' || name ELSE '' END || '|>' || chr(10) AS header FROM r),
 s AS (SELECT *, header || content || '<|end|>' || chr(10) AS segment FROM h),
 o AS (SELECT *, CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS segment_start FROM s)
SELECT conv_id, perspective, turn, speaker, name, segment, segment_start,
 CASE WHEN speaker = 'assistant' THEN segment_start + length(header) END AS loss_start,
 CASE WHEN speaker = 'assistant' THEN segment_start + length(header) + length(content) END AS loss_end FROM o""")
def op8(spark: SparkSession, directory: str) -> DataFrame:
    return chat.rotate(read(spark, directory, "conversations"))


@registered("op10_decontamination", sql="""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
 b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
 bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
 ns AS (SELECT DISTINCT n FROM bw),
 dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, ns WHERE len(w) >= n)),
 hits AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
 hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY 1),
 hi AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""")
def op10(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.report(read(spark, directory, "documents"), read(spark, directory, "benchmark"))


@registered("op6_packing")
def op6(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(read(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@registered("op2_token_store")
def op2(spark: SparkSession, directory: str) -> DataFrame:
    return huffman.round_trip(read(spark, directory, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@registered("op9_substring_dedup", sql="""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
 g AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
 r AS (SELECT doc_id, i FROM g JOIN (SELECT s FROM g GROUP BY s HAVING count(*) > 1) USING (s)),
 c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM r),
 k AS (SELECT doc_id, list(p) AS ps, count(*) AS n_removed FROM c GROUP BY 1),
 u AS (SELECT d.doc_id, w, n_removed, unnest(generate_series(1, len(w))) AS p FROM d LEFT JOIN k USING (doc_id) WHERE len(w) > 0),
 t AS (SELECT u.doc_id, string_agg(w[u.p], ' ' ORDER BY u.p) AS kept FROM u LEFT JOIN c ON u.doc_id = c.doc_id AND u.p = c.p WHERE c.p IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op9(spark: SparkSession, directory: str) -> DataFrame:
    return spans.report(read(spark, directory, "documents"))


@registered("op4_language")
def op4(spark: SparkSession, directory: str) -> DataFrame:
    return language.report(read(spark, directory, "documents"))


#: The rules of this query.
URL_RULES = [
    urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"),
]


@registered("op7_url_filter")
def op7(spark: SparkSession, directory: str) -> DataFrame:
    return urls.judge(read(spark, directory, "pages"), URL_RULES)


@registered("op3_pitman_yor")
def op3(spark: SparkSession, directory: str) -> DataFrame:
    return pitmanyor.score(read(spark, directory, "documents"))


@registered("op1_jaccard_join")
def op1(spark: SparkSession, directory: str) -> DataFrame:
    return jaccard.report(read(spark, directory, "documents"))


@registered("op11_spelling", sql="""WITH r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
 k AS (SELECT doc_id, run, count(*) AS times, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS x FROM r WHERE length(run) >= 6 GROUP BY doc_id, run),
 h AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: 16 * (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) + instr('0123456789ABCDEF', x[2 * i + 2]) - 1)),
   lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) AS h FROM k),
 w AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, times FROM h),
 v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY 1 HAVING sum(times) >= 5),
 d AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
 p AS (SELECT a.word AS word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
 q AS (SELECT DISTINCT d.word, v.word AS near, v.n AS near_n FROM d JOIN v ON d.rest = v.word),
 e AS (SELECT * FROM p UNION ALL SELECT * FROM q UNION ALL SELECT q.near, q.word, v.n FROM q JOIN v ON q.word = v.word),
 g AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM e GROUP BY 1),
 f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN g ON v.word = g.word),
 o AS (WITH RECURSIVE s AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL UNION ALL SELECT s.word, f.form FROM s JOIN f ON s.root = f.word WHERE f.form IS NOT NULL) SELECT s.word, root FROM s JOIN f ON s.root = f.word WHERE f.form IS NULL)
SELECT f.word, n, n_near, form, form_n, coalesce(root, f.word) AS root FROM f LEFT JOIN o ON f.word = o.word""")
def op11(spark: SparkSession, directory: str) -> DataFrame:
    return spelling.variants(read(spark, directory, "documents"))


@registered("op12_ranked_search", sql="""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
 q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
 s AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
 t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
 f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM t GROUP BY 1), s),
 m AS (SELECT doc_id, 50 + (50 * CAST(len(w) AS BIGINT) * nd) // l AS m FROM d, s WHERE len(w) > 0),
 c AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM q JOIN t USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY 1, 2),
 r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM c WHERE score > 0)
SELECT * FROM r WHERE rank <= 50""")
def op12(spark: SparkSession, directory: str) -> DataFrame:
    return lexical.rank(read(spark, directory, "documents"), read(spark, directory, "benchmark"))


@registered("op13_simhash")
def op13(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.report(read(spark, directory, "documents"))
