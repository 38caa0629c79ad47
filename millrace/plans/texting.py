"""Queries over text, chunks, conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import chunking as ch
from millrace.operators import memory
from millrace.plans.registry import query
from millrace.session import spread

# Sentences of a text in SQL: a marker after each sentence end, then a split.
SENTENCES = r"string_split(regexp_replace(text, '([.!?])[\s]+', '\1' || chr(1), 'g'), chr(1))"

def texts(t):
    return spread(t.documents.select("doc_id", "text"))


FOLD = f"""parts AS (SELECT doc_id, {SENTENCES} AS ss FROM documents),
 s AS (SELECT doc_id, list_transform(ss, lambda x: length(x)) AS lens, array_to_string(ss, ' ') AS j FROM parts),
 fold AS (SELECT doc_id, 2 AS i, 0::BIGINT AS st, lens[1] AS en, lens[1] AS used, NULL::BIGINT AS cs, NULL::BIGINT AS ce, len(lens) AS n FROM s
  UNION ALL SELECT f.doc_id, i + 1,
   CASE WHEN used + lens[i] > 512 THEN en - least(50, en - st) ELSE st END, en + 1 + lens[i], CASE WHEN used + lens[i] > 512 THEN least(50, en - st) ELSE used END + lens[i],
   CASE WHEN used + lens[i] > 512 THEN st END, CASE WHEN used + lens[i] > 512 THEN en END, n FROM fold f JOIN s ON s.doc_id = f.doc_id WHERE i <= n),
 spans AS (SELECT doc_id, cs, ce FROM fold WHERE cs IS NOT NULL UNION ALL SELECT doc_id, st, en FROM fold WHERE i = n + 1),
 chunks AS (SELECT sp.doc_id, cs AS start_char, ce AS end_char, substr(j, cs + 1, ce - cs) AS content FROM spans sp JOIN s ON s.doc_id = sp.doc_id)"""


@query("t01_character_chunks", "T1", "K6", sql=f"WITH RECURSIVE {FOLD} SELECT doc_id, start_char, end_char, md5(content) AS digest FROM chunks")
def _(t):
    out = ch.chunk_documents(texts(t), "doc_id", "text")
    return out.select("doc_id", F.col("start_char").cast("long"), F.col("end_char").cast("long"), F.md5("content").alias("digest"))


@query("t02_sentence_chunks", "T2", sql=f"""WITH RECURSIVE s AS (SELECT doc_id, ss, list_transform(ss, lambda x: length(x)) AS lens FROM (SELECT doc_id, {SENTENCES} AS ss FROM documents)),
 fold AS (SELECT doc_id, 2 AS i, 1 AS first, lens[1] AS used, NULL::INT AS cf, NULL::INT AS cl, len(lens) AS n FROM s
  UNION ALL SELECT f.doc_id, i + 1, CASE WHEN used + lens[i] > 500 THEN i - 1 ELSE first END, CASE WHEN used + lens[i] > 500 THEN lens[i - 1] ELSE used END + lens[i],
   CASE WHEN used + lens[i] > 500 THEN first END, CASE WHEN used + lens[i] > 500 THEN i - 1 END, n FROM fold f JOIN s ON s.doc_id = f.doc_id WHERE i <= n),
 ranges AS (SELECT doc_id, cf, cl FROM fold WHERE cf IS NOT NULL UNION ALL SELECT doc_id, first, n FROM fold WHERE i = n + 1)
SELECT r.doc_id, (cl - cf + 1)::BIGINT AS n_sentences, md5(array_to_string(ss[cf:cl], ' ')) AS digest FROM ranges r JOIN s ON s.doc_id = r.doc_id""")
def _(t):
    out = ch.chunk_by_sentences(texts(t), "doc_id", "text")
    return out.select("doc_id", F.col("n_sentences").cast("long"), F.md5("content").alias("digest"))


VECTORS = "v AS (SELECT label AS doc, vec_id AS pos, 'v' || vec_id AS sentence, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"
LAGGED = f"{VECTORS}, l AS (SELECT doc, pos, sentence, list_cosine_similarity(lag(vec) OVER (PARTITION BY doc ORDER BY pos), vec) AS similarity FROM v)"


def sentence_vectors(t):
    """``embeddings`` as a sentence table: the label is the document, the id the position."""
    return t.embeddings.select(F.col("label").alias("doc"), F.col("vec_id").alias("pos"), F.concat(F.lit("v"), "vec_id").alias("sentence"), F.col("embedding").alias("vec"))


@query("w10_previous_similarity", "W10", sql=f"WITH {LAGGED} SELECT doc, pos, round(similarity, 6) AS similarity FROM l")
def _(t):
    out = ch.similarity_to_previous(sentence_vectors(t), "doc", "pos", "vec")
    return out.select("doc", "pos", F.round("similarity", 6).alias("similarity"))


@query("t03_semantic_chunks", "T3", sql=f"""WITH {LAGGED}, b AS (SELECT *, sum(CASE WHEN similarity < 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS c FROM l)
SELECT doc, c::BIGINT AS chunk_no, string_agg(sentence, ' ' ORDER BY pos) AS content, count(*) AS n_sentences FROM b GROUP BY 1, 2""")
def _(t):
    return ch.semantic_chunks(sentence_vectors(t), "doc", "pos", "sentence", "vec", 0.5)


# Pages as Markdown: headings become header lines, each paragraph a line.
MARKDOWN = r"""pages_md AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<h1[^>]*>', chr(10) || '# ', 'g'), '<article[^>]*>|<footer[^>]*>', chr(10) || '## part' || chr(10), 'g'), '</h1>|</p>', chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)) AS md FROM pages)"""


def markdown(t):
    md = F.regexp_replace("html", "<h1[^>]*>", "\n# ")
    md = F.regexp_replace(md, "<article[^>]*>|<footer[^>]*>", "\n## part\n")
    md = F.regexp_replace(F.regexp_replace(md, "</h1>|</p>", "\n"), "<[^>]*>", "")
    return t.pages.select("page_id", F.trim(md, F.lit("\n")).alias("md"))


@query("t04_sections", "T4", sql=rf"""WITH {MARKDOWN}, lines AS (SELECT page_id, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS n FROM pages_md),
 numbered AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^#{{1,6}} ') THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY n) AS s FROM lines)
SELECT page_id, max(CASE WHEN regexp_matches(line, '^#{{1,6}} ') THEN length(regexp_extract(line, '^(#+) ', 1)) ELSE 0 END) AS level,
 coalesce(max(CASE WHEN regexp_matches(line, '^#{{1,6}} ') THEN trim(substr(line, length(regexp_extract(line, '^(#+) ', 1)) + 2)) END), '') AS title,
 coalesce(length(trim(string_agg(CASE WHEN NOT regexp_matches(line, '^#{{1,6}} ') THEN line END, chr(10) ORDER BY n), chr(10) || ' ')), 0) AS n_chars
FROM numbered GROUP BY page_id, s HAVING trim(string_agg(line, '')) <> ''""")
def _(t):
    out = ch.split_sections(markdown(t), "page_id", "md")
    return out.select("page_id", F.col("level").cast("long"), "title", F.length(F.trim(F.col("content"), F.lit("\n "))).cast("long").alias("n_chars"))


@query("t04_section_chunks", "T4")
def _(t):
    return ch.chunk_sections(markdown(t), "page_id", "md").select("page_id", "section_no", "path", "chunk_no", "content")


@query("t05_chunk_ids", "T5", sql=f"""WITH RECURSIVE {FOLD}, named AS (SELECT *, row_number() OVER w - 1 AS no, lag(start_char) OVER w IS NOT DISTINCT FROM start_char AS again FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY start_char, end_char)),
 h AS (SELECT doc_id, no, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(doc_id || ':' || start_char || CASE WHEN again THEN ':' || no ELSE '' END)) AS d FROM named)
SELECT doc_id, no AS chunk_no, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || ['8', '9', 'a', 'b'][(('0x' || substr(d, 17, 1))::BIGINT & 3) + 1] || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS chunk_id FROM h""")
def _(t):
    return ch.chunk_documents(texts(t), "doc_id", "text").select("doc_id", F.col("chunk_no").cast("long"), "chunk_id")


@query("t06_exact_duplicates", "T6", sql=r"""SELECT sha256(trim(regexp_replace(lower(text), '[\s]+', ' ', 'g'))) AS digest, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1""")
def _(t):
    return ch.first_copies(texts(t), tx.content_hash(F.col("text")), "doc_id")


PII_SQL = r"""pii AS (SELECT doc_id, 'EMAIL_ADDRESS' AS kind, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}')) AS found FROM documents
 UNION ALL SELECT doc_id, 'PHONE_NUMBER', unnest(regexp_extract_all(text, '\+1 \(\d{3}\) \d{3}-\d{4}')) FROM documents
 UNION ALL SELECT doc_id, 'IP_ADDRESS', unnest(regexp_extract_all(' ' || regexp_replace(text, '[ \n]', '  ', 'g'), '[ (]((?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?:[^0-9A-Za-z.-]|[.] |$)', 1)) FROM documents
 UNION ALL SELECT doc_id, 'CREDIT_CARD', unnest(regexp_extract_all(' ' || regexp_replace(text, '[ \n]', '  ', 'g'), '[ ](\d{16})(?:[^0-9A-Za-z.-]|[.] |$)', 1)) FROM documents)"""
LUHN_SQL = r"""list_sum(list_transform(range(16), lambda i: CASE WHEN i % 2 = 1 THEN substr(found, 16 - i, 1)::INT ELSE substr(found, 16 - i, 1)::INT END * CASE WHEN i % 2 = 1 THEN 2 ELSE 1 END
   - CASE WHEN i % 2 = 1 AND substr(found, 16 - i, 1)::INT > 4 THEN 9 ELSE 0 END)) % 10 = 0"""


@query("t07_personal_data", "T7", sql=f"WITH {PII_SQL} SELECT kind AS type, found, count(*) AS n FROM pii WHERE kind <> 'CREDIT_CARD' OR {LUHN_SQL} GROUP BY 1, 2")
def _(t):
    spans = texts(t).select("doc_id", F.explode(tx.detect_pii(F.col("text"))).alias("p"))
    return spans.groupBy(F.col("p.type").alias("type"), F.col("p.text").alias("found")).agg(F.count(F.lit(1)).alias("n"))


@query("t07_personal_data_spans", "T7", sql=f"""WITH {PII_SQL} SELECT doc_id, kind AS type, count(*) AS n, true AS offsets_agree FROM pii WHERE kind <> 'CREDIT_CARD' OR {LUHN_SQL} GROUP BY 1, 2""")
def _(t):
    spans = texts(t).select("doc_id", "text", F.explode(tx.detect_pii(F.col("text"))).alias("p"))
    agree = F.substring("text", F.col("p.start") + 1, F.col("p.end") - F.col("p.start")) == F.col("p.text")
    return spans.groupBy("doc_id", F.col("p.type").alias("type")).agg(F.count(F.lit(1)).alias("n"), F.bool_and(agree).alias("offsets_agree"))


@query("t08_personal_data_mask", "T8", sql=f"""WITH {PII_SQL}, hit AS (SELECT doc_id, sum(length(found) - length(kind) - 2) AS shrink FROM pii WHERE kind <> 'CREDIT_CARD' OR {LUHN_SQL} GROUP BY 1)
SELECT d.doc_id, (length(text) - coalesce(shrink, 0))::BIGINT AS masked_length FROM documents d LEFT JOIN hit USING (doc_id)""")
def _(t):
    return texts(t).select("doc_id", F.length(tx.mask_pii(F.col("text"))).cast("long").alias("masked_length"))


@query("t09_chunk_quality", "T9", sql=f"""WITH RECURSIVE {FOLD} SELECT doc_id, count(*) AS chunks, count(*) FILTER (WHERE NOT regexp_matches(content, '[.!?\\n]$')) AS open_ended,
 count(*) FILTER (WHERE length(content) < 50) AS too_short, count(*) FILTER (WHERE length(content) > 1000) AS too_long FROM chunks GROUP BY 1""")
def _(t):
    return ch.chunk_quality(ch.chunk_documents(texts(t), "doc_id", "text"), "doc_id", "content")


@query("t10_context_usage", "T10", sql=r"""WITH w AS (SELECT conv_id * 100 + turn AS k, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS ws, lower(replace(text, 'la ', '')) AS a FROM conversations),
 g AS (SELECT k, unnest(list_concat(list_concat(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')), list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))),
   list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))) AS g FROM w),
 best AS (SELECT k, g FROM (SELECT k, g, count(*) AS n FROM g GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, g) <= 50)
SELECT w.k, round(coalesce(avg(CASE WHEN b.g IS NULL THEN NULL WHEN contains(a, b.g) THEN 1.0 ELSE 0.0 END), 0.0), 9) AS usage FROM w LEFT JOIN best b ON w.k = b.k GROUP BY 1""")
def _(t):
    rows = t.conversations.select((F.col("conv_id") * 100 + F.col("turn")).alias("k"), "text", F.replace(F.col("text"), F.lit("la "), F.lit("")).alias("a"))
    return ch.context_usage(rows, "k", "text", "a").withColumn("usage", F.round("usage", 9))


STOP = "[" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + "]"
TOKENS = rf"list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+'), lambda w: length(w) > 1 AND NOT list_contains({STOP}, w))"


@query("t11_tokens", "T11", sql=f"SELECT token, count(*) AS n FROM (SELECT unnest({TOKENS}) AS token FROM documents) GROUP BY 1")
def _(t):
    return texts(t).select(F.explode(tx.tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("t13_html_text", "T13", sql=r"""SELECT page_id, md5(body) AS digest, length(body) AS size FROM (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(
 regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g')) AS body FROM pages)""")
def _(t):
    body = tx.html_to_text(F.col("html"))
    return t.pages.select("page_id", F.md5(body).alias("digest"), F.length(body).cast("long").alias("size"))


@query("t14_html_table", "T14", sql=r"""WITH l AS (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS hs, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS ts FROM pages),
 u AS (SELECT page_id, list_transform(hs, lambda x: replace(replace(x, '&quot;', '"'), '&amp;', '&')) AS hs, list_transform(ts, lambda x: replace(replace(x, '&quot;', '"'), '&amp;', '&')) AS ts FROM l)
SELECT page_id, 'Table with ' || len(hs) || ' rows and 2 columns.' || chr(10) || 'Columns: href, text' || chr(10) || chr(10) ||
 array_to_string(list_transform(range(1, least(len(hs), 5) + 1), lambda i: 'Row ' || (i - 1) || ': href: ' || trim(hs[i]) || ', text: ' || trim(ts[i]) || chr(10)), '') AS described FROM u WHERE len(hs) > 0""")
def _(t):
    rows = F.regexp_extract_all("html", F.lit(r'<li><a href="[^"]*">[^<]*</a></li>'), 0)
    cells = F.transform(rows, lambda r: F.regexp_replace(r, r'<li><a href="([^"]*)">([^<]*)</a></li>', "<tr><td>$1</td><td>$2</td></tr>"))
    table = F.concat(F.lit("<table><tr><th>href</th><th>text</th></tr>"), F.array_join(cells, ""), F.lit("</table>"))
    tables = t.pages.filter(F.size(rows) > 0).select("page_id", F.explode(tx.html_tables(table)).alias("markup"))
    return tables.select("page_id", tx.table_to_text(F.col("markup")).alias("described"))


@query("t15_keyword_coverage", "T15", sql="""SELECT doc_id, round(len(list_filter(['the', 'tion', 'and', 'que', 'sch'], lambda w: contains(lower(text), w))) / 5, 6) AS coverage,
 len(list_filter(['the', 'tion', 'and', 'que', 'sch'], lambda w: contains(lower(text), w))) / 5 >= 0.5 AS passed FROM documents""")
def _(t):
    share = tx.keyword_coverage(F.col("text"), ["the", "tion", "and", "que", "sch"])
    return t.documents.select("doc_id", F.round(share, 6).alias("coverage"), (share >= 0.5).alias("passed"))


BACK = "[" + ", ".join(f"'{w}'" for w in tx.BACK_REFERENCES) + "]"
COMPOUND = "[" + ", ".join(f"'{w}'" for w in tx.COMPOUND_PHRASES) + "]"


@query("t17_needs_context", "T17", sql=rf"""SELECT item_id, len(list_intersect(regexp_split_to_array(lower(text), '\s+'), {BACK})) > 0 OR contains(' ' || trim(regexp_replace(lower(text), '\s+', ' ', 'g')) || ' ', ' the same ') AS flag FROM benchmark
UNION ALL SELECT 1000000 + conv_id * 100 + turn, len(list_intersect(regexp_split_to_array(lower(text), '\s+'), {BACK})) > 0 OR contains(' ' || trim(regexp_replace(lower(text), '\s+', ' ', 'g')) || ' ', ' the same ') FROM conversations""")
def _(t):
    questions = t.benchmark.unionByName(t.conversations.select((F.col("conv_id") * 100 + F.col("turn") + 1000000).alias("item_id"), "text"))
    return questions.select("item_id", tx.needs_context(F.col("text")).alias("flag"))


@query("t18_needs_decomposition", "T18", sql=rf"""SELECT conv_id, turn, len(list_filter({COMPOUND}, lambda p: contains(' ' || lower(text) || ' ', ' ' || p || ' '))) > 0 OR len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) > 15
 OR length(text) - length(replace(text, '?', '')) > 1 AS flag FROM conversations""")
def _(t):
    return t.conversations.select("conv_id", "turn", tx.needs_decomposition(F.col("text")).alias("flag"))


# --- conversation memory ---------------------------------------------------

NOW = "2024-01-05 12:00:00"


def messages(t):
    """``conversations`` has no times: a conversation starts an hour after the one before, a turn takes a minute."""
    return t.conversations.select(
        "conv_id", "turn", "role", "text",
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("conv_id").cast("int"), mins=F.col("turn").cast("int"))).alias("ts"),
    )


MESSAGES = "m AS (SELECT *, TIMESTAMP '2024-01-01' + INTERVAL (conv_id) HOUR + INTERVAL (turn) MINUTE AS ts FROM conversations)"
LIVE = f"""{MESSAGES}, live AS (SELECT * FROM m WHERE conv_id IN (SELECT conv_id FROM m GROUP BY 1 HAVING max(ts) >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY ts DESC, turn DESC) <= 20)"""


@query("w07_session_memory", "W7", sql=rf"""WITH {LIVE}, l5 AS (SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 5)
SELECT conv_id, count(*) AS messages, (SELECT coalesce(string_agg(DISTINCT w, ' ' ORDER BY w), '') FROM (SELECT unnest(regexp_extract_all(text, '[A-Z][a-z]+')) AS w FROM l5 WHERE l5.conv_id = live.conv_id)) AS terms FROM live GROUP BY 1""")
def _(t):
    live = memory.live_messages(messages(t), "conv_id", "turn", "ts", NOW)
    named = live.withColumn("names", F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), 0))
    return memory.session_context(named, "conv_id", "turn", "names").withColumn("terms", F.array_join("terms", " "))


@query("w08_history_budget", "W8", sql="""WITH l AS (SELECT conv_id, turn, upper(substr(role, 1, 1)) || substr(role, 2) || ': ' || text AS line FROM conversations),
 b AS (SELECT *, sum(length(line)) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS used FROM l)
SELECT conv_id, string_agg(line, chr(10) ORDER BY turn) AS history, count(*) AS lines FROM b WHERE used <= 800 GROUP BY 1""")
def _(t):
    return memory.prompt_history(t.conversations, "conv_id", "turn", "role", "text", 200)
