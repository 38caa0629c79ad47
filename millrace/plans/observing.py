"""Queries over graphs, lineage, metrics, logs, traces and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import chunking as ch
from millrace.operators import graph as g
from millrace.operators import metrics as m
from millrace.operators import usercode as uc
from millrace.plans.registry import query
from millrace.plans.texting import FOLD, texts
from millrace.plans.views import QUERY_LOG, query_log
from millrace.session import cut_lineage


def triple_text(t):
    """One small text per supplier with two good lines and one that is no triple."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("s_suppkey", F.concat(
        "s_name", F.lit(" | located in | "), "n_name", F.lit("\nsee | also\n "), "n_name", F.lit(" | part of |  "), "r_name"
    ).alias("text"))


TRIPLES = """tri AS (SELECT s_suppkey, s_name AS subject, 'located in' AS relation, n_name AS object FROM supplier JOIN nation ON s_nationkey = n_nationkey
 UNION ALL SELECT s_suppkey, n_name, 'part of', r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 both_ways AS (SELECT DISTINCT * FROM (SELECT subject AS src, upper(replace(relation, ' ', '_')) AS label, object AS dst FROM tri UNION ALL SELECT object, upper(replace(relation, ' ', '_')), subject FROM tri)),
 starts AS (SELECT r_name AS start FROM region UNION ALL SELECT n_name FROM nation),
 hop1 AS (SELECT start, dst AS name, min([label]) AS relations, 1 AS distance FROM starts JOIN both_ways ON src = start GROUP BY 1, 2),
 hop2 AS (SELECT h.start, b.dst AS name, min(list_append(h.relations, b.label)) AS relations, 2 AS distance FROM hop1 h JOIN both_ways b ON b.src = h.name WHERE b.dst <> h.start AND (h.start, b.dst) NOT IN (SELECT (start, name) FROM hop1) GROUP BY 1, 2),
 kinds AS (SELECT r_name AS entity, 'region' AS "type" FROM region UNION ALL SELECT n_name, 'nation' FROM nation UNION ALL SELECT s_name, 'supplier' FROM supplier),
 reached AS (SELECT * FROM hop1 UNION ALL SELECT * FROM hop2)"""


def edges(t):
    tri = g.parse_triples(triple_text(t), "s_suppkey", "text")
    return tri.select(F.col("subject").alias("src"), g.relation_label(F.col("relation")).alias("label"), F.col("object").alias("dst"))


def starts(t):
    return t.region.select(F.col("r_name").alias("start")).unionByName(t.nation.select(F.col("n_name").alias("start")))


def kinds(t):
    """(entity, type) of everything the triples name."""
    kind = lambda df, name, text: df.select(F.col(name).alias("entity"), F.lit(text).alias("type"))
    return kind(t.region, "r_name", "region").unionByName(kind(t.nation, "n_name", "nation")).unionByName(kind(t.supplier, "s_name", "supplier"))


@query("g01_triples", "G1", sql=f"WITH {TRIPLES} SELECT * FROM tri")
def _(t):
    return g.parse_triples(triple_text(t), "s_suppkey", "text")


ENTITY_SQL = r"regexp_extract_all(' ' || regexp_replace(content, '[^\p{L}\p{N}_]+', '  ', 'g') || ' ', ' (\p{Lu}\p{Ll}{3,}) ', 1)"
MENTIONS = f"""{FOLD}, ent AS (SELECT doc_id, start_char, end_char, unnest(es) AS entity, generate_subscripts(es, 1) AS position FROM (SELECT *, {ENTITY_SQL} AS es FROM chunks)),
 rel AS (SELECT doc_id, start_char, end_char, position, entity AS src, lead(entity) OVER (PARTITION BY doc_id, start_char, end_char ORDER BY position) AS dst FROM ent)"""


def chunk_graph(t):
    """Capitalised words as entities; consecutive ones are related, and one candidate relation per
    entity points at a word that is no entity."""
    chunks = cut_lineage(ch.chunk_documents(texts(t), "doc_id", "text").select("doc_id", "chunk_id", "content"), "chunks")
    mentions = cut_lineage(uc.extract_entities(chunks, "chunk_id", "content"), "mentions")
    nxt = mentions.select("chunk_id", (F.col("position") - 1).alias("position"), F.col("entity").alias("object"))
    follows = mentions.join(nxt, ["chunk_id", "position"]).select("chunk_id", F.col("entity").alias("subject"), F.lit("next to").alias("predicate"), "object")
    stray = mentions.select("chunk_id", F.col("entity").alias("subject"), F.lit("points at").alias("predicate"), F.lit("nowhere").alias("object"))
    return g.build_tables(chunks, mentions, follows.unionByName(stray)), chunks, mentions


@query("g02_graph_tables", "G2", sql=f"""WITH RECURSIVE {MENTIONS} SELECT 'part_of' AS table_name, count(*) AS rows FROM chunks UNION ALL SELECT 'mentions', count(*) FROM (SELECT DISTINCT doc_id, start_char, end_char, entity FROM ent)
UNION ALL SELECT 'entities', count(DISTINCT entity) FROM ent UNION ALL SELECT 'relations', count(*) FROM rel WHERE dst IS NOT NULL""")
def _(t):
    tables, _, _ = chunk_graph(t)
    out = None
    for name in ("part_of", "mentions", "entities", "relations"):
        row = tables[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


@query("g02_relations", "G2", sql=f"WITH RECURSIVE {MENTIONS} SELECT src, 'NEXT_TO' AS label, dst, count(*) AS n FROM rel WHERE dst IS NOT NULL GROUP BY 1, 3")
def _(t):
    return chunk_graph(t)[0]["relations"].groupBy("src", "label", "dst").agg(F.count(F.lit(1)).alias("n"))


@query("g03_entity_merge", "G3", sql=f"WITH RECURSIVE {MENTIONS} SELECT entity, 'NAME' AS \"type\", count(*) AS mentions FROM ent GROUP BY 1")
def _(t):
    return g.merge_entities(chunk_graph(t)[2])


@query("g04_related_entities", "G4", sql=f"WITH {TRIPLES} SELECT start, name, \"type\", array_to_string(relations, ' > ') AS relations, distance FROM reached JOIN kinds ON entity = name QUALIFY row_number() OVER (PARTITION BY start ORDER BY distance, name) <= 20")
def _(t):
    found = g.with_types(g.nearest(g.related(starts(t), edges(t))), kinds(t))
    return found.select("start", "name", "type", F.array_join("relations", " > ").alias("relations"), "distance")


@query("g05_related_contexts", "G5", sql=f"""WITH {TRIPLES}, m AS (SELECT DISTINCT name AS entity, text FROM reached JOIN (SELECT s_suppkey, unnest([s_name, n_name, r_name]) AS entity, s_name || ' | located in | ' || n_name || chr(10) || 'see | also' || chr(10) || ' ' || n_name || ' | part of |  ' || r_name AS text
 FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) c ON c.entity = name), f AS (SELECT entity, text FROM m QUALIFY row_number() OVER (PARTITION BY entity ORDER BY text) <= 3)
SELECT start, name AS entity, "type", array_to_string(relations, ' > ') AS relations, contexts FROM reached JOIN kinds k ON k.entity = name JOIN (SELECT entity, string_agg(text, '//' ORDER BY text) AS contexts FROM f GROUP BY 1) c ON c.entity = name""")
def _(t):
    chunks = triple_text(t).select(F.col("s_suppkey").alias("chunk_id"), F.col("text").alias("content"))
    tri = g.parse_triples(chunks, "chunk_id", "content")
    mentions = tri.select("chunk_id", F.col("subject").alias("entity")).unionByName(tri.select("chunk_id", F.col("object").alias("entity"))).distinct()
    reached = cut_lineage(g.with_types(g.related(starts(t), edges(t)), kinds(t)), "reached")
    out = reached.withColumnRenamed("name", "entity").join(g.related_contexts(reached, mentions, chunks), "entity")
    return out.select("start", "entity", "type", F.array_join("relations", " > ").alias("relations"), F.array_join("contexts", "//").alias("contexts"))


@query("g06_entity_search", "G6", sql="SELECT c_name AS entity, c_mktsegment AS \"type\" FROM customer WHERE contains(lower(c_name), 'mer#00000012') AND c_mktsegment = 'BUILDING' ORDER BY 1 LIMIT 10")
def _(t):
    entities = t.customer.select(F.col("c_name").alias("entity"), F.col("c_mktsegment").alias("type"))
    return g.search_entities(entities, "MER#00000012", "BUILDING")


def job_events(t):
    """Jobs seen in the data: nations feed order states, order states feed line states, line states feed a model per ship year."""
    name = lambda kind, c: F.array(F.concat(F.lit(f"{kind}/"), c.cast("string")))
    first = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).select(name("customer", F.col("c_nationkey")).alias("inputs"), name("orders", F.col("o_orderstatus")).alias("outputs"))
    second = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(name("orders", F.col("o_orderstatus")).alias("inputs"), name("lines", F.col("l_returnflag")).alias("outputs"))
    third = t.lineitem.select(name("lines", F.col("l_returnflag")).alias("inputs"), name("model", F.year("l_shipdate")).alias("outputs"))
    return first.unionByName(second).unionByName(third)


@query("g07_lineage_impact", "G7", sql="""WITH RECURSIVE e AS (SELECT DISTINCT 'customer/' || c_nationkey AS i, 'orders/' || o_orderstatus AS o FROM customer JOIN orders ON c_custkey = o_custkey
 UNION SELECT DISTINCT 'orders/' || o_orderstatus, 'lines/' || l_returnflag FROM orders JOIN lineitem ON o_orderkey = l_orderkey UNION SELECT DISTINCT 'lines/' || l_returnflag, 'model/' || year(l_shipdate) FROM lineitem),
 r AS (SELECT 'customer/' || n_nationkey AS start, 'customer/' || n_nationkey AS dataset, 0 AS depth FROM nation UNION SELECT start, e.o, depth + 1 FROM r JOIN e ON e.i = r.dataset WHERE depth < 20)
SELECT start, dataset, min(depth) AS depth FROM r WHERE depth > 0 AND dataset LIKE 'model/%' GROUP BY 1, 2""")
def _(t):
    begin = t.nation.select(F.concat(F.lit("customer/"), F.col("n_nationkey").cast("string")).alias("start"))
    return g.impact(begin, g.lineage_edges(job_events(t))).filter(F.col("dataset").startswith("model/"))


@query("g08_neighbour_lines", "G8", sql=f"""WITH {TRIPLES}, f1 AS (SELECT DISTINCT start, label AS first, dst AS name, 1 AS distance FROM starts JOIN both_ways ON src = start),
 f2 AS (SELECT DISTINCT f.start, f.first, b.dst AS name, 2 AS distance FROM f1 f JOIN both_ways b ON b.src = f.name WHERE b.dst <> f.start AND (f.start, f.first, b.dst) NOT IN (SELECT (start, first, name) FROM f1)),
 l AS (SELECT * FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2) QUALIFY row_number() OVER (PARTITION BY start ORDER BY distance, first, name) <= 5)
SELECT start, start || ' relationships:' || chr(10) || string_agg('  - ' || start || ' ' || first || ' ' || name, chr(10) ORDER BY distance, first, name) AS described FROM l GROUP BY 1""")
def _(t):
    return g.neighbour_lines(starts(t), edges(t))


# --- metrics ---------------------------------------------------------------

SAMPLES = """samples AS (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'counter' WHEN event_type = 'purchase' THEN 'gauge' ELSE 'histogram' END AS "type", event_type AS name, 'env="' || CASE WHEN user_id % 2 = 0 THEN 'prod' ELSE 'dev' END || '",shard="' || user_id % 4 || '"' AS labels, value, ts FROM events),
 series AS (SELECT "type", name, labels, CASE WHEN "type" = 'gauge' THEN arg_max(value, {'t': ts, 'v': value}) ELSE CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) END AS value, count(*) AS observations FROM samples GROUP BY 1, 2, 3)"""


def samples(t):
    kind = F.when(F.col("event_type").isin("click", "view"), "counter").when(F.col("event_type") == "purchase", "gauge").otherwise("histogram")
    labels = F.create_map(F.lit("shard"), (F.col("user_id") % 4).cast("string"), F.lit("env"), F.when(F.col("user_id") % 2 == 0, "prod").otherwise("dev"))
    return t.events.select(kind.alias("type"), F.col("event_type").alias("name"), "value", labels.alias("labels"), F.col("ts").alias("timestamp"))


@query("l01_metric_series", "L1", sql=f"WITH {SAMPLES} SELECT * FROM series")
def _(t):
    return m.series(samples(t))


BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0]
HIST = "hist AS (SELECT event_type, unnest([5.0, 10.0, 25.0, 50.0, 100.0, 'infinity'::DOUBLE]) AS le, unnest([count(*) FILTER (WHERE value <= 5), count(*) FILTER (WHERE value <= 10), count(*) FILTER (WHERE value <= 25), count(*) FILTER (WHERE value <= 50), count(*) FILTER (WHERE value <= 100), count(value)]) AS count FROM events GROUP BY 1)"


@query("l02_histogram", "L2", sql=f"WITH {HIST} SELECT * FROM hist")
def _(t):
    return m.histogram(t.events, ["event_type"], "value", BOUNDS)


@query("l03_bucket_quantile", "L3", sql=f"""WITH {HIST}, p AS (SELECT *, coalesce(lag(count) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0.0) AS lo, max(count) OVER (PARTITION BY event_type) * 0.95 AS r FROM hist WINDOW w AS (PARTITION BY event_type ORDER BY le))
SELECT event_type, round(max(CASE WHEN le = 'infinity'::DOUBLE THEN lo ELSE lo + (le - lo) * (r - below) / (count - below) END), 6) AS quantile FROM p WHERE count >= r AND below < r GROUP BY 1""")
def _(t):
    return m.histogram_quantile(m.histogram(t.events, ["event_type"], "value", BOUNDS), ["event_type"], 0.95).withColumn("quantile", F.round("quantile", 6))


@query("l04_error_ratio", "L4", sql="""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS total, count(*) FILTER (WHERE event_type = 'error') AS errors, round(count(*) FILTER (WHERE event_type = 'error') / count(*), 9) AS ratio,
 count(*) FILTER (WHERE event_type = 'error') / count(*) > 0.05 AS alert FROM events GROUP BY 1""")
def _(t):
    return m.error_ratio(t.events, "ts", F.col("event_type") == "error").withColumn("ratio", F.round("ratio", 9))


@query("l04_hourly_increase", "L4", sql="SELECT date_trunc('hour', ts) AS window_start, count(*) FILTER (WHERE event_type = 'error') AS increase, count(*) FILTER (WHERE event_type = 'error') > 5 AS alert FROM events GROUP BY 1")
def _(t):
    return m.increase(t.events, "ts", F.col("event_type") == "error")


@query("l05_exposition", "L5", sql=f"WITH {SAMPLES} SELECT name || '{{' || labels || '}} ' || observations::VARCHAR AS line FROM series")
def _(t):
    return m.exposition(m.series(samples(t)).withColumn("value", F.col("observations")))


def log_lines(t):
    entry = F.to_json(F.struct(
        F.col("ts").cast("string").alias("timestamp"), F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("svc"), F.col("user_id") % 3).alias("service"), F.col("user_id").cast("string").alias("correlation_id"),
        F.col("event_type").alias("message"), F.when(F.col("value") > 50, F.col("event_id").cast("string")).alias("span_id"),
    ))
    return t.events.select(F.when(F.col("event_id") % 10 == 9, F.concat(F.lit("! "), "event_type")).otherwise(entry).alias("line"))


@query("l06_log_counts", "L6", sql="""SELECT CASE WHEN event_id % 10 = 9 THEN 'CORRUPT' WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, CASE WHEN event_id % 10 <> 9 THEN 'svc' || user_id % 3 END AS service, count(*) AS lines,
 count(CASE WHEN event_id % 10 <> 9 AND value > 50 THEN 1 END) AS in_span FROM events GROUP BY 1, 2""")
def _(t):
    return m.log_counts(m.parse_logs(log_lines(t), "line"))


@query("l07_trace_summary", "L7", sql="""WITH s AS (SELECT l_orderkey AS trace_id, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS root, l_linenumber, l_partkey, l_shipdate, l_quantity, l_returnflag FROM lineitem)
SELECT trace_id, count(*) AS spans, count(*) FILTER (WHERE l_linenumber = 1) AS roots, min(l_shipdate) AS started, max(l_shipdate + INTERVAL (l_quantity::INT) MINUTE) AS ended,
 arg_min('part' || l_partkey, {'t': -l_quantity, 's': l_linenumber::BIGINT * 1000000000 + l_partkey}) AS slowest, CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN 'error' ELSE 'success' END AS status FROM s GROUP BY 1""")
def _(t):
    spans = t.lineitem.select(
        F.col("l_orderkey").alias("trace_id"), (F.col("l_linenumber").cast("long") * 1000000000 + F.col("l_partkey")).alias("span_id"), F.when(F.col("l_linenumber") > 1, F.lit(1)).alias("parent_span_id"),
        F.concat(F.lit("part"), "l_partkey").alias("name"), F.col("l_shipdate").alias("start_time"),
        (F.col("l_shipdate") + F.make_dt_interval(mins=F.col("l_quantity").cast("int"))).alias("end_time"), F.when(F.col("l_returnflag") == "R", "error").otherwise("success").alias("status"),
    )
    return m.trace_summary(spans)


@query("l08_alert_rules", "L8", sql="""WITH v AS (SELECT 'query_latency_p95' AS metric, quantile_cont(value, 0.95) AS value FROM events UNION ALL SELECT 'error_ratio', count(*) FILTER (WHERE event_type = 'error') / count(*) FROM events
 UNION ALL SELECT 'retrieval_score', avg(value) / 100 FROM events UNION ALL SELECT 'unruled', 1.0)
SELECT r.alert, v.metric, round(value, 9) AS value, severity, CASE op WHEN '>' THEN value > threshold ELSE value < threshold END AS firing FROM v JOIN (VALUES ('HighLatency', 'query_latency_p95', '>', 3.0, 'warning'), ('HighErrorRate', 'error_ratio', '>', 0.05, 'critical'), ('LowRetrievalQuality', 'retrieval_score', '<', 0.5, 'warning')) r(alert, metric, op, threshold, severity) ON r.metric = v.metric""")
def _(t):
    from millrace.operators.ordered import linear_quantiles

    p95 = linear_quantiles(t.events.select("value"), [], "value", {"p95": 0.95}).select("p95").scalar()
    facts = t.events.agg(
        (F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))).alias("error_ratio"), (F.avg("value") / 100).alias("retrieval_score")
    ).select("*", p95.alias("query_latency_p95"), F.lit(1.0).alias("unruled"))
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in facts.columns]
    return m.evaluate_rules(facts.select(F.explode(F.array(*cells)).alias("v")).select("v.*")).withColumn("value", F.round("value", 9))


RULED = """w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS ts, count(*) FILTER (WHERE event_type = 'error') / count(*) AS ratio, count(*) FILTER (WHERE event_type = 'error') AS failed, avg(value) / 100 AS score FROM events GROUP BY 1),
 s AS (SELECT ts, unnest(['prediction_error_ratio', 'failed_runs', 'retrieval_score']) AS metric, unnest([ratio, failed::DOUBLE, score]) AS value FROM w),
 rules AS (SELECT * FROM (VALUES ('HighPredictionErrorRate', 'prediction_error_ratio', '>', 0.05, 'critical', 5), ('RunFailure', 'failed_runs', '>', 0.0, 'warning', 5), ('LowRetrievalQuality', 'retrieval_score', '<', 0.5, 'warning', 10)) r(alert, metric, op, threshold, severity, minutes)),
 j AS (SELECT alert, s.metric, severity, minutes, ts, value, CASE op WHEN '>' THEN value > threshold ELSE value < threshold END AS hit FROM s JOIN rules r ON r.metric = s.metric),
 e AS (SELECT alert, metric, severity, minutes, max(ts) AS newest, max(ts) FILTER (WHERE NOT hit) AS quiet, arg_max(value, ts) AS value FROM j GROUP BY ALL),
 f AS (SELECT e.*, (SELECT min(ts) FROM j WHERE j.alert = e.alert AND hit AND ts > coalesce(quiet, TIMESTAMP '1900-01-01')) AS since FROM e)"""


@query("l08_alert_states", "L8", sql=f"""WITH {RULED} SELECT alert, metric, severity, round(value, 9) AS value, since, CASE WHEN since IS NULL THEN 'inactive' WHEN newest - since >= minutes * INTERVAL 1 MINUTE THEN 'firing' ELSE 'pending' END AS state FROM f""")
def _(t):
    windows = t.events.groupBy(F.window("ts", "5 minutes").alias("w")).agg(
        (F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))).alias("prediction_error_ratio"),
        F.count_if(F.col("event_type") == "error").cast("double").alias("failed_runs"), (F.avg("value") / 100).alias("retrieval_score"),
    )
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in ("prediction_error_ratio", "failed_runs", "retrieval_score")])
    samples = windows.select(F.col("w.start").alias("ts"), F.explode(cells).alias("c")).select("ts", "c.*")
    return m.alert_states(samples).withColumn("value", F.round("value", 9))


# --- cost ------------------------------------------------------------------

MODELS = ["gpt-4-turbo", "gpt-3.5-turbo", "claude-3-sonnet", "llama-3.1-8b"]
PRICED = f"""{QUERY_LOG}, prices AS (SELECT * FROM (VALUES (0, 0.00001::DECIMAL(18,9), 0.00003::DECIMAL(18,9)), (1, 0.0000005::DECIMAL(18,9), 0.0000015::DECIMAL(18,9)), (2, 0.000003::DECIMAL(18,9), 0.000015::DECIMAL(18,9)), (3, 0.0000001::DECIMAL(18,9), 0.0000001::DECIMAL(18,9))) p(k, pi, po))"""


@query("a08_monthly_costs", "A8", sql=f"""WITH {PRICED} SELECT tenant_id, date_trunc('month', created_at)::TIMESTAMP AS month, CAST(sum(tokens_in * pi) AS DOUBLE) AS input_cost, CAST(sum(tokens_out * po) AS DOUBLE) AS output_cost,
 CAST(sum(tokens_in * pi + tokens_out * po) AS DOUBLE) AS total_cost, count(*) AS query_count FROM query_log JOIN prices ON k = query_id % 4 GROUP BY 1, 2""")
def _(t):
    names = F.array(*[F.lit(x) for x in MODELS])
    log = query_log(t).withColumn("model", F.get(names, (F.col("query_id") % 4).cast("int")))
    return m.monthly_costs(m.query_costs(log, m.PRICES_2024), "created_at")


@query("a09_cost_model", "A9", sql=f"""WITH {QUERY_LOG}, s AS (SELECT user_id, count(*) AS q, count(*) * 20000 AS v FROM query_log GROUP BY 1),
 c AS (SELECT user_id, q * 30 AS monthly, q * 30 * (1 - 0.5) AS calls, q * 30 * (1 - 0.5) * (2000 * 0.00000059 + 500 * 0.00000079) AS llm, CASE WHEN user_id % 3 = 0 THEN v / 1000000 * 15 WHEN v <= 1000000 THEN 25.0 WHEN v <= 5000000 THEN 95.0 WHEN v <= 10000000 THEN 380.0 END AS vec FROM s),
 x AS (SELECT *, llm + vec + CASE WHEN monthly < 10000 THEN 15 ELSE 50 END + CASE WHEN monthly < 10000 THEN 5 ELSE 30 END + CASE WHEN monthly < 1000 THEN 0 ELSE 50 END AS total FROM c)
SELECT user_id, monthly AS monthly_queries, floor(calls)::BIGINT AS effective_llm_calls, round(llm, 2) AS llm_cost, round(vec, 6) AS vector_db_cost, round(total, 2) AS total_monthly_cost, round(total / monthly, 4) AS cost_per_query FROM x""")
def _(t):
    scenarios = query_log(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("queries_per_day")).select(
        "user_id", "queries_per_day", F.lit("groq-70b").alias("model"), F.lit(0.5).alias("cache_hit_rate"), F.lit(2000).alias("avg_input_tokens"),
        F.lit(500).alias("avg_output_tokens"), (F.col("queries_per_day") * 20000).alias("total_vectors"), (F.col("user_id") % 3 != 0).alias("managed"),
    )
    out = m.monthly_model(scenarios)
    return out.select("user_id", "monthly_queries", "effective_llm_calls", "llm_cost", F.round("vector_db_cost", 6).alias("vector_db_cost"), "total_monthly_cost", "cost_per_query")
