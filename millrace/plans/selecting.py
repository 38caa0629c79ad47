"""Queries over projections, filters, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import select as sel
from millrace.operators.runfilter import run_filter
from millrace.plans.registry import query
from millrace.plans.views import AS_OF, CUSTOMER_ACTIVITY, MODEL_RUNS, QUERY_LOG, customer_activity, model_runs, query_log


@query("p01_predicate_filter", "P1", sql="SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 25")
def _(t):
    return t.lineitem.filter(F.col("l_quantity") > 25).select("l_orderkey", "l_linenumber", "l_quantity")


@query("p02_ratio_features", "P2", sql=f"""WITH {CUSTOMER_ACTIVITY}
SELECT customer_id, round(total_purchases / (tenure_days + 1.0), 9) AS purchase_frequency,
       round(tickets / (total_purchases + 1.0), 9) AS support_ratio, round(1 / (days_since_last + 1.0), 9) AS recency_score
FROM activity""")
def _(t):
    out = sel.ratio_features(customer_activity(t), "total_purchases", "tenure_days", "tickets", "days_since_last")
    return out.select("customer_id", *[F.round(c, 9).alias(c) for c in ("purchase_frequency", "support_ratio", "recency_score")])


@query("p03_event_stamp", "P3", sql=f"SELECT c_custkey, TIMESTAMP '{AS_OF}' AS event_timestamp FROM customer")
def _(t):
    return sel.stamp(t.customer.select("c_custkey"), AS_OF)


@query("p04_scalar_transform", "P4", sql="SELECT p_partkey, upper(p_name) AS name, round(p_retailprice * 1.1, 4) AS price_up, p_retailprice * 2 AS price_twice FROM part")
def _(t):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("name"),
        F.round(F.col("p_retailprice") * 1.1, 4).alias("price_up"), (F.col("p_retailprice") * 2).alias("price_twice"),
    )


@query("p05_age_group", "P5", sql="""SELECT p_partkey, p_size, CASE WHEN p_size < 25 THEN 'young' WHEN p_size < 40 THEN 'middle' ELSE 'senior' END AS age_group
FROM part WHERE p_partkey IS NOT NULL""")
def _(t):
    return t.part.filter(F.col("p_partkey").isNotNull()).select("p_partkey", "p_size", sel.age_group(F.col("p_size")).alias("age_group"))


@query("p06_right_closed_bins", "P6", sql="""SELECT l_orderkey, l_linenumber, l_discount * 10 AS p,
 CASE WHEN l_discount * 10 > 0 AND l_discount * 10 <= 0.3 THEN 'low' WHEN l_discount * 10 > 0.3 AND l_discount * 10 <= 0.7 THEN 'medium'
      WHEN l_discount * 10 > 0.7 AND l_discount * 10 <= 1.0 THEN 'high' END AS band FROM lineitem""")
def _(t):
    p = F.col("l_discount") * 10
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", p.alias("p"), sel.right_closed_bins(p, [0.0, 0.3, 0.7, 1.0], ["low", "medium", "high"]).alias("band")
    )


@query("p07_risk_level", "P7", sql="""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity / 50 > 0.7 THEN 'High' WHEN l_quantity / 50 > 0.4 THEN 'Medium' ELSE 'Low' END AS risk
FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", sel.risk_level(F.col("l_quantity") / 50).alias("risk"))


@query("p08_drop_nulls_and_repeats", "P8", sql="""SELECT DISTINCT tenant_id, topic, floor(latency_ms) AS latency FROM (
WITH %s SELECT * FROM query_log) WHERE tenant_id IS NOT NULL AND topic IS NOT NULL AND latency_ms IS NOT NULL""" % QUERY_LOG)
def _(t):
    rows = query_log(t).select("tenant_id", "topic", F.floor("latency_ms").cast("double").alias("latency"))
    return sel.drop_incomplete_and_repeated(rows)


@query("p09_exact_sample", "P9", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 1000")
def _(t):
    return sel.exact_sample(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 1000)


@query("p10_hash_split", "P10", sql="""SELECT split, count(*) AS n, sum(c_custkey)::BIGINT AS key_sum FROM (SELECT c_custkey,
 CASE WHEN ('0x' || substr(md5(c_custkey || ':42'), 1, 8))::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END AS split FROM customer) GROUP BY 1""")
def _(t):
    parts = sel.split_by_hash(t.customer.select("c_custkey"), "c_custkey")
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("key_sum"))


@query("p11_stratified_split", "P11", sql="""SELECT l_returnflag, split, count(*) AS n, sum(k)::BIGINT AS key_sum FROM (
 SELECT l_returnflag, k, CASE WHEN row_number() OVER (PARTITION BY l_returnflag ORDER BY draw, k) <= round(count(*) OVER (PARTITION BY l_returnflag) * 0.2)
   THEN 'test' ELSE 'train' END AS split
 FROM (SELECT o_orderstatus AS l_returnflag, o_orderkey AS k, ('0x' || substr(md5(o_orderkey || ':42'), 1, 12))::BIGINT AS draw FROM orders)) GROUP BY 1, 2""")
def _(t):
    rows = t.orders.select(F.col("o_orderstatus").alias("l_returnflag"), F.col("o_orderkey").alias("k"))
    parts = sel.stratified_split(rows, "k", "l_returnflag")
    return parts.groupBy("l_returnflag", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("key_sum"))


@query("p12_metadata_filter", "P12", sql="SELECT doc_id, lang, source FROM documents WHERE source = 'src3' AND lang = 'en'")
def _(t):
    return sel.matching(t.documents, source="src3", lang="en", doc_id=None).select("doc_id", "lang", "source")


@query("p13_question_check", "P13", sql="""SELECT conv_id, turn, length(q) AS size,
 CASE WHEN length(q) < 3 THEN 'Question too short' WHEN length(q) > 1000 THEN 'Question too long' END AS error,
 length(q) BETWEEN 3 AND 1000 AS is_valid FROM (SELECT conv_id, turn, trim(text) AS q FROM conversations)""")
def _(t):
    checked = sel.validate_question(t.conversations, "text")
    return checked.select("conv_id", "turn", F.length("question").cast("long").alias("size"), "error", "is_valid")


@query("p14_tenant_page", "P14", sql=f"""WITH {QUERY_LOG} SELECT query_id, created_at, rating FROM query_log
WHERE tenant_id = 3 AND rating = 2 ORDER BY created_at DESC, query_id LIMIT 20 OFFSET 20""")
def _(t):
    log = query_log(t).withColumn("status", F.col("rating").cast("string"))
    paged = sel.page(log, F.col("tenant_id"), 3, F.col("status"), "2", "created_at", "query_id", 20, 20)
    return paged.select("query_id", "created_at", "rating")


@query("p15_tenant_scope", "P15", sql=f"WITH {QUERY_LOG} SELECT query_id, topic FROM query_log WHERE tenant_id = 7")
def _(t):
    return sel.TenantScope("tenant_id", 7).read(query_log(t)).select("query_id", "topic")


@query("p16_status_update", "P16", sql="""WITH latest AS (SELECT l_orderkey AS k, count(*) AS chunk_count, min(l_linestatus) AS s FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN s = 'F' THEN 'completed' WHEN s IS NOT NULL THEN 'failed' ELSE o_orderstatus END AS status,
 chunk_count, CASE WHEN s = 'O' THEN 'open lines' END AS error,
 CASE WHEN s = 'F' THEN TIMESTAMP '2002-01-01' END AS processed_at FROM orders LEFT JOIN latest ON k = o_orderkey""")
def _(t):
    state = t.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.lit(None).cast("long").alias("chunk_count"),
        F.lit(None).cast("string").alias("error"), F.lit(None).cast("timestamp").alias("processed_at"),
    )
    updates = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("chunk_count"), F.min("l_linestatus").alias("s")
    )
    updates = updates.select(
        "o_orderkey", F.when(F.col("s") == "F", "completed").otherwise("failed").alias("status"), "chunk_count",
        F.when(F.col("s") == "O", "open lines").alias("error"),
    )
    return sel.apply_status_updates(state, updates, "o_orderkey", "2002-01-01")


@query("p17_parameter_grid", "P17", sql="SELECT p_partkey, m AS multiplier, p_size * m AS scaled FROM part, (VALUES (1), (2), (10)) v(m)")
def _(t):
    grid = sel.expand_by(t.part.select("p_partkey", "p_size"), "multiplier", [1, 2, 10])
    return grid.select("p_partkey", "multiplier", (F.col("p_size") * F.col("multiplier")).alias("scaled"))


@query("p18_positional_zip", "P18", sql="""SELECT conv_id, turn, pos AS position, w AS word, m AS mark FROM (SELECT conv_id, turn, generate_subscripts(ws, 1) - 1 AS pos, unnest(ws) AS w, unnest(ms) AS m
FROM (SELECT conv_id, turn, string_split(text, ' ') AS ws, list_transform(string_split(text, ' '), lambda x: '<' || x || '>') AS ms FROM conversations))""")
def _(t):
    pairs = t.conversations.select("conv_id", "turn", F.split("text", " ").alias("w"), F.transform(F.split("text", " "), lambda x: F.concat(F.lit("<"), x, F.lit(">"))).alias("m"))
    return sel.zip_positions(pairs, "w", "m").select(
        "conv_id", "turn", F.col("position").cast("long").alias("position"), F.col("w_item").alias("word"), F.col("m_item").alias("mark")
    )


@query("p19_threshold_route", "P19", sql="""SELECT route, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
 SELECT *, CASE WHEN o_totalprice >= 250000 THEN 'high' ELSE 'low' END AS route FROM orders) GROUP BY 1""")
def _(t):
    routed = sel.route_by_threshold(t.orders, "o_totalprice", 250000)
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("p20_alert_route", "P20", sql="""WITH a AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'prod_' || event_type ELSE 'dev_' || event_type END AS wf,
 CASE WHEN event_type = 'purchase' THEN 'critical_step' ELSE 'step' END AS task, event_id % 4 + 1 AS tries,
 CASE WHEN value < 50 THEN ['misc', 'analytics', 'ml-platform'] WHEN value < 100 THEN ['ml-platform'] ELSE ['misc'] END AS tags FROM events),
 r AS (SELECT event_id, CASE WHEN wf LIKE 'prod%' AND tries > 2 THEN 'P1' WHEN wf LIKE 'prod%' OR task LIKE '%critical%' THEN 'P2' WHEN tries > 1 THEN 'P3' ELSE 'P4' END AS severity,
 coalesce(list_filter(tags, lambda x: x IN ('data-engineering', 'ml-platform', 'analytics'))[1], 'data-engineering') AS team FROM a)
SELECT event_id, severity, team, CASE team WHEN 'ml-platform' THEN '#ml-alerts' WHEN 'analytics' THEN '#analytics-alerts' ELSE '#data-eng-alerts' END AS slack_channel,
 CASE team WHEN 'ml-platform' THEN 'ml-team@example.com' WHEN 'analytics' THEN 'analytics@example.com' ELSE 'data-eng@example.com' END AS email, team AS service, unnest(CASE severity WHEN 'P1' THEN ['pagerduty', 'slack_incidents', 'email_leadership']
 WHEN 'P2' THEN ['slack_alerts', 'email_team'] WHEN 'P3' THEN ['slack_alerts'] ELSE ['log'] END) AS channel FROM r""")
def _(t):
    lits = lambda *x: F.array(*[F.lit(v) for v in x])
    alerts = t.events.select(
        "event_id",
        F.concat(F.when(F.col("user_id") % 3 == 0, "prod_").otherwise("dev_"), "event_type").alias("wf"),
        F.when(F.col("event_type") == "purchase", "critical_step").otherwise("step").alias("task"),
        (F.col("event_id") % 4 + 1).alias("tries"),
        F.when(F.col("value") < 50, lits("misc", "analytics", "ml-platform")).when(F.col("value") < 100, lits("ml-platform")).otherwise(lits("misc")).alias("tags"),
    )
    return sel.route_alerts(alerts, "wf", "task", "tries", "tags").select("event_id", "severity", "team", "slack_channel", "email", "service", "channel")


@query("p21_chunk_metadata", "P21", sql="""SELECT conv_id, turn AS chunk_index, count(*) OVER (PARTITION BY conv_id) AS total_chunks, length(text) AS char_count,
 len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS word_count FROM conversations""")
def _(t):
    out = sel.chunk_metadata(t.conversations, "conv_id", "turn", "text", AS_OF)
    return out.select("conv_id", "chunk_index", "total_chunks", "char_count", "word_count")


# The kinds of filter that runs are asked for, with names and values of the runs here.
RUN_FILTERS = {
    "params.n_estimators = '10'": "n_estimators = '10'",
    "metrics.accuracy > 0.95": "accuracy > 0.95",
    "tags.team = 'Brand#1'": "team = 'Brand#1'",
    "tags.reviewed = 'false'": "reviewed = 'false'",
    "params.n_estimators = '45' AND metrics.accuracy > 0.90": "n_estimators = '45' AND accuracy > 0.90",
    "tags.team LIKE 'Brand#1%'": "team LIKE 'Brand#1%'",
    "params.model_type LIKE '%brass%'": "lower(model) LIKE '%brass%'",
    "tags.team IN ('Brand#1', 'Brand#23')": "team IN ('Brand#1', 'Brand#23')",
    "params.n_estimators > 40.5 AND metrics.cv_std <= 0.09": "n_estimators::DOUBLE > 40.5 AND cv_std <= 0.09",
    "attributes.status = 'FINISHED' AND metrics.accuracy >= 0.5 AND metrics.cv_std < 0.05 OR attributes.status != 'FINISHED'": "status = 'FINISHED' AND accuracy >= 0.5 AND cv_std < 0.05 OR status <> 'FINISHED'",
    "metrics.loss < 0.1": "false",
}


@query("p22_run_filter", "P22", sql=f"WITH {MODEL_RUNS} " + " UNION ALL ".join(f"SELECT {i} AS filter, run_id, accuracy FROM runs WHERE {c}" for i, c in enumerate(RUN_FILTERS.values())))
def _(t):
    runs = model_runs(t)
    fits = F.array(*[F.when(run_filter(text), F.lit(i)) for i, text in enumerate(RUN_FILTERS)])
    return runs.select(F.explode(F.array_compact(fits)).alias("filter"), "run_id", F.col("metrics")["accuracy"].alias("accuracy"))
