"""Queries over joins, grouped reports, windows, orderings and set computations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import ordered as o
from millrace.operators import relate as rel
from millrace.plans.registry import query
from millrace.plans.views import EVENT_AS_OF, MODEL_RUNS, QUERY_LOG, model_runs, money, query_log

def N():
    return F.count(F.lit(1))


def cents(c):
    return F.sum(money(c)).cast("double")


# --- joins -----------------------------------------------------------------


@query("j01_left_join_totals", "J1", sql="""SELECT c_custkey, CASE WHEN c_nationkey < 8 THEN 'young' WHEN c_nationkey < 16 THEN 'middle' ELSE 'senior' END AS age_group,
 count(o_orderkey) AS order_count, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_spent, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_orderkey), 8) AS avg_order
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""")
def _(t):
    users = t.customer.select(
        "c_custkey", F.when(F.col("c_nationkey") < 8, "young").when(F.col("c_nationkey") < 16, "middle").otherwise("senior").alias("age_group")
    )
    orders = t.orders.withColumn("amount", money("o_totalprice"))
    out = rel.user_order_totals(users, orders, "c_custkey", "o_custkey", "o_orderkey", "amount")
    return out.select(
        "c_custkey", "age_group", "order_count", F.round(F.col("total_spent").cast("double"), 2).alias("total_spent"),
        F.round(F.col("total_spent").cast("double") / F.when(F.col("order_count") > 0, F.col("order_count")), 8).alias("avg_order"),
    )


@query("j02_low_rated_queries", "J2", sql=f"""WITH {QUERY_LOG}, feedback AS (SELECT event_id AS query_id, event_id % 5 + 1 AS stars FROM events)
SELECT q.query_id, q.created_at, f.stars FROM query_log q JOIN feedback f ON q.query_id = f.query_id WHERE f.stars <= 2 ORDER BY q.created_at DESC, q.query_id LIMIT 20""")
def _(t):
    feedback = t.events.select(F.col("event_id").alias("query_id"), (F.col("event_id") % 5 + 1).alias("stars"))
    joined = query_log(t).join(feedback, "query_id").filter(F.col("stars") <= 2)
    return joined.orderBy(F.col("created_at").desc(), "query_id").limit(20).select("query_id", "created_at", "stars")


@query("j05_skip_known_content", "J5", sql="""WITH h AS (SELECT doc_id, lang, sha256(trim(regexp_replace(lower(text), '[\\s]+', ' ', 'g'))) AS digest FROM documents)
SELECT min(doc_id) AS doc_id, digest FROM h WHERE lang <> 'fr' AND digest NOT IN (SELECT digest FROM h WHERE lang = 'fr') GROUP BY digest""")
def _(t):
    from millrace.functions.text import content_hash

    hashed = t.documents.select("doc_id", "lang", content_hash(F.col("text")).alias("digest"))
    return rel.unseen_by_hash(hashed.filter("lang <> 'fr'"), hashed.filter("lang = 'fr'"), "digest", "doc_id").select("doc_id", "digest")


@query("j06_erasure_cascade", "J6", sql="""WITH gone AS (SELECT c_custkey FROM customer WHERE c_nationkey = 3), go AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT * FROM gone))
SELECT 'customer' AS table_name, count(*) AS before_rows, count(*) FILTER (WHERE c_nationkey <> 3) AS after_rows FROM customer
UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE o_orderkey NOT IN (SELECT * FROM go)) FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (WHERE l_orderkey NOT IN (SELECT * FROM go)) FROM lineitem""")
def _(t):
    gone = t.customer.filter(F.col("c_nationkey") == 3).select("c_custkey")
    gone_orders = t.orders.join(gone, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    left = {
        **rel.erase_cascade(gone_orders, "o_orderkey", {"lineitem": (t.lineitem, "l_orderkey"), "orders": (t.orders, "o_orderkey")}),
        **rel.erase_cascade(gone, "c_custkey", {"customer": (t.customer, "c_custkey")}),
    }
    rows = None
    for name, kept in left.items():
        before = getattr(t, name).agg(N().alias("n")).scalar()
        row = kept.agg(N().alias("after_rows")).select(F.lit(name).alias("table_name"), before.alias("before_rows"), "after_rows")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query("j07_acl_join", "J7", sql="""WITH p AS (SELECT DISTINCT user_id, unnest(['user:' || user_id, 'group:' || (user_id % 5), 'role:' || (user_id % 3)]) AS who FROM events),
 g AS (SELECT doc_id, unnest(['user:' || (doc_id % 97), 'group:' || (doc_id % 11), 'role:' || (doc_id % 17)]) AS who FROM documents)
SELECT user_id, count(DISTINCT doc_id) AS visible FROM p JOIN g ON p.who = g.who GROUP BY 1""")
def _(t):
    who = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"))
    u, d = F.col("user_id"), F.col("doc_id")
    principals = t.events.select("user_id").distinct().select(
        "user_id", F.explode(F.array(who("user", u), who("group", u % 5), who("role", u % 3))).alias("p")
    ).select("user_id", "p.*")
    grants = t.documents.select(
        "doc_id", F.explode(F.array(who("user", d % 97), who("group", d % 11), who("role", d % 17))).alias("p")
    ).select("doc_id", "p.*")
    return rel.visible_counts(t.documents.select("doc_id"), "doc_id", grants, principals)


@query("j07_visible_to_a_user", "J7", sql="""SELECT doc_id, lang FROM documents WHERE doc_id % 97 = 7 OR doc_id % 11 = 7 % 5 OR doc_id % 17 = 7 % 3""")
def _(t):
    """The rows that one requesting user, with their group and role, may see."""
    who = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"))
    d = F.col("doc_id")
    grants = t.documents.select("doc_id", F.explode(F.array(who("user", d % 97), who("group", d % 11), who("role", d % 17))).alias("p")).select("doc_id", "p.*")
    asking = t.spark.createDataFrame([(7, "user", "7"), (7, "group", "2"), (7, "role", "1")], "user_id long, kind string, name string")
    return rel.visible_rows(t.documents.select("doc_id", "lang"), "doc_id", grants, asking).select("doc_id", "lang")


@query("j08_full_outer_compare", "J8", sql="""WITH b AS (SELECT p_brand AS brand, count(*) / sum(count(*)) OVER () AS s FROM part WHERE p_size <= 25 GROUP BY 1),
 c AS (SELECT p_brand AS brand, count(*) / sum(count(*)) OVER () AS s FROM part WHERE p_size > 25 GROUP BY 1)
SELECT coalesce(b.brand, c.brand) AS brand, round(coalesce(b.s, 0), 9) AS baseline, round(coalesce(c.s, 0), 9) AS "current" FROM b FULL JOIN c ON b.brand = c.brand""")
def _(t):
    share = lambda d: rel.share_of_classes(d.withColumnRenamed("p_brand", "brand"), [], "brand")
    out = rel.full_compare(share(t.part.filter("p_size <= 25")), share(t.part.filter("p_size > 25")), "brand", "share")
    return out.select("brand", F.round("baseline", 9).alias("baseline"), F.round("current", 9).alias("current"))


@query("j10_model_pairs", "J10", sql="""WITH m AS (SELECT p_brand AS model, avg(p_retailprice) AS score, count(*) AS n FROM part GROUP BY 1)
SELECT a.model AS model_a, b.model AS model_b, round(b.score - a.score, 6) AS gain FROM m a JOIN m b ON a.model < b.model""")
def _(t):
    models = t.part.groupBy(F.col("p_brand").alias("model")).agg(F.avg("p_retailprice").alias("score"), N().alias("n"))
    pairs = rel.unordered_pairs(models, "model")
    return pairs.select(
        F.col("a.model").alias("model_a"), F.col("b.model").alias("model_b"), F.round(F.col("b.score") - F.col("a.score"), 6).alias("gain")
    )


# --- aggregations ----------------------------------------------------------


@query("a01_group_totals", "A1", sql="""SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS avg_value, sum(l_quantity) AS total_value, count(*) AS count
FROM lineitem GROUP BY 1, 2 ORDER BY total_value DESC""")
def _(t):
    out = rel.group_mean_sum_count(t.lineitem, ["l_returnflag", "l_linestatus"], "l_quantity")
    return out.withColumn("avg_value", F.round("avg_value", 6)).orderBy(F.col("total_value").desc())


@query("a02_group_deviation", "A2", sql="""SELECT p_type AS model, p_brand AS team, round(avg(p_size), 6) AS mean, round(stddev_samp(p_size), 6) AS std, count(*) AS count
FROM part GROUP BY 1, 2""")
def _(t):
    out = rel.group_mean_std_count(t.part.select(F.col("p_type").alias("model"), F.col("p_brand").alias("team"), "p_size"), ["model", "team"], "p_size")
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("a03_summary_report", "A3", sql=f"""WITH {MODEL_RUNS} SELECT model, count(*) AS total_runs, max(accuracy) AS best, round(avg(accuracy), 6) AS mean,
 arg_min(team, {{'m': -accuracy, 'k': run_id}}) AS best_team FROM runs GROUP BY 1""")
def _(t):
    runs = model_runs(t).withColumn("accuracy", F.col("metrics")["accuracy"])
    return runs.groupBy("model").agg(
        N().alias("total_runs"), F.max("accuracy").alias("best"), F.round(F.avg("accuracy"), 6).alias("mean"),
        rel.best_attribute("accuracy", "run_id", "team").alias("best_team"),
    )


@query("a04_tenant_statistics", "A4", sql=f"""WITH {QUERY_LOG} SELECT tenant_id, count(*) AS total, round(coalesce(avg(latency_ms), 0), 6) AS avg_ms, coalesce(sum(tokens_in + tokens_out), 0)::BIGINT AS tokens
FROM query_log WHERE created_at >= TIMESTAMP '{EVENT_AS_OF}' - INTERVAL 20 DAY GROUP BY 1""")
def _(t):
    log = query_log(t).filter(F.col("created_at") >= F.lit(EVENT_AS_OF).cast("timestamp") - F.expr("interval 20 days"))
    return log.groupBy("tenant_id").agg(
        N().alias("total"), F.round(F.coalesce(F.avg("latency_ms"), F.lit(0.0)), 6).alias("avg_ms"),
        F.coalesce(F.sum(F.col("tokens_in") + F.col("tokens_out")), F.lit(0).cast("long")).alias("tokens"),
    )


@query("a05_failing_queries", "A5", sql=f"""WITH {QUERY_LOG} SELECT topic, count(*) AS failures FROM query_log
WHERE latency_ms IS NULL AND created_at > TIMESTAMP '{EVENT_AS_OF}' - INTERVAL 240 HOUR GROUP BY 1 ORDER BY failures DESC, topic""")
def _(t):
    late = F.col("created_at") > F.lit(EVENT_AS_OF).cast("timestamp") - F.expr("interval 240 hours")
    return query_log(t).filter(late & F.col("latency_ms").isNull()).groupBy("topic").agg(N().alias("failures")).orderBy(F.col("failures").desc(), "topic")


@query("a06_cost_per_tenant", "A6", sql=f"""WITH {QUERY_LOG} SELECT tenant_id, CAST(sum(tokens_in * CAST(0.0000001 AS DECIMAL(18,9)) + tokens_out * CAST(0.0000001 AS DECIMAL(18,9))) AS DOUBLE) AS cost
FROM query_log WHERE created_at > date_trunc('month', TIMESTAMP '{EVENT_AS_OF}') GROUP BY 1 ORDER BY cost DESC""")
def _(t):
    price = F.lit("0.0000001").cast("decimal(18,9)")
    log = query_log(t).filter(F.col("created_at") > F.date_trunc("month", F.lit(EVENT_AS_OF).cast("timestamp")))
    cost = F.sum(F.col("tokens_in") * price + F.col("tokens_out") * price).cast("double")
    return log.groupBy("tenant_id").agg(cost.alias("cost")).orderBy(F.col("cost").desc())


@query("a07_oldest_source", "A7", sql="SELECT event_type AS source, max(ts) AS newest FROM events GROUP BY 1 ORDER BY newest")
def _(t):
    return t.events.groupBy(F.col("event_type").alias("source")).agg(F.max("ts").alias("newest")).orderBy("newest")


@query("a10_variant_results", "A10", sql="""WITH v AS (SELECT unnest(['control', 'fast', 'wide', 'unused']) AS variant),
 m AS (SELECT ['control', 'fast', 'wide'][(user_id % 3 + 1)::INT] AS variant, event_type AS metric, value FROM events),
 r AS (SELECT variant, metric, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM m GROUP BY 1, 2),
 s AS (SELECT variant, count(*) AS sample_size FROM m GROUP BY 1)
SELECT v.variant, metric, coalesce(n, 0) AS n, mean, low, high, coalesce(sample_size, 0) AS sample_size FROM v LEFT JOIN r ON r.variant = v.variant LEFT JOIN s ON s.variant = v.variant""")
def _(t):
    from millrace.operators.evaluate import variant_results

    names = F.array(*[F.lit(x) for x in ("control", "fast", "wide")])
    rows = t.events.select(
        F.get(names, (F.col("user_id") % 3).cast("int")).alias("variant"), F.col("event_type").alias("metric"), "value"
    )
    return variant_results(rows, ["control", "fast", "wide", "unused"]).withColumn("mean", F.round("mean", 6))


@query("a11_events_by_type", "A11", sql="""SELECT coalesce(CASE WHEN event_type <> 'signup' THEN event_type END, 'unknown') AS event_type, count(*) AS count FROM events GROUP BY 1""")
def _(t):
    from millrace.streaming.jobs import count_by_type

    return count_by_type(t.events.withColumn("event_type", F.when(F.col("event_type") != "signup", F.col("event_type"))))


@query("a12_success_rollup", "A12", sql="""SELECT count(*) AS total_sources, count(*) FILTER (WHERE ok) AS successful, sum(n)::BIGINT AS total_records FROM (
 SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') * 4 < count(*) AS ok FROM events GROUP BY 1)""")
def _(t):
    sources = t.events.groupBy("user_id").agg(N().alias("n"), (F.count_if(F.col("event_type") == "error") * 4 < N()).alias("ok"))
    return sources.agg(N().alias("total_sources"), F.count_if("ok").alias("successful"), F.sum("n").alias("total_records"))


@query("a13_latency_ranks", "A13", sql="""SELECT event_type, count(*) AS n, list_sort(list(value))[(floor(count(*) * 0.5) + 1)::INT] AS p50,
 CASE WHEN count(*) >= 20 THEN list_sort(list(value))[(floor(count(*) * 0.95) + 1)::INT] END AS p95,
 CASE WHEN count(*) >= 100 THEN list_sort(list(value))[(floor(count(*) * 0.99) + 1)::INT] END AS p99 FROM events GROUP BY 1""")
def _(t):
    out = o.value_at_rank(t.events.select("event_type", "value"), ["event_type"], "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return out.select(
        "event_type", "n", "p50", F.when(F.col("n") >= 20, F.col("p95")).alias("p95"), F.when(F.col("n") >= 100, F.col("p99")).alias("p99")
    )


@query("a14_class_ratio", "A14", sql="""SELECT l_returnflag AS label, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 9) AS share,
 max(count(*)) OVER () / sum(count(*)) OVER () <= 0.8 AS balanced FROM lineitem GROUP BY 1""")
def _(t):
    shares = rel.share_of_classes(t.lineitem.select(F.col("l_returnflag").alias("label")), [], "label")
    top = shares.agg(F.max("share").alias("m")).scalar()
    return shares.withColumn("balanced", top <= 0.8).withColumn("share", F.round("share", 9))


@query("a15_describe", "A15", sql=" UNION ALL ".join(f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
 quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in ("l_quantity", "l_extendedprice", "l_discount")))
def _(t):
    out = rel.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query("a16_missing_rates", "A16", sql=f"""WITH {QUERY_LOG}, c AS (SELECT count(*) AS n, count(*) - count(latency_ms) AS a, count(*) - count(topic) AS b, count(*) - count(user_id) AS d FROM query_log)
SELECT 'latency_ms' AS column_name, a AS missing, n AS cells, round(a / n, 9) AS missing_rate FROM c UNION ALL SELECT 'topic', b, n, round(b / n, 9) FROM c
UNION ALL SELECT 'user_id', d, n, round(d / n, 9) FROM c UNION ALL SELECT '*', a + b + d, n * 3, round((a + b + d) / (n * 3), 9) FROM c""")
def _(t):
    out = rel.missing_rates(query_log(t), ["latency_ms", "topic", "user_id"])
    return out.withColumn("missing_rate", F.round("missing_rate", 9))


@query("a17_documents_per_tenant", "A17", sql="SELECT source AS tenant_id, count(doc_id) AS documents FROM documents GROUP BY 1")
def _(t):
    return t.documents.groupBy(F.col("source").alias("tenant_id")).agg(F.count("doc_id").alias("documents"))


@query("a18_deletion_report", "A18", "O5", sql=f"""WITH {MODEL_RUNS}, c AS (SELECT 'failed' AS reason FROM runs WHERE status <> 'FINISHED' UNION ALL SELECT 'old' FROM runs WHERE started < TIMESTAMP '2024-01-01' - INTERVAL 90 DAY
 UNION ALL SELECT 'low_performance' FROM runs WHERE accuracy < 0.3 UNION ALL SELECT 'untagged' FROM runs WHERE reviewed IS NULL)
SELECT 'run' AS "type", reason, count(*) AS size FROM c GROUP BY 1, 2""")
def _(t):
    runs = model_runs(t).withColumn("accuracy", F.col("metrics")["accuracy"])
    listed = rel.retention_candidates(runs, "run_id", "status", "started", "2024-01-01", 90, "accuracy", 0.3, "tags", "reviewed")
    return listed.groupBy(F.lit("run").alias("type"), "reason").agg(N().alias("size"))


@query("a19_review_queue", "A19", sql=f"""WITH {QUERY_LOG} SELECT date_trunc('day', created_at) AS day, round(avg(rating), 6) AS avg_rating, count(*) FILTER (WHERE rating <= 2) AS queued FROM query_log GROUP BY 1""")
def _(t):
    log = query_log(t).filter(F.col("rating").between(1, 5))
    return log.groupBy(F.date_trunc("day", "created_at").alias("day")).agg(
        F.round(F.avg("rating"), 6).alias("avg_rating"), F.count_if(F.col("rating") <= 2).alias("queued")
    )


@query("a20_inferred_contract", "A20", sql="""SELECT * FROM (SELECT 0 AS position, 'user_id' AS name, 'bigint' AS "type", count(*) = count(user_id) AS required FROM events
UNION ALL SELECT 1, 'event_type', 'string', count(*) = count(event_type) FROM events
UNION ALL SELECT 2, 'latency', 'double', count(*) = count(CASE WHEN event_type <> 'error' THEN value END) FROM events)""")
def _(t):
    rows = t.events.select("user_id", "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("latency"))
    return rel.infer_contract(rows)


# --- windows ---------------------------------------------------------------


@query("w01_rolling_mean", "W1", sql="""SELECT event_id, CASE WHEN count(*) OVER w = 7 THEN round(avg(value) OVER w, 6) END AS rolling_mean FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 6 PRECEDING)""")
def _(t):
    out = rel.rolling_mean(t.events.select("user_id", "ts", "event_id", "value"), ["user_id"], "ts", "event_id", "value")
    return out.select("event_id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query("w02_average_rank", "W2", sql="""SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2 AS rank FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return o.average_rank(rows, ["l_returnflag"], "l_extendedprice").select("l_orderkey", "l_linenumber", "rank")


@query("w03_trailing_totals", "W3", sql="""SELECT event_id, count(*) OVER w7 AS count_7d, round(sum(value) OVER w7, 4) AS sum_7d, round(avg(value) OVER w7, 9) AS avg_7d,
 count(*) OVER w30 AS count_30d, round(sum(value) OVER w30, 4) AS sum_30d, max(value) OVER w30 AS max_30d FROM (SELECT *, floor(epoch(ts)) AS s FROM events)
WINDOW w7 AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW)""")
def _(t):
    rows = t.events.select("event_id", "user_id", "value", F.unix_seconds("ts").alias("s"))
    out = o.trailing_range(rows, "user_id", "s", "value", {"7d": 7 * 86400, "30d": 30 * 86400})
    return out.select(
        "event_id", "count_7d", F.round("sum_7d", 4).alias("sum_7d"), F.round(F.col("sum_7d") / F.col("count_7d"), 9).alias("avg_7d"),
        "count_30d", F.round("sum_30d", 4).alias("sum_30d"), "max_30d",
    )


PREDICTIONS = """predictions AS (SELECT event_id, ts, 'model' || (user_id % 4) AS model, CASE WHEN value > 50 THEN 1 ELSE 0 END AS predicted,
 CASE WHEN event_type <> 'view' THEN CASE WHEN value + event_id % 7 > 52 THEN 1 ELSE 0 END END AS actual FROM events)"""


def predictions(t):
    """``events`` as a prediction log; views have no actual outcome yet."""
    return t.events.select(
        "event_id", "ts", F.concat(F.lit("model"), F.col("user_id") % 4).alias("model"),
        F.when(F.col("value") > 50, 1).otherwise(0).alias("predicted"),
        F.when(F.col("event_type") != "view", F.when(F.col("value") + F.col("event_id") % 7 > 52, 1).otherwise(0)).alias("actual"),
    )


@query("w04_recent_accuracy", "W4", sql=f"""WITH {PREDICTIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC, event_id DESC) AS rn FROM predictions WHERE actual IS NOT NULL)
SELECT model, count(*) AS feedback, CASE WHEN count(*) >= 100 THEN round(avg(CASE WHEN predicted = actual THEN 1.0 ELSE 0.0 END), 9) END AS accuracy FROM r WHERE rn <= 100 GROUP BY 1""")
def _(t):
    out = rel.recent_accuracy(predictions(t), ["model"], [F.col("ts").desc(), F.col("event_id").desc()], "predicted", "actual", 100)
    return out.withColumn("accuracy", F.round("accuracy", 9))


@query("w05_recent_distribution", "W5", sql=f"""WITH {PREDICTIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC, event_id DESC) AS rn FROM predictions)
SELECT model, predicted, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY model), 9) AS share FROM r WHERE rn <= 100 GROUP BY 1, 2""")
def _(t):
    rows = rel.last_n(predictions(t), ["model"], [F.col("ts").desc(), F.col("event_id").desc()], 100)
    return rel.share_of_classes(rows, ["model"], "predicted").withColumn("share", F.round("share", 9))


@query("w06_superseded_versions", "W6", sql="""SELECT name, version, stage FROM (SELECT p_type AS name, p_partkey AS version, CASE WHEN p_size = 50 THEN 'Production' ELSE 'None' END AS stage,
 row_number() OVER (PARTITION BY p_type ORDER BY p_partkey DESC) AS rn FROM part) WHERE rn > 5 AND stage <> 'Production'""")
def _(t):
    versions = t.part.select(
        F.col("p_type").alias("name"), F.col("p_partkey").alias("version"), F.when(F.col("p_size") == 50, "Production").otherwise("None").alias("stage")
    )
    return rel.superseded_versions(versions, "name", "version", "stage", 5).select("name", "version", "stage")


@query("w11_best_row_per_id", "W11", sql="""WITH b AS (SELECT l_suppkey AS query, l_partkey AS id, max(l_extendedprice) AS score FROM lineitem GROUP BY 1, 2)
SELECT query, id, score FROM b QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, id) <= 5""")
def _(t):
    hits = t.lineitem.select(F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("id"), F.col("l_extendedprice").alias("score"))
    return rel.best_per_id(hits, "query", "id", "score", 5)


# --- order and limit -------------------------------------------------------


@query("o01_top_runs", "O1", sql=f"WITH {MODEL_RUNS} SELECT run_id, accuracy FROM runs ORDER BY accuracy DESC, run_id LIMIT 3")
def _(t):
    runs = model_runs(t).select("run_id", F.col("metrics")["accuracy"].alias("accuracy"))
    return runs.orderBy(F.col("accuracy").desc(), "run_id").limit(3)


@query("o02_most_recent", "O2", sql="SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 10")
def _(t):
    return t.events.select("event_id", "ts").orderBy(F.col("ts").desc(), "event_id").limit(10)


@query("o03_gate_then_best", "O3", sql=f"""WITH {MODEL_RUNS} SELECT team, run_id, accuracy, accuracy >= 0.9 AND cv_std <= 0.05 AS qualified FROM runs
QUALIFY row_number() OVER (PARTITION BY team ORDER BY accuracy >= 0.9 AND cv_std <= 0.05 DESC, accuracy DESC, run_id) = 1""")
def _(t):
    runs = model_runs(t).select("team", "run_id", F.col("metrics")["accuracy"].alias("accuracy"), F.col("metrics")["cv_std"].alias("cv_std"))
    gate = (F.col("accuracy") >= 0.9) & (F.col("cv_std") <= 0.05)
    return rel.best_qualified(runs, ["team"], gate, "accuracy", "run_id").select("team", "run_id", "accuracy", "qualified")


@query("o04_tag_best_runs", "O4", sql=f"""WITH {MODEL_RUNS}, best AS (SELECT run_id FROM runs WHERE accuracy > 0.95 ORDER BY accuracy DESC, run_id LIMIT 10)
SELECT run_id, CASE WHEN run_id IN (SELECT * FROM best) THEN 'true' ELSE reviewed END AS reviewed, CASE WHEN run_id IN (SELECT * FROM best) THEN '2024-01-01' END AS review_date FROM runs""")
def _(t):
    runs = model_runs(t).withColumn("accuracy", F.col("metrics")["accuracy"])
    tagged = rel.tag_best(runs, "run_id", "accuracy", 0.95, 10, "tags", {"reviewed": "true", "review_date": "2024-01-01"})
    return tagged.select("run_id", F.col("tags")["reviewed"].alias("reviewed"), F.col("tags")["review_date"].alias("review_date"))


@query("o05_retention_candidates", "O5", sql=f"""WITH {MODEL_RUNS} SELECT run_id, 'failed' AS reason FROM runs WHERE status <> 'FINISHED' UNION ALL SELECT run_id, 'old' FROM runs WHERE started < TIMESTAMP '2024-01-01' - INTERVAL 90 DAY
 UNION ALL SELECT run_id, 'low_performance' FROM runs WHERE accuracy < 0.3 UNION ALL SELECT run_id, 'untagged' FROM runs WHERE reviewed IS NULL""")
def _(t):
    runs = model_runs(t).withColumn("accuracy", F.col("metrics")["accuracy"])
    return rel.retention_candidates(runs, "run_id", "status", "started", "2024-01-01", 90, "accuracy", 0.3, "tags", "reviewed")


# --- set computations ------------------------------------------------------


@query("u01_category_difference", "U1", sql="""WITH b AS (SELECT DISTINCT p_name, p_brand, p_type FROM part WHERE p_size <= 25), c AS (SELECT DISTINCT p_name, p_brand, p_type FROM part WHERE p_size > 25)
SELECT 'new' AS side, * FROM (SELECT * FROM c EXCEPT SELECT * FROM b) UNION ALL SELECT 'missing', * FROM (SELECT * FROM b EXCEPT SELECT * FROM c)""")
def _(t):
    base, current = t.part.filter("p_size <= 25").select("p_name", "p_brand", "p_type"), t.part.filter("p_size > 25").select("p_name", "p_brand", "p_type")
    return current.subtract(base).select(F.lit("new").alias("side"), "*").unionByName(
        base.subtract(current).select(F.lit("missing").alias("side"), "*")
    )


@query("u02_set_hits", "U2", sql="""SELECT conv_id, turn, len(list_intersect(list_distinct(string_split(text, ' ')), ['the', 'and', 'la', 'der', 'el'])) AS hits FROM conversations""")
def _(t):
    wanted = F.array(*[F.lit(w) for w in ("the", "and", "la", "der", "el")])
    hits = F.size(F.array_intersect(F.array_distinct(F.split("text", " ")), wanted)).cast("long")
    return t.conversations.select("conv_id", "turn", hits.alias("hits"))


@query("u03_union_first_per_id", "U3", sql="""WITH u AS (SELECT 1 AS list, l_suppkey AS query, l_partkey AS id, min(l_orderkey) AS pos FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2, 3
 UNION ALL SELECT 2, l_suppkey, l_partkey, min(l_orderkey) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3
 UNION ALL SELECT 3, l_suppkey, l_partkey, min(l_orderkey) FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2, 3),
 f AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY query, id ORDER BY list, pos) = 1)
SELECT query, id, list FROM f QUALIFY row_number() OVER (PARTITION BY query ORDER BY list, pos, id) <= 5""")
def _(t):
    def hits(flag: str, number: int):
        rows = t.lineitem.filter(F.col("l_returnflag") == flag)
        return rows.groupBy(F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("id")).agg(F.min("l_orderkey").alias("pos")).withColumn("list", F.lit(number))

    merged = hits("A", 1).unionByName(hits("R", 2)).unionByName(hits("N", 3))
    return rel.first_per_id(merged, "query", "id", ["list", "pos", "id"], 5).select("query", "id", "list")
