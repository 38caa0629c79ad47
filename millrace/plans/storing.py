"""Queries over sources, sinks, snapshots, staging, versions and feature state."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import content_hash
from millrace.operators import features as fs
from millrace.plans.registry import query
from millrace.plans.views import CUSTOMER_ACTIVITY, customer_activity
from millrace.session import scratch
from millrace.sources import files, tables

ORDERS_DDL = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@query("s01_table_extract", "S1", sql=f"WITH {CUSTOMER_ACTIVITY} SELECT customer_id, c_mktsegment AS segment, total_purchases, tickets FROM activity")
def _(t):
    source = customer_activity(t).withColumnRenamed("c_mktsegment", "segment")
    return tables.extract(source, ["customer_id", "segment", "total_purchases", "tickets"], scratch(t.spark, "extract"))


@query("s02_parquet_round_trip", "S2", sql="SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1")
def _(t):
    path = scratch(t.spark, "orders")
    t.orders.write.mode("overwrite").parquet(path)
    back = t.spark.read.schema(ORDERS_DDL).parquet(path)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("s03_csv_load", "S3", sql="SELECT count(*) AS rows, 5 AS columns FROM customer")
def _(t):
    path = scratch(t.spark, "csv")
    tables.write_csv(t.customer, path)
    return tables.load_csv(t.spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", scratch(t.spark, "parquet"))


@query("s03_csv_rows", "S3", sql="SELECT * FROM customer")
def _(t):
    path = scratch(t.spark, "csv")
    tables.write_csv(t.customer, path)
    return tables.read_csv(t.spark, path, t.customer.schema)


@query("s04_s05_latest_snapshot", "S4", "S5", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    root = scratch(t.spark, "snapshots")
    for status, ts in (("F", "20240101_000000"), ("P", "20240301_120000"), ("O", "20240201_060000")):
        tables.publish_snapshot(t.orders.filter(F.col("o_orderstatus") == status), root, ts)
    return tables.latest_snapshot(t.spark, root, ORDERS_DDL).select("o_orderkey", "o_totalprice")


@query("s06_interval_extract", "S6", sql="SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01'")
def _(t):
    return tables.interval_extract(t.orders, "o_orderdate", "1998-03-01", "1998-04-01").select("o_orderkey", "o_orderdate")


@query("s07_day_listing", "S7", sql="SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows FROM events GROUP BY 1")
def _(t):
    return tables.list_days(t.events, "ts")


@query("s07_day_extract", "S7", sql="SELECT event_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def _(t):
    return tables.day_extract(t.events, "ts", "2024-01-15", "event_id").select("event_id", "value")


def _staged(t):
    root = scratch(t.spark, "staging")
    ddl = "event_id long, value decimal(10,2), created_at timestamp"
    early = F.col("event_type").isin("click", "error", "signup")
    for batch, day, rows in (("b1", "2024-01-01", early), ("b2", "2024-01-09", ~early)):
        tables.stage(t.events.filter(rows).select("event_id", "value"), root, batch, day, "value")
    return root, ddl


@query("s08_staged_append", "S8", sql="""SELECT CASE WHEN event_type IN ('click', 'error', 'signup') THEN 'b1' ELSE 'b2' END AS batch_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def _(t):
    root, ddl = _staged(t)
    return tables.read_staging(t.spark, root, ddl).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total"))


@query("s09_staging_retention", "S9", sql="SELECT 'b2' AS batch_id, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'error', 'signup')")
def _(t):
    root, ddl = _staged(t)
    kept = tables.clean_staging(t.spark, root, ddl, "b1", "2024-01-10", scratch(t.spark, "staging"))
    return kept.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("s10_corpus_load", "S10", sql=r"""SELECT 'source=' || source AS folder, 'txt' AS type, sum(length(regexp_replace(text, '[\r\n]+', ' ', 'g')) + 1)::BIGINT AS chars, true AS ids_agree FROM documents GROUP BY 1""")
def _(t):
    """Documents written as text files and read back as a corpus."""
    root = scratch(t.spark, "corpus")
    lines = t.documents.select(F.regexp_replace("text", "[\r\n]+", " ").alias("value"), "source")
    lines.write.partitionBy("source").option("lineSep", "\n").text(root)
    corpus = files.load_corpus(t.spark, root)
    return corpus.groupBy(F.regexp_extract("source", r"([^/]+)/[^/]+$", 1).alias("folder"), "type").agg(
        F.sum(F.length("content")).alias("chars"), F.bool_and(F.length("id") == 12).alias("ids_agree")
    )


@query("s11_changed_since", "S11", sql="SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-29 12:00:00'")
def _(t):
    return tables.changed_since(t.events, "ts", "2024-01-29 12:00:00").select("event_id", "ts")


@query("s12_changed_documents", "S12", sql="""SELECT doc_id, sha256(trim(regexp_replace(lower(text), '[\\s]+', ' ', 'g'))) AS digest FROM documents WHERE lang = 'fr' OR n_chars > 3000""")
def _(t):
    now = t.documents.select("doc_id", content_hash(F.col("text")).alias("digest"), F.lit("2024-02-01").cast("timestamp").alias("modified"), "lang", "n_chars")
    known = now.filter("lang <> 'fr'").withColumn("modified", F.when(F.col("n_chars") > 3000, F.lit("2024-01-01")).otherwise(F.lit("2024-02-01")).cast("timestamp"))
    return files.needs_processing(now, known, "doc_id", "digest", "modified").select("doc_id", "digest")


@query("s13_version_manifest", "S13", sql="SELECT 'v1' AS version, count(*) AS rows FROM customer UNION ALL SELECT 'v2', count(*) FROM customer WHERE c_nationkey <> 5")
def _(t):
    root = scratch(t.spark, "versions")
    tables.register_version(t.customer, root, "v1")
    tables.register_version(t.customer.filter("c_nationkey <> 5"), root, "v2")
    return tables.manifest(t.spark, root).select("version", "rows")


@query("s14_version_diff", "S14", sql="""SELECT c_custkey, CASE WHEN c_nationkey = 5 THEN 'removed' ELSE 'removed' END AS change, c_acctbal FROM customer WHERE c_nationkey IN (5, 6)
UNION ALL SELECT c_custkey, 'added', c_acctbal + 1 FROM customer WHERE c_nationkey = 6""")
def _(t):
    root = scratch(t.spark, "versions")
    tables.register_version(t.customer, root, "v1")
    changed = t.customer.filter("c_nationkey <> 5").withColumn("c_acctbal", F.when(F.col("c_nationkey") == 6, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    tables.register_version(changed, root, "v2")
    diff = tables.diff_versions(tables.read_version(t.spark, root, "v1"), tables.read_version(t.spark, root, "v2"))
    return diff.select("c_custkey", "change", "c_acctbal")


@query("s15_source_merge", "S15", sql="SELECT 'customer' AS source, count(*) AS total, count(*) AS with_nation FROM customer UNION ALL SELECT 'supplier', count(*), count(*) FROM supplier UNION ALL SELECT 'part', count(*), 0 FROM part")
def _(t):
    merged = tables.merge_sources({
        "customer": t.customer.select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation")),
        "supplier": t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation")),
        "part": t.part.select(F.col("p_partkey").alias("key")),
    })
    return merged.groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count("nation").alias("with_nation"))


@query("s16_result_audit", "S16", sql="""SELECT 'r1' AS run_id, 'null_check' AS expectation, true AS success, true AS gate_passed FROM customer HAVING count(*) > 0
UNION ALL SELECT 'r2', 'null_check', count(*) = 0, count(*) = 0 FROM events WHERE event_type = 'error'""")
def _(t):
    from millrace.operators import quality as q

    root = scratch(t.spark, "results")
    errors = t.events.select(F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    runs = {"r1": q.run_suite(t.customer, [q.counts_equal("null_check", "c_custkey IS NULL", 0)]), "r2": q.run_suite(errors, [q.counts_equal("null_check", "value IS NULL", 0)])}
    for run_id, results in runs.items():
        tables.append_results(results, root, run_id, "2024-01-01", F.col("success"))
    schema = "position long, expectation string, column_name string, success boolean, unexpected long, evaluated long"
    return tables.read_results(t.spark, root, schema).select("run_id", "expectation", "success", "gate_passed")


@query("s17_user_export", "S17", sql="SELECT 'events' AS table_name, count(*) AS n FROM events WHERE user_id = 8 UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey = 8 UNION ALL SELECT 'customer', 1 FROM customer WHERE c_custkey = 8")
def _(t):
    lines = tables.export_user({"customer": (t.customer, "c_custkey"), "orders": (t.orders, "o_custkey"), "events": (t.events, "user_id")}, 8)
    return lines.filter(F.length("row_json") > 2).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))


# --- features --------------------------------------------------------------

VIEW = fs.FeatureView("activity", "user_id", "ts", ("value", "event_type"), ttl_seconds=86400)


@query("j03_point_in_time", "J3", "F4", sql="""SELECT e.event_id, CASE WHEN e.ts - f.ts <= INTERVAL 1 DAY THEN f.value END AS activity__value, CASE WHEN e.ts - f.ts <= INTERVAL 1 DAY THEN f.event_type END AS activity__event_type,
 o.o_totalprice AS orders__o_totalprice FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') f ON e.user_id = f.user_id AND e.ts >= f.ts
 LEFT JOIN (SELECT o_custkey, arg_max(o_totalprice, {'d': o_orderdate, 'k': o_orderkey}) AS o_totalprice FROM orders GROUP BY 1) o ON o.o_custkey = e.user_id""")
def _(t):
    entities = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    history = t.events.filter("event_type <> 'purchase'")
    # The order key stands for the created time: the larger key was stored later.
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), "o_orderdate", F.timestamp_micros("o_orderkey").alias("created"), "o_totalprice")
    order_view = fs.FeatureView("orders", "user_id", "o_orderdate", ("o_totalprice",), created_ts="created")
    out = fs.historical_features(entities, "ts", [(VIEW, history), (order_view, orders)])
    return out.select("event_id", "activity__value", "activity__event_type", "orders__o_totalprice")


@query("j04_online_lookup", "J4", "F4", sql="""SELECT conv_id * 1000 + turn AS position, (conv_id * 8 + turn) % 200 AS user_id, CASE WHEN TIMESTAMP '2024-01-31' - ts <= INTERVAL 1 DAY THEN value END AS value,
 CASE WHEN TIMESTAMP '2024-01-31' - ts <= INTERVAL 1 DAY THEN event_type END AS event_type FROM conversations LEFT JOIN (SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type FROM events GROUP BY 1) e ON e.user_id = (conv_id * 8 + turn) % 200""")
def _(t):
    requests = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("position"), ((F.col("conv_id") * 8 + F.col("turn")) % 200).alias("user_id"))
    root = scratch(t.spark, "online")
    fs.push(t.events, VIEW, root, 0)
    return fs.online_features(requests, fs.serving_state(t.spark, VIEW, root, t.events), VIEW, F.lit("2024-01-31").cast("timestamp"))


@query("j09_on_demand", "J9", sql=f"""WITH {CUSTOMER_ACTIVITY} SELECT customer_id, round(c_acctbal / (total_spend + 1), 9) AS balance_to_spend, CASE WHEN total_purchases / 10 > 0.8 THEN 1 ELSE 0 END AS is_loyal FROM activity""")
def _(t):
    requests = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("balance"))
    stored = customer_activity(t).select("customer_id", "total_spend", (F.col("total_purchases") / 10).alias("loyalty"))
    out = fs.on_demand(requests, stored, "customer_id", {
        "balance_to_spend": F.round(fs.CUSTOMER_DERIVED["balance_to_spend"](F.col("balance"), F.col("total_spend")), 9),
        "is_loyal": fs.CUSTOMER_DERIVED["is_loyal"](F.col("loyalty")),
    })
    return out.select("customer_id", "balance_to_spend", "is_loyal")


@query("f01_materialise", "F1", sql="""SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20' GROUP BY 1""")
def _(t):
    return fs.materialise(t.events, VIEW, "2024-01-10", "2024-01-20")


@query("f02_materialise_incremental", "F2", sql="""SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type FROM events WHERE ts >= TIMESTAMP '2024-01-09' AND ts <= TIMESTAMP '2024-01-25' GROUP BY 1""")
def _(t):
    root = scratch(t.spark, "online")
    end = fs.materialise_incremental(t.events, VIEW, root, 0, None, "2024-01-10")
    fs.materialise_incremental(t.events, VIEW, root, 1, end, "2024-01-25")
    return fs.serving_table(t.spark, VIEW, root, t.events)


@query("f03_push", "F3", sql="""SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type FROM events GROUP BY 1""")
def _(t):
    root = scratch(t.spark, "online")
    for batch, kind in enumerate(("view", "click", "purchase", "error", "signup")):
        fs.push(t.events.filter(F.col("event_type") == kind), VIEW, root, batch)
    online = fs.serving_state(t.spark, VIEW, root, t.events)
    online.merge(everything=True)
    return online.current()
