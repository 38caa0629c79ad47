"""Working views of the given tables that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import Tables

AS_OF = "2001-12-31 00:00:00"
EVENT_AS_OF = "2024-01-31 00:00:00"


def money(column: str):
    """Exact cents, so that sums do not depend on the partitioning."""
    return F.col(column).cast("decimal(18,2)")


def query_log(t: Tables) -> DataFrame:
    """``events`` read as a query log: tenant, text, latency (NULL for failures), tokens and cost."""
    failed = F.col("event_type") == "error"
    return t.events.select(
        F.col("event_id").alias("query_id"),
        (F.col("user_id") % 10).alias("tenant_id"),
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("topic"),
        F.when(~failed, F.col("value")).alias("latency_ms"),
        F.floor(F.col("value") * 10).cast("long").alias("tokens_in"),
        F.floor(F.col("value")).cast("long").alias("tokens_out"),
        F.col("ts").alias("created_at"),
        (F.pmod("event_id", F.lit(5)) + 1).cast("long").alias("rating"),
    )


QUERY_LOG = """query_log AS (
  SELECT event_id AS query_id, user_id % 10 AS tenant_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS topic,
         CASE WHEN event_type <> 'error' THEN value END AS latency_ms,
         CAST(floor(value * 10) AS BIGINT) AS tokens_in, CAST(floor(value) AS BIGINT) AS tokens_out,
         ts AS created_at, event_id % 5 + 1 AS rating
  FROM events)"""


def model_runs(t: Tables) -> DataFrame:
    """``part`` read as model runs: type is the model, brand the team, the price a metric in 0..1."""
    return t.part.select(
        F.col("p_partkey").alias("run_id"),
        F.col("p_type").alias("model"),
        F.col("p_brand").alias("team"),
        F.create_map(F.lit("n_estimators"), F.col("p_size").cast("string"), F.lit("model_type"), F.lower("p_type")).alias("params"),
        F.create_map(
            F.lit("accuracy"), F.round((F.col("p_retailprice") % 100) / 100, 6), F.lit("cv_std"), F.round(F.col("p_size") / 500, 6)
        ).alias("metrics"),
        F.when(F.col("p_size") > 40, F.create_map(F.lit("team"), F.col("p_brand"), F.lit("reviewed"), F.lit("false")))
        .otherwise(F.create_map(F.lit("team"), F.col("p_brand")))
        .alias("tags"),
        F.when(F.col("p_name").startswith("red"), "FAILED").otherwise("FINISHED").alias("status"),
        (F.lit("2024-01-01").cast("timestamp") - F.make_dt_interval(days=F.col("p_size") * 5)).alias("started"),
    )


MODEL_RUNS = """runs AS (
  SELECT p_partkey AS run_id, p_type AS model, p_brand AS team, CAST(p_size AS VARCHAR) AS n_estimators,
         round((p_retailprice % 100) / 100, 6) AS accuracy, round(p_size / 500.0, 6) AS cv_std, p_size,
         CASE WHEN p_size > 40 THEN 'false' END AS reviewed,
         CASE WHEN p_name LIKE 'red%' THEN 'FAILED' ELSE 'FINISHED' END AS status,
         TIMESTAMP '2024-01-01' - INTERVAL (p_size * 5) DAY AS started
  FROM part)"""


def customer_activity(t: Tables) -> DataFrame:
    """One row per customer: order totals, tenure and recency in days, support tickets."""
    orders = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("purchases"),
        F.sum(money("o_totalprice")).alias("spend"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
    )
    tickets = t.events.filter(F.col("event_type") == "error").groupBy("user_id").agg(F.count(F.lit(1)).alias("tickets"))
    as_of = F.lit(AS_OF).cast("timestamp")
    return (
        t.customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(tickets, F.col("c_custkey") == F.col("user_id"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            "c_mktsegment",
            "c_acctbal",
            F.coalesce("purchases", F.lit(0).cast("long")).alias("total_purchases"),
            F.coalesce(F.col("spend").cast("double"), F.lit(0.0)).alias("total_spend"),
            F.datediff(as_of, "first_order").cast("long").alias("tenure_days"),
            F.datediff(as_of, "last_order").cast("long").alias("days_since_last"),
            F.coalesce("tickets", F.lit(0).cast("long")).alias("tickets"),
        )
    )


CUSTOMER_ACTIVITY = f"""activity AS (
  SELECT c_custkey AS customer_id, c_mktsegment, c_acctbal, coalesce(purchases, 0) AS total_purchases,
         coalesce(spend, 0.0) AS total_spend, date_diff('day', first_order, TIMESTAMP '{AS_OF}') AS tenure_days,
         date_diff('day', last_order, TIMESTAMP '{AS_OF}') AS days_since_last, coalesce(tickets, 0) AS tickets
  FROM customer
  LEFT JOIN (SELECT o_custkey, count(*) AS purchases, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend,
                    min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY 1)
    ON c_custkey = o_custkey
  LEFT JOIN (SELECT user_id, count(*) AS tickets FROM events WHERE event_type = 'error' GROUP BY 1)
    ON c_custkey = user_id)"""
