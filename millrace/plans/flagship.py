"""The flagship question: does the customer table pass its quality suite, and how active were the
customers that pass over the last 7 and 30 days?"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.operators.ordered import trailing_range
from millrace.plans.registry import query

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def suite():
    return [
        q.not_null("c_custkey"), q.unique("c_custkey"), q.between("c_acctbal", -1000, 10000), q.in_set("c_mktsegment", SEGMENTS),
        q.row_count_between(1, 10**12),
    ]


@query("flagship_customer_activity", "S2", "Q14", "Q15", "W3", "A1", sql="""WITH ok AS (SELECT *, c_custkey IS NOT NULL AS has_key, NOT coalesce(c_acctbal < -1000 OR c_acctbal > 10000, false) AS fits, coalesce(c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'), true) AS known FROM customer),
 gate AS (SELECT bool_and(has_key AND fits AND known) AND count(c_custkey) = count(DISTINCT c_custkey) AND count(*) BETWEEN 1 AND 1000000000000 AS passed FROM ok),
 e AS (SELECT c_mktsegment AS segment, event_id, count(*) OVER w7 AS c7, sum(value) OVER w7 AS s7, count(*) OVER w30 AS c30, max(value) OVER w30 AS m30 FROM (SELECT *, floor(epoch(ts)) AS s FROM events) JOIN ok ON c_custkey = user_id
  WHERE has_key AND fits AND known
  WINDOW w7 AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW))
SELECT segment, passed AS table_passed, count(*) AS events, round(avg(c7), 6) AS avg_count_7d, round(avg(s7), 6) AS avg_sum_7d, round(avg(c30), 6) AS avg_count_30d, max(m30) AS max_30d FROM e, gate WHERE passed GROUP BY 1, 2 ORDER BY events DESC, segment""")
def flagship(t):
    """Rows come from the suite's own row checks, and only a table that passes its gate gives any."""
    gate = q.quality_gate(q.run_suite(t.customer, suite()), ["not_be_null", "be_unique"], floor=1.0).select("passed").scalar()
    passing = t.customer.filter(q.passing_rows(suite())).filter(gate).select("c_custkey", F.col("c_mktsegment").alias("segment"))
    events = t.events.select("event_id", "user_id", "value", F.unix_seconds("ts").alias("s"))
    rows = events.join(passing, F.col("user_id") == F.col("c_custkey"))
    active = trailing_range(rows.drop("c_custkey"), "user_id", "s", "value", {"7d": 7 * 86400, "30d": 30 * 86400})
    out = active.groupBy("segment").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.avg("count_7d"), 6).alias("avg_count_7d"), F.round(F.avg("sum_7d"), 6).alias("avg_sum_7d"),
        F.round(F.avg("count_30d"), 6).alias("avg_count_30d"), F.max("max_30d").alias("max_30d"),
    )
    return out.withColumn("table_passed", gate).orderBy(F.col("events").desc(), "segment")
