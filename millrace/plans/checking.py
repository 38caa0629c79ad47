"""Queries over data-quality suites."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import quality as q
from millrace.plans.registry import query

ROW = "{pos} AS position, '{name}' AS expectation, '{col}' AS column_name"


def row(pos, name, col, bad, rows, table):
    return (
        f"SELECT {pos} AS position, '{name}' AS expectation, '{col}' AS column_name, {bad} = 0 AS success, "
        f"CAST({bad} AS BIGINT) AS unexpected, CAST({rows} AS BIGINT) AS evaluated FROM {table}"
    )


def fails(condition):
    return f"CASE WHEN {condition} THEN 0 ELSE 1 END"


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("q01_column_exists", "Q1", sql=row(0, "expect_column_to_exist", "c_custkey", fails("count(*) > 0"), "count(*)", "customer")
       + " UNION ALL " + row(1, "expect_column_to_exist", "churn", "1", "count(*)", "customer"))
def _(t):
    return q.run_suite(t.customer, [q.column_exists("c_custkey"), q.column_exists("churn")])


@query("q02_ordered_columns", "Q2", sql=row(0, "expect_table_columns_to_match_ordered_list", "*", "0", "count(*)", "customer")
       + " UNION ALL " + row(1, "expect_table_columns_to_match_ordered_list", "*", "1", "count(*)", "customer"))
def _(t):
    return q.run_suite(t.customer, [q.columns_match(CUSTOMER_COLUMNS), q.columns_match(sorted(CUSTOMER_COLUMNS, reverse=True))])


@query("q03_not_null", "Q3", sql=row(0, "expect_column_values_to_not_be_null", "c_custkey", "count(*) - count(c_custkey)", "count(*)", "customer"))
def _(t):
    return q.run_suite(t.customer, [q.not_null("c_custkey")])


@query("q04_unique", "Q4", sql=row(0, "expect_column_values_to_be_unique", "l_orderkey", "count(l_orderkey) - count(DISTINCT l_orderkey)", "count(l_orderkey)", "lineitem")
       + " UNION ALL " + row(1, "expect_column_values_to_be_unique", "l_orderkey", "sum(CASE WHEN n > 1 THEN n ELSE 0 END)", "sum(n)", "(SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)"))
def _(t):
    return q.run_suite(t.lineitem, [q.unique("l_orderkey"), q.unique("l_orderkey", mode="members")])


@query("q05_between", "Q5", sql=row(0, "expect_column_values_to_be_between", "l_quantity", "count(*) FILTER (WHERE l_quantity < 2 OR l_quantity > 45)", "count(*)", "lineitem")
       + " UNION ALL " + row(1, "expect_column_values_to_be_between", "l_discount", "count(*) FILTER (WHERE l_discount > 0.1)", "count(*)", "lineitem"))
def _(t):
    return q.run_suite(t.lineitem, [q.between("l_quantity", 2, 45), q.between("l_discount", high=0.1)])


BLANKED = "(SELECT CASE WHEN c_nationkey <> 4 THEN c_mktsegment END AS seg FROM customer)"


@query("q06_in_set", "Q6", sql=row(0, "expect_column_values_to_be_in_set", "seg", "count(*) FILTER (WHERE seg = 'MACHINERY')", "count(*)", BLANKED)
       + " UNION ALL " + row(1, "expect_column_values_to_be_in_set", "seg", "count(*) FILTER (WHERE seg = 'MACHINERY' OR seg IS NULL)", "count(*)", BLANKED))
def _(t):
    rows = t.customer.select(F.when(F.col("c_nationkey") != 4, F.col("c_mktsegment")).alias("seg"))
    return q.run_suite(rows, [q.in_set("seg", SEGMENTS), q.in_set("seg", SEGMENTS, null_policy="reject")])


@query("q07_row_count", "Q7", sql=row(0, "expect_table_row_count_to_be_between", "*", fails("count(*) BETWEEN 1 AND 1000000000"), "count(*)", "orders")
       + " UNION ALL " + row(1, "expect_table_row_count_to_be_between", "*", fails("count(*) <= 10"), "count(*)", "orders"))
def _(t):
    return q.run_suite(t.orders, [q.row_count_between(1, 10**9), q.row_count_between(high=10)])


@query("q08_mean_between", "Q8", sql=row(0, "expect_column_mean_to_be_between", "l_quantity", fails("avg(l_quantity) BETWEEN 20 AND 30"), "count(*)", "lineitem"))
def _(t):
    return q.run_suite(t.lineitem, [q.mean_between("l_quantity", 20, 30)])


@query("q09_unique_share", "Q9", sql=row(0, "expect_column_proportion_of_unique_values_to_be_between", "o_custkey", fails("count(DISTINCT o_custkey) / count(o_custkey) BETWEEN 0.05 AND 0.2"), "count(o_custkey)", "orders"))
def _(t):
    return q.run_suite(t.orders, [q.unique_share_between("o_custkey", 0.05, 0.2)])


@query("q10_regex_match", "Q10", sql=row(0, "expect_column_values_to_match_regex", "c_name", "count(*) FILTER (WHERE NOT regexp_full_match(c_name, 'Customer#[0-9]{8}[02468]'))", "count(*)", "customer"))
def _(t):
    return q.run_suite(t.customer, [q.matches("c_name", "Customer#[0-9]{8}[02468]")])


@query("q11_typed_schema", "Q11", "K5", sql=" UNION ALL ".join([
    row(0, "expect_column_values_to_not_be_null", "c_custkey", "count(*) - count(c_custkey)", "count(*)", "customer"),
    row(1, "expect_column_values_to_be_unique", "c_custkey", "count(c_custkey) - count(DISTINCT c_custkey)", "count(c_custkey)", "customer"),
    row(2, "expect_column_values_to_not_be_null", "c_acctbal", "count(*) - count(c_acctbal)", "count(*)", "customer"),
    row(3, "greater_than", "c_acctbal", "count(*) FILTER (WHERE c_acctbal <= 0)", "count(*)", "customer"),
    row(4, "expect_column_values_to_be_in_set", "c_mktsegment", "count(*) FILTER (WHERE c_mktsegment = 'MACHINERY')", "count(*)", "customer")]))
def _(t):
    schema = q.TableSchema({
        "c_custkey": q.ColumnRule(T.LongType(), unique=True),
        "c_acctbal": q.ColumnRule(T.DoubleType(), checks=(lambda c: q.greater_than(c, 0),)),
        "c_mktsegment": q.ColumnRule(T.StringType(), nullable=True, checks=(lambda c: q.in_set(c, SEGMENTS),)),
    })
    return schema.validate(t.customer)


@query("q12_no_negatives", "Q12", sql=row(0, "no_negative_values", "c_acctbal", "count(*) FILTER (WHERE c_acctbal < 0)", "count(*)", "customer")
       + " UNION ALL " + row(1, "no_negative_values", "c_nationkey", "count(*) FILTER (WHERE c_nationkey < 0)", "count(*)", "customer"))
def _(t):
    return q.run_suite(t.customer, [q.no_negatives("c_acctbal"), q.no_negatives("c_nationkey")])


@query("q13_finite", "Q13", sql=row(0, "no_nan_or_inf", "r", "count(*) FILTER (WHERE l_discount = 0)", "count(*)", "lineitem"))
def _(t):
    broken = F.when(F.col("l_discount") == 0, F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))).otherwise(F.col("l_tax"))
    return q.run_suite(t.lineitem.select(broken.alias("r")), [q.finite("r")])


def suite():
    return [
        q.column_exists("c_custkey"), q.not_null("c_custkey"), q.unique("c_custkey"), q.between("c_acctbal", 0, 10000),
        q.in_set("c_mktsegment", SEGMENTS), q.row_count_between(1, 10**9),
    ]


SUITE = " UNION ALL ".join([
    row(0, "expect_column_to_exist", "c_custkey", fails("count(*) > 0"), "count(*)", "customer"),
    row(1, "expect_column_values_to_not_be_null", "c_custkey", "count(*) - count(c_custkey)", "count(*)", "customer"),
    row(2, "expect_column_values_to_be_unique", "c_custkey", "count(c_custkey) - count(DISTINCT c_custkey)", "count(c_custkey)", "customer"),
    row(3, "expect_column_values_to_be_between", "c_acctbal", "count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 10000)", "count(*)", "customer"),
    row(4, "expect_column_values_to_be_in_set", "c_mktsegment", "count(*) FILTER (WHERE c_mktsegment = 'MACHINERY')", "count(*)", "customer"),
    row(5, "expect_table_row_count_to_be_between", "*", fails("count(*) >= 1"), "count(*)", "customer"),
])


@query("q14_suite_summary", "Q14", sql=f"""SELECT bool_and(success) AS success, count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS successful_expectations,
 count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations FROM ({SUITE})""")
def _(t):
    return q.suite_summary(q.run_suite(t.customer, suite()))


@query("q14_suite_rows", "Q14", sql=SUITE)
def _(t):
    return q.run_suite(t.customer, suite())


@query("q15_quality_gate", "Q15", sql=f"""SELECT *, critical_failures = 0 AND success_rate >= 0.8 AS passed FROM (SELECT count(*) FILTER (WHERE NOT success AND (contains(expectation, 'not_be_null') OR contains(expectation, 'be_unique'))) AS critical_failures,
 avg(CASE WHEN success THEN 1.0 ELSE 0.0 END) AS success_rate FROM ({SUITE}))""")
def _(t):
    return q.quality_gate(q.run_suite(t.customer, suite()), ["not_be_null", "be_unique"])


@query("q16_quarantine", "Q16", sql="SELECT event_id, event_type FROM events WHERE event_type = 'error' UNION ALL SELECT NULL, 'passed:purchase' FROM (SELECT 1) WHERE (SELECT min(value) FROM events WHERE event_type = 'purchase') > 0")
def _(t):
    from millrace.session import scratch

    root = scratch(t.spark, "quarantine")
    schema = "event_id long, event_type string"
    out = None
    for kind, checks in (("error", [q.between("value", high=1)]), ("purchase", [q.between("value", low=0)])):
        batch = t.events.filter(F.col("event_type") == kind)
        if q.branch(batch, checks, root, kind):
            part = batch.agg(F.lit(f"passed:{kind}").alias("event_type")).select(F.lit(None).cast("long").alias("event_id"), "event_type")
        else:
            part = t.spark.read.schema(schema).parquet(f"{root}/quarantine/{kind}")
        out = part if out is None else out.unionByName(part)
    return out


@query("q17_count_checks", "Q17", sql=row(0, "null_check", "l_shipdate IS NULL", "count(*) FILTER (WHERE l_shipdate IS NULL)", "count(*)", "lineitem")
       + " UNION ALL " + row(1, "value_range", "l_quantity > 49", "abs(count(*) FILTER (WHERE l_quantity > 49) - 3)", "count(*)", "lineitem"))
def _(t):
    return q.run_suite(t.lineitem, [q.counts_equal("null_check", "l_shipdate IS NULL", 0), q.counts_equal("value_range", "l_quantity > 49", 3)])


@query("q18_ready_check", "Q18", sql="""SELECT rows, missing, missing / (rows * 2) AS missing_share, true AS columns_present, rows >= 100 AND missing / (rows * 2) <= 0.1 AS ready
FROM (SELECT count(*) AS rows, count(*) - count(CASE WHEN event_type <> 'error' THEN value END) AS missing FROM events)""")
def _(t):
    return q.ready(t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")), ["event_id"])


@query("q25_service_levels", "Q25", sql="""SELECT * , CASE WHEN contains(name, 'max') THEN value <= "limit" ELSE value >= "limit" END AS compliant FROM (
 SELECT 'max_duration' AS name, max(value) AS value, 300.0::DOUBLE AS "limit" FROM events UNION ALL SELECT 'valid_share', round(avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END), 9), 0.9 FROM events
 UNION ALL SELECT 'records', count(*)::DOUBLE, 100.0 FROM events)""")
def _(t):
    measured = t.events.agg(
        F.max("value").alias("max_duration"), F.round(F.avg((F.col("event_type") != "error").cast("double")), 9).alias("valid_share"),
        F.count(F.lit(1)).cast("double").alias("records"),
    )
    cells = [F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in measured.columns]
    values = measured.select(F.explode(F.array(*cells)).alias("v")).select("v.*")
    return q.service_levels(values, {"max_duration": 300, "valid_share": 0.9, "records": 100})


@query("q26_output_check", "Q26", sql="""SELECT count(*) AS rows, count(*) FILTER (WHERE c_acctbal < 0) AS negatives, CASE WHEN count(*) = 0 THEN 'no output' WHEN count(*) FILTER (WHERE c_acctbal < 0) > 0 THEN 'negative values' END AS error,
 count(*) > 0 AND count(*) FILTER (WHERE c_acctbal < 0) = 0 AS valid FROM customer""")
def _(t):
    return q.output_valid(t.customer, "c_acctbal")
