"""Queries over profiles and drift. ``lineitem`` is split by ship date; one column is made to move."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import drift as d
from millrace.operators import relate as rel
from millrace.plans.registry import query
from millrace.plans.relating import PREDICTIONS, predictions

CUT = "1999-01-01"
COLUMNS = ["l_quantity", "l_extendedprice", "moved", "spread"]


def lines(t):
    """``moved`` grows and ``spread`` widens with the years."""
    year = F.year("l_shipdate")
    return t.lineitem.select(
        "l_shipdate", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice",
        (F.col("l_quantity") + (year - 1995) * 4).alias("moved"),
        (F.col("l_discount") * (year - 1990)).alias("spread"),
        F.concat(F.lit("y"), F.greatest(year, F.lit(1998)).cast("string")).alias("era"),
    )


def halves(t):
    """The lines before and after the cut."""
    rows, cut = lines(t), F.lit(CUT).cast("timestamp")
    return rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut)


HALVES = f"""lines AS (SELECT l_shipdate, l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_quantity + (year(l_shipdate) - 1995) * 4 AS moved, l_discount * (year(l_shipdate) - 1990) AS spread,
  'y' || greatest(year(l_shipdate), 1998) AS era, CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 'b' ELSE 'c' END AS side FROM lineitem),
 cells AS (SELECT side, unnest(['l_quantity', 'l_extendedprice', 'moved', 'spread']) AS column_name, unnest([l_quantity, l_extendedprice, moved, spread]) AS value FROM lines)"""

PROFILE = f"""{HALVES}, profile AS (SELECT side, column_name, count(value) AS count, count(*) - count(value) AS null_count, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std, min(value) AS min, max(value) AS max,
  (list_sort(list(value))[floor((count(value) - 1) / 2)::INT + 1] + list_sort(list(value))[floor(count(value) / 2)::INT + 1]) / 2 AS median,
  list_sort(list(value))[floor(count(value) * 0.25)::INT + 1] AS p25, list_sort(list(value))[floor(count(value) * 0.75)::INT + 1] AS p75 FROM cells GROUP BY 1, 2)"""


@query("d01_numeric_profile", "D1", sql=f"WITH {PROFILE.replace('SELECT side, column_name, count(value)', 'SELECT column_name, count(value)').replace('FROM cells GROUP BY 1, 2)', 'FROM cells GROUP BY 1)')} SELECT *, NULL::VARCHAR AS error FROM profile")
def _(t):
    return d.numeric_profile(lines(t), COLUMNS)


TOPS = """tops AS (SELECT side, column_name, value, n, n / sum(n) OVER (PARTITION BY side, column_name) AS share FROM (
  SELECT side, column_name, value, count(*) AS n FROM (SELECT side, unnest(['l_returnflag', 'l_linestatus', 'era']) AS column_name, unnest([l_returnflag, l_linestatus, era]) AS value FROM lines) GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY side, column_name ORDER BY count(*) DESC, value) <= 5))"""
TEXT_COLUMNS = ["l_returnflag", "l_linestatus", "era"]
SHARES = TOPS.replace("tops AS", "shares AS").replace("\n  QUALIFY row_number() OVER (PARTITION BY side, column_name ORDER BY count(*) DESC, value) <= 5", "")


@query("d02_categorical_profile", "D2", sql=f"""WITH {HALVES} SELECT column_name, count(value) AS count, count(*) - count(value) AS null_count, count(DISTINCT value) AS unique_count
FROM (SELECT side, unnest(['l_returnflag', 'l_linestatus', 'era']) AS column_name, unnest([l_returnflag, l_linestatus, era]) AS value FROM lines) GROUP BY 1""")
def _(t):
    return d.categorical_profile(lines(t), TEXT_COLUMNS)


@query("d02_top_values", "D2", sql=f"WITH {HALVES}, {TOPS.replace('SELECT side,', 'SELECT').replace('BY side, column_name', 'BY column_name').replace('GROUP BY 1, 2, 3', 'GROUP BY 1, 2')} SELECT column_name, value, n, round(share, 9) AS share FROM tops")
def _(t):
    return d.top_values(lines(t), TEXT_COLUMNS).withColumn("share", F.round("share", 9))


@query("d03_numeric_drift", "D3", sql=f"""WITH {PROFILE}, m AS (SELECT side, column_name, unnest(['mean', 'std', 'min', 'max']) AS metric, unnest([mean, std, min, max]) AS v FROM profile),
 p AS (SELECT b.column_name, b.metric, b.v AS baseline, c.v AS "current", CASE WHEN b.v <> 0 THEN abs(c.v - b.v) / abs(b.v) ELSE abs(c.v) END AS change FROM m b JOIN m c ON b.column_name = c.column_name AND b.metric = c.metric AND b.side = 'b' AND c.side = 'c')
SELECT column_name, metric, baseline, "current", round(change * 100, 2) AS change_pct, change > 0.2 AS drift FROM p""")
def _(t):
    base, current = halves(t)
    return d.numeric_drift(d.numeric_profile(base, COLUMNS), d.numeric_profile(current, COLUMNS))


@query("d04_categorical_drift", "D4", sql=f"""WITH {HALVES}, {SHARES}, j AS (SELECT coalesce(b.column_name, c.column_name) AS column_name, coalesce(b.share, 0) AS b, coalesce(c.share, 0) AS c
 FROM (SELECT * FROM shares WHERE side = 'b') b FULL JOIN (SELECT * FROM shares WHERE side = 'c') c ON b.column_name = c.column_name AND b.value = c.value)
SELECT column_name, max(round(abs(c - b) * 100, 2)) AS max_shift, count(*) FILTER (WHERE b = 0) AS new_categories, count(*) FILTER (WHERE c = 0) AS missing_categories,
 max(round(abs(c - b) * 100, 2)) > 10 OR count(*) FILTER (WHERE b = 0 OR c = 0) > 0 AS drift FROM j GROUP BY 1""")
def _(t):
    base, current = halves(t)
    return d.categorical_drift(d.category_shares(base, TEXT_COLUMNS), d.category_shares(current, TEXT_COLUMNS))


PSI = f"""{HALVES}, edges AS (SELECT column_name, unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM cells WHERE side = 'b' GROUP BY 1),
 edge_list AS (SELECT column_name, list(e) AS es FROM edges GROUP BY 1),
 placed AS (SELECT side, c.column_name, len(list_filter(es, lambda x: x <= value)) AS bucket, count(*) AS n FROM cells c JOIN edge_list l ON c.column_name = l.column_name GROUP BY ALL),
 spine AS (SELECT column_name, unnest(range(10)) AS bucket FROM edge_list),
 shares AS (SELECT s.column_name, (coalesce(b.n, 0) + 0.0001) / sum(coalesce(b.n, 0)) OVER (PARTITION BY s.column_name) AS b, (coalesce(c.n, 0) + 0.0001) / sum(coalesce(c.n, 0)) OVER (PARTITION BY s.column_name) AS c
   FROM spine s LEFT JOIN placed b ON b.side = 'b' AND b.column_name = s.column_name AND b.bucket = s.bucket LEFT JOIN placed c ON c.side = 'c' AND c.column_name = s.column_name AND c.bucket = s.bucket),
 psi AS (SELECT column_name, sum((c - b) * ln(c / b)) AS psi FROM shares GROUP BY 1)"""
SEVERITY = "CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'low' WHEN psi < 0.3 THEN 'medium' WHEN psi < 0.5 THEN 'high' ELSE 'critical' END"


@query("d05_stability_index", "D5", sql=f"WITH {PSI} SELECT column_name, round(psi, 6) AS psi FROM psi")
def _(t):
    return d.stability_index(*halves(t), COLUMNS).withColumn("psi", F.round("psi", 6))


KS = """steps AS (SELECT column_name, value, count(*) FILTER (WHERE side = 'b') AS b, count(*) FILTER (WHERE side = 'c') AS c FROM cells GROUP BY 1, 2),
 cums AS (SELECT column_name, sum(b) OVER w / sum(b) OVER p AS fb, sum(c) OVER w / sum(c) OVER p AS fc, sum(b) OVER p AS n, sum(c) OVER p AS m FROM steps WINDOW w AS (PARTITION BY column_name ORDER BY value), p AS (PARTITION BY column_name)),
 gaps AS (SELECT column_name, max(abs(fb - fc)) AS statistic, max(n)::BIGINT AS n, max(m)::BIGINT AS m FROM cums GROUP BY 1),
 ks AS (SELECT column_name, statistic, n, m, statistic * sqrt(n::DOUBLE * m / (n + m)) AS x FROM gaps)"""
P_VALUE = "CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * x * x))))) END"


@query("d06_two_sample_distance", "D6", sql=f"WITH {HALVES}, {KS} SELECT column_name, round(statistic, 9) AS statistic, n, m, round({P_VALUE}, 6) AS p_value FROM ks")
def _(t):
    out = d.two_sample_distance(*halves(t), COLUMNS)
    return out.withColumns({"statistic": F.round("statistic", 9), "p_value": F.round("p_value", 6)})


@query("d07_severity", "D7", sql=f"WITH {PSI} SELECT column_name, {SEVERITY} AS severity FROM psi")
def _(t):
    return d.stability_index(*halves(t), COLUMNS).select("column_name", d.severity(F.col("psi")).alias("severity"))


@query("d07_worst_severity", "D7", sql=f"WITH {PSI} SELECT arg_max({SEVERITY}, psi) AS worst FROM psi")
def _(t):
    bands = d.stability_index(*halves(t), COLUMNS).select(d.severity(F.col("psi")).alias("severity"))
    return bands.agg(F.max_by("severity", d.severity_rank(F.col("severity"))).alias("worst"))


@query("d08_drift_share", "D8", sql=f"""WITH {HALVES}, {KS}, p AS (SELECT {P_VALUE} AS p FROM ks) SELECT count(*) AS "columns", count(*) FILTER (WHERE p < 0.05) AS drifted, avg(CASE WHEN p < 0.05 THEN 1.0 ELSE 0.0 END) AS share,
 avg(CASE WHEN p < 0.05 THEN 1.0 ELSE 0.0 END) > 0.3 AS act FROM p""")
def _(t):
    return d.drift_share(d.two_sample_distance(*halves(t), COLUMNS))


RECENT = f"""{PREDICTIONS}, acc AS (SELECT model, avg(CASE WHEN predicted = actual THEN 1.0 ELSE 0.0 END) AS accuracy FROM (SELECT * FROM predictions WHERE actual IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY ts DESC, event_id DESC) <= 100) GROUP BY 1 HAVING count(*) >= 100),
 dist AS (SELECT model, max(n) / sum(n) AS share FROM (SELECT model, predicted, count(*) AS n FROM (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY model ORDER BY ts DESC, event_id DESC) <= 100) GROUP BY 1, 2) GROUP BY 1)"""


def recent(t):
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    accuracy = rel.recent_accuracy(predictions(t), ["model"], order, "predicted", "actual", 100)
    shares = rel.share_of_classes(rel.last_n(predictions(t), ["model"], order, 100), ["model"], "predicted")
    return accuracy, shares


@query("d09_alert_list", "D9", sql=f"""WITH {PSI}, {RECENT} SELECT 'DATA_DRIFT' AS "type", {SEVERITY} AS severity, column_name AS subject, printf('High drift detected in %s (PSI=%.3f)', column_name, psi) AS message FROM psi WHERE psi >= 0.3
UNION ALL SELECT 'PERFORMANCE_DEGRADATION', 'high', model, 'Model accuracy dropped below threshold' FROM acc WHERE 0.98 - accuracy > 0.05
UNION ALL SELECT 'PREDICTION_SKEW', 'medium', model, printf('Predictions heavily skewed to one class (%.1f%%)', share * 100) FROM dist WHERE share > 0.8""")
def _(t):
    accuracy, shares = recent(t)
    return d.drift_alerts(d.drift_report(*halves(t), COLUMNS), d.degradation(accuracy, 0.98), shares)


@query("d10_degradation", "D10", sql=f"""WITH {RECENT} SELECT model, round(coalesce(0.98 - accuracy, 0.0), 9) AS degradation, coalesce(0.98 - accuracy, 0.0) > 0.05 AS degraded
FROM (SELECT DISTINCT model FROM predictions WHERE actual IS NOT NULL) LEFT JOIN acc USING (model)""")
def _(t):
    return d.degradation(recent(t)[0], 0.98).select("model", F.round("degradation", 9).alias("degradation"), "degraded")


@query("d11_retrain_decision", "D11", sql=f"""WITH {PSI}, {RECENT}, f AS (SELECT (SELECT count(*) FROM psi WHERE psi >= 0.5) AS c, (SELECT count(*) FROM psi WHERE psi >= 0.3) AS h, (SELECT count(*) FROM acc WHERE 0.98 - accuracy > 0.05) AS slow,
 date_diff('day', min(ts), TIMESTAMP '2024-02-15') AS age FROM events),
 r AS (SELECT list_filter([CASE WHEN c > 0 THEN 'Critical drift detected' END, CASE WHEN h >= 2 THEN printf('Multiple features (%d) showing high drift', h) END, CASE WHEN slow > 0 THEN 'Performance below threshold' END,
  CASE WHEN age > 30 THEN printf('Model age (%d days) exceeds threshold', age) END], lambda x: x IS NOT NULL) AS rs FROM f)
SELECT len(rs) > 0 AS retrain, CASE WHEN len(rs) > 0 THEN array_to_string(rs, '; ') ELSE 'Model healthy' END AS reason FROM r""")
def _(t):
    age = t.events.agg(F.datediff(F.lit("2024-02-15").cast("timestamp"), F.min("ts")).alias("age")).scalar()
    return d.retrain_decision(d.drift_report(*halves(t), COLUMNS), d.degradation(recent(t)[0], 0.98), age)


@query("d12_monitoring_tests", "D12", sql=f"""WITH {HALVES}, {KS}, {PREDICTIONS}, p AS (SELECT column_name, {P_VALUE} AS p FROM ks),
 f AS (SELECT avg(CASE WHEN p < 0.05 THEN 1.0 ELSE 0.0 END) < 0.3 AS a, NOT bool_or(p < 0.05 AND column_name = 'l_quantity') AS b, (SELECT avg(CASE WHEN predicted = actual THEN 1.0 ELSE 0.0 END) > 0.8 FROM predictions WHERE actual IS NOT NULL) AS c FROM p)
SELECT unnest(['share_of_drifted_columns', 'column_drift_l_quantity', 'accuracy_score', 'all']) AS test, unnest([a, b, c, a AND b AND c]) AS passed FROM f""")
def _(t):
    hits = predictions(t).filter(F.col("actual").isNotNull())
    accuracy = hits.agg(F.avg((F.col("predicted") == F.col("actual")).cast("double")).alias("a")).scalar()
    return d.monitoring_tests(d.two_sample_distance(*halves(t), COLUMNS), "l_quantity", accuracy)
