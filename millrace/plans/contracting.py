"""Queries over event contracts. JSON events are made from ``events``; some get a defect by their id."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import contracts as c
from millrace.plans.registry import query
from millrace.session import cut_lineage, scratch, spread


def json_events(t):
    """Every event as JSON text; the id decides which defect, if any, it carries."""
    e = F.col("event_id")
    kind = F.when(F.col("event_type") == "click", "login").when(F.col("event_type") == "error", "logout").otherwise(F.col("event_type"))
    part = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    quoted = lambda col: F.concat(F.lit('"'), col, F.lit('"'))
    parts = F.array_compact(F.array(
        part("event_id", quoted(F.concat(F.lit("evt_"), e.cast("string")))),
        F.when(e % 11 != 0, part("user_id", F.when(e % 13 == 0, F.lit('"x7"')).when(e % 17 == 0, F.lit("null")).when(e % 19 == 0, F.lit("true")).when(e % 23 == 0, F.lit("2.5")).otherwise(F.col("user_id").cast("string")))),
        part("event_type", quoted(kind)),
        F.when(e % 29 != 0, part("timestamp", quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))),
        F.when(e % 2 == 0, part("source", quoted(F.when(e % 14 == 0, F.lit("fax")).when(e % 4 == 0, F.lit("web")).otherwise(F.lit("api"))))),
        F.when(e % 31 == 0, part("metadata", F.when(e % 62 == 0, F.lit("[1]")).otherwise(F.lit('{"k": 1}')))),
    ))
    events = t.events if t.events.isStreaming else spread(t.events)
    return events.select("event_id", F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}")).alias("body"))


KIND = "CASE event_type WHEN 'click' THEN 'login' WHEN 'error' THEN 'logout' ELSE event_type END"
VALIDATED = f"""facts AS (SELECT event_id, event_id AS e, user_id, ts, {KIND} AS kind, event_id % 2 = 0 AS newer FROM events),
 checked AS (SELECT *, CASE WHEN newer THEN 'v2' ELSE 'v1' END AS schema_version, list_filter([
  CASE WHEN e % 11 = 0 THEN 'Missing required field: user_id' END,
  CASE WHEN e % 29 = 0 THEN 'Missing required field: timestamp' END,
  CASE WHEN e % 11 <> 0 THEN CASE WHEN e % 13 = 0 THEN 'Field user_id: expected integer, got str' WHEN e % 17 = 0 THEN 'Field user_id: expected integer, got NoneType' WHEN e % 19 = 0 THEN NULL
    WHEN e % 23 = 0 THEN 'Field user_id: expected integer, got float' WHEN user_id < 1 THEN 'Field user_id: value ' || user_id || ' below minimum 1' END END,
  CASE WHEN NOT newer AND kind = 'view' THEN 'Field event_type: value ''view'' not in allowed values [''signup'', ''login'', ''purchase'', ''logout'']' END,
  CASE WHEN newer AND e % 14 = 0 THEN 'Field source: value ''fax'' not in allowed values [''web'', ''mobile'', ''api'']' END,
  CASE WHEN e % 62 = 0 THEN 'Field metadata: expected object, got list' END], lambda x: x IS NOT NULL) AS errors FROM facts)"""


@query("q19_event_validation", "Q19", sql=f"WITH {VALIDATED} SELECT event_id, schema_version, array_to_string(errors, ' | ') AS errors, len(errors) = 0 AS valid FROM checked")
def _(t):
    out = c.validate_events(json_events(t), "body")
    return out.select("event_id", "schema_version", F.array_join("errors", " | ").alias("errors"), "valid")


@query("q20_event_upgrade", "Q20", sql=f"""WITH {VALIDATED} SELECT 'evt_' || e AS event_id, CASE WHEN e % 19 = 0 THEN 1 ELSE user_id END AS user_id, kind AS event_type,
 CASE WHEN newer THEN CASE WHEN e % 4 = 0 THEN 'web' ELSE 'api' END ELSE 'unknown' END AS source, CASE WHEN NOT newer THEN 'v1' END AS upgraded_from FROM checked WHERE len(errors) = 0""")
def _(t):
    valid = c.validate_events(json_events(t), "body")
    return c.upgrade(valid, "body").select("event_id", "user_id", "event_type", "source", "upgraded_from")


@query("q21_dead_letters", "Q21", sql=f"WITH {VALIDATED} SELECT CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'dead' END AS side, schema_version, count(*) AS n FROM checked GROUP BY 1, 2")
def _(t):
    root = scratch(t.spark, "letters")
    c.split_dead_letters(c.validate_events(json_events(t), "body"), root)
    read = c.read_letters(t.spark, root, "event_id long, body string, schema_version string")
    return read.groupBy(F.when(F.col("valid"), "valid").otherwise("dead").alias("side"), "schema_version").agg(F.count(F.lit(1)).alias("n"))


@query("q21_error_counts", "Q19", "Q21", sql=f"WITH {VALIDATED} SELECT schema_version, unnest(errors) AS error, count(*) AS n FROM checked GROUP BY 1, 2")
def _(t):
    return c.union_errors(c.validate_events(json_events(t), "body"))


@query("q22_retry_triage", "Q22", sql="""SELECT action, count(*) AS n, sum(r)::BIGINT AS retries FROM (SELECT CASE WHEN coalesce(nullif(event_id % 9, 8), 0) < 5 THEN 'republish' ELSE 'permanent_failure' END AS action,
 CASE WHEN coalesce(nullif(event_id % 9, 8), 0) < 5 THEN coalesce(nullif(event_id % 9, 8), 0) + 1 ELSE event_id % 9 END AS r FROM events WHERE event_type = 'error') GROUP BY 1""")
def _(t):
    letters = t.events.filter("event_type = 'error'").select("event_id", F.when(F.col("event_id") % 9 != 8, F.col("event_id") % 9).alias("retry_count"))
    return c.triage(letters).groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.sum("retry_count").alias("retries"))


@query("q23_schema_compatibility", "Q23", sql="""WITH e AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'v2' ELSE 'v1' END AS version, list_filter(['event_id', CASE WHEN event_id % 11 <> 0 THEN 'user_id' END, 'event_type',
  CASE WHEN event_id % 29 <> 0 THEN 'timestamp' END, CASE WHEN event_id % 2 = 0 THEN 'source' END, CASE WHEN event_id % 31 = 0 THEN 'metadata' END], lambda x: x IS NOT NULL) AS fields FROM events),
 n AS (SELECT version, count(*) AS n FROM e GROUP BY 1),
 f AS (SELECT version, field, count(*) AS n FROM (SELECT version, unnest(fields) AS field FROM e) GROUP BY 1, 2),
 r AS (SELECT f.version, field FROM f JOIN n USING (version) WHERE f.n = n.n),
 pairs AS (SELECT * FROM (VALUES ('v1', 'v2'), ('v2', 'v1'), ('v1', 'v1')) v(old, new)),
 d AS (SELECT old, new, coalesce((SELECT string_agg(field, ', ' ORDER BY field) FROM r WHERE version = old AND field NOT IN (SELECT field FROM r WHERE version = new)), '') AS removed,
  coalesce((SELECT string_agg(field, ', ' ORDER BY field) FROM r WHERE version = new AND field NOT IN (SELECT field FROM r WHERE version = old)), '') AS added FROM pairs)
SELECT old, new, removed = '' AS backward_compatible, added = '' AS forward_compatible,
 concat_ws('; ', CASE WHEN removed <> '' THEN 'Removed required fields: ' || removed END, CASE WHEN added <> '' THEN 'New required fields: ' || added END) AS breaking_changes, added AS new_fields FROM d""")
def _(t):
    events = json_events(t).withColumn("version", F.when(F.json_object_keys("body").isNotNull() & F.array_contains(F.json_object_keys("body"), "source"), "v2").otherwise("v1"))
    fields = cut_lineage(c.observed_fields(events, "body", F.col("version")), "fields")
    pairs = [("v1", "v2"), ("v2", "v1"), ("v1", "v1")]
    compared = [c.compatibility(fields, old, new).select(F.lit(old).alias("old"), F.lit(new).alias("new"), "*") for old, new in pairs]
    return compared[0].unionByName(compared[1]).unionByName(compared[2])


@query("q24_signature", "Q24", sql="SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem")
def _(t):
    return c.enforce_signature(t.lineitem, "l_orderkey long not null, l_quantity long, l_linenumber double")
