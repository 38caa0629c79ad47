"""Metric series, histograms, rates, logs, traces, alert rules and cost reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- series ----------------------------------------------------------------


def labels_text(labels: Column) -> Column:
    """A label map as ``k="v"`` pairs in key order: maps cannot be group keys, this can."""
    pairs = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"')))
    return F.array_join(pairs, ",")


def series(samples: DataFrame) -> DataFrame:
    """(type, name, labels, value, observations): counters add up, gauges keep the last value,
    histograms count and sum their observations."""
    keyed = samples.withColumn("labels", labels_text(F.col("labels")))
    grouped = keyed.groupBy("type", "name", "labels").agg(
        F.sum(F.col("value").cast("decimal(28,6)")).cast("double").alias("__sum"), F.max_by("value", F.struct("timestamp", "value")).alias("__last"), F.count("value").alias("observations")
    )
    return grouped.select("type", "name", "labels", F.when(F.col("type") == "gauge", F.col("__last")).otherwise(F.col("__sum")).alias("value"), "observations")


def exposition(rows: DataFrame) -> DataFrame:
    """``name{k="v"} value`` lines."""
    return rows.select(
        F.concat("name", F.when(F.col("labels") != "", F.concat(F.lit("{"), "labels", F.lit("}"))).otherwise(""), F.lit(" "), F.col("value").cast("string")).alias("line")
    )


def histogram(df: DataFrame, keys: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Cumulative counts (keys.., le, count) for every bound and +Inf, one aggregation pass."""
    counts = df.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= b).alias(f"__{i}") for i, b in enumerate(bounds)], F.count(value).alias(f"__{len(bounds)}")
    )
    limits = [*bounds, float("inf")]
    cells = [F.struct(F.lit(float(b)).alias("le"), F.col(f"__{i}").alias("count")) for i, b in enumerate(limits)]
    return counts.select(*keys, F.explode(F.array(*cells)).alias("s")).select(*keys, "s.*")


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Linear interpolation inside the bucket the rank falls in; beyond the last bound, that bound.

    The window covers one key's buckets, of which there is a fixed handful.
    """
    window = Window.partitionBy(*keys).orderBy("le")
    whole = Window.partitionBy(*keys)
    placed = buckets.select(
        *keys, "le", "count", F.coalesce(F.lag("count").over(window), F.lit(0)).alias("__below"),
        F.coalesce(F.lag("le").over(window), F.lit(0.0)).alias("__from"), (F.max("count").over(whole) * F.lit(q)).alias("__rank"),
    )
    hit = (F.col("count") >= F.col("__rank")) & (F.col("__below") < F.col("__rank"))
    inside = F.col("__from") + (F.col("le") - F.col("__from")) * (F.col("__rank") - F.col("__below")) / (F.col("count") - F.col("__below"))
    value = F.when(F.col("le") == float("inf"), F.col("__from")).otherwise(inside)
    return placed.groupBy(*keys).agg(F.max(F.when(hit, value)).alias("quantile"))


def error_ratio(df: DataFrame, ts: str, failed: Column, width: str = "5 minutes", limit: float = 0.05) -> DataFrame:
    """Per tumbling window: total, errors, ratio, alert. (A sliding, extrapolated rate is not meant.)"""
    counted = df.groupBy(F.window(ts, width).alias("__w")).agg(F.count(F.lit(1)).alias("total"), F.count_if(failed).alias("errors"))
    return counted.select(F.col("__w.start").alias("window_start"), "total", "errors", (F.col("errors") / F.col("total")).alias("ratio")).withColumn(
        "alert", F.col("ratio") > limit
    )


def increase(df: DataFrame, ts: str, failed: Column, width: str = "1 hour", limit: int = 5) -> DataFrame:
    counted = df.groupBy(F.window(ts, width).alias("__w")).agg(F.count_if(failed).alias("increase"))
    return counted.select(F.col("__w.start").alias("window_start"), "increase", (F.col("increase") > limit).alias("alert"))


# --- logs and traces -------------------------------------------------------

LOG_SCHEMA = "timestamp string, level string, service string, correlation_id string, message string, span_id string, _corrupt_record string"


def parse_logs(df: DataFrame, line: str) -> DataFrame:
    """Structured log lines as columns; a line that is no JSON keeps its text in ``_corrupt_record``."""
    return df.select(F.from_json(line, LOG_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("l")).select("l.*")


def log_counts(logs: DataFrame) -> DataFrame:
    level = F.when(F.col("_corrupt_record").isNotNull(), "CORRUPT").otherwise(F.coalesce("level", F.lit("UNKNOWN")))
    return logs.groupBy(level.alias("level"), "service").agg(F.count(F.lit(1)).alias("lines"), F.count("span_id").alias("in_span"))


def trace_summary(spans: DataFrame) -> DataFrame:
    """Per trace: spans, roots, first start, last end, slowest span and status.

    ``spans`` is (trace_id, span_id, parent_span_id, name, start_time, end_time, status).
    """
    took = F.unix_micros("end_time") - F.unix_micros("start_time")
    return spans.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("spans"), F.count_if(F.col("parent_span_id").isNull()).alias("roots"), F.min("start_time").alias("started"),
        F.max("end_time").alias("ended"), F.min_by("name", F.struct((-took).alias("t"), "span_id")).alias("slowest"),
        F.when(F.count_if(F.col("status") == "error") > 0, "error").otherwise("success").alias("status"),
    )


# Alert rules as (name, metric, comparison, threshold, severity, minutes the condition
# must hold). Names of alerts and metrics are general ones; readiness of single servers is not ruled here.
ALERT_RULES = [
    ("RunFailure", "failed_runs", ">", 0.0, "warning", 5),
    ("DAGRunningTooLong", "workflow_duration_seconds", ">", 7200.0, "warning", 10),
    ("ExperimentFailed", "failed_runs_1h", ">", 5.0, "warning", 5),
    ("ModelAccuracyDegraded", "model_accuracy", "<", 0.8, "critical", 15),
    ("HighPredictionLatency", "prediction_latency_p95", ">", 1.0, "warning", 10),
    ("DataDriftDetected", "data_drift_score", ">", 0.3, "warning", 30),
    ("HighPredictionErrorRate", "prediction_error_ratio", ">", 0.05, "critical", 5),
    ("HighLatency", "query_latency_p95", ">", 3.0, "warning", 5),
    ("HighErrorRate", "error_ratio", ">", 0.05, "critical", 5),
    ("LowRetrievalQuality", "retrieval_score", "<", 0.5, "warning", 10),
]


def _judged(values: DataFrame, rules: list[tuple]) -> DataFrame:
    """A row for every value and rule that names its metric, with the rule as ``r`` and whether it ``hit``."""
    names = ("alert", "m", "op", "threshold", "severity", "minutes")
    cells = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, rule, strict=True)]) for rule in rules])
    joined = values.withColumn("r", F.explode(F.filter(cells, lambda r: r["m"] == F.col("metric"))))
    return joined.withColumn("hit", F.when(F.col("r.op") == ">", F.col("value") > F.col("r.threshold")).otherwise(F.col("value") < F.col("r.threshold")))


def evaluate_rules(values: DataFrame, rules: list[tuple] = ALERT_RULES) -> DataFrame:
    """(alert, metric, value, severity, firing) for every (metric, value) a rule names, hold times aside."""
    return _judged(values, rules).select(F.col("r.alert").alias("alert"), "metric", "value", F.col("r.severity").alias("severity"), F.col("hit").alias("firing"))


def alert_states(samples: DataFrame, rules: list[tuple] = ALERT_RULES) -> DataFrame:
    """(alert, metric, severity, value, since, state) after the newest of (metric, ts, value) samples.

    A condition that holds is pending until it has held for the rule's minutes, then it is firing;
    ``since`` is the first sample after the last one that did not meet it. Two small aggregates per
    alert, whatever the length of a series.
    """
    judged = _judged(samples, rules).select(F.col("r.alert").alias("alert"), "metric", F.col("r.severity").alias("severity"), F.col("r.minutes").alias("minutes"), "ts", "value", "hit")
    ends = judged.groupBy("alert", "metric", "severity", "minutes").agg(
        F.max("ts").alias("newest"), F.max(F.when(~F.col("hit"), F.col("ts"))).alias("quiet"), F.max_by("value", "ts").alias("value")
    )
    met = judged.filter("hit").select(F.col("alert").alias("__a"), F.col("ts").alias("__t")).join(ends.select(F.col("alert").alias("__a"), "quiet"), "__a")
    since = met.filter(F.col("quiet").isNull() | (F.col("__t") > F.col("quiet"))).groupBy("__a").agg(F.min("__t").alias("since"))
    held = F.unix_micros("newest") - F.unix_micros("since")
    state = F.when(F.col("since").isNull(), "inactive").when(held >= F.col("minutes") * 60_000_000, "firing").otherwise("pending")
    return ends.join(since, F.col("alert") == F.col("__a"), "left").select("alert", "metric", "severity", "value", "since", state.alias("state"))


# --- cost ------------------------------------------------------------------

# Dollars per token of two price lists, a monthly price per stored vector, and tiers.
PRICES_2024 = [
    ("gpt-4-turbo", "0.00001", "0.00003"), ("gpt-3.5-turbo", "0.0000005", "0.0000015"),
    ("claude-3-sonnet", "0.000003", "0.000015"), ("llama-3.1-8b", "0.0000001", "0.0000001"),
]
PRICES_HOSTED = [("groq-8b", "0.00000005", "0.00000008"), ("groq-70b", "0.00000059", "0.00000079"), ("gpt-3.5", "0.0000005", "0.0000015"), ("gpt-4", "0.00001", "0.00003")]
VECTOR_TIERS = [(1_000_000, 25), (5_000_000, 95), (10_000_000, 380)]
# Dollars a month: self-hosted vectors per million, a database and a cache below and from so many
# queries, monitoring from so many.
VECTORS_PER_MILLION = 15
DATABASE, CACHE, LARGE_FROM = (15, 50), (5, 30), 10_000
MONITORING, MONITORED_FROM = 50, 1000
_PRICE = "decimal(18,9)"


def price_maps(prices: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Price lists as literal maps: a handful of models, carried in the plan."""
    make = lambda i: F.create_map(*[x for row in prices for x in (F.lit(row[0]), F.lit(row[i]).cast(_PRICE))])
    return make(1), make(2)


def query_costs(log: DataFrame, prices: list[tuple[str, str, str]], model: str = "model") -> DataFrame:
    """Every query with its input and output cost, exact to nine places."""
    price_in, price_out = price_maps(prices)
    return log.withColumns({"cost_in": F.col("tokens_in") * price_in[F.col(model)], "cost_out": F.col("tokens_out") * price_out[F.col(model)]})


def monthly_costs(costs: DataFrame, ts: str) -> DataFrame:
    return costs.groupBy(F.col("tenant_id"), F.date_trunc("month", ts).alias("month")).agg(
        F.sum("cost_in").cast("double").alias("input_cost"), F.sum("cost_out").cast("double").alias("output_cost"),
        F.sum(F.col("cost_in") + F.col("cost_out")).cast("double").alias("total_cost"), F.count(F.lit(1)).alias("query_count"),
    )


def monthly_model(scenarios: DataFrame, prices: list[tuple[str, str, str]] = PRICES_HOSTED, tiers: list[tuple[int, int]] = VECTOR_TIERS) -> DataFrame:
    """Monthly cost per scenario (queries_per_day, model, cache_hit_rate, tokens, vectors, managed).

    The vector tier is the smallest that holds the vectors; beyond the last there is no price
    and the totals are NULL.
    """
    price_in, price_out = price_maps(prices)
    monthly = F.col("queries_per_day") * 30
    calls = monthly * (1 - F.col("cache_hit_rate"))
    llm = calls * (F.col("avg_input_tokens") * price_in[F.col("model")].cast("double") + F.col("avg_output_tokens") * price_out[F.col("model")].cast("double"))
    tier = None
    for size, price in sorted(tiers):
        hit = F.col("total_vectors") <= size
        tier = F.when(hit, F.lit(float(price))) if tier is None else tier.when(hit, F.lit(float(price)))
    vectors = F.when(F.col("managed"), tier).otherwise(F.col("total_vectors") / 1_000_000 * VECTORS_PER_MILLION)
    small = monthly < LARGE_FROM
    out = scenarios.withColumns({
        "monthly_queries": monthly, "effective_llm_calls": F.floor(calls).cast("long"), "llm_cost": llm, "vector_db_cost": vectors,
        "postgres_cost": F.when(small, DATABASE[0]).otherwise(DATABASE[1]), "redis_cost": F.when(small, CACHE[0]).otherwise(CACHE[1]),
        "monitoring_cost": F.when(monthly < MONITORED_FROM, 0).otherwise(MONITORING),
    })
    total = F.col("llm_cost") + F.col("vector_db_cost") + F.col("postgres_cost") + F.col("redis_cost") + F.col("monitoring_cost")
    return out.withColumns({"total_monthly_cost": F.round(total, 2), "cost_per_query": F.round(total / F.col("monthly_queries"), 4), "llm_cost": F.round("llm_cost", 2)})
