"""Column profiles and drift between a baseline and a current table."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import linear_quantiles, running_totals, values_at_ranks
from millrace.operators.relate import full_compare, unpivot_numeric
from millrace.operators.select import newest_per_key
from millrace.session import cut_lineage

# The index bounds of the severity words, in rising order.
SEVERITY_BOUNDS = [("none", 0.1), ("low", 0.2), ("medium", 0.3), ("high", 0.5)]
SEVERITY_RANK = {"none": 0, "low": 1, "medium": 2, "high": 3, "critical": 4}


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, null_count, mean, population std, min, max, median, p25, p75 per column.

    The median is the mean of the middle two; p25 and p75 are ``sorted[int(n * q)]``. A column
    without any value gets an error row.
    """
    long = unpivot_numeric(df, columns)
    stats = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("null_count"),
        F.round(F.avg("value"), 4).alias("mean"), F.round(F.stddev_pop("value"), 4).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    ranks = values_at_ranks(
        long, ["column_name"], "value",
        {
            "__a": lambda n: F.floor((n - 1) / 2), "__b": lambda n: F.floor(n / 2),
            "p25": lambda n: F.floor(n * 0.25), "p75": lambda n: F.floor(n * 0.75),
        },
    )
    ranks = ranks.select("column_name", ((F.col("__a") + F.col("__b")) / 2).alias("median"), "p25", "p75")
    return stats.join(ranks, "column_name", "left").withColumn(
        "error", F.when(F.col("count") == 0, "No valid values")
    )


def unpivot_text(df: DataFrame, columns: list[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("__s")).select(F.col("__s.c").alias("column_name"), F.col("__s.v").alias("value"))


def categorical_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, null_count and distinct values per column."""
    counts = unpivot_text(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    return counts.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("count"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_count"),
        F.count_if(known).alias("unique_count"),
    )


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent values per column with their share among those ``k``; value order on ties."""
    counts = unpivot_text(df, columns).filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = newest_per_key(counts, ["column_name"], [F.col("n").desc(), F.col("value")], k)
    return best.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("column_name")))


def category_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every value per column with its share among the column's known values."""
    counts = unpivot_text(df, columns).filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("__all"))
    return counts.join(totals, "column_name").withColumn("share", F.col("n") / F.col("__all")).drop("__all")


def numeric_drift(base: DataFrame, current: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Rows (column_name, metric, baseline, current, change_pct, drift) from two numeric profiles."""
    metrics = ["mean", "std", "min", "max"]

    def long(profile: DataFrame, name: str) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias(name)) for m in metrics]
        return profile.filter(F.col("error").isNull()).select("column_name", F.explode(F.array(*cells)).alias("s")).select("column_name", "s.*")

    joined = long(base, "baseline").join(long(current, "current"), ["column_name", "metric"])
    change = F.when(F.col("baseline") != 0, F.abs(F.col("current") - F.col("baseline")) / F.abs("baseline")).otherwise(F.abs("current"))
    return joined.withColumn("__change", change).select(
        "column_name", "metric", "baseline", "current", F.round(F.col("__change") * 100, 2).alias("change_pct"),
        (F.col("__change") > threshold).alias("drift"),
    )


def categorical_drift(base: DataFrame, current: DataFrame, threshold: float = 0.1) -> DataFrame:
    """One row per column from two ``category_shares`` frames: the largest shift in points, new and
    missing categories, and a true boolean for drift (stated intent; category sets never leak out
    in its place)."""
    key = F.struct("column_name", "value").alias("category")
    compared = full_compare(base.select(key, "share"), current.select(key, "share"), "category", "share")
    shift = F.round(F.abs(F.col("current") - F.col("baseline")) * 100, 2)
    out = compared.select("category.column_name", shift.alias("shift"), (F.col("baseline") == 0).alias("new"), (F.col("current") == 0).alias("missing"))
    return out.groupBy("column_name").agg(
        F.max("shift").alias("max_shift"), F.count_if("new").alias("new_categories"), F.count_if("missing").alias("missing_categories")
    ).withColumn("drift", (F.col("max_shift") > threshold * 100) | (F.col("new_categories") > 0) | (F.col("missing_categories") > 0))


def stability_index(base: DataFrame, current: DataFrame, columns: list[str], buckets: int = 10) -> DataFrame:
    """Population stability index per column over buckets at the baseline's percentiles.

    One row of edges per column is joined to the cells; the column count bounds that table.
    """
    fractions = {f"e{i}": i / buckets for i in range(1, buckets)}
    long_base, long_current = unpivot_numeric(base, columns), unpivot_numeric(current, columns)
    edges = linear_quantiles(long_base, ["column_name"], "value", fractions).drop("n")
    above = reduce(operator.add, [(F.col("value") >= F.col(e)).cast("int") for e in fractions])

    def counts(long: DataFrame, name: str) -> DataFrame:
        placed = long.filter(F.col("value").isNotNull()).join(F.broadcast(edges), "column_name")
        return placed.groupBy("column_name", above.alias("bucket")).agg(F.count(F.lit(1)).alias(name))

    spine = edges.select("column_name", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    both = spine.join(counts(long_base, "b"), ["column_name", "bucket"], "left").join(counts(long_current, "c"), ["column_name", "bucket"], "left")
    whole = Window.partitionBy("column_name")
    filled = both.withColumns({"b": F.coalesce("b", F.lit(0)), "c": F.coalesce("c", F.lit(0))})
    shares = filled.select(
        "column_name", ((F.col("b") + 0.0001) / F.sum("b").over(whole)).alias("b"), ((F.col("c") + 0.0001) / F.sum("c").over(whole)).alias("c")
    )
    return shares.groupBy("column_name").agg(F.sum((F.col("c") - F.col("b")) * F.ln(F.col("c") / F.col("b"))).alias("psi"))


def smirnov_p_value(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample test; the alternating series is cut at 100 terms."""
    x = distance * F.sqrt(n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x),
    )
    series = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def two_sample_distance(base: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and asymptotic p-value per column.

    Cells collapse to counts per value first; the running shares come from the bucketed totals.
    """
    side = lambda df, n: unpivot_numeric(df, columns).filter(F.col("value").isNotNull()).withColumn("__side", F.lit(n))
    counts = side(base, 0).unionByName(side(current, 1)).groupBy("column_name", "value").agg(
        F.count_if(F.col("__side") == 0).alias("b"), F.count_if(F.col("__side") == 1).alias("c")
    )
    counts = cut_lineage(counts, "steps")
    sizes = counts.groupBy("column_name").agg(F.sum("b").alias("n"), F.sum("c").alias("m"))
    running = running_totals(counts, ["column_name"], "value", {"cb": "b", "cc": "c"})
    gaps = running.join(F.broadcast(sizes), "column_name").select(
        "column_name", "n", "m", F.abs((F.col("cb") + F.col("b")) / F.col("n") - (F.col("cc") + F.col("c")) / F.col("m")).alias("gap")
    )
    found = gaps.groupBy("column_name").agg(F.max("gap").alias("statistic"), F.max("n").alias("n"), F.max("m").alias("m"))
    return found.withColumn("p_value", smirnov_p_value(F.col("statistic"), F.col("n"), F.col("m")))


def severity(psi: Column) -> Column:
    out = None
    for word, bound in SEVERITY_BOUNDS:
        out = F.when(psi < bound, word) if out is None else out.when(psi < bound, word)
    return out.otherwise("critical")


def severity_rank(word: Column) -> Column:
    """Severities compare by rank, not by spelling."""
    return F.create_map(*[F.lit(x) for kv in SEVERITY_RANK.items() for x in kv])[word]


def drift_report(base: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: index, severity, distance and p-value."""
    psi = stability_index(base, current, columns)
    return psi.join(two_sample_distance(base, current, columns), "column_name").withColumn("severity", severity(F.col("psi")))


def drift_share(report: DataFrame, limit: float = 0.3, p: float = 0.05) -> DataFrame:
    """Share of columns whose two-sample test rejects, and whether to act on it."""
    return report.agg(
        F.count(F.lit(1)).alias("columns"), F.count_if(F.col("p_value") < p).alias("drifted"),
        F.avg((F.col("p_value") < p).cast("double")).alias("share"),
    ).withColumn("act", F.col("share") > limit)


def degradation(recent: DataFrame, baseline_accuracy: float, threshold: float = 0.05) -> DataFrame:
    """``recent`` has an ``accuracy`` column, NULL where there is not enough feedback."""
    drop = F.coalesce(F.lit(baseline_accuracy) - F.col("accuracy"), F.lit(0.0))
    return recent.withColumn("degradation", drop).withColumn("degraded", F.col("degradation") > threshold)


def drift_alerts(report: DataFrame, degraded: DataFrame, distribution: DataFrame) -> DataFrame:
    """(type, severity, subject, message) rows from drift, accuracy and prediction skew."""
    data = report.filter(F.col("severity").isin("high", "critical")).select(
        F.lit("DATA_DRIFT").alias("type"), "severity", F.col("column_name").alias("subject"),
        F.format_string("High drift detected in %s (PSI=%.3f)", "column_name", "psi").alias("message"),
    )
    accuracy = degraded.filter("degraded").select(
        F.lit("PERFORMANCE_DEGRADATION").alias("type"), F.lit("high").alias("severity"), F.col("model").alias("subject"),
        F.lit("Model accuracy dropped below threshold").alias("message"),
    )
    top = distribution.groupBy("model").agg(F.max("share").alias("share")).filter(F.col("share") > 0.8)
    skew = top.select(
        F.lit("PREDICTION_SKEW").alias("type"), F.lit("medium").alias("severity"), F.col("model").alias("subject"),
        F.format_string("Predictions heavily skewed to one class (%.1f%%)", F.col("share") * 100).alias("message"),
    )
    return data.unionByName(accuracy).unionByName(skew)


def retrain_decision(report: DataFrame, degraded: DataFrame, model_age_days: Column) -> DataFrame:
    """One row: whether to retrain and why, reasons joined by "; ", else "Model healthy"."""
    drift = report.agg(F.count_if(F.col("severity") == "critical").alias("critical"), F.count_if(F.col("severity").isin("high", "critical")).alias("high"))
    slow = degraded.agg(F.coalesce(F.bool_or("degraded"), F.lit(False)).alias("d")).scalar()
    facts = drift.select("*", slow.alias("slow"), model_age_days.alias("age"))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("critical") > 0, "Critical drift detected"),
            F.when(F.col("high") >= 2, F.format_string("Multiple features (%d) showing high drift", "high")),
            F.when(F.col("slow"), "Performance below threshold"),
            F.when(F.col("age") > 30, F.format_string("Model age (%d days) exceeds threshold", "age")),
        )
    )
    return facts.withColumn("__r", reasons).select(
        (F.size("__r") > 0).alias("retrain"), F.when(F.size("__r") > 0, F.array_join("__r", "; ")).otherwise("Model healthy").alias("reason")
    )


def monitoring_tests(report: DataFrame, stable_column: str, accuracy: Column, share_below: float = 0.3, accuracy_above: float = 0.8, p: float = 0.05) -> DataFrame:
    """(test, passed) rows: drifted share, one named column stable, accuracy; all must pass."""
    drifted = F.col("p_value") < p
    facts = report.agg(F.avg(drifted.cast("double")).alias("share"), F.bool_or(drifted & (F.col("column_name") == stable_column)).alias("moved"))
    facts = facts.select("*", accuracy.alias("accuracy"))
    rows = [
        ("share_of_drifted_columns", F.col("share") < share_below),
        (f"column_drift_{stable_column}", ~F.col("moved")),
        ("accuracy_score", F.col("accuracy") > accuracy_above),
    ]
    passed = reduce(operator.and_, [F.coalesce(c, F.lit(False)) for _, c in rows])
    cells = [F.struct(F.lit(n).alias("test"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in rows]
    cells.append(F.struct(F.lit("all").alias("test"), passed.alias("passed")))
    return facts.select(F.explode(F.array(*cells)).alias("s")).select("s.*")
