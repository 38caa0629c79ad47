"""Projections, filters, samples and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import number_rows


def ratio(top: Column, bottom: Column) -> Column:
    """top / (bottom + 1) in DOUBLE, the smoothing used by every derived ratio feature."""
    return top.cast("double") / (bottom.cast("double") + 1)


def ratio_features(df: DataFrame, purchases: str, tenure: str, tickets: str, days_since: str) -> DataFrame:
    return df.withColumns(
        {
            "purchase_frequency": ratio(F.col(purchases), F.col(tenure)),
            "support_ratio": ratio(F.col(tickets), F.col(purchases)),
            "recency_score": ratio(F.lit(1), F.col(days_since)),
        }
    )


def stamp(df: DataFrame, run_ts: str, name: str = "event_timestamp") -> DataFrame:
    """One run time on every row; the caller passes it so that a rerun repeats."""
    return df.withColumn(name, F.lit(run_ts).cast("timestamp"))


def age_group(age: Column) -> Column:
    """Under 25 young, under 40 middle, anything else, NULL included, senior."""
    return F.when(age < 25, "young").when(age < 40, "middle").otherwise("senior")


def right_closed_bins(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Bins (a, b]. A value at or below the first edge, or above the last, has no bin."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one label per bin")
    out = None
    for low, high, label in zip(edges, edges[1:], labels, strict=False):
        hit = (value > low) & (value <= high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def risk_level(probability: Column) -> Column:
    return F.when(probability > 0.7, "High").when(probability > 0.4, "Medium").otherwise("Low")


def drop_incomplete_and_repeated(df: DataFrame) -> DataFrame:
    return df.dropna("any").dropDuplicates()


def exact_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), the same ones on every run and at every
    partitioning; the draw is an md5, so that any engine can repeat it.

    Rows are counted by the first four digits of their draw. All rows below the cell in which the
    sample ends are taken where they lie; only that cell's rows, one in 65,536 or so, are ordered.
    """
    drawn = df.withColumn("__draw", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))).withColumn("__cell", F.substring("__draw", 1, 4))
    left, cut = n, None
    for cell, count in sorted(tuple(r) for r in drawn.groupBy("__cell").count().collect()):
        if count > left:
            cut = cell
            break
        left -= count
    if cut is None:
        return df
    edge = drawn.filter(F.col("__cell") == cut).orderBy("__draw", key).limit(left)
    return drawn.filter(F.col("__cell") < cut).unionByName(edge).select(*df.columns)


def hash_share(key: Column, seed: int = 42) -> Column:
    """A repeatable number in 0..9999 per key, from md5 so that any engine can recompute it."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10000).cast("long")


def split_by_hash(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    part = F.when(hash_share(F.col(key), seed) < int(round(test_share * 10000)), "test").otherwise("train")
    return df.withColumn("split", part)


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Keep the class shares: the first ``round(share * n)`` rows of each class in hash order are test rows.

    Row numbers come from the bucketed counter, so one dominant class does not land in one task.
    """
    drawn = df.withColumn("__draw", F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), 1, 12), 16, 10).cast("long"))
    numbered = number_rows(drawn, [label], "__draw", [key], name="__no")
    sizes = df.groupBy(label).agg(F.round(F.count(F.lit(1)) * test_share).cast("long").alias("__take"))
    sizes = sizes.withColumnRenamed(label, "__label")
    joined = numbered.join(sizes, numbered[label].eqNullSafe(sizes["__label"]))
    return joined.withColumn("split", F.when(F.col("__no") <= F.col("__take"), "test").otherwise("train")).select(
        *df.columns, "split"
    )


def matching(df: DataFrame, **must: object) -> DataFrame:
    """Keep rows whose columns equal every given value; ``None`` means no condition."""
    return reduce(lambda d, kv: d if kv[1] is None else d.filter(F.col(kv[0]) == F.lit(kv[1])), must.items(), df)


def validate_question(df: DataFrame, column: str, low: int = 3, high: int = 1000) -> DataFrame:
    text = F.trim(F.col(column))
    size = F.length(text)
    error = (
        F.when(text.isNull() | (size < low), "Question too short").when(size > high, "Question too long")
    )
    return df.withColumns({"question": text, "error": error}).withColumn("is_valid", F.col("error").isNull())


def page(df: DataFrame, tenant: Column, tenant_id: object, status: Column | None, wanted: str | None,
         newest: str, key: str, limit: int, offset: int = 0) -> DataFrame:
    """One page of a tenant's rows, newest first, the key settling ties."""
    rows = df.filter(tenant == F.lit(tenant_id))
    if status is not None and wanted is not None:
        rows = rows.filter(status == wanted)
    return rows.orderBy(F.col(newest).desc(), key).offset(offset).limit(limit)


class TenantScope:
    """A view of tables that can only be read through one tenant's filter."""

    def __init__(self, column: str, tenant_id: object):
        self.column = column
        self.tenant_id = tenant_id

    def read(self, df: DataFrame) -> DataFrame:
        if self.column not in df.columns:
            raise ValueError(f"table has no tenant column {self.column}")
        return df.filter(F.col(self.column) == F.lit(self.tenant_id))


def apply_status_updates(state: DataFrame, updates: DataFrame, key: str, at: str) -> DataFrame:
    """Status, chunk count and error replaced where an update says so; processed_at set on completion.

    ``updates`` has at most one row per key: (key, status, chunk_count, error).
    """
    new = updates.select(
        F.col(key).alias("__k"), F.col("status").alias("__s"), F.col("chunk_count").alias("__c"), F.col("error").alias("__e")
    )
    joined = state.join(new, state[key] == new["__k"], "left")
    done = F.col("__s") == "completed"
    return joined.select(
        *[c for c in state.columns if c not in ("status", "chunk_count", "error", "processed_at")],
        F.coalesce("__s", "status").alias("status"),
        F.coalesce("__c", "chunk_count").alias("chunk_count"),
        F.coalesce("__e", "error").alias("error"),
        F.when(done, F.lit(at).cast("timestamp")).otherwise(F.col("processed_at")).alias("processed_at"),
    )


def expand_by(df: DataFrame, name: str, values: list) -> DataFrame:
    """Every row once per parameter value. The parameter list is part of the plan, so this is a
    generator over each row and never a join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def zip_positions(df: DataFrame, left: str, right: str) -> DataFrame:
    """The i-th element of one array with the i-th of the other."""
    zipped = df.select(*df.columns, F.posexplode(F.arrays_zip(left, right)).alias("position", "__z"))
    return zipped.withColumns({f"{left}_item": F.col(f"__z.{left}"), f"{right}_item": F.col(f"__z.{right}")}).drop("__z")


def route_by_threshold(df: DataFrame, value: str, threshold: float) -> DataFrame:
    return df.withColumn("route", F.when(F.col(value) >= threshold, "high").otherwise("low"))


# Alert levels, their channels, and the teams that own alerts.
ALERT_LEVELS = {
    "P1": (["pagerduty", "slack_incidents", "email_leadership"], "Critical - Immediate action required"),
    "P2": (["slack_alerts", "email_team"], "High - Action required within 1 hour"),
    "P3": (["slack_alerts"], "Medium - Action required today"),
    "P4": (["log"], "Low - Informational"),
}
# team: channel, mail, service
ALERT_TEAMS = {
    "data-engineering": ("#data-eng-alerts", "data-eng@example.com", "data-engineering"),
    "ml-platform": ("#ml-alerts", "ml-team@example.com", "ml-platform"),
    "analytics": ("#analytics-alerts", "analytics@example.com", "analytics"),
}
DEFAULT_TEAM = "data-engineering"


def alert_severity(workflow: Column, task: Column, tries: Column) -> Column:
    production = F.lower(workflow).contains("prod")
    return (
        F.when(production & (tries > 2), "P1")
        .when(production | F.lower(task).contains("critical"), "P2")
        .when(tries > 1, "P3")
        .otherwise("P4")
    )


def alert_team(tags: Column) -> Column:
    """The first tag that names a team."""
    known = F.filter(tags, lambda t: t.isin(*ALERT_TEAMS))
    return F.coalesce(F.get(known, F.lit(0)), F.lit(DEFAULT_TEAM))


def route_alerts(df: DataFrame, workflow: str, task: str, tries: str, tags: str) -> DataFrame:
    """One row per alert and channel, with the channel, mail and service of the team that owns it.
    The level and team tables are a few rows, carried as literal maps."""
    channels = F.create_map(
        *[x for level, (names, _) in ALERT_LEVELS.items() for x in (F.lit(level), F.array(*[F.lit(n) for n in names]))]
    )
    notes = F.create_map(*[x for level, (_, note) in ALERT_LEVELS.items() for x in (F.lit(level), F.lit(note))])
    routed = df.withColumns(
        {
            "severity": alert_severity(F.col(workflow), F.col(task), F.coalesce(F.col(tries), F.lit(1))),
            "team": alert_team(F.col(tags)),
        }
    )
    for i, name in enumerate(("slack_channel", "email", "service")):
        own = F.create_map(*[F.lit(x) for team, where in ALERT_TEAMS.items() for x in (team, where[i])])
        routed = routed.withColumn(name, own[F.col("team")])
    return routed.withColumn("description", notes[F.col("severity")]).withColumn(
        "channel", F.explode(channels[F.col("severity")])
    )


def chunk_metadata(df: DataFrame, doc: str, ordinal: str, text: str, processed_at: str) -> DataFrame:
    """Position, totals and sizes of every chunk; the totals are one aggregate joined back."""
    words = F.filter(F.split(F.col(text), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    totals = df.groupBy(doc).agg(F.count(F.lit(1)).alias("total_chunks"))
    return df.join(totals, doc).withColumns(
        {
            "chunk_index": F.col(ordinal),
            "char_count": F.length(text).cast("long"),
            "word_count": F.size(words).cast("long"),
            "processed_at": F.lit(processed_at).cast("timestamp"),
        }
    )


def newest_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in ``order``; Spark cuts each map task to ``n`` before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") <= n).drop("__rn")
