"""Joins, grouped reports, orderings and set computations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import drop_context, linear_quantiles, number_rows, number_values, with_preceding
from millrace.operators.select import newest_per_key
from millrace.session import cut_lineage, shuffle_width

#: Bitmaps of 4 KB that one task unites, about.
UNITED = 2**14

# --- joins -----------------------------------------------------------------


def user_order_totals(users: DataFrame, orders: DataFrame, user_key: str, order_user: str, order_key: str, amount: str) -> DataFrame:
    """Every user with order count, sum and mean; users without orders have count 0 and NULL sums.

    Orders are summed per user before the join, so a heavy buyer shuffles as one row per task.
    """
    totals = orders.filter(F.col(order_user).isNotNull()).groupBy(order_user).agg(
        F.count(order_key).alias("order_count"), F.sum(amount).alias("total_spent"), F.avg(amount).alias("avg_order")
    )
    return (
        users.join(totals, users[user_key] == totals[order_user], "left")
        .drop(order_user)
        .withColumn("order_count", F.coalesce("order_count", F.lit(0).cast("long")))
    )


def unseen_by_hash(batch: DataFrame, known: DataFrame, digest: str, key: str) -> DataFrame:
    """Rows whose content is neither stored nor earlier in the batch."""
    fresh = batch.join(known.select(digest).distinct(), digest, "left_anti")
    return newest_per_key(fresh, [digest], [F.col(key)])


def erase_cascade(key_sets: DataFrame, key: str, tables: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """What is left of each table once the rows of ``key_sets`` are erased.

    The key set is resolved once, before anything is removed, so children of already
    erased parents are found as well.
    """
    keys = key_sets.select(F.col(key).alias("__key")).distinct()
    return {name: df.join(keys, df[column] == keys["__key"], "left_anti") for name, (df, column) in tables.items()}


def visible_rows(rows: DataFrame, row_key: str, grants: DataFrame, principals: DataFrame) -> DataFrame:
    """(principal user, row) pairs allowed by any grant.

    ``grants`` is (row_key, kind, name), ``principals`` is (user_id, kind, name) with one row
    per user, group and role the user holds. One equi-join, no OR condition.
    """
    allowed = grants.join(principals, ["kind", "name"]).select("user_id", row_key).distinct()
    return rows.join(allowed, row_key)


def visible_counts(rows: DataFrame, row_key: str, grants: DataFrame, principals: DataFrame) -> DataFrame:
    """(user_id, visible): how many of ``rows`` each principal user may see; users who see none are absent.

    Rows are numbered densely, and the rows of a grant are bitmaps of 32,768 numbers each. Users who
    hold the same grants are counted once. A set's bitmaps are united number range by number range and
    counted, so no (user, row) pair is made and nothing is deduplicated; a grant that every row or many
    sets have is split over its ranges and over ``UNITED`` sets. Bitmaps move only in as many parts as
    hold ``UNITED`` of them each. ``visible_rows`` gives the rows themselves, for the principals of a request.
    """
    grant = ["kind", "name"]
    numbered = number_values(rows.select(row_key).distinct(), row_key, "__no")
    held = grants.join(numbered, row_key).select(*grant, F.bitmap_bucket_number("__no").alias("__range"), F.bitmap_bit_position("__no").alias("__bit"))
    maps = cut_lineage(held.groupBy(*grant, "__range").agg(F.bitmap_construct_agg("__bit").alias("__map")), "maps")
    ranges = maps.groupBy(*grant).agg(F.count(F.lit(1)).alias("__ranges"))
    users = principals.join(ranges, grant, "left_semi").groupBy("user_id").agg(F.array_sort(F.collect_set(F.struct(*grant))).alias("__held"))
    users = cut_lineage(users.withColumn("__set", F.sha2(F.to_json("__held").cast("binary"), 256)), "users")
    sets = users.groupBy("__set").agg(F.first("__held").alias("__held")).select("__set", F.inline("__held"))
    sizes = sets.groupBy(*grant).agg(F.count(F.lit(1)).alias("__sets")).join(ranges, grant)
    bitmaps, most = sizes.agg(F.sum(F.col("__sets") * F.col("__ranges")), F.max("__sets")).first()
    parts, shares = max(shuffle_width(rows.sparkSession), -(-(bitmaps or 0) // UNITED)), -(-(most or 1) // UNITED)
    share = F.pmod(F.xxhash64("__set"), F.lit(shares)).alias("__share")
    keys = [*grant, "__range", "__share"]
    wanted = sets.join(maps.select(*grant, "__range"), grant).select("*", share).repartition(parts, *keys)
    lying = maps.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))).alias("__share")).repartition(parts, *keys)
    met = wanted.join(lying, keys).select("__set", "__range", "__map").repartition(parts, "__set", "__range")
    united = met.groupBy("__set", "__range").agg(F.bitmap_or_agg("__map").alias("__map"))
    counted = united.groupBy("__set").agg(F.sum(F.bitmap_count("__map")).alias("visible"))
    return users.join(counted, "__set").select("user_id", "visible")


def full_compare(base: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """Both sides of every category, a missing side counting 0."""
    left = base.select(F.col(key).alias("__l"), F.col(value).alias("__b"))
    right = current.select(F.col(key).alias("__r"), F.col(value).alias("__c"))
    return left.join(right, left["__l"].eqNullSafe(right["__r"]), "full").select(
        F.coalesce("__l", "__r").alias(key),
        F.coalesce("__b", F.lit(0.0)).alias("baseline"),
        F.coalesce("__c", F.lit(0.0)).alias("current"),
    )


def unordered_pairs(df: DataFrame, key: str, blocks: int = 8) -> DataFrame:
    """All pairs with left key < right key, as ``a`` and ``b`` structs.

    Rows are dealt to blocks; a pair of blocks is one join key, so the work spreads over
    blocks * blocks tasks by an equi-join instead of a nested loop.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = df.select(row.alias("a"), block.alias("i"), every.alias("j"))
    right = df.select(row.alias("b"), every.alias("i"), block.alias("j"))
    return left.join(right, ["i", "j"]).filter(F.col(f"a.{key}") < F.col(f"b.{key}")).select("a", "b")


# --- grouped reports -------------------------------------------------------


def group_mean_sum_count(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(value).alias("avg_value"), F.sum(value).alias("total_value"), F.count(F.lit(1)).alias("count")
    )


def group_mean_std_count(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sample deviation; a group of one row has none."""
    return df.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("count")
    )


def best_attribute(metric: str, key: str, attribute: str) -> Column:
    """The attribute of the row with the largest metric, the smallest key on ties."""
    return F.min_by(F.col(attribute), F.struct((-F.col(metric)).alias("m"), F.col(key).alias("k")))


def share_of_classes(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """(keys.., label, count, share). The totals are an aggregate of their own, never one task's window."""
    counts = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("count"))
    if not keys:
        whole = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        return counts.withColumn("__n", whole).withColumn("share", F.col("count") / F.col("__n")).drop("__n")
    totals = counts.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(F.sum("count").alias("__n"))
    same = reduce(lambda a, b: a & b, [counts[k].eqNullSafe(totals[f"__k_{k}"]) for k in keys])
    return counts.join(totals, same).select(*keys, label, "count", (F.col("count") / F.col("__n")).alias("share"))


def unpivot_numeric(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """(keep.., column_name, value) rows, one per numeric cell."""
    cells = [F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns]
    return df.select(*(keep or []), F.explode(F.array(*cells)).alias("__s")).select(
        *(keep or []), F.col("__s.c").alias("column_name"), F.col("__s.v").alias("value")
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact linear quartiles and max per column."""
    long = unpivot_numeric(df, columns)
    stats = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = linear_quantiles(long, ["column_name"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("n")
    return stats.join(quartiles, "column_name", "left")


def missing_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with its share of NULLs, and the row ``*`` for the whole table."""
    columns = columns or df.columns
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing"), F.col("__n").alias("cells")) for c in columns]
    cells.append(F.struct(F.lit("*").alias("column_name"), total.alias("missing"), (F.col("__n") * len(columns)).alias("cells")))
    return counts.select(F.explode(F.array(*cells)).alias("s")).select(
        "s.*", F.when(F.col("s.cells") > 0, F.col("s.missing") / F.col("s.cells")).alias("missing_rate")
    )


def infer_contract(df: DataFrame) -> DataFrame:
    """Column name, type and whether a value is always present, from the data."""
    empty = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
            (F.col(f.name) == 0).alias("required"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return empty.select(F.explode(F.array(*cells)).alias("s")).select("s.*")


# --- windows ---------------------------------------------------------------


def rolling_mean(df: DataFrame, keys: list[str], order: str, tie: str, value: str, width: int = 7, name: str = "rolling_mean") -> DataFrame:
    """Mean of the last ``width`` values of the key, NULL until that many are present."""
    numbered = number_rows(df, keys, order, [tie], name="__no")
    blocked, window = with_preceding(numbered, keys, "__no", width - 1)
    frame = window.rowsBetween(-(width - 1), 0)
    full = F.when(F.count(value).over(frame) == width, F.avg(value).over(frame))
    return drop_context(blocked.withColumn(name, full)).drop("__no")


def previous_row(df: DataFrame, keys: list[str], order: str, ties: list[str], value: str, name: str = "previous") -> DataFrame:
    """``lag(value)`` per key without gathering the key in one task."""
    numbered = number_rows(df, keys, order, ties, name="__no")
    blocked, window = with_preceding(numbered, keys, "__no", 1)
    return drop_context(blocked.withColumn(name, F.lag(value).over(window))).drop("__no")


def last_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    if keys:
        return newest_per_key(df, keys, order, n)
    return df.orderBy(*order).limit(n)


def recent_accuracy(df: DataFrame, keys: list[str], order: list[Column], predicted: str, actual: str, n: int = 100) -> DataFrame:
    """Accuracy over the last ``n`` rows that have an actual value; NULL while there are fewer."""
    rows = last_n(df.filter(F.col(actual).isNotNull()), keys, order, n)
    hit = F.avg((F.col(predicted) == F.col(actual)).cast("double"))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("feedback"), F.when(F.count(F.lit(1)) >= n, hit).alias("accuracy")
    )


def superseded_versions(df: DataFrame, name: str, version: str, stage: str, keep: int = 5) -> DataFrame:
    """Versions beyond the newest ``keep`` of each name that are not in production.

    The newest ``keep`` are found by a cut that runs before the shuffle; the rest is an anti join.
    """
    kept = newest_per_key(df.select(name, version), [name], [F.col(version).desc()], keep)
    return df.join(kept, [name, version], "left_anti").filter(F.col(stage) != "Production")


def best_per_id(df: DataFrame, query: str, key: str, score: str, k: int) -> DataFrame:
    """Best-scored row of each (query, id), then the best ``k`` per query."""
    best = newest_per_key(df, [query, key], [F.col(score).desc()])
    return newest_per_key(best, [query], [F.col(score).desc(), F.col(key)], k)


def first_per_id(df: DataFrame, query: str, key: str, arrival: list[str], k: int) -> DataFrame:
    """The first arrival of each (query, id), cut to ``k`` in arrival order."""
    order = [F.col(c) for c in arrival]
    return newest_per_key(newest_per_key(df, [query, key], order), [query], order, k)


# --- order and limit -------------------------------------------------------


def best_qualified(df: DataFrame, keys: list[str], qualified: Column, metric: str, tie: str) -> DataFrame:
    """The best row among those that pass, or the best of all when none does."""
    rows = df.withColumn("qualified", F.coalesce(qualified, F.lit(False)))
    order = [F.col("qualified").desc(), F.col(metric).desc(), F.col(tie)]
    return last_n(rows, keys, order, 1)


def tag_best(df: DataFrame, key: str, metric: str, above: float, at_most: int, tags: str, extra: dict[str, str]) -> DataFrame:
    """Add tags to the best rows above a threshold; all other rows are unchanged."""
    chosen = df.filter(F.col(metric) > above).orderBy(F.col(metric).desc(), key).limit(at_most)
    chosen = chosen.select(F.col(key).alias("__key"))
    new = F.create_map(*[F.lit(x) for kv in extra.items() for x in kv])
    joined = df.join(F.broadcast(chosen), df[key] == chosen["__key"], "left")
    kept = F.map_filter(F.col(tags), lambda k, _: ~k.isin(*extra))
    return joined.withColumn(
        tags, F.when(F.col("__key").isNotNull(), F.map_concat(kept, new)).otherwise(F.col(tags))
    ).drop("__key")


def retention_candidates(df: DataFrame, key: str, status: str, started: str, as_of: str, days: int,
                         metric: str, below: float, tags: str, required_tag: str) -> DataFrame:
    """(key, reason) for runs that failed, are old, score low or lack a tag. Reports only.

    One pass: a run is emitted once per reason. A run without the metric is not "low".
    """
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"interval {days} days")
    reasons = F.array_compact(
        F.array(
            F.when(F.col(status) != "FINISHED", "failed"),
            F.when(F.col(started) < cutoff, "old"),
            F.when(F.col(metric) < below, "low_performance"),
            F.when(F.coalesce(F.col(tags)[required_tag], F.lit(None)).isNull(), "untagged"),
        )
    )
    return df.select(key, F.explode(reasons).alias("reason"))
