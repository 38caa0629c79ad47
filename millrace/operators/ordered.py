"""Ordered computations that stay parallel when one key holds a third of the rows.

A plain ``over (partition by key order by x)`` sends a whole key to one task. Everything
here splits a key along the order column first: rows get a bucket from equi-depth edges
(one bounded sketch over the table), the window runs inside
(key, bucket), and a small per-(key, bucket) aggregate carries totals across buckets.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage, shuffle_width

_B = "__bucket"
#: Rows of a bucket, about, and buckets at most.
ROWS_OF_BUCKET, MOST_BUCKETS = 1_000_000, 20_000


def bucket_by_order(df: DataFrame, order: str, buckets: int | None = None, name: str = _B) -> DataFrame:
    """Add an order-preserving bucket number: x <= y implies bucket(x) <= bucket(y).

    Edges come from one ``percentile_approx`` sketch over the same frame, so any group's
    share of a bucket is at most the bucket's depth. There are four buckets for every shuffle partition,
    or as many as ``ROWS_OF_BUCKET`` asks for where that is more, by the sketch's own count. Only the
    edges (one double per bucket) reach the driver; the bucket of a row is found by binary search in
    the JVM.
    """
    def sketch(count: int) -> tuple[int, list]:
        points = [i / count for i in range(1, count)]
        value = F.col(order).cast("double")
        return tuple(df.agg(F.count(value), F.percentile_approx(value, points, 20 * count)).first())

    count = buckets or max(16, 4 * shuffle_width(df.sparkSession))
    rows, edges = sketch(count)
    wanted = min(MOST_BUCKETS, -(-rows // ROWS_OF_BUCKET))
    if buckets is None and wanted > count:
        _, edges = sketch(wanted)
    edges = edges or []
    inner = sorted({float(e) for e in edges if e is not None and not math.isnan(e) and not math.isinf(e)})
    splits = [-math.inf, *(inner or [0.0]), math.inf]
    finder = Bucketizer(splits=splits, inputCol="__order", outputCol="__found", handleInvalid="keep")
    found = finder.transform(df.withColumn("__order", F.col(order).cast("double")))
    return found.withColumn(name, F.coalesce(F.col("__found").cast("int"), F.lit(-1))).drop("__order", "__found")


_REPEATED_WORK = re.compile(r"\b(Join|Aggregate|Window|Generate|Expand|Sort|Repartition\w*|Rebalance\w*|MapIn\w+|FlatMap\w+|\w*EvalPython)\b")


def evaluated_once(df: DataFrame) -> DataFrame:
    """A frame that may be read several times: as it is if that only repeats a scan, else written once."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return cut_lineage(df, "once") if _REPEATED_WORK.search(plan) else df


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__r_{k}"]) for k in keys])


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: str,
    sums: dict[str, str],
    ties: list[str] | None = None,
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Add, for every ``new: column`` in ``sums``, the sum of ``column`` over the rows of the
    same key that come strictly before this row in (``order``, ``ties``) order.

    The rows are read for the edges, for the totals and for the result; work behind them is done once."""
    df = evaluated_once(df)
    bucketed = bucket_by_order(df, order, buckets)
    across = Window.partitionBy(*keys).orderBy(F.col(_B).desc() if descending else F.col(_B))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    totals = bucketed.groupBy(*keys, _B).agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    totals = totals.select(
        *[F.col(k).alias(f"__r_{k}") for k in [*keys, _B]],
        *[F.sum(f"__t_{n}").over(before).alias(f"__base_{n}") for n in sums],
    )
    ordering = [F.col(c).desc() if descending else F.col(c) for c in [order, *(ties or [])]]
    inside = Window.partitionBy(*keys, _B).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    joined = bucketed.join(totals, _null_safe(bucketed, totals, [*keys, _B]), "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.coalesce(F.col(f"__base_{n}"), F.lit(0))).alias(n)
            for n, c in sums.items()
        ],
    )


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: str,
    ties: list[str] | None = None,
    name: str = "row_no",
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """``row_number()`` per key, from 1, without gathering a key in one task."""
    counted = running_totals(
        df.withColumn("__one", F.lit(1).cast("long")), keys, order, {name: "__one"}, ties, descending, buckets
    )
    return counted.drop("__one").withColumn(name, F.col(name) + 1)


def number_values(df: DataFrame, value: str, name: str, first: int = 0) -> DataFrame:
    """Number rows by ``value``, from ``first``, on its full length: one range exchange, counts of the
    ranges, and numbers inside each. ``value`` holds each value once."""
    ranged = df.repartitionByRange(max(16, 4 * shuffle_width(df.sparkSession)), value).withColumn("__range", F.spark_partition_id())
    written = cut_lineage(ranged, "ranges")
    counts = written.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__range").orderBy(value)
    numbered = written.withColumn("__at", F.row_number().over(inside)).join(bases, "__range")
    return numbered.select(*df.columns, (F.col("__at") + F.col("__base") + (first - 1)).alias(name))


def with_preceding(df: DataFrame, keys: list[str], row_no: str, width: int, block: int = 4096) -> tuple[DataFrame, object]:
    """Cut each numbered key into blocks, copying the last ``width`` rows of a block into the next.

    Returns the frame and the window to use on it; rows with ``__context`` true are copies
    and must be dropped after the window has been applied.
    """
    block = max(block, width)
    position = F.col(row_no) - 1
    own = F.floor(position / block)
    copies = F.when(
        position % block >= block - width,
        F.array(F.struct(own.alias("b"), F.lit(False).alias("c")), F.struct((own + 1).alias("b"), F.lit(True).alias("c"))),
    ).otherwise(F.array(F.struct(own.alias("b"), F.lit(False).alias("c"))))
    blocked = df.withColumn("__copy", F.explode(copies)).select(
        *df.columns, F.col("__copy.b").alias("__block"), F.col("__copy.c").alias("__context")
    )
    return blocked, Window.partitionBy(*keys, "__block").orderBy(row_no)


def drop_context(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("__context")).drop("__block", "__context")


def values_at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict, buckets: int | None = None) -> DataFrame:
    """Per key the values at given zero-based ranks, exactly. ``ranks`` maps a name to a function from
    the key's size (a Column) to the rank.

    A selection, not a sort: rows are counted per (key, bucket), the buckets that hold a wanted rank
    are found from the counts, and only their rows are looked at again, as counts per value.
    """
    bucketed = bucket_by_order(df.filter(F.col(value).isNotNull()).select(*keys, value), value, buckets)
    counts = bucketed.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__size", F.sum("__n").over(whole)).withColumn("__below", F.coalesce(F.sum("__n").over(before), F.lit(0)))

    def hit(name: str, rank) -> Column:
        at = F.least(rank(F.col("__size")), F.col("__size") - 1).cast("long") - F.col("__below")
        return F.when((at >= 0) & (at < F.col("__n")), F.struct(F.lit(name).alias("name"), at.alias("at")))

    wanted = counts.select(
        *[F.col(k).alias(f"__r_{k}") for k in [*keys, _B]], "__size", F.array_compact(F.array(*[hit(n, r) for n, r in ranks.items()])).alias("__hits")
    ).filter(F.size("__hits") > 0)
    near = bucketed.join(wanted, _null_safe(bucketed, wanted, [*keys, _B]))
    values = near.groupBy(*keys, _B, value).agg(F.count(F.lit(1)).alias("__n"), F.any_value("__size").alias("__size"), F.any_value("__hits").alias("__hits"))
    inside = Window.partitionBy(*keys, _B).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = values.withColumn("__before", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    met = lambda x: (x["at"] >= F.col("__before")) & (x["at"] < F.col("__before") + F.col("__n"))
    found = placed.withColumn("__names", F.transform(F.filter("__hits", met), lambda x: x["name"]))
    return found.groupBy(*keys).agg(
        F.max("__size").alias("n"), *[F.max(F.when(F.array_contains("__names", name), F.col(value))).alias(name) for name in ranks]
    )


def value_at_rank(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float], buckets: int | None = None) -> DataFrame:
    """The index rule ``sorted(v)[int(p * n)]`` for each ``name: p``, exactly: neither the
    interpolating nor the inverse-distribution percentile."""
    ranks = {n: (lambda size, p=p: F.floor(size * F.lit(float(p)))) for n, p in fractions.items()}
    return values_at_ranks(df, keys, value, ranks, buckets)


def linear_quantiles(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float], buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between the two neighbouring ranks.

    ``percentile`` gives the same numbers but keeps every distinct value in one task's buffer.
    """
    ranks = {}
    for n, p in fractions.items():
        ranks[f"__lo_{n}"] = lambda size, p=p: F.floor((size - 1) * F.lit(float(p)))
        ranks[f"__hi_{n}"] = lambda size, p=p: F.ceil((size - 1) * F.lit(float(p)))
    found = values_at_ranks(df, keys, value, ranks, buckets)

    def between(n: str, p: float) -> Column:
        at = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"__lo_{n}").cast("double"), F.col(f"__hi_{n}").cast("double")
        return (low + (high - low) * (at - F.floor(at))).alias(n)

    return found.select(*keys, "n", *[between(n, p) for n, p in fractions.items()])


def average_rank(df: DataFrame, keys: list[str], value: str, name: str = "rank", buckets: int | None = None) -> DataFrame:
    """Rank of ``value`` within the key, ascending, ties sharing their mean rank."""
    counts = cut_lineage(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), "counts")
    ranked = running_totals(counts, keys, value, {"__before": "__n"}, buckets=buckets)
    ranked = ranked.select(
        *[F.col(k).alias(f"__r_{k}") for k in [*keys, value]],
        (F.col("__before") + (F.col("__n") + 1) / 2).alias(name),
    )
    return df.join(ranked, _null_safe(df, ranked, [*keys, value])).select(*df.columns, name)


#: Rows of one key that may share a time bucket before narrower buckets are taken.
BUCKET_ROWS = 200_000
WIDTHS = (86400, 3600, 600, 60, 10, 1)


def fitting_width(df: DataFrame, keys: list[Column], seconds: Column, widths: list[int], rows: int | None = None) -> int:
    """The widest of the given bucket widths with which no key has more than ``rows`` rows in a bucket,
    or the narrowest. One aggregate that combines per task for each width tried; the first nearly always fits."""
    limit = BUCKET_ROWS if rows is None else rows
    for width in widths[:-1]:
        counts = df.groupBy(*keys, F.floor(seconds / width)).agg(F.count(F.lit(1)).alias("__n"))
        if (counts.agg(F.max("__n")).first()[0] or 0) <= limit:
            return width
    return widths[-1]


def trailing_range(
    df: DataFrame,
    key: str,
    seconds: str,
    value: str,
    windows: dict[str, int],
    bucket_seconds: int | None = None,
) -> DataFrame:
    """For every row the count, sum and max of ``value`` over the same key in [t - length, t].

    Buckets are an hour wide, or as narrow as the busiest key needs (see ``fitting_width``).

    ``seconds`` is the row's time as seconds (double or long). A window is put together from
    three parts: the row's own bucket up to the row, whole buckets in between from a small
    aggregate, and the far bucket from the row's offset on. The far part is read from copies
    moved ahead by the window length, so no task ever holds more than a bucket per copy.
    """
    if bucket_seconds is None:
        fitting = [w for w in WIDTHS if w <= 3600 and all(length % w == 0 for length in windows.values())]
        bucket_seconds = fitting_width(df, [F.col(key)], F.col(seconds), fitting)
    for length in windows.values():
        if length % bucket_seconds:
            raise ValueError("window lengths must be whole numbers of buckets")
    cols = df.columns
    bucket = F.floor(F.col(seconds) / bucket_seconds).cast("long")
    base = df.withColumn(_B, bucket)
    parts = base.groupBy(key, _B).agg(
        F.count(value).alias("__c"), F.sum(value).alias("__s"), F.max(value).alias("__m")
    )
    names = list(windows)
    middle_cols = []
    for name in names:
        span = windows[name] // bucket_seconds
        if span > 1:
            between = Window.partitionBy(key).orderBy(_B).rangeBetween(-(span - 1), -1)
            middle_cols += [
                F.sum("__c").over(between).alias(f"__mc_{name}"),
                F.sum("__s").over(between).alias(f"__ms_{name}"),
                F.max("__m").over(between).alias(f"__mm_{name}"),
            ]
        else:
            middle_cols += [
                F.lit(None).cast("long").alias(f"__mc_{name}"),
                F.lit(None).cast("double").alias(f"__ms_{name}"),
                F.lit(None).cast("double").alias(f"__mm_{name}"),
            ]
    middle = parts.select(F.col(key).alias(f"__r_{key}"), F.col(_B).alias(f"__r_{_B}"), *middle_cols)

    copies = F.array(
        F.struct(F.lit("").alias("w"), F.lit(0).cast("long").alias("shift")),
        *[F.struct(F.lit(n).alias("w"), F.lit(windows[n]).cast("long").alias("shift")) for n in names],
    )
    moved = base.withColumn("__copy", F.explode(copies)).withColumn("__w", F.col("__copy.w"))
    moved = moved.withColumn("__at", F.col(seconds) + F.col("__copy.shift")).withColumn(
        _B, F.floor(F.col("__at") / bucket_seconds).cast("long")
    )
    inside = Window.partitionBy(key, _B)
    upto = inside.orderBy("__at").rangeBetween(Window.unboundedPreceding, 0)
    after = inside.orderBy(F.col("__at").desc()).rangeBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("__w") == "", F.col(value))
    moved = moved.select(
        "*",
        F.count(own).over(upto).alias("__oc"),
        F.sum(own).over(upto).alias("__os"),
        F.max(own).over(upto).alias("__om"),
        *[
            agg(F.when(F.col("__w") == n, F.col(value))).over(after).alias(f"__{tag}_{n}")
            for n in names
            for tag, agg in (("fc", F.count), ("fs", F.sum), ("fm", F.max))
        ],
    ).filter(F.col("__w") == "")
    joined = moved.join(middle, (moved[key].eqNullSafe(middle[f"__r_{key}"])) & (moved[_B] == middle[f"__r_{_B}"]), "left")
    zero = F.lit(0)
    out = []
    for n in names:
        out += [
            (F.col("__oc") + F.coalesce(F.col(f"__mc_{n}"), zero) + F.coalesce(F.col(f"__fc_{n}"), zero)).alias(f"count_{n}"),
            (F.coalesce(F.col("__os"), zero) + F.coalesce(F.col(f"__ms_{n}"), zero) + F.coalesce(F.col(f"__fs_{n}"), zero)).alias(f"sum_{n}"),
            F.greatest("__om", f"__mm_{n}", f"__fm_{n}").alias(f"max_{n}"),
        ]
    return joined.select(*cols, *out)


def as_of_join(
    entities: DataFrame,
    features: DataFrame,
    key: str,
    entity_ts: str,
    feature_ts: str,
    columns: list[str],
    created_ts: str | None = None,
    ttl_seconds: int | None = None,
    bucket_seconds: int | None = None,
    entity_id: str | None = None,
) -> DataFrame:
    """Point-in-time join: per entity row the newest feature row at or before its time.

    Equal event times are settled by the newest ``created_ts``. With a TTL, a feature older
    than that is NULL. Feature and entity rows of one (key, time bucket) meet in one window;
    the newest feature of earlier buckets reaches a bucket as one carried row. Buckets are a day
    wide, or as narrow as the busiest key needs. Entities without a key meet nothing and no window.
    """
    entity_cols = entities.columns
    micros = lambda c: F.unix_micros(F.col(c))
    if bucket_seconds is None:
        keyed = lambda df, ts: df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), (micros(ts) / 1_000_000).alias("s"))
        both = keyed(entities, entity_ts).unionByName(keyed(features, feature_ts))
        bucket_seconds = fitting_width(both, [F.col("k")], F.col("s"), list(WIDTHS))
    width = bucket_seconds * 1_000_000
    payload = F.struct(
        micros(feature_ts).alias("__fts"),
        (micros(created_ts) if created_ts else F.lit(0).cast("long")).alias("__cts"),
        *[F.col(c) for c in columns],
    )
    feats = features.filter(F.col(key).isNotNull() & F.col(feature_ts).isNotNull()).select(
        F.col(key).alias("__k"), micros(feature_ts).alias("__t"), payload.alias("__f")
    )
    unkeyed = entities.filter(F.col(key).isNull())
    ents = entities.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__k"), micros(entity_ts).alias("__t"), F.struct(*[F.col(c) for c in entity_cols]).alias("__e")
    )
    bucket = F.floor(F.col("__t") / width).cast("long").alias(_B)
    feats = feats.select("*", bucket)
    ents = ents.select("*", bucket)
    newest = feats.groupBy("__k", _B).agg(F.max("__f").alias("__f"))
    wanted = ents.groupBy("__k", _B).agg(F.count(F.lit(1)).alias("__n")).select("__k", _B)
    marks = newest.withColumn("__want", F.lit(False)).unionByName(
        wanted.withColumn("__f", F.lit(None).cast(newest.schema["__f"].dataType)).withColumn("__want", F.lit(True))
    )
    earlier = Window.partitionBy("__k").orderBy(_B).rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        marks.withColumn("__c", F.max("__f").over(earlier))
        .filter(F.col("__want") & F.col("__c").isNotNull())
        .select("__k", F.col("__c.__fts").alias("__t"), F.col("__c").alias("__f"), _B)
    )
    rows = feats.unionByName(carried).withColumn("__e", F.lit(None).cast(ents.schema["__e"].dataType)).unionByName(
        ents.withColumn("__f", F.lit(None).cast(newest.schema["__f"].dataType))
    )
    # RANGE up to the current row takes in every feature with the same event time.
    sofar = Window.partitionBy("__k", _B).orderBy("__t").rangeBetween(Window.unboundedPreceding, 0)
    matched = rows.withColumn("__m", F.max("__f").over(sofar)).filter(F.col("__e").isNotNull())
    fresh = F.col("__m").isNotNull()
    if ttl_seconds is not None:
        fresh = fresh & (F.col("__t") - F.col("__m.__fts") <= ttl_seconds * 1_000_000)
    clash = set(entity_cols)
    shown = {c: c if c not in clash else f"feature_{c}" for c in columns}
    met = matched.select(
        *[F.col(f"__e.{c}").alias(c) for c in entity_cols], *[F.when(fresh, F.col(f"__m.{c}")).alias(shown[c]) for c in columns]
    )
    return met.unionByName(unkeyed.select(*entity_cols, *[F.lit(None).cast(met.schema[shown[c]].dataType).alias(shown[c]) for c in columns]))
