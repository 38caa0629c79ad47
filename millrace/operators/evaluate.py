"""Retrieval quality, classification reports, experiments and significance tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.stats import normal_tail_udf, student_udf
from millrace.operators.chunking import cosine
from millrace.operators.ordered import running_totals

# --- retrieval -------------------------------------------------------------


def retrieval_metrics(hits: DataFrame, relevant: DataFrame, queries: DataFrame, ks: tuple[int, ...] = (3, 5)) -> DataFrame:
    """Per query recall@k, precision@3, reciprocal rank and binary nDCG@5.

    ``hits`` is (query_id, id, rank) with distinct ids, ``relevant`` (query_id, id). A query
    without relevant ids has recall 0 and nDCG 0.
    """
    truth = relevant.select(F.col("query_id").alias("__q"), F.col("id").alias("__i"), F.lit(1).alias("__hit")).distinct()
    totals = relevant.distinct().groupBy("query_id").agg(F.count(F.lit(1)).alias("relevant"))
    judged = hits.join(truth, (F.col("query_id") == F.col("__q")) & (F.col("id") == F.col("__i")), "left")
    hit = F.col("__hit").isNotNull()
    discount = 1.0 / F.log2(F.col("rank") + 1)
    found = judged.groupBy("query_id").agg(
        *[F.count_if(hit & (F.col("rank") <= k)).alias(f"__at_{k}") for k in {*ks, 3}],
        F.min(F.when(hit, F.col("rank"))).alias("__first"),
        F.sum(F.when(hit & (F.col("rank") <= 5), discount).otherwise(0.0)).alias("__dcg"),
    )
    joined = queries.select("query_id").join(totals, "query_id", "left").join(found, "query_id", "left")
    zero = F.lit(0.0)
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("relevant"), F.lit(5)).cast("int")), zero, lambda s, i: s + 1.0 / F.log2(i + 1))
    return joined.select(
        "query_id",
        *[F.coalesce(F.col(f"__at_{k}") / F.col("relevant"), zero).alias(f"recall_{k}") for k in ks],
        F.coalesce(F.col("__at_3") / 3, zero).alias("precision_3"),
        F.coalesce(1 / F.col("__first"), zero).alias("reciprocal_rank"),
        F.when(F.col("relevant") > 0, F.coalesce("__dcg", zero) / ideal).otherwise(0.0).alias("ndcg_5"),
    )


def mean_metrics(per_query: DataFrame) -> DataFrame:
    return per_query.agg(*[F.avg(c).alias(c) for c in per_query.columns if c != "query_id"])


def redundant_neighbours(hits: DataFrame, vectors: DataFrame, limit: float = 0.95) -> DataFrame:
    """Cosine between consecutive hits of a query, and whether they are distinct enough."""
    rows = hits.join(vectors.select("id", F.col("vector").alias("__v")), "id")
    before = F.lag("__v").over(Window.partitionBy("query_id").orderBy("rank"))
    pairs = rows.withColumn("__p", before).filter(F.col("__p").isNotNull())
    return pairs.withColumn("similarity", cosine(F.col("__p"), F.col("__v"))).select(
        "query_id", "rank", "similarity", (F.col("similarity") < limit).alias("diverse")
    )


def coverage(hits: DataFrame, expected: DataFrame, at: int = 10, floor: float = 0.5) -> DataFrame:
    """Share of each query's expected ids among its first ``at`` hits."""
    seen = hits.filter(F.col("rank") <= at).select("query_id", "id", F.lit(1).alias("__hit")).distinct()
    joined = expected.distinct().join(seen, ["query_id", "id"], "left")
    return joined.groupBy("query_id").agg((F.count("__hit") / F.count(F.lit(1))).alias("coverage")).withColumn("passed", F.col("coverage") >= floor)


# --- classification --------------------------------------------------------


def confusion(df: DataFrame, label: str, predicted: str, keys: list[str] | None = None) -> DataFrame:
    """Counts per (keys.., label, predicted): the one aggregation every report starts from."""
    return df.groupBy(*(keys or []), F.col(label).cast("string").alias("label"), F.col(predicted).cast("string").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(counts: DataFrame, classes: list[str]) -> DataFrame:
    """One row per actual class, one column per predicted class, 0 where nothing fell."""
    wide = counts.groupBy("label").pivot("predicted", classes).agg(F.sum("n"))
    return wide.select("label", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"pred_{c}") for c in classes])


def per_class(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """precision, recall, f1 and support of every class seen in either column; 0 on zero division."""
    keys = keys or []
    sides = counts.select(
        *keys, F.explode(F.array(
            F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("guessed"), F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
            F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("guessed"), F.lit(0).cast("long").alias("hit")),
        )).alias("s")
    ).select(*keys, "s.*")
    sums = sides.groupBy(*keys, "class").agg(F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    scored = sums.withColumns({"precision": share("hit", "guessed"), "recall": share("hit", "support")})
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)).select(
        *keys, "class", "precision", "recall", "f1", "support", "hit"
    )


def averages(classes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """accuracy, macro and support-weighted precision, recall and f1 per key."""
    weight = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}")
    return classes.groupBy(*(keys or [])).agg(
        (F.sum("hit") / F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weight(c) for c in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    )


def classification_report(counts: DataFrame) -> DataFrame:
    """Rows for every class, then accuracy, macro and weighted averages."""
    classes = per_class(counts)
    avg = averages(classes)
    rows = classes.select("class", "precision", "recall", "f1", "support")
    cells = [
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"), F.col("support").alias("support")),
        *[
            F.struct(F.lit(f"{kind} avg").alias("class"), F.col(f"{kind}_precision").alias("precision"), F.col(f"{kind}_recall").alias("recall"), F.col(f"{kind}_f1").alias("f1"), F.col("support").alias("support"))
            for kind in ("macro", "weighted")
        ],
    ]
    return rows.unionByName(avg.select(F.explode(F.array(*cells)).alias("s")).select("s.*"))


def roc_curve(df: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """(keys.., threshold, fpr, tpr), one point per distinct score; prediction is score >= threshold."""
    counts = df.groupBy(*keys, score).agg(F.sum(F.col(label).cast("long")).alias("__p"), F.sum(1 - F.col(label).cast("long")).alias("__n"))
    running = running_totals(counts, keys, score, {"__tp": "__p", "__fp": "__n"}, descending=True)
    whole = counts.groupBy(*keys).agg(F.sum("__p").alias("__pos"), F.sum("__n").alias("__neg"))
    joined = running.join(whole, keys) if keys else running.select(
        "*", counts.agg(F.sum("__p").alias("p")).scalar().alias("__pos"), counts.agg(F.sum("__n").alias("n")).scalar().alias("__neg")
    )
    return joined.select(
        *keys, F.col(score).alias("threshold"), ((F.col("__fp") + F.col("__n")) / F.col("__neg")).alias("fpr"), ((F.col("__tp") + F.col("__p")) / F.col("__pos")).alias("tpr")
    )


def auc(df: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """Area under the curve per key: the chance that a positive outranks a negative, ties half."""
    counts = df.groupBy(*keys, score).agg(F.sum(F.col(label).cast("long")).alias("__p"), F.sum(1 - F.col(label).cast("long")).alias("__n"))
    running = running_totals(counts, keys, score, {"__below": "__n"})
    return running.groupBy(*keys).agg(
        F.sum("__p").alias("positives"), F.sum("__n").alias("negatives"),
        (F.sum(F.col("__p") * (F.col("__below") + F.col("__n") / 2)) / (F.sum("__p").cast("double") * F.sum("__n"))).alias("auc"),
    )


def one_vs_rest(df: DataFrame, label: str, scores: dict[str, Column]) -> DataFrame:
    """(class, is_class, score) rows, one per row and class."""
    cells = [F.struct(F.lit(c).alias("class"), (F.col(label) == c).cast("int").alias("is_class"), s.alias("score")) for c, s in scores.items()]
    return df.select(F.explode(F.array(*cells)).alias("s")).select("s.*")


def fairness(df: DataFrame, slice_by: str, label: str, predicted: str) -> DataFrame:
    """Quality per slice, with its distance from the best slice."""
    out = averages(per_class(confusion(df, label, predicted, [slice_by]), [slice_by]), [slice_by])
    return out.withColumn("gap", out.agg(F.max("accuracy").alias("m")).scalar() - F.col("accuracy"))


# --- experiments -----------------------------------------------------------


def variant_results(rows: DataFrame, variants: list[str]) -> DataFrame:
    """count, mean, min and max per variant and metric; variants without rows stay in the report.

    The sample size of a variant is all its metric rows.
    """
    stats = rows.groupBy("variant", "metric").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    sizes = rows.groupBy("variant").agg(F.count(F.lit(1)).alias("sample_size"))
    names = rows.sparkSession.createDataFrame([(v,) for v in variants], "variant string")
    zero = F.lit(0).cast("long")
    return names.join(stats, "variant", "left").join(sizes, "variant", "left").withColumns(
        {"n": F.coalesce("n", zero), "sample_size": F.coalesce("sample_size", zero)}
    )


def assignment_bucket(user: Column, experiment: str) -> Column:
    """md5("user:experiment") as a number modulo 10000, worked out eight hex digits at a time."""
    digest = F.md5(F.concat(user.cast("string"), F.lit(f":{experiment}")))
    out = F.lit(0).cast("long")
    for start in (1, 9, 17, 25):
        out = (out * F.lit(4294967296 % 10000) + F.conv(F.substring(digest, start, 8), 16, 10).cast("long")) % 10000
    return out


def assign_variant(user: Column, experiment: str, weights: dict[str, float]) -> Column:
    """The first variant whose cumulative weight exceeds the user's share; the last takes the rest."""
    if abs(sum(weights.values()) - 1.0) > 0.001:
        raise ValueError(f"variant weights sum to {sum(weights.values())}, not 1")
    share = assignment_bucket(user, experiment) / 10000.0
    names = list(weights)
    out, upto = None, 0.0
    for name in names[:-1]:
        upto += weights[name]
        out = F.when(share < upto, name) if out is None else out.when(share < upto, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


def split_traffic(df: DataFrame, user: str, experiment: str, challenger_share: float = 0.2) -> DataFrame:
    """A repeatable champion / challenger split instead of a random draw."""
    return df.withColumn("arm", assign_variant(F.col(user), experiment, {"challenger": challenger_share, "champion": 1 - challenger_share}))


def fold_summary(scores: DataFrame, keys: list[str], score: str) -> DataFrame:
    """mean, population std, min and max over the folds."""
    return scores.groupBy(*keys).agg(
        F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max"), F.count(score).alias("folds")
    )


def paired_t_test(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """t, two-sided p, significance at 5 % and the side with the larger mean, per key."""
    gap = F.col(a) - F.col(b)
    stats = pairs.groupBy(*keys).agg(F.count(gap).alias("n"), F.avg(gap).alias("__m"), F.stddev_samp(gap).alias("__s"), F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"))
    stats = stats.withColumn("t", F.when(F.col("__s") > 0, F.col("__m") / (F.col("__s") / F.sqrt("n"))))
    return stats.withColumn("p_value", student_udf(F.col("t"), (F.col("n") - 1).cast("double"))).select(
        *keys, "n", "mean_a", "mean_b", "t", "p_value", (F.col("p_value") < 0.05).alias("significant"),
        F.when(F.col("mean_a") > F.col("mean_b"), "a").otherwise("b").alias("better"),
    )


def two_proportion_test(arms: DataFrame, keys: list[str]) -> DataFrame:
    """Pooled one-sided z-test that the challenger succeeds more often.

    ``arms`` has arm ("champion" / "challenger") and success columns. With ten or fewer rows in
    an arm z is 0 and p is 1.
    """
    challenger = F.col("arm") == "challenger"
    stats = arms.groupBy(*keys).agg(
        F.count_if(~challenger).alias("n_champion"), F.count_if(challenger).alias("n_challenger"),
        F.count_if(~challenger & F.col("success")).alias("__h"), F.count_if(challenger & F.col("success")).alias("__c"),
    )
    p1 = F.when(F.col("n_champion") > 0, F.col("__h") / F.col("n_champion")).otherwise(0.0)
    p2 = F.when(F.col("n_challenger") > 0, F.col("__c") / F.col("n_challenger")).otherwise(0.0)
    stats = stats.withColumns({"rate_champion": p1, "rate_challenger": p2})
    pooled = (F.col("__h") + F.col("__c")) / (F.col("n_champion") + F.col("n_challenger"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n_champion") + 1 / F.col("n_challenger")))
    enough = (F.col("n_champion") > 10) & (F.col("n_challenger") > 10)
    z = F.when(enough, F.when(error > 0, (F.col("rate_challenger") - F.col("rate_champion")) / error).otherwise(0.0)).otherwise(0.0)
    stats = stats.withColumn("z", z)
    return stats.withColumn("p_value", F.when(enough, normal_tail_udf(F.col("z"))).otherwise(1.0)).drop("__h", "__c")


def should_promote(tested: DataFrame, gain: float = 0.01, at_least: int = 100, level: float = 0.05) -> DataFrame:
    better = F.col("rate_challenger") - F.col("rate_champion")
    return tested.withColumn(
        "promote", (F.col("p_value") < level) & (better > 0) & (better >= gain) & (F.col("n_challenger") >= at_least)
    )
