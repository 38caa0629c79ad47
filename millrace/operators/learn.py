"""Feature preparation, model training, selection and batch scoring on MLlib."""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import forest
from millrace.operators.ordered import number_values
from millrace.operators.select import hash_share, right_closed_bins
from millrace.session import cut_lineage


def scaling_statistics(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column from one pass; two numbers per column reach the driver."""
    aggs = [x for c in columns for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def standardise(df: DataFrame, columns: list[str], statistics: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(x - mean) / std with the population deviation; a constant column becomes 0."""
    found = statistics or scaling_statistics(df, columns)
    return df.withColumns({
        c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in found.items()
    })


def alphabetical_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code) in byte order of the value, codes from 0, NULL standing as "None"."""
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("value")).distinct()
    return number_values(values, "value", "code")


def label_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column replaced by its alphabetical code."""
    def one(d: DataFrame, c: str) -> DataFrame:
        codes = alphabetical_codes(d, c)
        joined = d.join(codes, F.coalesce(F.col(c).cast("string"), F.lit("None")) == F.col("value"))
        return joined.withColumn(c, F.col("code")).drop("value", "code")

    return reduce(one, columns, df)


def assemble(df: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="keep").transform(df)


def train_test(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    test = hash_share(F.col(key), seed) < int(test_share * 10000)
    return df.filter(~test), df.filter(test)


def training_rows(df: DataFrame, key: str, rows: int, least: int = 2000) -> DataFrame:
    """``df``, of about ``rows`` rows, written out in parts of ``least`` rows or more, one a core at most.

    Training reads its rows many times, on as many cores as they have parts; few columns of a large
    table would come out of a shuffle as one. Parts are by key and in its order, so samples repeat.
    """
    parts = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // least))
    return cut_lineage(df.repartition(parts, key).sortWithinPartitions(key) if parts > 1 else df, "training")


# The deepest tree the library grows: what "no limit" means here.
DEEPEST = 30


def random_forest(trees: int = 100, depth: int | None = 10, seed: int = 42, split: int = 2) -> RandomForestClassifier:
    """``split`` rows are needed to split a node; each side of a split then keeps half of them at least.

    Every row keeps the node it has come to in each tree, so that a pass over the rows neither sends
    the trees grown so far to every task nor walks them from the root; the trees are the same.
    """
    return RandomForestClassifier(
        numTrees=trees, maxDepth=DEEPEST if depth is None else depth, minInstancesPerNode=max(1, split // 2), seed=seed, labelCol="label", featuresCol="features",
        cacheNodeIds=True,
    )


def families(binary: bool = True, trees: int = 100, iterations: int = 1000) -> dict[str, Estimator]:
    """Comparable model families. Boosted trees and the linear SVM are binary, so more classes go one against the rest."""
    boosted = GBTClassifier(maxIter=trees, maxDepth=3, seed=42, labelCol="label")
    margin = LinearSVC(maxIter=iterations, labelCol="label")
    wrap = (lambda c: c) if binary else (lambda c: OneVsRest(classifier=c, labelCol="label"))
    return {
        "random_forest": random_forest(trees), "gradient_boosting": wrap(boosted),
        "logistic_regression": LogisticRegression(maxIter=iterations, labelCol="label"), "linear_svm": wrap(margin),
    }


def fit(estimator: Estimator, train: DataFrame, columns: list[str]) -> PipelineModel:
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep"), estimator]).fit(train)


def quality(model: Model, test: DataFrame) -> dict[str, float]:
    """Accuracy and the class-weighted precision, recall and F1, from one pass that counts (label, prediction)."""
    counts = model.transform(test).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r.n for r in counts)
    hits = {r.label: r.n for r in counts if r.label == r.prediction}
    actual, called = Counter(), Counter()
    for r in counts:
        actual[r.label] += r.n
        called[r.prediction] += r.n
    out = dict.fromkeys(("accuracy", "weightedPrecision", "weightedRecall", "f1"), 0.0)
    for label, n in actual.items():
        hit, share = hits.get(label, 0), n / total
        precision, recall = hit / called[label] if called[label] else 0.0, hit / n
        out["accuracy"] += hit / total
        out["weightedPrecision"] += share * precision
        out["weightedRecall"] += share * recall
        out["f1"] += share * (2 * precision * recall / (precision + recall) if hit else 0.0)
    return out


def compare_families(train: DataFrame, test: DataFrame, columns: list[str], models: dict[str, Estimator]) -> DataFrame:
    """(model, accuracy, f1): one row per family; the best is the first by accuracy, then name."""
    rows = []
    for name, estimator in models.items():
        scores = quality(fit(estimator, train, columns), test)
        rows.append((name, float(scores["accuracy"]), float(scores["f1"])))
    return train.sparkSession.createDataFrame(rows, "model string, accuracy double, f1 double")


# Nodes that MLlib may come to hold on the driver, at some 500 bytes each.
DRIVER_NODES = 1 << 20


def most_nodes(estimator: RandomForestClassifier, rows: int) -> int:
    """What a forest over ``rows`` rows can have: full trees, or a leaf for every few rows that a leaf must have."""
    leaves = max(1, rows // estimator.getMinInstancesPerNode())
    return estimator.getNumTrees() * (2 * min(1 << estimator.getMaxDepth(), leaves) - 1)


def fit_forest(estimator: RandomForestClassifier, train: DataFrame, columns: list[str], rows: int) -> Model | forest.ForestModel:
    """MLlib's forest where the driver can hold all its nodes, else one of the same rules that lies in a table."""
    if most_nodes(estimator, rows) <= DRIVER_NODES:
        return fit(estimator, train, columns)
    return forest.grow(
        train, columns, estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getSeed(), estimator.getMaxBins(),
    )


# The grid of a small search, as (trees, depth, rows needed to split).
SEARCH_GRID = [(10, 3, 2), (50, 5, 2), (100, 10, 5), (200, None, 2), (100, 5, 10)]


def grid_search(train: DataFrame, test: DataFrame, columns: list[str], grid: list[tuple[int, int | None, int]] = SEARCH_GRID) -> DataFrame:
    """Accuracy of every configuration in grid order, the first best one marked."""
    rows, n = [], train.count()
    for i, (trees, depth, split) in enumerate(grid):
        accuracy = quality(fit_forest(random_forest(trees, depth, split=split), train, columns, n), test)["accuracy"]
        rows.append((i, trees, depth, split, float(accuracy)))
    best = max(rows, key=lambda r: (r[4], -r[0]))[0]
    return train.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows], "config int, trees int, depth int, split int, accuracy double, best boolean")


def cross_validate(df: DataFrame, key: str, columns: list[str], estimator: Estimator, grid: list | None = None, folds: int = 5, parallelism: int = 2):
    """A ``CrossValidatorModel`` on hash folds, so that folds repeat; ``avgMetrics`` and
    ``stdMetrics`` hold mean and population deviation of the accuracy per configuration."""
    folded = assemble(df, columns).withColumn("fold", (hash_share(F.col(key)) % folds).cast("int"))
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid or ParamGridBuilder().build(), numFolds=folds, foldCol="fold", parallelism=parallelism,
        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"),
    ).fit(folded)


def fold_accuracies(df: DataFrame, key: str, columns: list[str], estimator: Estimator, folds: int = 5, parallelism: int = 2) -> DataFrame:
    """(fold, accuracy): every hash fold judged by a model fitted on the others. ``parallelism`` models
    are fitted at a time, so that one uses the cores the other leaves; each keeps its rows in memory."""
    folded = df.withColumn("__fold", (hash_share(F.col(key)) % folds).cast("int"))

    def judged(fold: int) -> tuple[int, float]:
        model = fit(estimator.copy(), folded.filter(F.col("__fold") != fold), columns)
        return fold, float(quality(model, folded.filter(F.col("__fold") == fold))["accuracy"])

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(inheritable_thread_target(df.sparkSession)(judged), range(folds)))
    return df.sparkSession.createDataFrame(rows, "fold int, accuracy double")


def score(model: PipelineModel, df: DataFrame, columns: list[str], threshold: float = 0.5) -> DataFrame:
    """Prediction, probability and risk band per row. Missing input columns are an error."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"Missing columns: {lacking}")
    scored = model.transform(df).withColumn("__p", vector_to_array("probability")[1])
    return scored.select(
        *df.columns, (F.col("__p") >= threshold).cast("int").alias("prediction"), F.col("__p").alias("probability"),
        right_closed_bins(F.col("__p"), [0.0, 0.3, 0.7, 1.0], ["low", "medium", "high"]).alias("risk_level"),
    )


def importance(model: PipelineModel, columns: list[str], df: DataFrame) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(columns, values, strict=True), key=lambda r: -r[1])
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def area_under_curve(model: PipelineModel, test: DataFrame) -> float:
    return BinaryClassificationEvaluator(labelCol="label").evaluate(model.transform(test))
