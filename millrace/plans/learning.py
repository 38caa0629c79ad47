"""Queries over feature preparation, models and user code. Customers are labelled by top-quartile spend."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from millrace.operators import learn as ml
from millrace.operators import usercode as uc
from millrace.operators.ordered import linear_quantiles
from millrace.plans.registry import query
from millrace.plans.views import CUSTOMER_ACTIVITY, customer_activity
from millrace.session import cut_lineage

FEATURES = ["c_acctbal", "total_purchases", "tenure_days", "days_since_last", "tickets", "segment_code"]


def labelled(t):
    """Customers with encoded segment and label; written out once, as every training pass reads it.
    So is their activity, which the quantile of the label reads several times."""
    rows = cut_lineage(customer_activity(t).withColumn("segment_code", F.length("c_mktsegment")), "activity")
    cut = linear_quantiles(rows.select("total_spend"), [], "total_spend", {"q": 0.75}).select("q").scalar()
    rows = rows.select("*", (F.col("total_spend") >= cut).cast("double").alias("label"))
    return ml.training_rows(rows.fillna(0, ["tenure_days", "days_since_last"]), "customer_id", t.customer.count())


@query("m01_standard_scaling", "M1", sql="SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 9) AS p_size, round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) AS p_retailprice FROM part")
def _(t):
    out = ml.standardise(t.part, ["p_size", "p_retailprice"])
    return out.select("p_partkey", F.round("p_size", 9).alias("p_size"), F.round("p_retailprice", 6).alias("p_retailprice"))


@query("m02_label_encoding", "M2", sql="SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand, dense_rank() OVER (ORDER BY coalesce(CASE WHEN p_size < 40 THEN p_type END, 'None')) - 1 AS p_type FROM part")
def _(t):
    rows = t.part.select("p_partkey", "p_brand", F.when(F.col("p_size") < 40, F.col("p_type")).alias("p_type"))
    return ml.label_encode(rows, ["p_brand", "p_type"]).select("p_partkey", "p_brand", "p_type")


@query("m03_vector_assembly", "M3", sql=f"WITH {CUSTOMER_ACTIVITY} SELECT customer_id, round(c_acctbal + total_purchases + tickets, 6) AS total FROM activity")
def _(t):
    from pyspark.ml.functions import vector_to_array

    rows = ml.assemble(customer_activity(t), ["c_acctbal", "total_purchases", "tickets"])
    parts = vector_to_array("features")
    return rows.select("customer_id", F.round(parts[0] + parts[1] + parts[2], 6).alias("total"))


@query("m04_random_forest", "M4", "M8")
def _(t):
    data = labelled(t)
    train, test = ml.train_test(data, "customer_id")
    model = ml.fit(ml.random_forest(100, 10, 42), train, FEATURES)
    scores = ml.quality(model, test)
    table = ml.importance(model, FEATURES, data)
    return table.select("feature", F.round("importance", 6).alias("importance"), *[F.lit(round(v, 6)).alias(k) for k, v in scores.items()])


@query("m05_model_families", "M5")
def _(t):
    train, test = ml.train_test(labelled(t), "customer_id")
    return ml.compare_families(train, test, FEATURES, ml.families())


@query("m06_grid_search", "M6")
def _(t):
    train, test = ml.train_test(labelled(t), "customer_id")
    return ml.grid_search(train, test, FEATURES)


@query("m07_batch_scoring", "M7", "P6")
def _(t):
    data = labelled(t)
    model = ml.fit(LogisticRegression(maxIter=50, labelCol="label"), ml.train_test(data, "customer_id")[0], FEATURES)
    out = ml.score(model, data, FEATURES)
    return out.select("customer_id", "prediction", F.round("probability", 6).alias("probability"), "risk_level")


@query("e09_cross_validation", "E9")
def _(t):
    folds = ml.fold_accuracies(labelled(t), "customer_id", FEATURES, ml.random_forest())
    return folds.agg(
        F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("std"), F.min("accuracy").alias("min"), F.max("accuracy").alias("max"),
        F.count(F.lit(1)).cast("int").alias("folds"),
    )


@query("k03_feature_function", "K3", "J9", sql=f"WITH {CUSTOMER_ACTIVITY} SELECT customer_id, round(c_acctbal / (total_spend + 1), 9) AS balance_to_spend, CASE WHEN total_purchases / 10 > 0.8 THEN 1 ELSE 0 END::BIGINT AS is_loyal FROM activity")
def _(t):
    @uc.feature_function(["c_acctbal", "total_spend", "total_purchases"], "balance_to_spend double, is_loyal long")
    def derived(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "balance_to_spend": frame["c_acctbal"] / (frame["total_spend"] + 1), "is_loyal": (frame["total_purchases"] / 10 > 0.8).astype("int64"),
        })

    return derived(customer_activity(t)).select("customer_id", F.round("balance_to_spend", 9).alias("balance_to_spend"), "is_loyal")


class Logistic(uc.BatchModel):
    """A fixed logistic model, loaded on the executor."""

    inputs = ["total_purchases", "tickets"]
    outputs = "prediction int, probability double"

    def load(self) -> None:
        self.weights = np.array([0.2, 0.1])

    def predict(self, frame: pd.DataFrame) -> pd.DataFrame:
        p = 1 / (1 + np.exp(-(frame.to_numpy(dtype="float64") @ self.weights - 2)))
        return pd.DataFrame({"prediction": (p >= 0.5).astype("int32"), "probability": p})


@query("k04_custom_model", "K4", "M7", sql=f"WITH {CUSTOMER_ACTIVITY}, p AS (SELECT customer_id, 1 / (1 + exp(-(0.2 * total_purchases + 0.1 * tickets - 2))) AS p FROM activity) SELECT customer_id, (p >= 0.5)::INT AS prediction, round(p, 9) AS probability FROM p")
def _(t):
    out = uc.apply_model(customer_activity(t).select("customer_id", "total_purchases", "tickets"), Logistic())
    return out.select("customer_id", "prediction", F.round("probability", 9).alias("probability"))
