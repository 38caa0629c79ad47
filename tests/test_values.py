"""Values of queries that SQL cannot repeat, and of operators whose way was changed for large tables."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import mask_pii
from millrace.operators import chunking, features, learn, ordered, relate, select
from millrace.plans import REGISTRY
from millrace.plans.learning import FEATURES, labelled
from millrace.plans.texting import markdown
from millrace.session import Tables


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    return labelled(Tables(spark, sf_dir)).cache()


def test_importances_sum_to_one_and_repeat(spark, sf_dir):
    first, again = (REGISTRY["m04_random_forest"](spark, sf_dir).collect() for _ in range(2))
    assert first == again and {r.feature for r in first} == set(FEATURES)
    assert abs(sum(r.importance for r in first) - 1) < 1e-4
    assert [r.importance for r in first] == sorted((r.importance for r in first), reverse=True)
    assert all(0 <= first[0][name] <= 1 for name in ("accuracy", "weightedPrecision", "weightedRecall", "f1"))


def test_families_are_judged_on_rows_they_have_not_seen(spark, data):
    train, test = learn.train_test(data, "customer_id")
    assert train.join(test, "customer_id").isEmpty() and train.count() + test.count() == data.count()
    rows = {r.model: r for r in learn.compare_families(train, test, FEATURES, learn.families(trees=3, iterations=20)).collect()}
    assert set(rows) == {"random_forest", "gradient_boosting", "logistic_regression", "linear_svm"}
    shares = [r["count"] for r in test.groupBy("label").count().collect()]
    assert max(r.accuracy for r in rows.values()) >= max(shares) / sum(shares) - 0.1


def test_the_first_best_configuration_is_marked(spark, data):
    train, test = learn.train_test(data, "customer_id")
    rows = learn.grid_search(train, test, FEATURES, [(2, 1, 2), (3, 4, 2), (3, 4, 2)]).collect()
    assert [r.config for r in rows if r.best] == [min(r.config for r in rows if r.accuracy == max(x.accuracy for x in rows))]
    assert rows[1].accuracy == rows[2].accuracy


def test_fold_accuracies(spark, sf_dir, data):
    folds = learn.fold_accuracies(data, "customer_id", FEATURES, learn.random_forest(5, 4))
    values = [r.accuracy for r in folds.collect()]
    assert len(values) == 5 and all(0 <= v <= 1 for v in values)
    model = learn.cross_validate(data, "customer_id", FEATURES, learn.random_forest(5, 4))
    assert abs(sum(values) / 5 - model.avgMetrics[0]) < 1e-9
    row = REGISTRY["e09_cross_validation"](spark, sf_dir).first()
    assert row["min"] <= row["mean"] <= row["max"] and row["folds"] == 5 and (row["std"] > 0) == (row["min"] < row["max"])


def test_scored_rows_are_in_their_band(spark, sf_dir, data):
    rows = REGISTRY["m07_batch_scoring"](spark, sf_dir).collect()
    assert len(rows) == data.count()
    for r in rows:
        assert r.prediction == (r.probability >= 0.5) or abs(r.probability - 0.5) < 1e-6
        # Bands are closed on the right: a probability of exactly 0 is in none.
        assert r.risk_level is not None or r.probability == 0
        assert r.risk_level is None or r.risk_level == ("low" if r.probability <= 0.3 else "medium" if r.probability <= 0.7 else "high") or min(abs(r.probability - x) for x in (0.3, 0.7)) < 1e-6


def test_section_chunks_are_the_chunks_of_their_sections(spark, sf_dir):
    pages = markdown(Tables(spark, sf_dir))
    got = {}
    for r in chunking.chunk_sections(pages, "page_id", "md", 120, 20).collect():
        got.setdefault((r.page_id, r.section_no), []).append((r.chunk_no, r.content))
    sections = chunking.split_sections(pages, "page_id", "md")
    alone = sections.select(F.concat_ws("/", "page_id", "section_no").alias("k"), "page_id", "section_no", "content")
    want = {}
    for r in chunking.chunk_documents(alone, "k", "content", 120, 20, ["page_id", "section_no"]).collect():
        want.setdefault((r.page_id, r.section_no), []).append((r.chunk_no, r.content))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    text = {(r.page_id, r.section_no): re.sub(r"\s+", " ", r.content).strip() for r in sections.collect()}
    for place, chunks in got.items():
        assert all(re.sub(r"\s+", " ", c).strip() in text[place] for _, c in chunks)


def test_a_valid_number_inside_a_longer_one_stays(spark):
    text = "pay 4111111111111111 now, not 94111111111111111234567 or 4111111111111112; again 4111111111111111"
    row = spark.createDataFrame([(text,), ("none",), ("",), (None,)], "t string").select(mask_pii(F.col("t")).alias("m")).collect()
    masked = row[0].m
    assert masked.count("<CREDIT_CARD>") == 2 and "94111111111111111234567" in masked and masked.startswith("pay <CREDIT_CARD> now")
    assert [r.m for r in row[1:]] == ["none", "", None]


@pytest.mark.parametrize("n", [0, 1, 37, 499, 500, 900])
def test_exact_sample(spark, n):
    rows = spark.range(500).select((F.col("id") * 7).alias("k"), "id")
    got = sorted(r.k for r in select.exact_sample(rows, "k", n).collect())
    assert got == sorted(sorted(range(0, 3500, 7), key=lambda k: (hashlib.md5(f"{k}:42".encode()).hexdigest(), k))[:n])


def test_work_behind_running_totals_is_done_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(ordered, "cut_lineage", lambda df, name: written.append(name) or df)
    rows = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), F.lit(1).alias("v"))
    ordered.running_totals(rows, ["k"], "o", {"t": "v"})
    assert written == []
    ordered.running_totals(rows.groupBy("k", "o").agg(F.sum("v").alias("v")), ["k"], "o", {"t": "v"})
    assert written == ["once"]


def test_buckets_follow_the_rows(spark, monkeypatch):
    rows = spark.range(4000)
    few = ordered.bucket_by_order(rows, "id").select("__bucket").distinct().count()
    monkeypatch.setattr(ordered, "ROWS_OF_BUCKET", 20)
    many = ordered.bucket_by_order(rows, "id")
    assert many.select("__bucket").distinct().count() > 4 * few
    assert many.groupBy("__bucket").count().agg(F.max("count")).first()[0] < 100


def test_history_of_a_busy_key(spark, monkeypatch):
    """A third of the rows in one key and day: the feature path takes narrower buckets by itself."""
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 60)
    tried = []
    fitting = ordered.fitting_width
    monkeypatch.setattr(ordered, "fitting_width", lambda *a, **k: tried.append(fitting(*a, **k)) or tried[-1])
    rows = spark.range(1500).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.timestamp_seconds(F.col("id") * 40).alias("ts"), (F.col("id") * 2).alias("x"))
    view = features.FeatureView("f", "k", "ts", ("x",), ttl_seconds=3600)
    entities = rows.filter("id % 2 = 1").select("id", "k", "ts")
    got = {r.id: r.f__x for r in features.historical_features(entities, "ts", [(view, rows.filter("id % 2 = 0"))]).collect()}
    last, want = {}, {}
    for i in range(1500):
        k = 0 if i % 3 == 0 else i % 50
        if i % 2 == 0:
            last[k] = i
        else:
            want[i] = last[k] * 2 if k in last and (i - last[k]) * 40 <= 3600 else None
    assert got == want and tried[0] < 86400


def test_visible_counts_are_those_of_the_pairs(spark):
    rows = spark.range(70_000).select((F.col("id") * 1_000_003 - 5).alias("d"))
    grants = rows.select("d", F.explode(F.array(F.struct(F.lit("all").alias("kind"), F.lit("x").alias("name")), F.struct(F.lit("u").alias("kind"), (F.col("d") % 7).cast("string").alias("name")))).alias("g")).select("d", "g.*")
    grants = grants.filter("kind = 'u' OR d % 3 = 0").unionByName(spark.createDataFrame([(-1, "u", "1")], "d long, kind string, name string"))
    principals = spark.createDataFrame([(1, "all", "x"), (1, "u", "2"), (2, "u", "3"), (2, "u", "4"), (3, "u", "none"), (4, "u", "2"), (4, "u", "2")], "user_id long, kind string, name string")
    pairs = relate.visible_rows(rows, "d", grants, principals).groupBy("user_id").count()
    got = {r.user_id: r.visible for r in relate.visible_counts(rows, "d", grants, principals).collect()}
    assert got == {r.user_id: r["count"] for r in pairs.collect()} and set(got) == {1, 2, 4}


def test_visible_counts_of_equal_sets_are_made_once(spark, monkeypatch):
    monkeypatch.setattr(relate, "UNITED", 2)
    rows = spark.range(70000).withColumnRenamed("id", "d")
    grants = rows.selectExpr("d", "'group' AS kind", "CAST(d % 3 AS STRING) AS name").union(rows.filter("d < 10").selectExpr("d", "'user'", "CAST(d AS STRING)"))
    principals = spark.range(40).selectExpr("id AS user_id", "explode(array(named_struct('kind', 'group', 'name', CAST(id % 4 AS STRING)), named_struct('kind', 'user', 'name', CAST(id AS STRING)))) AS p").select("user_id", "p.*")
    principals = principals.union(principals.filter("user_id = 1")).union(spark.sql("SELECT CAST(NULL AS BIGINT), 'group', '1'"))
    out = relate.visible_counts(rows, "d", grants, principals)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[__set#\d+, __range#\d+L?\], .*bitmap_or_agg", plan)
    size = lambda g: len(range(g, 70000, 3))
    want = {u: size(u % 4) + (u < 10 and u % 3 != u % 4) if u % 4 < 3 else int(u < 10) for u in range(40)}
    assert {r.user_id: r.visible for r in out.collect()} == {None: size(1), **{u: n for u, n in want.items() if n}}
