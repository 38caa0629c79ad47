"""Results do not depend on the partitioning, nor on one key holding a third of the rows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered, relate, vectorsearch


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: key 0 holds every third one and 300 of its rows share one value."""
    rows = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(40)) + 1).alias("k"),
        F.when(F.col("id") % 30 == 0, 7).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500))).cast("double").alias("v"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(90 * 86400))).alias("s"),
    )
    return rows


@pytest.fixture(params=[1, 4, 32])
def width(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_row_numbers(skewed, width):
    out = ordered.number_rows(skewed, ["k"], "v", ["id"]).toPandas().sort_values(["k", "v", "id"])
    assert (out.groupby("k").cumcount() + 1 == out["row_no"]).all()


def test_descending_totals(skewed, width):
    out = ordered.running_totals(skewed, ["k"], "v", {"before": "v"}, ties=["id"], descending=True).toPandas()
    out = out.sort_values(["k", "v", "id"], ascending=[True, False, False])
    assert ((out.groupby("k")["v"].cumsum() - out["v"]) - out["before"]).abs().max() < 1e-6


def test_ranks_and_quantiles(skewed, width):
    pdf = skewed.toPandas()
    ranks = ordered.average_rank(skewed, ["k"], "v").toPandas().set_index("id")["rank"]
    want = pdf.set_index("id").groupby("k")["v"].rank()
    assert (ranks.sort_index() == want.sort_index()).all()
    found = ordered.value_at_rank(skewed, ["k"], "v", {"p": 0.95}).toPandas().set_index("k")["p"]
    exact = pdf.groupby("k")["v"].apply(lambda v: sorted(v)[int(len(v) * 0.95)])
    assert (found.sort_index() == exact.sort_index()).all()
    linear = ordered.linear_quantiles(skewed, [], "v", {"q": 0.37}).first()["q"]
    assert abs(linear - pdf["v"].quantile(0.37)) < 1e-9


def test_rank_rule_is_not_a_percentile(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    row = ordered.value_at_rank(df, [], "v", {"a": 0.25, "b": 0.5}).first()
    assert (row["a"], row["b"], row["n"]) == (25.0, 50.0, 100)


@pytest.mark.parametrize("bucket", [3600, 86400])
def test_trailing_range(skewed, width, bucket):
    out = ordered.trailing_range(skewed, "k", "s", "v", {"7d": 7 * 86400, "1d": 86400}, bucket).toPandas()
    pdf = skewed.toPandas()
    for row in out[out["id"] % 97 == 0].itertuples():
        for name, length in (("7d", 7 * 86400), ("1d", 86400)):
            part = pdf[(pdf["k"] == row.k) & (pdf["s"] <= row.s) & (pdf["s"] >= row.s - length)]["v"]
            assert getattr(row, f"count_{name}") == len(part)
            assert abs(getattr(row, f"sum_{name}") - part.sum()) < 1e-6
            assert getattr(row, f"max_{name}") == part.max()


def test_as_of(spark, skewed, width):
    stamped = skewed.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")))
    entities, features = stamped.filter("id % 2 = 0").select("id", "k", "ts"), stamped.filter("id % 2 = 1").select("k", "ts", "v")
    out = ordered.as_of_join(entities, features, "k", "ts", "ts", ["v"], ttl_seconds=2 * 86400, bucket_seconds=40000).toPandas()
    left = entities.toPandas().sort_values("ts")
    right = features.toPandas().groupby(["k", "ts"], as_index=False)["v"].max().sort_values("ts")
    want = pd.merge_asof(left, right, on="ts", by="k", tolerance=pd.Timedelta(days=2)).set_index("id")["v"]
    got = out.set_index("id")["v"]
    assert len(got) == len(want)
    assert (got.sort_index().fillna(-1) == want.sort_index().fillna(-1)).all()


def test_preceding_rows_cross_blocks(skewed, width):
    numbered = ordered.number_rows(skewed, ["k"], "s", ["id"], name="no")
    blocked, window = ordered.with_preceding(numbered, ["k"], "no", 6, block=8)
    out = ordered.drop_context(blocked.withColumn("m", F.sum("v").over(window.rowsBetween(-6, 0)))).toPandas().sort_values(["k", "no"])
    want = out.groupby("k")["v"].rolling(7, min_periods=1).sum().to_numpy()
    assert abs(out["m"].to_numpy() - want).max() < 1e-6


def test_shares(skewed, width):
    out = relate.share_of_classes(skewed, [], "k").toPandas()
    assert abs(out["share"].sum() - 1) < 1e-9 and out.set_index("k")["count"][0] == 1000


def test_vector_search_paths_agree(spark, width):
    rows = spark.range(400).select(
        "id", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: (F.pmod(F.xxhash64(F.col("id") % 150, i), F.lit(2001)) - 1000).cast("float")).alias("vector")
    )
    chunks = rows.withColumn("vector", F.when(F.col("id") % 50 != 0, F.col("vector"))).withColumnRenamed("id", "chunk_id")
    queries = rows.filter("id < 20").withColumnRenamed("id", "query_id")
    sent = vectorsearch.cosine_top_k(queries, chunks, 6).collect()
    blocked = vectorsearch.cosine_top_k(queries, chunks, 6, dimensions=8, blocks=3).collect()
    assert sorted(map(tuple, sent)) == sorted(map(tuple, blocked))
    import numpy as np

    c = {r["chunk_id"]: np.array(r["vector"], dtype="float64") for r in chunks.collect() if r["vector"] is not None}
    for q in queries.collect():
        v = np.array(q["vector"], dtype="float64")
        cos = {i: round(float(v @ x / np.linalg.norm(v) / np.linalg.norm(x)), 9) for i, x in c.items()}
        want = sorted(cos, key=lambda i: (-cos[i], i))[:6]
        got = [r["id"] for r in sorted(sent, key=lambda r: r["rank"]) if r["query_id"] == q["query_id"]]
        assert got == want


def test_a_busy_hour_is_split(spark, monkeypatch):
    """A third of the rows in one key and hour: narrower buckets, the same answer."""
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"),
                                    F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") * 700).alias("s"), (F.col("id") % 11).cast("double").alias("v"))
    want = ordered.trailing_range(rows, "k", "s", "v", {"w": 7200}).toPandas().sort_values("id").reset_index(drop=True)
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 50)
    assert ordered.fitting_width(rows, [F.col("k")], F.col("s"), [3600, 600, 60, 10, 1]) == 60
    got = ordered.trailing_range(rows, "k", "s", "v", {"w": 7200}).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want)


def test_entities_without_a_key_meet_nothing(spark):
    ts = lambda c: F.timestamp_seconds(c)
    entities = spark.createDataFrame([(1, "a", 100), (2, None, 100)], "id long, k string, s long").withColumn("ts", ts("s"))
    features = spark.createDataFrame([("a", 50, 7), (None, 50, 8)], "k string, s long, x long").withColumn("fts", ts("s"))
    got = ordered.as_of_join(entities, features.select("k", "fts", "x"), "k", "ts", "fts", ["x"])
    assert {r.id: r.x for r in got.collect()} == {1: 7, 2: None}
