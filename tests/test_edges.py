"""Hand-computed edge cases for the rules a plain translation would miss."""

import datetime as dt
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import stats
from millrace.functions import text as tx
from millrace.functions import vectors as vec
from millrace.operators import chunking as ch
from millrace.operators import contracts, drift, evaluate, graph, keywords, learn, memory, metrics, ordered, quality, relate, select
from millrace.operators import vectorsearch as vs
from millrace.sources import tables


def one(df, *exprs):
    return df.select(*exprs).first()


def values(spark, column, *items, kind="string"):
    return spark.createDataFrame([(x,) for x in items], f"{column} {kind}")


# --- bins, ranks, profiles -------------------------------------------------


def test_right_closed_bins(spark):
    df = values(spark, "p", 0.0, 0.3, 0.30001, 0.7, 1.0, 1.1, None, kind="double")
    got = [r[0] for r in df.select(select.right_closed_bins(F.col("p"), [0, 0.3, 0.7, 1.0], ["low", "medium", "high"])).collect()]
    assert got == [None, "low", "medium", "medium", "high", None, None]


def test_null_age_is_senior(spark):
    got = [r[0] for r in values(spark, "a", 24, 25, 40, None, kind="int").select(select.age_group(F.col("a"))).collect()]
    assert got == ["young", "middle", "senior", "senior"]


def test_numeric_profile(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None), (None, None)], "a double, b double")
    rows = {r["column_name"]: r for r in drift.numeric_profile(df, ["a", "b"]).collect()}
    a, b = rows["a"], rows["b"]
    assert (a["count"], a["null_count"], a["mean"], a["std"], a["median"], a["p25"], a["p75"]) == (4, 1, 2.5, 1.118, 2.5, 2.0, 4.0)
    assert b["error"] == "No valid values" and b["mean"] is None


def test_zero_baseline_drift(spark):
    base = drift.numeric_profile(values(spark, "a", 0.0, 0.0, kind="double"), ["a"])
    now = drift.numeric_profile(values(spark, "a", 0.5, 0.5, kind="double"), ["a"])
    rows = {r["metric"]: r for r in drift.numeric_drift(base, now).collect()}
    assert rows["mean"]["change_pct"] == 50.0 and rows["mean"]["drift"] and not rows["std"]["drift"]


def test_new_category_is_drift(spark):
    base, now = values(spark, "c", *"aaab"), values(spark, "c", *"aaabc")
    row = drift.categorical_drift(drift.category_shares(base, ["c"]), drift.category_shares(now, ["c"])).first()
    assert row["new_categories"] == 1 and row["missing_categories"] == 0 and row["drift"] is True


def test_stability_index_with_repeated_edges(spark):
    base = values(spark, "a", *([1.0] * 8 + [2.0] * 2), kind="double")
    now = values(spark, "a", *([1.0] * 2 + [2.0] * 8), kind="double")
    edges = np.percentile([1.0] * 8 + [2.0] * 2, np.linspace(0, 100, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    share = lambda x: (np.histogram(x, bins=edges)[0] + 0.0001) / 10
    b, c = share([1.0] * 8 + [2.0] * 2), share([1.0] * 2 + [2.0] * 8)
    want = float(np.sum((c - b) * np.log(c / b)))
    assert abs(drift.stability_index(base, now, ["a"]).first()["psi"] - want) < 1e-9


def test_severities_compare_by_rank(spark):
    df = values(spark, "s", "none", "critical", "low")
    assert df.agg(F.max_by("s", drift.severity_rank(F.col("s")))).first()[0] == "critical"


def test_smirnov(spark):
    row = one(spark.range(1), drift.smirnov_p_value(F.lit(0.3), F.lit(50), F.lit(50)), drift.smirnov_p_value(F.lit(0.0), F.lit(50), F.lit(50)))
    assert abs(row[0] - 0.022217962616525286) < 1e-12 and row[1] == 1.0


# --- quality ---------------------------------------------------------------


def results(df, *checks):
    return [(r["success"], r["unexpected"]) for r in quality.run_suite(df, list(checks)).orderBy("position").collect()]


def test_uniqueness_modes_and_nulls(spark):
    df = values(spark, "a", 1, 1, 1, 2, None, None, kind="int")
    assert results(df, quality.unique("a"), quality.unique("a", mode="members")) == [(False, 2), (False, 3)]


def test_in_set_null_policy(spark):
    df = values(spark, "a", "x", None, "y")
    assert results(df, quality.in_set("a", ["x", "y"]), quality.in_set("a", ["x", "y"], null_policy="reject")) == [(True, 0), (False, 1)]


def test_empty_table(spark):
    df = values(spark, "a", 1, kind="int").filter("a > 5")
    assert results(df, quality.column_exists("a"), quality.not_null("a"), quality.row_count_between(1, 5), quality.mean_between("a", 0, 9)) == [
        (False, 1), (True, 0), (False, 1), (False, 1)]


def test_nan_is_not_null(spark):
    df = values(spark, "a", float("nan"), float("-inf"), None, 1.0, kind="double")
    assert results(df, quality.finite("a"), quality.not_null("a")) == [(False, 2), (False, 1)]


def test_between_is_inclusive_and_skips_nulls(spark):
    df = values(spark, "a", 1, 5, None, 6, kind="int")
    assert results(df, quality.between("a", 1, 5), quality.between("a", low=2)) == [(False, 1), (False, 1)]


def test_branch(spark, tmp_path):
    df = values(spark, "a", 1, 2, kind="int")
    assert quality.branch(df, [quality.not_null("a")], str(tmp_path), "r1")
    assert not quality.branch(df, [quality.between("a", high=1)], str(tmp_path), "r2")
    assert spark.read.schema("a int").parquet(f"{tmp_path}/quarantine/r2").count() == 2
    with pytest.raises(quality.QualityError):
        quality.branch(df, [quality.between("a", high=1)], str(tmp_path), "r3", on_failure="raise")


def test_input_check(spark):
    from pyspark.sql import types as T

    @quality.check_input(quality.TableSchema({"a": quality.ColumnRule(T.IntegerType(), checks=(lambda c: quality.greater_than(c, 0),))}))
    def double(df):
        return df.select(F.col("a") * 2)

    assert double(values(spark, "a", 1, kind="int")).first()[0] == 2
    with pytest.raises(quality.QualityError):
        double(values(spark, "a", 0, kind="int"))
    with pytest.raises(quality.QualityError):
        double(values(spark, "a", "x"))


# --- event contracts -------------------------------------------------------


def judged(spark, *bodies):
    return contracts.validate_events(values(spark, "body", *bodies), "body").collect()


def test_contract_errors(spark):
    good = '{"event_id": "evt_1", "user_id": 1, "event_type": "signup", "timestamp": "t"}'
    rows = judged(
        spark, good,
        '{"user_id": 0, "event_id": "E 1", "event_type": "view", "timestamp": null, "extra": 1}',
        '{"event_id": "evt_1", "user_id": true, "event_type": "view", "timestamp": "t", "source": "web"}',
        '{"source": null, "event_id": 5, "user_id": 2.5, "event_type": 7, "timestamp": "t"}',
        '{"event_id": "evt_1"', "[1]", '{"event_id": "evt_1", "user_id": false, "event_type": "signup", "timestamp": "t"}',
    )
    assert [r["valid"] for r in rows] == [True, False, True, False, False, False, False]
    assert rows[1]["errors"] == [
        "Field user_id: value 0 below minimum 1",
        "Field event_type: value 'view' not in allowed values ['signup', 'login', 'purchase', 'logout']",
        "Field timestamp: expected string, got NoneType",
    ]
    assert rows[3]["schema_version"] == "v2" and rows[3]["errors"] == [
        "Field source: expected string, got NoneType", "Field source: value 'None' not in allowed values ['web', 'mobile', 'api']",
        "Field event_id: expected string, got int", "Field user_id: expected integer, got float",
        "Field event_type: expected string, got int",
        "Field event_type: value '7' not in allowed values ['signup', 'login', 'purchase', 'logout', 'view']",
    ]
    assert rows[4]["errors"] == ["Not a JSON object"] and rows[5]["errors"] == ["Not a JSON object"]
    assert rows[6]["errors"] == ["Field user_id: value False below minimum 1"]


def test_missing_is_not_null(spark):
    rows = judged(spark, '{"event_id": "e", "user_id": 1, "event_type": "login"}', '{"event_id": "e", "user_id": 1, "event_type": "login", "timestamp": null}')
    assert rows[0]["errors"] == ["Missing required field: timestamp"]
    assert rows[1]["errors"] == ["Field timestamp: expected string, got NoneType"]


def test_signature(spark):
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    assert contracts.enforce_signature(df, "b double, a long").first() == (2.0, 1)
    with pytest.raises(ValueError):
        contracts.enforce_signature(df, "c int")


# --- text ------------------------------------------------------------------


def chunks(spark, text, size, overlap):
    df = spark.createDataFrame([(1, text)], "d long, text string")
    return ch.chunk_documents(df, "d", "text", size, overlap).orderBy("chunk_no").collect()


def test_chunk_overlap(spark):
    rows = chunks(spark, "Aaaa bbbb. Cccc dddd. Eeee ffff.", 20, 5)
    assert [(r["start_char"], r["end_char"], r["content"]) for r in rows] == [
        (0, 21, "Aaaa bbbb. Cccc dddd."), (16, 32, "dddd. Eeee ffff.")]


def test_no_overlap_carries_nothing(spark):
    rows = chunks(spark, "Aaaa. Bbbb. Cccc.", 5, 0)
    assert [r["content"] for r in rows] == ["Aaaa.", "Bbbb.", "Cccc."] and [r["start_char"] for r in rows] == [0, 6, 12]


def test_chunk_ids_stay_distinct(spark):
    rows = chunks(spark, "A. Bbbbbbbbbbbbbbbbbbbbbbbb. C.", 10, 8)
    assert len({r["chunk_id"] for r in rows}) == len(rows) and rows[0]["start_char"] == rows[1]["start_char"]
    assert rows[0]["chunk_id"] == str(uuid.uuid5(uuid.NAMESPACE_DNS, "1:0"))


def test_empty_and_single(spark):
    assert len(chunks(spark, "", 512, 50)) <= 1
    assert [r["content"] for r in chunks(spark, "Only one here.", 512, 50)] == ["Only one here."]


def test_unicode_blanks(spark):
    row = one(values(spark, "t", "A. B. C"), F.size(tx.sentences(F.col("t"))), tx.normalised(F.lit(" X \tY ")))
    assert tuple(row) == (3, "x y")


def test_question_flags(spark):
    df = values(spark, "q", "What about the same thing?", "and then what", "Tell me", "Why? Why?")
    rows = df.select(tx.needs_context(F.col("q")), tx.needs_decomposition(F.col("q"))).collect()
    assert [tuple(r) for r in rows] == [(True, False), (False, True), (False, False), (False, True)]


def test_personal_data(spark):
    text = "Call +1 (310) 555-4510, mail a.b@x.example.com. Card 4111 1111 1111 1111, not 4111 1111 1111 1112; SSN 123-45-6789 at 10.0.0.255."
    row = one(values(spark, "t", text), tx.detect_pii(F.col("t")).alias("p"), tx.mask_pii(F.col("t")).alias("m"))
    assert {p["type"]: p["text"] for p in row["p"]} == {
        "PHONE_NUMBER": "+1 (310) 555-4510", "EMAIL_ADDRESS": "a.b@x.example.com", "CREDIT_CARD": "4111 1111 1111 1111", "US_SSN": "123-45-6789", "IP_ADDRESS": "10.0.0.255"}
    assert all(text[p["start"]:p["end"]] == p["text"] for p in row["p"])
    assert row["m"] == "Call <PHONE_NUMBER>, mail <EMAIL_ADDRESS>. Card <CREDIT_CARD>, not 4111 1111 1111 1112; SSN <US_SSN> at <IP_ADDRESS>."


def test_html(spark):
    page = "<html><style>x{}</style><!-- <b> --><p>A &lt;b&gt; &amp;lt; &#233;&#x1F600;</p><script>1<2</script></html>"
    assert one(values(spark, "h", page), tx.html_to_text(F.col("h")))[0] == "A <b> &lt; é😀"
    table = "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>"
    assert one(values(spark, "h", table), tx.table_to_text(F.col("h")))[0] == "Table with 1 rows and 2 columns.\nColumns: a, b\n\nRow 0: a: 1, b: 2\n"


def test_sections(spark):
    df = spark.createDataFrame([(1, "intro\n# One\ntext\n## Sub\nmore\n# Two\nend")], "d long, text string")
    rows = ch.split_sections(df, "d", "text").orderBy("section_no").collect()
    assert [(r["level"], r["title"], r["path"]) for r in rows] == [(0, "", ""), (1, "One", "One"), (2, "Sub", "One > Sub"), (1, "Two", "Two")]


def test_history_budget_stops_at_the_first_overflow(spark):
    df = spark.createDataFrame([("s", 1, "user", "x"), ("s", 2, "user", "y" * 30), ("s", 3, "user", "zz")], "s string, turn long, role string, text string")
    row = memory.prompt_history(df, "s", "turn", "role", "text", max_tokens=5).first()
    assert row["history"] == "User: zz" and row["lines"] == 1


# --- retrieval -------------------------------------------------------------


def test_zero_vector_stays_zero(spark):
    df = values(spark, "v", [0.0, 0.0], [3.0, 4.0], kind="array<float>")
    assert [r[0] for r in df.select(vec.normalise(F.col("v"))).collect()] == [[0.0, 0.0], [0.6, 0.8]]


def test_mmr_against_brute_force(spark):
    rng = np.random.default_rng(7)
    docs = rng.normal(size=(30, 6))
    query = rng.normal(size=6)
    vectors = spark.createDataFrame([(i, [float(x) for x in d]) for i, d in enumerate(docs)], "id long, vector array<float>")
    queries = spark.createDataFrame([(1, [float(x) for x in query])], "query_id long, vector array<float>")
    hits = vs.cosine_top_k(queries, vectors.withColumnRenamed("id", "chunk_id"), 12)
    got = [r["id"] for r in vs.mmr(hits, queries, vectors, 5, 0.7).orderBy("pick").collect()]
    cos = lambda a, b: float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    left, picked = [r["id"] for r in hits.orderBy("rank").collect()], []
    while len(picked) < 5:
        best = max(left, key=lambda i: 0.7 * cos(query, docs[i]) + 0.3 * (1 - max((cos(docs[i], docs[j]) for j in picked), default=0.0)))
        picked.append(best)
        left.remove(best)
    assert got == picked


def test_query_words_count_with_repeats(spark):
    docs = spark.createDataFrame([(1, "red fox"), (2, "blue fox sky")], "d long, text string")
    index = keywords.KeywordIndex.build(docs, "d", "text")
    score = lambda text: index.search(spark.createDataFrame([(9, text)], "q long, text string"), "q", "text").filter("id = 1").first()["score"]
    assert abs(score("red red") - 2 * score("red")) < 1e-8
    assert index.search(spark.createDataFrame([(9, "the")], "q long, text string"), "q", "text").count() == 0


def test_common_terms_keep_the_floor(spark):
    docs = spark.createDataFrame([(i, "fox") for i in range(50)], "d long, text string")
    assert keywords.KeywordIndex.build(docs, "d", "text").terms().first()["idf"] == 0.25


def test_equal_scores_fuse_to_zero(spark):
    hits = spark.createDataFrame([(1, 10, 0.5, 1), (1, 11, 0.5, 2)], "query_id long, id long, score double, rank int")
    rows = keywords.weighted_fusion({"a": hits}).collect()
    assert [r["score"] for r in rows] == [0.0, 0.0]
    fused = keywords.reciprocal_rank_fusion({"a": hits, "b": hits.filter("id = 11").withColumn("rank", F.lit(1))}).collect()
    assert fused[0]["id"] == 11 and fused[0]["sources"] == {"a": 0.5, "b": 0.5}


def test_upsert_last_write_wins(spark):
    state = spark.createDataFrame([(1, [1.0], 1), (2, None, 1)], "id long, v array<double>, n int")
    batch = spark.createDataFrame([(1, [2.0], 2), (3, None, 2)], "id long, v array<double>, n int")
    assert [(r["id"], r["v"]) for r in vs.upsert(state, batch, "id", "v", "n").collect()] == [(1, [2.0])]


# --- evaluation ------------------------------------------------------------


def test_tail_probabilities(spark):
    assert abs(stats.normal_tail(1.959963984540054) - 0.025) < 1e-12
    assert abs(stats.student_two_sided(2.7764451051977987, 4) - 0.05) < 1e-10
    assert abs(stats.student_two_sided(1.0, 1) - 0.5) < 1e-12


def test_paired_t(spark):
    df = spark.createDataFrame([("m", 0.9, 0.8), ("m", 0.85, 0.8), ("m", 0.95, 0.82), ("m", 0.9, 0.85), ("m", 0.92, 0.81)], "m string, a double, b double")
    row = evaluate.paired_t_test(df, ["m"], "a", "b").first()
    assert abs(row["t"] - 5.41603) < 1e-4 and row["significant"] and row["better"] == "a"


def test_small_arms_are_not_tested(spark):
    df = spark.createDataFrame([("x", "champion", True)] * 10 + [("x", "challenger", False)] * 50, "k string, arm string, success boolean")
    row = evaluate.should_promote(evaluate.two_proportion_test(df, ["k"])).first()
    assert (row["z"], row["p_value"], row["promote"]) == (0.0, 1.0, False)


def test_assignment(spark):
    import hashlib

    df = values(spark, "u", "u1", "u2", "alice")
    got = [r[0] for r in df.select(evaluate.assignment_bucket(F.col("u"), "exp")).collect()]
    assert got == [int(hashlib.md5(f"{u}:exp".encode()).hexdigest(), 16) % 10000 for u in ("u1", "u2", "alice")]
    with pytest.raises(ValueError):
        evaluate.assign_variant(F.col("u"), "exp", {"a": 0.5, "b": 0.4})


def test_no_relevant_documents(spark):
    hits = spark.createDataFrame([(1, 5, 1)], "query_id long, id long, rank int")
    row = evaluate.retrieval_metrics(hits, hits.select("query_id", "id").filter("id < 0"), hits.select("query_id")).first()
    assert (row["recall_3"], row["reciprocal_rank"], row["ndcg_5"]) == (0.0, 0.0, 0.0)


# --- joins, state, graph, cost ---------------------------------------------


def test_as_of_ties_and_ttl(spark):
    ts = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    ents = spark.createDataFrame([(1, "k", ts(100)), (2, "k", ts(160)), (3, "k", ts(161)), (4, "z", ts(5)), (5, "k", ts(99))], "id int, k string, t timestamp")
    feats = spark.createDataFrame([("k", ts(100), ts(1), 1), ("k", ts(100), ts(2), 2)], "k string, e timestamp, c timestamp, v int")
    for bucket in (7, 1000):
        out = ordered.as_of_join(ents, feats, "k", "t", "e", ["v"], "c", ttl_seconds=60, bucket_seconds=bucket)
        assert {r["id"]: r["v"] for r in out.collect()} == {1: 2, 2: 2, 3: None, 4: None, 5: None}


def test_retention_needs_the_metric(spark):
    df = spark.createDataFrame([(1, "FINISHED", dt.datetime(2024, 1, 1), None, {"a": "1"})], "id int, s string, t timestamp, m double, tags map<string,string>")
    got = [r["reason"] for r in relate.retention_candidates(df, "id", "s", "t", "2024-01-02", 90, "m", 0.5, "tags", "b").collect()]
    assert got == ["untagged"]


def test_true_mention_count(spark):
    df = spark.createDataFrame([("c1", 1, "Ada", "PERSON"), ("c0", 4, "Ada", "NAME"), ("c2", 0, "Ada", "X")], "chunk_id string, position int, entity string, type string")
    assert tuple(graph.merge_entities(df).first()) == ("Ada", "NAME", 3)


def test_cycles_end(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "input string, output string")
    rows = graph.impact(values(spark, "start", "a"), edges).collect()
    assert sorted((r["dataset"], r["depth"]) for r in rows) == [("b", 1), ("c", 2)]


def test_related_is_undirected_and_bounded(spark):
    edges = spark.createDataFrame([("b", "R", "a"), ("b", "R", "c"), ("c", "S", "d")], "src string, label string, dst string")
    rows = graph.related(values(spark, "start", "a"), edges, 2).collect()
    assert sorted((r["name"], r["distance"]) for r in rows) == [("b", 1), ("c", 2)]


def test_cost_scenarios(spark):
    df = spark.createDataFrame(
        [(100, "groq-8b", 0.3, 500_000, True), (1000, "groq-70b", 0.5, 5_000_000, True), (10000, "gpt-3.5", 0.7, 50_000_000, True)],
        "queries_per_day long, model string, cache_hit_rate double, total_vectors long, managed boolean",
    ).withColumns({"avg_input_tokens": F.lit(2000), "avg_output_tokens": F.lit(500)})
    got = [r["total_monthly_cost"] for r in metrics.monthly_model(df).orderBy("queries_per_day").collect()]
    assert got == [95.29, 248.63, None]


def test_quantile_beyond_the_last_bound(spark):
    df = values(spark, "v", 1.0, 2.0, 50.0, 60.0, kind="double")
    hist = metrics.histogram(df.withColumn("k", F.lit(1)), ["k"], "v", [2.0, 4.0])
    assert metrics.histogram_quantile(hist, ["k"], 0.95).first()["quantile"] == 4.0
    assert metrics.histogram_quantile(hist, ["k"], 0.25).first()["quantile"] == 1.0


def test_label_encoding_names_null(spark):
    df = values(spark, "c", "b", None, "a", "Z")
    codes = {r["value"]: r["code"] for r in learn.alphabetical_codes(df, "c").collect()}
    assert codes == {"None": 0, "Z": 1, "a": 2, "b": 3}


def test_snapshots_are_never_replaced(spark, tmp_path):
    df = values(spark, "a", 1, kind="int")
    tables.publish_snapshot(df, str(tmp_path), "20240101_000000")
    with pytest.raises(Exception, match="(?i)exist"):
        tables.publish_snapshot(df, str(tmp_path), "20240101_000000")


def test_staging_is_kept_when_checks_fail(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.345)], "id long, value double")
    tables.stage(df, f"{tmp_path}/s", "b1", "2024-01-01", "value")
    ddl = "id long, value decimal(10,2), created_at timestamp"
    kept = tables.clean_staging(spark, f"{tmp_path}/s", ddl, "b1", "2024-03-01", f"{tmp_path}/o1", checks_passed=False)
    gone = tables.clean_staging(spark, f"{tmp_path}/s", ddl, "b1", "2024-03-01", f"{tmp_path}/o2")
    assert kept.count() == 1 and gone.count() == 0


def test_versions(spark, tmp_path):
    df = spark.range(100).repartition(7)
    tables.register_version(df, str(tmp_path), "v1")
    tables.register_version(df.repartition(2).orderBy(F.col("id").desc()), str(tmp_path), "v2")
    prints = {r["fingerprint"] for r in tables.manifest(spark, str(tmp_path)).collect()}
    assert len(prints) == 1 and tables.read_version(spark, str(tmp_path), "v1").count() == 100


def test_corpus(spark, tmp_path):
    import hashlib

    from millrace.sources import files

    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("héllo\nworld", encoding="utf-8")
    (tmp_path / "sub" / "b.md").write_text("# T", encoding="utf-8")
    rows = {r["filename"]: r for r in files.load_corpus(spark, str(tmp_path)).collect()}
    assert rows["a.txt"]["content"] == "héllo\nworld" and rows["b.md"]["type"] == "md"
    assert rows["a.txt"]["id"] == hashlib.md5(str(tmp_path / "a.txt").encode()).hexdigest()[:12]
    (tmp_path / "c.exe").write_text("x")
    with pytest.raises(Exception, match="unsupported file type"):
        files.load_corpus(spark, str(tmp_path)).collect()
    assert files.load_corpus(spark, str(tmp_path), on_unknown="skip").count() == 2


def test_text_ids(spark):
    """Chunk ids are text; ties go to the smaller one."""
    chunks = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("c", [0.0, 1.0])], "chunk_id string, vector array<float>")
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<float>")
    for blocks in (None, 2):
        rows = vs.cosine_top_k(queries, chunks, 2, dimensions=2, blocks=blocks).orderBy("rank").collect()
        assert [(r["id"], r["score"]) for r in rows] == [("a", 1.0), ("b", 1.0)]
    docs = spark.createDataFrame([("x", "red fox"), ("y", "")], "d string, text string")
    index = keywords.KeywordIndex.build(docs, "d", "text")
    assert index.search(spark.createDataFrame([("q", "fox")], "q string, text string"), "q", "text").first()["id"] == "x"
    assert {r["doc"]: r["doc_len"] for r in index.documents.collect()} == {"x": 2, "y": 0}


# --- answers that used to be cut -------------------------------------------


def test_lineage_goes_to_its_end(spark):
    edges = spark.createDataFrame([(f"d{i}", f"d{i + 1}") for i in range(13)] + [("d13", "d4")], "input string, output string")
    starts = spark.createDataFrame([("d0",)], "start string")
    assert {r.dataset: r.depth for r in graph.impact(starts, edges).collect()} == {f"d{i}": i for i in range(1, 14)}
    with pytest.raises(ValueError, match="deeper"):
        graph.impact(starts, edges, max_depth=5)


def test_malformed_vectors_are_reported_not_contagious(spark):
    from millrace.operators import vectorsearch as vs

    chunks = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0, 1.0]), (4, None)], "chunk_id long, vector array<double>")
    queries = spark.createDataFrame([(7, [1.0, 0.1]), (8, [1.0, 2.0, 3.0])], "query_id long, vector array<double>")
    got = vs.cosine_top_k(queries, chunks, 2).collect()
    assert [(r.query_id, r.id) for r in sorted(got, key=lambda r: r["rank"])] == [(7, 1), (7, 2)]
    assert vs.vector_dimension(chunks, "vector") == 2
    assert {(r.chunk_id, r.size) for r in vs.rejected_vectors(chunks, "chunk_id", "vector", 2).collect()} == {(3, 3), (4, None)}


def test_codes_of_values_with_a_long_common_prefix(spark):
    from millrace.operators import learn

    df = spark.range(3000).select(F.concat(F.lit("https://example.org/a/very/long/prefix/"), (F.col("id") * 7919 % 3000).cast("string")).alias("v"))
    codes = learn.alphabetical_codes(df, "v")
    assert [r.value for r in codes.orderBy("code").collect()] == sorted(r.v for r in df.collect())
    spread = ordered_sizes(codes, df)
    assert max(spread) < 3000 / 3


def ordered_sizes(codes, df):
    """Rows per range that the numbering made."""
    ranged = df.repartitionByRange(16, "v").groupBy(F.spark_partition_id()).count()
    return [r["count"] for r in ranged.collect()]


def test_entities_are_decoded_once(spark):
    from millrace.functions.text import unescape

    given = ["caf&eacute;", "&#x10FFFF;", "&#38;lt;", "&amp;amp;", "&nosuch; &#0; a & b", None, ""]
    want = ["caf\u00e9", "\U0010ffff", "&lt;", "&amp;", "&nosuch; \ufffd a & b", None, ""]
    df = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    assert [r.u for r in df.orderBy("i").select(unescape(F.col("t")).alias("u")).collect()] == want


def test_sixth_category_is_no_drift(spark):
    rows = lambda counts: spark.createDataFrame([(c,) for c, n in counts.items() for _ in range(n)], "c string")
    base = {"a": 60, "b": 50, "c": 40, "d": 30, "e": 20, "f": 19}
    now = {**base, "f": 21}
    row = drift.categorical_drift(drift.category_shares(rows(base), ["c"]), drift.category_shares(rows(now), ["c"])).first()
    assert (row["new_categories"], row["missing_categories"], row["drift"]) == (0, 0, False)


def test_event_ids_as_validation_takes_them(spark):
    from millrace.operators import contracts

    event = '{"event_id": "evt_1", "user_id": %s, "event_type": "login", "timestamp": "2024-01-01T00:00:00Z"}'
    df = spark.createDataFrame([(v, event % v) for v in ("true", "12", "12345678901234567890", "2.5")], "v string, body string")
    judged = {r.v: r["errors"] for r in contracts.validate_events(df, "body").collect()}
    assert judged["true"] == judged["12"] == judged["12345678901234567890"] == []
    assert judged["2.5"] == ["Field user_id: expected integer, got float"]
    ids = {r.v: r.user_id for r in contracts.upgrade(contracts.validate_events(df, "body"), "body").collect()}
    assert ids == {"true": 1, "12": 12, "12345678901234567890": None}


@pytest.mark.parametrize(("text", "ids"), [
    ("metrics.a > 0.5", [1]), ("metrics.a != 0.9 OR tags.t = 'x' AND params.p IN ('1', '2')", [1, 2]), ("params.p >= 10", [3]),
    ("tags.t LIKE 'y%' and attributes.id < 3", [2]), ("tags.`odd name` = 'it''s'", [3]), ("metrics.none = 1", []), ("params.p NOT IN ('1')", [2, 3]),
])
def test_run_filters(spark, text, ids):
    from millrace.operators.runfilter import run_filter

    rows = [(1, {"a": 0.9}, {"t": "x"}, {"p": "1"}), (2, {"a": 0.1}, {"t": "yes"}, {"p": "abc"}), (3, {}, {"odd name": "it's"}, {"p": "10"})]
    df = spark.createDataFrame(rows, "id int, metrics map<string,double>, tags map<string,string>, params map<string,string>")
    assert [r.id for r in df.filter(run_filter(text)).orderBy("id").collect()] == ids


@pytest.mark.parametrize("text", ["", "metrics.a >", "metrics.a > 1 XOR tags.t = 'x'", "other.a = 1", "metrics.a > 1 AND"])
def test_run_filter_errors(text):
    from millrace.operators.runfilter import run_filter

    with pytest.raises(ValueError):
        run_filter(text)


def test_alerts_wait_for_their_hold_time(spark):
    from millrace.operators import metrics

    rules = [("Hot", "temp", ">", 1.0, "warning", 10), ("Cold", "temp", "<", 0.0, "warning", 0)]
    series = lambda values: spark.createDataFrame([("temp", 60 * 5 * i, float(v)) for i, v in enumerate(values)], "metric string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
    state = lambda values: {r.alert: r.state for r in metrics.alert_states(series(values), rules).collect()}
    assert state([2, 0, 2, 2]) == {"Hot": "pending", "Cold": "inactive"}
    assert state([0, 2, 2, 2]) == {"Hot": "firing", "Cold": "inactive"}
    assert state([2, 2, 2, -1]) == {"Hot": "inactive", "Cold": "firing"}
