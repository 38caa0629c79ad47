"""Queries over classification quality, experiments and significance."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import evaluate as ev
from millrace.plans.registry import query

CLASSES = ["de", "en", "es", "fr"]


def guesses(t):
    """A language guess per document by telling words, and the rule's score per class."""
    has = lambda w: F.contains("text", F.lit(f" {w} "))
    count = lambda w: (F.size(F.split("text", f" {w} ")) - 1).cast("double")
    guess = F.when(has("der"), "de").when(has("el"), "es").when(has("des"), "fr").otherwise("en")
    return t.documents.select(
        "doc_id", "source", F.col("lang").alias("label"), guess.alias("predicted"),
        *[count(w).alias(f"score_{c}") for c, w in zip(CLASSES, ("der", "the", "el", "des"), strict=True)],
    )


GUESSES = """guesses AS (SELECT doc_id, source, lang AS label, CASE WHEN contains(text, ' der ') THEN 'de' WHEN contains(text, ' el ') THEN 'es' WHEN contains(text, ' des ') THEN 'fr' ELSE 'en' END AS predicted,
 len(string_split(text, ' der ')) - 1 AS score_de, len(string_split(text, ' the ')) - 1 AS score_en, len(string_split(text, ' el ')) - 1 AS score_es, len(string_split(text, ' des ')) - 1 AS score_fr FROM documents)"""
PER_CLASS = f"""{GUESSES}, names AS (SELECT label AS class FROM guesses UNION SELECT predicted FROM guesses),
 per AS (SELECT class, count(*) FILTER (WHERE label = class) AS support, count(*) FILTER (WHERE predicted = class) AS guessed, count(*) FILTER (WHERE label = class AND predicted = class) AS hit FROM names, guesses GROUP BY 1),
 pr AS (SELECT class, support, hit, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0.0 END AS "precision", CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS recall FROM per),
 cls AS (SELECT *, CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0.0 END AS f1 FROM pr)"""
SCORES = ["precision", "recall", "f1"]


def rounded(df, *columns, places=9):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("e04_quality_averages", "E4", sql=f"""WITH {PER_CLASS} SELECT round(sum(hit) / sum(support), 9) AS accuracy, {', '.join(f'round(avg("{s}"), 9) AS macro_{s}' for s in SCORES)},
 {', '.join(f'round(sum("{s}" * support) / sum(support), 9) AS weighted_{s}' for s in SCORES)}, sum(support)::BIGINT AS support FROM cls""")
def _(t):
    out = ev.averages(ev.per_class(ev.confusion(guesses(t), "label", "predicted")))
    return rounded(out, *[c for c in out.columns if c != "support"])


@query("e04_binary_quality", "E4", sql="""WITH g AS (SELECT quality AS label, CASE WHEN n_chars > 1200 THEN 1 ELSE 0 END AS predicted FROM labels JOIN documents USING (doc_id)),
 c AS (SELECT count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE predicted = 1) AS pp, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = predicted) / count(*) AS accuracy FROM g)
SELECT round(accuracy, 9) AS accuracy, round(tp / pp, 9) AS "precision", round(tp / p, 9) AS recall, round(2 * (tp / pp) * (tp / p) / (tp / pp + tp / p), 9) AS f1 FROM c""")
def _(t):
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(F.col("quality").alias("label"), (F.col("n_chars") > 1200).cast("int").alias("predicted"))
    classes = ev.per_class(ev.confusion(rows, "label", "predicted"))
    positive = classes.filter(F.col("class") == "1").select("precision", "recall", "f1")
    accuracy = ev.averages(classes).select("accuracy").scalar()
    return rounded(positive.withColumn("accuracy", accuracy), "accuracy", *SCORES)


@query("e05_class_quality", "E5", sql=f"""WITH {PER_CLASS} SELECT class, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM cls""")
def _(t):
    return rounded(ev.per_class(ev.confusion(guesses(t), "label", "predicted")).drop("hit"), *SCORES)


@query("e06_confusion_matrix", "E6", sql=f"WITH {GUESSES} SELECT label, {', '.join(f'count(*) FILTER (WHERE predicted = {c!r}) AS pred_{c}' for c in CLASSES)} FROM guesses GROUP BY 1")
def _(t):
    return ev.confusion_matrix(ev.confusion(guesses(t), "label", "predicted"), CLASSES)


BINARY = "g AS (SELECT quality AS y, n_chars / (n_chars + 2000) AS s FROM labels JOIN documents USING (doc_id))"


def binary(t):
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(F.col("quality").alias("y"), (F.col("n_chars") / (F.col("n_chars") + 2000)).alias("s"))


@query("e07_roc_curve", "E7", sql=f"""WITH {BINARY}, c AS (SELECT s, sum(y) AS p, sum(1 - y) AS n FROM g GROUP BY 1)
SELECT round(s, 9) AS threshold, round(sum(n) OVER w / sum(n) OVER (), 9) AS fpr, round(sum(p) OVER w / sum(p) OVER (), 9) AS tpr FROM c WINDOW w AS (ORDER BY s DESC)""")
def _(t):
    return rounded(ev.roc_curve(binary(t), [], "y", "s"), "threshold", "fpr", "tpr")


@query("e07_auc", "E7", sql=f"""WITH {BINARY}, r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r FROM g)
SELECT sum(y)::BIGINT AS positives, sum(1 - y)::BIGINT AS negatives, round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 9) AS auc FROM r""")
def _(t):
    return rounded(ev.auc(binary(t), [], "y", "s"), "auc")


OVR = f"""{GUESSES}, ovr AS (SELECT unnest(['de', 'en', 'es', 'fr']) AS class, unnest([(label = 'de')::INT, (label = 'en')::INT, (label = 'es')::INT, (label = 'fr')::INT]) AS y, unnest([score_de, score_en, score_es, score_fr]) AS s FROM guesses),
 r AS (SELECT class, y, rank() OVER (PARTITION BY class ORDER BY s) + (count(*) OVER (PARTITION BY class, s) - 1) / 2 AS r FROM ovr),
 a AS (SELECT class, sum(y) AS p, (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) AS auc FROM r GROUP BY 1)"""


@query("e07_auc_one_vs_rest", "E7", sql=f"WITH {OVR} SELECT round(avg(auc), 9) AS macro_auc, round(sum(auc * p) / sum(p), 9) AS weighted_auc FROM a")
def _(t):
    long = ev.one_vs_rest(guesses(t), "label", {c: F.col(f"score_{c}") for c in CLASSES})
    out = ev.auc(long, ["class"], "is_class", "score")
    return out.agg(F.round(F.avg("auc"), 9).alias("macro_auc"), F.round(F.sum(F.col("auc") * F.col("positives")) / F.sum("positives"), 9).alias("weighted_auc"))


@query("e08_classification_report", "E8", sql=f"""WITH {PER_CLASS} SELECT class, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM cls
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 9), sum(support)::BIGINT FROM cls UNION ALL SELECT 'macro avg', {', '.join(f'round(avg("{s}"), 9)' for s in SCORES)}, sum(support)::BIGINT FROM cls
UNION ALL SELECT 'weighted avg', {', '.join(f'round(sum("{s}" * support) / sum(support), 9)' for s in SCORES)}, sum(support)::BIGINT FROM cls""")
def _(t):
    return rounded(ev.classification_report(ev.confusion(guesses(t), "label", "predicted")), *SCORES)


FOLDS = """folds AS (SELECT p_type AS model, p_partkey % 5 AS fold, avg(CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN p_size % 10 > 4 THEN 1.0 ELSE 0.0 END) AS b FROM part GROUP BY 1, 2)"""


def folds(t):
    """Two scores per model and fold."""
    return t.part.groupBy(F.col("p_type").alias("model"), (F.col("p_partkey") % 5).alias("fold")).agg(
        F.avg((F.col("p_size") > 25).cast("double")).alias("a"), F.avg((F.col("p_size") % 10 > 4).cast("double")).alias("b")
    )


@query("e09_fold_summary", "E9", sql=f"WITH {FOLDS} SELECT model, round(avg(a), 9) AS mean, round(stddev_pop(a), 9) AS std, round(min(a), 9) AS min, round(max(a), 9) AS max, count(*) AS folds FROM folds GROUP BY 1")
def _(t):
    return rounded(ev.fold_summary(folds(t), ["model"], "a"), "mean", "std", "min", "max")


@query("e10_paired_t_test", "E10", sql=f"""WITH {FOLDS}, s AS (SELECT model, count(*) AS n, avg(a) AS mean_a, avg(b) AS mean_b, avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))) AS t FROM folds GROUP BY 1)
SELECT model, n, round(mean_a, 9) AS mean_a, round(mean_b, 9) AS mean_b, round(t, 6) AS t, CASE WHEN mean_a > mean_b THEN 'a' ELSE 'b' END AS better FROM s""")
def _(t):
    out = ev.paired_t_test(folds(t), ["model"], "a", "b")
    return rounded(out.withColumn("t", F.round("t", 6)).drop("p_value", "significant"), "mean_a", "mean_b")


# The two-sided 5 % bound of Student's t for the five folds of a model, and the one-sided one of z.
T_BOUND, Z_BOUND = 2.7764451051977987, 1.6448536269514722


@query("e10_paired_t_significance", "E10", sql=f"""WITH {FOLDS}, s AS (SELECT model, count(*) AS n, avg(a) AS mean_a, avg(b) AS mean_b, avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))) AS t FROM folds GROUP BY 1)
SELECT model, n, abs(t) > {T_BOUND} AS significant, CASE WHEN mean_a > mean_b THEN 'a' ELSE 'b' END AS better FROM s""")
def _(t):
    out = ev.paired_t_test(folds(t), ["model"], "a", "b")
    return out.select("model", "n", "significant", "better")


BUCKET = """list_reduce([0, ('0x' || substr(h, 1, 8))::BIGINT, ('0x' || substr(h, 9, 8))::BIGINT, ('0x' || substr(h, 17, 8))::BIGINT, ('0x' || substr(h, 25, 8))::BIGINT], lambda a, x: (a * 4294967296 + x) % 10000)"""
ARMS = f"""arms AS (SELECT event_type, event_id, CASE WHEN {BUCKET} / 10000 < 0.2 THEN 'challenger' ELSE 'champion' END AS arm, value > 40 AS success FROM (SELECT *, md5(event_id || ':rollout') AS h FROM events))"""
TESTED = f"""{ARMS}, c AS (SELECT event_type, count(*) FILTER (WHERE arm = 'champion') AS n1, count(*) FILTER (WHERE arm = 'challenger') AS n2, count(*) FILTER (WHERE arm = 'champion' AND success) AS k1, count(*) FILTER (WHERE arm = 'challenger' AND success) AS k2 FROM arms GROUP BY 1),
 z AS (SELECT *, CASE WHEN n1 > 10 AND n2 > 10 THEN (k2 / n2 - k1 / n1) / sqrt((k1 + k2) / (n1 + n2) * (1 - (k1 + k2) / (n1 + n2)) * (1 / n1 + 1 / n2)) ELSE 0.0 END AS z FROM c)"""


def arms(t):
    rows = ev.split_traffic(t.events, "event_id", "rollout")
    return rows.select("event_type", "event_id", "arm", (F.col("value") > 40).alias("success"))


@query("e11_two_proportion_z", "E11", sql=f"WITH {TESTED} SELECT event_type, n1 AS n_champion, n2 AS n_challenger, round(k1 / n1, 9) AS rate_champion, round(k2 / n2, 9) AS rate_challenger, round(z, 6) AS z FROM z")
def _(t):
    out = ev.two_proportion_test(arms(t), ["event_type"])
    return rounded(out.withColumn("z", F.round("z", 6)).drop("p_value"), "rate_champion", "rate_challenger")


@query("e12_promotion", "E11", "E12", sql=f"WITH {TESTED} SELECT event_type, z > {Z_BOUND} AND k2 / n2 - k1 / n1 >= 0.01 AND n2 >= 100 AS promote FROM z")
def _(t):
    tested = ev.two_proportion_test(arms(t), ["event_type"])
    return ev.should_promote(tested).select("event_type", "promote")


@query("e13_variant_assignment", "E13", sql=f"""SELECT user_id, b AS bucket, CASE WHEN b / 10000 < 0.5 THEN 'a' WHEN b / 10000 < 0.8 THEN 'b' ELSE 'c' END AS variant
FROM (SELECT user_id, {BUCKET} AS b FROM (SELECT DISTINCT user_id, md5(user_id || ':exp') AS h FROM events))""")
def _(t):
    users = t.events.select("user_id").distinct()
    return users.select(
        "user_id", ev.assignment_bucket(F.col("user_id"), "exp").alias("bucket"), ev.assign_variant(F.col("user_id"), "exp", {"a": 0.5, "b": 0.3, "c": 0.2}).alias("variant")
    )


@query("e14_traffic_split", "E14", sql=f"WITH {ARMS} SELECT arm, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM arms GROUP BY 1")
def _(t):
    from millrace.operators.relate import share_of_classes

    out = share_of_classes(arms(t), [], "arm")
    return out.select("arm", F.col("count").alias("n"), F.round("share", 9).alias("share"))


@query("e15_slice_quality", "E15", sql=f"""WITH {GUESSES}, s AS (SELECT source, round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 9) AS accuracy, count(*) AS support FROM guesses GROUP BY 1)
SELECT source, accuracy, round(max(accuracy) OVER () - accuracy, 6) AS gap, support FROM s""")
def _(t):
    out = ev.fairness(guesses(t), "source", "label", "predicted")
    return out.select("source", F.round("accuracy", 9).alias("accuracy"), F.round("gap", 6).alias("gap"), "support")
