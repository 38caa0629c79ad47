"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host with its subdomains and a start of the path; the longest fitting rule decides.
URLs that a rule decides are the labelled ones. From all of them come the suffix statistics (how many
URLs share the last one or two labels of the host, and how often these are blocked); the trees are fitted on at most ``FIT_ROWS`` of them, drawn by hash, with
lengths, depth, digit share, entropy, parameter counts and these statistics. Every URL that no rule
fits gets the trees' verdict.

Defined results: a null url, or one without ``://``, has an empty host and path; no rule fits it and
the trees judge it; with labelled URLs of one verdict only, that verdict holds for the rest, and
without any the rest is allowed; repeated rows are judged each.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

ALLOW, BLOCK = "allow", "block"
#: Suffixes with at least this share of all URLs are joined where the URLs lie.
HOT_SHARE = 1 / 1024
FIT_ROWS = 20_000
TREES, DEPTH = 20, 4
#: Weight of the overall block rate in a suffix's rate, in URLs.
PRIOR = 20.0


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The text of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    chars = F.split(text, "")

    def of(cs: Column) -> Column:
        size = F.size(cs).cast("double")
        share = lambda c: F.size(F.filter(cs, lambda x: x == c)) / size
        return F.aggregate(F.array_distinct(cs), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))

    return F.when(F.length(text) > 0, F.get(F.transform(F.array(chars), of), F.lit(0))).otherwise(0.0)


def _count(text: Column, character: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))).cast("double")


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    body = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(body, r"(?s)\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(body, r"[^0-9]", "")).cast("double")
    return {
        "url_length": F.length(body).cast("double"), "host_length": F.length(host).cast("double"), "path_length": F.length(path).cast("double"),
        "depth": _count(path, "/"), "labels": _count(host, "."), "hyphens": _count(body, "-"),
        "digit_share": digits / F.greatest(F.length(body), F.lit(1)),
        "host_digits": F.length(F.regexp_replace(host, r"[^0-9]", "")).cast("double"),
        "parameters": F.when(query != "", _count(query, "&") + 1).otherwise(0.0), "query_length": F.length(query).cast("double"),
        "fragment": F.when(F.contains(body, F.lit("#")), 1.0).otherwise(0.0), "entropy": _entropy(body), "host_entropy": _entropy(host),
    }


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def _suffix_tables(judged: DataFrame) -> tuple[dict[int, DataFrame], float]:
    """Per number of labels: block rate and log count by suffix, and whether the suffix is ``hot``."""
    rate, rows = judged.agg(F.avg("label"), F.count(F.lit(1))).first()
    base = 0.0 if rate is None else rate
    tables = {}
    for labels in (1, 2):
        grouped = judged.groupBy(_suffix(F.col("host"), labels).alias(f"s{labels}")).agg(
            F.coalesce(F.sum("label"), F.lit(0.0)).alias("b"), F.count("label").alias("n"), (F.count(F.lit(1)) >= rows * HOT_SHARE).alias("hot")
        )
        tables[labels] = grouped.select(
            f"s{labels}", ((F.col("b") + PRIOR * base) / (F.col("n") + PRIOR)).alias(f"rate_{labels}"), F.log1p("n").alias(f"count_{labels}"), "hot"
        )
    return tables, base


def _with_suffix(urls: DataFrame, table: DataFrame, labels: int, base: float) -> DataFrame:
    """Hot suffixes (at most 1 / ``HOT_SHARE``) by broadcast, the others by a join that hot ones stay out of."""
    suffix, names = f"s{labels}", [f"rate_{labels}", f"count_{labels}"]
    hot = table.filter("hot").select(suffix, *(F.col(n).alias(f"hot_{n}") for n in names))
    out = urls.withColumn(suffix, _suffix(F.col("host"), labels)).join(F.broadcast(hot), suffix, "left")
    apart = F.concat(F.lit("\0"), F.xxhash64("url", "key").cast("string"))
    out = out.withColumn(suffix, F.when(F.col(f"hot_{names[0]}").isNull(), F.col(suffix)).otherwise(apart))
    out = out.join(table.filter("NOT hot").select(suffix, *names), suffix, "left").drop(suffix)
    filled = {n: F.coalesce(f"hot_{n}", n, F.lit(default)) for n, default in zip(names, (base, 0.0), strict=True)}
    return out.withColumns(filled).drop(*(f"hot_{n}" for n in names))


def _with_features(judged: DataFrame, tables: dict[int, DataFrame], base: float) -> tuple[DataFrame, list[str]]:
    out, features = judged, lexical(F.col("url"), F.col("host"), F.col("path"))
    for labels, table in tables.items():
        out = _with_suffix(out, table, labels, base)
    return out.withColumns(features), [*features, *(f"{kind}_{labels}" for labels in tables for kind in ("rate", "count"))]


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: ``host``, ``path``, the ``rule`` that fits and the ``verdict``."""
    parts = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    judged = parts.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    blocked = [r.text for r in rules if r.verdict == BLOCK]
    judged = judged.withColumn("label", F.when(F.col("rule").isNull(), None).when(F.col("rule").isin(blocked), 1.0).otherwise(0.0))
    tables, base = _suffix_tables(judged)
    if base in (0.0, 1.0):
        guess = F.lit(BLOCK if base == 1.0 else ALLOW)
        ready = judged
    else:
        ready, names = _with_features(judged, tables, base)
        drawn = F.xxhash64("url", "key")
        sample = cut_lineage(ready.filter(F.col("label").isNotNull()).orderBy(drawn, "key").limit(fit_rows).select("label", *names), "urls")
        assembler = VectorAssembler(inputCols=names, outputCol="features")
        trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7)
        model = PipelineModel([assembler, trees.fit(assembler.transform(sample))])
        ready = model.transform(ready)
        guess = F.when(F.col("prediction") > 0.5, BLOCK).otherwise(ALLOW)
    verdict = F.when(F.col("label") == 1.0, BLOCK).when(F.col("label") == 0.0, ALLOW).otherwise(guess)
    return ready.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"))
