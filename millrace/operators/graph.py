"""Knowledge graph and lineage as node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.select import newest_per_key
from millrace.session import cut_lineage


def parse_triples(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, subject, relation, object) from lines "s | r | o"; other lines are left out."""
    lines = df.select(key, F.explode(F.split(text, r"\r?\n")).alias("__l"))
    parts = lines.select(key, F.transform(F.split("__l", r"\|"), lambda p: F.trim(p)).alias("p")).filter(F.size("p") == 3)
    return parts.select(key, F.col("p")[0].alias("subject"), F.col("p")[1].alias("relation"), F.col("p")[2].alias("object"))


def relation_label(predicate: Column) -> Column:
    return F.upper(F.replace(predicate, F.lit(" "), F.lit("_")))


def build_tables(chunks: DataFrame, mentions: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """Tables of a document graph.

    ``chunks`` is (doc_id, chunk_id), ``mentions`` (chunk_id, position, entity, type), ``relations``
    (chunk_id, subject, predicate, object). A relation stays only if both ends are entities of its chunk.
    """
    known = mentions.select("chunk_id", "entity").distinct()
    left = known.select(F.col("chunk_id").alias("__c"), F.col("entity").alias("__s"))
    right = known.select(F.col("chunk_id").alias("__d"), F.col("entity").alias("__o"))
    kept = relations.join(left, (F.col("chunk_id") == F.col("__c")) & (F.col("subject") == F.col("__s")), "left_semi").join(
        right, (F.col("chunk_id") == F.col("__d")) & (F.col("object") == F.col("__o")), "left_semi"
    )
    return {
        "part_of": chunks.select("chunk_id", "doc_id").distinct(),
        "mentions": known,
        "entities": merge_entities(mentions),
        "relations": kept.select(F.col("subject").alias("src"), relation_label(F.col("predicate")).alias("label"), F.col("object").alias("dst"), "chunk_id"),
    }


def merge_entities(mentions: DataFrame) -> DataFrame:
    """One row per name: the type seen first, and the true number of mentions."""
    return mentions.groupBy("entity").agg(
        F.min_by("type", F.struct("chunk_id", "position")).alias("type"), F.count(F.lit(1)).alias("mentions")
    )


def related(starts: DataFrame, edges: DataFrame, depth: int = 2, label: str | None = None, first_label: bool = False) -> DataFrame:
    """(start, name, relations, distance) for all nodes within ``depth`` undirected hops, each at its
    shortest distance, with the labels along the least of its shortest paths.

    ``edges`` is (src, label, dst). Every hop joins the frontier only, one row per node, so no path is
    enumerated; a walk that turns back along its edge ends at a node already seen. With
    ``first_label`` nodes are told apart by the label of the first hop as well.
    """
    chosen = edges if label is None else edges.filter(F.col("label") == label)
    both = chosen.select("src", "label", "dst").unionByName(chosen.select(F.col("dst").alias("src"), "label", F.col("src").alias("dst"))).distinct()
    keys = ["start", "first", "name"] if first_label else ["start", "name"]
    frontier = starts.select("start").distinct().withColumns({"name": F.col("start"), "relations": F.array().cast("array<string>")})
    if first_label:
        frontier = frontier.withColumn("first", F.lit(""))
    seen = frontier.withColumn("distance", F.lit(0))
    for hop in range(1, depth + 1):
        steps = frontier.join(both, F.col("name") == F.col("src"))
        if first_label:
            steps = steps.withColumn("first", F.when(F.col("first") == "", F.col("label")).otherwise(F.col("first")))
        walked = steps.select(*[F.col("dst").alias("name") if k == "name" else F.col(k) for k in keys], F.concat("relations", F.array("label")).alias("relations"))
        reached = walked.filter(F.col("name") != F.col("start")).groupBy(*keys).agg(F.min("relations").alias("relations"))
        frontier = reached.join(seen.select(*keys), keys, "left_anti")
        seen = seen.unionByName(frontier.withColumn("distance", F.lit(hop)))
    return seen.filter(F.col("distance") > 0)


def with_types(reached: DataFrame, entities: DataFrame) -> DataFrame:
    """Add the ``type`` of every reached node from (entity, type)."""
    return reached.join(entities.select(F.col("entity").alias("name"), "type"), "name", "left").select(*reached.columns, "type")


def nearest(reached: DataFrame, limit: int = 20) -> DataFrame:
    return newest_per_key(reached, ["start"], [F.col("distance"), F.col("name")], limit)


def related_contexts(reached: DataFrame, mentions: DataFrame, chunks: DataFrame, contexts: int = 3) -> DataFrame:
    """Up to ``contexts`` chunk texts mentioning each related entity, in text order; see ``reached`` for
    its type and the relations that lead to it."""
    names = reached.select(F.col("name").alias("entity")).distinct()
    texts = mentions.select("chunk_id", "entity").join(names, "entity").join(chunks.select("chunk_id", "content"), "chunk_id")
    first = newest_per_key(texts.select("entity", "content").distinct(), ["entity"], [F.col("content")], contexts)
    return first.groupBy("entity").agg(F.array_sort(F.collect_list("content")).alias("contexts"))


def search_entities(entities: DataFrame, text: str, kind: str | None = None, limit: int = 10) -> DataFrame:
    """Names containing ``text``, whatever the case, in name order."""
    found = entities.filter(F.contains(F.lower("entity"), F.lit(text.lower())))
    return (found if kind is None else found.filter(F.col("type") == kind)).orderBy("entity").limit(limit)


def neighbour_lines(starts: DataFrame, edges: DataFrame, depth: int = 2, rows: int = 20, shown: int = 5) -> DataFrame:
    """Per start the first relation and far node of its nearest ``rows`` neighbours, the first ``shown`` as text."""
    reached = related(starts, edges, depth, first_label=True)
    order = [F.col("distance"), F.col("first"), F.col("name")]
    listed = newest_per_key(newest_per_key(reached, ["start"], order, rows), ["start"], order, shown)
    line = F.concat(F.lit("  - "), "start", F.lit(" "), "first", F.lit(" "), "name")
    ordered = F.array_sort(F.collect_list(F.struct("distance", "first", "name", line.alias("line"))))
    return listed.groupBy("start").agg(
        F.concat(F.first("start"), F.lit(" relationships:\n"), F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")).alias("described")
    )


# --- lineage ---------------------------------------------------------------


def lineage_edges(jobs: DataFrame) -> DataFrame:
    """Distinct (input, output) datasets from job events with ``inputs`` and ``outputs`` lists."""
    return jobs.select(F.explode("inputs").alias("input"), "outputs").select("input", F.explode("outputs").alias("output")).distinct()


def impact(starts: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(start, dataset, depth): everything downstream, at its shortest depth.

    The walk goes on until nothing new is reached. A dataset is visited once per start, so a cycle
    ends by itself; each round is written out, which keeps the plan flat and survives lost
    executors. With ``max_depth`` a deeper lineage is an error, never a shorter answer.
    """
    frontier = starts.select("start").distinct().withColumn("dataset", F.col("start"))
    seen, depth = frontier.withColumn("depth", F.lit(0)), 0
    while True:
        depth += 1
        steps = frontier.join(edges, F.col("dataset") == F.col("input")).select("start", F.col("output").alias("dataset")).distinct()
        frontier = cut_lineage(steps.join(seen.select("start", "dataset"), ["start", "dataset"], "left_anti"), "impact")
        if frontier.isEmpty():
            return seen.filter(F.col("depth") > 0)
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"lineage is deeper than {max_depth}")
        seen = seen.unionByName(frontier.withColumn("depth", F.lit(depth)))
