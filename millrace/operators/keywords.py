"""Keyword index with BM25 scores, TF-IDF vectors and rank fusion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import let, tokens
from millrace.operators import postings as stored_postings
from millrace.operators.ordered import number_values
from millrace.operators.vectorsearch import rank_hits
from millrace.session import cut_lineage, shuffle_width

ENTRIES = "doc {key}, doc_len long, terms array<struct<term: string, tf: long>>"
FREQUENCIES = "term string, df long"


def term_counts(terms: Column) -> Column:
    """(term, tf) of every distinct term of a list, by run lengths over the sorted list: no shuffle."""
    def runs(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        count = lambda starts_, i, p: (F.coalesce(F.get(starts_, i + 1), F.size(ordered)) - p).cast("long")
        return let(starts, lambda at: F.transform(at, lambda p, i: F.struct(F.get(ordered, p).alias("term"), count(at, i, p).alias("tf"))))

    return let(F.sort_array(terms), runs)


def _parts(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the parts stored in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removeprefix("part=")) for n in names if n.startswith("part="))


class KeywordIndex:
    """One row per document with its term counts, and how many documents hold each term.

    Term counts come from the document's own row. Only document frequencies are shuffled, as counts
    combined per task, and they are worked out when the index is built, not at every search. An
    index that is stored to be searched also has its postings in ``blocks`` by term (see ``postings``).
    """

    def __init__(self, entries: DataFrame, frequencies: DataFrame, blocks: DataFrame | None = None):
        self.entries = entries
        self.frequencies = frequencies
        self.blocks = blocks

    @property
    def documents(self) -> DataFrame:
        return self.entries.select("doc", "doc_len")

    @property
    def postings(self) -> DataFrame:
        rows = self.entries.select("doc", "doc_len", F.explode("terms").alias("t"))
        return rows.select("doc", F.col("t.term").alias("term"), F.col("t.tf").alias("tf"), "doc_len")

    @staticmethod
    def entries_of(docs: DataFrame, doc: str, text: str) -> DataFrame:
        listed = docs.select(F.col(doc).alias("doc"), tokens(F.col(text)).alias("__t"))
        return listed.select("doc", F.size("__t").cast("long").alias("doc_len"), term_counts(F.col("__t")).alias("terms"))

    @staticmethod
    def build(docs: DataFrame, doc: str, text: str) -> KeywordIndex:
        """An index that is not stored; every use tokenises again."""
        entries = KeywordIndex.entries_of(docs, doc, text)
        return KeywordIndex(entries, KeywordIndex(entries, entries).postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")))

    @staticmethod
    def create(docs: DataFrame, doc: str, text: str, root: str, part: int = 0, searchable: bool = True) -> KeywordIndex:
        """Tokenise once and store the index as one part; parts add up, and the statistics are always
        those of the whole. Frequencies come from the stored counts, not from the texts again."""
        base, spark, key = root.rstrip("/"), docs.sparkSession, docs.schema[doc].dataType.simpleString()
        KeywordIndex.entries_of(docs, doc, text).write.mode("overwrite").parquet(f"{base}/entries/part={part}")
        stored = spark.read.schema(ENTRIES.format(key=key)).parquet(f"{base}/entries/part={part}")
        terms = stored.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        terms.write.mode("overwrite").parquet(f"{base}/frequencies/part={part}")
        if searchable:
            stored_postings.write_blocks(stored, base, part)
        return KeywordIndex.read(spark, root, key)

    @staticmethod
    def read(spark: SparkSession, root: str, key: str = "bigint") -> KeywordIndex:
        """A stored index; ``key`` is the type of the document ids. It is searched by blocks if all its
        parts have them."""
        base = root.rstrip("/")
        parts, blocked = _parts(spark, f"{base}/entries"), _parts(spark, f"{base}/blocks")
        return KeywordIndex(
            spark.read.schema(ENTRIES.format(key=key) + ", part int").parquet(f"{base}/entries").drop("part"),
            spark.read.schema(FREQUENCIES + ", part int").parquet(f"{base}/frequencies").drop("part"),
            stored_postings.read_blocks(spark, base, parts, key) if parts == blocked else None,
        )

    def append(self, docs: DataFrame, doc: str, text: str, root: str, part: int, searchable: bool = True) -> KeywordIndex:
        """Add documents. Frequencies add up over all parts, for every term, not only the new ones."""
        return KeywordIndex.create(docs, doc, text, root, part, searchable)

    def terms(self, floor: float = 0.25, only: DataFrame | None = None) -> DataFrame:
        """(term, df, idf): idf = max(ln((N - df + .5) / (df + .5) + 1), floor); ``only`` limits it to given terms."""
        n = self.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
        rows = self.frequencies if only is None else self.frequencies.join(only, "term", "left_semi")
        df = rows.groupBy("term").agg(F.sum("df").alias("df")).withColumn("__n", n)
        idf = F.greatest(F.ln((F.col("__n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1), F.lit(floor))
        return df.withColumn("idf", idf).drop("__n")

    def search(self, queries: DataFrame, query: str, text: str, k: int = 10, k1: float = 1.5, b: float = 0.75) -> DataFrame:
        """(query_id, id, score, matched, rank): query words count as often as they are asked.

        Scores are rounded to nine places, so that equal texts tie whatever the order of their
        sums. A stored index opens only blocks that may hold a hit. Without blocks all documents are
        met: they are dealt by their id, the query side carries its idf and is met where a document
        lies, so a document's scores are summed and the best chosen in its task, and only those move.
        Tasks grow in number with the pairs of query and document, not in size.
        """
        asked = queries.select(F.col(query).alias("query_id"), F.explode(tokens(F.col(text))).alias("term"))
        asked = asked.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))
        weighed = asked.join(self.terms(only=asked.select("term")), "term").select("query_id", "term", "times", "idf")
        average = self.documents.agg(F.avg("doc_len").alias("a")).scalar()
        if self.blocks is not None:
            return stored_postings.Search(self.blocks, weighed, average, k, k1, b).hits()
        weighed = cut_lineage(weighed.withColumn("__avg", average), "asked")
        pairs = self.documents.count() * weighed.select("query_id").distinct().count()
        dealt = KeywordIndex(self.entries.repartition(max(shuffle_width(weighed.sparkSession), -(-pairs // stored_postings.PAIRS)), "doc"), self.frequencies)
        hits = dealt.postings.join(weighed, "term")
        gain = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("doc_len") / F.col("__avg")))
        scores = hits.groupBy("query_id", F.col("doc").alias("id")).agg(
            F.round(F.sum(F.col("times") * F.col("idf") * gain), 9).alias("score"), F.sum("times").alias("matched")
        )
        return rank_hits(scores.filter(F.col("score") > 0), "query_id", "id", "score", k)


def tfidf_vectors(index: KeywordIndex, indexed: bool = True) -> DataFrame:
    """Sparse rows (doc, term, term_index, value): tf * (ln((1 + N) / (1 + df)) + 1), unit length per document.

    ``term_index`` is the alphabetical position of the term, numbered in parallel over the vocabulary.
    """
    n = index.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    terms = index.frequencies.groupBy("term").agg(F.sum("df").alias("df"))
    if indexed:
        terms = number_values(terms, "term", "term_index")
    terms = terms.withColumn("__n", n).withColumn("idf", F.ln((1 + F.col("__n")) / (1 + F.col("df"))) + 1)
    weights = index.postings.join(terms, "term").withColumn("__w", F.col("tf") * F.col("idf"))
    norms = weights.groupBy(F.col("doc").alias("__d")).agg(F.sqrt(F.sum(F.col("__w") * F.col("__w"))).alias("__norm"))
    columns = ["doc", "term", "term_index"] if indexed else ["doc", "term"]
    return weights.join(norms, F.col("doc") == F.col("__d")).select(*columns, (F.col("__w") / F.col("__norm")).alias("value"))


def _stack(lists: dict[str, DataFrame]) -> DataFrame:
    parts = [df.select("query_id", "id", "score", "rank", F.lit(name).alias("source")) for name, df in lists.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _fused(rows: DataFrame, part: Column, shown: Column, k: int) -> DataFrame:
    """Sum ``part`` per (query, id); ``sources`` maps each source to its own score. A row holds one entry per source."""
    fused = rows.groupBy("query_id", "id").agg(
        F.round(F.sum(part), 12).alias("score"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", shown)))).alias("sources")
    )
    return rank_hits(fused, "query_id", "id", "score", k)


def reciprocal_rank_fusion(lists: dict[str, DataFrame], k: int = 10, constant: int = 60) -> DataFrame:
    """Sum of 1 / (constant + rank) over the lists; each list's own score is kept."""
    return _fused(_stack(lists), 1.0 / (F.lit(constant) + F.col("rank")), F.col("score"), k)


def weighted_fusion(lists: dict[str, DataFrame], weights: dict[str, float] | None = None, k: int = 10) -> DataFrame:
    """Scores brought to 0..1 per query and list, then weighted. Without a weight a list counts
    1 / (number of lists that found anything for the query)."""
    weights = weights or {}
    rows = _stack(lists)
    per_list = rows.groupBy("query_id", "source").agg(F.min("score").alias("__lo"), F.max("score").alias("__hi"))
    per_list = per_list.withColumn("__lists", F.count(F.lit(1)).over(Window.partitionBy("query_id")))
    rows = rows.join(per_list, ["query_id", "source"])
    span = F.when(F.col("__hi") > F.col("__lo"), F.col("__hi") - F.col("__lo")).otherwise(F.lit(1.0))
    given = F.lit(None).cast("double")
    for name, value in weights.items():
        given = F.when(F.col("source") == name, F.lit(float(value))).otherwise(given)
    rows = rows.withColumn("__s", (F.col("score") - F.col("__lo")) / span).withColumn("__w", F.coalesce(given, 1.0 / F.col("__lists")))
    return _fused(rows, F.col("__w") * F.col("__s"), F.col("__s").alias("score"), k)
