"""Cutting documents into chunks, and assembling chunks into contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import let, sentences, uuid5, word_ngrams
from millrace.operators.ordered import running_totals
from millrace.operators.relate import previous_row
from millrace.operators.select import newest_per_key

_SPANS = "array<struct<start:int,end:int>>"


def character_spans(lengths: Column, size: int, overlap: int) -> Column:
    """Chunk spans in the space-joined text, folded over sentence lengths.

    Every chunk is one stretch of that text: it closes when the next sentence would pass
    ``size`` (joining spaces not counted) and the next chunk starts ``overlap`` characters
    before its end. Overlap 0 carries nothing.
    """

    def add(state: Column, n: Column) -> Column:
        close = (state["used"] + n > size) & state["open"]
        kept = F.least(F.lit(overlap), state["end"] - state["start"])
        restart = state["end"] - kept if overlap else state["end"] + 1
        start = F.when(close, restart).otherwise(state["start"])
        fresh = ~state["open"] | (close & F.lit(overlap == 0))
        return F.struct(
            start.alias("start"),
            F.when(fresh, start + n).otherwise(state["end"] + 1 + n).alias("end"),
            (F.when(close, kept if overlap else F.lit(0)).otherwise(state["used"]) + n).alias("used"),
            F.lit(True).alias("open"),
            F.when(close, F.concat(state["spans"], F.array(F.struct(state["start"].alias("start"), state["end"].alias("end"))))).otherwise(state["spans"]).alias("spans"),
        )

    zero = F.struct(
        F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("used"), F.lit(False).alias("open"), F.array().cast(_SPANS).alias("spans")
    )
    return F.aggregate(
        lengths, zero, add,
        lambda s: F.when(s["open"], F.concat(s["spans"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))).otherwise(s["spans"]),
    )


def chunk_documents(docs: DataFrame, doc: str, text: str, size: int = 512, overlap: int = 50, carry: list[str] | None = None) -> DataFrame:
    """(doc, carry.., chunk_no, chunk_id, start_char, end_char, content), one row per chunk.

    Ids are the version 5 id of "doc:start"; when a chunk starts where the one before it
    started, the ordinal is part of the name too, so ids stay distinct.
    """
    carry = carry or []
    parts = docs.select(doc, *carry, sentences(F.col(text)).alias("__s"))
    spans = parts.select(
        doc, *carry, F.array_join("__s", " ").alias("__j"),
        character_spans(F.transform("__s", F.length), size, overlap).alias("__x"),
    )
    repeated = let(F.col("__x"), lambda xs: F.transform(xs, lambda x, i: x.withField("again", (i > 0) & (F.get(xs, i - 1)["start"] == x["start"]))))
    rows = spans.select(doc, *carry, "__j", F.posexplode(repeated).alias("chunk_no", "x"))
    name = F.concat_ws(
        ":", F.col(doc).cast("string"), F.col("x.start").cast("string"), F.when(F.col("x.again"), F.col("chunk_no").cast("string"))
    )
    return rows.select(
        doc, *carry, "chunk_no", uuid5(name).alias("chunk_id"), F.col("x.start").alias("start_char"), F.col("x.end").alias("end_char"),
        F.substring("__j", F.col("x.start") + 1, F.col("x.end") - F.col("x.start")).alias("content"),
    )


def sentence_ranges(lengths: Column, size: int, keep: int) -> Column:
    """(first, last) sentence numbers of chunks that repeat the last ``keep`` sentences."""
    def fold(sizes: Column) -> Column:
        def add(state: Column, n: Column) -> Column:
            close = (state["used"] + n > size) & (state["last"] >= state["first"])
            first = F.when(close, F.greatest(state["first"], state["last"] - (keep - 1))).otherwise(state["first"])
            carried = F.aggregate(F.slice(sizes, first + 1, F.greatest(state["last"] - first + 1, F.lit(0))), F.lit(0), lambda a, b: a + b)
            done = F.array(F.struct(state["first"].alias("first"), state["last"].alias("last")))
            return F.struct(
                first.alias("first"), (state["last"] + 1).alias("last"), (F.when(close, carried).otherwise(state["used"]) + n).alias("used"),
                F.when(close, F.concat(state["out"], done)).otherwise(state["out"]).alias("out"),
            )

        zero = F.struct(F.lit(0).alias("first"), F.lit(-1).alias("last"), F.lit(0).alias("used"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))
        return F.aggregate(
            sizes, zero, add,
            lambda s: F.when(s["last"] >= s["first"], F.concat(s["out"], F.array(F.struct(s["first"].alias("first"), s["last"].alias("last"))))).otherwise(s["out"]),
        )

    return let(lengths, fold)


def chunk_by_sentences(docs: DataFrame, doc: str, text: str, size: int = 500, keep: int = 1) -> DataFrame:
    parts = docs.select(doc, sentences(F.col(text)).alias("__s"))
    ranged = parts.select(doc, "__s", F.posexplode(sentence_ranges(F.transform("__s", F.length), size, keep)).alias("chunk_no", "r"))
    return ranged.select(
        doc, "chunk_no", (F.col("r.last") - F.col("r.first") + 1).alias("n_sentences"),
        F.array_join(F.slice("__s", F.col("r.first") + 1, F.col("r.last") - F.col("r.first") + 1), " ").alias("content"),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in DOUBLE; a zero vector has cosine 0 with anything."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    size = norm(a) * norm(b)
    return F.when(size > 0, dot / size).otherwise(0.0)


def similarity_to_previous(df: DataFrame, doc: str, position: str, vector: str) -> DataFrame:
    """Cosine of each row's vector with the one before it in the document, NULL for the first."""
    out = previous_row(df, [doc], position, [], vector, "__prev")
    return out.withColumn("similarity", F.when(F.col("__prev").isNotNull(), cosine(F.col("__prev"), F.col(vector)))).drop("__prev")


def semantic_chunks(df: DataFrame, doc: str, position: str, text: str, vector: str, threshold: float = 0.5) -> DataFrame:
    """Sentences joined into chunks that break where the similarity to the sentence before drops below the threshold."""
    flagged = similarity_to_previous(df, doc, position, vector).select(
        doc, position, text, F.when(F.col("similarity") < threshold, 1).otherwise(0).cast("long").alias("__break")
    )
    numbered = running_totals(flagged, [doc], position, {"__before": "__break"})
    numbered = numbered.withColumn("chunk_no", F.col("__before") + F.col("__break"))
    return numbered.groupBy(doc, "chunk_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position, text))), lambda x: x[text]), " ").alias("content"),
        F.count(F.lit(1)).alias("n_sentences"),
    )


def split_sections(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, section_no, level, title, path, content): one row per header, text before the first as level 0.

    ``path`` joins the titles of the enclosing headers, outermost first.
    """
    parts = F.split(text, r"(?m)^(?=#{1,6} )")
    rows = docs.select(doc, F.transform(F.filter(parts, lambda p: F.trim(p) != ""), lambda p: F.struct(
        F.length(F.regexp_extract(p, r"^(#{1,6}) ", 1)).alias("level"),
        F.trim(F.regexp_extract(p, r"^#{1,6} ([^\n]*)", 1)).alias("title"),
        F.trim(F.regexp_replace(p, r"^#{1,6} [^\n]*\n?", "")).alias("content"),
    )).alias("__p"))

    def descend(stack: Column, s: Column) -> Column:
        outer = F.filter(stack["open"], lambda o: o["level"] < s["level"])
        opened = F.concat(outer, F.array(F.struct(s["level"].alias("level"), s["title"].alias("title"))))
        path = F.array_join(F.filter(F.transform(opened, lambda o: o["title"]), lambda x: x != ""), " > ")
        return F.struct(opened.alias("open"), F.concat(stack["paths"], F.array(path)).alias("paths"))

    zero = F.struct(F.array().cast("array<struct<level:int,title:string>>").alias("open"), F.array().cast("array<string>").alias("paths"))
    paths = F.aggregate("__p", zero, descend)["paths"]
    return rows.select(doc, F.posexplode(F.zip_with("__p", paths, lambda p, q: p.withField("path", q))).alias("section_no", "s")).select(
        doc, "section_no", "s.level", "s.title", "s.path", "s.content"
    )


def chunk_sections(docs: DataFrame, doc: str, text: str, size: int = 512, overlap: int = 50) -> DataFrame:
    """Sections first, then sentence chunks inside each; a chunk never crosses a header."""
    sections = split_sections(docs, doc, text).withColumn("__id", F.concat_ws("#", F.col(doc).cast("string"), F.col("section_no").cast("string")))
    carry = [doc, "section_no", "level", "path"]
    return chunk_documents(sections.withColumnRenamed("content", "__text"), "__id", "__text", size, overlap, carry).drop("__id")


def first_copies(docs: DataFrame, digest: Column, key: str) -> DataFrame:
    """The smallest key of every content hash, with the number of copies."""
    return docs.groupBy(digest.alias("digest")).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("copies"))


def chunk_quality(chunks: DataFrame, doc: str, text: str) -> DataFrame:
    """Per document: chunks that stop mid-sentence, are under 50 or over 1000 characters."""
    return chunks.groupBy(doc).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if(~F.col(text).rlike(r"[.!?\n]\z")).alias("open_ended"),
        F.count_if(F.length(text) < 50).alias("too_short"),
        F.count_if(F.length(text) > 1000).alias("too_long"),
    )


def context_usage(df: DataFrame, key: str, context: str, answer: str, top: int = 50) -> DataFrame:
    """Share of the context's ``top`` most frequent 3-5-word phrases that occur in the lower-cased answer.

    Phrases are counted as rows, so a long context spreads over tasks; equal counts are cut in phrase order.
    """
    grams = df.select(key, F.explode(word_ngrams(F.col(context))).alias("g")).groupBy(key, "g").agg(F.count(F.lit(1)).alias("n"))
    best = newest_per_key(grams, [key], [F.col("n").desc(), F.col("g")], top)
    checked = best.join(df.select(key, F.lower(answer).alias("__a")), key)
    used = checked.groupBy(key).agg(F.avg(F.contains("__a", "g").cast("double")).alias("usage"))
    return df.select(key).join(used, key, "left").withColumn("usage", F.coalesce("usage", F.lit(0.0)))


def within_budget(df: DataFrame, keys: list[str], rank: str, cost: Column, limit: int) -> DataFrame:
    """Rows per key in rank order, stopping at the first whose cost would pass the limit.

    The rows are ranked candidates of a query, so a key holds no more than the query asked for.
    """
    window = Window.partitionBy(*keys).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("__used", F.sum(cost).over(window)).filter(F.col("__used") <= limit).drop("__used")


def assemble_context(df: DataFrame, keys: list[str], rank: str, source: str, text: str, score: str | None = None) -> DataFrame:
    """One context string per key: source header and text, blocks apart by a blank line.

    With ``score`` the headers are numbered and show it to two places.
    """
    if score is None:
        block = F.concat(F.lit("[Source: "), F.coalesce(source, F.lit("Unknown")), F.lit("]\n"), F.col(text))
    else:
        block = F.concat(
            F.lit("[Source "), F.col(rank).cast("string"), F.lit(": "), F.coalesce(source, F.lit("Unknown")),
            F.format_string(" (relevance: %.2f)]\n", F.col(score)), F.col(text),
        )
    rows = df.withColumn("__b", block)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col("__b").alias("b"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["b"]), "\n\n").alias("context"))


def group_by_source(df: DataFrame, keys: list[str], rank: str, source: str, text: str) -> DataFrame:
    """Ranked texts of each source, joined by line breaks, with the rank at which the source first occurs."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(text).alias("t"))))
    return df.groupBy(*keys, source).agg(
        F.min(rank).alias("first_rank"), F.array_join(F.transform(ordered, lambda x: x["t"]), "\n").alias("texts")
    )
