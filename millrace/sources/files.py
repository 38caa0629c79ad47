"""Document files: loading, change detection."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The suffixes a corpus may hold, and those whose bytes are plain text.
SUFFIXES = ["pdf", "txt", "md", "docx"]
TEXT_SUFFIXES = ["txt", "md"]


def suffix_of(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def document_id(path: Column) -> Column:
    return F.substring(F.md5(path), 1, 12)


def load_corpus(
    spark: SparkSession,
    root: str,
    decoder: Callable[[Iterator], Iterator] | None = None,
    modified_after: str | None = None,
    on_unknown: str = "error",
) -> DataFrame:
    """All documents below ``root``: id, content, file name, type, path and modification time.

    Text files decode as UTF-8 in the JVM. ``decoder`` is an optional ``mapInPandas`` function
    from (path, content bytes) frames to (path, text) frames for the binary types. A file of any
    other suffix is an error, or is left out with ``on_unknown="skip"``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    files = reader.load(root).select("path", "modificationTime", "content")
    # The path without its file-system scheme, as a caller would have written it.
    plain = F.regexp_replace("path", r"^[a-z0-9]+:(//)?(?=/)", "")
    files = files.withColumns({"path": plain, "type": suffix_of(F.col("path"))})
    if on_unknown == "skip":
        files = files.filter(F.col("type").isin(SUFFIXES))
    else:
        files = files.withColumn(
            "type",
            F.when(F.col("type").isin(SUFFIXES), F.col("type")).otherwise(F.raise_error(F.concat(F.lit("unsupported file type: "), "path"))),
        )
    texts = files.filter(F.col("type").isin(TEXT_SUFFIXES)).withColumn("text", F.decode("content", "UTF-8"))
    out = texts.select("path", "type", "modificationTime", "text")
    if decoder is not None:
        binary = files.filter(~F.col("type").isin(TEXT_SUFFIXES))
        decoded = binary.select("path", "content").mapInPandas(decoder, "path string, text string")
        out = out.unionByName(binary.select("path", "type", "modificationTime").join(decoded, "path"))
    return out.select(
        document_id(F.col("path")).alias("id"), F.col("text").alias("content"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.col("type"), F.col("path").alias("source"),
        F.col("modificationTime").alias("created_at"),
    )


def needs_processing(files: DataFrame, state: DataFrame, key: str, digest: str, modified: str) -> DataFrame:
    """Files whose content is unseen or that changed after they were last stored.

    ``state`` has at most one row per key with the same columns.
    """
    known = state.select(F.col(key).alias("__k"), F.col(digest).alias("__d"), F.col(modified).alias("__m"))
    joined = files.join(known, files[key] == known["__k"], "left")
    stale = F.col("__k").isNull() | (F.col("__d") != F.col(digest)) | (F.col(modified) > F.col("__m"))
    return joined.filter(stale).select(*files.columns)
