"""A corpus pipeline of five stages, from the documents table to packed sequences.

Every stage takes (spark, docs, directory) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. The first four return the columns of ``documents``: the language
stage drops what it cannot identify, the Jaccard join leaves the smallest id of every group of linked
documents, the substring stage removes repeated words from texts (no row goes), decontamination drops
documents in which a benchmark window occurs. The last packs the token ids of what is left.

Defined cases: a null, empty or letterless text has no language, so its row goes in the first stage;
what a later stage empties stays as an empty text and packs as its end id. Of rows with one id and one
text one stays, of rows with one id and different texts each is judged for itself. A null id is an id
like any other; in a group it is the last to stay. Extra columns pass the first four stages as they are.
Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, jaccard, language, packing, spans, tokens
from millrace.session import scratch

#: The stages that SQL cannot express (language ID, packing) make the whole so.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    return jaccard.keep_one(docs, rule=jaccard.Rule(words=5, percent=80))


def remove_repeats(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    return spans.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{directory.rstrip('/')}/benchmark.parquet"))


def pack_tokens(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, memory=tokens.TIGHT)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("substring_dedup", remove_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_tokens),
]


def run(spark: SparkSession, directory: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{directory.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, directory).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
