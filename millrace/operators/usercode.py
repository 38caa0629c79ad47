"""User code on DataFrames: scorers, encoders, feature functions, models, extractors.

All of it runs in Arrow batches inside Spark's own partitions; a heavy object is built once
per worker process from a factory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import tokens


def batch_scorer(score: Callable[[pd.Series, pd.Series], pd.Series]):
    """A (question, text) -> score function as a column function."""

    @F.pandas_udf(T.DoubleType())
    def scorer(question: pd.Series, text: pd.Series) -> pd.Series:
        return score(question, text).astype("float64")

    return scorer


def lexical_scorer(question: Column, text: Column) -> Column:
    """Share of distinct tokens two texts have in common; native, for use without a model."""
    a, b = F.array_distinct(tokens(question)), F.array_distinct(tokens(text))
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def model_scorer(factory: Callable[[], Callable[[list[str], list[str]], list[float]]]):
    """A pair-scoring model loaded once per worker."""

    @F.pandas_udf(T.DoubleType())
    def scorer(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        predict = factory()
        for question, text in batches:
            yield pd.Series(predict(question.tolist(), text.tolist()), dtype="float64")

    return scorer


def encode(df: DataFrame, text: str, factory: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 32, vector: str = "vector", prefix: str = "") -> DataFrame:
    """Add a vector per row. Each distinct text is encoded once, in batches of ``batch``.

    ``factory`` builds the encoder once per task; ``prefix`` is the instruction some model
    families want before a query. Texts are told apart and joined back by their digests, so no text
    is a shuffle key.
    """
    digest = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    texts = df.select(digest.alias("h"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    distinct = texts.dropDuplicates(["h"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            texts = frame["t"].tolist()
            parts = [np.asarray(model([prefix + x for x in texts[i:i + batch]]), dtype="float32") for i in range(0, len(texts), batch)]
            if parts:
                yield pd.DataFrame({"h": frame["h"], "v": list(np.concatenate(parts))})

    vectors = distinct.mapInPandas(run, "h binary, v array<float>").select(F.col("h").alias("__h"), F.col("v").alias(vector))
    return df.withColumn("__d", digest).join(vectors, F.col("__d") == F.col("__h"), "left").drop("__h", "__d")


def hashing_encoder(dimensions: int = 64) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """A model-free encoder: signed token counts by md5. For tests and for use without a model."""

    def factory():
        from hashlib import md5

        known: dict[str, int] = {}

        def number(token: str) -> int:
            if token not in known:
                if len(known) > 200_000:
                    known.clear()
                known[token] = int(md5(token.encode()).hexdigest()[:8], 16)
            return known[token]

        def run(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dimensions), dtype="float32")
            for row, text in enumerate(texts):
                h = np.fromiter(map(number, text.lower().split()), np.int64)
                out[row] = np.bincount(h % dimensions, np.where((h >> 16) & 1, 1.0, -1.0), dimensions)
            return out

        return run

    return factory


def feature_function(inputs: list[str], outputs: str):
    """Turn a pandas function with declared inputs and outputs into a DataFrame function."""
    declared = T.StructType.fromDDL(outputs)

    def wrap(fn: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[DataFrame], DataFrame]:
        def apply(df: DataFrame) -> DataFrame:
            lacking = [c for c in inputs if c not in df.columns]
            if lacking:
                raise ValueError(f"missing inputs {lacking}")
            schema = T.StructType([*df.schema.fields, *declared.fields])

            def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for frame in frames:
                    made = fn(frame[inputs])
                    yield pd.concat([frame, made[declared.names].set_axis(frame.index)], axis=1)

            return df.mapInPandas(run, schema)

        return apply

    return wrap


class BatchModel:
    """User model protocol: ``load`` once per task, then ``predict`` per Arrow batch."""

    inputs: list[str] = []
    outputs: str = "prediction double"

    def load(self) -> None:
        """Fetch what ``predict`` needs; runs on the executor."""

    def predict(self, frame: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError


def apply_model(df: DataFrame, model: BatchModel) -> DataFrame:
    declared = T.StructType.fromDDL(model.outputs)
    schema = T.StructType([*df.schema.fields, *declared.fields])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model.load()
        for frame in frames:
            made = model.predict(frame[model.inputs])
            yield pd.concat([frame, made[declared.names].set_axis(frame.index)], axis=1)

    return df.mapInPandas(run, schema)


def extract_entities(chunks: DataFrame, key: str, text: str, extractor: Callable[[list[str]], list[list[tuple[str, str]]]] | None = None) -> DataFrame:
    """(key, position, text, type) of entities. ``extractor`` maps texts to lists of (text, type);
    without one, capitalised words serve as entities of type NAME."""
    if extractor is None:
        found = F.regexp_extract_all(F.col(text), F.lit(r"(?<![\p{L}\p{N}_])\p{Lu}\p{Ll}{3,}(?![\p{L}\p{N}_])"), 0)
        return chunks.select(key, F.posexplode(found).alias("position", "entity")).withColumn("type", F.lit("NAME"))
    schema = T.StructType([chunks.schema[key], T.StructField("position", T.IntegerType()), T.StructField("entity", T.StringType()), T.StructField("type", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (k, i, name, kind)
                for k, found in zip(frame[key], extractor(frame[text].tolist()), strict=True)
                for i, (name, kind) in enumerate(found)
            ]
            yield pd.DataFrame(rows, columns=[key, "position", "entity", "type"])

    return chunks.select(key, text).mapInPandas(run, schema)
