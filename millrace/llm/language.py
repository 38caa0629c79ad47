"""Language identification: sparse multinomial logistic regression on character n-grams.

Texts are lower-cased, everything but letters becomes one blank, and all runs of one to three
characters are hashed into ``SLOTS`` features. A feature's value is its share of the text's n-grams
times its inverse document frequency, so a text's score is a plain sum over its n-grams and no text
is ever cut or sampled.

Document frequencies are counted over all training documents. The weights are fitted on a bounded
sample, at most ``PER_LANGUAGE`` training documents of a language, drawn by hash: follow the
regularised leader, one document at a time, with a learning rate per coordinate and an elastic net
(``L1``, ``L2``). A fifth of the sample is not fitted but sets the temperature that calibrates the
probabilities.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any labelled
training document everything is ``und``; equal scores go to the language first in the alphabet;
a null id counts as the empty text when documents are dealt to the held-out part.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.names import named, packed_row, unpacked_row
from millrace.llm.texts import binary_column, release, slices, worker_memory

SLOTS_LOG2 = 16
SLOTS = 1 << SLOTS_LOG2
ORDERS = (1, 2, 3)
PER_LANGUAGE = 1000
EPOCHS = 4
RATE, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.01
SCALE = 100.0
UNKNOWN = "und"

_BLANK = 0x20
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _letters() -> np.ndarray:
    """By code point: the lower-case letter, or a blank for what is no letter."""
    kept = worker_memory("letters")
    if "table" not in kept:
        table = np.full(0x110000, _BLANK, np.uint32)
        for code in range(0x110000):
            if (c := chr(code)).isalpha():
                low = c.lower()
                table[code] = ord(low) if len(low) == 1 else code
        kept["table"] = table
    return kept["table"]


class Grams(NamedTuple):
    """Feature slots of the n-grams of a slice, by order; ``SLOTS`` marks runs that leave their text."""

    slots: list[np.ndarray]
    first: np.ndarray
    letters: np.ndarray


def grams(data: np.ndarray, offsets: np.ndarray) -> Grams:
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    plain = _letters()[codes]
    letter = plain != _BLANK
    after = np.zeros(len(plain), bool)
    after[1:] = letter[:-1]
    after[heads[:-1][heads[:-1] < len(plain)]] = False
    keep = letter | after
    first = np.concatenate([[0], np.cumsum(keep)])[heads]
    plain = plain[keep].astype(np.uint64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    slots = []
    for order in ORDERS:
        size = max(0, len(plain) - order + 1)
        mixed = np.full(size, order, np.uint64)
        for step in range(order):
            mixed = (mixed ^ plain[step : step + size]) * _FACTORS[step]
            mixed ^= mixed >> np.uint64(29)
        slot = (mixed * _FACTORS[0] >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        if order > 1:
            slot[text[:size] != text[order - 1 : order - 1 + size]] = SLOTS
        slots.append(slot)
    return Grams(slots, first, np.concatenate([[0], np.cumsum(letter)])[heads])


def _own_slots(found: Grams, row: int) -> np.ndarray:
    low, high = found.first[row], found.first[row + 1]
    own = np.concatenate([slot[low : max(low, high - order + 1)] for order, slot in zip(ORDERS, found.slots, strict=True)])
    return own[own < SLOTS]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    total, seen, rows = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, bool), 0
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            found = grams(data, offsets)
            for row in range(part.num_rows):
                own = _own_slots(found, row)
                seen[own] = True
                total[np.flatnonzero(seen)] += 1
                seen[own] = False
            rows += part.num_rows
    slot = np.flatnonzero(total)
    # Slot -1 carries the number of documents.
    yield pa.RecordBatch.from_pydict({"slot": pa.array(np.append(slot, -1), pa.int64()), "n": pa.array(np.append(total[slot], rows), pa.int64())})


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            found, slots, counts = grams(data, offsets), [], []
            for row in range(part.num_rows):
                slot, count = np.unique(_own_slots(found, row), return_counts=True)
                slots.append(slot.astype("<u4").tobytes())
                counts.append(count.astype("<u4").tobytes())
            yield pa.RecordBatch.from_pydict({
                "lang": part.column("lang"), "draw": part.column("draw"), "calibrate": part.column("calibrate"),
                "slots": binary_column(slots), "counts": binary_column(counts),
            })


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Follow the regularised leader, coordinate by coordinate; the last row of the state is the bias."""

    def __init__(self, features: int, classes: int):
        self.z = np.zeros((features + 1, classes))
        self.n = np.zeros((features + 1, classes))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at < len(self.z) - 1, L1, 0.0)[:, None]
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((BETA + np.sqrt(n)) / RATE + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = _softmax(x @ w)
        error[label] -= 1
        g = x[:, None] * error
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / RATE * w
        self.n[at] = n + g * g


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden section on its logarithm."""
    if not len(logits):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def remainder(key: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5).cast("int")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", held_out: int = 0, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from the documents whose ``remainder`` is not ``held_out`` and that have a language."""
    part = remainder(named(key))
    labelled = docs.select(named(text).alias("text"), named(lang).alias("lang"), part.alias("part"), F.xxhash64(named(key), named(text)).alias("draw"))
    labelled = labelled.filter((F.col("part") != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = {r.slot: r.n for r in labelled.select("text").mapInArrow(_frequencies, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    rows = counted.pop(-1, 0)
    frequency = np.zeros(SLOTS)
    frequency[list(counted)] = list(counted.values())
    inverse = np.log((1 + rows) / (1 + frequency)) + 1

    # Draw by hash so that about twice the wanted number is left of each language, then take the first.
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((SLOTS + 1, 0), np.float32), np.zeros(0), 1.0)
    below = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1 << 31, (2 * per_language << 31) // n))])
    near = labelled.filter(F.pmod(F.xxhash64("draw"), F.lit(1 << 31)) < below[F.col("lang")])
    drawn = Window.partitionBy("lang").orderBy("draw")
    sample = near.withColumn("at", F.row_number().over(drawn)).filter(F.col("at") <= per_language).drop("at")
    sample = sample.withColumn("calibrate", F.col("part") == (held_out + 1) % 5)
    rows = sample.mapInArrow(_sparse, "lang string, draw bigint, calibrate boolean, slots binary, counts binary").collect()
    rows.sort(key=lambda r: (r.draw, r.lang))
    languages = sorted({r.lang for r in rows})
    leader = Leader(SLOTS, len(languages))

    def example(r) -> tuple[np.ndarray, np.ndarray, int]:
        at, count = np.frombuffer(r.slots, "<u4").astype(np.int64), np.frombuffer(r.counts, "<u4").astype(float)
        x = SCALE * count / max(1.0, count.sum()) * inverse[at]
        return np.append(at, SLOTS), np.append(x, 1.0), languages.index(r.lang)

    for _ in range(EPOCHS):
        for r in rows:
            if not r.calibrate:
                leader.learn(*example(r))
    kept = [example(r) for r in rows if r.calibrate]
    logits = np.array([x @ leader.weights(at) for at, x, _ in kept]).reshape(len(kept), len(languages))
    temperature = _temperature(logits, np.array([label for _, _, label in kept], np.int64))
    weights = leader.weights(np.arange(SLOTS + 1))
    table = np.zeros((SLOTS + 1, len(languages)), np.float32)
    table[:SLOTS] = SCALE * weights[:SLOTS] * inverse[:, None]
    return Model(languages, table, weights[SLOTS], temperature)


def _judge(model: Model):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                found = grams(data, offsets)
                total = np.zeros((part.num_rows, max(1, len(model.languages))))
                size = np.zeros(part.num_rows)
                text = np.repeat(np.arange(part.num_rows), np.diff(found.first))
                for slot in found.slots:
                    own = text[: len(slot)]
                    for language in range(len(model.languages)):
                        total[:, language] += np.bincount(own, model.weights[:, language][slot], part.num_rows)
                    size += np.bincount(own[slot < SLOTS], minlength=part.num_rows)
                known = (np.diff(found.letters) > 0) & (len(model.languages) > 0)
                if len(model.languages):
                    p = _softmax((total / np.maximum(size, 1)[:, None] + model.bias) / model.temperature)
                else:
                    p = np.zeros((part.num_rows, 1))
                best = p.argmax(axis=1)
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "row": part.column("row"), "text": part.column("text"), "lang_pred": pa.array(names, pa.string()),
                    "score": pa.array(np.where(known, p[np.arange(len(p)), best], 0.0), pa.float64()),
                })

    return judge


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct without the text) and ``text``, with ``lang_pred`` and ``score``."""
    rows = docs.select(packed_row(docs, text).alias("row"), named(text).alias("text"))
    out = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_judge(model), out)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", held_out: int = 0) -> DataFrame:
    """Per row: whether it was held out, the predicted language and its calibrated probability."""
    model = fit(docs, key, text, lang, held_out)
    found = identify(docs.select(named(key), named(text)), model, text)
    own = F.col("row").getField(key)
    return found.select(own.alias(key), (remainder(own) == held_out).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, columns as they were, whose language is told with probability ``least`` or more."""
    found = identify(docs, fit(docs, key, text, lang), text).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*unpacked_row(docs, **{text: F.col("text")}))
