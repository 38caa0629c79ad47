"""One-permutation MinHash fingerprints in DataFrame expressions.

Word shingles are hashed once. The top bits of a hash choose one of ``BINS`` bins and a bin keeps
its smallest hash. Empty bins borrow by optimal densification: bin i tries bins chosen by a hash of
(i, attempt) until one holds a value; after the first few attempts the next occupied bin of a random
order of i is taken, which is the same draw without replacement. Of every bin the low ``BITS`` bits
are packed into longs. Two unrelated bins agree with probability 2**-BITS, and the estimate of the
Jaccard similarity is corrected for that.

Everything is one expression per row: no explode, no shuffle, no Python.

Defined results: a null text is empty; a text without words has the fingerprint ``''``; two such
are alike (1.0), one such and another text are not (0.0); a text of fewer words than a shingle is
one shingle. Equal texts have equal fingerprints whatever their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import let
from millrace.operators.ordered import bucket_by_order

BINS_LOG2 = 8
BINS = 1 << BINS_LOG2
BITS = 4
WORDS = 5
ATTEMPTS = 6

_SHIFT = 64 - BINS_LOG2
_REST = (1 << _SHIFT) - 1
_PER_LONG = 64 // BITS
_LOW = sum(1 << (BITS * i) for i in range(_PER_LONG))
_LOW_LONG = _LOW - (1 << 64) if _LOW >= 1 << 63 else _LOW
#: One marker per bin, in signed order: larger than any other value of its bin.
_MARKERS = [((i - BINS // 2) << _SHIFT) | _REST for i in range(BINS)]


def words(text: Column) -> Column:
    """Runs of anything but blank and 0x09-0x0D; of a null, none."""
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(blank, " "), lambda w: w != "")


def shingle_hashes(text: Column, width: int = WORDS) -> Column:
    """Hashes of all runs of ``width`` words; of a shorter text, of its one run."""

    def runs(hashes: Column) -> Column:
        starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (width - 1), F.lit(1)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, width)]))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), runs)


def _empty(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_REST)) == _REST


def _bin(x: Column) -> Column:
    return F.shiftright(x, _SHIFT)


def minima(hashes: Column) -> Column:
    """The smallest hash of every bin, in bin order; an empty bin holds its marker."""
    ordered = F.sort_array(F.concat(hashes, F.lit(_MARKERS)))
    return let(ordered, lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))


def densified(bins: Column) -> Column:
    """Every bin with a value, given that one has."""

    def tried(i: Column, attempt: int, all_bins: Column) -> Column:
        other = F.get(all_bins, F.pmod(F.xxhash64(i, F.lit(attempt)), F.lit(BINS)).cast("int"))
        return F.when(~_empty(other), other)

    def filled(all_bins: Column, held: Column) -> Column:
        def rest(i: Column) -> Column:
            order = F.transform(held, lambda y: F.struct(F.xxhash64(i, _bin(y)).alias("at"), y.alias("value")))
            return F.array_min(order)["value"]

        return F.transform(
            all_bins,
            lambda x, i: F.when(~_empty(x), x).otherwise(F.coalesce(*[tried(i, a, all_bins) for a in range(ATTEMPTS)], rest(i))),
        )

    return let(bins, lambda b: let(F.filter(b, lambda x: ~_empty(x)), lambda held: filled(b, held)))


def packed_bits(values: Column) -> Column:
    """The low bits of every bin, packed in order into longs."""
    mask = (1 << BITS) - 1
    return F.transform(
        F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)),
        lambda w: F.aggregate(
            F.slice(values, w * _PER_LONG + 1, F.lit(_PER_LONG)),
            F.lit(0).cast("long"),
            lambda acc, x: F.shiftleft(acc, BITS).bitwiseOR(x.bitwiseAND(F.lit(mask).cast("long"))),
        ),
    )


def signature(text: Column) -> Column:
    """Packed longs of a text, or null when it has no words."""
    return let(shingle_hashes(text), lambda h: F.when(F.size(h) > 0, let(densified(minima(h)), packed_bits)))


def as_text(packed: Column) -> Column:
    """Lower-case hex of a signature; ``''`` of null."""
    digits = F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the texts behind two signatures, corrected for chance agreement."""

    def different(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        both = bits
        for j in range(1, BITS):
            both = both.bitwiseOR(F.shiftrightunsigned(bits, j))
        return F.bit_count(both.bitwiseAND(F.lit(_LOW_LONG).cast("long")))

    unequal = F.aggregate(F.zip_with(a, b, different), F.lit(0), lambda acc, x: acc + x)
    chance = 2.0**-BITS
    estimate = ((BINS - unequal) / F.lit(float(BINS)) - chance) / (1 - chance)
    return (
        F.when(a.isNull() & b.isNull(), 1.0)
        .when(a.isNull() | b.isNull(), 0.0)
        .otherwise(F.least(F.greatest(estimate, F.lit(0.0)), F.lit(1.0)))
    )


def with_next(docs: DataFrame, order: str, carried: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the row that follows in descending ``order`` (nulls last, then by
    content); after the last comes the first.

    Rows are dealt to buckets of ``order`` values and each bucket also gets a copy of the row that
    follows it, so the rows move once and no window spans more than a bucket. The driver sees one
    number per bucket.
    """
    bucketed = bucket_by_order(docs, order, name="__bucket")
    heads = sorted(bucketed.groupBy("__bucket").agg(F.max(order).alias("__head")).collect(), reverse=True, key=lambda r: r[0])
    kind = docs.schema[order].dataType.simpleString()
    targets = [(row[0], row[1], heads[i - 1][0]) for i, row in enumerate(heads)]
    table = docs.sparkSession.createDataFrame(targets, f"__b int, __head {kind}, __target int")
    first = bucketed.join(F.broadcast(table), F.col("__bucket") == F.col("__b"), "left")
    is_head = F.col(order).eqNullSafe(F.col("__head"))
    own = F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("__target").alias("b"), F.lit(True).alias("copy"))
    dealt = first.withColumn("__place", F.explode(F.when(is_head, F.array(own, copy)).otherwise(F.array(own))))
    dealt = dealt.select(*docs.columns, F.col("__place.b").alias("__bucket"), F.col("__place.copy").alias("__copy"))
    tie = F.xxhash64(*[F.col(c) for c in carried])
    down = Window.partitionBy("__bucket").orderBy("__copy", F.col(order).desc_nulls_last(), tie)
    return dealt.select("*", *[F.lead(c).over(down).alias(f"next_{c}") for c in carried]).filter(~F.col("__copy")).drop("__bucket", "__copy")


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and its edited form, and say how alike they and the next text are.

    The edited text swaps the last half of the code points (rounded down) for as many from the
    start of the next document, in descending ``key`` order.
    """
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    own = own.withColumn("sign", signature(F.col("body")))
    paired = with_next(own, "key", ["body", "sign"])
    half = F.floor(F.length("body") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("body"), F.lit(1), F.length("body") - half), F.substring(F.col("next_body"), F.lit(1), half)
    )
    signed = paired.select("key", "sign", "next_sign", F.length("body").cast("long").alias("n_chars"), edited.alias("edited"))
    signed = signed.withColumn("edited_sign", signature(F.col("edited")))
    return signed.select(
        F.col("key").alias(key),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sign")).alias("fingerprint"),
        as_text(F.col("edited_sign")).alias("edited_fingerprint"),
        likeness(F.col("sign"), F.col("edited_sign")).alias("near_edited"),
        likeness(F.col("sign"), F.col("next_sign")).alias("near_next"),
    )
