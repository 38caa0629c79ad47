"""Text expressions on columns: native, no Python workers."""

from __future__ import annotations

import operator
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks as Unicode sees them; Java's \s alone is ASCII.
BLANK = r"(?U)[\s\x1c-\x1f]+"
SENTENCE_END = r"(?U)(?<=[.!?])[\s\x1c-\x1f]+"

# Words the keyword index leaves out.
STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "do", "does", "did", "will", "would", "could", "should", "may", "might", "must", "shall", "can", "to", "of",
    "in", "for", "on", "with", "at", "by", "from", "as", "into", "through", "during", "before", "after", "above",
    "below", "between", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so",
    "than", "too", "very", "just", "it", "its",
]

# Words and a phrase that point back into a conversation.
BACK_REFERENCES = [
    "it", "this", "that", "these", "those", "they", "them", "he", "she", "the same",
    "previous", "earlier", "before", "again", "more", "another", "also", "too",
]

# Phrases that mark a compound question.
COMPOUND_PHRASES = ["and", "or", "vs", "versus", "compare", "difference", "relationship", "how does", "why does", "what are the", "list", "explain"]


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` needs it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Whitespace-separated words, no empty ones."""
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def normalised(text: Column) -> Column:
    """Lower case, runs of blanks as one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), BLANK, " "))


def content_hash(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def sentences(text: Column) -> Column:
    return F.split(text, SENTENCE_END)


def tokens(text: Column) -> Column:
    """Lower-cased words of letters, digits and underscores; stop words and single characters dropped."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: (F.length(w) > 1) & ~w.isin(STOP_WORDS))


def word_ngrams(text: Column, low: int = 3, high: int = 5) -> Column:
    """All n-grams of lower-cased words of two or more characters, with repeats."""
    def grams(terms: Column, n: int) -> Column:
        starts = F.when(F.size(terms) >= n, F.sequence(F.lit(1), F.size(terms) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(terms, i, n), " "))

    terms = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)[\p{L}\p{N}_]{2,}"), 0)
    return let(terms, lambda ts: F.concat(*[grams(ts, n) for n in range(low, high + 1)]))


DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = DNS_NAMESPACE) -> Column:
    """RFC 4122 version 5 id of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), name.cast("binary")))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(variant)), F.substring(digest, 18, 3)), F.substring(digest, 21, 12),
    )


def needs_context(question: Column) -> Column:
    """True when the question points back at the conversation. An entry of several words is looked for
    as a phrase, the others as words."""
    single = [w for w in BACK_REFERENCES if " " not in w]
    known = F.arrays_overlap(words(F.lower(question)), F.array(*[F.lit(w) for w in single]))
    padded = F.concat(F.lit(" "), normalised(question), F.lit(" "))
    return known | reduce(operator.or_, [padded.contains(f" {p} ") for p in BACK_REFERENCES if " " in p])


def needs_decomposition(question: Column) -> Column:
    """True for a compound phrase anywhere (also at the very start), more than 15 words, or two question marks."""
    padded = F.concat(F.lit(" "), F.lower(question), F.lit(" "))
    phrase = reduce(operator.or_, [padded.contains(f" {p} ") for p in COMPOUND_PHRASES])
    marks = F.length(question) - F.length(F.replace(question, F.lit("?"), F.lit("")))
    return phrase | (F.size(words(question)) > 15) | (marks > 1)


def keyword_coverage(answer: Column, expected: list[str]) -> Column:
    wanted = F.array(*[F.lit(w) for w in expected])
    return F.size(F.filter(wanted, lambda w: F.contains(F.lower(answer), w))) / len(expected)


# --- HTML ------------------------------------------------------------------

# The public table of named character references, as the standard library carries it.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
# Those met most often; looked at before the table.
_COMMON = ["amp", "lt", "gt", "quot", "nbsp", "apos"]
_REFERENCE = r"&(?:#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]{1,31});"


def _decoded(reference: Column) -> Column:
    """The text of one character reference; an unknown name stays as it is, a number that is no
    character becomes the replacement character."""
    name = F.substring(reference, F.lit(2), F.length(reference) - 2)
    is_hex = F.lower(F.substring(name, 2, 1)) == "x"
    code = F.when(is_hex, F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2))).cast("long")
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    number = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    out = F.when(F.startswith(name, F.lit("#")), number)
    for common in _COMMON:
        out = out.when(name == common, F.lit(ENTITIES[common]))
    table = F.create_map(*[F.lit(x) for entry in ENTITIES.items() for x in entry])
    return out.otherwise(F.coalesce(F.try_element_at(table, name), reference))


def unescape(text: Column) -> Column:
    """Named and numeric character references as characters, in one pass from left to right, so
    that nothing is decoded twice."""
    def put(found: Column) -> Column:
        gaps = F.split(text, _REFERENCE)
        return F.array_join(F.zip_with(gaps, found, lambda gap, one: F.concat(gap, F.coalesce(_decoded(one), F.lit("")))), "")

    found = F.regexp_extract_all(text, F.lit(_REFERENCE), 0)
    return F.when(F.contains(text, F.lit("&")), let(found, put)).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Script, style, comments and tags out, entities decoded, blanks collapsed."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(unescape(bare), BLANK, " "))


def html_tables(html: Column) -> Column:
    """The outer markup of every (unnested) table."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<table\b[^>]*>.*?</table\s*>"), 0)


def table_to_text(table: Column, sample: int = 5) -> Column:
    """Row and column counts, header names, and the first rows as "name: value" pairs."""
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), 1)
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"), 1), html_to_text))

    def line(header: Column, row: Column, i: Column) -> Column:
        pairs = F.zip_with(header, row, lambda h, v: F.concat_ws(": ", h, F.coalesce(v, F.lit(""))))
        return F.concat(F.lit("Row "), i.cast("string"), F.lit(": "), F.array_join(pairs, ", "), F.lit("\n"))

    def describe(grid: Column) -> Column:
        header = F.get(grid, F.lit(0))
        body = F.size(grid) - 1
        return F.concat(
            F.lit("Table with "), F.greatest(body, F.lit(0)).cast("string"), F.lit(" rows and "), F.coalesce(F.size(header), F.lit(0)).cast("string"),
            F.lit(" columns.\nColumns: "), F.coalesce(F.array_join(header, ", "), F.lit("")), F.lit("\n\n"),
            F.array_join(F.transform(F.slice(grid, 2, sample), lambda row, i: line(header, row, i)), ""),
        )

    return let(cells, describe)


# --- personal data ---------------------------------------------------------

# What each type looks like and how sure a bare match is.
PII_PATTERNS = {
    "EMAIL_ADDRESS": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", 1.0),
    "CREDIT_CARD": (r"(?=\d)(?<![\p{L}\p{N}_.+-])\d(?:[ -]?\d){12,15}(?![\p{L}\p{N}_-])", 1.0),
    "US_SSN": (r"(?=\d)(?<![\p{L}\p{N}_-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}_-])", 0.85),
    "PHONE_NUMBER": (r"(?=[+(\d])(?<![\p{L}\p{N}_.])(?:\+\d{1,2}[ .-]?)?(?:\(\d{3}\)|\d{3})[ .-]\d{3}[ .-]\d{4}(?![\p{L}\p{N}_])", 0.75),
    "IP_ADDRESS": (r"(?=\d)(?<![\p{L}\p{N}_.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?[\p{L}\p{N}_])", 0.95),
    "US_PASSPORT": (r"(?=[A-Z]\d)(?<![\p{L}\p{N}_])[A-Z]\d{8}(?![\p{L}\p{N}_])", 0.4),
}


def luhn(number: Column) -> Column:
    """The check digit of a card number, blanks and dashes ignored."""
    digits = F.transform(F.filter(F.split(F.regexp_replace(number, r"\D", ""), ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def find_all(text: Column, pattern: str, kind: str, score: float) -> Column:
    """Every match as (type, start, end, score, text); start inclusive, end exclusive.

    A match starts after the gaps and matches before it, so offsets come from one split.
    """
    def place(hits: Column) -> Column:
        gaps = F.split(text, pattern)
        sizes = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("g"), F.length(h).alias("h")))
        starts = F.aggregate(
            sizes,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("s")),
            lambda acc, x: F.struct((acc["at"] + x["g"] + x["h"]).alias("at"), F.concat(acc["s"], F.array(acc["at"] + x["g"])).alias("s")),
        )["s"]
        spans = F.zip_with(
            hits, starts,
            lambda h, s: F.struct(F.lit(kind).alias("type"), s.alias("start"), (s + F.length(h)).alias("end"), F.lit(score).alias("score"), h.alias("text")),
        )
        return F.filter(spans, lambda x: luhn(x["text"])) if kind == "CREDIT_CARD" else spans

    empty = F.array().cast("array<struct<type:string,start:int,end:int,score:double,text:string>>")
    possible = F.contains(text, F.lit("@")) if kind == "EMAIL_ADDRESS" else text.rlike(r"\d\d|\d\.")
    found = F.when(possible, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(F.array().cast("array<string>"))
    return let(found, lambda hits: F.when(F.size(hits) > 0, place(hits)).otherwise(empty))


def detect_pii(text: Column, above: float = 0.7) -> Column:
    """Spans of personal data surer than ``above``. People and places need a model: see ``usercode``."""
    found = F.concat(*[find_all(text, p, kind, score) for kind, (p, score) in PII_PATTERNS.items()])
    return F.filter(found, lambda x: x["score"] > above)


def mask_pii(text: Column) -> Column:
    """Every finding, sure or not, replaced by its type in angle brackets."""

    def mask(acc: Column, kind: str, pattern: str) -> Column:
        if kind != "CREDIT_CARD":
            return F.regexp_replace(acc, pattern, f"<{kind}>")
        # By place: a number that is valid here may stand inside a longer one that is none.
        found = F.transform(F.regexp_extract_all(acc, F.lit(pattern), 0), lambda m: F.when(luhn(m), F.lit(f"<{kind}>")).otherwise(m))
        between = F.split(acc, pattern, -1)
        return F.array_join(F.zip_with(between, F.array_append(found, F.lit("")), lambda text_, m: F.concat(text_, m)), "")

    return reduce(lambda acc, kv: mask(acc, kv[0], kv[1][0]), PII_PATTERNS.items(), text)
