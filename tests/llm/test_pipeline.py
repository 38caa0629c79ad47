"""The corpus pipeline, stage by stage with the stages' own parameters, against brute force."""

import collections
import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from samples import CLASHING
from test_documents import grouped_by_links, lower, plain_words, tokenizer

STAGE = dict(corpus_pipeline.STAGES)
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def sentences(pick, words, n):
    return " ".join(pick.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two languages, near copies of 0.7 to 1, shared passages, leaks, odd rows; a folder as the driver gives it."""
    pick = random.Random(21)
    tongues = {"aa": [f"{a}{b}ana" for a in "brtkl" for b in "aeiou"] + ["rama", "nana"], "zz": [f"{a}{b}otz" for a in "qxwzj" for b in "aeiou"] + ["quix", "tzut"]}
    items = [(i, sentences(pick, tongues["zz"], n)) for i, n in enumerate((25, 12, 4))]
    rows = []
    for i in range(160):
        lang = ("aa", "zz")[i % 3 == 0]
        rows.append([i, sentences(pick, tongues[lang], pick.randrange(60, 140)), lang])
    base = rows[0][1].split()
    for i, edits in enumerate((0, 1, 1, 2, 3, 4, 6, 9)):
        own = list(base)
        for at in pick.sample(range(len(own)), edits):
            own[at] = "rama"
        rows.append([200 + i, " ".join(own).upper() if i == 2 else " ".join(own), "aa"])
    passage = sentences(pick, tongues["aa"], 55)
    for i in range(4):
        words = rows[10 + 2 * i][1].split()
        rows[10 + 2 * i][1] = " ".join(words[:20]) + "\n" + passage + " " + " ".join(words[20:])
    rows[30][1] += ". " + " - ".join(items[0][1].split()[5:18]).upper()
    rows[33][1] += " " + items[2][1]
    rows += [[300, None, "aa"], [301, "", "zz"], [302, "12 !?", None], [None, sentences(pick, tongues["zz"], 70), "zz"], [303, rows[40][1], "aa"], [40, rows[40][1], "aa"], [41, sentences(pick, tongues["aa"], 66), "aa"]]
    docs = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def pairs(frame):
    return collections.Counter((r.doc_id, r.text) for r in frame.collect())


def brute_repeats(rows, window=35):
    where = collections.Counter()
    split = [plain_words(t) for _, t in rows]
    for w in split:
        where.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = collections.Counter()
    for (key, text), w in zip(rows, split, strict=True):
        gone = {p for i in range(len(w) - window + 1) if where[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        out[key, " ".join(x for i, x in enumerate(w) if i not in gone) if gone else text] += 1
    return out


def leaks(text, items, window=10):
    words, found = ALNUM.findall(lower(text)), False
    for _, item in items:
        own = ALNUM.findall(lower(item))
        for i in range(max(1, len(own) - window + 1) if own else 0):
            part = own[i : i + window]
            found |= any(words[k : k + len(part)] == part for k in range(len(words) - len(part) + 1))
    return found


def test_stage_names():
    assert list(STAGE) == ["language_id", "jaccard_join", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]


def test_language_stage(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = pairs(STAGE["language_id"](spark, docs, folder))
    assert got == collections.Counter((i, t) for i, t, _ in rows if t and any(c.isalpha() for c in t))


def test_jaccard_stage(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = pairs(STAGE["jaccard_join"](spark, docs, folder))
    sets, roots = grouped_by_links([t for _, t, _ in rows], 5, 80)
    groups = collections.defaultdict(list)
    for (key, text, _), own, root in zip(rows, sets, roots, strict=True):
        groups[root if own else ("empty", key)].append((key, text))
    want = set()
    for members in groups.values():
        ids = [k for k, _ in members if k is not None]
        want.add((min(ids) if ids else None, next(t for k, t in members if k == (min(ids) if ids else None))))
    assert max(len(m) for m in groups.values()) >= 4 and any(1 < len(m) for m in groups.values())
    assert got == collections.Counter({x: 1 for x in want})


def test_substring_stage(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = STAGE["substring_dedup"](spark, docs, folder)
    assert pairs(out) == brute_repeats([(k, t) for k, t, _ in rows])
    assert all(r.n_chars == len(r.text) for r in out.filter("text IS NOT NULL").collect())


def test_decontamination_stage(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = pairs(STAGE["benchmark_decontamination"](spark, docs, folder))
    want = collections.Counter((k, t) for k, t, _ in rows if not leaks(t, items))
    assert got == want and 1 < len(rows) - sum(want.values()) < len(rows) / 2


def check_packing(rows, packed, capacity=2048):
    ids = tokenizer("byte_bpe_50k.json")
    want = collections.Counter()
    for key, text in rows:
        n = len(ids(text)) + 1
        sizes = ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)
        want.update((key, i, sum(sizes[:i]), s) for i, s in enumerate(sizes))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length) for r in packed) == want
    held = collections.defaultdict(list)
    for r in packed:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places[:-1], places[1:], strict=True)) and sum(places[-1]) <= capacity


def test_packing_stage(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check_packing([(k, t) for k, t, _ in rows], STAGE["best_fit_packing"](spark, docs, folder).collect())


def test_stages_keep_the_columns(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit(c))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        row = out.filter("doc_id = 5").first()
        assert all(row[c] == c for c in CLASHING), name


def test_run(spark, tables):
    """All stages one after the other: what brute force says of each stage's input, then packed."""
    folder, rows, items = tables
    kept = [(k, t) for k, t, _ in rows if t and any(c.isalpha() for c in t)]
    _, roots = grouped_by_links([t for _, t in kept], 5, 80)
    best = {}
    for row, root in zip(kept, roots, strict=True):
        if root not in best or (row[0] is not None and (best[root][0] is None or row[0] < best[root][0])):
            best[root] = row
    cut = [row for row, n in brute_repeats(list(best.values())).items() for _ in range(n)]
    check_packing([row for row in cut if not leaks(row[1], items)], corpus_pipeline.run(spark, folder).collect())


def test_run_on_empty_tables(spark, tables, tmp_path):
    folder, _, _ = tables
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
