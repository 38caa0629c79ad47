"""Operators over documents against brute force, on odd rows."""

import collections
import hashlib
import math
import re
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from samples import CLASHING
from tokenizers import Tokenizer

from millrace.llm import components, decontaminate, fingerprints, huffman, jaccard, language, packing, pitmanyor, spans
from millrace.session import cut_lineage


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


@pytest.fixture(scope="module")
def numbered(odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, "no id here at all"), (None, None), (3, "One"), (3, "other text under a used id")]
    return rows


def grouped_by_links(texts, words=4, percent=85):
    sets = []
    for t in texts:
        w = plain_words(lower(t))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(sets))]


def test_jaccard_join(frame, numbered):
    got = jaccard.report(frame(numbered, CLASHING)).collect()
    sets, roots = grouped_by_links([t for _, t in numbered])
    least = {}
    for (key, _), root in zip(numbered, roots, strict=True):
        if key is not None:
            least[root] = min(least.get(root, key), key)
    want = collections.Counter()
    for (key, _), own, root in zip(numbered, sets, roots, strict=True):
        want[key, len(own), least.get(root, key) if own else key] += 1
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_jaccard_keeps_one_of_a_group(frame, numbered):
    docs = frame(numbered, CLASHING)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    _, roots = grouped_by_links([t for _, t in numbered])
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert max(got.values()) == 1
    linked = collections.defaultdict(list)
    for row, root in zip(numbered, roots, strict=True):
        linked[root].append(row)
    for rows in linked.values():
        if plain_words(rows[0][1]):
            assert sum(got[r] for r in set(rows)) == 1


def test_large_blocks_are_split(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "NODE", 8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        own = list(base)
        own[(7 * i) % 60] = f"x{i}"
        own[(11 * i) % 60] = f"y{i % 5}"
        rows.append((i, " ".join(own[: 60 - i % 4])))
    got = {r.doc_id: r.component_id for r in jaccard.report(frame(rows), rule=jaccard.Rule(1, 90)).collect()}
    _, roots = grouped_by_links([t for _, t in rows], 1, 90)
    assert got == dict(enumerate(roots))
    assert len(set(roots)) < 90


@pytest.mark.parametrize("words, percent", [(0, 80), (4, 49), (4, 101)])
def test_rules_that_would_lose_links_are_refused(words, percent):
    with pytest.raises(ValueError):
        jaccard.Rule(words, percent)


def test_links_of_the_least_rule(frame):
    """Sets of 32 and 64 shingles, one within the other, at 50 percent: bitmaps of different widths."""
    rows = [(i, " ".join(f"w{i // 3}x{k}" for k in range((32, 64, 65)[i % 3]))) for i in range(30)]
    got = {r.doc_id: r.component_id for r in jaccard.report(frame(rows), rule=jaccard.Rule(1, 50)).collect()}
    _, roots = grouped_by_links([t for _, t in rows], 1, 50)
    assert got == dict(enumerate(roots))


def test_one_phrase_in_every_text_and_a_full_bitmap(frame, monkeypatch):
    monkeypatch.setattr("millrace.llm.bitmaps.MOST_LOG2", 16)
    phrase = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([f"a{i}x{k}" for k in range(30)] + phrase[i % 3 :] + [f"b{i}x{k}" for k in range(i % 7 * 10)])) for i in range(120)]
    rows += [(500 + i, " ".join(f"c{i % 5}x{k}" for k in range(60))) for i in range(10)]
    got = {r.doc_id: r.n_removed for r in spans.report(frame(rows)).collect()}
    where = collections.Counter()
    split = {key: plain_words(t) for key, t in rows}
    for w in split.values():
        where.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    assert got == {k: len({p for i in range(len(w) - 34) if where[tuple(w[i : i + 35])] > 1 for p in range(i, i + 35)}) for k, w in split.items()}


def test_text_ids_have_no_order_in_a_store(frame):
    docs = frame([(1, "a b")])
    with pytest.raises(TypeError):
        huffman.round_trip(docs.withColumn("doc_id", F.col("doc_id").cast("string")), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def test_signature_tree_drops_no_link():
    pick = np.random.default_rng(1)
    rule = jaccard.Rule()
    universe = pick.integers(1, 2**63, 4000, dtype=np.uint64)
    sets = []
    for _ in range(25):
        base = pick.choice(universe, int(pick.integers(5, 300)), replace=False)
        for _ in range(6):
            sets.append(np.unique(np.concatenate([base[int(pick.integers(0, 1 + len(base) // 8)) :], pick.choice(universe, 2)])))
    sizes = np.array([len(s) for s in sets])
    none = np.zeros(len(sets), np.int64)
    pairs = {tuple(sorted(p)) for p in jaccard.block_pairs(rule, sizes, [jaccard.bits_of(s) for s in sets], np.arange(len(sets)), none, False)}
    linked = set()
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (sizes[i] + sizes[j] - both):
                linked.add((j, i))
    assert linked <= pairs and len(pairs) < len(sets) ** 2 / 8


@pytest.mark.parametrize("at_once", [500_000, 40])
def test_components(spark, monkeypatch, at_once):
    monkeypatch.setattr(components, "EDGES_AT_ONCE", at_once)
    pick = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in pick.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}


def test_substring_dedup(frame, numbered):
    got = spans.report(frame(numbered, CLASHING)).collect()
    where = collections.Counter()
    for _, text in numbered:
        w = plain_words(text)
        where.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    want = collections.Counter()
    for key, text in numbered:
        w = plain_words(text)
        gone = {p for i in range(len(w) - 34) if where[tuple(w[i : i + 35])] > 1 for p in range(i, i + 35)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[key, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, got)) == want
    assert any(n for _, _, n, _ in want)


def test_removing_repeats_leaves_clean_rows(frame, numbered):
    docs = frame(numbered, CLASHING)
    got = spans.remove_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(numbered)
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id not in (None, 3)}
    assert by_id[9].text == numbered[9][1] and by_id[0].text is None
    assert by_id[10].text == "" and by_id[10].n_chars == 0


def test_decontamination(frame, spark, numbered, odd_texts):
    items = [("q1", " ".join(odd_texts[17].split()[20:70])), ("q2", "No ID, here!"), ("q3", None), ("q4", ""), (None, "w1 w2"), ("q5", "No ID, here!")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = {}
    for item, text in items:
        w = word.findall(lower(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item or "")
    want = collections.Counter()
    for key, text in numbered:
        w, hit, found = word.findall(lower(text)), set(), set()
        for window, owners in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= owners
        want[key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    docs = frame(numbered, CLASHING)
    assert collections.Counter(map(tuple, decontaminate.report(docs, bench).collect())) == want
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(n for k, n in want.items() if not k[-1])


def test_decontamination_in_blocks_and_places(frame, spark):
    bench = spark.createDataFrame([(i, " ".join(f"t{i}x{j}" for j in range(14))) for i in range(12)], "item_id long, text string")
    text = "É: start " + " ".join(f"T3x{j}" for j in range(2, 13)) + ", end"
    docs = frame([(1, text), (2, "nothing")])
    parts = decontaminate.windows_of(bench)
    one, many = (decontaminate.scan(docs, parts, block_bytes=b).orderBy("row.doc_id").collect() for b in (1 << 20, 600))
    assert [(r.intervals, r.spans, r["items"]) for r in one] == [(r.intervals, r.spans, r["items"]) for r in many]
    low, high = one[0].spans[0]
    assert text[low:high] == " ".join(f"T3x{j}" for j in range(2, 13)) and one[0]["items"] == ["3"]


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_packing(frame, numbered):
    ids = tokenizer("byte_bpe_50k.json")
    path = public_tokenizers.path("byte_bpe_50k.json")
    placed = cut_lineage(packing.pack(frame(numbered, CLASHING), path, end_id=0, capacity=256, keep_ids=True), "placed")
    want = collections.Counter()
    for key, text in numbered:
        own, start = ids(text) + [0], 0
        for piece, width in enumerate(packing.piece_lengths(len(own), 256)):
            want[key, piece, start, width, zlib.crc32(np.array(own[start : start + width], "<u4").tobytes())] += 1
            start += width
    rows = placed.collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        end = 0
        for offset, width in sorted(places):
            assert offset == end
            end += width
        assert end <= 256
    bound = -(-sum(k[3] * n for k, n in want.items()) // 256)
    assert len(held) <= bound + 1
    assert sorted(len(r.ids) // 4 for r in packing.sequences(placed).collect()) == sorted(sum(w for _, w in p) for p in held.values())


@pytest.mark.parametrize("capacity", [1, 7, 40])
def test_plans_use_every_piece_once(capacity):
    pick = np.random.default_rng(capacity)
    for _ in range(200):
        histogram = {int(x): int(n) for x, n in zip(pick.integers(1, capacity + 1, 9), pick.integers(1, 30, 9), strict=True)}
        used = collections.Counter()
        plan = packing.Plan(dict(histogram), capacity)
        for times, lengths in plan.classes:
            assert sum(lengths) <= capacity
            for x in lengths:
                used[x] += times
        assert used == collections.Counter(histogram)


def test_token_store(frame, numbered, spark, tmp_path):
    ids = tokenizer("word_bpe_49k.json")
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = frame(numbered, CLASHING)
    rows = huffman.round_trip(docs, path, end_id=2, folder=str(tmp_path / "store")).collect()
    want = collections.Counter()
    for key, text in numbered:
        own = ids(text) + [2]
        want[key, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    start, keys = 0, []
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
        keys.append(-1 if r.doc_id is None else r.doc_id)
    assert keys == sorted(keys)
    assert spark.read.parquet(str(tmp_path / "store" / "blocks")).count() > 1


def test_code_lengths_are_optimal_and_limited():
    import heapq

    pick = np.random.default_rng(0)
    for size in (2, 3, 17, 300):
        counts = pick.integers(1, 1000, size) ** 2
        heap, total, step = [(int(c), i) for i, c in enumerate(counts)], 0, size
        heapq.heapify(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            total += a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], step := step + 1))
        assert (huffman.code_lengths(counts, 40) * counts).sum() == total
        short = huffman.code_lengths(counts, 9)
        assert short.max() <= 9 and np.sum(2.0**-short) <= 1


def test_language(frame):
    texts = {"aa": ["bana rama", "rama nana bana"], "zz": ["quix xotz", "zotz quix tz"]}
    rows = [(i, f"{texts[lang][i % 2]} {i % 7}", lang, "s", 1) for i in range(200) for lang in [("aa", "zz")[i % 3 == 0]]]
    rows += [(900, None, "aa", "s", 0), (901, "", "zz", "s", 0), (902, "12 !?", "aa", "s", 0), (903, "RAMA", None, None, None), (None, "quix", "zz", "s", 1)]
    docs = frame(rows, CLASHING)
    got = {r.doc_id: r for r in language.report(docs).collect()}
    assert len(got) == len(rows)
    for key, text, lang, _, _ in rows:
        r = got[key]
        assert r.held_out == (zlib.crc32(b"" if key is None else str(key).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif lang:
            assert r.lang_pred == lang
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({900, 901, 902})


def test_language_is_told_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    right = [r.lang_pred == truth[r.doc_id] for r in language.report(docs).collect() if r.held_out]
    assert len(right) > 20 and sum(right) / len(right) > 0.95


def test_language_without_labels(frame):
    rows = [(1, "some text", None, "s", 9), (2, None, None, "s", 0)]
    assert {(r.lang_pred, r.score) for r in language.report(frame(rows)).collect()} == {("und", 0.0)}


def test_pitman_yor(frame, numbered, monkeypatch):
    monkeypatch.setattr(pitmanyor, "CHUNK", 4000)
    monkeypatch.setattr(pitmanyor, "BUCKET", 9000)
    got = pitmanyor.score(frame(numbered, CLASHING)).collect()
    tokens = [plain_words(lower(t)) + [None] for _, t in numbered]
    held = [pitmanyor.remainder(k) == 1 for k, _ in numbered]
    counts = collections.Counter(x for t, h in zip(tokens, held, strict=True) if not h for x in t)
    total, types = sum(counts.values()), len(counts)
    want = collections.Counter()
    for (key, _), own, out in zip(numbered, tokens, held, strict=True):
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (types + 1))) for x in own)
        want[key, out, len(own), sum(counts[x] > 0 for x in own), total, round(base, 4)] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert not [x for x in frame([]).sparkSession.catalog.listTables() if x.name.startswith("buckets")]


def test_pitman_yor_beats_its_base_on_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [r for r in pitmanyor.score(docs).collect() if r.held_out]
    assert len(out) > 20
    assert sum(r.score for r in out) / sum(r.n_tokens for r in out) > 0.1 + sum(r.base_score for r in out) / sum(r.n_tokens for r in out)


def test_predictive_probabilities_sum_to_one():
    """Every context's probabilities over the known words and the unseen type."""
    pick = np.random.default_rng(3)
    words = np.sort(pick.integers(1, 2**63, 30, dtype=np.uint64))
    contexts = np.arange(4)
    counts = pick.integers(0, 9, (30, 4))
    counts[0] = 1
    layout = pitmanyor.Layout(np.array([7, 9], np.uint64), 1)
    blob = pitmanyor._pairs_blob(np.repeat(words, 4), np.tile(contexts, 30), counts.ravel())
    unseen = pitmanyor._pairs_blob(np.full(4, 5, np.uint64), contexts, np.zeros(4, np.int64))
    bucket, other = pitmanyor.Bucket(0, blob, layout), pitmanyor.Bucket(0, unseen, layout)

    def world(last):
        sums = bucket.sums()
        rows = [SimpleNamespace(kind=int(k), id=int(i), n=int(n)) for k, i, n in zip(sums["kind"], sums["id"], sums["n"], strict=True)]
        return pitmanyor._world(rows, layout, last)

    now = world(None)
    for _ in range(4):
        bucket.sweep(now)
        now = world(now)
    total = bucket.predictive(now).reshape(30, 4).sum(axis=0) + other.predictive(now)
    assert np.allclose(total, 1, atol=0.02)


def test_every_training_word_is_a_context(frame, monkeypatch):
    """Rare words keep their own restaurants, also where their pairs lie in several buckets."""
    monkeypatch.setattr(pitmanyor, "CONTEXT_LOG2", 3)
    monkeypatch.setattr(pitmanyor, "BUCKET", 300)
    learn = [k for k in range(2000) if pitmanyor.remainder(k) != 1]
    held = [k for k in range(2000) if pitmanyor.remainder(k) == 1]
    rows = [(k, f"a{n % 30} b{n % 30}") for n, k in enumerate(learn[:600])]
    rows += [(k, f"a{n} b{n}") for n, k in enumerate(held[:30])] + [(k, f"a{n} b{(n + 1) % 30}") for n, k in enumerate(held[30:60])]
    got = {r.doc_id: r.score for r in pitmanyor.score(frame(rows)).collect()}
    # After a{n} its own b{n} was seen 20 times and nothing else ever.
    for n in range(30):
        assert got[held[n]] > got[held[30 + n]] + 1
    monkeypatch.setattr(pitmanyor, "CONTEXT_LOG2", 16)
    on_driver = {r.doc_id: r.score for r in pitmanyor.score(frame(rows)).collect()}
    assert max(abs(got[k] - on_driver[k]) for k in got) < 0.3


def test_ends_of_texts_are_dealt_over_the_buckets(frame, monkeypatch):
    monkeypatch.setattr(pitmanyor, "BUCKET", 300)
    layouts = []
    make = pitmanyor.Layout
    monkeypatch.setattr(pitmanyor, "Layout", lambda *a: layouts.append(make(*a)) or layouts[-1])
    pitmanyor.score(frame([(k, f"u{k}") for k in range(900)]))
    layout, end = layouts[0], np.full(900, pitmanyor.END)
    own, contexts = layout.place(end), np.arange(900) + pitmanyor.OWN
    assert layout.buckets > 4
    sizes = np.bincount(layout.bucket(end, own, contexts, end), minlength=layout.buckets)
    assert sizes.max() < 2 * 900 / layout.buckets


def test_without_training_texts_all_is_unseen(frame):
    held = next(k for k in range(99) if pitmanyor.remainder(k) == 1)
    assert [(r.n_known, r.score) for r in pitmanyor.score(frame([(held, "a b")])).collect()] == [(0, 0.0)]


def test_seating_matches_one_by_one():
    """The number of tables, drawn with and without the closed form for late customers."""
    customers, strength = np.full(4000, 900), np.full(4000, 0.8)
    quick = pitmanyor.seat(customers, strength, 0.5, np.random.default_rng(1))
    pick, slow = np.random.default_rng(2), np.ones(4000)
    for seated in range(1, 900):
        slow += pick.random(4000) * (0.8 + seated - 0.5 * slow) < 0.8
    assert abs(quick.mean() - slow.mean()) < 0.15 and quick.min() >= 1


def test_fingerprints(frame, odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, "without an id")]
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(frame(rows, CLASHING)).collect()}
    order = [k for k, _ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)]
    body = {k: t or "" for k, t in rows}
    by_text = collections.defaultdict(set)
    for at, key in enumerate(order):
        text, following = body[key], body[order[(at + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        by_text[text].add(r.fingerprint)
        by_text[edited].add(r.edited_fingerprint)
        for near, other in ((r.near_edited, edited), (r.near_next, following)):
            a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (plain_words(text), plain_words(other)))
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - true) < 0.2 and 0 <= near <= 1
    assert all(len(prints) == 1 for prints in by_text.values())
    assert got[0].fingerprint == "" and len(got[3].fingerprint) == fingerprints.BINS * fingerprints.BITS // 4


def test_empty_tables(spark, frame):
    none = frame([(1, "x")], CLASHING).filter("doc_id > 5")
    bench = spark.createDataFrame([], "item_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    results = [
        jaccard.report(none), jaccard.keep_one(none), spans.report(none), decontaminate.report(none, bench), decontaminate.keep_clean(none, bench),
        packing.pack(none, path, 0), huffman.round_trip(none, path, 2), language.report(none), language.keep_identified(none),
        pitmanyor.score(none), fingerprints.fingerprint_edits(none),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_an_empty_benchmark_hits_nothing(frame, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.report(frame([(1, "a b"), (2, None)]), bench).collect()
    assert [(r.n_hit, r.contaminated) for r in rows] == [(0, False)] * 2


def test_no_python_in_native_operators(frame):
    plan = fingerprints.fingerprint_edits(frame([(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and plan.count("Window") >= 1


def test_frames_of_many_columns_pass_through(frame):
    docs = frame([(1, "a b c"), (2, None)]).withColumn("a strange name", F.lit(1))
    assert language.keep_identified(docs).columns == docs.columns
    assert spans.remove_repeats(docs).columns == docs.columns
