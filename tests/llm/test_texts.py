"""N-gram classes, decontamination and language identification against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.llm import decontaminate, jaccard_join, ppm_language
from tenderlake.llm.arrays import BLANK_SEPARATED, Bloom, pack, pack_sorted, split_words, unpack, unpack_sorted, window_hashes
from tenderlake.llm.graph import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def classes_by_hand(rows, width=5, percent=75):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        grams = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        sets[i] = grams
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(seed):
    """Bases with chains of small edits, so that links do not carry over to all members of a class."""
    draw, rows = random.Random(seed), []
    words = [f"w{k}" for k in range(400)]
    shared = " ".join(draw.choices(words, k=12))
    for _ in range(6):
        text = draw.choices(words, k=draw.randint(30, 80))
        for _ in range(draw.randint(1, 9)):
            rows.append(" ".join(text) + (f" {shared}" if draw.random() < 0.5 else ""))
            text = list(text)
            for _ in range(draw.randint(0, 3)):
                text[draw.randrange(len(text))] = draw.choice(words)
    return [(i * 3 + 1, t) for i, t in enumerate(draw.sample(rows, len(rows)))]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)  # so that the order of n-grams matters
    extra = [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "One two"), (9005, "oNE\x0btwo"), (9006, "one  two three"),
             (9007, "A b c d e"), (9008, "a B c D e"), (9009, "x " * 30_000)]
    rows = corpus(seed) + extra
    docs = spark.createDataFrame([(i, t, "id", 0.5) for i, t in rows], "doc_id long, text string, id string, component double").repartition(3)
    got = {r.id: r.component for r in jaccard_join.jaccard_classes(docs).collect()}
    want = classes_by_hand(rows)
    assert {i: got.get(i, i) for i, _ in rows} == {i: c for i, (_, c) in want.items()}
    sizes = {r.doc_id: r.n for r in docs.select("doc_id", jaccard_join.count_ngrams().alias("n")).collect()}
    assert sizes == {i: n for i, (n, _) in want.items()}


def test_one_document_of_each_class_stays(spark, rows):
    text = " ".join(f"w{k}" for k in range(40))
    data = [(1, text, "a"), (2, text + " end", "b"), (2, text + " end", "b"), (3, "other words here", "c"), (3, "other words here", "c"),
            (None, text, "d"), (None, None, "e"), (4, None, "f")]
    docs = spark.createDataFrame(data, "doc_id long, text string, id string")
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "id") == [("a",), ("c",), ("d",), ("e",), ("f",)]
    assert jaccard_join.keep_first(docs.limit(0)).count() == 0


def test_a_large_group_of_near_copies_is_one_class(spark):
    draw = random.Random(5)
    base = [f"b{k}" for k in range(60)]
    data = [(i, " ".join(base[:p] + [f"new{i}"] + base[p + 1 :])) for i, p in enumerate(draw.choices(range(60), k=150))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    want = {i: c for i, (_, c) in classes_by_hand(data).items()}
    got = {r.id: r.component for r in jaccard_join.jaccard_classes(docs).collect()}
    assert {i: got.get(i, i) for i, _ in data} == want


def test_components_of_chains_stars_and_rings(spark):
    edges = [(10, 9), (9, 8), (8, 7), (7, 7), (1, 20), (1, 21), (1, 22), (30, 31), (31, 32), (32, 30), (30, 31)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {7: 7, 8: 7, 9: 7, 10: 7, 1: 1, 20: 1, 21: 1, 22: 1, 30: 30, 31: 30, 32: 30}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_arrays_round_trip_and_hash_by_content():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64))
    assert (unpack_sorted(pack_sorted(values)) == values).all()
    assert (unpack(pack(values[::-1]), np.uint64) == values[::-1]).all()
    assert len(unpack_sorted(pack_sorted(values[:0]))) == 0
    words = split_words([b"One two", b"", b"two ONE\ttwo"], BLANK_SEPARATED)
    assert words.first.tolist() == [0, 2, 2, 5]
    h = words.hashes
    assert h[0] == h[3] and h[1] == h[2] == h[4] and h[0] != h[1]
    two = window_hashes(h, 2)
    assert two[0] == two[3] and two[0] != two[2]
    bloom = Bloom(500)
    bloom.add(values.astype(np.int64))
    assert bloom.holds(values.astype(np.int64)).all()
    assert bloom.holds(np.arange(10_000)).mean() < 0.1


def contamination_by_hand(texts, items, width=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    windows = {}
    for name, text in items:
        w = words(text)
        n = min(width, len(w))
        for p in range(len(w) - n + 1):
            if n:
                windows.setdefault(tuple(w[p : p + n]), set()).add(name)
    out = {}
    for i, text in texts:
        w, hit, names = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    names |= windows[tuple(w[p : p + n])]
        out[i] = (len(w), len(hit), {str(x) for x in names if x is not None})
    return out


@pytest.mark.parametrize("block", [250_000, 7])
def test_contamination_equals_brute_force(spark, block):
    draw = random.Random(3)
    vocabulary = ["Ähre", "b2", "c", "d", "E", "ф", "gg"]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 9, 10, 14])))) for k in range(6)]
    items += [(6, None), (7, ""), (8, "--"), (None, "only nameless words"), (2, items[2][1]), (11, items[3][1])]
    texts = [(i, "; ".join(draw.choices(vocabulary, k=draw.randint(0, 40)))) for i in range(20)]
    texts += [(30, items[4][1].upper() + "."), (31, None), (32, ""), (33, "Only, nameless WORDS!"), (34, "z " * 50_000 + items[4][1]), (34, "z")]
    texts = list(dict.fromkeys(texts))[:-1]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, contamination string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs, bench, block_windows=block)
    c = F.col("contamination")
    got = {r.doc_id: (r.n, r.hit, set(r.names)) for r in found.select(
        "doc_id", c.n_words.alias("n"), decontaminate.hit_words(c).alias("hit"), F.filter(c["items"], lambda x: x.isNotNull()).alias("names")
    ).collect()}
    assert got == contamination_by_hand(texts, items)


def test_contaminated_documents_go_or_lose_their_spans(spark, rows):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"Clean. {passage}, and on", 5), (2, "clean words", 6), (3, None, 7)], "doc_id long, text string, n int")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert rows(decontaminate.remove_contaminated(docs, bench)) == [(2, "clean words", 6), (3, None, 7)]
    assert rows(decontaminate.cut_contamination(docs, bench), "text") == [(None,), ("Clean. and on",), ("clean words",)]
    assert decontaminate.remove_contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.remove_contaminated(docs, bench.limit(0)).count() == 3


def code_length_by_hand(training, text, order):
    """Bits of a text by the definition: longest context first, escapes by the number of kinds."""
    import math
    from collections import Counter, defaultdict

    counts = defaultdict(Counter)
    for t in training:
        for i in range(len(t)):
            for k in range(min(order, i) + 1):
                counts[t[i - k : i]][t[i]] += 1
    bits = 0.0
    for i, symbol in enumerate(text):
        k = min(order, i)
        while True:
            seen = counts.get(text[i - k : i])
            if seen:
                total, kinds = sum(seen.values()), len(seen)
                if symbol in seen:
                    bits -= math.log2(seen[symbol] / (total + kinds))
                    break
                bits -= math.log2(kinds / (total + kinds))
            if k == 0:
                bits += 8
                break
            k -= 1
    return bits


def test_code_lengths_equal_the_definition(spark, monkeypatch):
    monkeypatch.setattr(ppm_language, "LEAST_SEEN", 1)
    training = {"a": ["abracadabra abra", "cadabra " * 3], "b": ["mississippi river", "missouri ripples"]}
    data = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in training.items() for t in ts)]
    model = ppm_language.fit(spark.createDataFrame(data, "doc_id long, text string, lang string"), order=3)
    texts = [b"abra miss", b"zzz", "é abracad".encode(), b"", b"mississippi abracadabra " * 40]
    got = model.code_lengths(texts) / 1024
    want = [[code_length_by_hand([t.encode() for t in training[lang]], text, 3) for lang in "ab"] for text in texts]
    assert np.allclose(got, want, atol=0.002 * max(map(len, texts)))


def test_rare_contexts_of_many_languages_count(spark):
    training = {f"l{k:02d}": [f"{chr(97 + k)}quick {chr(97 + k)}brown fox", "the same words"] for k in range(20)}
    data = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in training.items() for t in ts)]
    model = ppm_language.fit(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    texts = ["kquick kbrown".encode(), b"the same fox", b"zq"]
    want = [[code_length_by_hand([t.encode() for t in training[lang]], text, ppm_language.ORDER) for lang in training] for text in texts]
    assert np.allclose(model.code_lengths(texts) / 1024, want, atol=0.02)


def test_language_edge_cases(spark, rows):
    data = [(1, "the cat sat on the mat and the dog", "en", "q"), (2, "der hund und die katze sind im haus", "de", None),
            (3, None, "de", ""), (4, "12 34 !?", None, ""), (5, "", "en", ""), (6, "the dog and the cat", None, "s"), (6, "the dog and the cat", None, "s"),
            (7, "die katze und der hund " * 5000, None, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, score string")
    model = ppm_language.fit(docs)
    found = ppm_language.predict_language(docs, model)
    assert rows(found, "doc_id", "lang_pred") == sorted(
        [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en"), (7, "de")], key=str)
    assert all(0 <= r.score <= 1 for r in found.collect())
    nothing = ppm_language.fit(docs.where("lang = 'xx'"))
    assert nothing is None
    assert {r.lang_pred for r in ppm_language.predict_language(docs, nothing).collect()} == {"und"}
    kept = ppm_language.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == 5
    assert ppm_language.keep_known(docs.limit(0)).count() == 0
