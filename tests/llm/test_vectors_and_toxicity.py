"""Vector classes against brute force; segment search and calibration."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tenderlake.llm import grid_join
from tenderlake.llm import toxic_segments as S


def classes_by_hand(rows, cosine=0.98):
    good = {i: np.array(v) for i, v, lab in rows
            if None not in (i, v, lab) and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    label = {i: (lab, len(v)) for i, v, lab in rows if i in good}
    parent, links = {i: i for i in good}, dict.fromkeys(good, 0)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in good:
        for b in good:
            if a < b and label[a] == label[b]:
                if good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return {i: (links[i], root(i)) for i in good}


def test_vector_classes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(grid_join, "BLOCK", 16)
    monkeypatch.setattr(grid_join, "_LEAF", 4)
    rng = np.random.default_rng(7)
    rows = []
    for _ in range(12):
        base = rng.normal(size=5)
        for _ in range(int(rng.integers(1, 25))):
            rows.append((len(rows) * 2, [float(x) for x in base + rng.normal(size=5) * 0.12], int(rng.integers(0, 2))))
    rows += [(1001 + k, rows[3][1], rows[3][2]) for k in range(20)]  # equal vectors
    rows += [(2001, None, 1), (2002, [0.0] * 5, 1), (2003, [1.0, None, 0.0, 0.0, 0.0], 1), (2004, [float("nan")] * 5, 1), (2005, [float("inf")] * 5, 1),
             (2006, rows[0][1], None), (2007, [1.0, 2.0], 0), (2008, [2.0, 4.0], 0), (2009, [], 0)]
    table = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows + [rows[5]]], "vec_id long, embedding array<double>, label int, kept string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in grid_join.vector_classes(table).collect()}
    want = classes_by_hand(rows)
    assert got == {i: want.get(i, (0, i)) for i, _, _ in rows}
    out = grid_join.vector_classes(table)
    assert out.count() == len(rows) + 1 and out.where("kept <> (vec_id = component_id)").count() == 0


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert grid_join.vector_classes(none).count() == 0
    lone = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, None, None)], "vec_id long, embedding array<float>, label int")
    assert sorted(str(tuple(r)) for r in grid_join.vector_classes(lone).collect()) == ["(5, 0, 5, True)", "(None, 0, None, False)"]


def segments_by_hand(scores, offset=0):
    """By the definition: the best segment, then the same to its left and right."""
    best = (0.0, 0, 0)
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            total = sum(scores[a:b])
            if total > best[0] + 1e-9 or (abs(total - best[0]) <= 1e-9 and total > 0 and b - a < best[2] - best[1]):
                best = (total, a, b)
    total, a, b = best
    if total <= 0:
        return []
    return segments_by_hand(scores[:a], offset) + [(a + offset, b + offset, total)] + segments_by_hand(scores[b:], offset + b)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-40, 40).map(lambda k: k + 0.37 * (k % 7) / 7), max_size=14))
def test_maximal_segments(scores):
    got, want = S.maximal_segments(np.array(scores, float)), segments_by_hand(scores)
    assert np.isclose(sum(s for _, _, s in got), sum(s for _, _, s in want))
    assert [s for _, _, s in got] == sorted([s for _, _, s in got], key=lambda x: 0)
    assert all(b <= c for (_, b, _), (c, _, _) in zip(got, got[1:]))
    assert all(np.isclose(sum(scores[a:b]), s) and s > 0 for a, b, s in got)
    if want:
        assert np.isclose(max(s for _, _, s in got), max(s for _, _, s in want))


def toxic_corpus(n=900):
    draw = random.Random(2)
    clean = [f"{a}{b}" for a in ("lo", "ma", "ne", "ti", "su") for b in ("ra", "po", "ki", "den", "vol", "mer")]
    bad = ["idiotling", "idiotisch", "scumbag", "scumling"]
    docs, labels = [], []
    for i in range(n):
        words = draw.choices(clean, k=draw.randint(10, 120))
        toxic = int(i % 7 == 0)
        if toxic:
            at = draw.randrange(len(words))
            words[at:at] = [w for _ in range(3) for w in (draw.choice(bad), draw.choice(clean))]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_toxic_passages_are_found_in_held_out_rows(spark):
    docs, labels = toxic_corpus()
    docs += [(9001, None), (9002, ""), (9003, "rano " * 40_000 + "idiotling scumbag idiotisch scumling"), (9004, "!!")]
    table = spark.createDataFrame([(i, t, "t") for i, t in docs], "doc_id long, text string, toxicity string")
    known = spark.createDataFrame([*labels, (3, 1, None), (None, 0, 1), (5, 0, 0), (7777, 0, 1)], "doc_id long, quality int, toxic int")
    held_out = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    model = S.fit(table, known.where(f"not ({held_out})"), "crc32(cast(cast(id as string) as binary)) % 4 = 3")
    found = {r.doc_id: r for r in S.score_toxicity(table, model).selectExpr("doc_id", "toxicity.*", f"{held_out} as held_out").collect()}
    truth = {i: t for i, _, t in labels}
    test = [i for i in truth if found[i].held_out]
    right = [(found[i].score >= S.THRESHOLD) == bool(truth[i]) for i in test]
    assert len(test) > 150 and np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    assert found[9001].score == found[9002].score == found[9004].score == min(r.score for r in found.values())
    hit = found[9003].segments[0]
    assert (hit.begin, hit.stop) == (40_000, 40_004) and hit.expected < 0.05
    assert found[9003].score >= S.THRESHOLD


def test_without_labels_all_texts_score_alike(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = S.fit(docs, none, "true")
    assert len({r.toxicity.score for r in S.score_toxicity(docs, model).collect()}) == 1
    assert S.score_toxicity(docs.limit(0), model).count() == 0


def test_every_passage_adds_to_the_score():
    model = S.Model({"vil": 4.0, "off": -2.0}, rate=1.0, scale=0.1, curve=(-4.0, 0.5))
    gap = "off " * 30
    text = lambda n: (gap + "vil vil vil ") * n + gap * (20 - n)
    scores = [model.judge(text(n))[0] for n in (1, 2, 5, 20)]
    assert scores == sorted(set(scores)) and len(model.judge(text(20))[1]) == 20
    words, found = model.segments(text(1))
    assert model.evidence(words, [s for _, _, s in found]) == model.surprise(words, found[0][2])
