"""Mixing and resharding."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.llm import entropy_mix, reshard


def documents(spark, sizes, extra=()):
    rows = [(i, " ".join(["w"] * n) if n is not None else None, s) for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows + list(extra), "doc_id long, text string, source string").withColumn("target", F.lit("x"))


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def rates_by_hand(sizes, target, most=3):
    """Bisection on the multiplier."""
    x = np.array(sizes) / np.mean(sizes)
    low, high = -1e4, 1e4
    for _ in range(300):
        middle = (low + high) / 2
        taken = (np.minimum(most, np.exp(np.minimum(middle * x, 50))) * sizes).sum()
        low, high = (middle, high) if taken < target else (low, middle)
    return np.minimum(most, np.exp(np.minimum(high * x, 50)))


def test_targets_rates_and_copies(spark):
    draw = random.Random(4)
    sizes = [(s, draw.choice([1, 5, 40, 90, 300])) for s in ("b", "a", "d", None) for _ in range({"b": 200, "a": 4, "d": 60, None: 30}[s])]
    sizes += [("e", 0), ("e", None)]
    docs = documents(spark, sizes)
    mix = entropy_mix.plan_mix(docs)
    got = mix.copies(docs).collect()
    by_source = {}
    for s, n in sizes:
        by_source.setdefault(s, []).append(n or 0)
    want = targets_by_hand({s: sum(v) for s, v in by_source.items()})
    multiplier = {r.source: (r.multiplier, r.mean, r.full) for r in mix.state.collect()}
    for source, own in by_source.items():
        rows = [r for r in got if r.source == source]
        taken = sum(r.copies * r.size for r in rows)
        assert {r.source_size for r in rows} == {sum(own)}
        assert all(abs(r.target - want[source]) < 1e-6 * max(1, want[source]) for r in rows)
        assert abs(taken - want[source]) <= max(own) / 2 + 1e-6
        assert all(0 <= r.copies <= 3 for r in rows)
        m, mean, full = multiplier[source]
        if sum(own) and not full:
            expected = rates_by_hand([n for n in own if n], want[source]) if 0 not in own else None
            if expected is not None:
                assert np.allclose(np.minimum(3, np.exp(m * np.array(own) / mean)), expected, rtol=1e-5)
                assert all(abs(r.copies - e) < 1 + 1e-6 for r, e in zip(sorted(rows, key=lambda r: r.doc_id), expected))
    again = entropy_mix.plan_mix(docs.repartition(7)).copies(docs)
    assert {(r.doc_id, r.copies) for r in again.collect()} == {(r.doc_id, r.copies) for r in got}
    assert mix.take(docs).columns == docs.columns and mix.take(docs).count() == sum(r.copies for r in got)


def test_mix_edge_cases(spark):
    twice = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "a b", "t"), (2, "", "t"), (3, "x\x0b y\x1f", "u")]
    docs = spark.createDataFrame(twice, "doc_id long, text string, source string")
    got = entropy_mix.plan_mix(docs).copies(docs).collect()
    assert len(got) == 5 and sorted(r.size for r in got) == [0, 2, 2, 3, 3]
    assert len({r.copies for r in got if r.doc_id == 1}) == 1
    none = docs.limit(0)
    assert entropy_mix.plan_mix(none).take(none).count() == 0


def test_flow_is_least():
    flow = reshard.minimum_cost_flow([5, 9], [4, 4, 6], [[0, 2, 1], [3, 0, 1]])
    assert [sum(r) for r in flow] == [5, 9] and [sum(c) for c in zip(*flow)] == [4, 4, 6]
    assert sum(f * c for fs, cs in zip(flow, [[0, 2, 1], [3, 0, 1]]) for f, c in zip(fs, cs)) == 6
    assert reshard.minimum_cost_flow([0, 0], [0], [[0], [1]]) == [[0], [0]]
    with pytest.raises(ValueError, match="less than the supplies"):
        reshard.minimum_cost_flow([5], [4], [[0]])


def test_shards_are_even_whole_and_move_little(spark):
    draw = random.Random(9)
    rows = [(i, "ä" * draw.randint(0, 60), None) for i in range(3000)] + [(5000, None, "n"), (None, "é", "n"), (7, "again", "x"), (7, "again", "x"), (6000, "z" * 4000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    plan = reshard.plan_resharding(docs, shards=6, old_shards=4)
    out = reshard.reshard(docs, shards=6, old_shards=4)
    got = out.withColumn("old", F.expr(reshard.old_shard("doc_id", 4))).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t, _ in rows)
    assert all(r["size"] == len((r.text or "").encode()) + 8 for r in got)
    total = sum(r["size"] for r in got)
    by_shard = {j: [r for r in got if r.shard == j] for j in range(6)}
    for own in by_shard.values():
        assert abs(sum(r["size"] for r in own) - total / 6) <= 200
        assert sorted(r.slot for r in own) == list(range(len(own)))
    moved = sum(r["size"] for r in got if r.shard != r.old)
    supply = [sum(r["size"] for r in got if r.old == i) for i in range(4)]
    least = sum(max(0, s - total / 6) for s in supply)
    assert moved <= least + 1000 and abs(moved - plan.moved_bytes) <= 1000


def test_large_documents_take_the_places_of_the_flow():
    wanted, cost = [100, 100, 100], [[int(i != j) for j in range(3)] for i in range(2)]
    transfers = reshard.minimum_cost_flow([150, 150], wanted, cost)
    documents = [(0, 60), (1, 60), (0, 50), (1, 50), (0, 40), (1, 40)]
    found = reshard.fit_into_transfers(documents, transfers, wanted)
    assert found == [0, 1, 2, 2, 0, 1]
    assert reshard.fit_into_transfers([(0, 90), (0, 90)], [[100, 0], [0, 80]], [100, 80]) == [0, 1]
    assert reshard.fit_into_transfers([], transfers, wanted) == []


@pytest.mark.parametrize("rows", [40, 1500])
def test_moved_bytes_stay_near_the_flow(spark, rows):
    draw = random.Random(rows)
    docs = spark.createDataFrame([(i, "w" * draw.randint(1, 400)) for i in range(rows)], "doc_id long, text string")
    plan = reshard.plan_resharding(docs, shards=6, old_shards=4)
    assert plan.least_bytes <= plan.moved_bytes + 6 * 408 and plan.moved_bytes <= plan.least_bytes + 6 * 408


def test_unchanged_layout_is_not_rewritten(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * 12) for i in range(8)], "doc_id long, text string")
    plan = reshard.plan_resharding(docs, shards=2, old="cast(doc_id % 2 as int)", old_shards=2)
    assert plan.affected == [] and plan.moved_bytes == 0
    got = reshard.rewrite(docs, plan, str(tmp_path / "out"))
    assert sorted((r.doc_id, r.shard) for r in got.collect()) == [(i, i % 2) for i in range(8)]
    assert reshard.reshard(docs.limit(0)).count() == 0
