"""Hard negatives against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from minewright.llm import negatives


def brute(rows, every=100, positives=5, negatives_=10):
    """``rows``: id to (label, list of integers)."""
    out = []
    width = max((len(v) for _, v in rows.values()), default=0)
    full = {i: np.array(v + [0] * (width - len(v)), object) for i, (_, v) in rows.items()}
    for a in rows:
        if a % every:
            continue
        scored = sorted((-int((full[a] * full[b]).sum()), b) for b in rows if b != a)
        near = [(b, -s) for s, b in scored if rows[b][0] == rows[a][0]][:positives]
        for p, ps in near:
            hard = [(b, -s) for s, b in scored if rows[b][0] != rows[a][0] and 30 * ps <= -100 * s <= 90 * ps][:negatives_]
            out += [(a, p, rank, b, ps, s) for rank, (b, s) in enumerate(hard, 1)]
    return sorted(out)


def found_by(df, **options):
    found = negatives.hard_negatives(df, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def table(spark, rows, schema="vec_id long, label int, vec array<int>"):
    names = "rank string, anchor string, leaf string, windows string, block string"
    full = [(*row, *["x"] * 5) for row in rows]
    return spark.createDataFrame(full, f"{schema}, {names}").repartition(3)


@pytest.mark.parametrize("spread", [0, 5, 300])
def test_equals_all_pairs(spark, spread):
    draw = random.Random(spread)
    centres = [[draw.randint(-300, 300) for _ in range(6)] for _ in range(8)]
    rows = {i: (draw.randint(0, 3), [c + draw.randint(-spread, spread) for c in draw.choice(centres)]) for i in range(900)}
    want = brute(rows, 30)
    assert len(want) > 100
    df = table(spark, [(i, *r) for i, r in rows.items()])
    for options in ({}, {"sample": 60, "arity": 3, "leaf_sample": 4, "block": 40}, {"sample": 1}):
        assert found_by(df, every=30, **options) == want


def test_odd_rows(spark):
    rows = [(0, 1, [1, 2]), (1, 1, [2, 4]), (2, 2, [1, 1]), (2, 3, [9, 9]), (3, None, [1, 1]), (4, 2, None), (None, 1, [5, 5]), (5, 2, [1, None]),
            (6, 2, [1]), (7, 2, [2]), (8, 1, []), (100, 7, [3, 3]), (200, 1, [-1, -2]), (9, 2, [0, 0, 4]), (10, 2, [0, 0, 4])]
    kept = {}
    for i, label, v in rows:
        if None not in (i, label, v) and None not in v:
            kept[i] = min(kept.get(i, (label, v)), (label, v))
    assert found_by(table(spark, rows)) == brute(kept)
    assert found_by(table(spark, [])) == []
    assert found_by(table(spark, [(0, None, None)])) == []
    large = [(i, i % 2, [10**9 + i, -10**9, i]) for i in range(8)]  # beyond exact floating point
    assert found_by(table(spark, large), every=2) == brute({i: (a, v) for i, a, v in large}, 2)
    with pytest.raises(ValueError):
        found_by(table(spark, [(0, 0, [2 * 10**9, 2 * 10**9]), (1, 0, [1])]))


def test_incomplete_vectors(spark):
    rows = [(1, [0.5, -0.001]), (2, [math.nan]), (3, [math.inf, 1.0]), (4, [None]), (5, None), (6, []), (7, [-math.inf])]
    df = spark.createDataFrame(rows, "vec_id long, e array<float>")
    found = df.select("vec_id", negatives.complete("e").alias("c"), F.when(negatives.complete("e"), negatives.integers("e")).alias("v")).collect()
    assert {r.vec_id: r.v for r in found if r.c} == {1: [128, -1], 6: []}


def test_ranges_rule_out_leaves():
    draw = np.random.default_rng(1)
    centres = draw.integers(-200, 200, (20, 8))
    rows = (centres[draw.integers(0, 20, 4000)] + draw.integers(-4, 5, (4000, 8))).astype(float)
    tree = negatives.grown(rows[:1000], float(np.sqrt((rows ** 2).sum(1).max())))
    tree.near = [np.full((len(n.points),) * 2, np.inf) for n in tree.nodes]
    tree.far = [np.full((len(n.points),) * 2, -np.inf) for n in tree.nodes]

    def seen(number, _, distance, child):
        for k in np.unique(child):
            tree.near[number][:, k] = np.minimum(tree.near[number][:, k], distance[child == k].min(0))
            tree.far[number][:, k] = np.maximum(tree.far[number][:, k], distance[child == k].max(0))

    leaf = tree.leaf_of(rows, seen)
    queries = rows[:50]
    scores = queries @ rows.T
    low, high = np.quantile(scores, 0.97, axis=1)[:, None], np.quantile(scores, 0.99, axis=1)[:, None]
    base = (queries ** 2).sum(1)[:, None] + tree.radius ** 2
    reached = {(int(row), number) for number, some, _ in tree.reached(queries, np.sqrt(base - 2 * high), np.sqrt(base - 2 * low)) for row in some}
    wanted = {(q, int(leaf[r])) for q, r in zip(*np.nonzero((scores >= low) & (scores <= high)))}
    assert wanted <= reached and len(reached) < 0.5 * 50 * tree.leaves
