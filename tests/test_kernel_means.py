"""Class means of random features against the exact kernel sums."""

import math
import random

import pytest

from minewright.operators import kernel_means


def test_margins_are_within_the_stated_error(spark):
    rng = random.Random(8)
    rows = [([rng.random(), rng.random(), rng.random() / 2 + (k % 2) * 0.4], k % 2) for k in range(400)]
    asks = [(q, [rng.random() for _ in range(3)]) for q in range(60)]
    df = spark.createDataFrame([*rows, (None, 1), ([0.1, None, 0.2], 0), ([0.1, 0.1, 0.1], None)], "data ARRAY<DOUBLE>, match INT").repartition(3)
    points = spark.createDataFrame([*asks, (99, None), (98, [None, 0.1, 0.2])], "id LONG, point ARRAY<DOUBLE>")
    means = kernel_means.class_means(df, 10.0)

    def mean(kind, point):
        own = [v for v, m in rows if m == kind]
        return sum(math.exp(-10 * math.dist(point, v) ** 2) for v in own) / len(own)

    inside = [sum(mean(kind, v) for v, m in rows if m == kind) / 200 for kind in (0, 1)]
    assert kernel_means.offset(means) == pytest.approx(inside[1] - inside[0], abs=0.05)
    found = {r.id: r for r in kernel_means.classify(points, means, 10.0).collect()}
    gaps = []
    for q, point in asks:
        exact = mean(0, point) - mean(1, point) + inside[1] - inside[0]
        gaps.append(abs(found[q].margin - exact))
        assert found[q].match == (0 if found[q].margin > 0 else 1)
        if abs(exact) > 0.11:
            assert found[q].match == (0 if exact > 0 else 1)
    assert max(gaps) < 0.11 and sum(gaps) / len(gaps) < 0.03
    assert found[99].match == found[98].match == 1 and found[99].margin is None
    nothing = kernel_means.class_means(df.limit(0), 10.0)
    assert nothing == {} and {r.match for r in kernel_means.classify(points, nothing).collect()} == {1}
