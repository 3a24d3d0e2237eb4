"""Nearest neighbours where squares are heavy, inputs equal and dimensions many, against full comparison."""

import math
import random

import pytest
from pyspark.sql import functions as F

from minewright.operators import neighbors


def tables(spark, points, asks):
    return (spark.createDataFrame(points, "id LONG, input ARRAY<DOUBLE>, result DOUBLE"),
            spark.createDataFrame(asks, "qid LONG, input ARRAY<DOUBLE>"))


def best(asks, points, k):
    return {q: [i for _, i in sorted((math.dist(v, w), i) for i, w, _ in points)[:k]] for q, v in asks}


def found(df):
    got = {}
    for r in df.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["id"])
    return got


@pytest.mark.parametrize("dims", [1, 4, 5, 9])
def test_many_dimensions_and_split_squares(spark, dims):
    rng = random.Random(dims)
    points = [(i, [rng.choice([0.0, 1.0, rng.random()]) for _ in range(dims)], 0.0) for i in range(250)]
    asks = [(q, [rng.uniform(-0.5, 1.5) for _ in range(dims)]) for q in range(20)]
    data, queries = tables(spark, points, asks)
    assert found(neighbors.nearest(data, queries, 3, dims, ["qid"], block=4)) == best(asks, points, 3)
    odd = [p for p in points if p[0] % 7 == 0]
    assert found(neighbors.nearest(data, queries, 3, dims, ["qid"], keep=lambda: F.col("id") % 7 == 0, block=4)) == best(asks, odd, 3)


def test_equal_inputs_with_keep(spark):
    """50,000 equal samples: a query looks at the lowest ids, and at more of them only if these are rejected."""
    rng = random.Random(1)
    rest = [(100_000 + i, [rng.random(), rng.random()], 1.0) for i in range(40)]
    heap = spark.range(50_000).select("id", F.array(F.lit(0.5), F.lit(0.5)).alias("input"), F.lit(2.0).alias("result"))
    data = heap.unionByName(tables(spark, rest, [(0, [0.0])])[0])
    asks = [(q, [0.5, 0.5]) for q in range(200)] + [(1000, [0.1, 0.9])]
    queries = tables(spark, rest, asks)[1]
    accepted = neighbors.nearest(data, queries, 3, 2, ["qid"], keep=lambda: F.col("id") % 500 != F.col("qid") % 500)
    got = found(accepted)
    assert got[0] == [1, 2, 3] and got[2] == [0, 1, 3] and got[150] == [0, 1, 2] and len(got) == 201
    late = neighbors.nearest(data, queries.where("qid < 20"), 3, 2, ["qid"], keep=lambda: (F.col("id") >= 49_000) & (F.col("id") < 100_000))
    assert all(v == [49_000, 49_001, 49_002] for v in found(late).values())
    none = neighbors.nearest(data, queries, 3, 2, ["qid"], keep=lambda: F.lit(False))
    assert none.count() == 0
