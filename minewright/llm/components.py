"""Connected components of an edge table, without a driver-side or single-task union."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.session import cut


class Forest:
    """Union-find over hashable items; the root of a tree is its smallest item."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, item):
        parent = self.parent
        top = item
        while (above := parent.get(top, top)) != top:
            top = above
        while (above := parent.get(item, item)) != top and item != top:
            parent[item] = top
            item = above
        return top

    def join(self, a, b) -> bool:
        """Whether the two were apart until now."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self.parent.setdefault(low, low)
        self.parent[high] = low
        return True


#: Edges that one task holds before it hands on their spanning forest.
HELD_EDGES = 200_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, held = Forest(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        held += batch.num_rows
        if held >= HELD_EDGES:
            yield from _star(forest)
            forest, held = Forest(), 0
    yield from _star(forest)


def _star(forest: Forest) -> Iterator[pa.RecordBatch]:
    pairs = [(item, forest.root(item)) for item in list(forest.parent)]
    high = np.array([a for a, b in pairs if a != b], np.int64)
    low = np.array([b for a, b in pairs if a != b], np.int64)
    if len(high):
        yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` of every vertex of ``edges(a, b)`` (longs); ``root`` is the smallest id of its component.

    Each task first replaces its edges by stars of its own spanning forest. Then large-star and
    small-star rounds alternate until nothing moves (a logarithmic number of rounds); minima are
    combined before the shuffle, so a vertex with very many edges is one row per task. Null ends and
    loops are ignored; an empty table gives an empty result.
    """
    apart = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null and a <> b")
    links = cut(apart.mapInArrow(_contracted, "a long, b long").distinct(), "links")
    while True:
        links = cut(_small_star(_large_star(links)), "links")
        # At rest every edge leads to a vertex that has no smaller neighbour: a set of stars.
        centres = links.select(F.col("b").alias("a")).distinct()
        if links.join(centres, "a", "left_semi").isEmpty():
            break
    return links.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("id")).distinct().withColumn("root", F.col("id")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex moves to the vertex's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex, move to its smallest neighbour."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()
