"""Hard negatives: a multiway hyperplane tree whose distance ranges rule out subtrees for a window of scores."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.llm.batches import lean
from minewright.session import cut

#: Rows that the tree is fitted on, split points of a node, and fitted rows of a leaf at most.
SAMPLE, ARITY, LEAF_SAMPLE = 4096, 16, 48
#: Rows of a leaf that one task compares at once; queries compared at once.
BLOCK, QUERIES = 4096, 256
LOWEST, HIGHEST = -(1 << 62), 1 << 62


@dataclass
class Node:
    """Split points, and for each its child: the number of a node, or -1 - the number of a leaf."""

    points: np.ndarray
    children: list[int] = field(default_factory=list)


@dataclass
class Tree:
    """``radius`` is the largest norm: one more component lifts every vector to it, so that a distance tells the score."""

    nodes: list[Node]
    radius: float
    leaves: int
    near: list[np.ndarray] = field(default_factory=list)
    far: list[np.ndarray] = field(default_factory=list)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(0.0, self.radius ** 2 - (vectors ** 2).sum(1))
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def leaf_of(self, vectors: np.ndarray, visit=None) -> np.ndarray:
        """The leaf of each vector; ``visit(node, rows, distances, child)`` sees every step."""
        lifted = self.lifted(vectors)
        out = np.zeros(len(lifted), np.int64)
        waiting = [(0, np.arange(len(lifted)))] if self.nodes else []
        while waiting:
            number, rows = waiting.pop()
            node = self.nodes[number]
            distance = _distances(lifted[rows], node.points)
            child = distance.argmin(1)
            if visit:
                visit(number, rows, distance, child)
            for k, target in enumerate(node.children):
                own = rows[child == k]
                if len(own) and target >= 0:
                    waiting.append((target, own))
                elif len(own):
                    out[own] = -1 - target
        return out

    def reached(self, vectors: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(leaf, rows, windows)``: leaves that the annulus ``inner`` to ``outer`` around each vector may touch.

        A subtree is left when, seen from any split point beside it, its range of distances and the
        annulus have nothing in common. ``windows`` tells which of a row's annuli are left.
        """
        slack = 1e-6 * (1.0 + self.radius)
        lifted = np.hstack([vectors, np.zeros((len(vectors), 1))])
        everything = np.arange(len(vectors)), np.ones(inner.shape, bool)
        if not self.nodes:
            yield 0, *everything
            return
        waiting = [(0, *everything)]
        while waiting:
            number, rows, open_ = waiting.pop()
            node = self.nodes[number]
            distance = _distances(lifted[rows], node.points)[:, :, None]
            least = np.maximum(self.near[number] - distance, distance - self.far[number]).max(1) - slack
            most = (distance + self.far[number]).min(1) + slack
            for k, target in enumerate(node.children):
                left = open_ & (least[:, k, None] <= outer[rows]) & (most[:, k, None] >= inner[rows])
                some = left.any(1)
                if some.any():
                    if target >= 0:
                        waiting.append((target, rows[some], left[some]))
                    else:
                        yield -1 - target, rows[some], left[some]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a ** 2).sum(1)[:, None] + (b ** 2).sum(1) - 2 * (a @ b.T)))


def grown(sample: np.ndarray, radius: float, arity: int = ARITY, leaf_sample: int = LEAF_SAMPLE) -> Tree:
    """A tree over ``sample``: split points far from each other, every row to its nearest one."""
    tree = Tree([], radius, 0)
    lifted = tree.lifted(sample)

    def grow(rows: np.ndarray) -> int:
        points = lifted[_apart(lifted[rows[:8 * arity]], arity, rows)] if len(rows) > leaf_sample else None
        if points is None or len(points) < 2:
            tree.leaves += 1
            return -tree.leaves
        number, node = len(tree.nodes), Node(points)
        tree.nodes.append(node)
        child = _distances(lifted[rows], points).argmin(1)
        node.children = [grow(rows[child == k]) for k in range(len(points))]
        return number

    grow(np.arange(len(sample)))
    return tree


def _apart(candidates: np.ndarray, arity: int, rows: np.ndarray) -> np.ndarray:
    """Rows of the first candidate and, again and again, the one farthest from those taken."""
    taken, gap = [0], _distances(candidates, candidates[:1])[:, 0]
    while len(taken) < arity and gap.max() > 1e-3:
        taken.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(candidates, candidates[taken[-1:]])[:, 0])
    return rows[taken]


def _vectors(column: pa.Array) -> np.ndarray:
    """One row per vector; shorter ones are filled up with zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[row]] = flat
    return out


def _filled(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


def _placed(tree: Tree, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaf_of(_filled(_vectors(batch.column("vec")), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    return run


def _ranges(tree: Tree, width: int):
    """Least and largest distance from every split point to every subtree of its node, as far as this task saw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [np.full((len(n.points),) * 2, np.inf) for n in tree.nodes]
        far = [np.full((len(n.points),) * 2, -np.inf) for n in tree.nodes]

        def seen(number, rows, distance, child):
            for k in np.unique(child):
                near[number][:, k] = np.minimum(near[number][:, k], distance[child == k].min(0))
                far[number][:, k] = np.maximum(far[number][:, k], distance[child == k].max(0))

        for batch in batches:
            tree.leaf_of(_filled(_vectors(batch.column("vec")), width), seen)
        for number in range(len(tree.nodes)):
            point, child = np.nonzero(far[number] >= 0)
            if len(point):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(point), number, np.int32)), pa.array(point.astype(np.int32)), pa.array(child.astype(np.int32)),
                    pa.array(near[number][point, child]), pa.array(far[number][point, child])], names=["node", "point", "child", "near", "far"])

    return run


def _visits(tree: Tree, blocks: dict[int, int], width: int, home: bool):
    """The blocks of leaves that a query has to see, with those of its windows that they may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(at, QUERIES)
                vectors = _filled(_vectors(batch.column("vec")), width)
                own = batch.column("leaf").to_numpy()
                windows = batch.column("windows").to_pylist()
                if home:
                    found = [(leaf, np.flatnonzero(own == leaf), None) for leaf in np.unique(own)]
                else:
                    most = max(map(len, windows), default=0)
                    score = np.array([[*[(w["low"], w["high"]) for w in row], *[(HIGHEST, LOWEST)] * (most - len(row))] for row in windows], float).reshape(len(windows), most, 2)
                    base = (vectors ** 2).sum(1)[:, None] + tree.radius ** 2
                    inner, outer = (np.sqrt(np.maximum(0.0, base - 2 * score[:, :, k])) for k in (1, 0))
                    outer[score[:, :, 0] > score[:, :, 1]] = -np.inf  # nothing is in an empty window
                    found = [(leaf, rows[own[rows] != leaf], left[own[rows] != leaf]) for leaf, rows, left in tree.reached(vectors, inner, outer)]
                for leaf, rows, left in found:
                    if not len(rows):
                        continue
                    asked = [[w for k, w in enumerate(windows[row]) if left is None or left[i, k]] for i, row in enumerate(rows)]
                    for block in range(blocks.get(int(leaf), 0)):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(rows), leaf, np.int32)), pa.array(np.full(len(rows), block, np.int32)),
                            batch.column("vec_id").take(pa.array(rows)), batch.column("label").take(pa.array(rows)),
                            batch.column("vec").take(pa.array(rows)), pa.array(asked, WINDOWS)], names=["leaf", "block", "vec_id", "label", "vec", "windows"])

    return run


WINDOWS = pa.list_(pa.struct([("positive", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))
WINDOWS_SQL = "array<struct<positive: long, low: long, high: long>>"
FOUND_SQL = "anchor long, positive long, vec_id long, score long"


def _compared(width: int, most: int, same: bool, exact: bool):
    """Rows by leaf and block, first the indexed ones, then the queries: the best ``most`` rows of every window."""
    def answers(block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = block
        windows = batch.column("windows").to_pylist()
        asked = _filled(_vectors(batch.column("vec")), width)
        kind = np.float64 if exact else np.int64
        scores = (asked.astype(kind) @ vectors.astype(kind).T).astype(np.int64)
        out: list[tuple] = [], [], [], []
        for k, (anchor, label) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist())):
            floor = min((w["low"] for w in windows[k]), default=HIGHEST)
            own = np.flatnonzero(((labels == label) == same) & (ids != anchor) & (scores[k] >= floor))
            own = own[np.lexsort((ids[own], -scores[k][own]))]
            down = -scores[k][own]
            for w in windows[k]:
                first = int(np.searchsorted(down, -w["high"], "left"))
                best = own[first:min(first + most, int(np.searchsorted(down, -w["low"], "right")))]
                if len(best):
                    for column, values in zip(out, (np.full(len(best), anchor), np.full(len(best), w["positive"]), ids[best], scores[k][best])):
                        column.append(values)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in out], names=["anchor", "positive", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for whole in batches:
            for start in range(0, whole.num_rows, QUERIES):
                part = whole.slice(start, QUERIES)
                place = part.column("leaf").to_numpy().astype(np.int64) << 32 | part.column("block").to_numpy()
                query = part.column("windows").is_valid().to_numpy(zero_copy_only=False)
                cuts = np.concatenate([[0], np.flatnonzero((place[1:] != place[:-1]) | (query[1:] != query[:-1])) + 1, [len(place)]])
                for a, b in zip(cuts[:-1], cuts[1:]):
                    rows = part.slice(a, b - a)
                    if place[a] != at:
                        at, held, block = place[a], [], None
                    if not query[a]:
                        held.append(rows)
                        continue
                    if block is None and held:
                        block = (np.concatenate([h.column("vec_id").to_numpy() for h in held]), np.concatenate([h.column("label").to_numpy() for h in held]),
                                 np.vstack([_filled(_vectors(h.column("vec")), width) for h in held]))
                    if block is not None:
                        yield from answers(block, rows)

    return run


class Index:
    """All rows, each in a block of its leaf, and the tree with its ranges over all of them."""

    def __init__(self, rows: DataFrame, sample: int = SAMPLE, arity: int = ARITY, leaf_sample: int = LEAF_SAMPLE, block: int = BLOCK):
        self.parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        square = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
        most = rows.agg(F.max(square).alias("square"), F.max(F.size("vec")).alias("width")).first()
        self.width, largest = most["width"] or 0, most["square"] or 0.0
        if largest >= 2.0 ** 62:
            raise ValueError("scores of vectors this long do not fit into a long")
        self.exact = largest < 2.0 ** 53
        first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec").toPandas()["vec"]
        fitted = np.zeros((len(first), self.width))
        for k, vector in enumerate(first):
            fitted[k, :len(vector)] = vector
        self.tree = grown(fitted, math.sqrt(largest), arity, leaf_sample)
        for row in rows.select("vec").mapInArrow(lean(_ranges(self.tree, self.width)), "node int, point int, child int, near double, far double").groupBy(
                "node", "point", "child").agg(F.min("near").alias("near"), F.max("far").alias("far")).collect():
            if not self.tree.near:
                self.tree.near = [np.full((len(n.points),) * 2, np.inf) for n in self.tree.nodes]
                self.tree.far = [np.full((len(n.points),) * 2, -np.inf) for n in self.tree.nodes]
            self.tree.near[row["node"]][row["point"], row["child"]] = row["near"]
            self.tree.far[row["node"]][row["point"], row["child"]] = row["far"]
        self.rows = cut(rows.mapInArrow(lean(_placed(self.tree, self.width)), "vec_id long, label int, vec array<int>, leaf int"), "indexed")
        sizes = self.rows.groupBy("leaf").count().collect()
        self.blocks = {row["leaf"]: -(-row["count"] // block) for row in sizes}
        number = F.lit(1)
        for leaf, blocks in self.blocks.items():
            if blocks > 1:
                number = F.when(F.col("leaf") == leaf, F.lit(blocks)).otherwise(number)
        self.blocked = self.rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), number).cast("int"))

    def _answers(self, asked: DataFrame, most: int, same: bool, home: bool) -> DataFrame:
        visits = asked.mapInArrow(lean(_visits(self.tree, self.blocks, self.width, home)),
                                  f"leaf int, block int, vec_id long, label int, vec array<int>, windows {WINDOWS_SQL}")
        rows = self.blocked.select("leaf", "block", "vec_id", "label", "vec", F.lit(None).cast(WINDOWS_SQL).alias("windows"))
        return (rows.unionByName(visits).repartition(self.parts, "leaf", "block")
                .sortWithinPartitions("leaf", "block", F.col("windows").isNotNull())
                .mapInArrow(lean(_compared(self.width, most, same, self.exact)), FOUND_SQL))

    def search(self, asked: DataFrame, most: int, same: bool) -> DataFrame:
        """``anchor, positive, vec_id, score, rank``: the first ``most`` rows in each window of ``asked(vec_id, label, vec, leaf, windows)``.

        A query first sees its own leaf. The last of ``most`` rows found there narrows its window; then it sees the
        leaves that the ranges do not rule out. Only exact scores count.
        """
        asked = cut(asked, "asked")
        known = cut(_first(self._answers(asked, most, same, True), most), "known")
        enough = known.where(F.col("rank") == most).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("positive", "score"))).alias("floors"))
        narrowed = asked.join(enough.withColumnRenamed("anchor", "vec_id"), "vec_id", "left").withColumn("windows", F.transform("windows", lambda w: F.struct(
            w["positive"].alias("positive"), F.greatest(w["low"], F.col("floors").getItem(w["positive"])).alias("low"), w["high"].alias("high")))).drop("floors")
        rest = self._answers(narrowed, most, same, False)
        return _first(known.drop("rank").unionByName(rest), most)


def _first(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def integers(vector: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as integers."""
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("int"))


def complete(vector: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, sample: int = SAMPLE,
                   arity: int = ARITY, leaf_sample: int = LEAF_SAMPLE, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``rows(vec_id, label, vec)``, vectors of integers.

    Anchors are the rows whose id ``every`` divides. An anchor's positives are its first ``positives`` other rows of
    the label, by inner product and then by id; a positive's negatives the first ``negatives`` rows of other labels whose score is
    ``low`` to ``high`` percent of the positive's.

    1. A tree is fitted on the ``sample`` rows of least hashed id: nodes of up to ``arity`` split points, each row
       to its nearest one. Vectors are lifted to one norm, so a window of scores is an annulus of distances.
    2. All rows go to their leaf, and every split point learns its range of distances to each subtree beside it.
    3. A query's annuli rule out subtrees by those ranges; the other leaves are compared exactly, a block of at most about ``block``
       rows at a time with the queries streaming by. Nothing is approximate.

    Rows with a null id, label, vector or component take no part; of rows with one id the one with the least label and vector
    counts. Shorter vectors are filled up with zeros. Scores that no long can hold are an error. Ties go by id. A negative score of the
    positive leaves an empty window. Other columns are not read; an empty table gives an empty result.
    """
    told = rows.where("vec_id is not null and label is not null and vec is not null").where(F.forall("vec", lambda x: x.isNotNull()))
    told = cut(told.groupBy(F.col("vec_id").cast("long").alias("vec_id"))
               .agg(F.min(F.struct(F.col("label").cast("int").alias("label"), F.col("vec").cast("array<int>").alias("vec"))).alias("row"))
               .select("vec_id", "row.label", "row.vec"), "vectors")
    index = Index(told, sample, arity, leaf_sample, block)
    anchors = index.rows.where(F.col("vec_id") % every == 0)
    window = F.struct(F.lit(0).cast("long").alias("positive"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"))
    near = cut(index.search(anchors.withColumn("windows", F.array(window)), positives, True).select(
        "anchor", F.col("vec_id").alias("positive"), F.col("score").alias("positive_score")), "positives")
    rest = F.pmod("positive_score", F.lit(100))  # in two parts, so that no product overflows
    whole = F.expr("(positive_score - pmod(positive_score, 100)) div 100")
    above, below = (percent * whole + part(F.lit(percent) * rest / 100).cast("long") for percent, part in ((low, F.ceil), (high, F.floor)))
    windows = near.groupBy(F.col("anchor").alias("vec_id")).agg(F.collect_list(F.struct("positive", above.alias("low"), below.alias("high"))).alias("windows"))
    found = index.search(anchors.join(windows, "vec_id").select("vec_id", "label", "vec", "leaf", "windows"), negatives, False)
    return found.join(near, ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
