"""Exact nearest neighbours without comparing everything with everything.

Samples are ``id, input ARRAY<DOUBLE>, result``. Space is cut into nested grids. A query takes the
finest square that holds enough samples: the k-th distance there bounds how far the answer can lie, so only squares
within that reach are joined. Crowded regions use fine squares, sparse ones coarse squares, and the
answer is the same as a full comparison. With more than four dimensions the grid lies over the distances to a
few pivots: two points are at least as far apart as their distances to any pivot differ.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.functions import kernels
from minewright.operators.pairs import spread
from minewright.session import cut

GRID_DIMS = 4
#: Samples of a square that meet their queries in one task; a square with more is joined in parts.
BLOCK = 4000
#: Rows among which the pivots are chosen.
PIVOT_SAMPLE = 200
PRIME = 2147483647


@dataclass
class Grid:
    """Nested squares over the places ``_at``; level ``l`` halves the side ``l`` times. ``bounded``: a square's diagonal bounds distances in it."""

    low: list[float]
    side: float
    levels: int
    bounded: bool

    def squares(self, level: Column) -> Column:
        return F.pow(F.lit(2.0), level)

    def index(self, value: Column, axis: int, level: Column) -> Column:
        at = F.floor((value - self.low[axis]) / self.side * self.squares(level))
        return F.greatest(F.lit(0).cast("long"), F.least(at, self.squares(level).cast("long") - 1))

    def cell(self, at: Column, level: Column) -> Column:
        return F.array(*[self.index(F.get(at, F.lit(i)), i, level) for i in range(len(self.low))])

    def above(self, cell: Column, level: Column) -> Column:
        """The square of ``level`` around a finest square: its indices halved."""
        return F.transform(cell, lambda c: F.call_function("shiftright", c, (F.lit(self.levels) - level).cast("int")))

    def reach(self, level: Column) -> Column:
        """No two points of a square are farther apart than this."""
        edge = self.side / self.squares(level)
        return F.sqrt(len(self.low) * edge * edge) * (1 + 1e-9) if self.bounded else F.lit(float("inf"))


def _pivots(data: DataFrame, dims: int) -> list[list[float]]:
    """Rows far from each other, chosen from the ``PIVOT_SAMPLE`` rows of least hashed input."""
    rows = [r["input"] for r in data.select("input").orderBy(F.xxhash64("input"), "input").limit(PIVOT_SAMPLE).collect()]
    chosen = rows[:1]
    while rows and len(chosen) < GRID_DIMS:
        chosen.append(max(rows, key=lambda row: min(math.dist(row[:dims], c[:dims]) for c in chosen)))
    return chosen


def _located(df: DataFrame, dims: int, pivots: list[list[float]] | None) -> DataFrame:
    """Adds ``_at``: the coordinates, or the distances to the pivots."""
    if pivots is None:
        return df.withColumn("_at", F.col("input"))
    return df.withColumn("_at", F.array(*[kernels.euclidean(F.col("input"), F.array(*[F.lit(float(v)) for v in p]), dims) for p in pivots]))


def _grid(data: DataFrame, queries: DataFrame, dims: int, bounded: bool) -> Grid:
    both = data.select("_at", F.lit(1).alias("n")).unionByName(queries.select("_at", F.lit(0).alias("n")))
    at = [F.get("_at", F.lit(i)) for i in range(dims)]
    box = both.agg(F.sum("n").alias("n"), *[F.min(v).alias(f"l{i}") for i, v in enumerate(at)],
                   *[F.max(v).alias(f"h{i}") for i, v in enumerate(at)]).first()
    widths = [(box[f"h{i}"] or 0.0) - (box[f"l{i}"] or 0.0) for i in range(dims)]
    # Fine enough for regions sixty-four times denser per dimension than an even spread.
    levels = math.ceil(math.log2(max(box["n"] or 1, 2)) / max(dims, 1)) + 6
    return Grid([box[f"l{i}"] or 0.0 for i in range(dims)], max(widths, default=0.0) or 1.0, levels, bounded)


def _levels(top: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(top)))


def _first_copies(data: DataFrame, by: list[str], dims: int, copies: int) -> DataFrame:
    """Of equal inputs the ``copies`` lowest ids; ``_rest`` marks the next one, which stands for all that follow."""
    place = [F.get("input", F.lit(axis)) for axis in range(dims)]
    lowest = F.row_number().over(Window.partitionBy(*by, *place).orderBy("id"))
    return (data.withColumn("_copy", lowest).where(F.col("_copy") <= copies + 1)
            .withColumn("_rest", F.col("_copy") == copies + 1).drop("_copy"))


def nearest(data: DataFrame, queries: DataFrame, k: int, dims: int, key: list[str], by: list[str] | None = None,
            keep: Callable[[], Column] | None = None, block: int = BLOCK) -> DataFrame:
    """``*key, *by, id, result, distance, rank`` of the ``k`` nearest samples of each query.

    ``key`` names a query, ``by`` columns shared with the data separate independent sets, and
    ``keep`` may reject a sample for a query (over the columns of both).

    The finest squares are counted once and rolled up by halving their indices. Of equal inputs only the lowest ids are
    looked at: ``k`` of them, or with ``keep`` some more and a mark for the rest; a query whose answer would reach such a mark is
    asked again with eight times as many. One that meets too few accepted samples is asked again two levels coarser, up to the
    whole space. A square with more than ``block`` samples meets its queries in parts.
    """
    by = by or []
    pivots = _pivots(data, dims) if dims > GRID_DIMS else None
    queries = cut(_located(queries, dims, pivots), "queries")
    data = cut(_located(data, dims, pivots), "samples")
    copies = least = k if keep is None else 4 * k + 16

    def shown(copies: int) -> DataFrame:
        few = _first_copies(data, by, dims, copies)
        return cut(few.where(~F.col("_rest")) if keep is None else few, "copies")

    samples = shown(copies)
    grid = _grid(samples, queries, len(pivots) if pivots is not None else dims, pivots is None)
    level = F.col("level")
    finest = cut(samples.groupBy(*by, grid.cell(F.col("_at"), F.lit(grid.levels)).alias("cell")).agg(F.count("*").alias("n")), "cells")
    counts = (finest.select(*by, "n", "cell", _levels(grid.levels).alias("level"))
              .groupBy(*by, "level", grid.above(F.col("cell"), level).alias("cell")).agg(F.sum("n").alias("n")))
    counts = cut(counts.where(F.col("n") >= min(k, block)), "squares")
    at = queries.select(*by, *key, "_at", _levels(grid.levels).alias("level")).withColumn("cell", grid.cell(F.col("_at"), level))
    filled = counts.where(F.col("n") >= (k if keep is None else 2 * k)).drop("n")
    found = at.join(filled, [*by, "level", "cell"]).groupBy(*by, *key).agg(F.max("level").alias("level"))
    asked = cut(queries.join(found, [*by, *key], "left").withColumn("level", F.coalesce("level", F.lit(0))), "asked")
    answers = []
    while True:
        size = F.col("n") * (copies / least)
        heavy = counts.where(size > block).select(*by, "level", F.col("cell").alias("_cell"), F.ceil(size / block).alias("_parts"))
        met = _answer(samples, asked, heavy, k, dims, grid, key, by, keep)
        if keep is None:
            return met.drop("_full", "_capped")
        met = cut(met, "met")
        answers.append(met.where("_full").drop("_full", "_capped"))
        done = met.groupBy(*by, *key).agg(F.max("_full").alias("_full"), F.max("_capped").alias("_capped"))
        capped = F.coalesce("_capped", F.lit(False))
        again = asked.join(done, [*by, *key], "left").where(~F.coalesce("_full", F.lit(False)) & (capped | (level > 0)))
        asked = cut(again.withColumn("level", F.when(capped, level).otherwise(F.greatest(level - 2, F.lit(0)))).drop("_full"), "asked")
        state = asked.agg(F.count("*").alias("n"), F.max("_capped").alias("capped")).first()
        asked = asked.drop("_capped")
        if not state["n"]:
            return reduce(DataFrame.unionByName, answers)
        if state["capped"]:
            copies *= 8
            samples = shown(copies)


def _placed(samples: DataFrame, asked: DataFrame, grid: Grid, by: list[str]) -> DataFrame:
    """The samples in their squares, at the levels some query uses."""
    used = [r[0] for r in asked.select("level").distinct().collect()] or [0]
    at = samples.select(*by, "id", "result", "_rest", F.col("input").alias("_input"), F.col("_at").alias("_place"),
                        F.explode(F.array(*[F.lit(u) for u in used])).alias("level"))
    return at.withColumn("_cell", grid.cell(F.col("_place"), F.col("level"))).drop("_place")


def _answer(samples, asked, heavy, k, dims, grid, key, by, keep) -> DataFrame:
    """One round: the k best accepted samples, whether they are certain (``_full``), and if not, whether a mark is among them (``_capped``).

    The k-th distance inside a query's own square bounds how far the answer can lie; only
    squares within that bound are joined. Without k accepted samples there, the diagonal is used.
    """
    place = [*by, "level", "_cell"]
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    placed = _placed(samples, asked, grid, by).join(heavy, place, "left").withColumn("_part", F.pmod(F.xxhash64("id"), parts)).drop("_parts")
    gap = kernels.euclidean(F.col("input"), F.col("_input"), dims).alias("distance")
    order = Window.partitionBy(*by, *key).orderBy("distance", "id")

    def meeting(asks: DataFrame) -> DataFrame:
        everywhere = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("_part")
        asks = asks.join(heavy, place, "left").select(*asks.columns, everywhere)
        met = spread(asks, [*place, "_part"]).join(placed, [*place, "_part"])
        return met.where(F.col("_rest") | keep()) if keep is not None else met

    own = meeting(asked.withColumn("_cell", grid.cell(F.col("_at"), F.col("level")))).where(~F.col("_rest")).select(*by, *key, "id", gap)
    bound = (own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
             .groupBy(*by, *key).agg(F.count("*").alias("_n"), F.max("distance").alias("_kth"))
             .where(F.col("_n") == k).select(*by, *key, (F.col("_kth") * (1 + 1e-9) + 1e-12).alias("_kth")))
    level = F.col("level")
    widest = F.when(level == 0, F.lit(float("inf"))).otherwise(grid.reach(level))
    asks = asked.join(bound, [*by, *key], "left").withColumn("_reach", F.coalesce("_kth", widest)).drop("_kth")
    # Unbounded squares say nothing without k samples: such a query waits for a coarser level.
    asks = cut(asks.where((level == 0) | (F.col("_reach") < float("inf"))), "reach")
    for i in range(len(grid.low)):
        at = F.get("_at", F.lit(i))
        low = F.when(level == 0, F.lit(0).cast("long")).otherwise(grid.index(at - F.col("_reach"), i, level))
        high = F.when(level == 0, F.lit(0).cast("long")).otherwise(grid.index(at + F.col("_reach"), i, level))
        asks = asks.select("*", F.explode(F.sequence(low, high)).alias(f"_c{i}"))
    cells = [f"_c{i}" for i in range(len(grid.low))]
    asks = asks.withColumn("_cell", F.array(*cells)).drop(*cells)
    met = meeting(asks).select(*by, *key, "id", "result", "_rest", "_reach", gap).where(F.col("distance") <= F.col("_reach"))
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # At most k rows per query are left here.
    together = Window.partitionBy(*by, *key)
    marked = F.max("_rest").over(together)
    enough = (F.count("*").over(together) == k) | (F.col("_reach") == float("inf"))
    return ranked.withColumn("_full", enough & ~marked).withColumn("_capped", marked).drop("_reach", "_rest")


def estimate(neighbours: DataFrame, key: list[str]) -> DataFrame:
    """Mean result of the nearest samples."""
    return neighbours.groupBy(*key).agg(F.avg("result").alias("guess"))


def weighted_estimate(neighbours: DataFrame, key: list[str], weight=kernels.gaussian) -> DataFrame:
    """Weighted mean result; NULL when the weights sum to zero."""
    w = weight(F.col("distance"))
    return neighbours.groupBy(*key).agg(F.try_divide(F.sum(w * F.col("result")), F.sum(w)).alias("guess"))


def held_out(row_id: Column, trial: Column, share: float) -> Column:
    """Whether a row is in the test set of a trial: a fixed hash of id and trial, the same everywhere."""
    first = F.pmod(row_id * 48271 + trial * 69621 + 1, F.lit(PRIME))
    mixed = F.pmod(F.pmod(first * first, F.lit(PRIME)) * 48271 + first, F.lit(PRIME))
    return mixed < int(share * PRIME)


def split(samples: DataFrame, trial: int, share: float = 0.05) -> DataFrame:
    return samples.withColumn("test", held_out(F.col("id"), F.lit(trial), share))


def test_errors(samples: DataFrame, trials: int, dims: int, k: int = 3, share: float = 0.05, by: list[str] | None = None) -> DataFrame:
    """``*by, trial, id, actual, guess`` of every held-out row, all trials in one job.

    Only held-out rows are repeated per trial; the samples stay once and are filtered as they meet.
    """
    by = by or []
    tests = (samples.select(*by, F.col("id").alias("qid"), "input", F.col("result").alias("actual"),
                            F.explode(F.sequence(F.lit(0), F.lit(trials - 1))).alias("trial"))
             .where(held_out(F.col("qid"), F.col("trial"), share)))
    tests = cut(tests, "tests")
    met = nearest(samples, tests, k, dims, ["trial", "qid"], by, lambda: ~held_out(F.col("id"), F.col("trial"), share))
    return tests.join(estimate(met, [*by, "trial", "qid"]), [*by, "trial", "qid"]).select(*by, "trial", F.col("qid").alias("id"), "actual", "guess")


def mean_squared(errors: DataFrame, by: list[str]) -> DataFrame:
    gap = F.col("actual") - F.col("guess")
    return errors.groupBy(*by).agg(F.avg(gap * gap).alias("error"))


def cross_validate(samples: DataFrame, dims: int, trials: int = 100, k: int = 3, share: float = 0.05, by: list[str] | None = None) -> DataFrame:
    """Mean over the trials of the mean squared error, per ``by`` group."""
    by = by or []
    per_trial = mean_squared(test_errors(samples, trials, dims, k, share, by), [*by, "trial"])
    return per_trial.groupBy(*by).agg(F.avg("error").alias("error"))


def scale_search(samples: DataFrame, scales: DataFrame, dims: int, trials: int = 10, k: int = 3) -> DataFrame:
    """``scale_id, error`` of every candidate vector of scale factors, in one job.

    ``scales(scale_id, factors)`` is the list of candidates; the samples are repeated once per
    candidate since each one bends the space differently.
    """
    options = scales.agg(F.collect_list(F.struct("scale_id", "factors"))).scalar()
    bent = (samples.withColumn("s", F.explode(options))
            .select(F.col("s.scale_id").alias("scale_id"), "id", kernels.rescaled(F.col("input"), F.col("s.factors")).alias("input"), "result"))
    return cross_validate(bent, dims, trials, k, by=["scale_id"])


def r_squared(errors: DataFrame) -> DataFrame:
    gap = F.col("actual") - F.col("guess")
    return errors.agg(F.count("*").alias("tests"), (1 - F.try_divide(F.sum(gap * gap), F.var_pop("actual") * F.count("*"))).alias("r2"))


def prob_guess(neighbours: DataFrame, key: list[str], low: float, high: float, weight=kernels.gaussian) -> DataFrame:
    """Share of the neighbour weight whose result lies in the closed range; 0 without weight."""
    w = weight(F.col("distance"))
    inside = F.sum(F.when(F.col("result").between(low, high), w).otherwise(0.0))
    return neighbours.groupBy(*key).agg(F.coalesce(F.try_divide(inside, F.sum(w)), F.lit(0.0)).alias("prob"))


def _weights(neighbours: DataFrame, key: list[str], weight) -> DataFrame:
    """The at most k neighbours of a query as one array with their total weight."""
    w = weight(F.col("distance"))
    return neighbours.groupBy(*key).agg(F.collect_list(F.struct(F.col("result"), w.alias("w"))).alias("near"), F.sum(w).alias("all"))


def cumulative(neighbours: DataFrame, key: list[str], high: float, weight=kernels.gaussian, step: float = 0.1) -> DataFrame:
    """``step_no, prob`` of a result between 0 and each step below ``high``."""
    steps = F.explode(F.sequence(F.lit(0), F.lit(math.ceil(high / step) - 1)))
    rows = _weights(neighbours, key, weight).select(*key, "near", "all", steps.alias("step_no"))
    inside = F.aggregate("near", F.lit(0.0), lambda total, n: total + F.when(
        (n["result"] >= 0) & (n["result"] <= F.col("step_no") * step), n["w"]).otherwise(0.0))
    return rows.select(*key, "step_no", F.coalesce(F.try_divide(inside, F.col("all")), F.lit(0.0)).alias("prob"))


def smoothed(neighbours: DataFrame, key: list[str], high: float, weight=kernels.gaussian, sigma: float = 5.0, step: float = 0.1) -> DataFrame:
    """Probability of each bin, spread with a gaussian over all bins.

    Only the few bins that hold a neighbour have a probability, so each bin sums over those.
    """
    bins = math.ceil(high / step)
    near = neighbours.select(*key, "result", weight(F.col("distance")).alias("w"))
    total = near.groupBy(*key).agg(F.sum("w").alias("all"))
    guess = F.floor(F.col("result") / step).cast("int")
    hits = (near.select(*key, "result", "w", F.explode(F.sequence(guess - 1, guess + 1)).alias("bin"))
            .where((F.col("bin") >= 0) & (F.col("bin") < bins))
            .where((F.col("result") >= F.col("bin") * step) & (F.col("result") <= F.col("bin") * step + step))
            .groupBy(*key, "bin").agg(F.sum("w").alias("w")).groupBy(*key).agg(F.collect_list(F.struct("bin", "w")).alias("hits")))
    rows = total.join(hits, key, "left").select(*key, "all", "hits", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    spread = F.aggregate("hits", F.lit(0.0), lambda s, h: s + h["w"] * kernels.gaussian(F.abs(F.col("bin") - h["bin"]) * step, sigma))
    return rows.select(*key, "bin", F.coalesce(F.try_divide(spread, F.col("all")), F.lit(0.0)).alias("prob"))
