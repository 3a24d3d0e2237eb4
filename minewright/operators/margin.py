"""Linear and kernel classifiers over ``id, data ARRAY, match`` rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.functions import kernels
from minewright.operators.pairs import spread_join
from minewright.session import cut

# Below this power exp() is zero in double arithmetic: farther rows add exactly nothing.
VANISHED = 746.0
GRID_DIMS = 3


def width(rows: DataFrame, column: str) -> int:
    """Length of the vectors, read from one row."""
    first = rows.select(F.size(column)).first()
    return first[0] if first else 0


def mean_vectors(rows: DataFrame, by: str, column: str = "data") -> DataFrame:
    """``by, mean``: one average per dimension in a single aggregation, nothing exploded."""
    dims = width(rows, column)
    means = [F.avg(F.get(column, F.lit(i)).cast("double")) for i in range(dims)]
    return rows.groupBy(by).agg(F.array(*means).alias("mean"))


def dp_classify(rows: DataFrame, means: DataFrame) -> DataFrame:
    """0 or 1 by the side of the plane halfway between the two class means."""
    sides = means.agg(F.max(F.when(F.col("match") == 0, F.col("mean"))).alias("m0"),
                      F.max(F.when(F.col("match") == 1, F.col("mean"))).alias("m1"))
    m = sides.select(F.struct("m0", "m1")).scalar()
    rows = rows.withColumn("m", m)
    m0, m1, point = F.col("m.m0"), F.col("m.m1"), F.col("data")
    y = (kernels.dot(point, m0) - kernels.dot(point, m1)
         + (kernels.squared_length(m1) - kernels.squared_length(m0)) / 2)
    return rows.select("id", F.when(y > 0, 0).otherwise(1).alias("match"))


def column_bounds(rows: DataFrame, column: str = "data") -> Column:
    """Low and high of every dimension as one struct of arrays."""
    dims = width(rows, column)
    at = [F.get(column, F.lit(i)).cast("double") for i in range(dims)]
    return rows.agg(F.struct(F.array(*[F.min(v) for v in at]).alias("low"), F.array(*[F.max(v) for v in at]).alias("high"))).scalar()


def scaled(data: Column, bounds: Column) -> Column:
    """Each dimension onto 0..1; a constant one becomes 0."""
    shifted = F.zip_with(data, bounds["low"], lambda v, low: v - low)
    spans = F.zip_with(bounds["high"], bounds["low"], lambda high, low: high - low)
    return F.zip_with(shifted, spans, lambda v, span: F.coalesce(F.try_divide(v, span), F.lit(0.0)))


def minmax_scale(rows: DataFrame) -> DataFrame:
    bounds = column_bounds(rows)
    return rows.withColumn("_bounds", bounds).withColumn("data", scaled(F.col("data"), F.col("_bounds"))).drop("_bounds")


def condensed(rows: DataFrame, dims: int) -> DataFrame:
    """Equal vectors of a class as one row with their count, grouped by plain numbers."""
    names = [f"_d{i}" for i in range(dims)]
    flat = rows.select("match", *[F.get("data", F.lit(i)).alias(name) for i, name in enumerate(names)])
    return (flat.groupBy(*names, "match").agg(F.count("*").alias("n"))
            .select(F.array(*names).alias("data"), "match", "n"))


def kernel_terms(points: DataFrame, weighted: DataFrame, gamma: float, dims: int, same: list[str] | None = None) -> DataFrame:
    """The points met with condensed class rows, one ``kernel`` term (count times kernel) per meeting.

    Rows farther than the kernel reaches add exactly zero, so the space is cut into squares of
    that reach and only neighbouring squares meet; crowded squares are split over tasks. The
    callers add the terms up in the same stage, before any shuffle.
    """
    same = same or []
    side = math.sqrt(VANISHED / gamma)
    axes = range(min(dims, GRID_DIMS))

    def square(vector: str, axis: int) -> Column:
        return F.floor(F.get(vector, F.lit(axis)).cast("double") / side)

    asks = points
    for axis in axes:
        asks = asks.withColumn(f"_c{axis}", F.explode(F.sequence(square("point", axis) - 1, square("point", axis) + 1)))
    rows = weighted.select(*weighted.columns, *[square("data", axis).alias(f"_c{axis}") for axis in axes])
    met = spread_join(asks, rows, [*same, *[f"_c{axis}" for axis in axes]])
    return met.withColumn("kernel", F.col("n") * kernels.rbf(F.col("point"), F.col("data"), gamma, dims))


def rbf_offset(rows: DataFrame, gamma: float, dims: int) -> DataFrame:
    """One row ``offset``: mean kernel inside class 1 minus mean kernel inside class 0, over all ordered pairs."""
    kinds = cut(condensed(rows, dims), "kinds")
    points = kinds.select(F.col("data").alias("point"), "match", F.col("n").alias("m"))
    inside = (kernel_terms(points, kinds, gamma, dims, ["match"])
              .groupBy("match").agg(F.sum(F.col("m") * F.col("kernel")).alias("total")))
    sizes = kinds.groupBy("match").agg(F.sum("n").cast("double").alias("size"))
    means = inside.join(sizes, "match").withColumn("mean", F.col("total") / (F.col("size") * F.col("size")))
    return means.agg(F.sum(F.when(F.col("match") == 1, F.col("mean")).otherwise(-F.col("mean"))).alias("offset"))


def rbf_classify(points: DataFrame, rows: DataFrame, offset: DataFrame, gamma: float, dims: int) -> DataFrame:
    """0 or 1 by the mean kernel to either class plus the offset; ``points`` is ``id, point``."""
    kinds = cut(condensed(rows, dims), "kinds")
    sizes = kinds.agg(F.struct(F.sum(F.when(F.col("match") == 0, F.col("n"))).alias("n0"),
                               F.sum(F.when(F.col("match") == 1, F.col("n"))).alias("n1"))).scalar()
    sums = kernel_terms(points, kinds, gamma, dims).groupBy("id").agg(
        F.sum(F.when(F.col("match") == 0, F.col("kernel")).otherwise(0.0)).alias("sum0"),
        F.sum(F.when(F.col("match") == 1, F.col("kernel")).otherwise(0.0)).alias("sum1"))
    sums = points.select("id").join(sums, "id", "left").withColumn("s", sizes).withColumn("offset", offset.scalar())
    near0, near1 = F.coalesce("sum0", F.lit(0.0)), F.coalesce("sum1", F.lit(0.0))
    y = near0 / F.col("s.n0") - near1 / F.col("s.n1") + F.col("offset")
    return sums.select("id", F.when(y > 0, 0).otherwise(1).alias("match"))
