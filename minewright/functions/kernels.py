"""Distances and weights over arrays and numbers, as built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_length(a: Column) -> Column:
    return dot(a, a)


def squared_distance(a: Column, b: Column, dims: int | None = None) -> Column:
    """Summed squared differences; spelled out per dimension when the length is known."""
    if dims is None:
        return total(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)))
    gaps = [F.get(a, F.lit(i)).cast("double") - F.get(b, F.lit(i)).cast("double") for i in range(dims)]
    return reduce(lambda s, g: s + g, [g * g for g in gaps])


def euclidean(a: Column, b: Column, dims: int | None = None) -> Column:
    return F.sqrt(squared_distance(a, b, dims))


def rescaled(a: Column, factors: Column) -> Column:
    return F.zip_with(a, factors, lambda x, f: x * f)


def inverse_weight(distance: Column, num: float = 1.0, const: float = 0.1) -> Column:
    return num / (distance + const)


def subtract_weight(distance: Column, const: float = 1.0) -> Column:
    return F.greatest(const - distance, F.lit(0.0))


def gaussian(distance: Column, sigma: float = 10.0) -> Column:
    return F.exp(-(distance * distance) / (2 * sigma * sigma))


def rbf(a: Column, b: Column, gamma: float = 20.0, dims: int | None = None) -> Column:
    return F.exp(-gamma * squared_distance(a, b, dims))
