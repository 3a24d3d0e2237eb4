"""Library learners: an entropy tree on one-hot features and a kernel machine by random features."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.session import cut


def tree_pipeline(text: list[str], numbers: list[str], label: str = "label", depth: int = 30, bins: int = 64) -> Pipeline:
    """Index and one-hot the text columns, pass the numbers through, fit an entropy tree.

    ``depth`` 30 is the library's largest; a number column is split at no more than ``bins`` - 1 places.
    """
    indexed, flags = [f"{c}_i" for c in text], [f"{c}_v" for c in text]
    return Pipeline(stages=[
        StringIndexer(inputCols=[*text, label], outputCols=[*indexed, "label_i"]),
        OneHotEncoder(inputCols=indexed, outputCols=flags, dropLast=False),
        VectorAssembler(inputCols=[*flags, *numbers], outputCol="features"),
        DecisionTreeClassifier(labelCol="label_i", impurity="entropy", maxDepth=depth, maxBins=bins)])


def random_features(data: Column, dims: int, size: int, gamma: float) -> Column:
    """Random Fourier features whose inner product approximates the RBF kernel.

    Frequencies come from a seeded hash through the Box–Muller transform, as literals, so
    they are the same on every executor and every run.
    """
    def uniform(*seed: int) -> float:
        state = 0x9E3779B97F4A7C15
        for value in seed:
            state = (state ^ (value + 1) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
            state = ((state ^ (state >> 31)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        return ((state >> 11) + 0.5) / (1 << 53)

    def normal(i: int, j: int) -> float:
        return math.sqrt(-2 * math.log(uniform(i, j, 1))) * math.cos(2 * math.pi * uniform(i, j, 2))

    scale = math.sqrt(2.0 / size)
    waves = []
    for i in range(size):
        weights = F.array(*[F.lit(math.sqrt(2 * gamma) * normal(i, j)) for j in range(dims)])
        dot = F.aggregate(F.zip_with(data, weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        waves.append(scale * F.cos(dot + 2 * math.pi * uniform(i, 0, 3)))
    return F.array(*waves)


def kernel_machine(train: DataFrame, dims: int, size: int = 64, gamma: float = 1.0, rounds: int = 100):
    """Linear support vectors over random features; returns a function that predicts a frame.

    Equal rows of a class are one row of their weight: the loss is the same sum, and a round passes over the distinct rows only.
    """
    def lifted(rows: DataFrame) -> DataFrame:
        return rows.withColumn("features", array_to_vector(random_features(F.col("data"), dims, size, gamma)))

    kinds = cut(train.groupBy("data", F.col("match").cast("double").alias("match")).agg(F.count("*").cast("double").alias("weight")), "kinds")
    model = LinearSVC(labelCol="match", featuresCol="features", weightCol="weight", maxIter=rounds, regParam=0.01).fit(lifted(kinds))
    return lambda rows: model.transform(lifted(rows)).drop("features", "rawPrediction")
