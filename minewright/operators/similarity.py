"""Preference similarity and recommendation over long ratings ``person, item, rating``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.operators.pairs import paired

Similarity = Callable[[Column, Column], Column]


def transpose(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.col("item").alias("person"), F.col("person").alias("item"), "rating")


def distance_similarity(x: Column, y: Column) -> Column:
    """Aggregate: one over one plus the summed squared differences (no square root)."""
    return 1 / (1 + F.sum((x - y) * (x - y)))


def _flat(x: Column) -> Column:
    """Whether the values do not vary, measured against their own squares."""
    return F.var_pop(x) <= 1e-20 * F.avg(x * x)


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: Pearson r; NULL when either side does not vary.

    The sums are of gaps from the running means: raw sums of squares lose the spread of values with a large offset.
    """
    return F.when(~(_flat(x) | _flat(y)), F.covar_pop(x, y) / (F.stddev_pop(x) * F.stddev_pop(y)))


def pearson_centered(x: Column, y: Column) -> Column:
    """Aggregate: the same r, the default measure."""
    return F.when(~(_flat(x) | _flat(y)), F.covar_pop(x, y) / F.sqrt(F.var_pop(x) * F.var_pop(y)))


def shared_items(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    """Items rated by both members of each requested pair ``a, b``."""
    left = ratings.select(F.col("person").alias("a"), "item", F.col("rating").alias("x"))
    right = ratings.select(F.col("person").alias("b"), "item", F.col("rating").alias("y"))
    return pairs.join(left, "a").join(right, ["b", "item"]).select("a", "b", "item", "x", "y")


def similarity(ratings: DataFrame, pairs: DataFrame, measure: Similarity) -> DataFrame:
    """``a, b, sim`` for the requested pairs; 0 for a pair without a shared item."""
    scored = (shared_items(ratings, pairs).groupBy("a", "b")
              .agg(measure(F.col("x"), F.col("y")).alias("sim"), F.lit(True).alias("met")))
    return (pairs.join(scored, ["a", "b"], "left")
            .select("a", "b", F.when(F.col("met"), F.col("sim")).otherwise(0.0).alias("sim")))


def against(ratings: DataFrame, target: DataFrame, measure: Similarity) -> DataFrame:
    """``other, sim`` of every other person against one target (a one-row frame ``person``)."""
    who = target.scalar()
    mine = ratings.where(F.col("person") == who).select("item", F.col("rating").alias("x"))
    others = ratings.where(F.col("person") != who)
    scored = (others.join(mine, "item").groupBy(F.col("person").alias("other"))
              .agg(measure(F.col("x"), F.col("rating")).alias("sim"), F.lit(True).alias("met")))
    return (others.select(F.col("person").alias("other")).distinct().join(scored, "other", "left")
            .select("other", F.when(F.col("met"), F.col("sim")).otherwise(0.0).alias("sim")))


def top_matches(ratings: DataFrame, target: DataFrame, n: int = 5, measure: Similarity = pearson_centered) -> DataFrame:
    return (against(ratings, target, measure)
            .orderBy(F.desc_nulls_last("sim"), F.desc("other")).limit(n))


def recommendations(ratings: DataFrame, target: DataFrame, measure: Similarity = pearson_centered) -> DataFrame:
    """Similarity-weighted mean rating of what the target has not rated (or rated 0)."""
    alike = against(ratings, target, measure).where("sim > 0")
    who = target.scalar()
    rated = ratings.where((F.col("person") == who) & (F.col("rating") != 0)).select("item")
    return (ratings.join(rated, "item", "left_anti")
            .join(alike, F.col("person") == F.col("other"))
            .groupBy("item")
            .agg((F.sum(F.col("rating") * F.col("sim")) / F.sum("sim")).alias("score")))


def similar_items(ratings: DataFrame, n: int = 10, measure: Similarity = distance_similarity) -> DataFrame:
    """The ``n`` best co-rated items per item, ranked by (sim, name) descending.

    Pair terms are summed before the shuffle, so what travels is one row per item pair and task.
    """
    met = paired(ratings.select("person", "item", "rating"), ["person"], "item")
    scored = (met.groupBy(F.col("x.item").alias("a"), F.col("y.item").alias("b"))
              .agg(measure(F.col("x.rating"), F.col("y.rating")).alias("sim")))
    both = scored.select(F.inline(F.array(
        F.struct(F.col("a").alias("item"), F.col("b").alias("other"), "sim"),
        F.struct(F.col("b").alias("item"), F.col("a").alias("other"), "sim"))))
    best = Window.partitionBy("item").orderBy(F.desc_nulls_last("sim"), F.desc("other"))
    return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def recommended_items(ratings: DataFrame, matches: DataFrame) -> DataFrame:
    """For every person: similarity-weighted ratings of the neighbours of their items they have not rated."""
    reached = ratings.join(matches.select("item", "other", "sim"), "item")
    return (reached.groupBy("person", F.col("other").alias("item"))
            .agg(F.sum(F.col("sim") * F.col("rating")).alias("total"), F.sum("sim").alias("weight"))
            .join(ratings.select("person", "item"), ["person", "item"], "left_anti")
            .select("person", "item", F.try_divide("total", "weight").alias("score")))
