"""Naive Bayes and Fisher text classification over long feature counts.

The model is ``FeatureCounts(feature, category, n)`` and ``CategoryCounts(category, n)``; both are
sums, so batches and streams merge them the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.functions import text

# Weight and assumed probability of an unseen feature.
WEIGHT, ASSUMED = 1.0, 0.5


@dataclass
class Model:
    features: DataFrame
    categories: DataFrame


def document_features(docs: DataFrame) -> DataFrame:
    """``doc_id, feature``: the distinct words of every text."""
    return docs.select("doc_id", F.explode(text.distinct_words(F.col("text"))).alias("feature"))


def train(docs: DataFrame) -> Model:
    """Counts of labelled documents ``doc_id, text, category``."""
    found = docs.select("category", F.explode(text.distinct_words(F.col("text"))).alias("feature"))
    return Model(found.groupBy("feature", "category").agg(F.count("*").alias("n")),
                 docs.groupBy("category").agg(F.count("*").alias("n")))


def merged(model: Model, more: Model) -> Model:
    return Model(model.features.unionByName(more.features).groupBy("feature", "category").agg(F.sum("n").alias("n")),
                 model.categories.unionByName(more.categories).groupBy("category").agg(F.sum("n").alias("n")))


def _category_list(model: Model) -> Column:
    """The categories with their sizes as one sorted array: the classifier's output dimension."""
    return model.categories.agg(F.array_sort(F.collect_list(F.struct("category", "n")))).scalar()


def feature_table(model: Model) -> DataFrame:
    """One row per feature: ``counts`` by category and their ``total``; the join side of every scoring."""
    return model.features.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("category", "n"))).alias("counts"), F.sum("n").alias("total"))


def feature_probabilities(model: Model) -> DataFrame:
    sizes = model.categories.select("category", F.col("n").alias("size"))
    return model.features.join(sizes, "category").select(
        "feature", "category", F.try_divide("n", "size").alias("prob"))


def category_probabilities(model: Model) -> DataFrame:
    """Share of each category in the summed feature probabilities of a feature."""
    probs = feature_probabilities(model)
    total = probs.groupBy("feature").agg(F.sum("prob").alias("all"))
    return probs.join(total, "feature").select("feature", "category", F.try_divide("prob", "all").alias("prob"))


def _weighted(prob: Column, total: Column) -> Column:
    return (WEIGHT * ASSUMED + total * prob) / (WEIGHT + total)


def _count(counts: Column, category: Column) -> Column:
    return F.coalesce(F.try_element_at(counts, category["category"]), F.lit(0)) / category["n"]


def _plain_prob(counts: Column, category: Column, categories: Column) -> Column:
    return _count(counts, category)


def _shared_prob(counts: Column, category: Column, categories: Column) -> Column:
    everywhere = F.aggregate(categories, F.lit(0.0), lambda total, c: total + _count(counts, c))
    return F.coalesce(F.try_divide(_count(counts, category), everywhere), F.lit(0.0))


def weighted_probabilities(model: Model) -> DataFrame:
    """The smoothed probability of every known feature in every category."""
    return (feature_table(model).withColumn("categories", _category_list(model))
            .select("feature", "counts", "total", "categories", F.explode("categories").alias("c"))
            .select("feature", F.col("c.category").alias("category"),
                    _weighted(_plain_prob(F.col("counts"), F.col("c"), F.col("categories")), F.col("total")).alias("prob")))


def _log_sums(features: DataFrame, docs: DataFrame, model: Model, prob) -> DataFrame:
    """``doc_id, category, log_sum, features`` for every document and category.

    The logs of a feature are worked out once, in the model, by the place of the category; a feature without a model row has
    the log of the assumed probability. So the features are read in one pass, and a feature found everywhere only widens the side
    that can be split. The logs are added per category before the shuffle.
    """
    scored = feature_table(model).withColumn("categories", _category_list(model)).select("feature", F.transform(
        "categories", lambda c: F.ln(_weighted(prob(F.col("counts"), c, F.col("categories")), F.col("total")))).alias("logs"))
    unseen = F.array_repeat(F.ln(F.lit(ASSUMED)), F.size(_category_list(model)))
    logs = features.join(scored, "feature", "left").select("doc_id", F.posexplode(F.coalesce("logs", unseen)).alias("at", "log"))
    seen = logs.groupBy("doc_id", "at").agg(F.sum("log").alias("log_sum"), F.count("*").alias("features"))
    grid = (docs.select("doc_id", F.posexplode(_category_list(model)).alias("at", "c"))
            .select("doc_id", "at", F.col("c.category").alias("category"), F.col("c.n").alias("size")))
    return grid.join(seen, ["doc_id", "at"], "left").select(
        "doc_id", "category", "size", F.coalesce("features", F.lit(0)).alias("features"), F.coalesce("log_sum", F.lit(0.0)).alias("log_sum"))


def log_probabilities(features: DataFrame, docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, category, log_prob``: log of the feature product times the category share."""
    total = model.categories.agg(F.sum("n")).scalar()
    return (_log_sums(features, docs, model, _plain_prob)
            .select("doc_id", "category", (F.col("log_sum") + F.ln(F.col("size") / total)).alias("log_prob")))


def classify(log_probs: DataFrame, thresholds: dict[str, float] | None = None, default: str | None = None) -> DataFrame:
    """The best category, or ``default`` if another one times the best one's threshold beats it.

    Only a document's categories meet in a window: as few rows as there are categories.
    """
    order = Window.partitionBy("doc_id").orderBy(F.desc("log_prob"), "category")
    ranked = log_probs.select("doc_id", "category", "log_prob", F.row_number().over(order).alias("rank"),
                              F.lead("log_prob").over(order).alias("second")).where("rank = 1")
    needed = F.lit(1.0)
    for category, value in (thresholds or {}).items():
        needed = F.when(F.col("category") == category, value).otherwise(needed)
    beaten = F.coalesce(F.col("second") + F.ln(needed) > F.col("log_prob"), F.lit(False))
    return ranked.select("doc_id", F.when(beaten, F.lit(default)).otherwise(F.col("category")).alias("category"))


def inverse_chi2(half: Column, terms: Column) -> Column:
    """Upper tail of chi-squared with ``2·terms`` degrees of freedom at ``2·half``, capped at 1.

    Up to a half of 1400 the sum is worked from its last term to its first, on a carried ``exp`` that neither underflows nor lets the sum
    overflow. Beyond, the terms are carried as logs so that long documents do not underflow.
    """
    least, most = F.lit(1).cast("long"), F.greatest(terms - 1, F.lit(1).cast("long"))
    some, none = (terms > 1) & (half > 0), F.array().cast("array<bigint>")
    carried = F.exp(-F.least(half, F.lit(700.0)))
    near = F.aggregate(F.coalesce(F.when(some, F.sequence(most, least, F.lit(-1).cast("long"))), none), carried,
                       lambda acc, i: carried + acc * half / i) * F.exp(F.least(700.0 - half, F.lit(0.0)))
    start = F.struct((-half).alias("log"), F.exp(-half).alias("sum"))

    def add(acc, i):
        log = acc["log"] + F.ln(half / i)
        return F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum"))

    far = F.aggregate(F.coalesce(F.when(some, F.sequence(least, most)), none), start, add, lambda acc: acc["sum"])
    return F.least(F.when(half <= 1400, near).otherwise(far), F.lit(1.0))


def fisher_probabilities(features: DataFrame, docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, category, prob`` by Fisher's method over the category probabilities."""
    sums = _log_sums(features, docs, model, _shared_prob)
    return sums.select("doc_id", "category", inverse_chi2(-F.col("log_sum"), F.col("features")).alias("prob"))


def fisher_classify(probs: DataFrame, minimums: dict[str, float] | None = None, default: str | None = None) -> DataFrame:
    """The most probable category above its minimum, else ``default``."""
    least = F.lit(0.0)
    for category, value in (minimums or {}).items():
        least = F.when(F.col("category") == category, value).otherwise(least)
    fits = (F.col("prob") > least) & (F.col("prob") > 0)
    best = F.min(F.when(fits, F.struct((-F.col("prob")).alias("p"), "category")))
    return probs.groupBy("doc_id").agg(F.coalesce(best["category"], F.lit(default)).alias("category"))
