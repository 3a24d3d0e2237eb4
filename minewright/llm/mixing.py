"""Mixing sources to target weights: whole copies for all, Pareto order sampling for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.llm.batches import rereadable, unused
from minewright.operators.ranks import numbered, running_totals
from minewright.session import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating; copies of a source at most.
WEIGHTS, MOST = (5, 2, 1), 3


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``target`` words of each source of ``sources(unnamed, name, words)``.

    The words of all sources are shared by weight; a target stops at ``most`` times its source's words and
    the excess is shared by the others. In the order of words per weight the stopped sources come first, and the share
    of one weight is the largest that any beginning of that order leaves to the rest.
    """
    ranked = numbered(sources.withColumn("all", F.lit(0)), ["all"], ["unnamed", "name"], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    weighted = cut(ranked.withColumn("weight", weight).withColumn("ratio", F.col("words") / F.col("weight")), "weighted")
    sums = running_totals(weighted, ["all"], ["ratio", "unnamed", "name"], {"w": F.col("weight"), "s": F.col("words")})
    sum_s, sum_w = weighted.agg(F.sum("words"), F.sum("weight")).first()
    if not sum_s:
        return weighted.select("unnamed", "name", "words", F.lit(0.0).alias("target"))
    share = sums.agg(F.max((sum_s - most * (F.col("s") - F.col("words"))) / (sum_w - F.col("w") + F.col("weight")))).first()[0]
    return weighted.select("unnamed", "name", "words",
                           F.least(F.col("weight") * F.lit(share), (most * F.col("words")).cast("double")).alias("target"))


def uniform(seed: int, id_: Column, text: Column) -> Column:
    """A number above 0 and below 1 that depends on the seed and the id (on the text if there is none)."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(id_.cast("string"), F.md5(text), F.lit("")))), 1, 13), 16, 10)
    return (drawn.cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 11, id_column: str = "doc_id",
        text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Per row the id, ``size`` (words), ``source_size``, ``target`` (its source's), ``copies`` and ``taken`` (copies times size).

    A source whose target is r times its words takes every document floor(r) times; the rest R of the target comes from a
    Pareto sample of its documents. Their inclusion probabilities p add up to R words and grow with the square root of
    the size (in steps of a quarter power of two), up to 1. Documents are ranked by random odds over inclusion odds,
    u / (1 - u) * (1 - p) / p, and taken in that order up to the nearest to R. Ranks are found by bins of that
    value, as many as the root of the source's documents, so no task orders a whole source.

    Sources rank by code point, null last and a source of its own. A null or empty text has size 0 and is never
    drawn. A null id draws by its text; repeated rows tie and are drawn one after the other. Other columns are not
    read; an empty table gives an empty result. The draw depends on ``seed`` and the ids alone, so reruns agree.
    """
    return _mixed(docs, weights, most, seed, id_column, text_column, source_column).select(
        F.col("id").alias(id_column), "size", F.col("words").alias("source_size"), "target", "copies", "taken")


def _mixed(docs, weights, most, seed, id_column, text_column, source_column) -> DataFrame:
    text, id_ = F.col(text_column).cast("string"), F.col(id_column).cast("long")
    rows = cut(docs.select(
        F.monotonically_increasing_id().alias("row"), id_.alias("id"), F.col(source_column).isNull().cast("int").alias("unnamed"),
        F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("name"), words(text).alias("size"),
        uniform(seed, id_, text).alias("u"))
        .withColumn("step", F.when(F.col("size") > 0, F.floor(F.log2("size") * 2).cast("int"))), "sizes")
    key = ["unnamed", "name"]
    steps = cut(rows.groupBy(*key, "step").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "steps")
    sources = steps.groupBy(*key).agg(F.sum("words").alias("words"), F.sum("n").alias("n"))
    aims = (targets(sources.drop("n"), weights, most).join(sources.select(*key, "n"), key)
            .withColumn("whole", F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("words")))
    aims = cut(aims.withColumn("bins", F.ceil(F.sqrt("n"))), "aims")

    # Inclusion probabilities: weight * scale, the largest weights cut off at 1. At most some 100 steps a source.
    weight = F.pow(F.lit(2.0), F.col("step") / 4)
    larger = Window.partitionBy(*key).orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy(*key).orderBy(F.desc("step")).rowsBetween(0, Window.unboundedFollowing)
    chances = (steps.where("step is not null").select(*key, "step", F.col("words").alias("step_words")).join(aims.select(*key, "rest"), key)
               .withColumn("least", (F.col("rest") - F.coalesce(F.sum("step_words").over(larger), F.lit(0)))
                           / F.sum(weight * F.col("step_words")).over(smaller))
               .withColumn("scale", F.max("least").over(Window.partitionBy(*key)))
               .select(*key, "step", F.least(F.lit(1.0), weight * F.col("scale")).alias("chance")))

    odds = F.col("u") / (1 - F.col("u")) * (1 - F.col("chance")) / F.col("chance")
    drawn = (rows.join(chances, [*key, "step"], "left").join(aims, key)
             .withColumn("rank", F.when(F.col("chance") > 0, odds))
             .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * F.col("bins"))))
    before = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (drawn.where("rank is not null").groupBy(*key, "bin").agg(F.sum("size").alias("bin_words"), F.first("rest").alias("rest"))
            .withColumn("ahead", F.coalesce(F.sum("bin_words").over(before), F.lit(0)))
            # The bin in which the rest runs out.
            .where("ahead < rest and ahead + bin_words >= rest").select(*key, F.col("bin").alias("last_bin"), "ahead"))
    placed = drawn.join(bins, key, "left")
    inside = Window.partitionBy(*key).orderBy("rank", "id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    edge = placed.where("bin = last_bin").withColumn(
        "extra", (2 * (F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))) + F.col("size") <= 2 * F.col("rest")).cast("long"))
    # Without a last bin the whole source is less than the rest (by rounding) or there is no rest.
    sure = placed.where("rank is null or last_bin is null or bin <> last_bin").withColumn(
        "extra", F.when(F.col("rank").isNull(), 0).when(F.col("last_bin").isNull(), (F.col("rest") >= F.col("words")).cast("int"))
        .otherwise((F.col("bin") < F.col("last_bin")).cast("int")).cast("long"))
    copies = F.col("whole") + F.col("extra")
    return edge.unionByName(sure).select("row", "id", "size", "words", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 11, id_column: str = "doc_id",
            text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The rows of the mix with all their columns, each as often as it is taken."""
    docs = rereadable(docs)
    row, copies = unused(docs, "row"), unused(docs, "copies")
    chosen = _mixed(docs, weights, most, seed, id_column, text_column, source_column).where("copies > 0").select(
        F.col("row").alias(row), F.col("copies").alias(copies))
    return (docs.withColumn(row, F.monotonically_increasing_id()).join(chosen, row)
            .withColumn(row, F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop(row, copies))
