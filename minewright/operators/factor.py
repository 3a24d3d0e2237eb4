"""Non-negative factorisation of a long sparse matrix ``i, j, v`` and topic reports.

``W`` is ``i, w ARRAY`` and ``H`` is ``j, h ARRAY``; the dense product never exists. Only the
factor-by-factor products (as small as the factor count squared) are shared with every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.functions import kernels
from minewright.operators import factor_blocks, factor_rounds
from minewright.session import cut, laid_out, small_batches


def uniform(*parts: Column) -> Column:
    """A number in (0, 1] from a hash of the parts: the same on any cluster."""
    text = F.concat_ws("-", *[p.cast("string") for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("double") + 1) / 268435457.0


def start(matrix: DataFrame, side: str, vector: str, factors: int) -> DataFrame:
    """Hashed starting weights of every row (or column) that has an entry."""
    keys = matrix.select(side).distinct()
    return keys.select(side, F.array(*[uniform(F.col(side), F.lit(f"{vector}{a}")) for a in range(factors)]).alias(vector))


def gram(side: DataFrame, vector: str, factors: int) -> Column:
    """Sums of products of every two factors, as one array of arrays."""
    at = [F.get(vector, F.lit(a)) for a in range(factors)]
    sums = {(a, b): F.sum(at[a] * at[b]) for a in range(factors) for b in range(a, factors)}
    return side.agg(F.array(*[F.array(*[sums[min(a, b), max(a, b)] for b in range(factors)]) for a in range(factors)])).scalar()


def _pulled(matrix: DataFrame, fixed: DataFrame, fixed_key: str, moved_key: str, fixed_vector: str, factors: int) -> DataFrame:
    """``moved_key, pull``: V times the fixed side, one array per moved key, summed in every task before the shuffle."""
    parts = [F.sum(F.col("v") * F.get(fixed_vector, F.lit(a))) for a in range(factors)]
    return matrix.join(fixed, fixed_key).groupBy(moved_key).agg(F.array(*parts).alias("pull"))


def _updated(matrix: DataFrame, fixed: DataFrame, moved: DataFrame, fixed_key: str, moved_key: str,
             fixed_vector: str, moved_vector: str, factors: int) -> DataFrame:
    """One multiplicative update of ``moved``: times (V · fixed) over (moved · gram of fixed).

    The products are summed per moved key before the shuffle, so a hot row or column costs one
    partial sum per task. A zero denominator gives 0.
    """
    pulled = _pulled(matrix, fixed, fixed_key, moved_key, fixed_vector, factors)
    rows = moved.join(pulled, moved_key).withColumn("gram", gram(fixed, fixed_vector, factors))
    spread = F.transform("gram", lambda row: kernels.dot(row, F.col(moved_vector)))
    new = F.zip_with(F.zip_with(moved_vector, "pull", lambda m, p: m * p), spread,
                     lambda top, down: F.coalesce(F.try_divide(top, down), F.lit(0.0)))
    return rows.select(moved_key, new.alias(moved_vector))


def step(matrix: DataFrame, w: DataFrame, h: DataFrame, factors: int) -> tuple[DataFrame, DataFrame]:
    """Update H from W, then W from the new H."""
    h = cut(_updated(matrix, w, h, "i", "j", "w", "h", factors), "h")
    return _updated(matrix, h, w, "j", "i", "h", "w", factors), h


def cost(matrix: DataFrame, w: DataFrame, h: DataFrame, factors: int) -> DataFrame:
    """One row ``cost``: squared error over all cells, from the entries, V times W and the two small products."""
    squares = matrix.agg(F.coalesce(F.sum(F.col("v") * F.col("v")), F.lit(0.0)).alias("vv"))
    met = h.join(_pulled(matrix, w, "i", "j", "w", factors), "j").agg(F.coalesce(F.sum(kernels.dot(F.col("h"), F.col("pull"))), F.lit(0.0))).scalar()
    both = squares.withColumn("vwh", met).withColumn("gw", gram(w, "w", factors)).withColumn("gh", gram(h, "h", factors))
    trace = F.aggregate(F.zip_with("gw", "gh", kernels.dot), F.lit(0.0), lambda s, v: s + v)
    return both.select((F.col("vv") - 2 * F.col("vwh") + trace).alias("cost"))


def factorize(matrix: DataFrame, factors: int = 10, rounds: int = 50, check_every: int = 10) -> tuple[DataFrame, DataFrame]:
    """W and H after ``rounds`` updates, or earlier if the product is exact.

    If the side with fewer keys is small enough to travel, a round is one pass over the cells (``factor_rounds``). If not, the matrix is laid out twice, in blocks of rows and in blocks of columns, and each factor in blocks of its own keys. A half round
    joins the matrix where it lies with the factor that stays, multiplies whole blocks, and moves only the sums for the factor that
    changes; that one is written, since the next half round reads it three times.
    """
    matrix = cut(matrix.select("i", "j", F.coalesce(F.col("v").cast("double"), F.lit(0.0)).alias("v")), "matrix")
    size = matrix.agg(F.count("*").alias("cells"), F.coalesce(F.sum(F.col("v") * F.col("v")), F.lit(0.0)).alias("squares"),
                      F.approx_count_distinct("i").alias("i"), F.approx_count_distinct("j").alias("j")).first()
    if min(size["i"], size["j"]) * factors * 8 <= factor_rounds.TRAVELS:
        sides = [("i", "w"), ("j", "h")]
        (own, vector), (other, carried) = sides if size["i"] > size["j"] else sides[::-1]
        begun = start(matrix.where(F.col(other).isNotNull()), other, carried, factors)
        found = dict(zip((vector, carried), factor_rounds.factorized(
            matrix, begun, own, other, (vector, carried), size["cells"], size["squares"], factors, rounds, check_every)))
        return found["w"], found["h"]
    rows, columns = factor_blocks.numbers(matrix, "i"), factor_blocks.numbers(matrix, "j")
    cells = cut(matrix.join(rows.select("i", F.col("block").alias("i_block"), F.col("place").alias("i_place")), "i")
                .join(columns.select("j", F.col("block").alias("j_block"), F.col("place").alias("j_place")), "j").drop("i", "j"), "cells")
    by_i, by_j = factor_blocks.layout(cells, "i", "j", "matrix_i"), factor_blocks.layout(cells, "j", "i", "matrix_j")
    w = laid_out(factor_blocks.factor_of(start(matrix, "i", "w", factors), rows, "i", "w"), ["block"], "w")
    h = laid_out(factor_blocks.factor_of(start(matrix, "j", "h", factors), columns, "j", "h"), ["block"], "h")
    with small_batches(matrix.sparkSession, 16):
        for done in range(1, rounds + 1):
            h = laid_out(factor_blocks.updated(by_i, w, h, factors), ["block"], "h", placed=True)
            w = laid_out(factor_blocks.updated(by_j, h, w, factors), ["block"], "w", placed=True)
            if done % check_every == 0 and done < rounds and factor_blocks.cost(cells, by_i, w, h, factors) == 0.0:
                break
    return factor_blocks.vectors_of(w, rows, "i", "w", factors), factor_blocks.vectors_of(h, columns, "j", "h", factors)


def long(side: DataFrame, key: str, vector: str) -> DataFrame:
    return side.select(key, F.posexplode(vector).alias("factor", "weight"))


def top_keys(side: DataFrame, key: str, vector: str, n: int) -> DataFrame:
    """``factor, rank, key, weight``: the heaviest keys per factor, by (weight, key) descending.

    Spark drops all but n candidates per factor in every task before the shuffle.
    """
    order = Window.partitionBy("factor").orderBy(F.desc("weight"), F.desc(key))
    return (long(side, key, vector).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
            .select("factor", "rank", key, "weight"))


def topic_words(h: DataFrame, n: int = 6) -> DataFrame:
    """``factor, words``: the top words of each topic in one text."""
    top = top_keys(h, "j", "h", n).groupBy("factor").agg(F.array_sort(F.collect_list(F.struct("rank", "j"))).alias("t"))
    return top.select("factor", F.array_join(F.col("t.j"), " ").alias("words"))


def topic_titles(w: DataFrame, titles: DataFrame, n: int = 3) -> DataFrame:
    """``factor, rank, title, weight`` from ``titles(i, title)``."""
    return top_keys(w.join(titles, "i").select("title", "w"), "title", "w", n)


def article_topics(w: DataFrame, h: DataFrame, titles: DataFrame, n: int = 3) -> DataFrame:
    """``title, rank, weight, words``: the strongest topics of every article, by (weight, topic) descending.

    The weights of an article are one short array, so the best ones are taken from it in place.
    """
    cells = F.transform("w", lambda weight, at: F.struct(weight.alias("weight"), at.alias("factor")))
    best = F.slice(F.sort_array(cells, asc=False), 1, n)
    ranked = w.join(titles, "i").select("title", F.posexplode(best).alias("place", "cell"))
    return (ranked.select("title", (F.col("place") + 1).alias("rank"), "cell.weight", "cell.factor")
            .join(topic_words(h), "factor").select("title", "rank", "weight", "words"))


def aligned(series: DataFrame, key: str, date: str) -> DataFrame:
    """Rows of the dates on which every series has a value."""
    every = series.agg(F.count_distinct(key)).scalar()
    full = series.groupBy(date).agg(F.count_distinct(key).alias("n")).where(F.col("n") == every).select(date)
    return series.join(full, date, "left_semi")
