"""Scoring pages for a query from the word positions, links and ranks.

A query is a frame ``word_no, word``; the positions of its words carry ``url, word_no, location``.
Page-wise windows are safe: a page is one stored record, so its positions fit a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.session import cut

TINY = 0.00001


def asked(found: DataFrame, query: DataFrame) -> DataFrame:
    """The rows of ``found`` (with ``word`` and ``url``) for the words of the query, with their ``word_no``.

    The few words of a query become literals, so a posting store reads only where they stand. Words on no page are ignored: the
    others are numbered from 0 without gaps, in the order of the query.
    """
    numbers: dict[str, list[int]] = {}
    for row in query.select("word_no", "word").collect():
        numbers.setdefault(row["word"], []).append(row["word_no"])
    rows = found.where(F.col("word").isin(*numbers))
    known = {row["word"] for row in rows.select("word").distinct().collect()}
    order = sorted((n, word) for word in known for n in numbers[word])
    if not order:
        return rows.withColumn("word_no", F.lit(0)).where(F.lit(False))
    place = None
    for word in sorted(known):
        own = F.array(*[F.lit(k) for k, (_, other) in enumerate(order) if other == word])
        place = F.when(F.col("word") == word, own) if place is None else place.when(F.col("word") == word, own)
    return rows.where(F.col("word").isin(*known)).withColumn("word_no", F.explode(place))


def match_rows(found: DataFrame, query: DataFrame) -> DataFrame:
    """Positions on the pages that hold every known query word, as ``url, word_no, word, location``.

    This is the factorised form of the position combinations: a page with 100 and 200 positions
    is 300 rows here, not 20,000, and every score below is exact on it.
    """
    hits = asked(found, query)
    known = hits.agg(F.count_distinct("word_no")).scalar()  # at most the words of the query
    full = hits.groupBy("url").agg(F.count_distinct("word_no").alias("n")).where(F.col("n") == known).select("url")
    return hits.join(full, "url", "left_semi").select("url", "word_no", "word", "location")


def matched_pages(store: DataFrame, query: DataFrame) -> DataFrame:
    """``url, frequency, location`` of the pages that hold every known query word, from one read of a posting store."""
    hits = asked(store, query)
    words = hits.groupBy("url").agg(F.collect_list(F.struct("word_no", F.col("n").cast("double").alias("n"))).alias("words"),
                                    F.sum("first").cast("double").alias("location"))
    found = cut(words.select("url", F.aggregate("words", F.lit(1.0), lambda product, w: product * w["n"]).alias("frequency"), "location",
                             F.transform("words", lambda w: w["word_no"]).alias("numbers")), "matched")
    known = found.agg(F.max(F.array_max("numbers")) + 1).scalar()
    return found.where(F.size("numbers") == known).select("url", "frequency", "location")


def page_scores(pages: DataFrame, values: dict[str, DataFrame], small: set[str]) -> DataFrame:
    """``url`` and a score in 0..1 per value, all against the best of the result set; ``values`` are further ``url, value`` frames.

    A page without a value has 0. ``small``: the values of which the smallest is the best.
    """
    for name, found in values.items():
        pages = pages.join(found.select("url", F.col("value").cast("double").alias(name)), "url", "left")
    names = [c for c in pages.columns if c != "url"]
    pages = cut(pages.select("url", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in names]), "values")
    best = pages.agg(*[F.min(c).alias(c) if c in small else F.when(F.max(c) == 0, TINY).otherwise(F.max(c)).alias(c) for c in names]).first()
    return pages.select("url", *[(F.lit(best[c]) / F.greatest(F.col(c), F.lit(TINY)) if c in small else F.col(c) / F.lit(best[c])).alias(c) for c in names])


def per_word(rows: DataFrame) -> DataFrame:
    return rows.groupBy("url", "word_no").agg(F.count("*").alias("n"), F.min("location").alias("first"))


def frequency(rows: DataFrame) -> DataFrame:
    """Number of position combinations per page: the product of the word counts."""
    counts = per_word(rows).groupBy("url").agg(F.collect_list(F.col("n").cast("double")).alias("counts"))
    return counts.select("url", F.aggregate("counts", F.lit(1.0), lambda product, n: product * n).alias("value"))


def _at_most(value: Column, most: float | None) -> Column:
    return value if most is None else F.least(value, F.lit(float(most)))


def location(rows: DataFrame, most: float | None = None) -> DataFrame:
    """Smallest sum of positions: the sum of the first positions; values over ``most`` (if given) count as it."""
    return per_word(rows).groupBy("url").agg(_at_most(F.sum("first").cast("double"), most).alias("value"))


def distance(rows: DataFrame, most: float | None = None) -> DataFrame:
    """Smallest sum of gaps between neighbouring query words; 1 for a single word. Values over ``most`` (if given) count as it.

    Word by word, the best cost of ending at each position comes from two sweeps over the page:
    the cheapest earlier position to the left (cost minus place) and to the right (cost plus place).
    """
    steps = rows.select("url", "word_no", F.col("location").cast("double").alias("place"))
    words = (rows.agg(F.max("word_no")).first()[0] or 0) + 1
    if words < 2:
        return steps.select("url").distinct().withColumn("value", F.lit(1.0))
    best = steps.where("word_no = 0").select("url", "place", F.lit(0.0).alias("cost"))
    for word_no in range(1, words):
        here = steps.where(F.col("word_no") == word_no).select("url", "place", F.lit(None).cast("double").alias("cost"))
        line = Window.partitionBy("url").orderBy("place")
        left = F.min(F.col("cost") - F.col("place")).over(line.rangeBetween(Window.unboundedPreceding, 0))
        right = F.min(F.col("cost") + F.col("place")).over(line.rangeBetween(0, Window.unboundedFollowing))
        best = (best.unionByName(here).select("url", "place", "cost", left.alias("left"), right.alias("right"))
                .where("cost IS NULL")
                .select("url", "place", F.least(F.col("left") + F.col("place"), F.col("right") - F.col("place")).alias("cost")))
    return best.groupBy("url").agg(_at_most(F.min("cost"), most).alias("value"))


def normalized(scores: DataFrame, small_is_better: bool = False) -> DataFrame:
    """``url, score`` in 0..1 against the best value of the result set."""
    value = F.col("value")
    if small_is_better:
        return scores.select("url", (scores.agg(F.min("value")).scalar() / F.greatest(value, F.lit(TINY))).alias("score"))
    top = scores.agg(F.when(F.max("value") == 0, TINY).otherwise(F.max("value"))).scalar()
    return scores.select("url", (value / top).alias("score"))


def frequency_score(rows: DataFrame) -> DataFrame:
    return normalized(frequency(rows))


def location_score(rows: DataFrame) -> DataFrame:
    return normalized(location(rows), small_is_better=True)


def distance_score(rows: DataFrame) -> DataFrame:
    """``rows`` should be a stored table: the scores are read twice, once for their minimum. A single word scores 1."""
    return normalized(cut(distance(rows), "distances"), small_is_better=True)


def _filled(pages: DataFrame, values: DataFrame) -> DataFrame:
    return (pages.select("url").distinct().join(values, "url", "left")
            .select("url", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value")))


def inbound_score(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Links into each page, repeats included."""
    return normalized(_filled(pages, links.groupBy(F.col("to_url").alias("url")).agg(F.count("*").alias("value"))))


def rank_score(pages: DataFrame, ranks: DataFrame) -> DataFrame:
    return normalized(_filled(pages, ranks.select("url", F.col("score").alias("value"))))


def link_votes(link_words: DataFrame, ranks: DataFrame, query: DataFrame) -> DataFrame:
    """``url, value``: summed rank of the pages whose link text holds a query word; ``link_words`` is ``from_url, to_url, word``."""
    words = [row["word"] for row in query.select("word").distinct().collect()]
    return (link_words.where(F.col("word").isin(*words)).join(ranks.select(F.col("url").alias("from_url"), "score"), "from_url")
            .groupBy(F.col("to_url").alias("url")).agg(F.sum("score").alias("value")))


def link_text_score(pages: DataFrame, link_words: DataFrame, ranks: DataFrame, query: DataFrame) -> DataFrame:
    return normalized(_filled(pages, link_votes(link_words, ranks, query)))


def weighted(scores: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``url, score``: the weighted sum of the scores of a page."""
    return scores.select("url", reduce(Column.__add__, [F.lit(float(w)) * F.col(name) for name, w in weights.items()]).alias("score"))


def top_pages(scores: DataFrame, order: Column, n: int = 10) -> DataFrame:
    return scores.orderBy(order, F.desc("url")).limit(n)
