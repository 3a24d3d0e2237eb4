"""Word counting and weighting over documents, in long (sparse) form throughout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.functions import text
from minewright.operators.ranks import numbered
from minewright.session import cut, small_batches


def word_counts(entries: DataFrame, by: str, body: Column, shortest: int) -> DataFrame:
    """``by, word, n`` of the lower-cased words (``\\W+`` parts them) of at least ``shortest`` letters; written, since weights read it twice.

    A text is one row, so its words are counted where it lies. Only if a value of ``by`` comes twice are counts of several rows added up.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.split_pattern_regex(batch.column("body"), r"\W+")
            words, row = lists.flatten(), pc.list_parent_indices(lists)
            kept = pc.greater_equal(pc.binary_length(words), shortest)  # words are ASCII
            words, row = pc.ascii_lower(words.filter(kept)).dictionary_encode(), row.filter(kept).to_numpy().astype(np.int64)
            size = max(len(words.dictionary), 1)
            cells, n = np.unique(row * size + words.indices.to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([batch.column(by).take(pa.array(cells // size)), words.dictionary.take(pa.array(cells % size)), pa.array(n)],
                                             names=[by, "word", "n"])

    with small_batches(entries.sparkSession, 1000):
        counts = cut(entries.select(by, body.alias("body")).mapInArrow(run, f"{by} {dict(entries.dtypes)[by]}, word string, n long"), "counts")
    if entries.select(by).groupBy(by).count().where("count > 1").isEmpty():
        return counts
    return counts.groupBy(by, "word").agg(F.sum("n").alias("n"))


def feed_word_counts(entries: DataFrame) -> DataFrame:
    """``feed, word, n``; words are lower-cased as rows, where generated code does it."""
    pieces = entries.select("feed", F.explode(text.html_pieces(F.concat_ws(" ", "title", "summary"))).alias("word"))
    return (pieces.where("word <> ''").groupBy("feed", F.lower("word").alias("word")).agg(F.count("*").alias("n")))


def vocabulary_band(counts: DataFrame, listed: DataFrame, low: float = 0.1, high: float = 0.5) -> DataFrame:
    """Words used more than once by a share of the listed feeds inside the open band."""
    feeds = listed.select("feed").distinct().agg(F.count("*").cast("double")).scalar()
    return (counts.groupBy("word").agg(F.count_if(F.col("n") > 1).alias("feeds"))
            .withColumn("frac", F.col("feeds") / feeds)
            .where((F.col("frac") > low) & (F.col("frac") < high)))


def word_blocks(vocabulary: DataFrame, block: int = 1000) -> DataFrame:
    """``word, block, place``: the words in order, ``block`` of them to a column block; numbered without one task for all."""
    at = numbered(vocabulary.select("word").distinct(), [], ["word"], "_at")
    return at.select("word", F.floor(F.col("_at") / block).cast("int").alias("block"), F.pmod("_at", F.lit(block)).cast("int").alias("place"))


def matrix_blocks(counts: DataFrame, words: DataFrame, feeds: DataFrame) -> DataFrame:
    """``feed, block, counts``: one zero-filled count array per feed and column block of ``words(word, block, place)``.

    Nothing holds more words than a block: neither a row nor the driver. Words without a block are left out, a feed without
    words has zeros. An empty vocabulary or no feeds give an empty table.
    """
    sizes = words.groupBy("block").agg(F.count("*").cast("int").alias("size"))
    cells = (counts.join(words, "word").groupBy("feed", "block")
             .agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("cells")))
    blocks = sizes.agg(F.array_sort(F.collect_list(F.struct("block", "size")))).scalar()  # two numbers a block
    every = feeds.select("feed").distinct().select("feed", F.explode(blocks).alias("b")).select("feed", "b.block", "b.size")
    filled = every.join(cells, ["feed", "block"], "left").withColumn("cells", F.coalesce("cells", F.array().cast("array<struct<place: int, n: bigint>>")))
    # Zeros fill what lies between one word and the next: a look at every word there is, none at every place.
    zeros = F.zip_with(F.concat(F.array(F.lit(-1)), "cells.place"), F.concat("cells.place", F.array("size")),
                       lambda here, after: F.array_repeat(F.lit(0).cast("long"), after - here - 1))
    found = F.concat(F.transform("cells.n", lambda n: F.array(n)), F.array(F.array().cast("array<bigint>")))
    return filled.select("feed", "block", F.flatten(F.zip_with(zeros, found, lambda gap, n: F.concat(gap, n))).alias("counts"))


def first_by(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Keep the earliest row of every key.

    Only keys and numbers are grouped. The keys that come twice then tell which rows to leave out, so the
    other columns move only if these keys are too many to be sent to the rows. Of rows with one key and number any one stays.
    """
    twice = cut(rows.groupBy(key, seq).agg(F.count("*").alias("_ties")).groupBy(key).agg(
        F.sum("_ties").alias("_rows"), F.min(F.struct(seq, "_ties")).alias("_first")).where("_rows > 1").select(
        F.col(key).alias("_key"), F.col(f"_first.{seq}").alias("_seq"), "_first._ties"), "twice")
    same = F.col(key).eqNullSafe(F.col("_key"))
    kept = rows.join(twice, same, "left").where(F.col("_ties").isNull() | F.col(seq).eqNullSafe(F.col("_seq")))
    if not twice.where("_ties > 1").isEmpty():
        rank = F.row_number().over(Window.partitionBy(key).orderBy(seq))
        tied = F.coalesce(F.col("_ties") > 1, F.lit(False))
        kept = kept.where(~tied).unionByName(kept.where(tied).withColumn("_rank", rank).where("_rank = 1").drop("_rank"))
    return kept.select(*rows.columns)


def first_by_title(entries: DataFrame) -> DataFrame:
    return first_by(entries, "title", "doc_id")


def article_words(articles: DataFrame) -> DataFrame:
    """Counts of the words of articles that ``first_by_title`` has told apart."""
    return word_counts(articles, "doc_id", F.concat(F.col("title"), text.strip_html(F.col("summary"))), 4)


def article_matrix(counts: DataFrame, articles: DataFrame, least: int = 3, share: float = 0.6) -> DataFrame:
    """Counts of the words whose total lies above ``least`` and below a share of the articles."""
    total = articles.agg((F.count("*") * share)).scalar()
    kept = cut(counts.groupBy("word").agg(F.sum("n").alias("total"))
               .where((F.col("total") > least) & (F.col("total") < total)).select("word"), "kept")  # its real size tells how to join
    return counts.join(kept, "word").select("doc_id", "word", "n")


def tfidf(counts: DataFrame, documents: DataFrame, max_df: float = 0.95, features: int = 320) -> DataFrame:
    """L2-normalised tf-idf (smoothed idf plus one) of the most frequent words."""
    total = documents.agg(F.count("*").cast("double")).scalar()
    vocabulary = (counts.groupBy("word").agg(F.count("*").alias("df"), F.sum("n").alias("total"))
                  .withColumn("docs", total)
                  .where(F.col("df") <= max_df * F.col("docs"))
                  .orderBy(F.desc("total"), "word").limit(features)
                  .select("word", (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1).alias("idf")))
    raw = counts.join(vocabulary, "word").withColumn("raw", F.col("n") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "word", (F.col("raw") / norm).alias("weight"))


def indicators(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Long one-hot form: ``column=value`` flags for text, the number itself for numeric columns."""
    types = dict(rows.dtypes)
    cells = [
        F.struct(F.concat(F.lit(f"{c}="), F.col(c)).alias("feature"), F.lit(1.0).alias("value"))
        if types[c] == "string"
        else F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    return rows.select(key, F.inline(F.array(*cells)))
