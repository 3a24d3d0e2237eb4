"""The inverted index: dictionaries and word positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.functions import text
from minewright.operators.ranks import numbered
from minewright.session import cut, small_batches


def dictionary(values: DataFrame, column: str, key: str) -> DataFrame:
    """Surrogate ids 1, 2, … in value order of the distinct values."""
    return numbered(values.select(column).distinct(), [], [column], key, start=1).select(key, column)


def extend_dictionary(known: DataFrame, values: DataFrame, column: str, key: str) -> DataFrame:
    """Get-or-create: unseen values get ids after the largest known one."""
    fresh = values.select(column).distinct().join(known, column, "left_anti")
    top = known.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    added = dictionary(fresh, column, key).select((F.col(key) + top).alias(key), column)
    return known.select(key, column).unionByName(added)


def postings(pages: DataFrame) -> DataFrame:
    """``url, word, location``: positions count all words, stop words are dropped afterwards."""
    return (pages.select("url", F.posexplode(text.plain_words(text.page_text(F.col("html")))).alias("location", "word"))
            .where(~F.col("word").isin(text.STOP_WORDS)))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, url, locations`` from ``url, words``: the words of a page, numbered and cut into runs of one word."""
    stop = pa.array(text.STOP_WORDS)
    for batch in batches:
        lists = batch.column("words")
        words, page = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
        real = pc.not_equal(words, "")
        words, page = pc.ascii_lower(words.filter(real)).dictionary_encode(), page[real.to_numpy(zero_copy_only=False)]
        code = words.indices.to_numpy().astype(np.int64)
        at = np.arange(len(page)) - np.searchsorted(page, page, "left")
        kept = ~pc.is_in(words.dictionary, stop).to_numpy(zero_copy_only=False)[code]
        code, page, at = code[kept], page[kept].astype(np.int64), at[kept].astype(np.int32)
        key = page * len(words.dictionary) + code
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([
            words.dictionary.take(pa.array(code[order[first]])), batch.column("url").take(pa.array(page[order[first]])),
            pa.ListArray.from_arrays(pa.array(np.append(first, len(key)).astype(np.int32)), pa.array(at[order]))], names=["word", "url", "locations"])


def grouped_postings(pages: DataFrame) -> DataFrame:
    """``word, url, locations``: the same postings, one row per word of a page.

    A page is one row, so its words are sorted and cut into runs of one word where it lies; nothing is shuffled.
    """
    words = pages.select("url", F.coalesce(text.page_words(F.col("html")), F.array().cast("array<string>")).alias("words"))
    return words.mapInArrow(_runs, "word string, url string, locations array<int>")


def posting_store(grouped: DataFrame, path: str, row_group: int = 1 << 20) -> DataFrame:
    """``grouped(word, url, locations)`` written to ``path``, sorted by word: ``word, url, n, first, locations``.

    A word's rows lie side by side in one or few files (a frequent word spans several), and small row groups carry the
    first and last word they hold: a filter on literal words reads the row groups of these words and no others. The rows are
    written before they are ranged, since the range sampling would make them a second time.
    """
    with small_batches(grouped.sparkSession, 500):
        grouped = cut(grouped.select("word", "url", "locations"), "grouped")
    sorted_rows = grouped.repartitionByRange("word", "url").sortWithinPartitions("word", "url")
    rows = sorted_rows.select("word", "url", F.size("locations").cast("long").alias("n"), F.get("locations", F.lit(0)).alias("first"), "locations")
    rows.write.option("parquet.block.size", row_group).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def locations(store: DataFrame) -> DataFrame:
    """``url, location, word`` of a posting store, one row per position."""
    return store.select("url", F.explode("locations").alias("location"), "word")


def word_location(found: DataFrame, urls: DataFrame, words: DataFrame) -> DataFrame:
    return (found.join(urls, "url").join(words, "word")
            .select("url_id", "word_id", F.col("location").cast("long").alias("location")))


def new_pages(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Incoming pages whose url has no indexed word yet."""
    return pages.join(found.select("url").distinct(), "url", "left_anti")
