"""Readers and writers of the mining file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.operators.ranks import numbered
from minewright.functions import text


def load_ratings(spark: SparkSession, items: str, data: str) -> DataFrame:
    """``person, item, rating`` from ``id|title|…`` items and tab-separated ``user, id, rating, ts``.

    A person who rated a title twice keeps the rating with the latest time (the higher one at the same time).
    """
    titles = spark.read.csv(items, sep="|", quote="").select(F.col("_c0").alias("movie_id"), F.col("_c1").alias("item"))
    rated = spark.read.csv(data, sep="\t", schema="person STRING, movie_id STRING, rating DOUBLE, ts LONG")
    return rated.join(titles, "movie_id").groupBy("person", "item").agg(F.max_by("rating", F.struct("ts", "rating")).alias("rating"))


def write_matrix(rows: DataFrame, words: DataFrame, path: str, corner: str = "Blog") -> None:
    """Write ``feed, block, counts`` as one tab-separated matrix per column block, in a folder ``block=…`` each.

    ``words(word, block, place)`` names the columns: every block has its own header line, so neither a line nor the driver holds
    more words than a block.
    """
    header = words.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w")).select(
        "block", F.concat_ws("\t", F.lit(corner), F.array_join("w.word", "\t")).alias("value"))
    lines = rows.select("block", F.concat_ws("\t", "feed", F.array_join("counts", "\t")).alias("value"))
    header.unionByName(lines).write.partitionBy("block").text(path)


def read_matrix(spark: SparkSession, path: str, corner: str = "Blog") -> DataFrame:
    """``row_name, column, value`` from tab-separated matrices whose header lines start with ``corner``.

    ``path`` is one matrix or has column blocks in ``block=…`` folders; a line belongs to the header of its folder. Lines are split
    into arrays and turned long at once: thousands of words need no wide row.
    """
    lines = spark.read.text(path)
    if "block" not in lines.columns:
        lines = lines.withColumn("block", F.lit(0))
    is_header = F.col("value").startswith(f"{corner}\t")
    names = lines.where(is_header).groupBy("block").agg(F.split(F.min("value"), "\t").alias("names"))
    cells = lines.where(~is_header & (F.col("value") != "")).select("block", F.split("value", "\t").alias("c")).join(names, "block")
    long = F.arrays_zip(F.slice("names", 2, F.size("names") - 1).alias("column"), F.slice("c", 2, F.size("c") - 1).alias("value"))
    return cells.select(F.get("c", F.lit(0)).alias("row_name"), F.inline(long)).withColumn("value", F.col("value").cast("double"))


def feed_entries(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """``feed, title, summary`` of stored RSS documents, one per file or one per line.

    The description stands in for a missing summary; feeds without a title are skipped.
    """
    schema = "channel STRUCT<title: STRING, item: ARRAY<STRUCT<title: STRING, summary: STRING, description: STRING>>>"
    feeds = spark.read.text(path, wholetext=not per_line).select(F.from_xml("value", schema).alias("rss")).select("rss.channel.*")
    return (feeds.where("title IS NOT NULL").select(F.col("title").alias("feed"), F.explode("item").alias("e"))
            .select("feed", "e.title", F.coalesce("e.summary", "e.description").alias("summary")))


def load_schedule(spark: SparkSession, path: str) -> DataFrame:
    """``origin, dest, idx, dep_min, arr_min, price``; ``idx`` counts a route's flights in file order.

    File order is the only order the format has: files follow each other by name, their splits by place, and the
    lines of a split as they are read, so a file of any size is spread over as many tasks as it has splits.
    """
    lines = (spark.read.text(path, lineSep="\n")
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"), F.regexp_replace("value", r"\r$", "").alias("text")).where("trim(text) <> ''"))
    part = F.split(F.trim("text"), ",")
    rows = lines.select("file", "block", "line", part[0].alias("origin"), part[1].alias("dest"), text.minutes(part[2]).alias("dep_min"),
                        text.minutes(part[3]).alias("arr_min"), part[4].cast("long").alias("price"))
    return numbered(rows, ["origin", "dest"], ["file", "block", "line"], "idx").drop("file", "block", "line")


def load_match(spark: SparkSession, path: str, columns: int, all_num: bool = False) -> DataFrame:
    """``data, match`` from (gzipped) CSV lines whose last of ``columns`` fields is the class."""
    names = [f"c{i}" for i in range(columns)]
    wide = spark.read.csv(path, schema=", ".join(f"{n} STRING" for n in names))
    kind = "double" if all_num else "string"
    return wide.select(F.array(*[F.col(n).cast(kind) for n in names[:-1]]).alias("data"), F.trim(names[-1]).cast("int").alias("match"))


def load_volumes(spark: SparkSession, path: str) -> DataFrame:
    """``ticker, date, volume`` from headed CSV files (columns 0 and 5) in one ``ticker=…`` folder each."""
    names = ["date", "open", "high", "low", "close", "volume", "adjusted"]
    rows = spark.read.csv(path, header=True, schema=", ".join(f"`{n}` STRING" for n in names))
    return rows.where("date IS NOT NULL").select(F.col("ticker").cast("string").alias("ticker"), "date", F.col("volume").cast("double").alias("volume"))


def write_report(lines: DataFrame, path: str) -> None:
    """Write a one-column report as text files."""
    lines.write.text(path)
