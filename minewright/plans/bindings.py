"""The mining inputs as views of the given tables, in Spark and as DuckDB CTE text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.operators.vectorize import first_by_title
from minewright.registry import Tables
from minewright.session import cut


def prefs(t: Tables) -> DataFrame:
    """Customers rate the brands they bought by mean quantity."""
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("o_custkey").alias("person"), F.col("p_brand").alias("item"))
            .agg(F.avg("l_quantity").alias("rating")))


def stored_prefs(t: Tables) -> DataFrame:
    """The ratings written once, for queries that read them several times."""
    return cut(prefs(t), "prefs")


PREFS = """prefs AS (
  SELECT o_custkey AS person, p_brand AS item, avg(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY o_custkey, p_brand)"""


def neighbours(ratings: DataFrame) -> DataFrame:
    """Requested pairs: every customer with the next customer number."""
    people = ratings.select(F.col("person").alias("a")).distinct()
    return people.join(people.select((F.col("a") - 1).alias("a"), F.col("a").alias("b")), "a")


NEIGHBOURS = """pairs AS (
  SELECT x.person AS a, y.person AS b FROM (SELECT DISTINCT person FROM prefs) x
  JOIN (SELECT DISTINCT person FROM prefs) y ON y.person = x.person + 1)"""


def entries(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", F.col("source").alias("feed"), F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("summary"), F.col("source").alias("publisher"))


def articles(t: Tables) -> DataFrame:
    """The earliest entry of every title; the repeated titles are found once a query."""
    if "articles" not in vars(t):
        t.articles = first_by_title(entries(t))
    return t.articles


ENTRIES = """entries AS (
  SELECT doc_id, source AS feed, split_part(text, chr(10), 1) AS title, text AS summary, source AS publisher
  FROM documents)"""


def labelled(t: Tables) -> DataFrame:
    return (t.documents.join(t.labels, "doc_id")
            .select("doc_id", "text", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("category")))


LABELLED = """labelled AS (
  SELECT d.doc_id, d.text, CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS category
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
