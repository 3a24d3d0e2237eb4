"""Round trips: a view of the tables written in a file format and read back by its reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.operators import vectorize
from minewright.plans.bindings import ENTRIES, entries
from minewright.plans.factors import VOLUMES, volumes
from minewright.plans.texts import FEED_COUNTS
from minewright.registry import Tables, plan
from minewright.session import cut, scratch_path
from minewright.sources import files


@plan("load_ratings", """
SELECT CAST(o_custkey AS VARCHAR) AS person, p_name || ' #' || p_partkey AS item,
  arg_max(l_quantity, (date_diff('day', DATE '1970-01-01', l_shipdate::DATE) * 10000 + (l_orderkey * 100 + l_quantity::BIGINT) % 10000, l_quantity)) AS rating
FROM (SELECT o_custkey, l_partkey, l_orderkey, l_quantity, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def load_ratings(t: Tables):
    folder = scratch_path(t.spark, "ratings")
    items = t.part.select(F.col("p_partkey").cast("string"), F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")), F.lit("x"))
    items.write.csv(f"{folder}/items", sep="|", quote="")
    # The time is the ship day, with order and quantity as the last digits.
    data = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey"), F.col("l_partkey"), F.col("l_quantity"),
        (F.date_diff("l_shipdate", F.lit("1970-01-01").cast("date")).cast("long") * 10000 + F.pmod(F.col("l_orderkey") * 100 + F.col("l_quantity").cast("long"), F.lit(10000))).alias("ts"))
    data.write.csv(f"{folder}/data", sep="\t")
    return files.load_ratings(t.spark, f"{folder}/items", f"{folder}/data")


@plan("read_matrix", f"""WITH {FEED_COUNTS}
SELECT feed AS row_name, word AS "column", CAST(coalesce(n, 0) AS DOUBLE) AS value
FROM (SELECT DISTINCT feed FROM entries) CROSS JOIN (SELECT word FROM band) LEFT JOIN feed_counts USING (feed, word)""")
def read_matrix(t: Tables):
    folder = scratch_path(t.spark, "matrix")
    found = entries(t)
    counts = cut(vectorize.feed_word_counts(found), "counts")
    band = vectorize.vocabulary_band(counts, found)
    words = cut(vectorize.word_blocks(band, 100), "words")
    files.write_matrix(vectorize.matrix_blocks(counts, words, found), words, folder)
    return files.read_matrix(t.spark, folder)


@plan("feed_entries", f"""WITH {ENTRIES}
SELECT feed, trim(title) AS title, count(*) AS n FROM entries
GROUP BY feed, trim(title)""")
def feed_entries(t: Tables):
    folder = scratch_path(t.spark, "feeds")

    def tagged(name, value):
        safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "&", "&amp;"), "<", "&lt;"), r"\r?\n", "&#10;")
        return F.concat(F.lit(f"<{name}>"), F.regexp_replace(safe, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), F.lit(f"</{name}>"))

    # Every second entry has only a description.
    body = F.when(F.col("doc_id") % 2 == 0, tagged("summary", F.col("summary"))).otherwise(tagged("description", F.col("summary")))
    channel = F.concat(F.lit("<rss><channel>"), tagged("title", F.col("feed")), F.lit("<item>"), tagged("title", F.col("title")), body, F.lit("</item></channel></rss>"))
    entries(t).select(channel.alias("value")).write.text(folder)
    found = files.feed_entries(t.spark, folder, per_line=True).where("summary IS NOT NULL")
    return found.groupBy("feed", F.trim("title").alias("title")).agg(F.count("*").alias("n"))


@plan("load_schedule", """
SELECT CAST(c_nationkey AS VARCHAR) AS origin, CAST(o_orderkey % 2 AS VARCHAR) AS dest,
  row_number() OVER (PARTITION BY c_nationkey, o_orderkey % 2 ORDER BY o_orderkey) - 1 AS idx,
  o_orderkey % 1440 AS dep_min, o_custkey % 1440 AS arr_min, CAST(floor(o_totalprice / 1000) AS BIGINT) AS price
FROM orders JOIN customer ON o_custkey = c_custkey""")
def load_schedule(t: Tables):
    folder = scratch_path(t.spark, "schedule")

    def clock(minute):
        return F.concat(F.floor(minute / 60).cast("string"), F.lit(":"), F.lpad((minute % 60).cast("string"), 2, "0"))

    lines = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.concat_ws(
        ",", F.col("c_nationkey").cast("string"), (F.col("o_orderkey") % 2).cast("string"), clock(F.col("o_orderkey") % 1440),
        clock(F.col("o_custkey") % 1440), F.floor(F.col("o_totalprice") / 1000).cast("string")).alias("value"))
    # Files come out in key order, as many as the data fill: range partitions are numbered and named in order.
    lines.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").select("value").write.text(folder)
    return files.load_schedule(t.spark, folder)


@plan("load_match", """
SELECT (l_returnflag = 'R')::INT AS match, l_quantity::DOUBLE AS quantity, round(l_discount * 100)::DOUBLE AS discount FROM lineitem""")
def load_match(t: Tables):
    folder = scratch_path(t.spark, "match")
    t.lineitem.select("l_quantity", F.round(F.col("l_discount") * 100), (F.col("l_returnflag") == "R").cast("int")).write.csv(folder, compression="gzip")
    return files.load_match(t.spark, folder, 3, all_num=True).select("match", F.get("data", F.lit(0)).alias("quantity"), F.get("data", F.lit(1)).alias("discount"))


@plan("load_volumes", f"WITH {VOLUMES} SELECT ticker, date, volume FROM volumes")
def load_volumes(t: Tables):
    folder = scratch_path(t.spark, "volumes")
    zero = F.lit(0)
    (volumes(t).select("ticker", "date", zero.alias("open"), zero.alias("high"), zero.alias("low"), zero.alias("close"), "volume", zero.alias("adjusted"))
     .repartition("ticker").write.partitionBy("ticker").csv(folder, header=True))
    return files.load_volumes(t.spark, folder)
