"""Link extraction, the link graph and its rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.functions import text
from minewright.session import cut, laid_out


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` seen from the page ``base``, without the fragment."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(path, "[^/]*$", "")
    absolute = (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
                .when(href.startswith("//"), F.concat(scheme, href))
                .when(href.startswith("/"), F.concat(site, href))
                .when(href.startswith("?"), F.concat(site, path, href))
                .when((href == "") | href.startswith("#"), F.regexp_replace(base, "#.*$", ""))
                .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), href)))
    return F.regexp_replace(absolute, "#.*$", "")


def page_links(pages: DataFrame) -> DataFrame:
    """``page_id, seq, from_url, to_url, anchor`` of every usable link of every page."""
    anchor = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    found = (pages.select("page_id", F.col("url").alias("from_url"), F.posexplode(F.arrays_zip(
                F.regexp_extract_all("html", F.lit(anchor), F.lit(1)).alias("href"),
                F.regexp_extract_all("html", F.lit(anchor), F.lit(2)).alias("inner"))).alias("seq", "link"))
             .withColumn("target", resolve(F.col("from_url"), F.col("link.href"))))
    # Quoted targets are skipped before the fragment is cut, so the raw href counts too.
    usable = ~F.contains(F.concat("link.href", "target"), F.lit("'")) & (
        F.col("target").startswith("file") | F.col("target").startswith("http"))
    return found.where(usable).select("page_id", "seq", "from_url", F.col("target").alias("to_url"),
                                      text.page_text(F.col("link.inner")).alias("anchor"))


def link_words(links: DataFrame) -> DataFrame:
    """Anchor words per link, stop words and self-links left out."""
    return (links.where("from_url <> to_url")
            .select("page_id", "seq", "from_url", "to_url", F.explode(text.plain_words(F.col("anchor"))).alias("word"))
            .where(~F.col("word").isin(text.STOP_WORDS)))


#: Links of one page that are kept together; a page with more is split.
HUB = 100_000


def page_rank(nodes: DataFrame, edges: DataFrame, rounds: int = 20, damping: float = 0.85, cut_every: int = 5, hub: int = HUB) -> DataFrame:
    """Synchronous rank over ``nodes(url_id)`` and ``edges(from_id, to_id)``.

    Each distinct linker passes its rank divided by all its links. The distinct edges with their shares are laid out
    once by the page they start from; a page with more than ``hub`` links is laid out in several places, to which its rank
    travels. A round moves no edges: it reads them where the ranks are and sums what they pass on, first in
    every task and then per page, so a page that everybody links to is one sum per task. Links of pages that are no nodes
    pass nothing on; repeated nodes are one; an empty table gives an empty result.
    """
    kind = nodes.schema["url_id"].dataType
    edges = edges.select(F.col("from_id").cast(kind).alias("from_id"), F.col("to_id").cast(kind).alias("to_id"))
    out = edges.groupBy("from_id").agg(F.count("*").alias("links"))
    shares = edges.distinct().join(out, "from_id").select("from_id", "to_id", (F.lit(damping) / F.col("links")).alias("share"))
    hubs = cut(out.where(F.col("links") > hub).select("from_id", F.ceil(F.col("links") / hub).alias("places")), "hubs")
    some = not hubs.isEmpty()
    plain = laid_out(shares.join(hubs, "from_id", "left_anti") if some else shares, ["from_id"], "shares")
    if some:
        place = F.pmod(F.xxhash64("to_id"), F.col("places")).alias("place")
        split = laid_out(shares.join(hubs, "from_id").select("from_id", place, "to_id", "share"), ["from_id", "place"], "hub_shares")
        hubs = laid_out(hubs, ["from_id"], "hubs")
    nodes = laid_out(nodes.select("url_id").distinct(), ["url_id"], "nodes")
    ranks = nodes.withColumn("score", F.lit(1.0))
    passed = F.col("share") * F.col("score")
    for done in range(1, rounds + 1):
        gains = plain.join(ranks, F.col("from_id") == F.col("url_id")).select("to_id", passed.alias("gain"))
        if some:
            spread = (hubs.join(ranks, F.col("from_id") == F.col("url_id"))
                      .select("from_id", "score", F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1)).alias("place")))
            gains = gains.unionByName(split.join(spread, ["from_id", "place"]).select("to_id", passed.alias("gain")))
        gained = gains.groupBy(F.col("to_id").alias("url_id")).agg(F.sum("gain").alias("gain"))
        ranks = nodes.join(gained, "url_id", "left").select(
            "url_id", (F.lit(1 - damping) + F.coalesce("gain", F.lit(0.0))).alias("score"))
        if done % cut_every == 0 and done < rounds:
            ranks = cut(ranks, "ranks")
    return ranks


def reachable(start: DataFrame, edges: DataFrame, depth: int = 2) -> DataFrame:
    """``url_id, depth`` of every node within ``depth`` link steps of the start nodes."""
    seen = start.select("url_id").distinct().withColumn("depth", F.lit(0))
    frontier = seen
    for step in range(1, depth + 1):
        fresh = (frontier.join(edges, F.col("url_id") == F.col("from_id"))
                 .select(F.col("to_id").alias("url_id")).distinct()
                 .join(seen, "url_id", "left_anti").withColumn("depth", F.lit(step)))
        frontier = cut(fresh, "frontier")
        seen = seen.unionByName(frontier)
    return seen
