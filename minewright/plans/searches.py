"""Index, link graph and ranked search over the stored pages."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from minewright.operators import index, links, ranking
from minewright.operators.vectorize import first_by
from minewright.plans.texts import PAGE_TEXT
from minewright.registry import Tables, plan
from minewright.session import cut, scratch_path
from minewright.sources import files

STOP = "('the', 'of', 'to', 'and', 'a', 'in', 'is', 'it')"

PAGES = "first_pages AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1)"
POSTINGS = rf"""{PAGES}, {PAGE_TEXT.replace('FROM pages)', 'FROM first_pages)')},
split_words AS (SELECT url, list_filter(regexp_split_to_array(lower(body), '\W+'), lambda x: x <> '') AS ws FROM page_texts),
postings AS (
  SELECT * FROM (SELECT url, generate_subscripts(ws, 1) - 1 AS location, unnest(ws) AS word FROM split_words)
  WHERE word NOT IN {STOP})"""

SCHEME = r"'^[A-Za-z][A-Za-z0-9+.\-]*:'"
LINKS = rf"""raw_links AS (
  SELECT page_id, url, generate_subscripts(h, 1) - 1 AS seq, unnest(h) AS href, unnest(i) AS inside FROM (
    SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) AS h,
      regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2) AS i FROM first_pages)),
parts AS (
  SELECT *, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*:)', 1) AS scheme,
    regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) AS site,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path FROM raw_links),
resolved AS (
  SELECT *, regexp_replace(CASE WHEN regexp_matches(href, {SCHEME}) THEN href WHEN href LIKE '//%' THEN scheme || href
    WHEN href LIKE '/%' THEN site || href WHEN href LIKE '?%' THEN site || path || href
    WHEN href = '' OR href LIKE '#%' THEN regexp_replace(url, '#.*$', '')
    ELSE site || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || href
    END, '#.*$', '') AS to_url FROM parts),
page_links AS (
  SELECT page_id, CAST(seq AS INT) AS seq, url AS from_url, to_url,
    trim(regexp_replace(inside, '<[^>]*>', ' ', 'g')) AS anchor
  FROM resolved WHERE NOT contains(href || to_url, chr(39)) AND (to_url LIKE 'file%' OR to_url LIKE 'http%')),
anchor_words AS (
  SELECT page_id, seq, from_url, to_url, w AS word FROM (
    SELECT page_id, seq, from_url, to_url, unnest(regexp_split_to_array(lower(anchor), '\W+')) AS w
    FROM page_links WHERE from_url <> to_url) WHERE w <> '' AND w NOT IN {STOP})"""

DICTIONARIES = """url_list AS (
  SELECT row_number() OVER (ORDER BY url) AS url_id, url FROM (
    SELECT url FROM first_pages UNION SELECT to_url FROM page_links)),
word_list AS (
  SELECT row_number() OVER (ORDER BY word) AS word_id, word FROM (
    SELECT word FROM postings UNION SELECT word FROM anchor_words))"""

INDEXED = f"WITH {POSTINGS}, {LINKS}, {DICTIONARIES}"


class Site:
    """The stored index of the pages: built once per query run, then only read."""

    def __init__(self, t: Tables):
        self.pages = first_by(t.pages, "url", "page_id")

    @cached_property
    def store(self):
        return index.posting_store(index.grouped_postings(self.pages), scratch_path(self.pages.sparkSession, "postings"))

    @property
    def postings(self):
        return index.locations(self.store)

    @cached_property
    def links(self):
        return cut(links.page_links(self.pages), "links")

    @cached_property
    def anchor_words(self):
        return links.link_words(self.links)

    def urls(self):
        return self.pages.select("url").union(self.links.select("to_url")).distinct()

    def url_list(self):
        return index.dictionary(self.urls(), "url", "url_id")

    def word_list(self):
        return index.dictionary(self.store.select("word").union(self.anchor_words.select("word")), "word", "word_id")

    def edges(self):
        return self.links.where("from_url <> to_url").select(F.col("from_url").alias("from_id"), F.col("to_url").alias("to_id"))

    @cached_property
    def ranks(self):
        nodes = self.urls().select(F.col("url").alias("url_id"))
        return cut(links.page_rank(nodes, self.edges()).withColumnRenamed("url_id", "url"), "ranks")

    @cached_property
    def query(self):
        """The query: the two words found on most pages, in that order."""
        top = (self.store.groupBy("word").agg(F.count("*").alias("n"))
               .orderBy(F.desc("n"), "word").limit(2))
        ordered = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))).alias("w"))
        return cut(ordered.select(F.posexplode(F.col("w.word")).alias("word_no", "word")), "query")

    @cached_property
    def matches(self):
        return cut(ranking.match_rows(self.postings, self.query), "matches")


@plan("url_list", f"{INDEXED} SELECT url_id, url FROM url_list")
def url_list(t: Tables):
    return Site(t).url_list()


@plan("word_list", f"{INDEXED} SELECT word_id, word FROM word_list")
def word_list(t: Tables):
    return Site(t).word_list()


@plan("extend_ids", f"""{INDEXED}, known AS (
  SELECT row_number() OVER (ORDER BY to_url) AS url_id, to_url AS url FROM (SELECT DISTINCT to_url FROM page_links))
SELECT url_id, url FROM known UNION ALL
SELECT (SELECT coalesce(max(url_id), 0) FROM known) + row_number() OVER (ORDER BY url), url FROM (
  SELECT DISTINCT url FROM first_pages WHERE url NOT IN (SELECT url FROM known))""")
def extend_ids(t: Tables):
    """Link targets got their ids first; the stored pages that none of them is come after."""
    site = Site(t)
    known = cut(index.dictionary(site.links.select(F.col("to_url").alias("url")), "url", "url_id"), "known")
    return index.extend_dictionary(known, site.pages, "url", "url_id")


@plan("word_report", f"{INDEXED} SELECT word_id || ' ' || word AS value FROM word_list")
def word_report(t: Tables):
    """The word list as a text report, written and read again."""
    path = scratch_path(t.spark, "report")
    files.write_report(Site(t).word_list().select(F.concat_ws(" ", "word_id", "word").alias("value")), path)
    return t.spark.read.text(path)


@plan("word_location", f"""{INDEXED}
SELECT url_id, word_id, location FROM postings JOIN url_list USING (url) JOIN word_list USING (word)""")
def word_location(t: Tables):
    site = Site(t)
    return index.word_location(site.postings, site.url_list(), site.word_list())


@plan("new_pages", f"{INDEXED} SELECT url FROM url_list WHERE url NOT IN (SELECT url FROM postings)")
def new_pages(t: Tables):
    site = Site(t)
    return index.new_pages(site.urls(), site.store)


@plan("page_links", f"{INDEXED} SELECT page_id, seq, from_url, to_url, anchor FROM page_links")
def page_links(t: Tables):
    return Site(t).links


@plan("link", f"""{INDEXED}
SELECT page_id, seq, f.url_id AS from_id, g.url_id AS to_id
FROM page_links JOIN url_list f ON f.url = from_url JOIN url_list g ON g.url = to_url WHERE from_url <> to_url""")
def link(t: Tables):
    site = Site(t)
    ids = site.url_list()
    return (site.links.where("from_url <> to_url")
            .join(ids.select(F.col("url_id").alias("from_id"), F.col("url").alias("from_url")), "from_url")
            .join(ids.select(F.col("url_id").alias("to_id"), F.col("url").alias("to_url")), "to_url")
            .select("page_id", "seq", "from_id", "to_id"))


@plan("link_words", f"{INDEXED} SELECT page_id, seq, word_id FROM anchor_words JOIN word_list USING (word)")
def link_words(t: Tables):
    site = Site(t)
    return site.anchor_words.join(site.word_list(), "word").select("page_id", "seq", "word_id")


def supplier_links(t: Tables):
    """A cyclic, skewed graph over suppliers: every line item is a link."""
    count = t.supplier.agg(F.count("*")).scalar()
    return (t.lineitem.select("l_suppkey", "l_partkey").withColumn("c", count)
            .select(F.col("l_suppkey").alias("from_id"),
                    F.floor((F.col("l_partkey") % F.col("c")) * (F.col("l_partkey") % F.col("c")) / F.col("c")).alias("to_id"))
            .where("from_id <> to_id"))


GRAPH = """edges AS (
  SELECT * FROM (SELECT l_suppkey AS from_id, CAST(floor(((l_partkey % c) * (l_partkey % c)) / c) AS BIGINT) AS to_id
    FROM lineitem, (SELECT count(*) AS c FROM supplier)) WHERE from_id <> to_id),
shares AS (
  SELECT from_id, to_id, 0.85 / links AS share FROM (SELECT DISTINCT from_id, to_id FROM edges)
  JOIN (SELECT from_id, count(*) AS links FROM edges GROUP BY from_id) USING (from_id))"""


def rank_rounds(nodes: str, rounds: int = 20) -> str:
    steps = [f"r0 AS (SELECT id, CAST(1 AS DOUBLE) AS score FROM {nodes})"]
    for i in range(1, rounds + 1):
        steps.append(f"""r{i} AS (SELECT n.id, 0.15 + coalesce(g.gain, 0) AS score FROM {nodes} n LEFT JOIN (
  SELECT to_id AS id, sum(share * score) AS gain FROM shares JOIN r{i - 1} ON from_id = id GROUP BY to_id) g USING (id))""")
    return ",\n".join(steps)


@plan("page_rank", f"""WITH nodes AS (SELECT s_suppkey AS id FROM supplier), {GRAPH}, {rank_rounds('nodes')}
SELECT id AS url_id, round(score, 6) AS score FROM r20""")
def page_rank(t: Tables):
    nodes = t.supplier.select(F.col("s_suppkey").alias("url_id"))
    return links.page_rank(nodes, supplier_links(t)).withColumn("score", F.round("score", 6))


@plan("reachable_pages", f"""WITH RECURSIVE {GRAPH}, walk AS (
  SELECT min(s_suppkey) AS url_id, 0 AS depth FROM supplier
  UNION SELECT to_id, depth + 1 FROM walk JOIN (SELECT DISTINCT from_id, to_id FROM edges) ON from_id = url_id WHERE depth < 2)
SELECT url_id, min(depth) AS depth FROM walk GROUP BY url_id""")
def reachable_pages(t: Tables):
    return links.reachable(t.supplier.agg(F.min("s_suppkey").alias("url_id")), supplier_links(t).distinct())


QUERY = f"""{INDEXED}, query AS (
  SELECT row_number() OVER (ORDER BY n DESC, word) - 1 AS word_no, word FROM (
    SELECT word, count(DISTINCT url) AS n FROM postings GROUP BY word ORDER BY n DESC, word LIMIT 2)),
hits AS (SELECT url, word_no, word, location FROM postings JOIN query USING (word)),
full_pages AS (SELECT url FROM hits GROUP BY url HAVING count(DISTINCT word_no) = (SELECT count(DISTINCT word_no) FROM hits)),
rows AS (SELECT * FROM hits WHERE url IN (SELECT url FROM full_pages)),
combos AS (SELECT a.url, a.location AS l0, b.location AS l1 FROM rows a JOIN rows b ON a.url = b.url AND a.word_no = 0 AND b.word_no = 1),
freq AS (SELECT url, CAST(count(*) AS DOUBLE) AS value FROM combos GROUP BY url),
loc AS (SELECT url, min(l0 + l1) AS value FROM combos GROUP BY url),
dist AS (SELECT url, min(abs(l0 - l1)) AS value FROM combos GROUP BY url),
freq_score AS (SELECT url, value / (SELECT max(value) FROM freq) AS score FROM freq),
loc_score AS (SELECT url, (SELECT min(value) FROM loc) / greatest(value, 0.00001) AS score FROM loc),
dist_score AS (SELECT url, (SELECT min(value) FROM dist) / greatest(value, 0.00001) AS score FROM dist)"""


def _big(source):
    return f"""SELECT url, coalesce(value, 0) / (SELECT CASE WHEN max(coalesce(value, 0)) = 0 THEN 0.00001 ELSE max(coalesce(value, 0)) END
  FROM full_pages LEFT JOIN {source} USING (url)) AS score FROM full_pages LEFT JOIN {source} USING (url)"""


RANKED = f"""{QUERY}, edges AS (SELECT from_url AS from_id, to_url AS to_id FROM page_links WHERE from_url <> to_url),
shares AS (
  SELECT from_id, to_id, 0.85 / links AS share FROM (SELECT DISTINCT from_id, to_id FROM edges)
  JOIN (SELECT from_id, count(*) AS links FROM edges GROUP BY from_id) USING (from_id)),
nodes AS (SELECT url AS id FROM url_list), {rank_rounds('nodes')},
ranks AS (SELECT id AS url, score AS value FROM r20),
inbound AS (SELECT to_url AS url, count(*) AS value FROM page_links WHERE from_url <> to_url GROUP BY to_url),
votes AS (
  SELECT a.to_url AS url, sum(r.value) AS value FROM anchor_words a JOIN query USING (word) JOIN ranks r ON r.url = a.from_url
  GROUP BY a.to_url),
inbound_score AS ({_big('inbound')}), rank_score AS ({_big('ranks')}), text_score AS ({_big('votes')})"""


@plan("match_rows", f"{QUERY} SELECT url, CAST(word_no AS INT) AS word_no, word, CAST(location AS INT) AS location FROM rows")
def match_rows(t: Tables):
    return Site(t).matches


def _scores(df):
    return df.select("url", F.round("score", 6).alias("score"))


@plan("normalize_scores", """SELECT s_suppkey AS url, round(n / (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)), 6) AS score
FROM (SELECT l_suppkey AS s_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey)""")
def normalize_scores(t: Tables):
    return _scores(ranking.normalized(t.lineitem.groupBy(F.col("l_suppkey").alias("url")).agg(F.count("*").alias("value"))))


@plan("score_frequency", f"{QUERY} SELECT url, round(score, 6) AS score FROM freq_score")
def score_frequency(t: Tables):
    return _scores(ranking.frequency_score(Site(t).matches))


@plan("score_location", f"{QUERY} SELECT url, round(score, 6) AS score FROM loc_score")
def score_location(t: Tables):
    return _scores(ranking.location_score(Site(t).matches))


@plan("score_distance", f"{QUERY} SELECT url, round(score, 6) AS score FROM dist_score")
def score_distance(t: Tables):
    return _scores(ranking.distance_score(Site(t).matches))


@plan("score_distance_unknown", f"{QUERY} SELECT url, round(score, 6) AS score FROM dist_score")
def score_distance_unknown(t: Tables):
    """The same query with words that no page has before and between its words: they change nothing."""
    site = Site(t)
    asked = site.query.select((2 * F.col("word_no") + 1).alias("word_no"), "word")
    unknown = asked.select(F.col("word_no") - 1, F.concat(F.lit("0unknown "), "word").alias("word"))
    return _scores(ranking.distance_score(cut(ranking.match_rows(site.postings, asked.unionByName(unknown.toDF("word_no", "word"))), "matches")))


@plan("score_inbound", f"{RANKED} SELECT url, round(score, 6) AS score FROM inbound_score")
def score_inbound(t: Tables):
    site = Site(t)
    return _scores(ranking.inbound_score(site.matches, site.links.where("from_url <> to_url")))


@plan("score_page_rank", f"{RANKED} SELECT url, round(score, 6) AS score FROM rank_score")
def score_page_rank(t: Tables):
    site = Site(t)
    return _scores(ranking.rank_score(site.matches, site.ranks))


@plan("score_link_text", f"{RANKED} SELECT url, round(score, 6) AS score FROM text_score")
def score_link_text(t: Tables):
    site = Site(t)
    return _scores(ranking.link_text_score(site.matches, site.anchor_words, site.ranks, site.query))


def scored_pages(t: Tables):
    site = Site(t)
    ranks = site.ranks
    scores = ranking.page_scores(ranking.matched_pages(site.store, site.query), {
        "rank": ranks.select("url", F.col("score").alias("value")), "votes": ranking.link_votes(site.anchor_words, ranks, site.query)}, {"location"})
    return ranking.weighted(scores, dict.fromkeys(("location", "frequency", "rank", "votes"), 1.0))


TOTAL = f"""{RANKED}, total AS (
  SELECT url, round(sum(score), 6) AS score FROM (
    SELECT * FROM loc_score UNION ALL SELECT * FROM freq_score UNION ALL SELECT * FROM rank_score UNION ALL SELECT * FROM text_score)
  GROUP BY url)"""


@plan("search_scores", f"{TOTAL} SELECT url, score FROM total")
def search_scores(t: Tables):
    return _scores(scored_pages(t))


@plan("search", f"{TOTAL} SELECT url, score FROM total ORDER BY score DESC, url DESC LIMIT 10")
def search(t: Tables):
    return ranking.top_pages(_scores(scored_pages(t)), F.desc("score"))
