"""Text scalars and vectorising."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.functions import text
from minewright.operators import vectorize
from minewright.plans.bindings import ENTRIES, articles, entries
from minewright.registry import Tables, plan
from minewright.session import cut


def _joined(df, key, words):
    return df.select(key, words.alias("w")).select(
        key, F.array_join("w", " ").alias("words"), F.size("w").cast("long").alias("n"))


def _words_oracle(table, key, expression):
    return f"""SELECT {key}, coalesce(array_to_string(w, ' '), '') AS words, CAST(len(w) AS BIGINT) AS n
FROM (SELECT {key}, {expression} AS w FROM {table})"""


@plan("tokens_html", _words_oracle("pages", "page_id", r"""list_filter(list_transform(regexp_split_to_array(
  regexp_replace(html, '<[^>]+', '', 'g'), '[^A-Z^a-z]+'), lambda x: lower(x)), lambda x: x <> '')"""))
def tokens_html(t: Tables):
    return _joined(t.pages, "page_id", text.html_words(F.col("html")))


@plan("tokens_plain", _words_oracle("documents", "doc_id", r"""list_filter(list_transform(
  regexp_split_to_array(text, '\W+'), lambda x: lower(x)), lambda x: x <> '')"""))
def tokens_plain(t: Tables):
    return _joined(t.documents, "doc_id", text.plain_words(F.col("text")))


@plan("tokens_distinct", r"""
SELECT doc_id, string_agg(w, ' ' ORDER BY w) AS words, count(*) AS n FROM (
  SELECT DISTINCT doc_id, lower(w) AS w
  FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\W+')) AS w FROM documents)
  WHERE length(w) BETWEEN 3 AND 19) GROUP BY doc_id
UNION ALL
SELECT doc_id, '', 0 FROM documents
WHERE len(list_filter(regexp_split_to_array(text, '\W+'), lambda x: length(x) BETWEEN 3 AND 19)) = 0""")
def tokens_distinct(t: Tables):
    return _joined(t.documents, "doc_id", F.array_sort(text.distinct_words(F.col("text"))))


@plan("tokens_long", _words_oracle("documents", "doc_id", r"""list_transform(list_filter(
  regexp_split_to_array(text, '\W+'), lambda x: length(x) > 3), lambda x: lower(x))"""))
def tokens_long(t: Tables):
    return _joined(t.documents, "doc_id", text.long_words(F.col("text")))


@plan("strip_html", """
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '<[^>]*$', '', 'g'), '>', ' ', 'g') AS text
FROM pages""")
def strip_html(t: Tables):
    return t.pages.select("page_id", text.strip_html(F.col("html")).alias("text"))


PAGE_TEXT = r"""page_texts AS (
  SELECT page_id, url, coalesce(array_to_string(list_filter(list_transform(string_split(
    replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(
        regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', chr(1), 'g'),
        '<[^>]*>', chr(1), 'g'), '<[^>]*$', '', 'g'),
      '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), chr(1)),
    lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> ''), chr(10)), '') AS body
  FROM pages)"""


@plan("page_text", f"WITH {PAGE_TEXT} SELECT page_id, body AS text FROM page_texts")
def page_text(t: Tables):
    return t.pages.select("page_id", text.page_text(F.col("html")).alias("text"))


@plan("entry_features", rf"""
WITH {ENTRIES}, w AS (
  SELECT doc_id, title, publisher,
    list_filter(regexp_split_to_array(summary, '\W+'), lambda x: length(x) BETWEEN 3 AND 19) AS ws FROM entries),
u AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, len(ws) AS n, unnest(ws) AS x, unnest(list_append(ws[2:], NULL)) AS nxt FROM w),
up AS (SELECT *, regexp_matches(x, '^[^a-z]*[A-Z][^a-z]*$') AS shout FROM u),
f AS (
  SELECT doc_id, 'Title:' || lower(x) AS feature FROM (
    SELECT doc_id, unnest(regexp_split_to_array(title, '\W+')) AS x FROM entries) WHERE length(x) BETWEEN 3 AND 19
  UNION SELECT doc_id, lower(x) FROM up
  UNION SELECT doc_id, lower(x || ' ' || nxt) FROM up WHERE shout AND i < n
  UNION SELECT doc_id, 'Publisher:' || publisher FROM entries
  UNION SELECT doc_id, 'UPPERCASE' FROM up GROUP BY doc_id HAVING count_if(shout) > 0.3 * count(*))
SELECT doc_id, string_agg(feature, '|' ORDER BY feature) AS features, count(*) AS n FROM f GROUP BY doc_id""")
def entry_features(t: Tables):
    found = text.entry_features(F.col("title"), F.col("summary"), F.col("publisher"))
    return (entries(t).select("doc_id", F.array_sort(found).alias("f"))
            .select("doc_id", F.nullif(F.array_join("f", "|"), F.lit("")).alias("features"), F.size("f").cast("long").alias("n")))


FEED_COUNTS = rf"""{ENTRIES}, feed_counts AS (
  SELECT feed, word, count(*) AS n FROM (
    SELECT feed, lower(unnest(regexp_split_to_array(
      regexp_replace(title || ' ' || summary, '<[^>]+', '', 'g'), '[^A-Z^a-z]+'))) AS word FROM entries)
  WHERE word <> '' GROUP BY feed, word),
band AS (
  SELECT word, count_if(n > 1) AS feeds, count_if(n > 1) / (SELECT count(DISTINCT feed) FROM entries) AS frac
  FROM feed_counts GROUP BY word HAVING frac > 0.1 AND frac < 0.5)"""


@plan("doc_word_counts", f"WITH {FEED_COUNTS} SELECT feed, word, n FROM feed_counts")
def doc_word_counts(t: Tables):
    return vectorize.feed_word_counts(entries(t))


@plan("vocab_band", f"WITH {FEED_COUNTS} SELECT word, CAST(feeds AS BIGINT) AS feeds, round(frac, 6) AS frac FROM band")
def vocab_band(t: Tables):
    feed_entries = entries(t)
    band = vectorize.vocabulary_band(vectorize.feed_word_counts(feed_entries), feed_entries)
    return band.select("word", "feeds", F.round("frac", 6).alias("frac"))


@plan("doc_term_matrix", f"""
WITH {FEED_COUNTS}, placed AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS place FROM band)
SELECT feed, CAST(place // 100 AS INT) AS block, string_agg(coalesce(n, 0), chr(9) ORDER BY word) AS line
FROM (SELECT DISTINCT feed FROM entries) CROSS JOIN placed LEFT JOIN feed_counts USING (feed, word)
GROUP BY feed, place // 100""")
def doc_term_matrix(t: Tables):
    """The matrix in column blocks of 100 words: no row holds the whole vocabulary."""
    feed_entries = entries(t)
    counts = cut(vectorize.feed_word_counts(feed_entries), "counts")
    words = cut(vectorize.word_blocks(vectorize.vocabulary_band(counts, feed_entries), 100), "words")
    return vectorize.matrix_blocks(counts, words, feed_entries).select("feed", "block", F.array_join("counts", "\t").alias("line"))


ARTICLES = rf"""{ENTRIES}, articles AS (
  SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id) = 1),
article_words AS (
  SELECT doc_id, lower(w) AS word, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_split_to_array(title || regexp_replace(regexp_replace(regexp_replace(
      summary, '<[^>]*>', ' ', 'g'), '<[^>]*$', '', 'g'), '>', ' ', 'g'), '\W+')) AS w FROM articles)
  WHERE length(w) > 3 GROUP BY doc_id, lower(w)),
article_matrix AS (
  SELECT doc_id, word, n FROM article_words JOIN (
    SELECT word FROM article_words GROUP BY word
    HAVING sum(n) > 3 AND sum(n) < 0.6 * (SELECT count(*) FROM articles)) USING (word))"""


@plan("article_words", f"WITH {ARTICLES} SELECT doc_id, word, n FROM article_words")
def article_words(t: Tables):
    return vectorize.article_words(articles(t))


def article_counts(t: Tables):
    """The filtered article-by-word counts that the topic operators factorise."""
    found = articles(t)
    return vectorize.article_matrix(vectorize.article_words(found), found)


@plan("article_matrix", f"WITH {ARTICLES} SELECT doc_id, word, n FROM article_matrix")
def article_matrix(t: Tables):
    return article_counts(t)


def tfidf_weights(t: Tables):
    found = articles(t)
    return vectorize.tfidf(vectorize.word_counts(found, "doc_id", F.col("summary"), 2), found)


TFIDF = rf"""{ENTRIES}, articles AS (
  SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id) = 1),
counts AS (
  SELECT doc_id, lower(w) AS word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_split_to_array(summary, '\W+')) AS w FROM articles)
  WHERE length(w) > 1 GROUP BY doc_id, lower(w)),
n AS (SELECT count(*) AS docs FROM articles),
vocabulary AS (
  SELECT word, ln((1 + any_value(docs)) / (1 + count(*))) + 1 AS idf FROM counts, n
  GROUP BY word HAVING count(*) <= 0.95 * any_value(docs) ORDER BY sum(n) DESC, word LIMIT 320),
tfidf AS (
  SELECT doc_id, word, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY doc_id)) AS weight FROM counts JOIN vocabulary USING (word))"""


@plan("tfidf", f"WITH {TFIDF} SELECT doc_id, word, round(weight, 6) AS weight FROM tfidf")
def tfidf(t: Tables):
    return tfidf_weights(t).withColumn("weight", F.round("weight", 6))


def tree_rows(t: Tables):
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("id"), "c_mktsegment", "o_orderpriority",
                    F.floor(F.col("o_totalprice") / 10000).alias("price_band"), F.col("o_orderstatus").alias("label")))


TREE_ROWS = """tree_obs AS (
  SELECT o_orderkey AS id, c_mktsegment, o_orderpriority, CAST(floor(o_totalprice / 10000) AS BIGINT) AS price_band,
    o_orderstatus AS label
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@plan("one_hot", f"""
WITH {TREE_ROWS}
SELECT id, 'c_mktsegment=' || c_mktsegment AS feature, CAST(1 AS DOUBLE) AS value FROM tree_obs
UNION ALL SELECT id, 'o_orderpriority=' || o_orderpriority, 1 FROM tree_obs
UNION ALL SELECT id, 'price_band', price_band FROM tree_obs""")
def one_hot(t: Tables):
    return vectorize.indicators(tree_rows(t), "id", ["c_mktsegment", "o_orderpriority", "price_band"])


@plan("yes_no", """
SELECT v AS answer, CASE v WHEN 'yes' THEN 1 WHEN 'no' THEN -1 ELSE 0 END::BIGINT AS code, count(*) AS n
FROM (SELECT CASE WHEN value >= 50 THEN 'yes' WHEN value < 10 THEN 'no' ELSE '' END AS v FROM events) GROUP BY v""")
def yes_no(t: Tables):
    answer = F.when(F.col("value") >= 50, "yes").when(F.col("value") < 10, "no").otherwise("")
    return (t.events.select(answer.alias("answer")).withColumn("code", text.yes_no(F.col("answer")))
            .groupBy("answer", "code").agg(F.count("*").alias("n")))


def interests(t: Tables):
    """Colon-separated brands each customer bought (a brand list is as short as the brand catalogue)."""
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("o_custkey").alias("person")).agg(F.array_sort(F.collect_set("p_brand")).alias("b"))
            .select("person", F.array_join("b", ":").alias("interests")))


INTERESTS = """interests AS (
  SELECT o_custkey AS person, string_agg(DISTINCT p_brand, ':' ORDER BY p_brand) AS interests
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_custkey)"""


@plan("match_count", f"""
WITH {INTERESTS}
SELECT a.person AS a, b.person AS b,
  CAST(len(list_filter(string_split(a.interests, ':'), lambda v: list_contains(string_split(b.interests, ':'), v))) AS BIGINT) AS shared
FROM interests a JOIN interests b ON b.person = a.person + 1""")
def match_count(t: Tables):
    people = interests(t)
    right = people.select((F.col("person") - 1).alias("a"), F.col("person").alias("b"), F.col("interests").alias("theirs"))
    return (people.select(F.col("person").alias("a"), F.col("interests").alias("ours")).join(right, "a")
            .select("a", "b", text.match_count(F.col("ours"), F.col("theirs")).alias("shared")))


@plan("minutes", """
SELECT o_orderkey, clock, CAST(split_part(clock, ':', 1) AS BIGINT) * 60 + CAST(split_part(clock, ':', 2) AS BIGINT) AS minutes
FROM (SELECT o_orderkey, CAST(o_custkey % 24 AS VARCHAR) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') AS clock FROM orders)""")
def minutes(t: Tables):
    clock = F.concat((F.col("o_custkey") % 24).cast("string"), F.lit(":"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"))
    return (t.orders.select("o_orderkey", clock.alias("clock"))
            .withColumn("minutes", text.minutes(F.col("clock"))))
